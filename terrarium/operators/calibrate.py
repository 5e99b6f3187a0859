"""Load-cell bursts and two-point calibration (Q11: A4, J3, F15)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from terrarium.functions import expr as X
from terrarium.operators.asof import asof_joins

# Fixed value: a calibration point never saved reads as 1000.
DEFAULT_POINT = 1000.0
ZERO = "zero"
ONE_KG = "1kg"


def spread(n: Column, var_pop: Column) -> Column:
    """One-pass spread with divisor n-2 (not n-1): sqrt(S/(n-2)) where
    S = n*var_pop.  Null for n <= 2, where the device formula breaks down."""
    return F.when(n > 2, F.sqrt(var_pop * n / (n - 2)))


def burst_stats(bursts: DataFrame, keys=("sensor", "reading_ts"), v: str = "v") -> DataFrame:
    """A4 over the long form (one row per sample): n, mean ``raw`` and
    ``stddev`` per reading.  All three aggregates are partial-aggregated."""
    n = F.count(F.col(v))
    return (bursts.groupBy(*keys)
            .agg(n.alias("n"), F.avg(v).alias("raw"),
                 spread(n, F.var_pop(v)).alias("stddev")))


def burst_stats_array(samples: Column) -> tuple[Column, Column, Column]:
    """A4 over the array form: (n, raw, stddev) computed row-locally with
    higher-order functions, no shuffle.  Nulls in the array are skipped."""
    vals = F.filter(samples, lambda x: x.isNotNull())
    n = F.size(vals).cast("long")
    total = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x)
    mean = F.try_divide(total, n)
    ss = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return n, F.when(n > 0, mean), F.when(n > 2, F.sqrt(ss / (n - 2)))


def calibrated(readings: DataFrame, calibrations: DataFrame, sensor: str = "sensor",
               ts: str = "timestamp", raw: str = "raw", **asof_opts) -> DataFrame:
    """Q11: each raw reading uses the latest ``zero`` and ``1kg`` presses of
    its sensor at or before its time (default 1000 when never saved), then
    grams = (raw - zero) * 1000 / (one_kg - zero), null when the points are
    equal.  ``calibrations`` has (sensor, point, ts, raw)."""
    cal = calibrations.select(F.col("sensor").alias(sensor), "point", F.col("ts").alias("_cts"),
                              F.col("raw").alias("_craw"))
    zero = cal.where(F.col("point") == ZERO).select(sensor, "_cts", F.col("_craw").alias("zero"))
    one = cal.where(F.col("point") == ONE_KG).select(sensor, "_cts", F.col("_craw").alias("one_kg"))
    out = asof_joins(readings, [(zero, ["zero"]), (one, ["one_kg"])], [sensor], ts, "_cts", **asof_opts)
    z = F.coalesce(F.col("zero"), F.lit(DEFAULT_POINT))
    k = F.coalesce(F.col("one_kg"), F.lit(DEFAULT_POINT))
    return (out.withColumn("zero", z).withColumn("one_kg", k)
            .withColumn("grams", X.calibrate(F.col(raw), z, k)))


#: Sensors are dealt over this many buckets of a stream's state, and the
#: readings of each over this many groups of its bucket.
BUCKETS = 64
SPREAD = 8
#: Held by a group: the names of its sensors, and packed rows that name them by place.
_HELD = "sensors array<string>, presses binary, readings binary"
_PRESS = np.dtype([("one", "?"), ("s", "i4"), ("t", "i8"), ("v", "f8")])
_READING = np.dtype([("s", "i4"), ("t", "i8"), ("v", "f8")])
_FOUND = "sensor string, timestamp timestamp, raw double, zero double, one_kg double"


def _rows(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(columns["t"]), kind)
    for name, values in columns.items():
        out[name] = values
    return out


def _merged(presses: np.ndarray) -> np.ndarray:
    """Presses by point, sensor and time, of equal times the largest (-inf: no value)."""
    presses = presses[np.lexsort([presses[c] for c in ("v", "t", "s", "one")])]
    a, b = presses[:-1], presses[1:]
    return presses[np.append((a["one"] != b["one"]) | (a["s"] != b["s"]) | (a["t"] != b["t"]), True)[:presses.size]]


def _still_met(presses: np.ndarray, mark: int) -> np.ndarray:
    """Merged presses without those before a sensor's last one at ``mark``: no
    reading to come meets them."""
    a, b = presses[:-1], presses[1:]
    return presses[np.append((a["one"] != b["one"]) | (a["s"] != b["s"]) | (b["t"] > mark), True)[:presses.size]]


def _points(presses: np.ndarray, one: bool, readings: np.ndarray) -> np.ndarray:
    """For each reading the value of its sensor's last press at or before it."""
    own = presses[presses["one"] == one]
    times, place = np.unique(np.concatenate([own["t"], readings["t"]]), return_inverse=True)
    place += np.concatenate([own["s"], readings["s"]]).astype("i8") * times.size
    at = np.searchsorted(place[:own.size], place[own.size:], side="right") - 1
    v = np.where(np.append(own["s"], -2)[at] == readings["s"], np.append(own["v"], -np.inf)[at], -np.inf)
    return np.where(np.isneginf(v), DEFAULT_POINT, v)


def _as_of_watermark(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known, presses, readings = state.get if state.exists else ([], b"", b"")
    mark = state.getCurrentWatermarkMs() * 1000
    new = [f for f in frames if len(f)]
    codes, names = pd.factorize(np.concatenate([np.array(known, dtype=object), *[f["sensor"].to_numpy(object) for f in new]]))
    presses, readings = [np.frombuffer(presses, _PRESS)], [np.frombuffer(readings, _READING)]
    first = len(known)                      # codes of what is held stay; -1: no sensor
    for f in new:
        s, t = codes[first:first + len(f)], f["micros"].to_numpy("i8")
        point, v = f["point"].to_numpy("i8"), f["raw"].to_numpy("f8", na_value=np.nan)
        first += len(f)
        saved = point >= 0
        presses.append(_rows(_PRESS, one=point[saved] == 1, s=s[saved], t=t[saved],
                             v=np.where(np.isnan(v[saved]), -np.inf, v[saved])))
        readings.append(_rows(_READING, s=s[~saved], t=t[~saved], v=v[~saved]))
    # all presses that a closed reading can meet came before the watermark passed it
    presses, readings = _merged(np.concatenate(presses)), np.concatenate(readings)
    closed = readings[readings["t"] <= mark]
    if closed.size:
        yield pd.DataFrame({"sensor": np.append(names, None)[closed["s"]], "timestamp": pd.to_datetime(closed["t"], unit="us"),
                            "raw": closed["v"], "zero": _points(presses, False, closed), "one_kg": _points(presses, True, closed)})
    presses, readings = _still_met(presses, mark).copy(), readings[readings["t"] > mark].copy()
    used = np.union1d(presses["s"], readings["s"][readings["s"] >= 0])
    for rows in (presses, readings):
        rows["s"] = np.where(rows["s"] < 0, -1, np.searchsorted(used, rows["s"]))
    state.update((names[used].tolist(), presses.tobytes(), readings.tobytes()))
    if readings.size:
        state.setTimeoutTimestamp(int(readings["t"].min()) // 1000 + 1)


def calibrated_stream(readings: DataFrame, presses: DataFrame, watermark: str = "10 minutes",
                      spread: int = SPREAD, buckets: int = BUCKETS) -> DataFrame:
    """Q11 while the stream runs: ``readings`` (sensor, timestamp, raw) and
    ``presses`` (sensor, point, timestamp, raw) are streams; a reading comes
    out, with the points that ``calibrated`` would give it, once the watermark
    has passed its time, as no press can come between any more.

    The state of a sensor is its latest press of each point and what is newer
    than the watermark, however long a press holds.  (A join of the two
    streams on an interval holds back what is windowed on top of it for the
    whole interval, as long as a press may hold.)  Sensors are dealt over
    ``buckets``, as one call for each sensor costs far more than its rows;
    readings of a sensor are dealt over ``spread`` groups of its bucket, each
    of which gets the sensor's few presses.  Late rows are dropped; readings
    without a sensor get the defaults, in any bucket; rows without a time are
    left out; a press without a value counts as never saved."""
    micros = F.unix_micros("timestamp").alias("micros")
    bucket = F.pmod(F.xxhash64("sensor"), F.lit(buckets)).cast("int")
    deal = F.xxhash64("timestamp", "raw")
    anywhere = F.pmod(F.shiftright(deal, 16), F.lit(buckets)).cast("int")
    rows = readings.select(
        F.when(F.col("sensor").isNull(), anywhere).otherwise(bucket).alias("bucket"),
        F.pmod(deal, F.lit(spread)).cast("int").alias("part"), "sensor", F.lit(-1).alias("point"), "timestamp", "raw")
    saved = presses.where(F.col("point").isin(ZERO, ONE_KG) & F.col("sensor").isNotNull()).select(
        bucket.alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"), "sensor",
        (F.col("point") == ONE_KG).cast("int").alias("point"), "timestamp", "raw")
    both = (rows.unionByName(saved).where(F.col("timestamp").isNotNull()).withWatermark("timestamp", watermark)
            .select("bucket", "part", "sensor", "point", "timestamp", "raw", micros))
    found = both.groupBy("bucket", "part").applyInPandasWithState(
        _as_of_watermark, _FOUND, _HELD, "append", GroupStateTimeout.EventTimeTimeout)
    return found.withColumn("grams", X.calibrate(F.col("raw"), F.col("zero"), F.col("one_kg")))
