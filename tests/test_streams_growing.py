"""Streams that learn while they run: ranges that grow, calibration presses,
and which of many queries has ended."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrarium.operators import calibrate, derive
from terrarium.plans import streamed
from terrarium.plans.registry import Context, Registry, default_registry
from terrarium.sources.log import FileLog, compacted, decode
from terrarium.streaming import streams

NOW = {"availableNow": True}
START = dt.datetime(2024, 1, 1)


def _readings(spark, rows):
    """Rows of (minute, sensor, grams) as readings."""
    return spark.createDataFrame([(START + dt.timedelta(minutes=m), "scale", float(g), 1.0, {"plant": s} if s else {})
                                  for m, s, g in rows],
                                 "timestamp timestamp, sensor string, grams double, stddev double, tags map<string,string>")


APPENDS = [[(0, "a", 100), (1, "a", 90), (2, None, 5)], [(20, "a", 80), (21, "a", 95)], [(40, "b", 50), (41, "b", 70), (42, "a", 85)]]


def test_ranges_grow_with_every_append(spark, tmp):
    src, out = FileLog(spark, f"{tmp}/in"), FileLog(spark, f"{tmp}/out")
    reg = default_registry(lo=0.0, hi=1e6, caps=(), retires=())
    ctx = Context(spark, lambda: streams.readings_stream(src), streaming=True)
    for rows in APPENDS:
        src.append("readings", _readings(spark, rows), log_time=F.col("timestamp"))
        for which in ("raw", "rollup"):
            for q in reg.start(ctx, out, f"{tmp}/cp", names=["water", "water_rel", "evaporation"], which=[which],
                               raw_trigger=NOW, rollup_trigger=NOW,
                               growing=lambda c: derive.ranges(reg.datasets["weights"].fn(c))):
                q.awaitTermination()
    good, _ = decode(out.scan("water"), schema=reg.datasets["water"].row_schema(), ntz=True)
    got = sorted((r.sensor, r.timestamp, r.water) for r in good.collect())
    at = lambda m: START + dt.timedelta(minutes=m)
    # each append against the minimum known with it; b, first seen in the third, has its rows
    assert got == [("a", at(0), 10.0), ("a", at(1), 0.0), ("a", at(20), 0.0), ("a", at(21), 15.0), ("a", at(42), 5.0),
                   ("b", at(40), 0.0), ("b", at(41), 20.0)]
    rolled, _ = decode(compacted(out, "water-10min"), schema=reg.datasets["water"].row_schema(), ntz=True)
    assert sorted((r.sensor, r.timestamp, r.water) for r in rolled.select("sensor", "timestamp", "water").collect()) == [
        ("a", at(0), 5.0), ("a", at(20), 7.5), ("a", at(40), 5.0), ("b", at(40), 10.0)]
    rel, _ = decode(out.scan("water_rel"), schema=reg.datasets["water_rel"].row_schema(), ntz=True)
    assert {(r.sensor, r.timestamp): r.water for r in rel.collect()}[("b", at(41))] == 1.0


def test_a_version_written_again_is_the_same(spark, tmp):
    def ranges(rows):
        return spark.createDataFrame(rows, "sensor string, min double, max double")

    path = f"{tmp}/ranges"
    parts = [ranges([("a", 1.0, 2.0)]), ranges([("b", 5.0, 5.0), ("a", 0.0, 1.0)]), ranges([])]
    for version in (0, 1, 1, 2, 2):                    # micro-batches 1 and 2 are replayed
        found = streams.next_version(spark, path, version, parts[version], derive.merged_ranges)
    assert sorted(map(tuple, found.collect())) == [("a", 0.0, 2.0), ("b", 5.0, 5.0)]


def test_names_the_failed_one_of_ten_queries(spark, tmp):
    src, out = FileLog(spark, f"{tmp}/in"), FileLog(spark, f"{tmp}/out")
    src.append("readings", _readings(spark, APPENDS[0]), log_time=F.col("timestamp"))
    reg = Registry()
    for i in range(10):
        @reg.stream(f"d{i}", values=["grams"], keys=["sensor"])
        def rows(ctx, i=i):
            broken = F.raise_error(F.lit("scale unplugged")).cast("double")
            return ctx.readings().withColumn("grams", broken if i == 7 else F.col("grams"))

    ctx = Context(spark, lambda: streams.readings_stream(src), streaming=True)
    queries = reg.start(ctx, out, f"{tmp}/cp", which=["raw"], raw_trigger={"processingTime": "1 second"})
    try:
        assert len(queries) == 10
        ended = reg.await_any(spark, timeout=120)
        assert list(ended) == ["d7"] and "scale unplugged" in ended["d7"]
        assert sum(q.isActive for q in queries) == 9
        assert reg.await_any(spark, timeout=0.2) == {}          # told once; the others go on
        queries[0].stop()
        assert reg.await_any(spark, timeout=60) == {"d0": None}
    finally:
        for q in queries:
            q.stop()
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_calibration_in_a_stream_equals_a_plain_lookup(spark, tmp):
    """Presses at equal times, without a value, before and at readings' times,
    late ones, unknown points; readings without a sensor; three appends."""
    rng = np.random.default_rng(7)
    src, out = FileLog(spark, f"{tmp}/in"), FileLog(spark, f"{tmp}/out")
    sensors = ["hot"] * 6 + ["cold", None]
    bursts, presses = [], []
    for part in range(3):
        minute = lambda: int(rng.integers(0, 300)) + 300 * part
        bursts.append([(START + dt.timedelta(minutes=minute()), sensors[rng.integers(8)], [float(i), float(i) + 2])
                       for i in range(120)])
        presses.append([(START + dt.timedelta(minutes=minute()), sensors[rng.integers(8)],
                         ["zero", "1kg", "other"][rng.integers(3)], None if i % 9 == 0 else float(rng.integers(50)))
                        for i in range(60)])
    last = START + dt.timedelta(minutes=1000)
    bursts[2].append((last, "hot", [1.0]))
    bursts[1].append((START, "hot", [-1.0]))                       # late: the watermark is past it
    presses[1].append((START, "cold", "zero", -1.0))

    def start():
        b = streams.readings_stream(src, "bursts", streamed.BURST, watermark=None)
        b = b.withColumn("raw", calibrate.burst_stats_array(F.col("samples"))[1])
        p = streams.readings_stream(src, "presses", streamed.PRESS, watermark=None)
        return streams.start_raw(calibrate.calibrated_stream(b, p), out, "calibrated", f"{tmp}/cp", trigger=NOW)

    for b, p in zip(bursts, presses):
        src.append("bursts", spark.createDataFrame(b, "timestamp timestamp, sensor string, samples array<double>"),
                   log_time=F.col("timestamp"))
        src.append("presses", spark.createDataFrame(p, "timestamp timestamp, sensor string, point string, raw double"),
                   log_time=F.col("timestamp"))
        start().awaitTermination()

    kept = [p for part in presses for p in part if p[3] != -1.0]

    def point(sensor, t, name):
        own = [(u, float("-inf") if v is None else v) for u, s, n, v in kept if s == sensor is not None and n == name and u <= t]
        v = max(own)[1] if own else float("-inf")
        return 1000.0 if v == float("-inf") else v

    want = []
    for t, s, samples in (b for part in bursts for b in part):
        if t < last and samples != [-1.0]:
            z, k, raw = point(s, t, "zero"), point(s, t, "1kg"), sum(samples) / len(samples)
            want.append((str(s), t, raw, z, k, None if z == k else (raw - z) * 1000 / (k - z)))
    good, _ = decode(out.scan("calibrated"), ntz=True, schema=streamed.FOUND)
    got = [(str(r.sensor), r.timestamp, r.raw, r.zero, r.one_kg, r.grams) for r in good.collect()]
    assert len(got) == len(want) == 360
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:5] == w[:5] and (g[5] is w[5] or g[5] == pytest.approx(w[5]))
