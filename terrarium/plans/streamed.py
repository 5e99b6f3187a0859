"""Named streaming queries: each runs Structured Streaming over a file log
made from ``events`` and returns the batch read of what the stream wrote.

The input grows as a live log does: ``APPENDS`` appends, contiguous
``event_id`` ranges in order, and after each one the stream goes on from its
checkpoint with ``availableNow``, so a micro-batch is one append however many
files and writers it has, and every query restarts from its checkpoint.
Folders come from ``session.shared_dir`` (``spark.checkpoint.dir``), one fresh
set per call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from terrarium.operators import calibrate, derive
from terrarium.plans import fixture as FX
from terrarium.plans.named import rounded
from terrarium.plans.registry import Context, default_registry
from terrarium.schema import EXTENDED, LOG
from terrarium.session import conf_scope, ensure_utc, shared_dir
from terrarium.sources.events import (burst_arrays_from_events, calibrations_from_events, load, payloads_from_events,
                                      readings_from_events)
from terrarium.sources.log import FileLog, compacted, decode
from terrarium.streaming import streams

APPENDS = 4
TAIL_SPLIT = "2024-01-15 00:00:00"
AVAILABLE_NOW = {"availableNow": True}


def _micro_text(ts: str = "timestamp"):
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" -0000"))


def append_readings(log: FileLog, events: DataFrame, topic: str = "readings") -> None:
    """Append the readings of ``events``, one writer for each scan task."""
    chunk = readings_from_events(events, keep=("user_id",))
    log.append(topic, chunk, value_cols=[c for c in chunk.columns if c != "user_id"],
               position=F.col("event_id"), log_time=F.col("timestamp"), time_text=_micro_text())


def pieces(events: DataFrame, n: int = APPENDS) -> list[DataFrame]:
    """``events`` cut at ``n`` - 1 ids; every row is in one piece, rows
    without an id in the first.  The cuts are pushed down to the scan."""
    lo, hi = events.agg(F.min("event_id"), F.max("event_id")).first()
    if lo is None:
        return [events]
    cuts = [lo + (hi - lo + 1) * i // n for i in range(1, n)]
    eid = F.col("event_id")
    out = [events.where((eid < cuts[0]) | eid.isNull())]
    for a, b in zip(cuts, cuts[1:]):
        out.append(events.where((eid >= a) & (eid < b)))
    return [*out, events.where(eid >= cuts[-1])]


def _setup(spark: SparkSession, sf_dir: str, tag: str):
    """(root, input log, its pieces, output log, registry, context)."""
    ensure_utc(spark)
    root = shared_dir(spark, "streams", tag, unique=True)
    events = load(spark, sf_dir, "events")
    src, out = FileLog(spark, f"{root}/in"), FileLog(spark, f"{root}/out")
    reg = default_registry(lo=FX.LO, hi=FX.HI, max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                           retires=FX.RETIRES)

    def ranges_snapshot():
        """A table, written once: its measured size decides the join."""
        w = reg.datasets["weights"].fn(Context(spark, lambda: readings_from_events(events)))
        derive.ranges(w).write.parquet(f"{root}/ranges")
        return spark.read.parquet(f"{root}/ranges")

    ctx = Context(spark, lambda: streams.readings_stream(src), ranges_snapshot, streaming=True)
    return root, src, pieces(events), out, reg, ctx


def _follow(src: FileLog, chunks: list[DataFrame], start) -> None:
    """Append piece after piece and let the queries of ``start`` catch up."""
    for chunk in chunks:
        append_readings(src, chunk)
        _run(start())


def _parallelism(spark: SparkSession) -> int:
    """State partitions for these runs: one per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def _run(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:  # pragma: no cover - surfaced to caller
            raise RuntimeError(str(q.exception()))


def _rollup_values(out: FileLog, topic: str, keys, values) -> DataFrame:
    recs = compacted(out, topic)
    good, _ = decode(recs.select("topic", "partition", "offset", "value"),
                     schema=_schema(["timestamp", *keys, *values]), ntz=True)
    return rounded(good.select("timestamp", *keys, *values))


def _schema(cols):
    return StructType([StructField(c, DoubleType() if c not in ("timestamp", "sensor")
                                   else StringType()) for c in cols])


def q_stream_raw_weights(spark, sf_dir):
    """The raw weights stream, read back from its topic.  The
    sink writes whole-second time text, as the reference's sink does."""
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, "raw")
    _follow(src, chunks, lambda: reg.start(
        ctx, out, f"{root}/cp", names=["weights"], which=["raw"], raw_trigger=AVAILABLE_NOW,
        state_partitions=_parallelism(spark)))
    good, _ = decode(out.scan("weights"), schema=EXTENDED, ntz=True)
    return good.select("event_id", "timestamp", "sensor", "grams", "stddev")


def _rollup(spark, sf_dir, name: str, values, keys=("sensor",)):
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, f"{name}-rollup")
    _follow(src, chunks, lambda: reg.start(
        ctx, out, f"{root}/cp", names=[name], which=["rollup"], rollup_trigger=AVAILABLE_NOW,
        state_partitions=_parallelism(spark)))
    return f"{root}/cp/{name}-10min", _rollup_values(out, f"{name}-10min", list(keys), list(values))


def q_stream_weights_10min(spark, sf_dir):
    """Update-mode rollup as a keyed change log, compacted."""
    return _rollup(spark, sf_dir, "weights", ["grams", "stddev"])[1]


def q_stream_water_10min(spark, sf_dir):
    """The rollup of a stream joined with the ranges table."""
    return _rollup(spark, sf_dir, "water", ["water"])[1]


def q_stream_temperatures_10min(spark, sf_dir):
    """Q6/Q7: the rollup of the temperatures."""
    return _rollup(spark, sf_dir, "temperatures", ["temperature_f"])[1]


def q_stream_evaporation_10min(spark, sf_dir):
    """Evaporation windows rolled up again, in append mode, and the
    windows that the query's state still holds open."""
    checkpoint, closed = _rollup(spark, sf_dir, "evaporation", ["ml_hour"])
    opened = streams.open_chained_windows(spark, checkpoint, ["ml_hour"], ["sensor"], derive.LOSS_STATE,
                                          derive.loss_of_state)
    return streams.current(closed, rounded(opened), ["sensor"])


def q_stream_current_10min(spark, sf_dir):
    """K2/T5: an update-mode rollup as a page would show it now: open windows
    from the running query's state, the others from the change log."""
    checkpoint, written = _rollup(spark, sf_dir, "weights", ["grams", "stddev"])
    opened = streams.open_windows(spark, checkpoint, ["grams", "stddev"], ["sensor"])
    # state goes with its checkpoint: its rows are few (the open windows)
    return streams.current(written, rounded(opened), ["sensor"])


def q_stream_latest_point(spark, sf_dir):
    """A live series in which a later point of the same hour replaces an
    earlier one, over four appends."""
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, "series")
    weights = reg.datasets["weights"].fn

    def start():
        with conf_scope(spark, {"spark.sql.shuffle.partitions": _parallelism(spark)}):
            return [streams.start_series(weights(ctx), out, "points", "sensor", "grams", "event_id", f"{root}/cp",
                                         trigger=AVAILABLE_NOW)]

    _follow(src, chunks, start)
    good, _ = decode(compacted(out, "points").select("topic", "partition", "offset", "value"), schema=StructType([
        StructField("timestamp", StringType()), StructField("series", StringType()),
        StructField("y", DoubleType()), StructField("event_id", LongType())]), ntz=True)
    return good.select("series", F.col("timestamp").alias("x"), "y", "event_id")


def q_stream_growing_10min(spark, sf_dir):
    """Water of each append above the minimum as known by then, rolled
    up; no snapshot of the ranges is taken, sensors get theirs as they come."""
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, "growing")
    ctx.ranges = None

    def start(which):
        return reg.start(ctx, out, f"{root}/cp", names=["water"], which=[which], raw_trigger=AVAILABLE_NOW,
                         rollup_trigger=AVAILABLE_NOW, state_partitions=_parallelism(spark),
                         growing=lambda c: derive.ranges(reg.datasets["weights"].fn(c)))

    for chunk in chunks:
        append_readings(src, chunk)
        for which in ("raw", "rollup"):
            _run(start(which))
    return _rollup_values(out, "water-10min", ["sensor"], ["water"])


BURST = StructType([StructField("timestamp", StringType()), StructField("sensor", StringType()),
                    StructField("samples", ArrayType(DoubleType()))])
PRESS = StructType([StructField("timestamp", StringType()), StructField("sensor", StringType()),
                    StructField("point", StringType()), StructField("raw", DoubleType())])
FOUND = StructType([StructField("timestamp", StringType()), StructField("sensor", StringType())]
                   + [StructField(c, DoubleType()) for c in ("raw", "zero", "one_kg", "grams")])


def q_stream_calibrated(spark, sf_dir):
    """Bursts and calibration presses as two topics, calibrated
    while they grow over four appends: the readings the watermark has passed."""
    ensure_utc(spark)
    root = shared_dir(spark, "streams", "calibrated", unique=True)
    src, out = FileLog(spark, f"{root}/in"), FileLog(spark, f"{root}/out")

    def start():
        bursts = streams.readings_stream(src, "bursts", BURST, watermark=None)
        raw = calibrate.burst_stats_array(F.col("samples"))[1]
        presses = streams.readings_stream(src, "presses", PRESS, watermark=None)
        with conf_scope(spark, {"spark.sql.shuffle.partitions": _parallelism(spark)}):
            return streams.start_raw(calibrate.calibrated_stream(bursts.withColumn("raw", raw), presses), out,
                                     "calibrated", f"{root}/cp", trigger=AVAILABLE_NOW, time_text=_micro_text())

    for chunk in pieces(load(spark, sf_dir, "events")):
        for topic, rows in (("bursts", burst_arrays_from_events(chunk)),
                            ("presses", calibrations_from_events(chunk).withColumnRenamed("ts", "timestamp"))):
            src.append(topic, rows, log_time=F.col("timestamp"), time_text=_micro_text())
        _run([start()])
    good, _ = decode(out.scan("calibrated"), schema=FOUND, ntz=True)
    return rounded(good.select("sensor", "timestamp", "raw", "zero", "one_kg", "grams"))


def q_stream_dead_letters(spark, sf_dir):
    """P20: the device bodies as a topic, decoded by a stream in four appends;
    what does not decode is kept, as it came, beside the readings."""
    ensure_utc(spark)
    root = shared_dir(spark, "streams", "dead", unique=True)
    src, out = FileLog(spark, f"{root}/in"), FileLog(spark, f"{root}/out")
    for chunk in pieces(load(spark, sf_dir, "events")):
        bodies = payloads_from_events(chunk, FX.SIGNING_KEY, FX.WRONG_KEY)
        src.append_records(bodies.select(
            F.lit(None).cast("binary").alias("key"), F.encode("body", "UTF-8").alias("value"), F.lit("bodies").alias("topic"),
            F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
            F.lit("2024-01-01").cast("timestamp").alias("timestamp")), topic="bodies")
        _run([streams.start_decoded(src, "bodies", out, "decoded", "corrupt", f"{root}/cp", trigger=AVAILABLE_NOW)])
    text = F.col("value").cast("string")
    dead = out.scan("corrupt").select(F.lit("corrupt").alias("output"),
                                      F.get_json_object(text, "$.offset").cast("long").alias("event_id"),
                                      F.get_json_object(text, "$.value").alias("body"), F.lit(1).cast("long").alias("n"))
    fine = out.scan("decoded").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("decoded").alias("output"), F.lit(None).cast("long").alias("event_id"),
        F.lit(None).cast("string").alias("body"), "n")
    return dead.unionByName(fine)


def q_stream_late_10min(spark, sf_dir):
    """Rows that come after the watermark has passed their window do not
    change it.  Every hundredth row of the first append comes with the third."""
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, "late")
    if len(chunks) > 2:
        late = F.coalesce(F.col("event_id") % 100 == 7, F.lit(False))
        chunks[2] = chunks[2].unionByName(chunks[0].where(late))
        chunks[0] = chunks[0].where(~late)
    _follow(src, chunks, lambda: reg.start(
        ctx, out, f"{root}/cp", names=["weights"], which=["rollup"], rollup_trigger=AVAILABLE_NOW,
        state_partitions=_parallelism(spark)))
    return _rollup_values(out, "weights-10min", ["sensor"], ["grams", "stddev"])


def _tailed(spark, sf_dir, tag: str, snapshot: bool):
    """The readings of two appends, followed by a tail that starts between
    them and is restarted: (those of its snapshot, those delivered)."""
    ensure_utc(spark)
    root = shared_dir(spark, "streams", tag, unique=True)
    log = FileLog(spark, f"{root}/log")
    events = load(spark, sf_dir, "events")
    early = F.coalesce(F.col("ts") < F.lit(TAIL_SPLIT).cast("timestamp_ntz"), F.lit(False))

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/delivered/batch_id={batch_id}")

    def keep(batch: DataFrame) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/snapshot")

    for part in (early, ~early):
        append_readings(log, events.where(part))
        _run([streams.tail(log, "readings", deliver, f"{root}/cp", snapshot=keep if snapshot else None,
                           trigger=AVAILABLE_NOW)])

    def rows(folder: str) -> DataFrame:
        good, _ = decode(spark.read.schema(LOG).parquet(f"{root}/{folder}"), schema=EXTENDED, ntz=True)
        return good.select("event_id", "timestamp", "sensor", "grams")

    return rows("snapshot") if snapshot else None, rows("delivered")


def q_stream_tail(spark, sf_dir):
    """A snapshot of the first append, and a tail that goes on
    from it over a restart: each reading is in one of them, once."""
    snapshot, delivered = _tailed(spark, sf_dir, "tail", snapshot=True)
    return (snapshot.withColumn("served", F.lit("snapshot"))
            .unionByName(delivered.withColumn("served", F.lit("tail"))))


def q_stream_tail_latest(spark, sf_dir):
    """A tail from the latest record, started after the first append; it
    opens none of the older files and delivers what comes later, over a
    restart."""
    return _tailed(spark, sf_dir, "latest", snapshot=False)[1]


def q_stream_fresh_start(spark, sf_dir):
    """K6: the raw weights stream run twice into the same topic; the second
    run has no checkpoint, so it first drops the old output.  The topic then
    holds one copy of the stream."""
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, "fresh")

    def start(checkpoint):
        return reg.start(ctx, out, f"{root}/{checkpoint}", names=["weights"], which=["raw"],
                         raw_trigger=AVAILABLE_NOW)

    _follow(src, chunks, lambda: start("cp1"))
    _run(start("cp2"))
    good, _ = decode(out.scan("weights"), schema=EXTENDED, ntz=True)
    return good.select("event_id", "timestamp", "sensor", "grams", "stddev")


def q_stream_shared_raw(spark, sf_dir):
    """K8 for streams: one readings scan feeds weights, water, water_rel and
    temperatures; the water topic is read back."""
    root, src, chunks, out, reg, ctx = _setup(spark, sf_dir, "shared")
    _follow(src, chunks, lambda: [reg.start_shared_raw(ctx, out, f"{root}/cp", trigger=AVAILABLE_NOW)])
    schema = StructType(EXTENDED.fields + [StructField(c, DoubleType())
                                           for c in ("min", "max", "water")])
    good, _ = decode(out.scan("water"), schema=schema, ntz=True)
    return rounded(good.select("event_id", "timestamp", "sensor", "grams", "min", "max", "water"))


QUERIES = {
    "stream_raw_weights": q_stream_raw_weights,
    "stream_weights_10min": q_stream_weights_10min,
    "stream_water_10min": q_stream_water_10min,
    "stream_temperatures_10min": q_stream_temperatures_10min,
    "stream_evaporation_10min": q_stream_evaporation_10min,
    "stream_current_10min": q_stream_current_10min,
    "stream_latest_point": q_stream_latest_point,
    "stream_growing_10min": q_stream_growing_10min,
    "stream_calibrated": q_stream_calibrated,
    "stream_dead_letters": q_stream_dead_letters,
    "stream_late_10min": q_stream_late_10min,
    "stream_tail": q_stream_tail,
    "stream_tail_latest": q_stream_tail_latest,
    "stream_fresh_start": q_stream_fresh_start,
    "stream_shared_raw": q_stream_shared_raw,
}
