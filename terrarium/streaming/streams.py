"""Structured Streaming queries over the topic log.

Sinks use ``foreachBatch`` and publish each micro-batch as an append of its own
(``FileLog.write_stream_batch``).  A batch replayed after a failure finds its
append published and writes nothing, so together with the checkpoint every
record is in the log once, and a tail is served it once.  File sinks refuse
update mode, which is why update-mode rollups are written as keyed change logs
this way (K2) and read back compacted (K5).
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from terrarium.functions import expr as X
from terrarium.operators.rollup import window_col
from terrarium.schema import EXTENDED
from terrarium.session import ensure_utc
from terrarium.sources.log import FileLog, decode

WATERMARK = "10 minutes"  # fixed value: the reference's watermark delay
RAW_TRIGGER = "1 minute"  # fixed value: the reference's raw-stream trigger


def readings_stream(log: FileLog, topic: str = "readings", schema: StructType = EXTENDED,
                    watermark: str | None = WATERMARK, **source_opts) -> DataFrame:
    """Decoded readings of ``topic`` as a stream, event time as
    TIMESTAMP (UTC) with the watermark set (N6: NTZ cannot carry one).
    Malformed values parse to nothing and are skipped (P20)."""
    ensure_utc(log.spark)
    good, _ = decode(log.scan(topic, batch=False, **source_opts), schema=schema, ntz=False)
    return good.withWatermark("timestamp", watermark) if watermark else good


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def reset_if_new(log: FileLog, topics: Sequence[str], checkpoint: str) -> bool:
    """K6: a stream without a checkpoint starts afresh: its old output topics
    are dropped first.  Returns whether a reset happened."""
    jvm, fs = log._fs()
    if fs.exists(jvm.org.apache.hadoop.fs.Path(checkpoint)):
        return False
    log.reset(topics)
    return True


def start_raw(df: DataFrame, out: FileLog, topic: str, checkpoint: str,
              trigger: dict | None = None,
              time_text: Column | None = None, query_name: str | None = None) -> StreamingQuery:
    """K1: append every row of a stream to ``topic`` as JSON (time as
    ``yyyy-MM-dd HH:mm:ss Z``), unkeyed.  Aggregated streams must be in a
    form append mode accepts (closed windows only)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out.write_stream_batch(topic, batch, checkpoint, batch_id, time_text=time_text)

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w.outputMode("append"), trigger).start()


def windowed(df: DataFrame, values: Sequence[str], keys: Sequence[str], width: str,
             label: str = "start", ts: str = "timestamp", start_offset: str | None = None,
             shift: str | None = None) -> DataFrame:
    """A2/T2 over a stream: group on the window *struct* (N16: grouping on a
    field of it loses the watermark), then project the label."""
    g = df.groupBy(window_col(ts, width, start_offset).alias("w"), *keys).agg(
        *[F.avg(v).alias(v) for v in values])
    t = F.col(f"w.{label}")
    if shift:
        t = t + F.expr(f"INTERVAL {shift}")
    return g.select(t.alias("timestamp"), *keys, *values)


def start_rollup(df: DataFrame, out: FileLog, topic: str, values: Sequence[str],
                 keys: Sequence[str], checkpoint: str, width: str = "10 minutes",
                 trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Update-mode rollup; each micro-batch's changed groups are
    appended to ``topic`` as keyed records (key = time + keys), so the
    compacted topic holds the current value of every window."""
    agg = windowed(df, values, keys, width)
    key_cols = ["timestamp", *keys]

    def write(batch: DataFrame, batch_id: int) -> None:
        out.write_stream_batch(topic, batch, checkpoint, batch_id, key_cols=key_cols)

    w = agg.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w.outputMode("update"), trigger).start()


def rollup_of_windows(inner: DataFrame, values: Sequence[str], keys: Sequence[str],
                      inner_width: str, outer_width: str = "10 minutes") -> DataFrame:
    """Roll up rows already labelled by a window *end* into outer
    start-labelled windows, in a form streaming accepts.

    ``inner`` carries ``timestamp`` = ``window_time`` of its window (end - 1
    microsecond), which keeps the watermark.  Outer windows are shifted back
    by one microsecond (start offset = outer - 1 µs), so the end time e lands
    in the bucket [m*outer, (m+1)*outer) exactly when e does, and 1 µs is
    added back to the start.  Final values only (append mode), never partial
    updates (N5)."""
    micros = _micros(outer_width)
    return windowed(inner, values, keys, outer_width,
                    start_offset=f"{micros - 1} microseconds", shift="1 microsecond")


def _micros(width: str) -> int:
    return int(X.age_delta(width).total_seconds() * 1_000_000)


def start_appended_rollup(agg: DataFrame, out: FileLog, topic: str, keys: Sequence[str],
                          checkpoint: str, trigger: dict | None = None,
                          query_name: str | None = None) -> StreamingQuery:
    """K2 for chained rollups: closed windows only (append mode), still
    written as keyed records so the topic reads like any rollup topic."""
    key_cols = ["timestamp", *keys]

    def write(batch: DataFrame, batch_id: int) -> None:
        out.write_stream_batch(topic, batch, checkpoint, batch_id, key_cols=key_cols)

    w = agg.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w.outputMode("append"), trigger).start()


def next_version(spark: SparkSession, path: str, version: int, more: DataFrame,
                 merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Version ``version`` of a dimension table that grows with a
    stream: the version before it merged with ``more``, written under ``path``.

    Versions are numbered like the micro-batches they belong to.  A replayed
    micro-batch writes its version again from the same two parts, and no other
    micro-batch reads it before, so nothing has to be locked or noted.  Work
    grows with the micro-batch and the table, not with the history; versions
    that no replay can ask for are dropped."""
    own = f"{path}/version={version}"
    table = more
    if version:
        table = merge(spark.read.schema(more.schema).parquet(f"{path}/version={version - 1}"), more)
    table.write.mode("overwrite").parquet(own)
    if version > 1:
        jvm = spark.sparkContext._jvm
        old = jvm.org.apache.hadoop.fs.Path(f"{path}/version={version - 2}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(more.schema).parquet(own)


@contextlib.contextmanager
def pool(spark: SparkSession, name: str):
    """Queries started inside run their jobs in the scheduler pool ``name``."""
    sc = spark.sparkContext
    old = sc.getLocalProperty("spark.scheduler.pool")
    sc.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.scheduler.pool", old)


class _Ends(StreamingQueryListener):
    """Wakes its owner when one of the queries with ``ids`` ends."""

    def __init__(self, ids: set[str]):
        self.ids, self.seen = ids, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self.ids:
            self.seen.set()


def await_any(spark: SparkSession, queries: Sequence[StreamingQuery],
              timeout: float | None = None) -> dict[str, str | None]:
    """Wait until one of ``queries`` ends, or for ``timeout`` seconds: the
    ids of those that have ended, each with its error (None: without one)."""
    listener = _Ends({q.id for q in queries})
    spark.streams.addListener(listener)
    try:
        if queries and all(q.isActive for q in queries):
            listener.seen.wait(timeout)
        return {q.id: str(q.exception()) if q.exception() is not None else None for q in queries if not q.isActive}
    finally:
        spark.streams.removeListener(listener)


def start_series(df: DataFrame, out: FileLog, topic: str, series: str, y: str, order: str,
                 checkpoint: str, width: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """T11 for streams: points of a series that fall on one time (``width``
    wide) replace each other, the newest by ``order`` stays.  Written as a
    keyed change log in update mode; state is held until the watermark has
    passed a point's time."""
    newest = df.groupBy(window_col("timestamp", width).alias("w"), F.col(series).alias("series")).agg(
        F.max_by(y, order).alias("y"), F.max(order).alias(order))
    points = newest.select(F.col("w.start").alias("timestamp"), "series", "y", order)

    def write(batch: DataFrame, batch_id: int) -> None:
        out.write_stream_batch(topic, batch, checkpoint, batch_id, key_cols=["timestamp", "series"])

    w = points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("update"), trigger).start()


def start_decoded(log: FileLog, topic: str, out: FileLog, good_topic: str, corrupt_topic: str, checkpoint: str,
                  schema: StructType = EXTENDED, trigger: dict | None = None,
                  on_counts: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """P20: one scan of ``topic`` with two outputs: readings that decode, and
    the records that do not, as they came, in a topic of their own.  The
    numbers of both are counted on the way (``Observation``) and handed to
    ``on_counts`` with the micro-batch's id."""
    stream = log.scan(topic, batch=False)

    def write(batch: DataFrame, batch_id: int) -> None:
        records = batch.withColumnRenamed("timestamp", "logged").persist()
        try:
            good, corrupt = decode(records, schema=schema, keep=("topic", "partition", "offset", "logged"))
            counts = {}
            for name, rows, to in (("good", good.select([f.name for f in schema.fields]), good_topic),
                                   ("corrupt", corrupt, corrupt_topic)):
                seen = Observation()
                if out.write_stream_batch(to, rows.observe(seen, F.count(F.lit(1)).alias("n")), checkpoint, batch_id):
                    counts[name] = seen.get["n"]     # an output published before a failure is not counted again
            if on_counts is not None:
                on_counts(batch_id, counts)
        finally:
            records.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("append"), trigger).start()


def state_rows(spark: SparkSession, checkpoint: str, operator: int, fields: str) -> DataFrame:
    """The state that a stateful operator of a query held after its last
    micro-batch, from the query's checkpoint: the key columns, and the
    aggregation buffers renamed to ``fields`` (``name type`` pairs, in order)."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("key.*", F.col("value").cast(f"struct<{fields}>").alias("value")).select("*", "value.*").drop("value")


def _averages(values: Sequence[str]) -> str:
    return ", ".join(f"sum_{v}: double, count_{v}: bigint" for v in values)


def _averaged(sums: DataFrame, values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return sums.select("timestamp", *keys, *[F.try_divide(f"sum_{v}", f"count_{v}").alias(v) for v in values])


def open_windows(spark: SparkSession, checkpoint: str, values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """T5: the windows of an update-mode rollup that its watermark has not
    passed, as they are now."""
    held = state_rows(spark, checkpoint, 0, _averages(values))
    return _averaged(held.withColumn("timestamp", F.col("window.start")), values, keys)


def open_chained_windows(spark: SparkSession, checkpoint: str, values: Sequence[str], keys: Sequence[str],
                         inner_fields: str, inner_rows: Callable[[DataFrame], DataFrame],
                         width: str = "10 minutes") -> DataFrame:
    """T4: the windows of a chained rollup that append mode has not emitted,
    as they would be if the stream ended here.

    The outer operator's state holds the sums of inner windows that are
    closed; ``inner_rows`` turns the inner operator's buffers
    (``inner_fields``) into rows like those the stream emits, labelled by
    their window's end.  Rows that came too late are in neither state."""
    outer = state_rows(spark, checkpoint, 0, _averages(values)).withColumn(
        "timestamp", F.col("window.start") + F.expr("INTERVAL 1 MICROSECOND")).drop("window")
    inner = inner_rows(state_rows(spark, checkpoint, 1, inner_fields))
    added = inner.select(window_col("timestamp", width).start.alias("timestamp"), *keys, *[
        c for v in values for c in (F.col(v).alias(f"sum_{v}"), F.col(v).isNotNull().cast("long").alias(f"count_{v}"))])
    sums = [f(f"{p}_{v}").alias(f"{p}_{v}") for v in values for p, f in (("sum", F.sum), ("count", F.sum))]
    return _averaged(outer.unionByName(added).groupBy("timestamp", *keys).agg(*sums), values, keys)


def current(closed: DataFrame, opened: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All windows of a rollup: the ones still open from state, the others as
    they were written."""
    now = opened.select(*[F.col(c).cast(closed.schema[c].dataType).alias(c) for c in closed.columns])
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}")) for k in ("timestamp", *keys)]
    return closed.alias("c").join(now.alias("o"), same, "left_anti").unionByName(now)


def tail(log: FileLog, topics: str | Sequence[str], on_batch: Callable[[DataFrame, int], None],
         checkpoint: str, snapshot: Callable[[DataFrame], None] | None = None, whole: bool = False,
         trigger: dict | None = None, **source_opts) -> StreamingQuery:
    """What the log holds when the tail first starts goes to
    ``snapshot``, everything that is appended later to ``on_batch``.

    Both are micro-batches of one query, so its checkpoint is the hand-off: no
    record is served twice or missed, over any number of topics and restarts.
    Without ``snapshot`` this is a tail from the latest record: the first
    micro-batch is only noted, none of its files is opened.  ``whole`` serves
    the first micro-batch to ``on_batch`` like any other."""
    if {"maxfilespertrigger", "maxbytespertrigger"} & {k.lower() for k in source_opts}:
        raise ValueError("the first micro-batch has to hold the whole snapshot")
    held = whole or not _held_at_start(log, topics, checkpoint)

    def serve(batch: DataFrame, batch_id: int) -> None:
        if batch_id or held:
            on_batch(batch, batch_id)
        elif snapshot is not None:
            snapshot(batch)

    df = log.scan(topics, batch=False, **source_opts)
    w = df.writeStream.foreachBatch(serve).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("append"), trigger).start()


def _held_at_start(log: FileLog, topics: str | Sequence[str], checkpoint: str) -> bool:
    """Whether the log held anything when the tail first started: a log that
    was empty has no snapshot, and its first micro-batch is news.  Noted beside
    the checkpoint, so a restart before the first micro-batch goes the same
    way."""
    jvm, fs = log._fs()
    path = jvm.org.apache.hadoop.fs.Path
    for name in ("held", "empty"):
        if fs.exists(path(f"{checkpoint}-start/{name}")):
            return name == "held"
    held = log.holds(topics)
    fs.create(path(f"{checkpoint}-start/{'held' if held else 'empty'}"), True).close()
    return held
