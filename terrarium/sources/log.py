"""The topic log (D1): scans, decode, appends, keyed change logs.

A log is a folder of Parquet files with the LOG columns, laid out as
``topic=<t>/append=<name>/date=<d>``, with dates of the log time.  Every append
(a batch write or a stream's micro-batch) is an ordinary Spark write to a
staging folder, which one rename publishes whole: readers and streams see all
of an append or nothing, however long it took to write, and there is nothing
to claim, list or wait for.  A batch append has a fresh name; the name of a
micro-batch follows from its stream's checkpoint and its number, so a replay
after a failure finds it published and writes nothing.

A record's position is ``(topic, partition, offset)``.  Offsets are given by
the caller (a column that rises in the log's order), or number the rows of an
append above those of the stream's earlier micro-batches; records of several
writers are in the order of their log time, then of their offset.

Scans open only the folders of their topics, prune by date, and, as files are
sorted by time, by the row groups' times inside a day.  A Kafka-backed reader
and writer with the same scans is at the end; it needs the connector jar,
absent here (N14).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from terrarium.functions import expr as X
from terrarium.schema import LOG, READING
from terrarium.session import conf_scope


CORRUPT = "_corrupt_record"
_STORED = StructType(LOG.fields + [StructField("append", StringType()), StructField("date", DateType())])
#: Row groups are small enough that a few hours of a day are a few of them,
#: and times are written with statistics.
ROW_GROUP_BYTES = 16 << 20
_WRITE = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def _json(cols: Sequence[str], time_text: Column | None = None) -> Column:
    """JSON text of ``cols`` (nulls omitted), ``timestamp`` written as text:
    ``time_text`` when given, else ``yyyy-MM-dd HH:mm:ss Z``."""
    ts = time_text if time_text is not None else X.format_ts(F.col("timestamp"))
    return F.to_json(F.struct(*[(ts.alias("timestamp") if c == "timestamp" else F.col(c))
                                for c in cols]))


def decode(records: DataFrame, schema: StructType = READING, ntz: bool = False,
           keep: Sequence[str] = ("topic", "partition", "offset")) -> tuple[DataFrame, DataFrame]:
    """Bytes -> text -> struct -> columns.

    Returns (good, corrupt).  Parsing is permissive: a value that is not a
    JSON object goes to ``corrupt`` with its raw text instead of stopping
    the batch, while a wrong-typed field only nulls that field.
    ``timestamp`` is parsed from its text (F3).

    Each value is parsed once: the task's number makes the parse
    nondeterministic to the optimizer, which then does not copy it into the
    tests for corrupt values below (streams allow no row number here).
    """
    text = F.col("value").cast("string")
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    parse = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = records.select(*keep, text.alias("_raw"), F.when(F.spark_partition_id() >= 0, parse).alias("_j"))
    # Only text that is not a JSON object is corrupt.  A wrong-typed field
    # (a fractional `lux` for a long) nulls that field and keeps the rest
    # (N15); the syntax check runs only for rows the parser flagged.
    flagged = F.col(f"_j.{CORRUPT}").isNotNull()
    bad = F.col("_j").isNull() | (flagged & F.json_object_keys(F.col("_raw")).isNull())
    corrupt = parsed.where(bad).select(*keep, F.col("_raw").alias("value"))
    good = (parsed.where(~bad)
            .select(*keep, *[F.col("_j").getField(f.name).alias(f.name) for f in schema.fields])
            .withColumn("timestamp", X.parse_ts(F.col("timestamp"), ntz=ntz)))
    return good, corrupt


class FileLog:
    """A topic log stored as Parquet under ``path`` (partitioned by topic)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(conf)

    def _folder(self, topic: str) -> str:
        return f"{self.path}/topic={topic}"

    # -- scans ------------------------------------------------------------
    def scan(self, topics: str | Sequence[str], batch: bool = True,
             since: _dt.datetime | Column | None = None, **stream_opts) -> DataFrame:
        """Records of ``topics`` (comma text or list), whole or
        from log time ``since`` on.  ``batch=False`` gives the streaming scan
        of the same folders."""
        names = topic_names(topics)
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        if batch:
            there = [t for t in names if fs.exists(path(self._folder(t)))]
            df = (self.spark.read.schema(_STORED).option("basePath", self.path)
                  .parquet(*map(self._folder, there))) if there else self.spark.createDataFrame([], _STORED)
        else:
            for t in names:  # a stream may start before any data lands
                fs.mkdirs(path(self._folder(t)))
            reader = self.spark.readStream.schema(_STORED).option("basePath", self.path)
            for k, v in stream_opts.items():
                reader = reader.option(k, v)
            df = reader.parquet(f"{self.path}/topic={{{','.join(names)}}}")
        if since is not None:
            bound = since if isinstance(since, Column) else F.lit(since).cast("timestamp")
            df = df.where((F.col("date") >= F.to_date(bound)) & (F.col("timestamp") >= bound))
        return df.select(*[f.name for f in LOG.fields])

    def holds(self, topics: str | Sequence[str]) -> bool:
        """Whether anything has been appended to one of ``topics``."""
        jvm, fs = self._fs()
        return any(len(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self._folder(t)}/append=*")) or []) > 0
                   for t in topic_names(topics))

    # -- appends ----------------------------------------------------------
    def records(self, df: DataFrame, key_cols: Sequence[str] | None = None,
                value_cols: Sequence[str] | None = None, position: Column | None = None,
                partition: Column | None = None, log_time: Column | None = None,
                time_text: Column | None = None, first: int = 0) -> DataFrame:
        """LOG records (without topic) for one append of ``df``.

        Values (and keys, when ``key_cols`` is given) are JSON with the time
        as text.  The log partition is ``partition``, else the Spark
        partition; the offset is ``position``, else ``first`` plus the row's
        index in its Spark partition.  Neither costs a shuffle."""
        when = (log_time if log_time is not None else F.current_timestamp()).cast("timestamp")
        key = _json(key_cols, time_text).cast("binary") if key_cols else F.lit(None).cast("binary")
        own = F.spark_partition_id()
        index = F.monotonically_increasing_id() - own.cast("long") * F.lit(1 << 33)
        return df.select(
            key.alias("key"), F.encode(_json(list(value_cols or df.columns), time_text), "UTF-8").alias("value"),
            (own if partition is None else partition).cast("int").alias("partition"),
            (F.lit(first).cast("long") + index if position is None else position.cast("long")).alias("offset"),
            when.alias("timestamp"))

    def _publish(self, topic: str, records: DataFrame, name: str) -> bool:
        """Write ``records`` and make them the append ``name`` of ``topic``,
        unless it is there already.  Returns whether this call published it."""
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        target = path(f"{self._folder(topic)}/append={name}")
        if fs.exists(target):
            return False
        staging = f"{self.path}/_staging/{uuid.uuid4().hex}"
        # the session of a micro-batch is its query's own
        with conf_scope(records.sparkSession, _WRITE):
            (records.withColumn("date", F.to_date("timestamp")).sortWithinPartitions("date", "timestamp")
             .write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("date").parquet(staging))
        fs.mkdirs(target.getParent())
        try:
            # fails if another attempt of the same micro-batch was first
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.makeQualified(target).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            flags = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(fs.makeQualified(path(staging)), fs.makeQualified(target), flags)
        except Py4JJavaError:
            fs.delete(path(staging), True)
            if fs.exists(target):
                return False
            raise
        return True

    def append(self, topic: str, df: DataFrame, **opts) -> None:
        """K3: append a batch DataFrame to ``topic`` (options: ``records``)."""
        self._publish(topic, self.records(df, **opts), uuid.uuid4().hex)

    def append_records(self, records: DataFrame, topic: str) -> None:
        """Append already built LOG records of ``topic``."""
        self._publish(topic, records.drop("topic"), uuid.uuid4().hex)

    def write_stream_batch(self, topic: str, df: DataFrame, writer: str, micro_batch: int, **opts) -> bool:
        """K1/K2: one micro-batch of the stream with checkpoint ``writer``;
        a replayed one is left as it is (returns False)."""
        name = f"{hashlib.sha1(writer.encode()).hexdigest()}-{micro_batch}"
        return self._publish(topic, self.records(df, first=micro_batch << 33, **opts), name)

    def reset(self, topics: Sequence[str]) -> None:
        """K6: drop the records of ``topics`` (a stream starting afresh)."""
        jvm, fs = self._fs()
        for t in topics:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._folder(t)), True)


def topic_names(topics: str | Sequence[str]) -> list[str]:
    """topics as a list, from comma text or a list."""
    return [t.strip() for t in topics.split(",")] if isinstance(topics, str) else list(topics)


#: The order of the records of one key: by log time, then by offset.
LOG_ORDER = ["timestamp", "offset", "partition"]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key, newest by ``order`` (e.g. offset).

    ``max_by`` over the order columns is an algebraic aggregate, so each
    input partition first reduces its rows to one per key before the
    shuffle, and a hot key never gathers its rows in one task.  The carried
    columns may be of any type (maps, binary).
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_m"))
            .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest]))


def compacted(log: FileLog, topic: str) -> DataFrame:
    """K5: compacted view of a keyed topic: newest record per key."""
    recs = log.scan(topic).where(F.col("key").isNotNull())
    return latest_by_key(recs, ["topic", "key"], LOG_ORDER)


def to_records(df: DataFrame, topic: str, partition: Column, position: Column,
               log_time: Column, key_cols: Sequence[str] | None = None,
               value_cols: Sequence[str] | None = None,
               time_text: Column | None = None) -> DataFrame:
    """LOG records for ``df`` without writing them: value = JSON of
    ``value_cols`` (time as text, nulls omitted), key = JSON of ``key_cols``
    (None: unkeyed), offset = ``position``, which rises in the log's order.

    Keep one key in one partition (derive ``partition`` from the key) so the
    newest record of a key is the one with the largest offset.
    """
    key = _json(key_cols, time_text).cast("binary") if key_cols else F.lit(None).cast("binary")
    return df.select(key.alias("key"), F.encode(_json(list(value_cols or df.columns), time_text), "UTF-8").alias("value"),
                     F.lit(topic).alias("topic"), partition.cast("int").alias("partition"),
                     position.cast("long").alias("offset"), log_time.cast("timestamp").alias("timestamp"))


def topic(log: "FileLog | KafkaLog", name: str, schema: StructType = READING,
          batch: bool = False, watermark: str | None = "10 minutes", ntz: bool = False,
          **source_opts) -> DataFrame:
    """The reference's ``topic(t, batch)``: decoded records of one topic, event
    time parsed, watermark set on streams (N6: streams need TIMESTAMP)."""
    good, _ = decode(log.scan(name, batch=batch, **source_opts), schema=schema, ntz=ntz)
    return good.withWatermark("timestamp", watermark) if (watermark and not batch) else good


def in_log_order(df: DataFrame) -> DataFrame:
    """O1: records in log order (range-partitioned global sort)."""
    return df.orderBy("topic", "partition", "offset")


class KafkaLog:
    """Scans of a Kafka log and batch writes to it.

    A reader and writer of records, not a full ``FileLog``: resets and
    compaction are the broker's own.  Needs the Spark Kafka connector on the classpath (absent here, N14), so
    it is not exercised by the tests.  ``since`` maps to the connector's
    ``startingTimestamp`` (S4: seek by log time on every partition).
    """

    def __init__(self, spark: SparkSession, servers: str, options: dict | None = None):
        self.spark = spark
        self.servers = servers
        self.options = dict(options or {})

    def scan(self, topics: str | Sequence[str], batch: bool = True,
             since: _dt.datetime | Column | None = None, **stream_opts) -> DataFrame:
        names = topics if isinstance(topics, str) else ",".join(topics)
        reader = (self.spark.read if batch else self.spark.readStream).format("kafka")
        reader = reader.option("kafka.bootstrap.servers", self.servers).option("subscribe", names)
        if since is not None and not isinstance(since, Column):
            ms = int(since.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000) \
                if since.tzinfo is None else int(since.timestamp() * 1000)
            reader = reader.option("startingTimestamp", str(ms))
        else:
            reader = reader.option("startingOffsets", "earliest")
        reader = reader.option("failOnDataLoss", "false")
        for k, v in {**self.options, **stream_opts}.items():
            reader = reader.option(k, v)
        df = reader.load().select(*[f.name for f in LOG.fields])
        if isinstance(since, Column):
            df = df.where(F.col("timestamp") >= since)
        return df

    def append(self, topic: str, df: DataFrame, key_cols: Sequence[str] | None = None,
               value_cols: Sequence[str] | None = None, time_text: Column | None = None) -> None:
        """K1/K3: JSON values (and keys) produced to ``topic``; Kafka assigns
        partitions (by key) and offsets."""
        key = _json(key_cols, time_text) if key_cols else F.lit(None).cast("string")
        out = df.select(key.alias("key"), _json(list(value_cols or df.columns), time_text).alias("value"))
        (out.write.format("kafka").option("kafka.bootstrap.servers", self.servers)
         .option("topic", topic).save())
