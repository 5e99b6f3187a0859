"""Serving views: time-bounded snapshot of topics, series, ranges, export
(Q9: S4, P13, P14, A6, U1; D11, O3, P19, A5, A8, T11; K7, F20).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrarium.functions import expr as X
from terrarium.sources.log import latest_by_key


def snapshot(records: DataFrame, topics: Sequence[str] | str | None = None,
             since: _dt.datetime | Column | None = None,
             shared_keys: bool = False) -> DataFrame:
    """Q9: the served history of ``topics`` from log records (LOG columns).

    S4 keeps records logged at or after ``since``; P13 drops values without
    a ``timestamp`` field; P14 keeps values whose own time (parsed leniently,
    honouring a zone offset) is strictly after ``since``; A6 keeps the newest
    record per key (per ``(topic, key)``, or per key across topics with
    ``shared_keys``, ordered by topic-list position then offset); U1 adds the
    unkeyed records.  Output: topic, partition, offset, key, value (text),
    timestamp (parsed).
    """
    names = ([t.strip() for t in topics.split(",")] if isinstance(topics, str)
             else list(topics) if topics is not None else None)
    df = records if names is None else records.where(F.col("topic").isin(names))
    if since is not None:
        bound = since if isinstance(since, Column) else F.lit(since).cast("timestamp")
        df = df.where(F.col("timestamp") >= bound)
    text = F.col("value").cast("string")
    df = df.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                   text.alias("value"),
                   X.parse_ts_any(F.get_json_object(text, "$.timestamp")).alias("_t"),
                   F.get_json_object(text, "$.timestamp").isNotNull().alias("_has_t"))
    df = df.where(F.col("_has_t"))
    if since is not None:
        df = df.where(bound < F.col("_t"))
    df = df.drop("_has_t").withColumnRenamed("_t", "timestamp")
    keyed = df.where(F.col("key").isNotNull())
    unkeyed = df.where(F.col("key").isNull())
    if shared_keys and names:
        order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("topic"))
        keyed = latest_by_key(keyed.withColumn("_topic_ord", order), ["key"],
                              ["_topic_ord", "offset"]).drop("_topic_ord")
    else:
        keyed = latest_by_key(keyed, ["topic", "key"], ["offset"])
    return keyed.unionByName(unkeyed)


def history(log, topics: str | Sequence[str], age: str,
            asof: _dt.datetime | Column | None = None, shared_keys: bool = False) -> DataFrame:
    """The served view of ``GET /stream?topics=&age=`` (Entry C): the
    snapshot of ``topics`` (comma text, F22) for the last ``age`` ("2 hours",
    F9) before ``asof`` (default: now).  The bound prunes the log scan."""
    now = F.current_timestamp() if asof is None else (
        asof if isinstance(asof, Column) else F.lit(asof).cast("timestamp"))
    bound = now - X.age_interval(age)
    return snapshot(log.scan(topics, since=bound), topics, since=bound, shared_keys=shared_keys)


def series_points(df: DataFrame, series: str, x: str, y: str,
                  only: str | None = None) -> DataFrame:
    """The points of each series, ordered by series then x.

    Returned as rows, not one array per series: a global range-partitioned
    sort splits a large series over many tasks, where collecting it into a
    single array would put the whole series in one row.
    """
    out = df.select(F.col(series).alias("series"), F.col(x).alias("x"), F.col(y).alias("y"))
    if only is not None:
        out = out.where(F.col("series") == F.lit(only))
    return out.where(F.col("x").isNotNull()).orderBy("series", "x")


def latest_point(df: DataFrame, series: str = "series", x: str = "x",
                 order: Sequence[str] = ("offset",)) -> DataFrame:
    """A new point with the same time as an existing one replaces it
    (newest by ``order`` wins), otherwise it is appended."""
    return latest_by_key(df, [series, x], list(order))


def series_distinct(df: DataFrame, series: str) -> DataFrame:
    """A5: the distinct series values (a partial-aggregated distinct)."""
    return df.select(F.col(series).alias("series")).distinct()


def y_range(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Plot range of ``y`` (optionally per group)."""
    aggs = [F.min(y).alias("min_y"), F.max(y).alias("max_y")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def export_rows(readings: DataFrame) -> DataFrame:
    """The four export columns ``timestamp, name, temp, humidity``;
    a missing humidity becomes the empty string."""
    return readings.select(
        F.col("timestamp").cast("string").alias("timestamp"),
        F.col("sensor").alias("name"),
        F.col("temperature_c").alias("temp"),
        F.coalesce(F.col("humidity").cast("string"), F.lit("")).alias("humidity"))


def write_export(rows: DataFrame, path: str) -> None:
    """K7: append the export rows as CSV."""
    rows.write.mode("append").option("header", "false").csv(path)


# Full microsecond precision: the JSON source's default formats stop at
# milliseconds and would silently truncate event times.
JSON_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_jsonl(df: DataFrame, path: str) -> None:
    """K4: append rows as JSON lines (times with microseconds)."""
    df.write.mode("append").options(**JSON_TIME_OPTIONS).json(path)


def read_jsonl(spark, path: str, schema) -> DataFrame:
    """Read JSON lines written by ``write_jsonl``."""
    return spark.read.schema(schema).options(**JSON_TIME_OPTIONS).json(path)


def fan_out(df: DataFrame, sinks) -> None:
    """K8: write one DataFrame to several sinks, computing it once."""
    df = df.persist()
    try:
        for sink in sinks:
            sink(df)
    finally:
        df.unpersist()
