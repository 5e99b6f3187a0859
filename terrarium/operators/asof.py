"""As-of lookup: for each left row, the latest right row at or before it.

Spark has no as-of join, and the usual window recipe (union both sides, then
``last(..., ignorenulls)`` over ``partitionBy(key).orderBy(ts)``) sends every
row of one key through a single task, which a hot device turns into one huge
sort.  Here time is cut into buckets, and the window runs within ``(key,
bucket)``, so a hot key spreads over its buckets and no left row is compared
with more than its neighbours in the sort.  What held before a bucket is
carried into it: right rows are first reduced to the last one of each (key,
bucket), and a prefix over these small rows finds the one that holds when a
bucket begins.  Only buckets that have left rows get a carried row, so a
right row that stays open for years costs nothing in between.

Each left row is shuffled once, however many right tables are looked up.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 3600


def _bucket(c: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str,
              right_ts: str, values: Sequence[str],
              bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Left outer as-of join: adds ``values`` of the latest right row of the
    same ``by`` key with ``right_ts <= left_ts`` (null when there is none).

    Right rows at the same time keep the largest values (a deterministic tie
    rule).  The right time is cast to the left time's type, so NTZ and
    TIMESTAMP sides can be mixed.  Left rows without a key or a time stay,
    with nulls."""
    return asof_joins(left, [(right, values)], by, left_ts, right_ts, bucket_seconds)


def asof_joins(left: DataFrame, rights: Sequence[tuple[DataFrame, Sequence[str]]], by: Sequence[str],
               left_ts: str, right_ts: str, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``asof_join`` with several right tables at once: ``rights`` are pairs of
    a table and its value columns; each is looked up on its own."""
    kind = left.schema[left_ts].dataType
    keys = [f"_by{i}" for i in range(len(by))]
    points = [f"_p{i}" for i in range(len(rights))]
    parts = []
    for i, (right, values) in enumerate(rights):
        own = right.select(*[F.col(b).alias(k) for b, k in zip(by, keys)],
                           F.col(right_ts).cast(kind).alias("_t"),
                           F.struct(*[F.col(v) for v in values]).alias(points[i]))
        parts.append(own.dropna(subset=[*keys, "_t"]).groupBy(*keys, "_t")
                     .agg(F.max(points[i]).alias(points[i]))
                     .withColumn("_b", _bucket(F.col("_t"), bucket_seconds)))
    known = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    lt = F.col(left_ts)
    framed = left.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], lt.alias("_t"),
                         _bucket(lt, bucket_seconds).alias("_b"), F.struct(*left.columns).alias("_row"))
    # the last right row of each bucket, and the buckets that have left rows
    ends = known.groupBy(*keys, "_b").agg(*[
        F.max_by(p, F.when(F.col(p).isNotNull(), F.col("_t"))).alias(p) for p in points])
    asked = framed.dropna(subset=[*keys, "_b"]).select(*keys, "_b").distinct().withColumn("_asked", F.lit(True))
    steps = (ends.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "_b")
             .agg(*[F.max(p).alias(p) for p in points], F.max("_asked").alias("_asked")))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.select(*keys, "_b", "_asked", *[F.last(p, ignorenulls=True).over(before).alias(p) for p in points])
    carried = carried.where("_asked").drop("_asked")

    # rows without key or time meet nothing; they stay spread over the tasks they come from
    alone = F.lit(-1).cast("long") - F.spark_partition_id()
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "_t"]])
    rows = framed.withColumn("_b", F.when(complete, F.col("_b")).otherwise(alone))
    every = (rows.withColumn("_kind", F.lit(1))
             .unionByName(known.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
             .unionByName(carried.withColumn("_kind", F.lit(-1)), allowMissingColumns=True))
    so_far = (Window.partitionBy(*keys, "_b").orderBy(F.col("_t").asc_nulls_first(), "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = every.select("_row", "_kind", complete.alias("_ok"),
                         *[F.last(p, ignorenulls=True).over(so_far).alias(p) for p in points])
    return found.where(F.col("_kind") == 1).select(
        "_row.*", *[F.when(F.col("_ok"), F.col(f"{p}.{v}")).alias(v)
                    for p, (_, values) in zip(points, rights) for v in values])
