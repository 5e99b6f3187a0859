"""Dense row numbers within groups, without one task per group.

``row_number()`` over ``Window.partitionBy(g).orderBy(o)`` sorts each group in
a single task, and a log has few partitions.  Here quantiles of ``o`` cut every
group into pieces, the window runs within ``(g, piece)``, and each piece starts
above the rows of the pieces before it.  Wherever the cuts fall the numbers are
the same; they only decide how evenly the rows are dealt.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_within(df: DataFrame, group: Sequence[str], order: str, name: str = "offset") -> DataFrame:
    """Add ``name`` = place of each row within its ``group`` by the number
    ``order``, from 0.  Rows without ``order`` come last; a null in ``group``
    is a group of its own."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.approxQuantile(order, [i / n for i in range(1, n)], 1 / (4 * n))
    splits = [-float("inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    pieces = Bucketizer(splits=splits, inputCol="_order", outputCol="_piece", handleInvalid="keep").transform(
        df.withColumn("_order", F.col(order).cast("double")))
    pieces = pieces.withColumn("_piece", F.coalesce("_piece", F.lit(float(len(splits)))))    # null has none
    own = Window.partitionBy(*group, "_piece").orderBy(F.col(order).asc_nulls_last())
    placed = pieces.drop("_order").withColumn("_place", F.row_number().over(own) - 1)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (pieces.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
              .select(*[F.col(g).alias(f"_own_{g}") for g in group], F.col("_piece").alias("_own_piece"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_own_{g}")) for g in group],
                  F.col("_piece") == F.col("_own_piece"))
    return placed.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_place")).cast("long").alias(name))
