"""Event-time window rollups in batch.

Grouping is always on the window *struct* and the label field is projected
afterwards (N16): grouping on an extracted field loses the watermark in
streams, and keeping one form for batch and stream keeps them equal.
The aggregates are algebraic (avg, min/max of structs), so Spark plans a
partial aggregate before the shuffle; a hot sensor costs one partial row per
window per input partition, not a skewed reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_WIDTH = "10 minutes"


def window_col(ts: str | Column, width: str, start_offset: str | None = None) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    if start_offset:
        return F.window(c, width, width, start_offset)
    return F.window(c, width)


def rollup(df: DataFrame, values: Sequence[str], keys: Sequence[str] = (),
           width: str = DEFAULT_WIDTH, label: str = "start",
           ts: str = "timestamp") -> DataFrame:
    """``avg(v) AS v`` per tumbling window and keys.

    ``avg`` skips nulls; a null key is its own group; rows without a time are
    dropped by the window.  The window is labelled by its ``start`` (T2) or
    ``end`` (T3) into column ``timestamp``.
    """
    aggs = [F.avg(v).alias(v) for v in values]
    grouped = df.groupBy(window_col(ts, width).alias("w"), *keys).agg(*aggs)
    return grouped.select(F.col(f"w.{label}").alias("timestamp"), *keys, *values)


def first_minus_last(ts: str, value: str) -> Column:
    """A3: the value at the earliest time minus the value at the latest.

    Struct ordering breaks time ties by the value: the smallest value at the
    earliest time, the largest at the latest.  One point gives 0.
    """
    first = F.min(F.struct(F.col(ts), F.col(value)))[value]
    last = F.max(F.struct(F.col(ts), F.col(value)))[value]
    return first - last
