"""Derived measures over cleaned weights (Q2-Q5: A1, A3, J1, P10-P12, T3).

``ranges`` is one row per sensor.  The joins against it are plain joins:
Spark broadcasts the side when the size it measures allows it, and otherwise
shuffles with adaptive skew splitting.  ``loss`` only needs to know which
sensors have a range, so it uses a left-semi join on the distinct sensors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarium.operators.rollup import first_minus_last, window_col

# Evaporation window and the accepted loss range (exclusive).
LOSS_WIDTH = "5 minutes"
LOSS_LO = 0.0
LOSS_HI = 30.0


def ranges(weights: DataFrame) -> DataFrame:
    """Q2/A1: ``min(grams) AS min, max(grams) AS max`` per sensor (a null
    sensor forms its own group, as grouping does)."""
    return weights.groupBy("sensor").agg(F.min("grams").alias("min"),
                                         F.max("grams").alias("max"))


def merged_ranges(known: DataFrame, more: DataFrame) -> DataFrame:
    """Ranges that grow: those of two sets of weights together."""
    return known.unionByName(more).groupBy("sensor").agg(F.min("min").alias("min"), F.max("max").alias("max"))


def with_range(weights: DataFrame, rng: DataFrame) -> DataFrame:
    """Inner equi-join USING sensor; unmatched and null sensors drop."""
    return weights.join(rng.select("sensor", "min", "max"), ["sensor"])


def water(weights: DataFrame, rng: DataFrame) -> DataFrame:
    """Grams above the sensor's minimum."""
    return with_range(weights, rng).withColumn("water", F.col("grams") - F.col("min"))


def water_rel(weights: DataFrame, rng: DataFrame) -> DataFrame:
    """Min-max scaled grams; a sensor with min = max gives null."""
    return with_range(weights, rng).withColumn(
        "water", F.try_divide(F.col("grams") - F.col("min"), F.col("max") - F.col("min")))


def loss(weights: DataFrame, rng: DataFrame | None, width: str = LOSS_WIDTH,
         lo: float = LOSS_LO, hi: float = LOSS_HI,
         start_offset: str | None = None, label: str = "end") -> DataFrame:
    """Q5 ``evaporation``: per sensor and tumbling window, grams at the first
    time minus grams at the last (A3), kept when lo < loss < hi (P10), the
    window labelled by its end (T3).  ``ml_hour`` is the per-window loss as
    the reference names it; ``rate_per_hour`` scales it to an hour.

    The join with ranges only restricts to sensors that have a range, so it is
    a left-semi join against the distinct sensor list.  ``rng=None`` means
    the ranges are taken from these same weights (the batch case): every
    non-null sensor then has a range and the join is a null filter, which
    saves the second scan and the aggregation.
    """
    if rng is None:
        kept = weights.where(F.col("sensor").isNotNull())
    else:
        sensors = rng.select("sensor").where(F.col("sensor").isNotNull()).distinct()
        kept = weights.join(sensors, ["sensor"], "left_semi")
    per_window = (kept
                  .groupBy(window_col("timestamp", width, start_offset).alias("w"), "sensor")
                  .agg(first_minus_last("timestamp", "grams").alias("ml_hour")))
    return _losses(per_window, lo, hi, label)


#: The aggregation buffers of ``loss`` in a stream's state.
LOSS_STATE = "first: struct<timestamp: timestamp, grams: double>, last: struct<timestamp: timestamp, grams: double>"


def loss_of_state(state: DataFrame, lo: float = LOSS_LO, hi: float = LOSS_HI) -> DataFrame:
    """The losses of windows a stream still holds open, from its state."""
    return _losses(state.select(F.col("window").alias("w"), "sensor",
                                (F.col("first.grams") - F.col("last.grams")).alias("ml_hour")), lo, hi, "end")


def _losses(per_window: DataFrame, lo: float, hi: float, label: str) -> DataFrame:
    per_window = per_window.where((F.col("ml_hour") > F.lit(lo)) & (F.col("ml_hour") < F.lit(hi)))
    seconds = F.unix_seconds(F.col("w.end").cast("timestamp")) - F.unix_seconds(
        F.col("w.start").cast("timestamp"))
    # label "time" = window_time (end - 1 µs): the form a stream can window again
    t = F.window_time(F.col("w")) if label == "time" else F.col(f"w.{label}")
    return per_window.select(
        t.alias("timestamp"), "sensor", "ml_hour",
        (F.col("ml_hour") * F.lit(3600.0) / seconds).alias("rate_per_hour"))
