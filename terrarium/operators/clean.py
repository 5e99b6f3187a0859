"""Declarative cleaning rules for the named datasets (Q1 weights, Q6 temperatures).

All rules are plain ``where`` predicates over built-in expressions, so they
push through projections and, for columnar sources, into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrarium.functions import expr as X


@dataclass(frozen=True)
class CapRule:
    """Drop readings of ``sensor`` whose ``column`` exceeds ``limit``."""
    sensor: str
    limit: float
    column: str = "grams"


@dataclass(frozen=True)
class RetireRule:
    """Drop readings of ``sensor`` at or after ``since`` (a date/time text)."""
    sensor: str
    since: str


# The reference's own rule constants, kept as defaults.
#   weight window (exclusive): 200 < grams < 10000; quality gate: stddev < 200
#   cap: sensor 'ficus', grams > 1800 dropped
#   retirement: sensor 'plumeria' from 2017-02-27
#   temperature sentinel: temperature_c = -999 means missing
DEFAULT_LO = 200.0
DEFAULT_HI = 10000.0
DEFAULT_MAX_STDDEV = 200.0
DEFAULT_CAPS = (CapRule("ficus", 1800.0),)
DEFAULT_RETIRES = (RetireRule("plumeria", "2017-02-27"),)
SENTINEL_C = -999.0


def cap_predicate(rule: CapRule) -> Column:
    """Kept in the NOT(a AND b) form on purpose (three-valued logic): a null
    sensor over the cap is dropped, a null sensor under it kept."""
    return ~((F.col("sensor") == F.lit(rule.sensor)) & (F.col(rule.column) > F.lit(rule.limit)))


def retire_predicate(rule: RetireRule, ts_type) -> Column:
    """NOT(sensor = s AND timestamp >= since), with the bound cast to the
    time column's own type (TIMESTAMP in streams, TIMESTAMP_NTZ in batch)."""
    bound = F.lit(rule.since).cast(ts_type)
    return ~((F.col("sensor") == F.lit(rule.sensor)) & (F.col("timestamp") >= bound))


def clean_weights(readings: DataFrame,
                  lo: float = DEFAULT_LO,
                  hi: float = DEFAULT_HI,
                  max_stddev: float = DEFAULT_MAX_STDDEV,
                  caps=DEFAULT_CAPS,
                  retires=DEFAULT_RETIRES,
                  sensor_tag: str = "plant") -> DataFrame:
    """Q1 ``weights``: P4 grams present, P5 stddev < max (null dropped),
    P6 lo < grams < hi, sensor := tags[sensor_tag] (P3), then P7 caps and
    P8 retirements."""
    df = (readings
          .where(F.col("grams").isNotNull())
          .where(F.col("stddev") < F.lit(max_stddev))
          .where(F.col("grams") < F.lit(hi))
          .where(F.col("grams") > F.lit(lo))
          .withColumn("sensor", X.tag(sensor_tag)))
    for rule in caps:
        df = df.where(cap_predicate(rule))
    ts_type = df.schema["timestamp"].dataType
    for rule in retires:
        df = df.where(retire_predicate(rule, ts_type))
    return df


def clean_temperatures(readings: DataFrame, sentinel: float = SENTINEL_C,
                       sensor_tag: str = "user") -> DataFrame:
    """Q6 ``temperatures``: P9 drop the sentinel (null also dropped), then
    sensor := tags[sensor_tag]."""
    return (readings
            .where(F.col("temperature_c") != F.lit(sentinel))
            .withColumn("sensor", X.tag(sensor_tag)))
