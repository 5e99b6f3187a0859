"""Landed raw payloads turned into readings (S7 scale lines, S8 one-wire
text, S9 nested observations).  The devices' own reads are hardware
drivers; what remains is text and JSON parsing, done with built-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarium.functions import expr as X
from terrarium.schema import OBSERVATION


def scale_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Keep lines with more than one comma part; the first part
    is the number (null when it is not one), turned into ``weight`` with the
    fixed transform; ``grams`` is the same value under the name the weights
    dataset reads (N13)."""
    parts = F.split(F.col(line), ",")
    kept = lines.where(F.size(parts) > 1)
    number = F.trim(parts[0]).try_cast("double")
    return (kept.withColumn("number", number)
            .withColumn("weight", X.scale_fixed(F.col("number")))
            .withColumn("grams", F.col("weight")))


def onewire(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """A two-line one-wire payload; the first line must end in
    ``YES`` (CRC ok), the second carries ``t=<milli-degrees>`` at its end.
    Anything else gives no reading (the row is dropped)."""
    lines = F.split(F.col(payload), "\n")
    first = F.rtrim(F.get(lines, F.lit(0)))
    second = F.coalesce(F.get(lines, F.lit(1)), F.lit(""))  # a missing line is not an error
    milli = F.regexp_extract(F.trim(second), r"t=(-?[0-9]+)$", 1)
    c = (milli.try_cast("int") / F.lit(1000.0))
    return (payloads.where(first.endswith("YES"))
            .withColumn("temperature_c", c)
            .where(F.col("temperature_c").isNotNull())
            .withColumn("temperature_f", X.c_to_f(F.col("temperature_c"))))


def observations(payloads: DataFrame, json_col: str = "json", name: str = "name",
                 schema=OBSERVATION) -> DataFrame:
    """Flatten ``current_observation``, set ``sensor`` to the source
    name and use the RFC-822 observation time as ``timestamp``."""
    o = payloads.select(F.col(name).alias("sensor"), "*",
                        F.from_json(F.col(json_col), schema).alias("_o"))
    flat = o.select("*", "_o.current_observation.*").drop("_o", json_col, name)
    return flat.withColumn("timestamp", X.parse_ts_any(F.col("observation_time_rfc822")))
