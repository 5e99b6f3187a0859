"""Schemas of the data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# D3: the typed reading.  `timestamp` is text on the wire and is parsed by
# functions.expr.parse_ts; the other fields keep their wire types.
READING = StructType([
    StructField("timestamp", StringType()),
    StructField("sensor", StringType()),
    StructField("relative_humidity", StringType()),
    StructField("temperature_f", DoubleType()),
    StructField("temperature_c", DoubleType()),
    StructField("grams", DoubleType()),
    StructField("lux", LongType()),
    StructField("raw", DoubleType()),
    StructField("stddev", DoubleType()),
    StructField("tags", MapType(StringType(), StringType())),
])

# Fields devices send that D3 drops.  `zero` and `1kg` are read from a file
# as text on the device, so they are kept as strings and cast on use.
EXTENDED = StructType(READING.fields + [
    StructField("humidity", DoubleType()),
    StructField("broad", DoubleType()),
    StructField("ir", DoubleType()),
    StructField("clear", DoubleType()),
    StructField("red", DoubleType()),
    StructField("green", DoubleType()),
    StructField("blue", DoubleType()),
    StructField("res", DoubleType()),
    StructField("tdesc", DoubleType()),
    StructField("par", DoubleType()),
    StructField("weight", DoubleType()),
    StructField("sec", LongType()),
    StructField("usec", LongType()),
    StructField("git_hash", StringType()),
    StructField("zero", StringType()),
    StructField("1kg", StringType()),
    StructField("event_id", LongType()),
])

# One record of the append-only topic log.
LOG = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# Signed payload before enrichment (Q8 input).
PAYLOAD = StructType([
    StructField("body", StringType()),
    StructField("signature", StringType()),
])

# Device tag dimension.
TAGS = StructType([
    StructField("mac", StringType()),
    StructField("tags", MapType(StringType(), StringType())),
])

# Load-cell sample bursts and calibration presses.
BURST = StructType([
    StructField("sensor", StringType()),
    StructField("reading_ts", TimestampType()),
    StructField("i", IntegerType()),
    StructField("v", DoubleType()),
])

CALIBRATION = StructType([
    StructField("sensor", StringType()),
    StructField("point", StringType()),
    StructField("ts", TimestampType()),
    StructField("raw", DoubleType()),
])

# Graph spec of the catalog.
GRAPH = StructType([
    StructField("title", StringType()),
    StructField("data", ArrayType(StringType())),
    StructField("series", StringType()),
    StructField("x", StringType()),
    StructField("y", StringType()),
    StructField("age", StringType()),
])

# The part of a weather observation payload that is kept.
OBSERVATION = StructType([
    StructField("current_observation", StructType([
        StructField("observation_time_rfc822", StringType()),
        StructField("temp_c", DoubleType()),
        StructField("temp_f", DoubleType()),
        StructField("relative_humidity", StringType()),
        StructField("station_id", StringType()),
        StructField("weather", StringType()),
    ])),
])
