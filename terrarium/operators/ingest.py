"""Ingest: verify signed payloads and enrich them into readings (Q8).

P15 signature check -> body decode -> F6 time from ``sec`` -> F11 id
normalisation -> F10 Fahrenheit -> F12 MAC -> J2 tag lookup.  One projection
plus one join against the device tag dimension, so an arbitrarily large batch
of payloads streams through; Spark broadcasts the dimension when its measured
size allows it.  Payloads with a wrong signature or a malformed body are
returned as their own DataFrame with a reason; fields that the reading schema
does not know are kept in ``extra``, with their types, and the body itself in
``body``.  A payload's signature and its parse are computed once.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrarium.functions import expr as X
from terrarium.schema import EXTENDED

# Body schema: everything a device sends (the extended reading).
BODY = StructType([f for f in EXTENDED.fields if f.name != "event_id"])
# Names of body fields that have a column of their own.
KNOWN = [f.name for f in EXTENDED.fields]
INVALID_SIGNATURE = "invalid signature"
MALFORMED_BODY = "malformed body"
#: All fields of a body, as they came.
FIELDS = "map<string, variant>"


def signature_ok(key: str | bytes, body: str = "body", signature: str = "signature"):
    """P15 predicate: the signature equals the HMAC-SHA1 of the body, as
    lower-case hex; a missing or empty one is false, never null or an error."""
    expected = X.hmac_sha1_hex(F.col(body), key)
    return F.coalesce(F.col(signature) == expected, F.lit(False))


def _once(df: DataFrame, **columns) -> DataFrame:
    """``df`` with ``columns``, each computed once a row: the row number makes
    them nondeterministic to the optimizer, which then neither copies them
    into a filter pushed below nor merges them into the projections above."""
    row = F.monotonically_increasing_id()
    return df.select("*", *[F.when(row >= 0, c).alias(k) for k, c in columns.items()])


def verify(payloads: DataFrame, key: str | bytes) -> tuple[DataFrame, DataFrame]:
    """Split payloads into (accepted, rejected) with ``signature_ok``."""
    marked = _once(payloads, _ok=signature_ok(key))
    accepted = marked.where(F.col("_ok")).drop("_ok")
    rejected = (marked.where(~F.col("_ok")).drop("_ok")
                .withColumn("reason", F.lit(INVALID_SIGNATURE)))
    return accepted, rejected


def decode_body(payloads: DataFrame, schema: StructType = BODY) -> DataFrame:
    """Parse the JSON body, once, into a VARIANT: its known fields are read
    from it as one struct, and ``extra`` keeps the others with the types they
    came with.  ``malformed`` tells bodies that are not one JSON object, or
    have a field that its type cannot hold; their fields are null."""
    keep = [c for c in payloads.columns if c != "signature"]
    fields = [f for f in schema.fields if f.name not in keep]
    parsed = _once(payloads, _body=F.try_parse_json("body"))
    read = _once(parsed, _r=F.try_variant_get("_body", "$", StructType(fields).simpleString()),
                 _all=F.try_variant_get("_body", "$", FIELDS))
    names = [f.name for f in fields]
    given = F.size(F.map_filter("_all", lambda k, v: k.isin(names) & ~F.is_variant_null(v)))
    held = reduce(add, [F.col("_r").getField(n).isNotNull().cast("int") for n in names])
    told = _once(read, malformed=F.coalesce(F.col("_r").isNull() | (given != held), F.lit(True)))
    extra = F.map_filter("_all", lambda k, v: ~k.isin(KNOWN))
    return told.select(*payloads.columns, *[F.col("_r").getField(n).alias(n) for n in names], extra.alias("extra"),
                       "malformed")


def normalise(readings: DataFrame) -> DataFrame:
    """Time from ``sec`` when present, id without ``:``,
    Fahrenheit when Celsius is present, and the device ``mac``."""
    ts_from_sec = X.reading_time_text(X.epoch_ts(F.col("sec")))
    return (readings
            .withColumn("timestamp", F.when(F.col("sec").isNotNull(), ts_from_sec)
                        .otherwise(F.col("timestamp")))
            .withColumn("sensor", X.sensor_id(F.col("sensor")))
            .withColumn("temperature_f", F.when(F.col("temperature_c").isNotNull(),
                                                X.c_to_f(F.col("temperature_c")))
                        .otherwise(F.col("temperature_f")))
            .withColumn("mac", X.mac(F.col("sensor"))))


def tag(readings: DataFrame, tags: DataFrame) -> DataFrame:
    """Left lookup by MAC; a known device's tags replace whatever the
    payload carried, an unknown device keeps its own (possibly null)."""
    dim = tags.select(F.col("mac").alias("_mac"), F.col("tags").alias("_dim_tags"))
    joined = readings.join(dim, F.col("mac") == F.col("_mac"), "left")
    return (joined.withColumn("tags", F.coalesce(F.col("_dim_tags"), F.col("tags")))
            .drop("_mac", "_dim_tags"))


def enrich(payloads: DataFrame, tags: DataFrame, key: str | bytes) -> tuple[DataFrame, DataFrame]:
    """Q8: (accepted enriched readings, rejected payloads).  A rejected
    payload keeps its body and signature and names its reason."""
    checked = checked_payloads(payloads, key)
    accepted = checked.where(F.col("reason").isNull()).drop("signature", "reason")
    rejected = checked.where(F.col("reason").isNotNull()).select(*payloads.columns, "reason")
    return tag(normalise(accepted), tags), rejected


def checked_payloads(payloads: DataFrame, key: str | bytes) -> DataFrame:
    """Every payload, decoded, with the ``reason`` it is refused for
    (null: none); one signature and one parse a payload."""
    decoded = decode_body(_once(payloads, _signed=signature_ok(key)))
    reason = (F.when(~F.col("_signed"), F.lit(INVALID_SIGNATURE))
              .when(F.col("malformed"), F.lit(MALFORMED_BODY)))
    return decoded.withColumn("reason", reason).drop("_signed", "malformed")
