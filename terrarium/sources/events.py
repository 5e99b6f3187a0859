"""Readings and log records derived from the driver's ``events`` table.

The reference has no data of its own; the fixtures see ``events`` through a
fixed projection (FIXTURES.md section 3/4).  Everything here is a narrow
projection (no shuffle) except the log offsets, which number rows within
each log partition the way a partitioned log does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarium.functions import expr as X
from terrarium.operators.numbering import number_within

READINGS_TOPIC = "readings"
LOG_PARTITIONS = 4


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def device_mac(user_id: str = "user_id") -> F.Column:
    """Invented device MAC: lower hex of the user id, 12 digits, colons."""
    return X.colon_mac(F.lpad(F.lower(F.hex(F.col(user_id))), 12, "0"))


def readings_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed readings (D3 columns plus ``event_id``) from ``events``.

    timestamp = ts (kept TIMESTAMP_NTZ in batch), grams = 190 + 2*value,
    stddev = 3*k, temperature_c = -999 when k < 5 else value,
    sensor = device MAC + ``-weight``, tags = {user: user_id, plant:
    event_type unless user_id % 10 = 0}.
    """
    k = F.get_json_object("props", "$.k").cast("long")
    user = F.col("user_id").cast("string")
    temp_c = F.when(k < 5, F.lit(-999.0)).otherwise(F.col("value"))
    tags = F.when(F.col("user_id") % 10 != 0,
                  F.create_map(F.lit("user"), user, F.lit("plant"), F.col("event_type"))
                  ).otherwise(F.create_map(F.lit("user"), user))
    return events.select(
        F.col("ts").alias("timestamp"),
        F.concat(device_mac(), F.lit("-weight")).alias("sensor"),
        F.lit(None).cast("string").alias("relative_humidity"),
        X.c_to_f(temp_c).alias("temperature_f"),
        temp_c.alias("temperature_c"),
        (F.lit(190.0) + 2 * F.col("value")).alias("grams"),
        F.lit(None).cast("long").alias("lux"),
        F.lit(None).cast("double").alias("raw"),
        (F.lit(3.0) * k).alias("stddev"),
        tags.alias("tags"),
        F.col("event_id"),
        *[F.col(c) for c in keep],
    )


def reading_json(readings: DataFrame) -> F.Column:
    """The wire form of a reading: JSON with the time as text (nulls omitted)."""
    cols = [c for c in readings.columns if c != "timestamp"]
    ts_text = F.concat(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                       F.lit(" -0000"))
    return F.to_json(F.struct(ts_text.alias("timestamp"), *[F.col(c) for c in cols]))


def log_from_events(events: DataFrame, topic: str = READINGS_TOPIC,
                    partitions: int = LOG_PARTITIONS, numbered: bool = False) -> DataFrame:
    """LOG records (D1) for ``events``: partition = user_id % n, offset =
    event_id (``numbered``: dense within a partition, in the order of
    event_id), key null, value = the reading's JSON, log time = the reading
    time."""
    parted = events.withColumn(
        "partition", F.pmod(F.col("user_id"), F.lit(partitions)).cast("int"))
    readings = readings_from_events(parted, keep=("partition",))
    position = F.col("event_id").cast("long")
    if numbered:
        readings, position = number_within(readings, ["partition"], "event_id", "_offset"), F.col("_offset")
    return readings.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(reading_json(readings.drop("partition", "_offset")), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("partition"),
        position.alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )


# ---------------------------------------------------------------------------
# Raw device inputs derived from events (ingest, landing, calibration).
# Every event yields one input row; the event type picks the kind of input.
# ---------------------------------------------------------------------------

def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


def _hex12(user_id: str = "user_id") -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(user_id))), 12, "0")


def _fmt2(c: F.Column) -> F.Column:
    return F.format_string("%.2f", c)


def channel_of_event() -> F.Column:
    """Channel a device reports on: purchase -> dht, signup -> rbg, else weight."""
    et = F.col("event_type")
    return (F.when(et == "purchase", F.lit("dht"))
            .when(et == "signup", F.lit("rbg")).otherwise(F.lit("weight")))


def payloads_from_events(events: DataFrame, key: str, wrong_key: str) -> DataFrame:
    """Signed device payloads (``event_id, body, signature``).

    The body is JSON text built field by field: ``sec``/``usec`` when k >= 10
    (else a ``timestamp`` text), channel fields (dht: temperature, integer
    when k is even; weight: grams, stddev; rbg: colour counts), device tags
    on signups, and a ``git_hash``.  k < 3: empty signature; error events:
    signed with the wrong key; 3 <= k <= 5: body altered after signing; k = 6:
    signature in upper case; k = 7: a field the schema does not know; k = 8:
    a body cut off before it was signed.
    """
    k = _k()
    ts = F.col("ts").cast("timestamp")
    ch = channel_of_event()
    sec = F.unix_seconds(ts)
    usec = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    temp = F.when(k % 2 == 0, F.floor("value").cast("string")).otherwise(_fmt2(F.col("value")))
    time_part = F.when(k >= 10, F.concat(F.lit(',"sec":'), sec.cast("string"),
                                          F.lit(',"usec":'), usec.cast("string"))) \
        .otherwise(F.concat(F.lit(',"timestamp":"'),
                            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(' -0000"')))
    fields = (F.when(ch == "dht", F.concat(F.lit(',"temperature_c":'), temp,
                                            F.lit(',"humidity":'), k.cast("string")))
              .when(ch == "rbg", F.concat(F.lit(',"clear":'), k.cast("string"),
                                          F.lit(',"red":'), (k * 2).cast("string")))
              .otherwise(F.concat(F.lit(',"grams":'), _fmt2(F.lit(190.0) + 2 * F.col("value")),
                                  F.lit(',"stddev":'), (k * 3).cast("string"))))
    own_tags = F.when(F.col("event_type") == "signup", F.lit(',"tags":{"source":"device"}')) \
        .otherwise(F.lit(""))
    body = F.concat(F.lit('{"sensor":"'), device_mac(), F.lit("-"), ch, F.lit('"'),
                    time_part, fields, own_tags,
                    F.when(k == 7, F.lit(',"firmware":{"v":7}')).otherwise(F.lit("")),
                    F.lit(',"git_hash":"f1"}'))
    body = F.when(k == 8, F.substring(body, 1, 30)).otherwise(body)
    signed = events.select("event_id", "event_type", k.alias("k"), body.alias("body"))
    sig = (F.when(F.col("k") < 3, F.lit(""))
           .when(F.col("event_type") == "error", X.hmac_sha1_hex(F.col("body"), wrong_key))
           .when(F.col("k") == 6, F.upper(X.hmac_sha1_hex(F.col("body"), key)))
           .otherwise(X.hmac_sha1_hex(F.col("body"), key)))
    sent = F.when(F.col("k").between(3, 5),
                  F.replace(F.col("body"), F.lit('"git_hash":"f1"'), F.lit('"git_hash":"f2"'))) \
        .otherwise(F.col("body"))
    return signed.select("event_id", sent.alias("body"), sig.alias("signature"))


def tags_from_events(events: DataFrame) -> DataFrame:
    """Device tag dimension (``mac, tags``): a device is known once it made a
    purchase; its tags are the user and a plant named after its smallest k.
    One row per device, from a partial-aggregated group-by."""
    per_user = (events.groupBy("user_id")
                .agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("buyer"),
                     F.min(_k()).alias("kmin"))
                .where(F.col("buyer") == 1))
    return per_user.select(
        _hex12().alias("mac"),
        F.create_map(F.lit("user"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
                     F.lit("plant"), F.concat(F.lit("plant-"), F.col("kmin").cast("string")))
        .alias("tags"))


def lines_from_events(events: DataFrame) -> DataFrame:
    """Landed scale lines (``event_id, line``): ``<n>,kg`` mostly; an error
    gives a bare number (no comma, dropped), a signup a non-number."""
    et = F.col("event_type")
    line = (F.when(et == "error", _fmt2(F.col("value")))
            .when(et == "signup", F.lit("x,kg"))
            .otherwise(F.concat(_fmt2(F.col("value")), F.lit(",kg"))))
    return events.select("event_id", line.alias("line"))


def onewire_from_events(events: DataFrame) -> DataFrame:
    """One-wire payloads (``event_id, sensor, payload``): CRC line ends in
    YES when k >= 10 (else NO); errors carry negative temperatures."""
    k = _k()
    milli = F.round(F.col("value") * 1000).cast("long") * F.when(
        F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1))
    payload = F.concat(F.lit("4b 46 7f ff 0c 10 1c : crc=1c "),
                       F.when(k >= 10, F.lit("YES")).otherwise(F.lit("NO")),
                       F.lit("\n4b 46 7f ff 0c 10 1c t="), milli.cast("string"), F.lit("\n"))
    return events.select("event_id", F.concat(F.lit("28-"), _hex12()).alias("sensor"),
                         payload.alias("payload"))


def observations_from_events(events: DataFrame) -> DataFrame:
    """Landed weather observations (``event_id, name, json``) whose time is
    RFC-822 text in a -0800 zone."""
    obs_time = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0800"))
    js = F.concat(F.lit('{"current_observation":{"observation_time_rfc822":"'), obs_time,
                  F.lit('","temp_c":'), _fmt2(F.col("value")),
                  F.lit(',"station_id":"S'), F.col("user_id").cast("string"), F.lit('"}}'))
    return events.select("event_id", F.concat(F.lit("station-"), F.col("event_type")).alias("name"),
                         js.alias("json"))


READING_TYPES = ("view", "click", "error")


def bursts_from_events(events: DataFrame) -> DataFrame:
    """Load-cell bursts in long form (``sensor, reading_ts, i, v``) for the
    weight readings: 1 + k % 10 samples each, spread around value * 100."""
    return (_burst_events(events)
            .select("*", F.explode(F.sequence(F.lit(0), (F.col("k") % 10).cast("int"))).alias("i"))
            .select("sensor", "reading_ts", "i", _sample(F.col("i")).alias("v")))


def _burst_events(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type").isin(*READING_TYPES))
            .select(F.concat(_hex12(), F.lit("-weight")).alias("sensor"),
                    F.col("ts").alias("reading_ts"), F.col("value"), _k().alias("k")))


def _sample(i: Column) -> Column:
    return (F.col("value") * 100 + ((F.col("k") * (i + 3)) % 17) - 8).cast("double")


def burst_arrays_from_events(events: DataFrame) -> DataFrame:
    """The same bursts as a device sends them: ``sensor, timestamp, samples``."""
    places = F.sequence(F.lit(0), (F.col("k") % 10).cast("int"))
    return _burst_events(events).select("sensor", F.col("reading_ts").alias("timestamp"),
                                        F.transform(places, _sample).alias("samples"))


def calibrations_from_events(events: DataFrame) -> DataFrame:
    """Calibration presses (``sensor, point, ts, raw``): a signup saves the
    zero point, a purchase the one-kilogram point."""
    et = F.col("event_type")
    return (events.where(et.isin("signup", "purchase"))
            .select(F.concat(_hex12(), F.lit("-weight")).alias("sensor"),
                    F.when(et == "signup", F.lit("zero")).otherwise(F.lit("1kg")).alias("point"),
                    F.col("ts").alias("ts"),
                    F.when(et == "signup", F.col("value") * 10)
                    .otherwise(F.col("value") * 10 + 1000).alias("raw")))
