"""Named batch queries over the driver's tables (``queries()`` entries).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL lives in ``plans.oracle``.  Doubles from aggregates or divisions
are rounded to ``fixture.DIGITS`` digits on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from terrarium.functions import expr as X
from terrarium.operators import calibrate, clean, derive, ingest
from terrarium.operators.numbering import number_within
from terrarium.operators.rollup import rollup
from terrarium.plans import fixture as FX
from terrarium.session import ensure_utc, shared_dir
from terrarium.sources import events as EV
from terrarium.sources import landing
from terrarium.sources.events import load, readings_from_events
from terrarium.sources.log import FileLog, decode, latest_by_key, to_records
from terrarium.operators import serve
from terrarium.operators.rollup import window_col


def rounded(df: DataFrame, digits: int = FX.DIGITS) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType)
        else F.col(f.name) for f in df.schema.fields])


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return readings_from_events(load(spark, sf_dir, "events"))


def weights_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_weights(readings(spark, sf_dir), lo=FX.LO, hi=FX.HI,
                               max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                               retires=FX.RETIRES)


def temperatures_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_temperatures(readings(spark, sf_dir))


def q_weights(spark, sf_dir):
    return weights_df(spark, sf_dir).select("event_id", "timestamp", "sensor", "grams", "stddev")


def q_weights_10min(spark, sf_dir):
    return rounded(rollup(weights_df(spark, sf_dir), ["grams", "stddev"], ["sensor"]))


def q_all_10min(spark, sf_dir):
    return rounded(rollup(weights_df(spark, sf_dir), ["grams", "stddev"]))


def q_ranges(spark, sf_dir):
    return derive.ranges(weights_df(spark, sf_dir))


def _water(spark, sf_dir, fn):
    w = weights_df(spark, sf_dir)
    return fn(w, derive.ranges(w))


def q_water(spark, sf_dir):
    return rounded(_water(spark, sf_dir, derive.water).select(
        "event_id", "timestamp", "sensor", "grams", "min", "max", "water"))


def q_water_rel(spark, sf_dir):
    return rounded(_water(spark, sf_dir, derive.water_rel).select(
        "event_id", "timestamp", "sensor", "grams", "min", "max", "water"))


def q_water_10min(spark, sf_dir):
    return rounded(rollup(_water(spark, sf_dir, derive.water), ["water"], ["sensor"]))


def q_water_rel_10min(spark, sf_dir):
    return rounded(rollup(_water(spark, sf_dir, derive.water_rel), ["water"], ["sensor"]))


def evaporation_df(spark, sf_dir):
    # ranges come from the same weights here, so the sensor restriction is a
    # null filter (derive.loss with rng=None): one scan instead of two
    return derive.loss(weights_df(spark, sf_dir), None)


def q_evaporation(spark, sf_dir):
    return rounded(evaporation_df(spark, sf_dir))


def q_evaporation_10min(spark, sf_dir):
    return rounded(rollup(evaporation_df(spark, sf_dir), ["ml_hour"], ["sensor"]))


def q_temperatures(spark, sf_dir):
    return rounded(temperatures_df(spark, sf_dir).select(
        "event_id", "timestamp", "sensor", "temperature_c", "temperature_f"))


def q_temperatures_10min(spark, sf_dir):
    return rounded(rollup(temperatures_df(spark, sf_dir), ["temperature_f"], ["sensor"]))


def _events(spark, sf_dir):
    ensure_utc(spark)
    return load(spark, sf_dir, "events")


def land(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a derived input to the shared folder and read it back: the
    device inputs and logs the operators consume are data at rest, and the
    write cuts the lineage to the generating expressions."""
    path = shared_dir(spark, "landed", name, unique=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _payloads(spark, sf_dir):
    return EV.payloads_from_events(_events(spark, sf_dir), FX.SIGNING_KEY, FX.WRONG_KEY)


def _ingested(spark, sf_dir):
    """(accepted, rejected) of the payloads."""
    return ingest.enrich(_payloads(spark, sf_dir), EV.tags_from_events(_events(spark, sf_dir)), FX.SIGNING_KEY)


def _enriched(spark, sf_dir):
    return _ingested(spark, sf_dir)[0]


def q_rejected_payloads(spark, sf_dir):
    """What ingest refuses, with the reason."""
    return _ingested(spark, sf_dir)[1].select("event_id", "reason")


def q_enrich_readings(spark, sf_dir):
    accepted = _enriched(spark, sf_dir)
    return rounded(accepted.select(
        "event_id", "timestamp", "sensor", "mac", "temperature_c", "temperature_f",
        "humidity", "grams", "stddev", "clear", "red", "git_hash",
        F.to_json(F.col("extra")["firmware"]).alias("firmware"),
        X.tag("user").alias("tag_user"), X.tag("plant").alias("tag_plant"),
        X.tag("source").alias("tag_source")))


def q_signature_check(spark, sf_dir):
    return _payloads(spark, sf_dir).select(
        "event_id", ingest.signature_ok(FX.SIGNING_KEY).alias("valid"))


def q_sensor_channel(spark, sf_dir):
    r = ingest.decode_body(_payloads(spark, sf_dir))
    sid = X.sensor_id(F.col("sensor"))
    return r.select("event_id", sid.alias("sensor"), X.mac(sid).alias("mac"),
                    X.channel(sid).alias("channel"))


def q_parse_timestamps(spark, sf_dir):
    ev = _events(spark, sf_dir)
    ts = F.col("ts")
    text = X.reading_time_text(ts)
    zoned = F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" -0800"))
    return ev.select(
        "event_id", text.alias("text"),
        X.parse_ts(text, ntz=True).alias("parsed"),
        X.parse_ts_any(zoned).cast("timestamp_ntz").alias("parsed_zoned"),
        X.format_ts(ts.cast("timestamp")).alias("formatted"),
        X.to_millis(ts).alias("epoch_ms"),
        X.epoch_ts(F.unix_seconds(ts.cast("timestamp"))).cast("timestamp_ntz").alias("from_sec"))


def q_json_project(spark, sf_dir):
    good, _ = decode(EV.log_from_events(_events(spark, sf_dir), numbered=True), ntz=True)
    return good.select("topic", "partition", "offset", "timestamp", "sensor", "grams",
                       "stddev", "temperature_c", X.tag("plant").alias("plant"),
                       X.tag("user").alias("user"))


def q_landed_lines(spark, sf_dir):
    out = landing.scale_lines(EV.lines_from_events(_events(spark, sf_dir)))
    return rounded(out.select("event_id", "line", "number", "weight", "grams"))


def q_onewire_payload(spark, sf_dir):
    out = landing.onewire(EV.onewire_from_events(_events(spark, sf_dir)))
    return rounded(out.select("event_id", "sensor", "temperature_c", "temperature_f"))


def q_observation_payload(spark, sf_dir):
    out = landing.observations(EV.observations_from_events(_events(spark, sf_dir)))
    return out.select("event_id", "sensor", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      "temp_c", "station_id")


def _burst_stats(spark, sf_dir):
    return calibrate.burst_stats(EV.bursts_from_events(_events(spark, sf_dir)))


def q_burst_stats(spark, sf_dir):
    return rounded(_burst_stats(spark, sf_dir))


def q_calibrated_weight(spark, sf_dir):
    stats = _burst_stats(spark, sf_dir).withColumnRenamed("reading_ts", "timestamp")
    cal = EV.calibrations_from_events(_events(spark, sf_dir))
    out = calibrate.calibrated(stats, cal)
    return rounded(out.select("sensor", "timestamp", "raw", "zero", "one_kg", "grams"))


SNAPSHOT_SINCE = "2024-01-15 00:00:00"
ROLLUP_TOPIC = "weights-10min"


def rollup_log(weights: DataFrame, numbered: bool = False) -> DataFrame:
    """A keyed change log like the one the weights rollup writes: every
    cleaned weight emits its window's record (key = window start + sensor),
    so the newest record per key is the window's last reading.  One key
    stays in one log partition (window index mod 4).  Offsets are event_id
    (``numbered``: dense within a log partition, in the order of event_id)."""
    w = weights.select("event_id", "timestamp", "sensor", "grams",
                       window_col("timestamp", "10 minutes").start.alias("start"))
    framed = w.select("event_id", F.col("start").alias("timestamp"), "sensor", "grams",
                      F.col("timestamp").alias("_logged"))
    part = F.pmod(F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / 600), F.lit(4))
    position = F.col("event_id")
    if numbered:
        framed = number_within(framed.withColumn("_part", part), ["_part"], "event_id", "_offset")
        part, position = F.col("_part"), F.col("_offset")
    return to_records(framed, ROLLUP_TOPIC, part, position, F.col("_logged"),
                      key_cols=["timestamp", "sensor"],
                      value_cols=["timestamp", "sensor", "grams"],
                      time_text=X.format_ts(F.col("timestamp").cast("timestamp")))


def _served(df: DataFrame) -> DataFrame:
    text = F.col("value")
    return df.select("topic", "key", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                     F.get_json_object(text, "$.sensor").alias("sensor"),
                     F.get_json_object(text, "$.grams").cast("double").alias("grams"))


def q_snapshot_since(spark, sf_dir):
    """Q9 over a stored log: the readings topic and a keyed rollup topic are
    landed, then scanned from the bound on (topic and time pruned at the
    scan) and served."""
    ev = _events(spark, sf_dir)
    log = FileLog(spark, shared_dir(spark, "landed", "log", unique=True))
    log.append_records(EV.log_from_events(ev), topic="readings")
    log.append_records(rollup_log(weights_df(spark, sf_dir)), topic=ROLLUP_TOPIC)
    since = F.lit(SNAPSHOT_SINCE).cast("timestamp")
    topics = ["readings", ROLLUP_TOPIC]
    return _served(serve.snapshot(log.scan(topics, since=since), topics, since=since))


HISTORY_ASOF, HISTORY_AGE = "2024-01-31 00:00:00", "15 days"
SHARED_GRAMS = 300.0


def q_history_age(spark, sf_dir):
    """The served history of two topics for an age before a fixed
    time, pruned at the scan."""
    log = FileLog(spark, shared_dir(spark, "landed", "log", unique=True))
    log.append_records(EV.log_from_events(_events(spark, sf_dir)), topic="readings")
    log.append_records(rollup_log(weights_df(spark, sf_dir)), topic=ROLLUP_TOPIC)
    asof = F.lit(HISTORY_ASOF).cast("timestamp")
    return _served(serve.history(log, f"readings,{ROLLUP_TOPIC}", HISTORY_AGE, asof=asof))


def q_shared_key_snapshot(spark, sf_dir):
    """A6 across topics: of records with the same key, the topic named last
    wins, then the larger offset."""
    weights = weights_df(spark, sf_dir)
    late = rollup_log(weights.where(F.col("grams") > SHARED_GRAMS)).withColumn("topic", F.lit("weights-late"))
    recs = rollup_log(weights).unionByName(late)
    return _served(serve.snapshot(recs, [ROLLUP_TOPIC, "weights-late"], shared_keys=True))


def q_latest_by_key(spark, sf_dir):
    recs = rollup_log(weights_df(spark, sf_dir), numbered=True)
    latest = latest_by_key(recs, ["topic", "key"], ["offset"])
    text = F.col("value").cast("string")
    return latest.select(
        F.col("key").cast("string").alias("key"), "partition", "offset",
        X.parse_ts_any(F.get_json_object(text, "$.timestamp")).cast("timestamp_ntz").alias("timestamp"),
        F.get_json_object(text, "$.sensor").alias("sensor"),
        F.get_json_object(text, "$.grams").cast("double").alias("grams"))


def q_series_points(spark, sf_dir):
    return serve.series_points(weights_df(spark, sf_dir), "sensor", "timestamp", "grams")


def q_one_series(spark, sf_dir):
    """The points of one series."""
    return serve.series_points(weights_df(spark, sf_dir), "sensor", "timestamp", "grams", only="click")


def q_latest_point(spark, sf_dir):
    """Of several points of a series at one time the newest stays."""
    points = weights_df(spark, sf_dir).select(
        F.col("sensor").alias("series"), F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("x"),
        F.col("grams").alias("y"), "event_id")
    return serve.latest_point(points, order=["event_id"])


def q_csv_export(spark, sf_dir):
    """K7: the export rows appended as CSV in two parts, and read back."""
    rows = serve.export_rows(_enriched(spark, sf_dir))
    path = shared_dir(spark, "landed", "csv", unique=True)
    warm = F.coalesce(F.col("temp") > 20, F.lit(False))
    for part in (rows.where(warm), rows.where(~warm)):
        serve.write_export(part, path)
    back = spark.read.schema(rows.schema).csv(path)
    return rounded(back.withColumn("humidity", F.coalesce("humidity", F.lit(""))))


def q_series_distinct(spark, sf_dir):
    return serve.series_distinct(weights_df(spark, sf_dir), "sensor")


def q_y_range(spark, sf_dir):
    return serve.y_range(weights_df(spark, sf_dir), "grams")


def q_export_rows(spark, sf_dir):
    return serve.export_rows(_enriched(spark, sf_dir))


def q_jsonl_roundtrip(spark, sf_dir):
    """K4: temperatures appended as JSON lines to the shared folder and read
    back with their schema."""
    t = temperatures_df(spark, sf_dir).select(
        "event_id", "timestamp", "sensor", "temperature_c", "temperature_f")
    path = shared_dir(spark, "landed", "jsonl", unique=True)
    serve.write_jsonl(t, path)
    return rounded(serve.read_jsonl(spark, path, t.schema))


def q_fanout(spark, sf_dir):
    """K8: one computed batch of enriched readings written to two sinks (JSON
    lines and the log), then both read back."""
    rows = _enriched(spark, sf_dir).select("event_id", "timestamp", "sensor", "grams")
    root = shared_dir(spark, "landed", "fanout", unique=True)
    log = FileLog(spark, f"{root}/log")
    serve.fan_out(rows, [
        lambda d: serve.write_jsonl(d, f"{root}/jsonl"),
        lambda d: log.append("readings", d, position=F.col("event_id"), time_text=F.col("timestamp")),
    ])
    a = serve.read_jsonl(spark, f"{root}/jsonl", rows.schema).select(
        F.lit("jsonl").alias("sink"), "event_id", "sensor")
    text = F.col("value").cast("string")
    b = log.scan("readings").select(
        F.lit("log").alias("sink"),
        F.get_json_object(text, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(text, "$.sensor").alias("sensor"))
    return a.unionByName(b)


QUERIES = {
    "weights": q_weights,
    "weights_10min": q_weights_10min,
    "all_10min": q_all_10min,
    "ranges": q_ranges,
    "water": q_water,
    "water_rel": q_water_rel,
    "water_10min": q_water_10min,
    "water_rel_10min": q_water_rel_10min,
    "evaporation": q_evaporation,
    "evaporation_10min": q_evaporation_10min,
    "temperatures": q_temperatures,
    "temperatures_10min": q_temperatures_10min,
    "enrich_readings": q_enrich_readings,
    "rejected_payloads": q_rejected_payloads,
    "signature_check": q_signature_check,
    "sensor_channel": q_sensor_channel,
    "parse_timestamps": q_parse_timestamps,
    "json_project": q_json_project,
    "landed_lines": q_landed_lines,
    "onewire_payload": q_onewire_payload,
    "observation_payload": q_observation_payload,
    "burst_stats": q_burst_stats,
    "calibrated_weight": q_calibrated_weight,
    "snapshot_since": q_snapshot_since,
    "history_age": q_history_age,
    "shared_key_snapshot": q_shared_key_snapshot,
    "latest_by_key": q_latest_by_key,
    "one_series": q_one_series,
    "latest_point": q_latest_point,
    "csv_export": q_csv_export,
    "series_points": q_series_points,
    "series_distinct": q_series_distinct,
    "y_range": q_y_range,
    "export_rows": q_export_rows,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "fanout": q_fanout,
}
