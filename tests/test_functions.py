import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from terrarium.functions import expr as X


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text", [
    "2017-02-27 10:00:00 -0000", "2017-02-27 10:00:00 +0000", "2017-02-27 10:00:00 -0800",
    "2017-02-27 10:00:00"])
def test_parse_ts_ignores_zone_suffix(spark, text):
    assert one(spark, lambda c: X.parse_ts(c, ntz=True), text) == dt.datetime(2017, 2, 27, 10, 0, 0)


@pytest.mark.parametrize("text", ["garbage", "", None, "2017-02-31 10:00:00", "27/02/2017 10:00"])
def test_parse_ts_malformed_is_null(spark, text):
    assert one(spark, lambda c: X.parse_ts(c, ntz=True), text) is None


def test_parse_ts_keeps_fraction(spark):
    got = one(spark, lambda c: X.parse_ts(c, ntz=True), "2024-01-01 00:00:07.179575 -0000")
    assert got == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


@pytest.mark.parametrize("text,expected", [
    ("2017-02-27 10:00:00 -0800", dt.datetime(2017, 2, 27, 18, 0, 0)),
    ("2017-02-27 10:00:00 +0000", dt.datetime(2017, 2, 27, 10, 0, 0)),
    ("2017-02-27 10:00:00 -0000", dt.datetime(2017, 2, 27, 10, 0, 0)),
    ("Mon, 27 Feb 2017 10:00:00 -0800", dt.datetime(2017, 2, 27, 18, 0, 0)),
    ("2017-02-27T10:00:00", dt.datetime(2017, 2, 27, 10, 0, 0)),
    ("not a time", None),
])
def test_parse_ts_any_honours_zone(spark, text, expected):
    got = one(spark, lambda c: X.parse_ts_any(c).cast("timestamp_ntz"), text)
    assert got == expected


def test_format_ts_utc(spark):
    got = spark.range(1).select(
        X.format_ts(F.lit("2017-02-27 10:00:00").cast("timestamp")).alias("r")).first()["r"]
    assert got == "2017-02-27 10:00:00 +0000"


def test_epoch_and_millis(spark):
    r = spark.range(1).select(
        X.reading_time_text(X.epoch_ts(F.lit(1488189600))).alias("t"),
        X.to_millis(F.lit("2017-02-27 10:00:00.123456").cast("timestamp_ntz")).alias("ms")).first()
    assert r["t"] == "2017-02-27 10:00:00 -0000"
    assert r["ms"] == 1488189600123


def test_now_text_injectable(spark):
    got = spark.range(1).select(X.now_text(dt.datetime(2020, 5, 1, 12, 30, 15)).alias("r")).first()["r"]
    assert got == "2020-05-01 12:30:15 -0000"


@pytest.mark.parametrize("key", ["k", "secret-key", "x" * 100, "clé"])
@pytest.mark.parametrize("body", ['{"sensor":"a"}', "", "ünïcödé body"])
def test_hmac_matches_stdlib(spark, key, body):
    expected = hmac.new(key.encode(), body.encode(), hashlib.sha1).hexdigest()
    assert one(spark, lambda c: X.hmac_sha1_hex(c, key), body) == expected


def test_c_to_f_double(spark):
    assert one(spark, X.c_to_f, 21, "int") == pytest.approx(69.8)
    assert one(spark, X.c_to_f, -40.0, "double") == pytest.approx(-40.0)


def test_calibrate(spark):
    r = spark.range(1).select(
        X.calibrate(F.lit(1500.0), F.lit(1000.0), F.lit(1000.0)).alias("same"),
        X.calibrate(F.lit(1500.0), F.lit(1000.0), F.lit(2000.0)).alias("half")).first()
    assert r["same"] is None
    assert r["half"] == pytest.approx(500.0)


def test_scale_fixed(spark):
    assert one(spark, X.scale_fixed, 1.5, "double") == pytest.approx((1.5 + 40.77) * 1000 + 1.6)


def test_ids(spark):
    r = spark.createDataFrame([("68:c6:3a:9f:b1:5c-weight",), ("68c63a9fb15c",)], "s string").select(
        X.sensor_id("s").alias("id"), X.mac(X.sensor_id("s")).alias("mac"),
        X.channel(X.sensor_id("s")).alias("ch")).collect()
    assert [tuple(x) for x in r] == [("68c63a9fb15c-weight", "68c63a9fb15c", "weight"),
                                    ("68c63a9fb15c", "68c63a9fb15c", "")]


def test_tag_missing_is_null(spark):
    df = spark.createDataFrame([({"user": "a"},), (None,)], "tags map<string,string>")
    got = [r["p"] for r in df.select(X.tag("plant").alias("p")).collect()]
    assert got == [None, None]


def test_age_delta():
    assert X.age_delta("2 hours") == dt.timedelta(hours=2)
    assert X.age_delta("10 days") == dt.timedelta(days=10)
    assert X.age_delta("1 week") == dt.timedelta(days=7)
    with pytest.raises(ValueError):
        X.age_delta("2 fortnights")
    with pytest.raises(ValueError):
        X.age_delta("1 month")
