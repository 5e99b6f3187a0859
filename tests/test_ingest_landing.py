import datetime as dt
import hashlib
import hmac
import json

import pytest

from terrarium.operators import ingest
from terrarium.sources import landing

KEY = "test-key"


def sign(body, key=KEY):
    return hmac.new(key.encode(), body.encode(), hashlib.sha1).hexdigest()


def payloads(spark):
    known = json.dumps({"sensor": "aa:bb:cc:dd:ee:01-dht", "sec": 1488189600, "usec": 500000,
                        "temperature_c": 21})
    own_tags = json.dumps({"sensor": "ffeeddccbbaa-weight", "timestamp": "2017-02-27 10:00:00 -0000",
                           "grams": 512.5, "tags": {"plant": "fern"}})
    frac = json.dumps({"sensor": "aabbccddee01-dht", "sec": 1488189601, "usec": 0,
                       "temperature_c": 21.5})
    tampered = json.dumps({"sensor": "aabbccddee01-dht", "temperature_c": 30})
    rows = [("known", known, sign(known)),
            ("own_tags", own_tags, sign(own_tags)),
            ("frac", frac, sign(frac)),
            ("tampered", tampered.replace("30", "31"), sign(tampered)),
            ("wrong_key", known, sign(known, "other")),
            ("empty", known, ""),
            ("missing", known, None)]
    return spark.createDataFrame(rows, "id string, body string, signature string")


def tags(spark):
    return spark.createDataFrame([("aabbccddee01", {"user": "u1", "plant": "ficus"})],
                                 "mac string, tags map<string,string>")


def test_enrich_accept_reject(spark):
    accepted, rejected = ingest.enrich(payloads(spark), tags(spark), KEY)
    assert sorted(r["id"] for r in rejected.collect()) == ["empty", "missing", "tampered", "wrong_key"]
    assert {r["reason"] for r in rejected.collect()} == {ingest.INVALID_SIGNATURE}
    got = {r["id"]: r for r in accepted.collect()}
    assert set(got) == {"known", "own_tags", "frac"}
    k = got["known"]
    assert k["sensor"] == "aabbccddee01-dht" and k["mac"] == "aabbccddee01"
    assert k["timestamp"] == "2017-02-27 10:00:00 -0000"      # from sec, whole seconds
    assert k["temperature_f"] == pytest.approx(69.8)           # integer °C, double division
    assert k["tags"] == {"user": "u1", "plant": "ficus"}       # known MAC: tags replaced
    assert got["frac"]["temperature_f"] == pytest.approx(70.7)
    o = got["own_tags"]
    assert o["timestamp"] == "2017-02-27 10:00:00 -0000"       # no sec: kept
    assert o["tags"] == {"plant": "fern"}                      # unknown MAC keeps its own
    assert o["temperature_f"] is None


def _signed(spark, rows):
    """(id, body, upper-case signature?) -> signed payloads."""
    import hashlib
    import hmac

    key = KEY if isinstance(KEY, bytes) else KEY.encode()
    out = []
    for i, body, upper in rows:
        sig = hmac.new(key, body.encode(), hashlib.sha1).hexdigest()
        out.append((i, body, sig.upper() if upper else sig))
    return spark.createDataFrame(out, "id string, body string, signature string")


def test_upper_case_signature_malformed_body_and_unknown_field(spark):
    good = '{"sensor":"aabbccddee01-dht","temperature_c":21,"firmware":{"v":7},"note":"x"}'
    rows = [("good", good, False), ("upper", good, True), ("text", "not json", False), ("cut", good[:30], False),
            ("list", "[1]", False), ("type", '{"temperature_c":"warm"}', False), ("empty", "", False)]
    accepted, rejected = ingest.enrich(_signed(spark, rows), tags(spark), KEY)
    got = {r["id"]: r for r in accepted.collect()}
    assert set(got) == {"good"} and got["good"]["body"] == good
    assert {k: v.toPython() for k, v in got["good"]["extra"].items()} == {"firmware": {"v": 7}, "note": "x"}
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {
        "upper": ingest.INVALID_SIGNATURE, **{k: ingest.MALFORMED_BODY for k in ("text", "cut", "list", "type", "empty")}}


def test_one_parse_and_one_signature_a_payload(spark, tmp):
    payloads(spark).write.parquet(f"{tmp}/p")
    accepted, rejected = ingest.enrich(spark.read.parquet(f"{tmp}/p"), tags(spark), KEY)
    for df, parses in ((accepted, 1), (rejected, 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parsejson(") == parses and plan.count("unhex") <= 4, plan


def test_unknown_fields_keep_their_types_into_the_log(spark, tmp):
    from terrarium.sources.log import FileLog

    body = json.dumps({"sensor": "aabbccddee01-dht", "temperature_c": 21, "fw": {"v": 7, "ok": [True, None, 1.5]},
                       "n": 3, "none": None, "tags": None, "lux": None})
    accepted, _ = ingest.enrich(_signed(spark, [("x", body, False)]), tags(spark), KEY)
    log = FileLog(spark, f"{tmp}/log")
    log.append("readings", accepted.select("sensor", "temperature_c", "extra"))
    (record,) = log.scan("readings").collect()
    assert json.loads(record["value"])["extra"] == {"fw": {"v": 7, "ok": [True, None, 1.5]}, "n": 3, "none": None}


def test_joins_see_files_that_others_add(spark, tmp):
    """A dimension or a history that grows between two calls is read anew."""
    from terrarium.operators import derive

    def readings(sensor, grams):
        return spark.createDataFrame([(sensor, g, dt.datetime(2024, 1, 1, 0, m)) for m, g in enumerate(grams)],
                                     "sensor string, grams double, timestamp timestamp_ntz")

    def water():
        df = spark.read.parquet(f"{tmp}/weights")
        return {(r["sensor"], r["grams"]): r["water"] for r in derive.water(df, derive.ranges(df)).collect()}

    readings("s1", [10.0, 14.0]).write.parquet(f"{tmp}/weights")
    assert water() == {("s1", 10.0): 0.0, ("s1", 14.0): 4.0}
    readings("s1", [2.0]).unionByName(readings("s2", [5.0])).write.mode("append").parquet(f"{tmp}/weights")
    assert water() == {("s1", 10.0): 8.0, ("s1", 14.0): 12.0, ("s1", 2.0): 0.0, ("s2", 5.0): 0.0}

    body = '{"sensor":"aabbccddee99-dht","temperature_c":21}'
    for plant in ("ficus", "fern"):
        spark.createDataFrame([("aabbccddee99", {"plant": plant})], "mac string, tags map<string,string>").write.mode(
            "overwrite").parquet(f"{tmp}/tags")
        accepted, _ = ingest.enrich(_signed(spark, [("a", body, False)]), spark.read.parquet(f"{tmp}/tags"), KEY)
        assert accepted.first()["tags"] == {"plant": plant}


def test_scale_lines(spark):
    df = spark.createDataFrame([("1.5,kg",), ("1.5",), ("",), ("x,kg",), (" 2.0 ,kg,extra",)],
                               "line string")
    got = {r["line"]: r["weight"] for r in landing.scale_lines(df).collect()}
    assert set(got) == {"1.5,kg", "x,kg", " 2.0 ,kg,extra"}
    assert got["1.5,kg"] == pytest.approx((1.5 + 40.77) * 1000 + 1.6)
    assert got["x,kg"] is None


def test_onewire(spark):
    ok = "72 01 4b 46 7f ff 0e 10 57 : crc=57 YES\n72 01 4b 46 7f ff 0e 10 57 t=23125\n"
    rows = [("ok", ok), ("no", ok.replace("YES", "NO")),
            ("neg", ok.replace("t=23125", "t=-1250")),
            ("four", ok.replace("t=23125", "t=9500")),
            ("six", ok.replace("t=23125", "t=101000")), ("junk", "YES")]
    df = spark.createDataFrame(rows, "id string, payload string")
    got = {r["id"]: r["temperature_c"] for r in landing.onewire(df).collect()}
    assert got == {"ok": 23.125, "neg": -1.25, "four": 9.5, "six": 101.0}


def test_observations(spark):
    js = json.dumps({"current_observation": {"observation_time_rfc822": "Mon, 27 Feb 2017 10:00:00 -0800",
                                             "temp_c": 12.5, "station_id": "KX"}})
    df = spark.createDataFrame([("home", js)], "name string, json string")
    r = landing.observations(df).first()
    assert r["sensor"] == "home" and r["temp_c"] == 12.5
    assert r["timestamp"].replace(tzinfo=None) == dt.datetime(2017, 2, 27, 18, 0, 0)
