import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, MapType, StringType, StructField, StructType,
                               TimestampNTZType)

from terrarium.operators import clean, derive
from terrarium.operators.clean import CapRule, RetireRule
from terrarium.operators.rollup import rollup

SCHEMA = StructType([
    StructField("timestamp", TimestampNTZType()),
    StructField("grams", DoubleType()),
    StructField("stddev", DoubleType()),
    StructField("temperature_c", DoubleType()),
    StructField("tags", MapType(StringType(), StringType())),
])

T0 = dt.datetime(2024, 1, 20)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _and(a, b):  # SQL three-valued AND
    if a is False or b is False:
        return False
    if a is None or b is None:
        return None
    return True


def _keep(sensor, grams, ts):
    def eq(x, y):
        return None if x is None else x == y

    def gt(x, y):
        return None if x is None else x > y

    def ge(x, y):
        return None if x is None else x >= y

    cap = _and(eq(sensor, "click"), gt(grams, 500.0))
    ret = _and(eq(sensor, "view"), ge(ts, T0))
    keep = lambda v: None if v is None else not v
    return keep(cap) is True and keep(ret) is True


def test_cap_and_retire_truth_table(spark):
    sensors = [None, "other", "click", "view"]
    grams = [None, 400.0, 500.0, 600.0]
    times = [None, T0 - dt.timedelta(seconds=1), T0, T0 + dt.timedelta(seconds=1)]
    rows, expected = [], []
    for i, (s, g, t) in enumerate(itertools.product(sensors, grams, times)):
        tags = {"plant": s} if s is not None else {}
        rows.append((t, g, float(i), 0.0, tags))
        if _keep(s, g, t):
            expected.append(float(i))
    df = frame(spark, rows)
    out = df.withColumn("sensor", F.try_element_at("tags", F.lit("plant")))
    for rule in (CapRule("click", 500.0),):
        out = out.where(clean.cap_predicate(rule))
    out = out.where(clean.retire_predicate(RetireRule("view", "2024-01-20"),
                                           out.schema["timestamp"].dataType))
    got = sorted(r["stddev"] for r in out.collect())
    assert got == sorted(expected)
    # a null sensor over the cap is dropped, under it kept
    assert any(s is None and g == 400.0 for s, g, _ in itertools.product(sensors, grams, times))


def test_weight_window_and_quality(spark):
    rows = [(T0, g, 1.0, 0.0, {"plant": "p"}) for g in (200.0, 200.1, 9999.9, 10000.0)]
    rows += [(T0, 300.0, None, 0.0, {"plant": "p"}), (T0, None, 1.0, 0.0, {"plant": "p"}),
             (T0, 300.0, 200.0, 0.0, {"plant": "p"}), (T0, 300.0, 199.9, 0.0, {})]
    out = clean.clean_weights(frame(spark, rows), caps=(), retires=())
    got = sorted((r["grams"], r["sensor"]) for r in out.collect())
    assert got == [(200.1, "p"), (300.0, None), (9999.9, "p")]


def test_reference_defaults(spark):
    rows = [(dt.datetime(2017, 2, 26), 1900.0, 1.0, 0.0, {"plant": "ficus"}),
            (dt.datetime(2017, 2, 26), 1700.0, 1.0, 0.0, {"plant": "ficus"}),
            (dt.datetime(2017, 2, 27), 500.0, 1.0, 0.0, {"plant": "plumeria"}),
            (dt.datetime(2017, 2, 26, 23, 59, 59), 500.0, 1.0, 0.0, {"plant": "plumeria"})]
    out = clean.clean_weights(frame(spark, rows))
    assert sorted((r["sensor"], r["grams"]) for r in out.collect()) == [
        ("ficus", 1700.0), ("plumeria", 500.0)]


def test_temperatures_sentinel(spark):
    rows = [(T0, None, None, c, {"user": "u"}) for c in (-999.0, None, 21.5)]
    out = clean.clean_temperatures(frame(spark, rows))
    assert [(r["temperature_c"], r["sensor"]) for r in out.collect()] == [(21.5, "u")]


def _ts(h, m, s):
    return dt.datetime(2024, 1, 1, h, m, s)


def test_rollup_window_boundaries(spark):
    times = [_ts(0, 0, 0), _ts(0, 4, 59), _ts(0, 5, 0), _ts(0, 9, 59), _ts(0, 10, 0), None]
    rows = [(t, float(i), 0.0, 0.0, {"plant": "a"}) for i, t in enumerate(times)]
    df = frame(spark, rows).withColumn("sensor", F.col("tags")["plant"])
    ten = {r["timestamp"]: r["grams"] for r in rollup(df, ["grams"], ["sensor"]).collect()}
    assert ten == {_ts(0, 0, 0): 1.5, _ts(0, 10, 0): 4.0}
    five = rollup(df, ["grams"], ["sensor"], width="5 minutes", label="end").collect()
    assert {r["timestamp"]: r["grams"] for r in five} == {
        _ts(0, 5, 0): 0.5, _ts(0, 10, 0): 2.5, _ts(0, 15, 0): 4.0}


def test_rollup_null_key_own_group_and_global(spark):
    rows = [(_ts(0, 1, 0), 1.0, 0.0, 0.0, {"plant": "a"}), (_ts(0, 2, 0), 3.0, 0.0, 0.0, {}),
            (_ts(0, 3, 0), 5.0, 0.0, 0.0, {})]
    df = frame(spark, rows).withColumn("sensor", F.col("tags")["plant"])
    keyed = {r["sensor"]: r["grams"] for r in rollup(df, ["grams"], ["sensor"]).collect()}
    assert keyed == {"a": 1.0, None: 4.0}
    assert rollup(df, ["grams"]).first()["grams"] == 3.0


def _weights(spark, rows):
    return frame(spark, [(t, g, 1.0, 0.0, {"plant": s}) for s, t, g in rows]).withColumn(
        "sensor", F.col("tags")["plant"])


def test_water_rel_min_equals_max_is_null(spark):
    w = _weights(spark, [("flat", _ts(0, 1, 0), 500.0), ("flat", _ts(0, 2, 0), 500.0),
                         ("up", _ts(0, 1, 0), 400.0), ("up", _ts(0, 2, 0), 600.0)])
    got = {(r["sensor"], r["grams"]): r["water"]
           for r in derive.water_rel(w, derive.ranges(w)).collect()}
    assert got[("flat", 500.0)] is None
    assert got[("up", 600.0)] == 1.0 and got[("up", 400.0)] == 0.0


def test_join_drops_sensors_without_range(spark):
    w = _weights(spark, [("a", _ts(0, 1, 0), 500.0), ("b", _ts(0, 1, 0), 700.0)])
    rng = spark.createDataFrame([("a", 400.0, 800.0), ("c", 1.0, 2.0)], "sensor string, min double, max double")
    got = [(r["sensor"], r["water"]) for r in derive.water(w, rng).collect()]
    assert got == [("a", 100.0)]


def test_loss_ties_and_single_point(spark):
    # two points at the first time (smallest grams wins), two at the last (largest wins)
    w = _weights(spark, [("a", _ts(0, 0, 10), 520.0), ("a", _ts(0, 0, 10), 510.0),
                         ("a", _ts(0, 3, 0), 505.0), ("a", _ts(0, 3, 0), 500.0),
                         ("b", _ts(0, 1, 0), 900.0)])
    out = derive.loss(w, derive.ranges(w)).collect()
    assert [(r["timestamp"], r["sensor"], r["ml_hour"]) for r in out] == [
        (_ts(0, 5, 0), "a", 5.0)]
    assert out[0]["rate_per_hour"] == pytest.approx(60.0)


def test_loss_end_label_rolls_into_next_bucket(spark):
    w = _weights(spark, [("a", _ts(0, 5, 1), 520.0), ("a", _ts(0, 9, 0), 510.0)])
    ev = derive.loss(w, derive.ranges(w))
    r10 = rollup(ev, ["ml_hour"], ["sensor"]).collect()
    assert [(r["timestamp"], r["ml_hour"]) for r in r10] == [(_ts(0, 10, 0), 10.0)]


def test_loss_self_ranges_equals_join(spark):
    w = _weights(spark, [("a", _ts(0, 0, 10), 520.0), ("a", _ts(0, 3, 0), 500.0),
                         (None, _ts(0, 1, 0), 900.0), (None, _ts(0, 4, 0), 880.0)])
    a = derive.loss(w, derive.ranges(w)).collect()
    b = derive.loss(w, None).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 1
