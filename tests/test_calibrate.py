import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from terrarium.operators import calibrate
from terrarium.operators.asof import asof_join


def _t(m):
    return dt.datetime(2024, 1, 1, 0, m, 0)


def test_burst_stats_long_form(spark):
    rows = [("n1", _t(0), 0, 5.0),
            ("n2", _t(0), 0, 1.0), ("n2", _t(0), 1, 3.0),
            ("n3", _t(0), 0, 1.0), ("n3", _t(0), 1, 2.0), ("n3", _t(0), 2, 6.0),
            ("n4", _t(0), 0, 1.0), ("n4", _t(0), 1, 2.0), ("n4", _t(0), 2, 4.0), ("n4", _t(0), 3, 9.0)]
    rows += [("n10", _t(0), i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "sensor string, reading_ts timestamp_ntz, i int, v double")
    got = {r["sensor"]: r for r in calibrate.burst_stats(df).collect()}
    assert got["n1"]["stddev"] is None and got["n1"]["raw"] == 5.0
    assert got["n2"]["stddev"] is None and got["n2"]["raw"] == 2.0
    assert got["n3"]["raw"] == 3.0
    assert got["n3"]["stddev"] == pytest.approx(math.sqrt(14.0 / 1))
    assert got["n4"]["raw"] == 4.0
    assert got["n4"]["stddev"] == pytest.approx(4.358898943540674)
    s = sum((i - 4.5) ** 2 for i in range(10))
    assert got["n10"]["stddev"] == pytest.approx(math.sqrt(s / 8))


def test_burst_stats_array_form_matches(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0, 9.0],), ([5.0],), ([1.0, 3.0],), ([],)],
                               "s array<double>")
    n, raw, sd = calibrate.burst_stats_array(F.col("s"))
    got = [tuple(r) for r in df.select(n, raw, sd).collect()]
    assert got[0][0] == 4 and got[0][1] == 4.0 and got[0][2] == pytest.approx(4.358898943540674)
    assert got[1] == (1, 5.0, None)
    assert got[2] == (2, 2.0, None)
    assert got[3] == (0, None, None)


CAL = [("s1", "zero", _t(10), 100.0), ("s1", "1kg", _t(10), 1100.0),
       ("s1", "zero", _t(20), 200.0),          # zero saved again: latest wins
       ("s2", "zero", _t(5), 50.0),            # only zero saved
       ("s3", "zero", _t(40), 10.0)]           # saved after the reading: ignored
READ = [("s1", _t(15), 600.0), ("s1", _t(25), 700.0), ("s1", _t(10), 600.0),
        ("s2", _t(30), 1050.0), ("s3", _t(30), 500.0), ("s4", _t(30), 500.0)]


@pytest.mark.parametrize("seconds", [60, 600, 86_400])
def test_calibrated(spark, seconds):
    cal = spark.createDataFrame(CAL, "sensor string, point string, ts timestamp_ntz, raw double")
    rd = spark.createDataFrame(READ, "sensor string, timestamp timestamp_ntz, raw double")
    out = calibrate.calibrated(rd, cal, bucket_seconds=seconds)
    got = {(r["sensor"], r["timestamp"]): (r["zero"], r["one_kg"], r["grams"]) for r in out.collect()}
    assert got[("s1", _t(10))] == (100.0, 1100.0, 500.0)        # same-time press applies
    assert got[("s1", _t(15))] == (100.0, 1100.0, 500.0)
    assert got[("s1", _t(25))][:2] == (200.0, 1100.0)
    assert got[("s1", _t(25))][2] == pytest.approx(500000.0 / 900.0)
    assert got[("s2", _t(30))][:2] == (50.0, 1000.0)            # 1kg defaults to 1000
    assert got[("s2", _t(30))][2] == pytest.approx(1000.0 * 1000.0 / 950.0)
    assert got[("s3", _t(30))] == (1000.0, 1000.0, None)        # later save ignored
    assert got[("s4", _t(30))] == (1000.0, 1000.0, None)        # never saved
    assert len(got) == len(READ)


def test_asof_against_brute_force(spark):
    import bisect

    start = dt.datetime(2024, 1, 1)
    left = [(str(i % 7), start + dt.timedelta(seconds=37 * i)) for i in range(2000)] + [(None, start), ("1", None)]
    right = [(str(i % 5), start + dt.timedelta(seconds=511 * (i // 2)), float(i)) for i in range(200)] + [
        ("2", None, 1.0), (None, start, 2.0)]
    times: dict = {}
    for k, t, v in right:
        if k is not None and t is not None:
            times.setdefault(k, {})[t] = max(v, times.get(k, {}).get(t, v))
    want = []
    for k, t in left:
        own = sorted(times.get(k, {}).items()) if t is not None else []
        at = bisect.bisect_right([x for x, _ in own], t) if own else 0
        want.append((k, t, own[at - 1][1] if at else None))
    lf = spark.createDataFrame(left, "k string, t timestamp_ntz")
    rf = spark.createDataFrame(right, "k string, rt timestamp_ntz, v double")
    for seconds in (60, 900, 86_400):
        got = [tuple(r) for r in asof_join(lf, rf, ["k"], "t", "rt", ["v"], bucket_seconds=seconds).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_asof_of_a_hot_key_with_an_old_open_row_stays_small(spark):
    """One sensor, many presses, one of them from 1970: no row is spread over
    the time in between, and no reading meets all presses."""
    left = spark.range(0, 20_000).select(F.lit("s").alias("k"), (
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 7)).alias("t"))
    right = spark.range(0, 4000).select(F.lit("s").alias("k"), (
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 29)).alias("rt"),
        F.col("id").cast("double").alias("v"))
    right = right.unionByName(spark.createDataFrame([("s", dt.datetime(1970, 1, 2), -1.0)],
                                                    "k string, rt timestamp_ntz, v double"))
    out = asof_join(left, right, ["k"], "t", "rt", ["v"])
    assert out.count() == 20_000 and out.where("v is null").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
