import datetime as dt
import json

from pyspark.sql import functions as F

from terrarium.operators import serve
from terrarium.plans import registry as R
from terrarium.schema import LOG, READING
from terrarium.sources.log import FileLog, compacted, decode, latest_by_key


def rec(topic, part, off, value, key=None, ts=dt.datetime(2024, 1, 1)):
    return (key.encode() if key else None, value.encode(), topic, part, off, ts)


def test_decode_splits_corrupt(spark):
    rows = [rec("readings", 0, 0, json.dumps({"timestamp": "2024-01-01 00:00:05 -0000",
                                              "sensor": "a", "lux": 5})),
            rec("readings", 0, 1, "{not json"),
            rec("readings", 0, 2, json.dumps({"sensor": "b", "lux": 1.5})),
            rec("readings", 0, 3, json.dumps({"timestamp": "2024-01-01 00:00:06 +0000", "tags": None}))]
    good, corrupt = decode(spark.createDataFrame(rows, LOG), READING, ntz=True)
    g = {r["offset"]: r for r in good.collect()}
    assert [r["offset"] for r in corrupt.collect()] == [1]
    assert g[0]["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 5) and g[0]["lux"] == 5
    assert g[2]["timestamp"] is None and g[2]["lux"] is None and g[2]["sensor"] == "b"
    assert g[3]["tags"] is None


def test_latest_by_key_and_snapshot(spark):
    v = lambda t, x: json.dumps({"timestamp": t, "x": x})
    rows = [rec("a", 0, 0, v("2024-01-01 00:10:00 +0000", 1), key="k1"),
            rec("a", 0, 1, v("2024-01-01 00:10:00 +0000", 2), key="k1"),
            rec("a", 0, 2, v("2024-01-01 00:10:00 +0000", 3), key="k1"),
            rec("b", 0, 0, v("2024-01-01 00:10:00 +0000", 9), key="k1"),
            rec("a", 0, 3, v("2024-01-01 00:00:00 -0000", 4)),
            rec("a", 0, 4, v("2024-01-01 00:00:01 -0000", 5)),
            rec("a", 0, 5, json.dumps({"x": 6}))]
    df = spark.createDataFrame(rows, LOG)
    latest = latest_by_key(df.where(F.col("key").isNotNull()), ["topic", "key"], ["offset"])
    assert sorted((r["topic"], r["offset"]) for r in latest.collect()) == [("a", 2), ("b", 0)]

    snap = serve.snapshot(df, ["a", "b"])
    got = sorted((r["topic"], r["offset"]) for r in snap.collect())
    assert got == [("a", 2), ("a", 3), ("a", 4), ("b", 0)]         # no timestamp -> dropped

    bound = F.lit("2024-01-01 00:00:00").cast("timestamp")          # equal time is excluded
    snap = serve.snapshot(df, "a,b", since=bound)
    assert sorted((r["topic"], r["offset"]) for r in snap.collect()) == [("a", 2), ("a", 4), ("b", 0)]

    shared = serve.snapshot(df, ["b", "a"], shared_keys=True)       # later topic in the list wins
    keyed = [(r["topic"], r["offset"]) for r in shared.collect() if r["key"] is not None]
    assert keyed == [("a", 2)]


def _numbers(spark, *values):
    return spark.createDataFrame([(v, dt.datetime(2024, 1, 1, 0, v % 60)) for v in values], "n int, timestamp timestamp")


def _n(df):
    return sorted(json.loads(r["value"])["n"] for r in df.collect())


def test_file_log_roundtrip_positions(spark, tmp):
    log = FileLog(spark, f"{tmp}/log")
    df = spark.createDataFrame([(i, f"s{i % 3}", dt.datetime(2024, 1, 1, 0, i)) for i in range(10)],
                               "n int, sensor string, timestamp timestamp")
    log.append("t", df.where("n < 6"), position=F.col("n"), log_time=F.col("timestamp"))
    log.append("t", df.where("n >= 6"), position=F.col("n"), log_time=F.col("timestamp"))
    allr = log.scan("t")
    assert sorted(r["offset"] for r in allr.collect()) == list(range(10)) and _n(allr) == list(range(10))
    assert _n(log.scan("t", since=dt.datetime(2024, 1, 1, 0, 8))) == [8, 9]
    log.append("u", df)
    numbered = log.scan("u").select("partition", "offset")
    assert numbered.distinct().count() == 10
    log.reset(["t"])
    assert log.scan("t").count() == 0 and log.scan("t,u").count() == 10


def test_compacted_keyed_topic(spark, tmp):
    log = FileLog(spark, f"{tmp}/log")
    for rows in ([("a", 1.0), ("b", 5.0)], [("a", 2.0)]):
        df = spark.createDataFrame(rows, "sensor string, grams double").withColumn(
            "timestamp", F.lit("2024-01-01 00:10:00").cast("timestamp"))
        log.append("w-10min", df, key_cols=["timestamp", "sensor"], value_cols=["timestamp", "sensor", "grams"])
    got = {json.loads(r["key"].decode())["sensor"]: json.loads(r["value"].decode())["grams"]
           for r in compacted(log, "w-10min").collect()}
    assert got == {"a": 2.0, "b": 5.0}


def test_series_and_export(spark, tmp):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 2), 3.0, None, 20.0),
                                ("a", dt.datetime(2024, 1, 1, 0, 1), 1.0, 40.5, 21.0),
                                ("b", dt.datetime(2024, 1, 1, 0, 1), 7.0, None, None)],
                               "sensor string, timestamp timestamp_ntz, grams double, humidity double, temperature_c double")
    pts = serve.series_points(df, "sensor", "timestamp", "grams").collect()
    assert [(r["series"], r["y"]) for r in pts] == [("a", 1.0), ("a", 3.0), ("b", 7.0)]
    assert [r["y"] for r in serve.series_points(df, "sensor", "timestamp", "grams", only="b").collect()] == [7.0]
    assert sorted(r["series"] for r in serve.series_distinct(df, "sensor").collect()) == ["a", "b"]
    yr = serve.y_range(df, "grams").first()
    assert (yr["min_y"], yr["max_y"]) == (1.0, 7.0)
    rows = serve.export_rows(df)
    assert sorted(r["humidity"] for r in rows.collect()) == ["", "", "40.5"]
    serve.write_export(rows, f"{tmp}/csv")
    assert spark.read.csv(f"{tmp}/csv").count() == 3


def test_fan_out_and_jsonl(spark, tmp):
    df = spark.range(5).withColumn("sq", F.col("id") * F.col("id"))
    serve.fan_out(df, [lambda d: serve.write_jsonl(d, f"{tmp}/a"),
                       lambda d: d.write.parquet(f"{tmp}/b")])
    assert spark.read.json(f"{tmp}/a").count() == 5
    assert sorted(r["sq"] for r in spark.read.parquet(f"{tmp}/b").collect()) == [0, 1, 4, 9, 16]


def test_latest_point_upsert(spark):
    df = spark.createDataFrame([("a", 1, 10.0, 0), ("a", 1, 11.0, 1), ("a", 2, 12.0, 2)],
                               "series string, x int, y double, offset int")
    got = sorted((r["x"], r["y"]) for r in serve.latest_point(df).collect())
    assert got == [(1, 11.0), (2, 12.0)]


def test_catalog(spark, tmp):
    reg = R.default_registry()
    cat = reg.catalog(spark)
    assert cat.count() == 6
    full = R.topics_text(R.expand_catalog(cat))
    rows = {(r["title"], r["y"]): r for r in full.collect()}
    assert len(rows) == 12
    twin = rows[("weights - 10 days", "grams")]
    assert twin["data"] == ["weights-10min"] and twin["age"] == "10 days"
    assert twin["topics"] == "weights-10min"
    assert rows[("weights", "stddev")]["age"] == "2 hours"
    R.write_catalog(full, f"{tmp}/cat")
    back = R.read_catalog(spark, f"{tmp}/cat")
    assert back.count() == 12


def test_history_and_topic_reader(spark, tmp):
    from terrarium.operators.serve import history
    from terrarium.sources.log import in_log_order, topic
    log = FileLog(spark, f"{tmp}/log")
    df = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=30 * i)) for i in range(8)],
        "n int, timestamp timestamp")
    log.append("readings", df, position=F.col("n"), log_time=F.col("timestamp"), partition=F.col("n") % 2)
    h = history(log, "readings", "2 hours", asof=dt.datetime(2024, 1, 1, 3, 30))
    got = sorted(json.loads(r["value"])["n"] for r in h.collect())
    assert got == [4, 5, 6, 7]                      # 01:30 excluded (strict), 02:00..03:30 kept
    t = topic(log, "readings", batch=True)
    assert t.count() == 8 and "timestamp" in t.columns
    order = [(r["partition"], r["offset"]) for r in in_log_order(log.scan("readings")).collect()]
    assert order == sorted(order)


def _follow(log, topics, got, checkpoint, **opts):
    from terrarium.streaming import streams

    streams.tail(log, topics, lambda d, i: got.extend(_n(d)), checkpoint,
                 trigger={"availableNow": True}, **opts).awaitTermination()


def test_replayed_micro_batch_is_in_the_log_and_the_tail_once(spark, tmp):
    log, got = FileLog(spark, f"{tmp}/log"), []
    assert log.write_stream_batch("r", _numbers(spark, 1, 2), "cp", 0)
    _follow(log, "r", got, f"{tmp}/tail", whole=True)
    assert not log.write_stream_batch("r", _numbers(spark, 1, 2), "cp", 0)      # the stream failed after it
    _follow(log, "r", got, f"{tmp}/tail", whole=True)
    assert log.write_stream_batch("r", _numbers(spark, 3), "cp", 1)
    _follow(log, "r", got, f"{tmp}/tail", whole=True)
    assert got == [1, 2, 3] == _n(log.scan("r"))
    # another stream into the same topic adds to it
    assert log.write_stream_batch("r", _numbers(spark, 4), "other", 0)
    assert _n(log.scan("r")) == [1, 2, 3, 4]


def test_slow_append_is_neither_lost_nor_half_seen(spark, tmp, monkeypatch):
    """An append that is still being written while others are published."""
    from pyspark.sql.readwriter import DataFrameWriter

    log, got, snaps = FileLog(spark, f"{tmp}/log"), [], []
    log.append("r", _numbers(spark, 1))
    write = DataFrameWriter.parquet

    def slow(self, path, *a, **k):
        write(self, path, *a, **k)
        monkeypatch.setattr(DataFrameWriter, "parquet", write)     # the next ones are quick
        snaps.append(_n(log.scan("r")))
        _follow(log, "r", got, f"{tmp}/tail", snapshot=lambda d: got.extend(_n(d)))
        log.append("r", _numbers(spark, 5))
        _follow(log, "r", got, f"{tmp}/tail")
        snaps.append(_n(log.scan("r")))

    monkeypatch.setattr(DataFrameWriter, "parquet", slow)
    log.append("r", _numbers(spark, 2, 3, 4))
    _follow(log, "r", got, f"{tmp}/tail")
    assert snaps == [[1], [1, 5]] and got == [1, 5, 2, 3, 4] and _n(log.scan("r")) == [1, 2, 3, 4, 5]


def test_failed_append_leaves_nothing(spark, tmp):
    log = FileLog(spark, f"{tmp}/log")
    bad = _numbers(spark, 1, 2).withColumn("x", F.when(F.col("n") == 2, F.raise_error(F.lit("no"))).otherwise(F.lit("y")))
    try:
        log.write_stream_batch("r", bad, "cp", 0)
        raise AssertionError("it should have failed")
    except Exception as e:
        assert "no" in str(e)
    assert log.scan("r").count() == 0
    assert log.write_stream_batch("r", _numbers(spark, 1), "cp", 0) and _n(log.scan("r")) == [1]


def test_attempts_of_one_micro_batch_publish_it_once(spark, tmp, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    log, write = FileLog(spark, f"{tmp}/log"), DataFrameWriter.parquet

    def raced(self, path, *a, **k):
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        assert log.write_stream_batch("r", _numbers(spark, 1), "cp", 0)
        write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", raced)
    assert not log.write_stream_batch("r", _numbers(spark, 1), "cp", 0)
    assert _n(log.scan("r")) == [1]


def test_scans_open_only_their_topic_dates_and_hours(spark, tmp, monkeypatch):
    import pyarrow.parquet as pq

    from terrarium.sources import log as module

    log = FileLog(spark, f"{tmp}/log")
    log.append("a", _numbers(spark, *range(8)))
    days = spark.createDataFrame([(d, dt.datetime(2024, 1, d, 12)) for d in (1, 2, 3)], "n int, timestamp timestamp")
    log.append("b", days.coalesce(1), log_time=F.col("timestamp"))
    got = []
    _follow(log, "b", got, f"{tmp}/cp", whole=True)
    assert got == [1, 2, 3]
    since = log.scan("b", since=dt.datetime(2024, 1, 2))
    assert _n(since) == [2, 3]
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert len(since.inputFiles()) > 0 and all("topic=b" in f for f in since.inputFiles())
    # S4 inside a day: two hours are a small part of its row groups
    monkeypatch.setattr(module, "ROW_GROUP_BYTES", 4096)
    day = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("n")).withColumn(
        "timestamp", F.expr("timestamp_seconds(1704067200 + n * 4)"))
    log.append("c", day.coalesce(1), log_time=F.col("timestamp"))
    (file,) = [f for f in log.scan("c").inputFiles() if "date=2024-01-01" in f]
    meta = pq.ParquetFile(file.removeprefix("file://")).metadata
    at = [meta.row_group(0).column(k).path_in_schema for k in range(meta.num_columns)].index("timestamp")
    stats = [meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups)]
    assert len(stats) >= 20 and all(x.max <= y.min for x, y in zip(stats, stats[1:]))
    assert sum(x.max >= stats[-1].max - dt.timedelta(hours=2) for x in stats) <= len(stats) // 6


def test_tail_from_the_latest_record_over_several_topics_and_a_restart(spark, tmp):
    log, got = FileLog(spark, f"{tmp}/log"), []
    log.append("r", _numbers(spark, 1, 2))
    log.append("s", _numbers(spark, 3))
    _follow(log, "r,s", got, f"{tmp}/cp")
    log.append("s", _numbers(spark, 4))           # these arrive while the tail is down
    log.append("r", _numbers(spark, 5))
    _follow(log, "r,s", got, f"{tmp}/cp")
    assert sorted(got) == [4, 5]


def test_tail_of_an_empty_log_serves_what_comes(spark, tmp):
    log, got, snaps = FileLog(spark, f"{tmp}/empty-log"), [], []
    for v in (1, 2):
        _follow(log, "r", got, f"{tmp}/cp", snapshot=lambda d: snaps.append(_n(d)))
        log.append("r", _numbers(spark, v))
    _follow(log, "r", got, f"{tmp}/cp", snapshot=lambda d: snaps.append(_n(d)))
    assert got == [1, 2] and snaps == []
