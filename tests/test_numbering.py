import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrarium.operators.numbering import number_within
from terrarium.plans import named, oracle
from terrarium.sources import events as EV

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark, rows):
    """Rows of (event_id, minute, user_id, value)."""
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), u, "click", v, '{"k": 20}')
                                  for i, m, u, v in rows], EVENTS)


def test_equals_row_number(spark):
    # one group holds most rows, most numbers lie close together, some are far off
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 4).alias("g"),
        F.when(F.col("id") < 100, F.col("id") * 10**12).otherwise(-((F.col("id") * 7919) % 20011)).alias("o"), F.col("id"))
    got = number_within(df, ["g"], "o")
    exp = df.withColumn("offset", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert sorted((r.id, r.offset) for r in got.collect()) == sorted((r.id, r.offset) for r in exp.collect())


def test_null_groups_null_order_ties_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", None), ("a", 3), ("b", 7), ("b", 7)], "g string, o int")
    got = sorted(((r.g, r.o, r.offset) for r in number_within(df, ["g"], "o").collect()), key=str)
    assert got == [("a", 3, 0), ("a", None, 1), ("b", 7, 0), ("b", 7, 1), (None, 1, 0), (None, 2, 1)]
    assert number_within(df.where("false"), ["g"], "o").count() == 0


def test_no_task_holds_a_whole_group(spark):
    df = number_within(spark.range(0, 40000).select(F.lit(1).alias("g"), "id"), ["g"], "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(rows) == 40000 and max(rows) < 30000


def _written(spark, tmp, rows):
    _events(spark, rows).write.parquet(f"{tmp}/events.parquet")
    return tmp


def _sql(tmp, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp}/events.parquet/*.parquet')")
    return sorted(con.execute(oracle.SQL[name]).fetchall(), key=str)


def test_projected_offsets_number_each_log_partition(spark, tmp):
    rows = [(10 * i + 7, i, i % 6, 20.0 + i) for i in range(60)]
    got = named.q_json_project(spark, _written(spark, tmp, rows))
    own = {}
    for r in sorted(got.collect(), key=lambda r: r.timestamp):
        own.setdefault(r.partition, []).append(r.offset)
    assert own == {p: list(range(len(v))) for p, v in own.items()} and len(own) == 4
    assert sorted(map(tuple, got.collect()), key=str) == _sql(tmp, "json_project")


def test_latest_offsets_number_each_log_partition(spark, tmp):
    # 3 records of a key, 4 log partitions by window; what is not a weight has no number
    rows = [(100 - i if i % 2 else 100 + i, 3 * i, 1, 20.0 + i if i % 5 else 1.0) for i in range(40)]
    got = named.q_latest_by_key(spark, _written(spark, tmp, rows)).collect()
    assert sorted(map(tuple, got), key=str) == _sql(tmp, "latest_by_key")
    weights = 32
    assert all(r.offset < weights for r in got) and min(r.event_id for r in _events(spark, rows).collect()) > weights


def test_stored_records_keep_the_callers_offsets(spark):
    recs = EV.log_from_events(_events(spark, [(7, 0, 1, 30.0), (3, 1, 1, 30.0)]))
    assert sorted(r.offset for r in recs.collect()) == [3, 7]
