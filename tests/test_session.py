from terrarium.session import conf_scope, ensure_utc, shared_dir


def test_conf_scope_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with conf_scope(spark, {"spark.sql.shuffle.partitions": 3}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_dir_under_checkpoint_dir(spark):
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    base = shared_dir(spark)
    a = shared_dir(spark, "x", unique=True)
    b = shared_dir(spark, "x", unique=True)
    assert a.startswith(base) and b.startswith(base) and a != b
