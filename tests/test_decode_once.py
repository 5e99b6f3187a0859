"""A value of the log is parsed once, whatever is asked of it."""

from pyspark.sql import functions as F

from terrarium.schema import EXTENDED, LOG
from terrarium.sources.log import decode


def _records(spark, values):
    rows = [(None, None if v is None else bytearray(v, "utf-8"), "readings", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LOG)


def test_decode_parses_each_value_once(spark):
    good, corrupt = decode(_records(spark, ['{"sensor":"a","lux":1.5,"grams":2.0}', '{"sensor":"b"', "7", None]), schema=EXTENDED)
    for df in (good, corrupt, good.where(F.col("grams") > 1).groupBy("sensor").agg(F.max("grams"))):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [(r.offset, r.sensor, r.lux, r.grams) for r in good.collect()] == [(0, "a", None, 2.0)]
    assert sorted((r.offset, r.value) for r in corrupt.collect()) == [(1, '{"sensor":"b"'), (2, "7"), (3, None)]
