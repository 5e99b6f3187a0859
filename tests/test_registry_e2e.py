import datetime as dt
import json

from pyspark.sql import functions as F

from terrarium.operators import clean
from terrarium.plans import fixture as FX
from terrarium.plans.registry import Context, default_registry
from terrarium.schema import EXTENDED, LOG
from terrarium.sources.events import load, readings_from_events
from terrarium.sources.log import decode, topic

from conftest import SF001


def test_registry_batch_matches_fixture_counts(spark):
    reg = default_registry(lo=FX.LO, hi=FX.HI, max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                           retires=FX.RETIRES)
    readings = readings_from_events(load(spark, SF001, "events"))
    ctx = Context(spark, lambda: readings,
                  lambda: reg.datasets["weights"].fn(Context(spark, lambda: readings))
                  .groupBy("sensor").agg(F.min("grams").alias("min"), F.max("grams").alias("max")))
    frames = reg.batch(ctx)
    assert set(frames) == {n + s for n in ("weights", "water", "water_rel", "evaporation",
                                           "temperatures") for s in ("", "-10min")}
    assert frames["weights"].count() == 545
    assert frames["weights"].where(F.col("sensor").isNull()).count() == 53
    assert frames["weights-10min"].count() == 542
    assert frames["evaporation"].count() == 0          # empty at sf0.001 (FIXTURES 3)
    assert frames["water"].count() == 545 - 53          # null sensors have no range
    assert len(reg.specs()) == 6


def _log(spark, values):
    rows = [(None, (v if isinstance(v, str) else json.dumps(v)).encode(), "readings", 0, i,
             dt.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LOG)


class _Log:
    def __init__(self, df):
        self.df = df

    def scan(self, name, batch=True, **_):
        return self.df.where(F.col("topic") == name)


def test_reading_edge_rows_through_log(spark):
    t = "2017-02-27 10:00:00"
    values = [
        "{malformed",
        {"sensor": "a", "grams": 500.0, "stddev": 1.0, "tags": {"plant": "p"}},        # no time
        {"timestamp": t + " -0000", "grams": 500.0, "stddev": 1.0, "tags": {"plant": "p"}},
        {"timestamp": t + " +0000", "grams": 200.1, "stddev": 1.0, "tags": {"plant": "p"}},
        {"timestamp": t + " -0800", "grams": 9999.9, "stddev": 1.0, "tags": {"user": "u"}},
        {"timestamp": t + " -0000", "grams": 200.0, "stddev": 1.0},                     # at lo
        {"timestamp": t + " -0000", "grams": 10000.0, "stddev": 1.0},                   # at hi
        {"timestamp": t + " -0000", "grams": 500.0},                                    # null stddev
        {"timestamp": t + " -0000", "grams": 500.0, "stddev": 1.0, "lux": 1.5},         # fractional lux
        {"timestamp": t + " -0000", "temperature_c": -999, "tags": {"user": "u"}},
        {"timestamp": t + " -0000", "temperature_c": None, "tags": {"user": "u"}},
        {"timestamp": t + " -0000", "temperature_c": 20.5, "tags": {"user": "u"}},
    ]
    log = _Log(_log(spark, values))
    good, corrupt = decode(log.scan("readings"), EXTENDED, ntz=True)
    assert corrupt.count() == 1
    r = topic(log, "readings", schema=EXTENDED, batch=True, ntz=True)
    w = clean.clean_weights(r, caps=(), retires=()).orderBy("offset").collect()
    # row 1 has no time (weights keep it; windows drop it), 5 and 6 sit on the
    # open bounds, 7 has no stddev; 4 and 8 have no plant tag
    assert [(x["offset"], x["grams"], x["sensor"]) for x in w] == [
        (1, 500.0, "p"), (2, 500.0, "p"), (3, 200.1, "p"), (4, 9999.9, None), (8, 500.0, None)]
    assert w[0]["timestamp"] is None
    times = {x["offset"]: x["timestamp"] for x in w}
    assert all(v == dt.datetime(2017, 2, 27, 10, 0, 0) for k, v in times.items() if k != 1)
    assert [x["lux"] for x in w if x["offset"] == 8] == [None]
    temps = clean.clean_temperatures(r).collect()
    assert [(x["temperature_c"], x["sensor"]) for x in temps] == [(20.5, "u")]
