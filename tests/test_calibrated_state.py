"""Calibration in a stream over many sensors: its state has few groups."""

import datetime as dt

from pyspark.sql import functions as F

from terrarium.operators import calibrate
from terrarium.plans import streamed
from terrarium.sources.log import FileLog, decode
from terrarium.streaming import streams

NOW = {"availableNow": True}
START = dt.datetime(2024, 1, 1)
SENSORS = 700


def test_groups_of_the_state_do_not_grow_with_the_sensors(spark, tmp):
    """Every sensor is pressed and read in both appends; one is not read but
    in the last, one only without a name."""
    src, out = FileLog(spark, f"{tmp}/in"), FileLog(spark, f"{tmp}/out")
    at = lambda m: START + dt.timedelta(minutes=m)
    names = [f"s{i}" for i in range(SENSORS)]
    bursts = [[(at(60), s, [float(i)]) for i, s in enumerate(names[1:], 1)] + [(at(60), None, [5.0])],
              [(at(200), s, [float(i)]) for i, s in enumerate(names)] + [(at(400), "last", [0.0])]]
    presses = [[(at(30), s, "zero", float(i)) for i, s in enumerate(names)],
               [(at(150), s, "1kg", 2000.0 + i) for i, s in enumerate(names)]]
    for b, p in zip(bursts, presses):
        src.append("bursts", spark.createDataFrame(b, "timestamp timestamp, sensor string, samples array<double>"),
                   log_time=F.col("timestamp"))
        src.append("presses", spark.createDataFrame(p, "timestamp timestamp, sensor string, point string, raw double"),
                   log_time=F.col("timestamp"))
        readings = streams.readings_stream(src, "bursts", streamed.BURST, watermark=None)
        readings = readings.withColumn("raw", calibrate.burst_stats_array(F.col("samples"))[1])
        saved = streams.readings_stream(src, "presses", streamed.PRESS, watermark=None)
        query = streams.start_raw(calibrate.calibrated_stream(readings, saved), out, "calibrated", f"{tmp}/cp", trigger=NOW)
        query.awaitTermination()
        groups = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
        assert groups and max(groups) < SENSORS
    good, _ = decode(out.scan("calibrated"), ntz=True, schema=streamed.FOUND)
    got = {(r.sensor, r.timestamp): (r.raw, r.zero, r.one_kg) for r in good.collect()}
    want = {(s, at(60)): (float(i), float(i), 1000.0) for i, s in enumerate(names) if i}
    want |= {(s, at(200)): (float(i), float(i), 2000.0 + i) for i, s in enumerate(names)}
    assert got == want | {(None, at(60)): (5.0, 1000.0, 1000.0)}
