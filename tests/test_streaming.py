"""Streaming behaviour: batch/stream equality, late data, restart, fresh
start and scan sharing (SURVEY section 5, items 3-6)."""

import json

import pytest
from pyspark.sql import functions as F

from terrarium.operators.rollup import rollup
from terrarium.plans import fixture as FX
from terrarium.plans import streamed
from terrarium.plans.registry import Context, default_registry
from terrarium.schema import EXTENDED
from terrarium.sources.events import load
from terrarium.sources.log import FileLog, compacted, decode
from terrarium.streaming import streams

from conftest import SF001, SF01

NOW = {"availableNow": True}


def _values(df, cols):
    return sorted(tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in cols)
                  for r in df.collect())


def _compacted_rows(out, topic):
    return [json.loads(r["value"].decode()) for r in compacted(out, topic).collect()]


def test_late_rows_dropped_from_rollup_kept_in_raw(spark, tmp):
    """4 files of 2,500 events; 25 rows of file 0 arrive in file 2, after
    the watermark has passed them: the rollup equals batch without them,
    the raw stream keeps them, and the progress reports 25 dropped rows."""
    ev = load(spark, SF01, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), "event_type", "value")
    late = (F.col("event_id") < 2500) & (F.col("event_id") % 100 == 7)
    src = f"{tmp}/src"
    for i in range(4):
        part = ev.where((F.col("event_id") >= 2500 * i) & (F.col("event_id") < 2500 * (i + 1)))
        if i == 0:
            part = part.where(~late)
        if i == 2:
            part = part.unionByName(ev.where(late))
        part.coalesce(1).write.mode("append").parquet(src)

    def stream():
        return (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
                .withWatermark("timestamp", "10 minutes"))

    out = FileLog(spark, f"{tmp}/out")
    q1 = streams.start_rollup(stream(), out, "types-10min", ["value"], ["event_type"],
                              f"{tmp}/cp1", trigger=NOW)
    q2 = streams.start_raw(stream(), out, "types", f"{tmp}/cp2", trigger=NOW)
    q1.awaitTermination()
    q2.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q1.recentProgress if p.get("stateOperators"))
    assert dropped == 25

    got = _compacted_rows(out, "types-10min")
    assert len(got) == 8003
    on_time = ev.where(~late).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    expected = rollup(on_time, ["value"], ["event_type"])
    assert expected.count() == 8003
    assert rollup(ev, ["value"], ["event_type"]).count() == 8016
    exp = {(r["timestamp"].strftime("%Y-%m-%d %H:%M:%S +0000"), r["event_type"]): round(r["value"], 6)
           for r in expected.collect()}
    assert {(g["timestamp"], g["event_type"]): round(g["value"], 6) for g in got} == exp

    raw = out.scan("types")
    assert raw.count() == 10000


def _append(log, events, day):
    """One append of one file: all its records have one log day."""
    from terrarium.sources.events import readings_from_events

    log.append("readings", readings_from_events(events).coalesce(1), position=F.col("event_id"),
               log_time=F.lit(f"2024-02-{day + 1:02d}").cast("timestamp"), time_text=streamed._micro_text())


def _setup(spark, tmp, files):
    events = load(spark, SF001, "events")
    src = FileLog(spark, f"{tmp}/in")
    for day, chunk in enumerate(streamed.pieces(events, files)):
        _append(src, chunk, day)
    return events, src


def _ctx(spark, src, reg):
    return Context(spark, lambda: streams.readings_stream(src, maxFilesPerTrigger=1),
                   None, streaming=True)


def test_restart_from_checkpoint_equals_batch(spark, tmp):
    events = load(spark, SF001, "events")
    src = FileLog(spark, f"{tmp}/in")
    chunks = streamed.pieces(events, 4)
    for day in (0, 1):
        _append(src, chunks[day], day)
    reg = default_registry(lo=FX.LO, hi=FX.HI, max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                           retires=FX.RETIRES)
    out = FileLog(spark, f"{tmp}/out")
    for q in reg.start(_ctx(spark, src, reg), out, f"{tmp}/cp", names=["weights"],
                       which=["rollup"], rollup_trigger=NOW):
        q.awaitTermination()
    first = len(_compacted_rows(out, "weights-10min"))
    for day in (2, 3):
        _append(src, chunks[day], day)
    for q in reg.start(_ctx(spark, src, reg), out, f"{tmp}/cp", names=["weights"],
                       which=["rollup"], rollup_trigger=NOW):
        q.awaitTermination()
    got = {(g["timestamp"], g.get("sensor")): round(g["grams"], 6)
           for g in _compacted_rows(out, "weights-10min")}
    from terrarium.plans import named
    batch = named.q_weights_10min(spark, SF001).collect()
    exp = {(r["timestamp"].strftime("%Y-%m-%d %H:%M:%S +0000"), r["sensor"]): r["grams"] for r in batch}
    assert 0 < first < len(exp)
    assert got == exp


def test_fresh_start_resets_outputs(spark, tmp):
    events, src = _setup(spark, tmp, files=2)
    reg = default_registry(lo=FX.LO, hi=FX.HI, max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                           retires=FX.RETIRES)
    out = FileLog(spark, f"{tmp}/out")
    for cp in ("cp1", "cp2"):  # second run has no checkpoint: old output is dropped first
        for q in reg.start(_ctx(spark, src, reg), out, f"{tmp}/{cp}", names=["weights"],
                           which=["raw"], raw_trigger=NOW):
            q.awaitTermination()
    from terrarium.plans import named
    assert out.scan("weights").count() == named.q_weights(spark, SF001).count()


def test_shared_scan_equals_separate_streams(spark, tmp):
    events, src = _setup(spark, tmp, files=2)
    reg = default_registry(lo=FX.LO, hi=FX.HI, max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                           retires=FX.RETIRES)
    from terrarium.operators import derive

    def ranges():
        batch, _ = decode(src.scan("readings"), schema=EXTENDED, ntz=False)
        return derive.ranges(reg.datasets["weights"].fn(Context(spark, lambda: batch)))

    ctx = Context(spark, lambda: streams.readings_stream(src, maxFilesPerTrigger=1), ranges,
                  streaming=True)
    shared = FileLog(spark, f"{tmp}/shared")
    reg.start_shared_raw(ctx, shared, f"{tmp}/cps", trigger=NOW).awaitTermination()
    sep = FileLog(spark, f"{tmp}/sep")
    qs = reg.start(ctx, sep, f"{tmp}/cp", names=["weights", "water", "temperatures"],
                   which=["raw"], raw_trigger=NOW)
    for q in qs:
        q.awaitTermination()
    for name in ("weights", "water", "temperatures"):
        a = sorted(r["value"] for r in shared.scan(name).collect())
        b = sorted(r["value"] for r in sep.scan(name).collect())
        assert a == b and len(a) > 0


@pytest.mark.parametrize("refresh", [None, 1])
def test_ranges_snapshot_and_refresh(spark, tmp, refresh):
    """Ranges come from the weights topic the stream itself writes.
    Taken once at start it is empty, so water stays empty (as in the
    reference's first run); refreshed every batch, water fills from batch 1."""
    events, src = _setup(spark, tmp, files=3)
    reg = default_registry(lo=FX.LO, hi=FX.HI, max_stddev=FX.MAX_STDDEV, caps=FX.CAPS,
                           retires=FX.RETIRES)
    from terrarium.operators import derive
    out = FileLog(spark, f"{tmp}/out")

    def ranges():
        w, _ = decode(out.scan("weights"), schema=EXTENDED, ntz=False)
        return derive.ranges(w)

    ctx = Context(spark, lambda: streams.readings_stream(src, maxFilesPerTrigger=1), ranges,
                  streaming=True)
    reg.start_shared_raw(ctx, out, f"{tmp}/cp", names=["weights", "water"], trigger=NOW,
                         refresh_every=refresh).awaitTermination()
    n_weights = out.scan("weights").count()
    n_water = out.scan("water").count()
    assert n_weights > 0
    if refresh is None:
        assert n_water == 0
    else:
        assert 0 < n_water < n_weights


def test_pieces_hold_every_row_once(spark):
    events = load(spark, SF001, "events")
    odd = events.limit(50).withColumn("event_id", F.when(F.col("event_id") % 2 == 0, F.lit(None).cast("long"))
                                      .otherwise(F.lit(10 ** 12) + F.col("event_id")))
    every = events.unionByName(odd)
    assert sum(p.count() for p in streamed.pieces(every)) == every.count()
    assert [p.count() for p in streamed.pieces(events.where("false"))] == [0]


def test_last_open_window_of_the_chained_rollup_is_served(spark, tmp):
    """The only loss lies in the very last window, which append mode never emits."""
    import datetime as dt

    rows = [(1, dt.datetime(2024, 1, 1, 0, 1), "error", 410.0, 1), (2, dt.datetime(2024, 1, 1, 0, 2), "error", 400.0, 1),
            (3, dt.datetime(2024, 1, 2, 0, 1), "error", 425.0, 1), (4, dt.datetime(2024, 1, 2, 0, 2), "error", 405.0, 1)]
    base = load(spark, SF001, "events").limit(1).collect()[0].asDict()
    made = [{**base, "event_id": i, "ts": t, "event_type": e, "value": v / 2, "user_id": u,
             "props": '{"k": 30}'} for i, t, e, v, u in rows]
    schema = load(spark, SF001, "events").schema
    for part in ([made[0], made[1]], made):
        folder = f"{tmp}/sf{len(part)}"
        spark.createDataFrame(part, schema).write.parquet(f"{folder}/events.parquet")
        from terrarium.plans import named
        want = sorted(map(tuple, named.q_evaporation_10min(spark, folder).collect()))
        got = sorted(map(tuple, streamed.q_stream_evaporation_10min(spark, folder).collect()))
        assert got == want and len(got) == len(part) // 2


def test_dead_letters_are_kept_and_counted(spark, tmp):
    """P20: one scan, two outputs, both counted; a restart adds to them."""
    from terrarium.sources.log import LOG

    src, out, counts = FileLog(spark, f"{tmp}/in"), FileLog(spark, f"{tmp}/out"), {}
    import datetime as dt
    for n, values in enumerate((['{"sensor":"a","grams":1.5}', "{cut", "text"], ['{"sensor":"b"}', "[1]"])):
        rows = [(None, v.encode(), "t", 0, 10 * n + k, dt.datetime(2024, 1, 1)) for k, v in enumerate(values)]
        src.append_records(spark.createDataFrame(rows, LOG), "t")
        streams.start_decoded(src, "t", out, "good", "bad", f"{tmp}/cp", trigger=NOW,
                              on_counts=counts.__setitem__).awaitTermination()
    assert counts == {0: {"good": 1, "corrupt": 2}, 1: {"good": 1, "corrupt": 1}}
    assert sorted(json.loads(r["value"])["sensor"] for r in out.scan("good").collect()) == ["a", "b"]
    bad = [json.loads(r["value"]) for r in out.scan("bad").collect()]
    assert sorted((b["value"], b["offset"]) for b in bad) == [("[1]", 11), ("text", 2), ("{cut", 1)]


def test_open_windows_leave_out_rows_that_came_too_late(spark, tmp):
    """T4: a row the stream has dropped is not in its open windows either."""
    from terrarium.operators import derive
    import datetime as dt

    def add(log, *rows):
        df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m), "a", float(g)) for h, m, g in rows],
                                   "timestamp timestamp, sensor string, grams double")
        log.append("readings", df, time_text=F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss -0000"))

    src, out = FileLog(spark, f"{tmp}/in"), FileLog(spark, f"{tmp}/out")

    def run():
        rows = streams.readings_stream(src)
        inner = derive.loss(rows, None, label="time")
        agg = streams.rollup_of_windows(inner, ["ml_hour"], ["sensor"], "5 minutes")
        streams.start_appended_rollup(agg, out, "e", ["sensor"], f"{tmp}/cp", trigger=NOW).awaitTermination()

    add(src, (0, 1, 100), (0, 4, 95))
    run()
    add(src, (5, 1, 90), (5, 4, 83))
    run()
    add(src, (0, 2, 200), (0, 3, 190), (5, 2, 90))        # the first two are far too late
    run()
    opened = streams.open_chained_windows(spark, f"{tmp}/cp", ["ml_hour"], ["sensor"], derive.LOSS_STATE,
                                          derive.loss_of_state).collect()
    assert [(r["timestamp"], r["ml_hour"]) for r in opened] == [(dt.datetime(2024, 1, 1, 5, 0), 7.0)]
    assert [(g["timestamp"], g["ml_hour"]) for g in _compacted_rows(out, "e")] == [("2024-01-01 00:00:00 +0000", 5.0)]
