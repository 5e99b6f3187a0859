"""Dataset registration: declare a dataset once, run it in batch or as streams.

``@registry.stream(name, values, keys)`` registers a function of a
``Context`` that returns a DataFrame with a ``timestamp`` column.  Each
dataset has its raw output (topic ``name``) and a rollup of its value
columns over 10-minute windows by its keys (topic ``name-10min``), plus one
graph spec per value column (K9).  Registration is pure; ``batch`` builds
the DataFrames, ``start`` launches the streaming queries.  The decorated
function is returned unchanged, so datasets build on one another by calling
each other's functions (water calls weights).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from terrarium.operators import clean, derive
from terrarium.operators.rollup import rollup
from terrarium.schema import GRAPH
from terrarium.session import conf_scope
from terrarium.sources.log import FileLog
from terrarium.streaming import streams

ROLLUP_SUFFIX = "-10min"
ROLLUP_WIDTH = "10 minutes"
# The served ages of raw and rolled-up graphs.
RAW_AGE = "2 hours"
ROLLUP_AGE = "10 days"
ROLLUP_TITLE = " - 10 days"


@dataclass
class Context:
    """What dataset functions read: readings (batch or streaming), and the
    sensor ranges snapshot, a static batch table taken once (T9, N9)."""
    spark: SparkSession
    readings: Callable[[], DataFrame]
    ranges: Callable[[], DataFrame] | None = None
    streaming: bool = False
    growing: bool = False       # every sensor of the readings has a range
    cache: dict = field(default_factory=dict)

    def ranges_df(self) -> DataFrame:
        if "ranges" not in self.cache:
            if self.ranges is None:
                raise ValueError("this dataset needs a ranges snapshot")
            self.cache["ranges"] = self.ranges()
        return self.cache["ranges"]


@dataclass(frozen=True)
class Dataset:
    name: str
    values: tuple[str, ...]
    keys: tuple[str, ...]
    fn: Callable[[Context], DataFrame]
    width: str = ROLLUP_WIDTH
    inner_width: str | None = None  # set when fn's rows are already windows (end label)
    ranged: bool = False        # fn joins its rows with the ranges

    def row_schema(self) -> StructType:
        """Time, keys and values, as a record of the raw topic holds them."""
        return StructType([StructField(c, StringType()) for c in ("timestamp", *self.keys)]
                          + [StructField(v, DoubleType()) for v in self.values])


class Registry:
    def __init__(self) -> None:
        self.datasets: dict[str, Dataset] = {}
        self.started: list[tuple[str, StreamingQuery]] = []    # (output topic, query)

    def stream(self, name: str, values: Sequence[str], keys: Sequence[str] = (),
               rollup: str = ROLLUP_WIDTH, inner_width: str | None = None, ranged: bool = False):
        def deco(fn):
            self.datasets[name] = Dataset(name, tuple(values), tuple(keys), fn, rollup,
                                          inner_width, ranged)
            return fn
        return deco

    # -- batch -----------------------------------------------------------
    def batch(self, ctx: Context, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
        """Raw and rollup DataFrames of each dataset, keyed by topic name."""
        out: dict[str, DataFrame] = {}
        for d in self._select(names):
            raw = d.fn(ctx)
            out[d.name] = raw
            out[d.name + ROLLUP_SUFFIX] = rollup(raw, list(d.values), list(d.keys), d.width)
        return out

    # -- streams ---------------------------------------------------------
    def start(self, ctx: Context, out: FileLog, checkpoint_root: str,
              names: Sequence[str] | None = None, which: Sequence[str] = ("raw", "rollup"),
              raw_trigger: dict | None = None, rollup_trigger: dict | None = None,
              reset: bool = True, state_partitions: int | None = None,
              growing: Callable[[Context], DataFrame] | None = None) -> list[StreamingQuery]:
        """Launch the raw and rollup queries of each dataset.

        Default triggers follow the reference: one minute for raw streams,
        as fast as possible for rollups.  A dataset without a checkpoint
        first drops its old output topics (K6).  ``state_partitions`` fixes
        the shuffle/state partition count of the stateful queries (it is
        stored in the checkpoint at first start).

        T9/N9: ``growing`` gives the ranges of a micro-batch's readings.  With
        it no snapshot of the ranges is needed: a dataset that joins them keeps
        a table of its own, one version a micro-batch, and joins each
        micro-batch with the version that knows it, so a sensor has its rows
        from its first reading on.  Its rollup follows the raw topic, where
        the joined rows are, so its raw query has to run as well.

        T8: the jobs of each query run in a scheduler pool named after its
        output topic (shares are fair where ``spark.scheduler.mode`` is)."""
        settings = {"spark.sql.shuffle.partitions": state_partitions} if state_partitions else {}
        with conf_scope(ctx.spark, settings):
            return self._start(ctx, out, checkpoint_root, names, which, raw_trigger,
                               rollup_trigger, reset, growing)

    def _start(self, ctx, out, checkpoint_root, names, which, raw_trigger, rollup_trigger,
               reset, growing) -> list[StreamingQuery]:
        raw_trigger = raw_trigger or {"processingTime": streams.RAW_TRIGGER}
        if growing:
            ctx = replace(ctx, growing=True, cache={})
        started: list[StreamingQuery] = []

        def begin(topic: str, start: Callable[..., StreamingQuery], *args, **opts) -> None:
            with streams.pool(ctx.spark, topic):
                started.append(start(*args, **opts))
            self.started.append((topic, started[-1]))

        for d in self._select(names):
            rollup_topic = d.name + ROLLUP_SUFFIX
            cp_raw = f"{checkpoint_root}/{d.name}"
            cp_roll = f"{checkpoint_root}/{d.name}{ROLLUP_SUFFIX}"
            if reset:
                if "raw" in which:
                    streams.reset_if_new(out, [d.name], cp_raw)
                if "rollup" in which:
                    streams.reset_if_new(out, [d.name + ROLLUP_SUFFIX], cp_roll)
            grown = growing if d.ranged else None
            if "raw" in which and grown:
                begin(d.name, self._start_grown, d, ctx, grown, out, cp_raw, raw_trigger)
            elif "raw" in which:
                raw = d.fn(ctx)
                if d.inner_width:  # rows are windows labelled end - 1 µs: show the end
                    raw = raw.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 MICROSECOND"))
                begin(d.name, streams.start_raw, raw, out, d.name, cp_raw, trigger=raw_trigger)
            if "rollup" in which:
                src = streams.readings_stream(out, d.name, d.row_schema()) if grown else d.fn(ctx)
                if d.inner_width:
                    agg = streams.rollup_of_windows(src, d.values, d.keys, d.inner_width, d.width)
                    begin(rollup_topic, streams.start_appended_rollup, agg, out, rollup_topic, d.keys, cp_roll,
                          trigger=rollup_trigger)
                else:
                    begin(rollup_topic, streams.start_rollup, src, out, rollup_topic, d.values, d.keys, cp_roll,
                          width=d.width, trigger=rollup_trigger)
        return started

    @staticmethod
    def _start_grown(d: Dataset, ctx: Context, growing: Callable[[Context], DataFrame], out: FileLog,
                     checkpoint: str, trigger: dict) -> StreamingQuery:
        """The raw output of a dataset whose ranges grow: each micro-batch adds
        its own to the last version and is joined with the outcome."""
        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            batch = batch.persist()
            try:
                own = Context(spark, lambda: batch, growing=True)
                ranges = streams.next_version(spark, f"{checkpoint}-ranges", batch_id, growing(own),
                                              derive.merged_ranges)
                out.write_stream_batch(d.name, d.fn(replace(own, ranges=lambda: ranges, cache={})), checkpoint, batch_id)
            finally:
                batch.unpersist()

        w = ctx.readings().writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return w.outputMode("append").trigger(**trigger).start()

    def start_shared_raw(self, ctx: Context, out: FileLog, checkpoint: str,
                         names: Sequence[str] | None = None,
                         trigger: dict | None = None,
                         refresh_every: int | None = None) -> StreamingQuery:
        """K8 scan sharing: one readings scan feeds the raw output of every
        stateless dataset (all but windowed ones) through one foreachBatch;
        the micro-batch is persisted once and each dataset is computed from
        it, instead of one scan per dataset and query.

        T9: the ranges snapshot is taken once at start (the reference's
        behaviour); ``refresh_every=n`` takes it again every n micro-batches,
        so sensors that appear later get a range."""
        chosen = [d for d in self._select(names) if not d.inner_width]
        state = {"ranges": ctx.ranges_df() if ctx.ranges is not None else None}

        def write(batch: DataFrame, batch_id: int) -> None:
            if refresh_every and ctx.ranges is not None and batch_id > 0 \
                    and batch_id % refresh_every == 0:
                state["ranges"] = ctx.ranges()
            ranges = state["ranges"]
            batch = batch.persist()
            try:
                bctx = Context(ctx.spark, lambda: batch, (lambda: ranges) if ranges is not None else None)
                for d in chosen:
                    out.write_stream_batch(d.name, d.fn(bctx), checkpoint, batch_id)
            finally:
                batch.unpersist()

        trigger = trigger or {"processingTime": streams.RAW_TRIGGER}
        w = (ctx.readings().writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).outputMode("append"))
        return w.trigger(**trigger).start()

    def await_any(self, spark: SparkSession, timeout: float | None = None) -> dict[str, str | None]:
        """Wait until any of the queries that ``start`` launched ends, or
        for ``timeout`` seconds: the output topics of those that have ended
        since the last call, each with its error (None: it was stopped or had
        nothing left to do).  The others go on."""
        ended = streams.await_any(spark, [q for _, q in self.started], timeout)
        found = {topic: ended[q.id] for topic, q in self.started if q.id in ended}
        self.started = [(topic, q) for topic, q in self.started if q.id not in ended]
        return found

    # -- catalog ---------------------------------------------------------
    def specs(self) -> list[dict]:
        """K9: one graph spec per value column of each dataset."""
        return [{"title": d.name, "data": [d.name], "series": "sensor" if d.keys else None,
                 "x": "timestamp", "y": v} for d in self.datasets.values() for v in d.values]

    def catalog(self, spark: SparkSession) -> DataFrame:
        rows = [(s["title"], s["data"], s["series"], s["x"], s["y"], RAW_AGE) for s in self.specs()]
        return spark.createDataFrame(rows, GRAPH)

    def _select(self, names):
        return [self.datasets[n] for n in (names or self.datasets)]


def expand_catalog(specs: DataFrame) -> DataFrame:
    """Each spec plus its rollup twin (title + " - 10 days", served
    age 10 days, every topic suffixed "-10min")."""
    raw = specs.withColumn("age", F.lit(RAW_AGE))
    twin = (specs.withColumn("title", F.concat(F.col("title"), F.lit(ROLLUP_TITLE)))
            .withColumn("age", F.lit(ROLLUP_AGE))
            .withColumn("data", F.transform("data", lambda t: F.concat(t, F.lit(ROLLUP_SUFFIX)))))
    return raw.unionByName(twin)


def topics_text(specs: DataFrame) -> DataFrame:
    """the comma-joined topic list each graph requests."""
    return specs.withColumn("topics", F.array_join("data", ","))


def write_catalog(specs: DataFrame, path: str) -> None:
    """K9: the catalog as one JSON-lines file."""
    specs.coalesce(1).write.mode("overwrite").json(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Read a catalog, either JSON lines or one JSON list (multiLine)."""
    first = spark.read.text(path, wholetext=True).select(F.ltrim(F.col("value")).startswith("[")).first()
    return spark.read.schema(GRAPH).option("multiLine", bool(first and first[0])).json(path)


def default_registry(lo: float = clean.DEFAULT_LO, hi: float = clean.DEFAULT_HI,
                     max_stddev: float = clean.DEFAULT_MAX_STDDEV,
                     caps=clean.DEFAULT_CAPS, retires=clean.DEFAULT_RETIRES,
                     sentinel: float = clean.SENTINEL_C,
                     loss_width: str = derive.LOSS_WIDTH) -> Registry:
    """The reference's six datasets (Q1, Q3-Q6 and their rollups, Q7)."""
    reg = Registry()

    @reg.stream("weights", values=["grams", "stddev"], keys=["sensor"])
    def weights(ctx: Context) -> DataFrame:
        return clean.clean_weights(ctx.readings(), lo=lo, hi=hi, max_stddev=max_stddev,
                                   caps=caps, retires=retires)

    @reg.stream("water", values=["water"], keys=["sensor"], ranged=True)
    def water(ctx: Context) -> DataFrame:
        return derive.water(weights(ctx), ctx.ranges_df())

    @reg.stream("water_rel", values=["water"], keys=["sensor"], ranged=True)
    def water_rel(ctx: Context) -> DataFrame:
        return derive.water_rel(weights(ctx), ctx.ranges_df())

    @reg.stream("evaporation", values=["ml_hour"], keys=["sensor"], inner_width=loss_width)
    def evaporation(ctx: Context) -> DataFrame:
        label = "time" if ctx.streaming else "end"
        return derive.loss(weights(ctx), None if ctx.growing else ctx.ranges_df(), width=loss_width, label=label)

    @reg.stream("temperatures", values=["temperature_f"], keys=["sensor"])
    def temperatures(ctx: Context) -> DataFrame:
        return clean.clean_temperatures(ctx.readings(), sentinel=sentinel)

    return reg
