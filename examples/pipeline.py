"""End to end: ingest -> log -> streams -> served view (Entries B, A and C).

1. Signed payloads (derived from ``events``) are verified and enriched with
   the device tag table; accepted readings are appended to the ``readings``
   topic of a file log, rejected ones are counted.
2. The registry's datasets run as streams over that topic until the input
   is consumed: raw outputs and 10-minute rollups go to their own topics.
3. The served view returns the history of a dataset and its rollup.

python examples/pipeline.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from terrarium.functions import expr as X  # noqa: E402
from terrarium.operators import derive, ingest, serve  # noqa: E402
from terrarium.plans.registry import Context, default_registry  # noqa: E402
from terrarium.schema import EXTENDED  # noqa: E402
from terrarium.session import ensure_utc, shared_dir  # noqa: E402
from terrarium.sources import events as EV  # noqa: E402
from terrarium.sources.log import FileLog, decode  # noqa: E402
from terrarium.streaming import streams  # noqa: E402

KEY = "example-key"


def run(spark: SparkSession, sf_dir: str) -> dict:
    ensure_utc(spark)
    root = shared_dir(spark, "example", unique=True)
    ev = EV.load(spark, sf_dir, "events")

    # Entry B: verify, enrich, append
    payloads = EV.payloads_from_events(ev, KEY, "not-the-key")
    payloads.write.parquet(f"{root}/landed")
    accepted, rejected = ingest.enrich(spark.read.parquet(f"{root}/landed"),
                                       EV.tags_from_events(ev), KEY)
    readings = (accepted.where(F.col("grams").isNotNull())
                .withColumn("timestamp", X.parse_ts(F.col("timestamp"))))
    log = FileLog(spark, f"{root}/log")
    log.append("readings", readings.drop("mac"), position=F.col("event_id"),
               time_text=X.reading_time_text(F.col("timestamp")))

    # Entry A: registered datasets as streams (rules loose enough for the data)
    reg = default_registry(lo=0.0, hi=1e9, max_stddev=1e9, caps=(), retires=(),
                           loss_width="5 minutes")
    out = FileLog(spark, f"{root}/out")

    def ranges() -> DataFrame:
        batch, _ = decode(log.scan("readings"), schema=EXTENDED, ntz=False)
        return derive.ranges(reg.datasets["weights"].fn(Context(spark, lambda: batch)))

    ctx = Context(spark, lambda: streams.readings_stream(log), ranges, streaming=True)
    queries = reg.start(ctx, out, f"{root}/cp", names=["weights", "water"],
                        raw_trigger={"availableNow": True},
                        rollup_trigger={"availableNow": True},
                        state_partitions=spark.sparkContext.defaultParallelism)
    for q in queries:
        q.awaitTermination()

    # Entry C: the served view of weights and its rollup
    view = serve.history(out, "weights,weights-10min", "10 days",
                         asof=F.lit("2024-01-31 00:00:00").cast("timestamp"))
    return {
        "accepted": accepted.count(),
        "rejected": rejected.count(),
        "weights": out.scan("weights").count(),
        "water": out.scan("water").count(),
        "rollup_keys": out.scan("weights-10min").select("key").distinct().count(),
        "served": view.groupBy("topic").count().orderBy("topic").collect(),
    }


if __name__ == "__main__":
    spark = (SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print(run(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"))
