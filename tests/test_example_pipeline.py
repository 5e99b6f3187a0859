import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples"))

from conftest import SF001  # noqa: E402


def test_ingest_log_streams_serve(spark):
    import pipeline
    r = pipeline.run(spark, SF001)
    assert r["accepted"] + r["rejected"] == 1000
    assert 0 < r["weights"] <= r["accepted"]
    assert 0 < r["water"] <= r["weights"]
    assert 0 < r["rollup_keys"] <= r["weights"]
    assert {row["topic"] for row in r["served"]} == {"weights", "weights-10min"}
