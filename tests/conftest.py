from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="terrarium-tests-")
    s = (SparkSession.builder.master("local[*]")
         .appName("terrarium-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.local.dir", f"{scratch}/local")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
