"""Session helpers: time zone and the shared folder for checkpoints and logs."""

from __future__ import annotations

import atexit
import contextlib
import posixpath
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def ensure_utc(spark: SparkSession) -> None:
    """All time work runs in UTC (the reading text carries a fixed zone
    suffix that is not trustworthy, so it is ignored and UTC assumed)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookups differ across modes
        value = None
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - no SparkContext (Connect)
        return None


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir``.  Only in local mode,
    where no such setting exists (tests), a fresh folder is made under the
    system temp directory and registered as the checkpoint dir, so that
    ``DataFrame.checkpoint()`` and streaming checkpoints share it; it is
    removed when the process ends.  On a
    cluster an unset location is an error rather than a silent local path.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) so checkpoints survive executor loss")
        base = tempfile.mkdtemp(prefix="terrarium-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    if unique:
        parts = parts + (uuid.uuid4().hex,)
    return posixpath.join(base, *parts) if parts else base


@contextlib.contextmanager
def conf_scope(spark: SparkSession, settings: dict):
    """Apply SQL settings for the duration of a block, then restore them.

    A streaming query clones the session when it starts, so settings made
    around ``start()`` (such as the state partition count) stay with that
    query without leaking into later work of the session."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
