"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.session import shared_dir

#: Bytes of text handled at once inside a task.  A batch is cut into slices
#: of at most this many bytes (one row at least), so a task's memory depends
#: on the longest text, not on the number of rows of an Arrow batch.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage with a plain table, which survives lost executors and is
    read twice without computing twice."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the value's text, modulo: the fold of a row."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, last) row ranges of a string or binary column holding at most
    ``limit`` bytes each, one row at least."""
    n = len(column)
    if not n:
        return
    kind = pa.large_binary()
    sizes = np.diff(np.frombuffer(
        column.cast(pa.large_string()).cast(kind).buffers()[1], dtype=np.int64,
        count=n + 1 + column.offset)[column.offset:])
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    yield start, n


#: Characters of a text that a model is fitted on, at most.
TRAIN_CHARS = 1 << 14


def training_part(text: str, *seed: Column, most: int = TRAIN_CHARS) -> Column:
    """What a model is fitted on of a text: all of it, or a part of ``most``
    characters whose place is drawn by a hash of ``seed``."""
    t = F.col(text)
    places = F.greatest(F.length(t) - most, F.lit(0)) + 1
    return F.substring(t, F.pmod(F.xxhash64(*seed), places).cast("int") + 1, F.lit(most))


def map_texts(df: DataFrame, text: str, keep: list[str], added: T.StructType,
              function: Callable[[list], dict]) -> DataFrame:
    """Apply ``function`` to the values of column ``text``, a slice at a time.

    ``function`` takes a list of texts (None for null) and returns a dict of
    equally long lists or Arrow arrays, one for each field of ``added``.
    Columns ``keep`` are passed through (the text among them if it is named);
    all others are dropped, so an extra column with a clashing name does no
    harm."""
    at = keep.index(text) if text in keep else len(keep)
    source = df.select(*[F.col(f"`{c}`") for c in keep], *([] if at < len(keep) else [F.col(f"`{text}`")]))
    schema = T.StructType([source.schema[c] for c in keep] + list(added.fields))
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            for i, j in slices(column):
                got = function(column.slice(i, j - i).to_pylist())
                arrays = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                for f in added.fields:
                    v = got[f.name]
                    kind = arrow.field(f.name).type
                    arrays.append(v.cast(kind) if isinstance(v, pa.Array) else pa.array(v, kind))
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return source.mapInArrow(run, schema)


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with plain column names that clash with nothing, and the new
    name of each column."""
    names = {c: f"column_{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def unmasked(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(new).alias(old) for old, new in names.items()])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
