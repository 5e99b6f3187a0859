"""Vector codes: every vector as 16 bytes, by integer codebooks.

A component x becomes the integer floor(256 * x).  Vectors are cut into
``PARTS`` equal consecutive parts; each part position has a codebook of up to
``ENTRIES`` entries, fitted in ``ROUNDS`` rounds of nearest-entry assignment
(squared Euclidean distance, ties to the lower index) and componentwise
floor(sum / count).  An unused entry stays as it was.

Nothing is subtracted or squared row by row.  Each dimension of a slice of
rows has a dictionary of the distinct integers that occur there; the squared
differences of every dictionary value to all entries are tabulated once, and a
part's distances are gathers from these tables by dictionary code, added up
over the part's dimensions.  A slice has at most ``SLICE_ROWS`` rows, so its
tables are bounded by its rows whatever the range of the values.

A round is one pass over the stored integers; a task sends the driver's
aggregation one row for each dimension and entry, so the driver sees only
the codebooks: ``ENTRIES`` integers a dimension.

Rows: a vector that is null or holds null or non-finite components is dropped.
The first codebook is made of the smallest keys (null keys last, equal keys in
order of their vectors); repeated rows are rows of their own.  Vectors of
different lengths have codebooks of their own, and a length that is no
multiple of ``PARTS`` is filled up with zeros; an empty vector has code zero
and error zero.  Integers beyond the range in which a squared error fits a
long are held at its ends; a group's error that does not fit is null.  An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import _arrow_schema, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
SLICE_ROWS = 4096


def finite(vector: str) -> Column:
    """Whether all components are there and finite."""
    v = F.col(vector)
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
                      F.lit(False))


def dictionaries(rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(values, codes): for each dimension its distinct integers, ascending,
    and the place of each row's integer among them."""
    values, codes = [], np.empty(rows.shape[::-1], np.int32)
    for k in range(rows.shape[1]):
        own, codes[k] = np.unique(rows[:, k], return_inverse=True)
        values.append(own)
    return values, codes


def assign(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, error), both (parts, rows): each part's nearest entry of
    ``book`` (entries, width), the lowest on ties, and its squared distance."""
    n, width = rows.shape
    own = width // PARTS
    values, codes = dictionaries(rows)
    index, error = np.zeros((PARTS, n), np.int64), np.zeros((PARTS, n), np.int64)
    for p in range(PARTS if own else 0):
        far = np.zeros((n, len(book)), np.int64)
        for k in range(p * own, (p + 1) * own):
            table = (values[k][:, None] - book[None, :, k]) ** 2
            far += table[codes[k]]
        index[p] = far.argmin(axis=1)
        error[p] = np.take_along_axis(far, index[p][:, None], axis=1)[:, 0]
    return index, error


def sums(rows: np.ndarray, index: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, totals), both (entries, width): for every dimension, the rows
    whose part went to an entry, and the sum of their integers."""
    width = rows.shape[1]
    own = width // PARTS
    counts, totals = np.zeros((entries, width), np.int64), np.zeros((entries, width), np.int64)
    for k in range(width):
        to = index[k // own]
        counts[:, k] = np.bincount(to, minlength=entries)
        np.add.at(totals[:, k], to, rows[:, k])
    return counts, totals


def digest(book: np.ndarray) -> str:
    """SHA-256 of all integers of the final codebooks: by part, entry and
    position within the part."""
    entries, width = book.shape
    ordered = book.reshape(entries, PARTS, width // PARTS).transpose(1, 0, 2).reshape(-1)
    return hashlib.sha256(",".join(map(str, ordered.tolist())).encode()).hexdigest()


# ------------------------------------------------------------------ DataFrames

def integers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, width, v) of every kept row; v holds the integers."""
    width = (F.ceil(F.size("x") / PARTS) * PARTS).cast("int")
    most = F.floor(F.sqrt(F.lit(2.0 ** 63) / F.greatest(F.col("width"), F.lit(1))) / 2) - 1
    whole = F.transform("x", lambda x: F.floor(F.greatest(-F.col("most"), F.least(
        F.col("most").cast("double"), x * SCALE))).cast("long"))
    return (vectors.filter(finite(vector))
            .select(F.col(key).alias("key"), F.col(label).alias("label"),
                    F.col(vector).cast("array<double>").alias("x"))
            .withColumn("width", width).withColumn("most", most)
            .select("key", "label", "width", F.concat(whole, F.array_repeat(
                F.lit(0).cast("long"), F.col("width") - F.size("x"))).alias("v")))


def first_books(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each width the integers of the ``ENTRIES`` smallest keys."""
    nth = F.row_number().over(Window.partitionBy("width").orderBy(F.col("key").isNull(), "key", "v"))
    # the limit is applied before the shuffle, too: at most ENTRIES rows of a width leave a task
    found = rows.select("width", "key", "v").withColumn("n", nth).filter(F.col("n") <= ENTRIES)
    books: dict[int, list] = {}
    for r in found.orderBy("width", "n").select("width", "v").collect():
        books.setdefault(r["width"], []).append(r["v"])
    return {w: np.array(v, np.int64).reshape(len(v), w) for w, v in books.items()}


def _by_width(batch: pa.RecordBatch, columns: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Slices of rows of one width: (width, the rows, their integers)."""
    widths = batch.column(columns - 2).to_numpy()
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        for i in range(0, len(at), SLICE_ROWS):
            part = batch.take(pa.array(at[i:i + SLICE_ROWS]))
            flat = part.column(columns - 1).flatten().to_numpy(zero_copy_only=False)
            yield w, part, flat.reshape(len(part), w).astype(np.int64)


SUMS = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("at", T.IntegerType()),
                     T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()),
                     T.StructField("total", T.LongType())])


def refit(rows: DataFrame, books: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """One round: every part to its nearest entry, then every used entry to
    the floored mean of its parts."""
    arrow = _arrow_schema(SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for w, _, own in _by_width(batch, 2):
                got = sums(own, assign(own, books[w])[0], len(books[w]))
                held[w] = [a + b for a, b in zip(held[w], got)] if w in held else list(got)
        for w, (n, total) in held.items():
            entry, at = np.nonzero(n)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), w), pa.int32()), pa.array(at, pa.int32()),
                     pa.array(entry, pa.int32()), pa.array(n[entry, at]), pa.array(total[entry, at])], schema=arrow)

    found = (rows.select("width", "v").mapInArrow(run, SUMS).groupBy("width", "at", "entry")
             .agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    new = {w: book.copy() for w, book in books.items()}
    for r in found.collect():                      # one row a dimension and entry
        new[r["width"]][r["entry"], r["at"]] = r["total"] // r["n"]
    return new


def fit(rows: DataFrame) -> dict[int, np.ndarray]:
    books = first_books(rows)
    for _ in range(ROUNDS if books else 0):
        books = refit(rows, books)
    return books


def coded(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """(key, label, code, error, books) of every row: two hex digits a part,
    the squared distances summed, and the digest of its codebooks."""
    schema = T.StructType([rows.schema["key"], rows.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType()), T.StructField("books", T.StringType())])
    arrow = _arrow_schema(schema)
    digests = {w: digest(book) for w, book in books.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, part, own in _by_width(batch, 4):
                index, error = assign(own, books[w])
                codes = index.astype(np.uint8).T.tobytes().hex()
                size = 2 * PARTS
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([codes[i:i + size] for i in range(0, len(codes), size)], pa.string()),
                     pa.array(error.sum(axis=0)), pa.array([digests[w]] * len(part), pa.string())], schema=arrow)

    return rows.select("key", "label", "width", "v").mapInArrow(run, schema)


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> DataFrame:
    """(<key>, code, error, label_error, codebooks_sha256) of every kept row;
    ``label_error`` is the error summed over the rows with the same label,
    null labels together."""
    rows = stored(integers(vectors, key, vector, label))
    done = stored(coded(rows, fit(rows)))
    total = (done.groupBy(F.col("label").alias("own")).agg(F.try_sum("error").alias("label_error")))
    return (done.join(total, F.col("label").eqNullSafe(F.col("own")))
            .select(F.col("key").alias(key), "code", "error", "label_error",
                    F.col("books").alias("codebooks_sha256")))
