"""Embedding near-duplicates by counting collisions of sorted projections.

Unit vectors are projected on ``PROJECTIONS`` random lines and sorted along
each.  A window is centred on every query; two vectors collide on a line if
one lies in the other's window.  Vectors at the smallest linking cosine are
``reach`` apart, so their difference along a random line is normal with that
deviation, and the number of collisions is binomial: the count asked for is
the largest that such a pair misses with a probability of at most ``MISS``.
Pairs that pass are verified by their cosine in double precision.

The windows of a sorted line are differences of two prefix sets, kept as bits
(one word holds 64 vectors); the collisions of all queries with all vectors
are counted in carry-save counters, so a pair costs two bits a line.

Only vectors with the same label and length meet.  Equal vectors are one
class with a number of copies, so groups of copies cost nothing.  A group of
over ``CELL`` classes is split in two at the median of the random line on
which its vectors spread most, with a margin of ``MARGIN`` reaches on either
side that belongs to both halves, again and again until its cells are small.  A
pair is lost only if it is over twice the margin apart and the cut lies in
between (about one in ten thousand of the pairs at the smallest cosine), and is
compared in the first of the halves that both belong to.  A cell whose
vectors are too near each other to be split is compared in full, dealt out by
pairs of its parts; nearly all of its pairs are links.

A cell returns one row for each of its linked vectors: the number of links and
the first vector of its connected group there.  Pairs are never written.

Rows: null, empty and zero vectors, vectors that hold null or non-finite
components, and rows without a label link with nothing.  A null key is never a
component's id unless the component has no other (then null).  Repeated rows
are vectors of their own and link with each other.  An empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import _arrow_schema, stored
from terrarium.llm.components import components
from terrarium.llm.hnsw import usable
from terrarium.llm.simhash import beyond

COSINE = 0.93
#: Random lines, half the width of a window in reaches, and the share of the
#: pairs at the smallest cosine that may pass too few windows.
PROJECTIONS, HALF_WINDOW, MISS = 48, 2.0, 1e-5
#: Classes compared in one task; lines tried for a split; the margin in reaches.
CELL, LINES, MARGIN = 4096, 8, 1.5
#: Splits of a group; a pair's halves are told apart by one bit each.
DEEPEST = 60
SEED = 20
CELL_KEY = ["label", "dim", "path"]
NODE = ["absent", "id", "h1", "h2"]


def reach(cosine: float) -> float:
    """How far apart unit vectors with this cosine are."""
    return math.sqrt(2 - 2 * cosine)


def needed(projections: int = PROJECTIONS, half: float = HALF_WINDOW, miss: float = MISS) -> int:
    """The largest number of collisions that a pair at the smallest cosine
    falls short of with a probability of at most ``miss``."""
    p = math.erf(half / math.sqrt(2))
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p ** count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


def directions(dim: int, lines: int, salt: int) -> np.ndarray:
    """Random lines (dim, lines), the same wherever they are asked for."""
    return np.random.default_rng((SEED, dim, salt)).normal(size=(dim, lines))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two that keep their squares in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def missed(projected: np.ndarray, half: float) -> Iterator[np.ndarray]:
    """For each line, words (n, words) whose bits mark, for every query, the
    vectors outside its window."""
    n = len(projected)
    words = -(-n // 64)
    for line in projected.T:
        order = np.argsort(line, kind="stable")
        along = line[order]
        prefix = np.zeros((n + 1, words), np.uint64)
        prefix[np.arange(1, n + 1), order // 64] = np.uint64(1) << (order % 64).astype(np.uint64)
        np.bitwise_xor.accumulate(prefix, axis=0, out=prefix)
        first = np.searchsorted(along, line - half, "left")
        last = np.searchsorted(along, line + half, "right")
        yield ~(prefix[first] ^ prefix[last])


def near_pairs(vectors: np.ndarray, cosine: float = COSINE, at_once: int = 256,
               part: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b), a < b, of rows of ``vectors`` that pass enough windows
    and whose cosine is at least ``cosine``."""
    n, dim = vectors.shape
    x = scaled(vectors)
    norm = np.linalg.norm(x, axis=1)
    projected = x / norm[:, None] @ directions(dim, PROJECTIONS, 0)
    words = -(-n // 64)
    far = beyond(missed(projected, HALF_WINDOW * reach(cosine)), (n, words), PROJECTIONS - needed())
    for start in range(0, n, at_once):
        passed = np.unpackbits(~far[start:start + at_once].view(np.uint8), axis=1, bitorder="little")[:, :n]
        row, b = np.nonzero(passed)
        a = row + start
        a, b = a[a < b], b[a < b]
        for i in range(0, len(a), part):
            p, q = a[i:i + part], b[i:i + part]
            fits = np.einsum("nd,nd->n", x[p], x[q]) / (norm[p] * norm[q]) >= cosine
            yield p[fits], q[fits]


def first_of_group(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first place of the connected group of each of ``n`` places."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least


# ------------------------------------------------------------------ DataFrames

def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lines(rows: DataFrame, level: int) -> DataFrame:
    """``rows`` with ``p``, the places of the unit vectors on the lines of a
    level."""
    schema = T.StructType([*rows.schema.fields, T.StructField("p", T.ArrayType(T.FloatType()))])
    arrow = _arrow_schema(schema)
    at, wide = rows.columns.index("v"), rows.columns.index("dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(wide).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = scaled(_matrix(part.column(at), dim))
                p = x / np.linalg.norm(x, axis=1)[:, None] @ directions(dim, LINES, level + 1)
                edges = pa.array(np.arange(len(part) + 1) * LINES, pa.int32())
                own = pa.ListArray.from_arrays(edges, pa.array(p.astype(np.float32).reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, own.cast(arrow.field("p").type)], schema=arrow)

    return rows.mapInArrow(run, schema)


def deal(classes: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """``classes`` (label, dim, v and more) dealt into cells: ``path`` and
    ``block`` name a cell of a label and length, ``also`` has a bit for each
    second half whose first half holds the row as well, and rows of a block
    with a ``side`` meet those of the other side only."""
    margin = MARGIN * reach(cosine)
    rows = classes.withColumns({"path": F.lit(1).cast("long"), "also": F.lit(0).cast("long")})
    whole = {"block": F.lit(-1).cast("long"), "side": F.lit(-1)}
    dealt: list[DataFrame] = []
    for level in range(DEEPEST + 1):
        rows = stored(rows)
        columns = rows.columns
        big = stored(rows.groupBy(*CELL_KEY).count().filter(F.col("count") > cell))
        if big.isEmpty():
            break
        dealt.append(rows.join(big, CELL_KEY, "left_anti").select(columns).withColumns(whole))
        placed = stored(_lines(rows.join(big.select(CELL_KEY), CELL_KEY).select(columns), level))
        quartiles = placed.groupBy(*CELL_KEY).agg(*[
            F.percentile_approx(F.col("p")[k], [0.25, 0.5, 0.75], 1000).alias(f"q{k}") for k in range(LINES)])
        # the line with most room between the median and the nearer quartile
        best = F.greatest(*[F.struct(F.least(F.col(f"q{k}")[2] - F.col(f"q{k}")[1],
                                             F.col(f"q{k}")[1] - F.col(f"q{k}")[0]).alias("room"),
                                     F.col(f"q{k}")[1].alias("cut"), F.lit(k).alias("line"))
                            for k in range(LINES)])
        cuts = stored(quartiles.select(*CELL_KEY, best.alias("best")).join(big, CELL_KEY)
                      .select(*CELL_KEY, "best.*", "count"))
        joined = placed.join(cuts, CELL_KEY)
        can = (F.col("room") > margin) & F.lit(level < DEEPEST)
        place = F.element_at("p", F.col("line") + 1)
        left, right = place <= F.col("cut") + margin, place >= F.col("cut") - margin
        twice = F.col("also").bitwiseOR(F.when(left, F.lit(1 << level)).otherwise(F.lit(0)).cast("long"))
        halves = F.filter(F.array(
            F.struct(left.alias("holds"), (F.col("path") * 2).alias("path"), F.col("also").alias("also")),
            F.struct(right.alias("holds"), (F.col("path") * 2 + 1).alias("path"), twice.alias("also"))),
            lambda h: h["holds"])
        rest = [c for c in columns if c not in ("path", "also")]
        rows = (joined.filter(can).select(*rest, F.explode(halves).alias("half"))
                .select(*rest, "half.path", "half.also").select(columns))
        parts = F.ceil(F.col("count") * 2 / cell)
        own = F.pmod(F.xxhash64("h1", "h2"), F.col("parts"))
        cells = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: F.struct(
            (F.least(F.col("own"), o) * F.col("parts") + F.greatest(F.col("own"), o)).alias("block"),
            F.when(F.col("own") == o, -1).when(F.col("own") < o, 0).otherwise(1).alias("side")))
        # parts of one pair meet across; those of a part with itself, all
        dealt.append(joined.filter(~can).withColumn("parts", parts).withColumn("own", own)
                     .select(*columns, F.explode(cells).alias("cell")).select(*columns, "cell.*"))
    else:
        big = None
    out = rows.withColumns(whole) if big is not None else rows.filter("false").withColumns(whole)
    for df in dealt:
        out = out.unionByName(df)
    return out


def compare(cells: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(node, links, root) of the linked classes of every cell; ``links``
    counts the copies of the classes a class links with in this cell, and
    ``root`` is the first class of its connected group there."""
    node = T.StructType([cells.schema[c] for c in NODE])
    schema = T.StructType([T.StructField("node", node), T.StructField("links", T.LongType()),
                           T.StructField("root", node)])
    arrow = _arrow_schema(schema)

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, sort_keys=[(c, "ascending") for c in NODE],
                                           null_placement="at_end")).combine_chunks()
        copies, also, side = (group[c].to_numpy() for c in ("copies", "also", "side"))
        links, left, right = np.zeros(len(group), np.int64), [], []
        for a, b in near_pairs(_matrix(group["v"], key[1].as_py()), cosine):
            own = ((also[a] & also[b]) == 0) & ((side[a] != side[b]) | (side[a] < 0))
            a, b = a[own], b[own]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            left.append(a.astype(np.int32))
            right.append(b.astype(np.int32))
        at = np.flatnonzero(links)
        root = first_of_group(len(group), *(np.concatenate(x) for x in (left, right)))[at] if len(at) else at
        fields = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (group[c] for c in NODE)]
        nodes = pa.StructArray.from_arrays(fields, fields=list(arrow.field("node").type))
        return pa.Table.from_arrays([nodes.take(pa.array(at)), pa.array(links[at]), nodes.take(pa.array(root))],
                                    schema=arrow)

    # a block of unlike sides holds the rows of both; one of a part with itself has side -1
    return (cells.select(*CELL_KEY, "block", *NODE, "copies", "also", "side", "v")
            .groupBy(*CELL_KEY, "block").applyInArrow(run, schema))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """(<key>, n_links, component_id, kept) of every row: the number of other
    vectors linked directly, the smallest key reachable by links, and whether
    it is the row's own."""
    able = usable(vector) & F.col(label).isNotNull()
    rows = vectors.select(F.col(key).alias("id"), F.when(able, F.col(label)).alias("label"),
                          F.when(able, F.col(vector).cast("array<double>")).alias("v"))

    def mark(k: int) -> Column:
        return F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(k), "label", "v"))

    marked = rows.withColumns({"h1": mark(1), "h2": mark(2)})
    classes = stored(marked.filter(F.col("v").isNotNull()).groupBy("h1", "h2").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("v").alias("v")).withColumns({"absent": F.col("id").isNull(), "dim": F.size("v")}))
    found = stored(compare(deal(classes, cosine, cell), cosine))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = counts.join(joined, "node", "left").select("node.h1", "node.h2", "links", F.col("root.id").alias("first"))
    done = stored(classes.select("h1", "h2", "id", "copies").join(linked, ["h1", "h2"], "left").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("links").isNotNull(), F.col("first")).otherwise(F.col("id")).alias("first")))
    out = (marked.select("id", "h1", "h2").join(done, ["h1", "h2"], "left")
           .withColumn("first", F.when(F.col("h1").isNotNull(), F.col("first")).otherwise(F.col("id"))))
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.col("first").alias("component_id"), F.col("id").eqNullSafe(F.col("first")).alias("kept"))
