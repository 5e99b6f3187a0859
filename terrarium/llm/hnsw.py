"""Approximate nearest neighbours with one small-world graph per shard.

Vectors are dealt into shards of bounded size.  Each shard's hierarchical
navigable small-world graph is built in one task, in numpy, and stored as flat
neighbour arrays in a table (one row a shard).  Every query walks every
shard's graph; the candidates it meets are scored exactly, in double
precision on the original vectors, and the shards' best are merged.

Nodes are distinct vectors: of equal vectors only the ``k`` + 1 smallest ids
can be among a query's ``k`` nearest, so each node carries those, and copies
cost no links.  Building and searching move many nodes or queries side by
side; nodes that are inserted together also see each other.

The measure is the largest cosine, ties go to the smaller id.  Vectors that
are null, zero, or hold null or non-finite components take no part; vectors
of different lengths never meet.  Repeated rows (same id and vector) count
once; a null id takes no part; an empty table gives an empty result; a query
with fewer candidates gets all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import _arrow_schema, stored

#: Links of a node (twice as many in the lowest layer), and the width of the
#: beam when building and when searching.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 80, 96
#: Nodes of a shard: at most so many, and so many bytes of vectors.
SHARD_ROWS, SHARD_BYTES = 8192, 32 << 20
#: Nodes inserted, and queries searched, side by side; nodes expanded at once.
TOGETHER, EXPAND = 256, 4
NONE = -1


@dataclass
class Graph:
    """unit: vectors of length one (float32); layers: for each layer the
    links (rows, links) of its nodes, by ``place``; place[l][node] is the
    node's row in layer l, or NONE."""

    unit: np.ndarray
    layers: list[np.ndarray]
    place: list[np.ndarray]
    entry: int


def search_layer(unit: np.ndarray, links: np.ndarray, place: np.ndarray, queries: np.ndarray,
                 entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes found (queries, beam), nearest first, and
    their distances; ``entries`` are (queries, any) nodes to start from."""
    q = len(queries)
    rows = np.arange(q)[:, None]
    ids = np.full((q, beam), NONE, np.int32)
    far = np.full((q, beam), np.inf, np.float32)
    seen = np.zeros((q, len(unit)), bool)
    start = entries[:, :beam]
    ids[:, :start.shape[1]] = start
    far[:, :start.shape[1]] = np.where(start >= 0, 1 - np.einsum("qed,qd->qe", unit[start], queries), np.inf)
    seen[rows, start] = True
    done = np.zeros((q, beam), bool)
    while True:
        open_ = np.where(done | (ids < 0), np.inf, far)
        pick = np.argpartition(open_, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
        able = np.isfinite(np.take_along_axis(open_, pick, axis=1))
        active = np.flatnonzero(able.any(axis=1))
        if not len(active):
            break
        pick, able, at = pick[active], able[active], active[:, None]
        done[at, pick] = True
        # done of places that hold no open node does no harm: they are done or empty
        near = links[place[np.maximum(ids[at, pick], 0)]]                  # active, EXPAND, links
        near = np.where(able[:, :, None], near, NONE).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = NONE
        near[seen[at, near]] = NONE
        keep = np.flatnonzero((near >= 0).any(axis=0))
        near = near[:, keep]
        if near.shape[1]:
            seen[at, np.where(near < 0, ids[at, pick[:, :1]], near)] = True
            d = 1 - np.einsum("qed,qd->qe", unit[near], queries[active], optimize=True)
            d[near < 0] = np.inf
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_far = np.concatenate([far[active], d], axis=1)
            all_done = np.concatenate([done[active], np.zeros_like(near, bool)], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, axis=1)
            far[active] = np.take_along_axis(all_far, best, axis=1)
            done[active] = np.take_along_axis(all_done, best, axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
    ids[~np.isfinite(far)] = NONE
    return ids, far


def choose(unit: np.ndarray, ids: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` links (nodes, most) from candidates in rising distance:
    those nearer to the node than to any chosen one, then the nearest rest."""
    n, c = ids.shape
    x = unit[ids]
    between = 1 - np.matmul(x, x.transpose(0, 2, 1))
    taken = np.zeros((n, c), bool)
    nearest = np.full((n, c), np.inf, np.float32)        # to any chosen one
    count = np.zeros(n, np.int64)
    for k in range(c):
        fits = (ids[:, k] >= 0) & (far[:, k] < nearest[:, k]) & (count < most)
        taken[:, k] = fits
        count += fits
        np.minimum(nearest, np.where(fits[:, None], between[:, k, :], np.inf), out=nearest)
    place = np.where(ids < 0, 2 * c, np.where(taken, 0, c) + np.arange(c))
    order = np.argsort(place, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(np.where(ids < 0, NONE, ids), order, axis=1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((n, most - out.shape[1]), NONE, out.dtype)], axis=1)
    return out


def build(vectors: np.ndarray, seed: int = 17) -> Graph:
    """The graph over distinct non-zero vectors (n, d), n >= 1."""
    n = len(vectors)
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(rng.random(n) + 1e-12) / math.log(LINKS)).astype(int), 12)
    layers, place = [], []
    for k in range(level.max() + 1):
        own = np.flatnonzero(level >= k)
        at = np.full(n, NONE, np.int32)
        at[own] = np.arange(len(own))
        place.append(at)
        layers.append(np.full((len(own), LINKS * 2 if k == 0 else LINKS), NONE, np.int32))
    graph = Graph(unit, layers, place, 0)
    top = -1                                        # highest layer with a node in the graph
    for first in range(0, n, TOGETHER):
        batch = np.arange(first, min(n, first + TOGETHER))
        x = unit[batch]
        entries = np.full((len(batch), 1), graph.entry, np.int32)
        for k in range(max(top, int(level[batch].max())), -1, -1):
            own = np.flatnonzero(level[batch] >= k)
            if k <= top:
                rest = np.flatnonzero(level[batch] < k)
                if len(rest):
                    entries[rest, :1] = search_layer(unit, layers[k], place[k], x[rest], entries[rest, :1], 1)[0]
                if len(own):
                    ids, far = search_layer(unit, layers[k], place[k], x[own], entries[own], BUILD_BEAM)
            else:
                ids = np.full((len(own), 1), NONE, np.int32)
                far = np.full((len(own), 1), np.inf, np.float32)
            if not len(own):
                continue
            # nodes inserted together see each other
            mates = np.broadcast_to(batch[own].astype(np.int32), (len(own), len(own)))
            apart = 1 - x[own] @ x[own].T
            np.fill_diagonal(apart, np.inf)
            ids, far = np.concatenate([ids, mates], axis=1), np.concatenate([far, apart], axis=1)
            order = np.argsort(far, axis=1, kind="stable")[:, :BUILD_BEAM]
            ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
            ids = np.where(np.isfinite(far), ids, NONE)
            _link(graph, k, batch[own], choose(unit, ids, far, LINKS))
            if k <= top:
                entries[own, 0] = np.where(ids[:, 0] >= 0, ids[:, 0], entries[own, 0])
                # a mate may not be reachable yet from the layer below: start from the graph
                entries[own, 0] = np.where(entries[own, 0] >= first, graph.entry, entries[own, 0])
        highest = int(level[batch].max())
        if highest > top:
            top, graph.entry = highest, int(batch[level[batch].argmax()])
    return graph


def _link(graph: Graph, layer: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Sets the links of new nodes and adds the ones back; a node with too
    many keeps the best by the same rule."""
    links, place, unit = graph.layers[layer], graph.place[layer], graph.unit
    most = links.shape[1]
    links[place[nodes], :chosen.shape[1]] = chosen
    source = np.repeat(nodes, chosen.shape[1])
    target = chosen.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    while len(target):
        # at most LINKS new links of a target at a time
        first = np.flatnonzero(np.diff(target, prepend=-1))
        nth = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        now = nth < LINKS
        own, row = np.unique(target[now], return_inverse=True)
        offered = np.full((len(own), LINKS), NONE, np.int32)
        offered[row, nth[now]] = source[now]
        all_ids = np.concatenate([links[place[own]], offered], axis=1)
        dup = np.sort(all_ids, axis=1)
        if (dup[:, 1:][dup[:, 1:] >= 0] == dup[:, :-1][dup[:, 1:] >= 0]).any():
            for r in range(len(own)):                   # mates that chose each other
                _, at = np.unique(all_ids[r], return_index=True)
                again = np.setdiff1d(np.arange(all_ids.shape[1]), at)
                all_ids[r, again] = NONE
        far = np.where(all_ids >= 0, 1 - np.einsum("qed,qd->qe", unit[all_ids], unit[own]), np.inf).astype(np.float32)
        order = np.argsort(far, axis=1, kind="stable")
        all_ids, far = np.take_along_axis(all_ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        full = (all_ids >= 0).sum(axis=1) > most
        new = all_ids[:, :most].copy()
        if full.any():
            new[full] = choose(unit, all_ids[full], far[full], most)
        links[place[own]] = new
        source, target = source[~now], target[~now]


def search(graph: Graph, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """Nodes found near each of the queries of length one (queries, beam)."""
    entries = np.full((len(queries), 1), graph.entry, np.int32)
    for k in range(len(graph.layers) - 1, 0, -1):
        entries = search_layer(graph.unit, graph.layers[k], graph.place[k], queries, entries, 1)[0]
    return search_layer(graph.unit, graph.layers[0], graph.place[0], queries, entries, beam)[0]


# ------------------------------------------------------------------ DataFrames

INDEX = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("shard", T.LongType()),
                      T.StructField("vectors", T.BinaryType()), T.StructField("ids", T.BinaryType()),
                      T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("links", T.BinaryType()),
                      T.StructField("places", T.BinaryType())])
NO_ID = np.iinfo(np.int64).min


def usable(vector: str) -> Column:
    """Whether a vector takes part."""
    v = F.col(vector)
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0), F.lit(False))


def index(vectors: DataFrame, key: str, vector: str, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One stored row a shard: its distinct vectors, the ids they carry, and
    the graph as flat arrays."""
    rows = (vectors.filter(usable(vector) & F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .distinct())
    # the smallest ids of equal vectors; the limit is applied before the shuffle, too
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    nodes = stored(rows.withColumn("n", first).filter(F.col("n") <= k + 1)
                   .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                   .withColumn("dim", F.size("v")))
    total, widest = nodes.agg(F.count("*"), F.max("dim")).first()
    most = max(64, min(shard_rows, SHARD_BYTES // (8 * (widest or 1))))
    shards = max(1, -(-total // most))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))
    arrow = _arrow_schema(INDEX)

    def graph_of(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(parts)
        dim, shard = group["dim"][0].as_py(), group["shard"][0].as_py()
        v = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        ids = np.full((len(v), k + 1), NO_ID, np.int64)
        for r, own in enumerate(group["ids"].to_pylist()):
            ids[r, :len(own)] = own
        graph = build(v)
        return pa.RecordBatch.from_arrays([
            pa.array([x], kind) for x, kind in zip(
                (dim, shard, v.tobytes(), ids.tobytes(),
                 [graph.entry, *[s for layer in graph.layers for s in layer.shape]],
                 b"".join(layer.tobytes() for layer in graph.layers),
                 b"".join(p.tobytes() for p in graph.place)), arrow.types)], schema=arrow)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            dims = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(dims) != 0) + 1).tolist(), len(dims)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and held[0].column(0)[0].as_py() != dims[a]:
                    yield graph_of(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield graph_of(held)

    # a task for each shard: left to their few bytes, shards would be merged into few tasks
    return stored(dealt.select("dim", "shard", "v", "ids", F.col("ids")[0].alias("first"))
                  .repartitionById(shards, F.col("shard").cast("int"))
                  .sortWithinPartitions("dim", "first").mapInArrow(make, INDEX))


def load(dim: int, vectors: bytes, ids: bytes, sizes: list[int], links: bytes,
         places: bytes) -> tuple[Graph, np.ndarray, np.ndarray]:
    """(graph, original vectors, ids) of a row of the index."""
    v = np.frombuffer(vectors, np.float64).reshape(-1, dim)
    layers, at = [], 0
    for n, width in zip(sizes[1::2], sizes[2::2]):
        layers.append(np.frombuffer(links, np.int32, n * width, at * 4).reshape(n, width))
        at += n * width
    place = np.frombuffer(places, np.int32).reshape(len(layers), len(v))
    unit = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    return (Graph(unit, layers, list(place), sizes[0]), v,
            np.frombuffer(ids, np.int64).reshape(len(v), -1))


def nearest_in(graph: Graph, vectors: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, cosine) of the ``k`` nearest that the graph finds."""
    unit = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype(np.float32)
    found = search(graph, unit)
    row, col = np.nonzero(found >= 0)
    node = found[row, col]
    score = np.einsum("nd,nd->n", vectors[node], queries[row]) / (
        np.linalg.norm(vectors, axis=1)[node] * np.linalg.norm(queries, axis=1)[row])
    width = ids.shape[1]
    who, row, score = ids[node].reshape(-1), np.repeat(row, width), np.repeat(score, width)
    keep = (who != NO_ID) & (who != query_ids[row])
    who, row, score = who[keep], row[keep], score[keep]
    order = np.lexsort((who, -score, row))
    who, row, score = who[order], row[order], score[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    best = nth < k
    return query_ids[row[best]], who[best], score[best]


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, <key>, score): the ``k`` nearest of every query row,
    the query's own id excepted."""
    graphs = index(vectors, key, vector, k, shard_rows)
    asked = (queries.filter(usable(vector) & F.col(key).isNotNull())
             .select(F.col(key).cast("long").alias("query"), F.col(vector).cast("array<double>").alias("v"))
             .distinct().withColumn("dim", F.size("v")))
    # a shard's row first, then all queries, a slice at a time: a task holds one shard
    one = graphs.select("dim", "shard", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("query"),
                        F.lit(None).cast("array<double>").alias("v"), "vectors", "ids", "sizes", "links", "places")
    cells = graphs.select("dim", "shard")
    many = asked.join(cells, "dim").select(
        "dim", "shard", F.lit(1).alias("turn"), "query", "v",
        *[F.lit(None).cast(INDEX[c].dataType).alias(c) for c in ("vectors", "ids", "sizes", "links", "places")])
    shards = (graphs.agg(F.max("shard")).first()[0] or 0) + 1
    ordered = (one.union(many).repartitionById(shards, F.col("shard").cast("int"))
               .sortWithinPartitions("dim", "shard", "turn", "query"))
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField(key, T.LongType()),
                           T.StructField("score", T.DoubleType())])
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            turns = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(turns) != 0) + 1).tolist(), len(turns)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if turns[a] == 0:
                    # shards without queries in between leave only the last one
                    held = load(batch.column(0)[b - 1].as_py(), *(batch.column(c)[b - 1].as_py() for c in range(5, 10)))
                    continue
                dim = batch.column(0)[a].as_py()
                for i in range(a, b, TOGETHER):
                    part = batch.slice(i, min(TOGETHER, b - i))
                    own = part.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    got = nearest_in(*held, part.column(3).to_numpy(), own, k)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], schema=arrow)

    found = ordered.mapInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key)))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", key, "score")
