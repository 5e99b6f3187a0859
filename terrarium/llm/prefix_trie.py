"""The prefix trie of conversations, as a sharded node table.

Conversations are rebuilt (``rebuilt``), and every prefix of a rebuilt
conversation is a node.  A prefix is named by its depth and 128 bits: the
exclusive or of hashes of (position, role, text), so prefixes of a
conversation are running sums over its sorted turns.  Turns are sorted by
range over all conversations and summed partition by partition, with the sums
of earlier partitions joined in where a conversation crosses a border: a
conversation of any length is spread over tasks.

Prefixes are reduced to distinct nodes with counts before anything else.  A
node is heavy if what follows in its members' turns could be more than
``SUBTREE`` nodes; the subtrees below heavy nodes are dealt whole into shards.
A shard enumerates its digests, gives each a slot by a minimal perfect hash
(every look-up compares the whole digest), scatters the counts into flat
arrays and adds them up through the array of parent slots, deepest first.
Sums of the heavy nodes are taken over the tops of the shards by doubling:
each round, every node adds what the nodes 2^k below it have gathered, so a
path of any length takes a logarithmic number of rounds.

Member lists are hashed as sorted streams: ids are joined in runs by sorted
ranges, and a node's runs are fed to its digest in order, so no list is held.

Rows: a null conv_id names no conversation; a null role or text counts as
empty; turns are ordered with null first, equal turns by role, then text;
repeated rows are turns of their own; texts may be of any length (they are
read once, for their hash and words).  An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import _arrow_schema, stored

#: Conversations that share a base, and what its head's length is taken modulo.
GROUP, HEADS = 20, 4
#: Nodes of a subtree that a shard takes whole, and of a shard on average.
SUBTREE, SHARD = 2048, 4096
#: Bytes of ids joined in a run.
RUN_BYTES = 1 << 16
#: Places of a hash level for each key that is left.
SPARE = 1.5
WORDS = r"[^\x20\x09-\x0D]+"
PREFIX = ["depth", "x1", "x2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------- running sums

def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return first, np.diff(np.append(first, len(key)))


def running(rows: DataFrame, group: str, order: list, xors: list[str]) -> DataFrame:
    """``rows`` with ``nth``, their place in their group by ``order`` (from
    0), and the columns ``xors`` replaced by their exclusive or up to the row.

    The order may leave open only which of equal rows comes first."""
    keep = [c for c in rows.columns if c not in xors]
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("part", T.IntegerType()),
                           T.StructField("nth", T.LongType()), *[T.StructField(x, T.LongType()) for x in xors]])
    arrow = _arrow_schema(schema)
    placed = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).select(*keep, *xors)
    own, k = keep.index(group), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, held = None, 0, [np.int64(0)] * len(xors)
        for batch in batches:
            if not len(batch):
                continue
            key = batch.column(own).to_numpy()
            first, sizes = _groups(key)
            nth = np.arange(len(key)) - np.repeat(first, sizes)
            goes_on = slice(0, sizes[0] if key[0] == last else 0)
            nth[goes_on] += count
            sums = []
            for i in range(len(xors)):
                so_far = np.bitwise_xor.accumulate(batch.column(k + i).to_numpy())
                so_far = so_far ^ np.repeat(np.concatenate([[0], so_far[first[1:] - 1]]), sizes)
                so_far[goes_on] ^= held[i]
                sums.append(so_far)
            last, count, held = key[-1], nth[-1] + 1, [s[-1] for s in sums]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(k)], pa.array(np.full(len(key), part), pa.int32()),
                 pa.array(nth), *[pa.array(s) for s in sums]], schema=arrow)

    local = stored(placed.mapInArrow(run, schema))
    totals = local.groupBy(group, "part").agg(
        (F.max("nth") + 1).alias("n"), *[F.max_by(x, "nth").alias(x) for x in xors])
    # one row a group and partition; a group has more than one only where it crosses a border
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(totals.select(group, "part", F.sum("n").over(before).alias("_n"),
                                   *[F.expr(f"bit_xor({x})").over(before).alias(f"_{x}") for x in xors])
                     .filter(F.col("_n").isNotNull()))
    return (local.join(offsets, [group, "part"], "left").select(
        *keep, (F.col("nth") + F.coalesce("_n", F.lit(0))).alias("nth"),
        *[F.col(x).bitwiseXOR(F.coalesce(f"_{x}", F.lit(0))).alias(x) for x in xors]))


# --------------------------------------------------------------- conversations

def turns(conversations: DataFrame) -> DataFrame:
    """(conv, nth, m1, m2, words) of every turn; m1 and m2 stand for role and
    text."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        text("role").alias("role"), text("text").alias("text"))
    # texts are moved only where the order of equal turns needs them
    tied = stored(rows.groupBy("conv", "turn").count().filter(F.col("count") > 1)
                  .select(F.col("conv").alias("c"), F.col("turn").alias("t")))
    marked = rows.join(tied, (F.col("conv") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left").select(
        "conv", "turn", F.when(F.col("c").isNotNull(), F.struct("role", "text")).alias("tie"),
        *[F.xxhash64(F.lit(k), "role", "text").alias(f"m{k}") for k in (1, 2)],
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"), F.rand(7).alias("salt"))
    # equal rows are told apart by the salt alone, so that many of them are spread
    narrow = stored(marked.select("conv", "turn", "tie", "salt", "m1", "m2", "words"))
    return running(narrow, "conv", ["turn", "tie", "salt"], []).select("conv", "nth", "m1", "m2", "words")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after the exchange of heads: the first h turns
    of conversation c - c % ``GROUP``, then c's own after its first h, with
    h = crc32(c) % ``HEADS``."""
    sizes = stored(own.groupBy("conv").agg((F.max("nth") + 1).alias("n")))
    base = F.col("conv") - F.col("conv") % GROUP
    heads = F.crc32(F.col("conv").cast("string")) % HEADS
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = stored(sizes.withColumns({"base": base, "h": heads}).join(bases, "base", "left")
                   .withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
                   .withColumn("size", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
                   .select("conv", "base", "h", "head", "size"))
    marks = ["m1", "m2", "words", "size"]
    tails = (own.join(convs, "conv").filter(F.col("nth") >= F.col("h"))
             .select("conv", (F.col("nth") - F.col("h") + F.col("head")).alias("pos"), *marks))
    firsts = own.filter((F.col("nth") < HEADS - 1) & (F.col("conv") % GROUP == 0)).withColumnRenamed("conv", "base")
    # a base has few heads' turns and at most GROUP conversations
    led = (firsts.join(convs, "base").filter(F.col("nth") < F.col("head"))
           .select("conv", F.col("nth").alias("pos"), *marks))
    return tails.unionByName(led), convs.select("conv", "size")


def prefixes(rebuilt_turns: DataFrame) -> DataFrame:
    """(conv, depth, x1, x2, p1, p2, words, size): every prefix of every
    conversation with at least one turn, and its parent's digest."""
    salted = rebuilt_turns.withColumns({
        f"s{k}": F.xxhash64(F.lit(k), "pos", "m1", "m2") for k in (1, 2)})
    rows = running(salted.select("conv", "pos", "words", "size", "s1", "s2",
                                 F.col("s1").alias("x1"), F.col("s2").alias("x2")), "conv", ["pos"], ["x1", "x2"])
    return rows.select("conv", (F.col("pos") + 1).alias("depth"), "x1", "x2",
                       F.col("x1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("s2")).alias("p2"),
                       "words", "size")


# --------------------------------------------------------------------- shards

class Slots:
    """A minimal perfect hash of distinct keys (rows of int64 columns) onto
    0 .. n - 1, with the keys stored in their slots.

    On each level the keys that are left are hashed to ``SPARE`` places each;
    those alone at a place keep it, and a slot is the rank of its place among
    the places kept."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []           # rank of each kept place, else -1
        left, ranked = keys, 0
        while len(left):
            place = self._place(left, len(self.levels), size := max(2, int(SPARE * len(left))))
            kept = np.bincount(place, minlength=size) == 1
            self.levels.append(np.where(kept, ranked + np.cumsum(kept) - 1, -1))
            ranked += int(kept.sum())
            left = left[~kept[place]]
        self.keys = np.zeros_like(keys)
        self.keys[self._candidates(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        h = np.full(len(keys), (level * 0x9E3779B97F4A7C15 + 1) % (1 << 64), np.uint64)
        for column in keys.T:
            h ^= np.ascontiguousarray(column).view(np.uint64)
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
        return (h % np.uint64(size)).astype(np.int64)

    def _candidates(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        for level, ranks in enumerate(self.levels):
            open_ = np.flatnonzero(slot < 0)
            if not len(open_):
                break
            slot[open_] = ranks[self._place(keys[open_], level, len(ranks))]
        return slot

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slots of ``keys``; -1 for those that are not there."""
        slot = self._candidates(keys)
        there = np.flatnonzero(slot >= 0)
        wrong = (self.keys[slot[there]] != keys[there]).any(axis=1)
        slot[there[wrong]] = -1
        return slot


def accumulate(parent: np.ndarray, depth: np.ndarray, values: list[np.ndarray]) -> None:
    """Adds every slot's values to its parent's, deepest first, in place."""
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[order])) + 1
    for at in np.split(order, edges):
        at = at[parent[at] >= 0]
        for v in values:
            np.add.at(v, parent[at], v[at])


NODE = T.StructType([T.StructField(c, T.LongType()) for c in (
    "depth", "x1", "x2", "p1", "p2", "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved")])


def sharded(nodes: DataFrame) -> DataFrame:
    """``NODE`` rows of the nodes (with column ``shard``) of whole subtrees;
    ``parent_conv`` is null for a subtree's top."""
    arrow = _arrow_schema(NODE)

    def run(group: pa.Table) -> pa.Table:
        raw = {c: group[c].to_numpy() for c in ("depth", "x1", "x2", "p1", "p2", "conv", "n_convs", "words")}
        table = Slots(np.stack([raw[c] for c in PREFIX], axis=1))
        slot = table.find(np.stack([raw[c] for c in PREFIX], axis=1))
        flat = {c: np.empty_like(v) for c, v in raw.items()}
        for c, v in raw.items():
            flat[c][slot] = v
        parent = table.find(np.stack([flat["depth"] - 1, flat["p1"], flat["p2"]], axis=1))
        inner = parent >= 0
        children = np.bincount(parent[inner], minlength=len(slot)).astype(np.int64)
        leaves = (children == 0).astype(np.int64)
        saved = (flat["n_convs"] - 1) * flat["words"]
        accumulate(parent, flat["depth"], [leaves, saved])
        return pa.Table.from_arrays(
            [*[pa.array(flat[c]) for c in ("depth", "x1", "x2", "p1", "p2", "conv")],
             pa.array(flat["conv"][np.where(inner, parent, 0)], mask=~inner), pa.array(flat["n_convs"]),
             pa.array(children), pa.array(leaves), pa.array(saved)], schema=arrow)

    return nodes.select("shard", *PREFIX, "p1", "p2", "conv", "n_convs", "words").groupBy("shard").applyInArrow(run, NODE)


# ---------------------------------------------------------------------- trie

def heavy_sums(heavy: DataFrame, tops: DataFrame) -> DataFrame:
    """``NODE`` rows of the heavy nodes (the root among them), given the rows
    of the shards' tops."""
    own = heavy.select(F.col("depth").alias("d"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                       F.col("conv").alias("parent_conv"))
    linked = stored(heavy.withColumn("d", F.col("depth") - 1).join(own, ["d", "p1", "p2"], "left").drop("d"))
    below = (tops.select("depth", "p1", "p2", "n_leaves", "saved")
             .unionByName(linked.filter(F.col("depth") > 0).select(
                 "depth", "p1", "p2", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved")))
             .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
             .agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("from_tops")))
    zero = F.lit(0).cast("long")
    nodes = stored(linked.join(below, PREFIX, "left").select(
        *PREFIX, "p1", "p2", "conv", "parent_conv", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        (F.coalesce("from_tops", zero) + (F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    # a node is known by its smallest member and its depth; up: the node 2^k above it
    state = stored(nodes.select("conv", "depth", F.col("parent_conv").alias("up"), "n_leaves", "saved"))
    step = 1
    while not (climbing := state.filter(F.col("up").isNotNull())).isEmpty():
        gathered = climbing.groupBy(F.col("up").alias("conv"), (F.col("depth") - step).alias("depth")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.select(F.col("conv").alias("up"), (F.col("depth") + step).alias("depth"), F.col("up").alias("next"))
        state = stored(state.join(gathered, ["conv", "depth"], "left").join(above, ["up", "depth"], "left").select(
            "conv", "depth", F.col("next").alias("up"),
            (F.col("n_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved")))
        step *= 2
    return nodes.drop("n_leaves", "saved").join(state.drop("up"), ["conv", "depth"]).select(NODE.names)


def ends(rows: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the nodes at which a conversation
    ends; ``rows`` has (depth, x1, x2, conv) of each conversation's last
    prefix."""
    runs = T.StructType([*[T.StructField(c, T.LongType()) for c in PREFIX], T.StructField("part", T.IntegerType()),
                         T.StructField("nth", T.LongType()), T.StructField("ids", T.StringType())])
    done = T.StructType([*[T.StructField(c, T.LongType()) for c in PREFIX], T.StructField("ends_sha256", T.StringType())])
    arrow, arrow_done = _arrow_schema(runs), _arrow_schema(done)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not len(batch):
                continue
            key = np.stack([batch.column(k).to_numpy() for k in range(3)])
            ids = batch.column(3).to_pylist()
            edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            cuts, least = [0, *edge.tolist(), len(ids)], RUN_BYTES // 20
            spans = [(i, min(i + least, b)) for a, b in zip(cuts, cuts[1:]) for i in range(a, b, least)]
            at = [a for a, _ in spans]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(key[k][at]) for k in range(3)], pa.array([part] * len(at), pa.int32()),
                 pa.array(np.arange(nth, nth + len(at))), pa.array([",".join(map(str, ids[a:b])) for a, b in spans])],
                schema=arrow)
            nth += len(at)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for batch in batches:
            found = []
            for d, a, b, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 5))):
                if (d, a, b) == last:
                    sha.update(b"," + ids.encode())
                else:
                    if last:
                        found.append((*last, sha.hexdigest()))
                    last, sha = (d, a, b), hashlib.sha256(ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], schema=arrow_done)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*last, sha.hexdigest())], schema=arrow_done)

    order = [*PREFIX, "conv"]
    pieces = stored(rows.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, runs))
    return pieces.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "part", "nth").mapInArrow(hashed, done)


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of every node."""
    turned, convs = rebuilt(turns(conversations))
    rows = stored(prefixes(turned))
    zero = F.lit(0).cast("long")
    root = (convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).filter(F.col("n_convs") > 0)
            .select(*[zero.alias(c) for c in (*PREFIX, "p1", "p2")], "conv", "n_convs", zero.alias("words")))
    nodes = stored(rows.groupBy(*PREFIX).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
        F.max("words").alias("words"), F.sum(F.col("size") - F.col("depth") + 1).alias("follows")))
    heavy = stored(nodes.filter(F.col("follows") > SUBTREE))
    light = nodes.filter(F.col("follows") <= SUBTREE)
    # the first light node on a conversation's path is the top of its shard's subtree
    marked = rows.join(heavy.select(*PREFIX, F.lit(True).alias("heavy")), PREFIX, "left").filter(F.col("heavy").isNull())
    tops = marked.groupBy("conv").agg(F.min(F.struct(*PREFIX)).alias("top"))
    shards = -(-light.count() // SHARD)
    dealt = light.join(tops, "conv").withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(max(1, shards))))
    inner = stored(sharded(dealt))
    crown = stored(heavy.drop("follows").unionByName(root))
    outer = heavy_sums(crown, inner.filter(F.col("parent_conv").isNull()))
    over = crown.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                        F.col("conv").alias("over"))
    # only tops have their parent among the heavy nodes
    inner = (inner.join(over, ["depth", "p1", "p2"], "left")
             .withColumn("parent_conv", F.coalesce("parent_conv", "over")).select(NODE.names))
    last = (rows.filter(F.col("depth") == F.col("size")).select(*PREFIX, "conv")
            .unionByName(convs.filter(F.col("size") == 0).select(*[zero.alias(c) for c in PREFIX], "conv")))
    return (inner.unionByName(outer).join(ends(last), PREFIX, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))
