"""SimHash near-duplicates with a bit-sliced comparison.

A fingerprint has 64 bits; two link if they differ in at most ``RADIUS`` bits.
Candidates come from blocking: the bits are cut into ``BLOCKS`` parts, and two
fingerprints within the radius agree on at least ``BLOCKS - RADIUS`` of them,
so every link is found in the table of some combination of that many parts.
Inside a bucket nothing is compared value by value: the bit planes are stored
vertically (one machine word holds the same bit of 64 fingerprints), the
distances of a whole block are updated with carry-save counters, and a block
is given up once all its distances exceed the radius.

Only distinct fingerprints are compared, so exact copies cost nothing.  A
bucket with more than ``BUCKET`` fingerprints is dealt out in cells, one for
each pair of its parts, so no task holds an unbounded bucket and no pair is
lost.  Inside a bucket a spanning star of each connected group is returned,
not all its pairs.

Rows: null and empty texts, and texts without a word, have fingerprint zero
and are linked like any other; repeated rows share a component; a null doc_id
is never a component's id unless the component has no other (then null); an
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import map_texts, masked, stored, unmasked
from terrarium.llm.components import components

WORDS, SEED, RADIUS, BITS = 3, 42, 3, 64
BLOCKS = 6
#: Fingerprints of a bucket that are compared in one task.
BUCKET = 4096
#: Buckets up to this size are compared side by side with their neighbours.
SMALL = 32
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- fingerprint

def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash over ``words``-word shingles, repeats included."""
    # bytes are lower-cased and split by exactly the ASCII letters and white space
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        shingles = [joined]
    else:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        stops = np.cumsum(sizes + 1) - 1
        starts = (stops - sizes)[:len(found) - words + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(starts, stops[words - 1:].tolist())]
    digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), np.uint8)
    ones = np.zeros(BITS, np.int64)
    for part in np.array_split(digests.reshape(-1, 8), -(-len(shingles) // 16384)):
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(shingles)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words: int = WORDS,
                 seed: int = SEED) -> DataFrame:
    """``keep`` columns plus ``fp``, the fingerprint as a signed long."""
    return map_texts(docs, text, keep, T.StructType([T.StructField("fp", T.LongType())]),
                     lambda texts: {"fp": [_signed(fingerprint(t, words, seed)) for t in texts]})


# ------------------------------------------------------- bit-sliced comparison

def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes (64, words) of unsigned 64-bit values; value k is bit k % 64
    of word k // 64.  Missing places of the last word are zero."""
    n = len(values)
    lanes = np.zeros(-(-n // 64) * 64, np.uint64)
    lanes[:n] = values
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def beyond(diffs: Iterator[np.ndarray], shape, radius: int = RADIUS) -> np.ndarray:
    """Words whose bits mark the lanes with more than ``radius`` ones in all
    ``diffs``, the planes of differing bits.

    Three planes at a time go through a full adder; its sum and its carry are
    added to vertical counters with as many bits as the radius needs, and a
    carry out of the top sticks.  Stops once every lane is beyond."""
    size = radius.bit_length()
    counters = [np.zeros(shape, np.uint64) for _ in range(size)]
    over = np.zeros(shape, np.uint64)

    def add(x: np.ndarray, weight: int) -> None:
        for k in range(weight, size):
            counters[k], x = counters[k] ^ x, counters[k] & x
        np.bitwise_or(over, x, out=over)

    group: list[np.ndarray] = []
    seen = 0
    for d in diffs:
        group.append(d)
        if len(group) < 3:
            continue
        a, b, c = group
        group = []
        half = a ^ b
        add(half ^ c, 0)
        add((a & b) | (half & c), 1)
        seen += 1
        if seen % 4 == 0 and (_more(counters, over, radius) == FULL).all():
            return np.full(shape, FULL)
    for d in group:
        add(d, 0)
    return _more(counters, over, radius)


def _more(counters, over, radius):
    """Lanes whose counter is above the radius or has overflowed."""
    more, equal = over.copy(), np.full(over.shape, FULL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            more = more | (equal & counters[k])
            equal = equal & ~counters[k]
    return more


def _lanes(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little")[:n].astype(bool)


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each k, whether left[k] and right[k] are within the radius."""
    x = planes(left ^ right)
    return ~_lanes(beyond(iter(x), x.shape[1], radius), len(left))


def _far(x: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Words (queries, words) marking the lanes beyond the radius of each query."""
    bits = queries[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)
    flips = np.where(bits == 1, FULL, np.uint64(0))
    return beyond((x[k][None, :] ^ flips[:, k][:, None] for k in range(BITS)),
                  (len(queries), x.shape[1]), radius)


def group_roots(values: np.ndarray, radius: int = RADIUS, at_once: int = 32) -> np.ndarray:
    """For each of the distinct, ascending ``values`` of a bucket, the place of
    the first one of its connected group.

    Every value is a query once, against the values not reached yet; the
    block is packed anew when half of its lanes are done."""
    root = np.arange(len(values))
    lanes = np.arange(len(values))
    open_ = np.ones(len(values), bool)      # by lane
    x = planes(values)
    for start in range(len(values)):
        if root[start] != start:
            continue
        open_[np.searchsorted(lanes, start)] = False
        frontier = [start]
        while frontier and open_.any():
            if open_.sum() * 2 < len(lanes):
                lanes, open_ = lanes[open_], np.ones(int(open_.sum()), bool)
                x = planes(values[lanes])
            own, frontier = frontier[:at_once], frontier[at_once:]
            near = np.bitwise_or.reduce(~_far(x, values[own], radius), axis=0)
            new = _lanes(near, len(lanes)) & open_
            open_ &= ~new
            root[lanes[new]] = start
            frontier += lanes[new].tolist()
    return root


# ---------------------------------------------------------------------- links

def masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """The bits that each blocking table compares."""
    edges = np.linspace(0, BITS, blocks + 1).astype(int).tolist()
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
          bucket: int = BUCKET) -> DataFrame:
    """Links (a, b), a != b, whose connected groups are those of all pairs of
    fingerprints (column ``fp``, distinct) within the radius."""
    rows = F.array(*[F.struct(F.lit(k).cast("byte").alias("t"),
                              F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for k, m in enumerate(masks(blocks, radius))])
    banded = distinct.select("fp", F.explode(rows).alias("r")).select("fp", "r.t", "r.key")
    hot = (banded.groupBy("t", "key").count().filter(F.col("count") > bucket)
           .select("t", "key", F.ceil(F.col("count") / bucket).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    cells = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(other, lambda o: (F.least(part, o).cast("long") * F.col("parts")
                                      + F.greatest(part, o))))
    dealt = (banded.join(hot, ["t", "key"], "left")
             .select("fp", "t", "key", F.explode(cells).alias("cell")))
    ordered = (dealt.repartition("t", "key", "cell")
               .sortWithinPartitions("t", "key", "cell", "fp")
               .select("t", "key", "cell", "fp"))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return ordered.mapInArrow(lambda batches: _compare(batches, radius), schema)


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Reads rows sorted by bucket; the last bucket of a batch waits for its
    rest in the next one."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        if not rows.shape[1]:
            continue
        changes = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
        same = held and (held[-1][:3, -1] == rows[:3, 0]).all()
        cut = int(changes[-1]) if len(changes) else (0 if same or not held else -1)
        if cut == 0 and not same:
            held.append(rows)
            continue
        if cut == -1:
            done, held = np.concatenate(held, axis=1), [rows]
        elif cut == 0:
            held.append(rows)
            continue
        else:
            done, held = np.concatenate([*held, rows[:, :cut]], axis=1), [rows[:, cut:]]
        yield from _groups(done, radius)
    if held:
        yield from _groups(np.concatenate(held, axis=1), radius)


def _groups(rows: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    values = np.ascontiguousarray(rows[3]).view(np.uint64)
    n = len(values)
    first = np.concatenate([[0], np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1, [n]])
    sizes = np.diff(first)
    left, right = [], []
    if n > 1:
        size = np.repeat(sizes, sizes)
        left_over = np.repeat(first[1:], sizes) - np.arange(n) - 1   # places after it in its bucket
        for step in range(1, min(SMALL, int(sizes.max()))):
            at = np.flatnonzero((size <= SMALL) & (left_over >= step))
            if len(at):
                at = at[near_pairs(values[at], values[at + step], radius)]
                left.append(values[at])
                right.append(values[at + step])
    for k in np.flatnonzero(sizes > SMALL):
        own = np.sort(values[first[k]:first[k + 1]])
        root = group_roots(own, radius)
        member = np.flatnonzero(root != np.arange(len(own)))
        left.append(own[root[member]])
        right.append(own[member])
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)],
                                         names=["a", "b"])


# ----------------------------------------------------------------- components

def groups(prints: DataFrame, order: Column, radius: int = RADIUS) -> DataFrame:
    """(fp, root, first) of every fingerprint of ``prints``: fingerprints with
    the same root are linked directly or through others; ``first`` is the
    smallest ``order`` of the group's rows.

    Rows are reduced to their fingerprints before anything is joined; each
    side of a join is a stored table, so a fingerprint or a group with very
    many members is split by the skew handling of the join."""
    own = stored(prints.groupBy("fp").agg(F.min(order).alias("own")))
    joined = components(links(own.select("fp"), radius))
    labelled = stored(own.join(joined.select(F.col("node").alias("fp"), "root"), "fp", "left")
                      .select("fp", "own", F.coalesce("root", "fp").alias("root")))
    least = stored(labelled.groupBy("root").agg(F.min("own").alias("first")))
    return stored(labelled.join(least, "root").select("fp", "root", "first"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id) of every row; rows of a component are linked
    directly or through others, and its id is the smallest key in it."""
    prints = stored(fingerprints(docs, [key], text, words))
    found = groups(prints, F.col(key), radius)
    return prints.join(found, "fp").select(key, "fp", F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
             radius: int = RADIUS) -> DataFrame:
    """One document of each group of near-duplicates: the one with the
    smallest key (null last), of equal keys the one with the smallest hash.
    Rows that agree in key and text are one document."""
    plain, names = masked(docs)
    key, text = names[key], names[text]
    marks = [F.xxhash64(F.lit(k), key, text) for k in (1, 2)]
    plain = plain.withColumns({"mark_1": marks[0], "mark_2": marks[1]})
    prints = stored(fingerprints(plain, [key, "mark_1", "mark_2"], text, words))
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), "mark_1", "mark_2")
    first = (groups(prints, order, radius).select("first.mark_1", "first.mark_2").distinct())
    again = Window.partitionBy("mark_1", "mark_2").orderBy(F.xxhash64(*names.values()))
    left = (plain.join(first, ["mark_1", "mark_2"])
            .withColumn("again", F.row_number().over(again)).filter(F.col("again") == 1))
    return unmasked(left, names)
