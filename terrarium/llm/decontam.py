"""Benchmark decontamination with a BM25 index and block-max WAND.

The test items form an inverted index: for each term its items, ascending,
with BM25 impacts in blocks that carry their largest impact.  Impacts are
divided by the score an item gives its own full text, so a score is the share
of an item that a passage holds, and one threshold suits short and long items.

A document's words that the index knows are cut into pieces as long as the
longest item; a passage is two pieces next to each other, so an item that
stands in a document stands whole in some passage.  Each passage is a query.
Its block bounds (the sums of its terms' block maxima) are computed for many
passages at once; where some block can reach the threshold, block-max WAND
visits the items and returns all that do.  A retrieved item counts as leaked
if the word sequences of its question and of its answer both stand in the
passage of the document.

The index is built on the driver from at most ``SHARD_BYTES`` of item text;
larger benchmarks are split into shards by a hash, each searched by all
documents with the statistics of its own shard.

Words are runs of letters and digits, with their accents and vowel signs,
case-folded; a character of a script that is written without spaces is a word
by itself.  An item of any length is one query window: pieces grow with the
longest item.  Rows: null or empty documents and items match nothing;
repeated items are all reported, repeated documents each on its own row; an
empty table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import _arrow_schema, map_texts, slices

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage has to reach.
THRESHOLD = 0.6
#: Share of the word sequences of question and answer that have to stand there.
OVERLAP = 0.6
#: Items of a block; more if the index would have over ``MAX_BLOCKS`` blocks.
BLOCK, MAX_BLOCKS = 4, 128
SHARD_BYTES = 4 << 20
#: Words of a piece at least.
MIN_PIECE = 32
#: Words of a sequence in the question and in the answer.
QUESTION_GRAM, ANSWER_GRAM = 5, 3
#: Scripts that are written without spaces, whose characters are
#: words by themselves.
ALONE = (r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
         r"\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff")
#: Beyond ASCII, marks and white space separate words; accents and vowel signs do not.
BETWEEN = regex.compile(r"[^\w\p{M}\x00-\x7f]+")
SINGLE = regex.compile(f"[{ALONE}]")
WORD = regex.compile(rf"[{ALONE}]|(?:[0-9A-Za-z]|(?![{ALONE}\x00-\x7f])[\w\p{{M}}])+")
#: In ASCII, every byte but letters and digits separates words.
SPACED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
ANSWER = re.compile(r"\banswer\s*:", re.I)
SENTENCE_END = re.compile(r"[.!?]+\s+|[。！？]+")
HITS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()),
                     T.StructField("answer_overlap", T.DoubleType()), T.StructField("start", T.IntegerType()),
                     T.StructField("stop", T.IntegerType())])


def words_of(text: str | None) -> list[bytes]:
    folded = (text or "").casefold()
    if not folded.isascii():
        folded = SINGLE.sub(r" \g<0> ", BETWEEN.sub(" ", folded))
    return folded.encode().translate(SPACED).split()


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: at a label "Answer:" if there is one, else before
    the last sentence, else before the last quarter of the words."""
    m = ANSWER.search(text)
    if m and words_of(text[:m.start()]) and words_of(text[m.end():]):
        return text[:m.start()], text[m.end():]
    for m in reversed(list(SENTENCE_END.finditer(text.rstrip()))):
        if words_of(text[:m.end()]) and words_of(text[m.end():]):
            return text[:m.end()], text[m.end():]
    spans = [m.span() for m in WORD.finditer(text)]
    if len(spans) < 2:
        return "", text
    at = spans[len(spans) - max(1, len(spans) // 4)][0]
    return text[:at], text[at:]


def grams(words: list, n: int) -> set[tuple]:
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Index:
    """terms: the number of each word; items: (id, question grams, answer
    grams) over those numbers; postings: by term, its items, their impacts and
    the largest impact of each ``block`` postings; tops: terms x blocks of
    items, largest impacts, with a row of zeros for unknown words."""

    terms: dict[bytes, int] = field(default_factory=dict)
    items: list[tuple] = field(default_factory=list)
    postings: list[tuple[list[int], list[float], list[float]]] = field(default_factory=list)
    tops: np.ndarray | None = None
    block: int = BLOCK
    piece: int = MIN_PIECE


def build_index(rows: list[tuple], k1: float = K1, b: float = B, block: int = BLOCK) -> Index:
    """Index of (id, text) rows."""
    counts = [(item, text, Counter(words)) for item, text in rows if (words := words_of(text))]
    index = Index(block=max(block, -(-len(counts) // MAX_BLOCKS)))
    if not counts:
        return index
    df = Counter(t for _, _, c in counts for t in c)
    mean = sum(c.total() for _, _, c in counts) / len(counts)
    n = len(counts)
    for t in sorted(df):
        index.terms[t] = len(index.terms)
        index.postings.append(([], [], []))
    index.tops = np.zeros((len(df) + 1, -(-n // index.block)), np.float32)
    for k, (item, text, c) in enumerate(counts):
        question, answer = ([index.terms.get(w, -1) for w in words_of(x)] for x in split_item(text))
        index.items.append((item, grams(question, QUESTION_GRAM), grams(answer, ANSWER_GRAM)))
        index.piece = max(index.piece, c.total())
        norm = k1 * (1 - b + b * c.total() / mean)
        impact = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (k1 + 1) / (f + norm)
                  for t, f in c.items()}
        own = sum(impact.values())
        for t, w in impact.items():
            items, weights, _ = index.postings[index.terms[t]]
            items.append(k)
            weights.append(w / own)
            top = index.tops[index.terms[t]]
            top[k // index.block] = max(top[k // index.block], w / own)
    for _, weights, tops in index.postings:
        tops.extend(max(weights[i:i + index.block]) for i in range(0, len(weights), index.block))
    return index


def wand(index: Index, terms: list[int], threshold: float = THRESHOLD, first: int = 0,
         end: int | None = None) -> list[tuple[int, float]]:
    """All (item, score) with a score of at least ``threshold``, among the
    items from ``first`` on and before ``end``."""
    end, block = len(index.items) if end is None else end, index.block
    # a cursor: item, place, bound, items, weights, block maxima
    cursors = []
    for p in map(index.postings.__getitem__, terms):
        at = bisect_left(p[0], first)
        if at < len(p[0]) and p[0][at] < end:
            cursors.append([p[0][at], at, max(p[2][at // block:bisect_left(p[0], end) // block + 1]), *p])
    found = []
    # sums in another order may differ in the last place
    least = threshold - 1e-9
    while True:
        cursors.sort(key=lambda c: c[0])
        total, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            if c[0] >= end:
                break
            total += c[2]
            if total >= least:
                pivot = k
                break
        if pivot < 0:
            return found
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        # the blocks that hold the pivot: their maxima, and where the first of them ends
        bound, leave = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else end
        for c in cursors[:pivot + 1]:
            k = c[1] // block
            while k < len(c[5]) and c[3][min(len(c[3]), (k + 1) * block) - 1] < item:
                k += 1
            if k < len(c[5]):
                bound += c[5][k]
                leave = min(leave, c[3][min(len(c[3]), (k + 1) * block) - 1] + 1)
        if bound < least:
            _advance(cursors[:pivot + 1], max(leave, item + 1), end)
        elif cursors[0][0] == item:
            score = sum(c[4][c[1]] for c in cursors[:pivot + 1])
            if score >= least:
                found.append((item, score))
            _advance(cursors[:pivot + 1], item + 1, end)
        else:
            _advance([c for c in cursors[:pivot] if c[0] < item], item, end)


def _advance(cursors: list[list], item: int, end: int) -> None:
    for c in cursors:
        items, k = c[3], c[1]
        while k < len(items) and items[k] < item:
            k += 1
        c[0], c[1] = (items[k] if k < len(items) else end), k


def _block_bounds(index: Index, pieces: np.ndarray) -> np.ndarray:
    """The bound of every block (pieces, blocks), each term counted once."""
    pieces = np.sort(pieces, axis=1)
    pieces[:, 1:][pieces[:, 1:] == pieces[:, :-1]] = len(index.terms)
    out = np.empty((len(pieces), index.tops.shape[1]), np.float32)
    step = max(1, (1 << 21) // (pieces.shape[1] * out.shape[1]))
    for i in range(0, len(pieces), step):
        np.take(index.tops, pieces[i:i + step], axis=0).sum(axis=1, out=out[i:i + step])
    return out


def search(index: Index, texts: list[str | None], threshold: float = THRESHOLD,
           overlap: float = OVERLAP) -> list[tuple[int, tuple]]:
    """(place of the text, hit) of every leaked item.  A hit is (item id,
    score, question overlap, answer overlap, start, stop) of the best passage,
    the first one on ties; start and stop are code points of the text."""
    unknown, size = len(index.terms), index.piece
    if not index.items:
        return []
    docs, known, owner = [], [], []
    for place, text in enumerate(texts):
        words = words_of(text)
        ids = np.array([*map(index.terms.get, words, repeat(unknown))], np.int32)
        at = np.flatnonzero(ids < unknown)
        docs.append(ids)
        known.append(at)
        owner += [place] * -(-len(at) // size)
    if not owner:
        return []
    pieces = np.full((len(owner), size), unknown, np.int32)
    flat, k = pieces.reshape(-1), 0
    firsts = []
    for ids, at in zip(docs, known):
        flat[k * size:k * size + len(at)] = ids[at]
        firsts.append(k)
        k += -(-len(at) // size)
    bounds = _block_bounds(index, pieces)
    owner = np.array(owner)
    paired = np.concatenate([owner[1:] == owner[:-1], [False]])
    both = bounds.copy()
    both[paired] += bounds[1:][paired[:-1]]
    # float32 sums: the margin keeps every passage that could reach the threshold
    able = both.max(axis=1) >= threshold - 1e-3
    # a document's last piece is part of the passage before it
    able &= paired | np.concatenate([[True], owner[1:] != owner[:-1]])
    best: dict[tuple[int, int], tuple] = {}
    for k in np.flatnonzero(able).tolist():
        place = int(owner[k])
        terms = np.unique(pieces[k:k + 2] if paired[k] else pieces[k])
        terms = terms[terms < unknown]
        blocks = np.flatnonzero(index.tops[terms].sum(axis=0) >= threshold - 1e-3)
        if not len(blocks):
            continue
        first = (k - firsts[place]) * size
        at = known[place][first:first + 2 * size]
        passage, own = docs[place][at[0]:at[-1] + 1].tolist(), {}
        for item, score in (hit for block in blocks.tolist() for hit in wand(
                index, terms.tolist(), threshold, block * index.block, (block + 1) * index.block)):
            shares = []
            for wanted in index.items[item][1:]:
                width = len(next(iter(wanted))) if wanted else 0
                have = own.setdefault(width, grams(passage, width))
                shares.append(len(wanted & have) / len(wanted) if wanted else 1.0)
            if min(shares) >= overlap and ((place, item) not in best or score > best[place, item][0]):
                best[place, item] = (score, *shares, int(at[0]), int(at[-1]))
    return [(place, (index.items[item][0], *hit[:3], *_span(texts[place], *hit[3:])))
            for (place, item), hit in sorted(best.items())]


def _span(text: str, first: int, last: int) -> tuple[int, int]:
    """Code points of the words ``first`` to ``last`` of a text."""
    spans = [m.span() for m in WORD.finditer(text)]
    return spans[min(first, len(spans) - 1)][0], spans[min(last, len(spans) - 1)][1]


def _shards(items: DataFrame, key: str, text: str, shard_bytes: int) -> list[list[tuple]]:
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    part = F.pmod(F.xxhash64(key, text), F.lit(n))
    for k in range(n):
        yield sorted(((r[0], r[1]) for r in items.filter(part == k).select(key, text).collect()),
                     key=lambda r: (r[0] is None, r[0], r[1] or ""))


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                 overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for every document and test item that it leaks: the keys, the
    BM25 score as a share of the item's own, both overlaps, and the code
    points of the passage."""
    source = docs.select(F.col(key), F.col(text))
    schema = T.StructType([source.schema[key], T.StructField(item_key, items.schema[item_key].dataType), *HITS.fields])
    arrow = _arrow_schema(schema)
    found = None
    for rows in _shards(items, item_key, item_text, shard_bytes):
        index = docs.sparkSession.sparkContext.broadcast(build_index(rows))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, hits = [], []
                for i, j in slices(batch.column(1)):
                    for row, hit in search(index.value, batch.column(1).slice(i, j - i).to_pylist(),
                                           threshold, overlap):
                        at.append(i + row)
                        hits.append(hit)
                if hits:
                    columns = list(zip(*hits))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at, pa.int64()))]
                        + [pa.array(c, arrow.field(k).type) for k, c in enumerate(columns, 1)], schema=arrow)

        part = source.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return found


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents that leak no test item, all columns kept.  Nothing is
    shuffled: each shard of the index is one more pass over what is left."""
    flag = "leaks"
    while flag in docs.columns:
        flag += "_"
    columns, added = docs.columns, T.StructType([T.StructField(flag, T.BooleanType())])
    for rows in _shards(items, item_key, item_text, shard_bytes):
        index = docs.sparkSession.sparkContext.broadcast(build_index(rows))

        def run(texts: list, index=index) -> dict:
            found = {place for place, _ in search(index.value, texts, threshold, overlap)}
            return {flag: [k in found for k in range(len(texts))]}

        docs = map_texts(docs, text, columns, added, run).filter(~F.col(flag)).select(columns)
    return docs
