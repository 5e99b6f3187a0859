"""Removal of repeated passages by hashing units of text.

Units are the lines of a document, and the pieces of its sequence of words: a
piece ends after the word of least rank of any ``WINDOW`` words in a row.
Ranks are hashes of a word and the one before it, words that end a sentence
before all others, so the same passage is cut alike in any prose and however
its lines are wrapped, mostly at its sentences.  Words are what stands between
white space; a character of a script that is written without spaces is a word.
A unit's digest (96 bits) is taken over its lower-case words.  Digests are
grouped over the whole table; the occurrence that ranks first - smallest
document key, then smallest text hash (128 bits, which with the key identify a
document), then smallest offset - stays, all others count as repeated:

* a repeated line of at least ``LINE_WORDS`` words goes;
* repeated pieces go where, next to each other, they hold at least
  ``RUN_WORDS`` words.  The digest of a piece of fewer than ``PIECE_WORDS``
  words is taken over the ``CONTEXT`` words that end with it, so short pieces
  go only with words before them that repeat as well.

Passages that were set into other prose therefore go as well, while a short
sentence that two documents happen to share stays.  Two equal passages are cut
alike from at most their ``WINDOW``-th rank to at least their ``WINDOW``-th
from the end; with 51 words, 20 or more stand between, so something of every
such repeat goes.  What goes always has an earlier twin that stays, so what
ranks first is never lost.

Words, hashes and cuts of many texts are computed side by side on arrays of
code points; long texts are read in blocks.  Results keep the original offsets
(in code points) of what went and of what stayed.  Rows: null text stays null,
empty text stays empty, both with nothing removed; a null key ranks first;
rows with the same key and the same text count as one document and get the
same result; an empty table gives an empty result; further columns pass
through untouched.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import _arrow_schema, masked, slices, stored

LINE_WORDS, PIECE_WORDS, RUN_WORDS = 8, 3, 20
#: Words that the digest of a shorter piece is taken over.
CONTEXT = 8
#: Words in a row that hold a cut.
WINDOW = 15
#: Marks that end a sentence, marks that may follow them, and
#: the code points of scripts that are written without spaces.
ENDS = ".!?…。！？"
CLOSERS = "\"')]}»’”」』"
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3001, 0x30FF),
            (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D)]
#: All planes from here on hold such characters.
WIDE = 0x20000
#: Code points hashed at once.
BLOCK = 1 << 18
LINE, PIECE = 0, 1
#: Odd multipliers of the hashes over the characters of a word and over the
#: words of a unit.
BY_CHAR, BY_WORD = 0x9E3779B97F4A7C15, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
UNITS = T.StructType([T.StructField(n, t) for n, t in (
    ("d1", T.LongType()), ("d2", T.IntegerType()), ("level", T.ByteType()), ("start", T.IntegerType()))])
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                 T.StructField("stop", T.IntegerType())]))


# ----------------------------------------------------------------------- words

@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code point, kind) of each code point below ``WIDE``; kind
    is 0 for white space, 1 for others, 2 for a word by itself."""
    lower = np.arange(WIDE, dtype=np.uint32)
    kind = np.ones(WIDE, np.uint8)
    for c in range(WIDE):
        if len(low := chr(c).lower()) == 1:
            lower[c] = ord(low)
        if chr(c).isspace():
            kind[c] = 0
    for a, b in UNSPACED:
        kind[a:b + 1] = 2
    return lower, kind


@functools.cache
def _powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse, mod 2^64."""
    found = []
    for m in (multiplier, pow(multiplier, -1, 1 << 64)):
        factors = np.full(n, m, np.uint64)
        factors[0] = 1
        found.append(np.cumprod(factors, dtype=np.uint64))
    return tuple(found)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray, multiplier: int) -> np.ndarray:
    """For each span [first, last) of ``values`` its polynomial hash."""
    size = 1 << max(10, int(len(values)).bit_length())
    up, down = _powers(multiplier, size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)])
    return (total[last] - total[first]) * down[first]


@dataclass
class Words:
    """start and stop (code points), hash, line (number of line ends before)
    and whether it ends a sentence, of each word."""

    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    line: np.ndarray
    ends: np.ndarray


def words_of(text: str) -> tuple[Words, np.ndarray]:
    """The words of ``text`` and the places of its line ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lower, kinds = _characters()
    found: list[list[np.ndarray]] = []
    line_ends = np.flatnonzero(codes == 10)
    at = 0
    while at < len(codes):
        size = BLOCK
        while True:
            block = codes[at:at + size]
            kind = np.where(block < WIDE, kinds[np.minimum(block, WIDE - 1)], 2)
            own = kind > 0
            alone = kind == 2
            fresh = own.copy()               # a word begins here
            fresh[1:] &= ~own[:-1] | alone[1:] | alone[:-1]
            done = at + size >= len(codes)
            # a block that does not end the text ends where a word or a space does
            edge = len(block) if done else int(np.flatnonzero(fresh | ~own)[-1] if (fresh | ~own).any() else 0)
            if edge:
                break
            size *= 2
        block, own, fresh = block[:edge], own[:edge], fresh[:edge]
        first = np.flatnonzero(fresh)
        # a word stops before the next character that is no part of it
        closes = np.append(fresh[1:] | ~own[1:], True) & own
        last = np.flatnonzero(closes) + 1
        low = np.where(block < WIDE, lower[np.minimum(block, WIDE - 1)], block)
        hashed = _mixed(_sums(low.astype(np.uint64) + np.uint64(1), first, last, BY_CHAR) + (last - first).astype(np.uint64))
        end, close = (np.isin(block, np.array([ord(c) for c in marks], np.uint32)) for marks in (ENDS, CLOSERS))
        before = np.maximum(last - 2, 0)
        sentence = end[last - 1] | (close[last - 1] & end[before] & (last - first > 1))
        found.append([first + at, last + at, hashed, sentence])
        at += edge
    start, stop, hashed, ends = (np.concatenate(c) for c in zip(*found)) if found else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
    return Words(start, stop, hashed, np.searchsorted(line_ends, start), ends), line_ends


# ----------------------------------------------------------------------- units

@dataclass
class Units:
    """Units of several texts by (text, level, start), as arrays; start and
    stop are offsets in the text, and a line's stop is past its line end."""

    text: np.ndarray
    level: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    words: np.ndarray
    d1: np.ndarray
    d2: np.ndarray
    hashed: np.ndarray                # whether it has a digest


def cut_after(hashes: np.ndarray, ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a piece ends after each of the words of texts in a row."""
    n = len(hashes)
    out = np.zeros(n, bool)
    if not n:
        return out
    same = np.zeros(n, bool)
    same[1:] = text[1:] == text[:-1]
    out[:-1] = ~same[1:]
    out[-1] = True
    rank = hashes.copy()
    rank[1:] = np.where(same[1:], _mixed(hashes[1:] * np.uint64(3) + hashes[:-1]), hashes[1:])
    rank = (rank >> np.uint64(1)) | np.where(ends, np.uint64(0), np.uint64(1 << 63))
    if n >= WINDOW:
        for a in range(0, n - WINDOW + 1, 1 << 16):
            rows = np.lib.stride_tricks.sliding_window_view(rank[a:a + (1 << 16) + WINDOW - 1], WINDOW)
            least = np.arange(a, a + len(rows)) + WINDOW - 1 - rows[:, ::-1].argmin(axis=1)
            whole = text[a:a + len(rows)] == text[a + WINDOW - 1:a + WINDOW - 1 + len(rows)]
            out[least[whole]] = True
    return out


def units_of(texts: list[str]) -> Units:
    """All units of ``texts``."""
    joined = "\n".join(texts)
    w, line_ends = words_of(joined)
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])        # of each text
    text = np.searchsorted(begin, w.start, "right") - 1
    n = len(w.start)
    none = np.zeros(0, np.int64)

    def spans(last_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = np.flatnonzero(last_of)
        return np.concatenate([[0], last[:-1] + 1]) if len(last) else none, last + 1

    def digests(first: np.ndarray, last: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        size = (last - first).astype(np.uint64) * np.uint64(2) + np.uint64(level)
        d1, d2 = (_mixed(_sums(w.hash, first, last, m) + size) for m in BY_WORD)
        return d1.view(np.int64), (d2 >> np.uint64(32)).astype(np.uint32).view(np.int32)

    on_line = np.zeros(n, bool)
    if n:
        on_line[:-1] = w.line[1:] != w.line[:-1]
        on_line[-1] = True
    first, last = spans(on_line)
    long = last - first >= LINE_WORDS
    first, last = first[long], last[long]
    number = w.line[first]
    bounds = np.concatenate([[-1], line_ends, [len(joined)]])
    lines = (text[first], bounds[number] + 1, bounds[number + 1] + 1, last - first, *digests(first, last, LINE),
             np.ones(len(first), bool))

    first, last = spans(cut_after(w.hash, w.ends, text))
    opening = np.searchsorted(text, text[first])                 # first word of the text
    covered = np.where(last - first < PIECE_WORDS, np.maximum(opening, last - CONTEXT), first)
    pieces = (text[first], w.start[first], w.stop[last - 1], last - first, *digests(covered, last, PIECE),
              last - covered >= PIECE_WORDS)
    own, start, stop, size, d1, d2, hashed = (np.concatenate(c) for c in zip(lines, pieces))
    level = np.repeat([LINE, PIECE], [len(lines[0]), len(pieces[0])])
    order = np.lexsort((start, level, own))
    own, stop = own[order], stop[order]
    ends = begin[own + 1] - 1                                    # a last line has no line end of its own
    return Units(own, level[order], start[order] - begin[own], np.minimum(stop, ends) - begin[own],
                 size[order], d1[order], d2[order], hashed[order])


def hashed_units(text: str) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(digest, level, start) of every unit that has a digest.

    A line that is a single piece is both units; its digests differ by level,
    so lines are only compared with lines.  Only pieces that begin the text
    and have fewer than ``PIECE_WORDS`` words up to their end have none."""
    u = units_of([text])
    for k in np.flatnonzero(u.hashed).tolist():
        yield (int(u.d1[k]), int(u.d2[k])), int(u.level[k]), int(u.start[k])


def cut_spans(u: Units, gone: np.ndarray, texts: int) -> list[list[tuple[int, int]]]:
    """For each of ``texts`` texts the spans to remove, given which units are
    repeated."""
    line = np.flatnonzero(gone & (u.level == LINE))
    piece = np.flatnonzero(u.level == PIECE)
    text, run = u.text[piece], gone[piece]
    edge = np.ones(len(piece) + 1, bool)
    edge[1:-1] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(edge)
    first, last = at[:-1], at[1:]                     # pieces next to each other, all repeated or none
    total = np.concatenate([[0], np.cumsum(u.words[piece])])
    if len(piece):
        fits = run[first] & (total[last] - total[first] >= RUN_WORDS)
        first, last = piece[first[fits]], piece[last[fits] - 1]
    else:
        first = last = piece
    own = np.concatenate([u.text[line], u.text[first]])
    start, stop = np.concatenate([u.start[line], u.start[first]]), np.concatenate([u.stop[line], u.stop[last]])
    order = np.lexsort((stop, start, own))
    out: list[list[tuple[int, int]]] = [[] for _ in range(texts)]
    for k, a, b in zip(own[order].tolist(), start[order].tolist(), stop[order].tolist()):
        if out[k] and a <= out[k][-1][1]:
            out[k][-1] = (out[k][-1][0], max(b, out[k][-1][1]))
        else:
            out[k].append((a, b))
    return out


def cuts_of(texts: list[str], repeated: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """For each text the spans to remove, given the (level, start) of its
    repeated units."""
    u = units_of(texts)

    def places(text: np.ndarray, level: np.ndarray, start: np.ndarray) -> np.ndarray:
        return ((text << 1) + level << 32) + start

    sizes = [len(r) for r in repeated]
    flat = np.array([x for r in repeated for x in r], np.int64).reshape(-1, 2)
    gone = np.isin(places(u.text, u.level, u.start),
                   places(np.repeat(np.arange(len(texts)), sizes), flat[:, 0], flat[:, 1]))
    return cut_spans(u, gone, len(texts))


def cuts(text: str, repeated: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans to remove, given the (level, start) of the repeated units."""
    return cuts_of([text], [repeated])[0]


def kept(text: str, removed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What lies between the removed spans."""
    edges = [0, *[x for span in removed for x in span], len(text)]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]


# ------------------------------------------------------------------ DataFrames

def _units(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(3)
        for i, j in slices(column, 1 << 20):
            u = units_of([t or "" for t in column.slice(i, j - i).to_pylist()])
            own = np.flatnonzero(u.hashed)
            at = pa.array(u.text[own] + i)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(at) for k in range(3)], pa.array(u.d1[own]), pa.array(u.d2[own]),
                 pa.array(u.level[own].astype(np.int8)), pa.array(u.start[own].astype(np.int32))], schema=schema)


def _marks(text: str) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(F.lit(k), F.col(text)) for k in (1, 2)]


def repeated_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, mark_1, mark_2, units) of every document with a repeated unit;
    units is an array of (level, start) of the places that rank behind the
    first occurrence: a set, so repeated rows do not lengthen it."""
    marks = [m.alias(f"mark_{k}") for k, m in enumerate(_marks(text), 1)]
    source = docs.select(F.col(key).alias("key"), *marks, F.col(text).alias("text"))
    schema = T.StructType([*source.drop("text").schema.fields, *UNITS.fields])
    arrow = _arrow_schema(schema)
    units = source.mapInArrow(lambda batches: _units(batches, arrow), schema)
    rank = F.struct("key", "mark_1", "mark_2", "start")
    first = stored(units.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
                   .filter(F.col("n") > 1).select("d1", "d2", "first"))
    return (units.join(first, ["d1", "d2"]).filter(~rank.eqNullSafe(F.col("first")))
            .groupBy("key", "mark_1", "mark_2").agg(F.collect_set(F.struct("level", "start")).alias("units")))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   removed: str = "removed", kept_spans: str = "kept") -> DataFrame:
    """``docs`` with what is left of ``text``, and two more columns: the spans
    of the original text that went (``removed``) and that stayed
    (``kept_spans``)."""
    plain, names = masked(docs)
    found = repeated_units(docs, key, text)
    own = dict(zip(("own_1", "own_2"), _marks(names[text])))
    joined = plain.withColumns(own).join(
        found, F.col(names[key]).eqNullSafe(F.col("key")) & (F.col("own_1") == F.col("mark_1"))
        & (F.col("own_2") == F.col("mark_2")), "left")
    columns = list(names.values())
    at, n = columns.index(names[text]), len(columns)
    source = joined.select(*columns, "units")
    schema = T.StructType([*joined.select(columns).schema.fields, T.StructField("went", SPAN),
                           T.StructField("stayed", SPAN)])
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(at), 1 << 20):
                left, went, stayed = [], [], []
                values, units = (batch.column(k).slice(i, j - i).to_pylist() for k in (at, n))
                held = [k for k, (value, own) in enumerate(zip(values, units)) if value and own]
                found = dict(zip(held, cuts_of([values[k] for k in held],
                                               [[(u["level"], u["start"]) for u in units[k]] for k in held])))
                for k, value in enumerate(values):
                    spans = found.get(k, [])
                    rest = kept(value or "", spans)
                    left.append("".join(value[a:b] for a, b in rest) if spans else value)
                    went.append([{"start": a, "stop": b} for a, b in spans])
                    stayed.append([{"start": a, "stop": b} for a, b in rest])
                arrays = [batch.column(k).slice(i, j - i) for k in range(n)]
                arrays[at] = pa.array(left, arrow.field(at).type)
                yield pa.RecordBatch.from_arrays(
                    arrays + [pa.array(went, arrow.field(n).type), pa.array(stayed, arrow.field(n + 1).type)],
                    schema=arrow)

    return source.mapInArrow(run, schema).select(
        *[F.col(new).alias(old) for old, new in names.items()],
        F.col("went").alias(removed), F.col("stayed").alias(kept_spans))
