"""Byte-level BPE encoding and decoding from a tokenizer's vocabulary file.

A text is split at special tokens and then into words by the byte-level
pattern.  The symbols of a word form a doubly linked list; a priority queue
holds the rank of every adjacent pair that can merge, lowest rank first, then
leftmost.  Entries whose symbols have changed meanwhile are stale and skipped.
Decoding concatenates the vocabulary's byte strings.

Nothing is trained; the file's path is a parameter and its content is sent to
the tasks once.  The merges of recent words are remembered in each worker, at
most ``REMEMBER`` words; forgetting them changes the time, not the result.

Rows: null and empty texts give no tokens and decode to an empty text (null
texts decode to an empty text too); repeated rows get equal results; an empty
table gives an empty result; extra columns are ignored or passed through.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush
from itertools import chain

import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrarium.llm.common import map_texts

DEFAULT_FILE = "byte_bpe_50k.json"
#: Of them, those that do not follow a space.
REMEMBER, UNSPACED = 800_000, 100_000
#: The byte-level pattern; white space is Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = frozenset(regex.findall("[" + SPACE + "]", "".join(map(chr, range(0x3001)))))
#: Marks that the pattern takes alone when they end a text after a letter.
MARKS = frozenset(",.;:!?")
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+| ?[^\p{L}\p{N}" + SPACE + r"]+"
    r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if it is printable, else the next free one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Remembered(dict):
    """The ids of each piece of text seen; those of a missing one are computed."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, piece: str):
        ids = self[piece] = self.compute(piece)
        return ids


class Tokenizer:
    """Encoder and decoder over a byte-level BPE file in JSON."""

    def __init__(self, source: str | bytes):
        spec = json.loads(source)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without normalizer is needed")
        vocab = model["vocab"]
        alphabet = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(alphabet)}
        self.prefix_space = bool(pre.get("add_prefix_space"))
        self.first = [vocab[c] for c in alphabet]
        self.mark = {c: vocab[c] for c in MARKS}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: a pair's key is one number: the left id times this, plus the right id
        self.base = max(vocab.values()) + 2
        self.parts = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.ranks = {left * self.base + right: rank for rank, (left, right, _) in enumerate(self.parts)}
        own = {i: b for b, i in enumerate(self.first)}
        self.byte_ranks = {(own[left], own[right]): rank for rank, (left, right, _) in enumerate(self.parts)
                           if left in own and right in own}
        #: an id above all others, in no pair
        self.none = self.base - 1
        self.strings = [b""] * (max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]) + 1)
        for token, i in vocab.items():
            self.strings[i] = bytes(to_byte[c] for c in token)
        self.special = {}
        for token in spec.get("added_tokens", []):
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError("special tokens that take neighbours are not supported")
            self.special[token["content"]] = token["id"]
            self.strings[token["id"]] = token["content"].encode("utf-8")
        self.splitter = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
                                      ) if self.special else None
        self.decimal = [str(i) for i in range(len(self.strings))]
        self.words = Remembered(lambda word: tuple(self.merge(word.encode("utf-8"))))
        self.spaced = Remembered(self._spaced)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        ranks, parts, base = self.ranks.get, self.parts, self.base
        ids = [*map(self.first.__getitem__, word)]
        end = len(ids)
        if end < 2:
            return ids
        # the list's ends link to a symbol that merges with none
        ids.append(self.none)
        after, before = [*range(1, end + 2)], [*range(-1, end)]
        # an entry is one number: the pair's rank, then the place of its left symbol
        bits = end.bit_length()
        mask = (1 << bits) - 1
        pairs = self.byte_ranks
        queue = [pairs[pair] << bits | i for i, pair in enumerate(zip(word, word[1:])) if pair in pairs]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry & mask
            left, right, new = parts[entry >> bits]
            j = after[i]
            if ids[i] != left or ids[j] != right:
                continue                                    # stale
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            before[k] = i
            if (rank := ranks(new * base + ids[k])) is not None:
                heappush(queue, rank << bits | i)
            h = before[i]
            if (rank := ranks(ids[h] * base + new)) is not None:
                heappush(queue, rank << bits | h)
        ids.pop()
        return [x for x in ids if x >= 0]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        for memory, most in ((self.words, UNSPACED), (self.spaced, REMEMBER - UNSPACED)):
            if len(memory) > most:
                memory.clear()
        ids: list[int] = []
        at = 0
        for m in self.splitter.finditer(text) if self.splitter else ():
            self._encode_plain(text[at:m.start()], ids)
            ids.append(self.special[m.group()])
            at = m.end()
        self._encode_plain(text[at:] if at else text, ids)
        return ids

    def _spaced(self, piece: str) -> tuple[int, ...] | None:
        """The ids of a piece without spaces, after a space; None if it is
        empty or has white space at an end, which the pattern may join with
        the space."""
        if not piece or piece[0] in SPACES or piece[-1] in SPACES:
            return None
        if piece.isascii():
            # what the pattern finds in letters, and in letters and one mark
            if piece.isalpha():
                return tuple(self.merge(b" " + piece.encode()))
            if piece[-1] in MARKS and piece[:-1].isalpha():
                return (*self.spaced[piece[:-1]], self.mark[piece[-1]])
        first, *rest = PATTERN.findall(" " + piece)
        # a word with marks behind it shares the memory of the word alone
        ids = self.spaced[first[1:]] if rest and first != " " else self.merge(first.encode("utf-8"))
        for word in rest:
            ids = (*ids, *self.words[word])
        return tuple(ids)

    def _encode_plain(self, text: str, ids: list[int]) -> None:
        if not text:
            return
        if self.prefix_space and not text[0].isspace():
            text = " " + text
        # a word of the pattern never goes on after a single space
        first, *pieces = text.split(" ")
        found = [*map(self.spaced.__getitem__, pieces)]
        if None in found or not first or first[0] in SPACES or first[-1] in SPACES:
            found = map(self.words.__getitem__, PATTERN.findall(text))
        else:
            for word in PATTERN.findall(first):
                ids += self.words[word]
        ids.extend(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")

    def decimals(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))


_LOADED: dict[str, Tokenizer] = {}


def _loaded(source: Broadcast) -> Tokenizer:
    """One tokenizer a worker process and file."""
    digest, content = source.value
    if digest not in _LOADED:
        _LOADED[digest] = Tokenizer(content)
    return _LOADED[digest]


def shared_file(spark: SparkSession, path: str | None = None) -> Broadcast:
    """Reads a vocabulary file (a few MB) on the driver for all tasks."""
    with open(path or public_tokenizers.path(DEFAULT_FILE), "rb") as f:
        content = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(content).hexdigest(), content))


def encode(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` columns plus ``ids``, the token ids of each text."""
    source = shared_file(docs.sparkSession, path)
    return map_texts(docs, text, keep, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))]),
                     lambda texts: {"ids": [_loaded(source).encode(t) for t in texts]})


def round_trip(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None,
               ids: bool = False) -> DataFrame:
    """Encodes and decodes every text: ``keep`` columns, n_tokens, and the
    SHA-256 of the ids (decimal, joined by commas) and of the decoded text;
    with ``ids`` the token ids as well."""
    source = shared_file(docs.sparkSession, path)
    added = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                          T.StructField("decoded_sha256", T.StringType())])
    if ids:
        added = added.add("ids", T.ArrayType(T.IntegerType()))

    def run(texts: list) -> dict:
        tokenizer = _loaded(source)
        out: dict[str, list] = {f.name: [] for f in added.fields}
        for text in texts:
            found = tokenizer.encode(text)
            out["n_tokens"].append(len(found))
            out["ids_sha256"].append(hashlib.sha256(tokenizer.decimals(found).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(tokenizer.decode(found).encode("utf-8")).hexdigest())
            if ids:
                out["ids"].append(found)
        return out

    return map_texts(docs, text, keep, added, run)
