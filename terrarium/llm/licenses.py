"""Licence scan with a generalised suffix automaton of licence words.

The automaton holds every run of words of the templates and of the base
phrases.  A text streams through it once; at each word the matching statistic
is the longest run that ends there and occurs in some template, with the
automaton state of that run.

* A base phrase stands wherever it is a suffix of the matched run: each state
  carries the phrases on its suffix path.
* Runs that cannot be extended and have at least ``MIN_MATCH`` words are
  anchors.  Anchors of a template that follow each other in text and template,
  with at most ``MAX_GAP`` words between them, are chained; a chain that covers
  ``COVERAGE`` of the template's words is a span of that template.

Two neighbouring words that follow each other in no template end every run,
so the automaton only steps through stretches where they do; elsewhere the
statistic is at most one word.

Words are runs of ASCII letters (lower-cased) and digits and of all characters
beyond ASCII.  Rows: null and empty texts have no words, spans or places;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from terrarium.llm.common import map_texts
from terrarium.llm.license_texts import PHRASES, TEMPLATES

MIN_MATCH, MAX_GAP, COVERAGE = 3, 6, 0.75
SPACED = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("template", T.StringType()),
                     T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
                     T.StructField("coverage", T.DoubleType())])
ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(PLACE)),
                      T.StructField("spans", T.ArrayType(SPAN))])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().translate(SPACED).split()


@dataclass
class Match:
    start: int
    size: int
    state: int


class Scanner:
    """Generalised suffix automaton of templates (label, name, text) and base
    phrases (label, text)."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.templates = [(label, name, words_of(text)) for label, name, text in templates]
        self.phrases = [(label, words_of(text)) for label, text in phrases]
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        sources = [words for _, _, words in self.templates] + [words for _, words in self.phrases]
        ids = [[self.number.setdefault(w, len(self.number)) for w in words] for words in sources]
        n = len(self.number)
        self.follows = np.zeros((n + 1) * (n + 1), bool)
        for own in ids:
            last = 0
            for a, b in zip(own, own[1:]):
                self.follows[a * (n + 1) + b] = True
            for w in own:
                last = self._extend(last, w)
        self._mark(ids)

    def _new(self, size: int, link: int, edges: dict) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(edges)
        return len(self.size) - 1

    def _split(self, state: int, w: int, to: int) -> int:
        """A copy of ``to`` for the runs that end like ``state`` plus ``w``."""
        if self.size[state] + 1 == self.size[to]:
            return to
        copy = self._new(self.size[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while state >= 0 and self.next[state].get(w) == to:
            self.next[state][w] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:                   # another template has this run already
            return self._split(last, w, self.next[last][w])
        new = self._new(self.size[last] + 1, 0, {})
        state = last
        while state >= 0 and w not in self.next[state]:
            self.next[state][w] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, w, self.next[state][w])
        return new

    def _mark(self, ids: list[list[int]]) -> None:
        """Where each state's runs end in the templates, and which phrases are
        a suffix of them."""
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.size]
        self.suffix: list[list[int]] = [[] for _ in self.size]
        for k, own in enumerate(ids):
            state = 0
            for at, w in enumerate(own):
                state = self.next[state][w]
                if k < len(self.templates):
                    self.ends[state].append((k, at))
            if k >= len(self.templates):
                self.suffix[state].append(k - len(self.templates))
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for state in reversed(order):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        for state in order:
            if self.link[state] > 0:
                self.suffix[state] = self.suffix[state] + self.suffix[self.link[state]]

    def matches(self, ids: list[int], offset: int, places: list[tuple[str, int]]) -> list[Match]:
        """Streams words (numbers) through the automaton; appends the base
        places and returns the runs that cannot be extended."""
        found: list[Match] = []
        state = size = 0
        for at, w in enumerate(ids):
            grown = self.next[state].get(w)
            if grown is None:
                if size >= MIN_MATCH:
                    found.append(Match(offset + at - size, size, state))
                while state > 0 and w not in self.next[state]:
                    state = self.link[state]
                    size = self.size[state]
                grown = self.next[state].get(w)
            if grown is None:
                state = size = 0
            else:
                state, size = grown, size + 1
            for k in self.suffix[state]:
                label, words = self.phrases[k]
                if size >= len(words):
                    places.append((label, offset + at - len(words) + 1))
        if size >= MIN_MATCH:
            found.append(Match(offset + len(ids) - size, size, state))
        return found

    def chains(self, found: list[Match]) -> list[tuple[str, str, int, int, float]]:
        """Spans (label, template, first word, last word, coverage), by first
        word; of spans of one template that overlap the best covered stays."""
        open_: dict[int, list[list[int]]] = {}     # template: [first, last, template's last, covered]
        done: list[tuple[int, list[int]]] = []
        for m in found:
            for k, end in self.ends[m.state]:
                begin = end - m.size + 1
                alive, best = [], None
                for c in open_.get(k, []):
                    if m.start - c[1] - 1 > MAX_GAP:
                        done.append((k, c))
                        continue
                    alive.append(c)
                    # the part of the run that the chain does not hold yet
                    skip = max(0, c[1] + 1 - m.start, c[2] + 1 - begin)
                    if skip < m.size and m.start + skip > c[1] and 0 <= begin + skip - c[2] - 1 <= MAX_GAP and (
                            best is None or c[3] - skip > best[0][3] - best[1]):
                        best = (c, skip)
                if best:
                    c, skip = best
                    alive.append([c[0], m.start + m.size - 1, end, c[3] + m.size - skip])
                alive.append([m.start, m.start + m.size - 1, end, m.size])
                # of chains at the same place in text and template the best one goes on
                kept: dict[tuple[int, int], list[int]] = {}
                for c in alive:
                    if (c[1], c[2]) not in kept or c[3] > kept[c[1], c[2]][3]:
                        kept[c[1], c[2]] = c
                open_[k] = list(kept.values())
        done += [(k, c) for k, own in open_.items() for c in own]
        spans = []
        for k, words in enumerate(t[2] for t in self.templates):
            own = sorted((c for t, c in done if t == k and c[3] >= COVERAGE * len(words)),
                         key=lambda c: (-c[3], c[0], c[1]))
            taken: list[list[int]] = []
            for c in own:
                if all(c[0] > t[1] or c[1] < t[0] for t in taken):
                    taken.append(c)
                    spans.append((*self.templates[k][:2], c[0], c[1], min(1.0, c[3] / len(words))))
        return sorted(spans, key=lambda s: (s[2], s[1]))

    def scan(self, text: str | None) -> tuple[int, list[tuple], list[tuple]]:
        """(number of words, base places, template spans)."""
        words = words_of(text)
        n = len(self.number)
        ids = np.array([*map(self.number.get, words, repeat(n))], np.int32)
        joined = self.follows[ids[:-1].astype(np.int64) * (n + 1) + ids[1:]] if len(ids) > 1 else np.zeros(0, bool)
        places: list[tuple[str, int]] = []
        found: list[Match] = []
        if joined.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[0], joined.astype(np.int8), [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                found += self.matches(ids[a:b + 1].tolist(), a, places)
        return len(words), places, self.chains(found) if found else []


_SCANNER: list[Scanner] = []


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, places (base phrases) and spans (templates)."""

    def run(texts: list) -> dict:
        if not _SCANNER:
            _SCANNER.append(Scanner())       # a few hundred states, once a worker
        rows = [_SCANNER[0].scan(t) for t in texts]
        return {"n_words": [r[0] for r in rows],
                "places": [[dict(zip(PLACE.names, p)) for p in r[1]] for r in rows],
                "spans": [[dict(zip(SPAN.names, s)) for s in r[2]] for r in rows]}

    return map_texts(docs, text, keep, ADDED, run)
