"""Toxicity by a classifier chain of linear models.

The labels say only whether a text is toxic, so the categories of the chain
are found in the labelled texts: the toxic ones are put into ``FAMILIES``
clusters by all their features, and belong to each to some degree.  The chain
predicts family after family and the toxic label last; each link is a logistic
regression over the text's features and the probabilities of all links before
it.  A family's link does not see the features that mark the family most, so
it has to tell the family by its company and by the families before it.  In training those are out-of-fold predictions, so a
later link learns from probabilities as uncertain as the ones it will see.

Features: which known words, and which known beginnings of ``PREFIXES``
bytes, occur in the text; the vocabulary comes from the training sample.

Rows: null and empty texts have no features and get each link's bias;
repeated rows get equal scores; an empty table gives an empty result; without
rows of both classes all probabilities are 0.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from terrarium.llm.common import map_texts
from terrarium.llm.licenses import words_of
from terrarium.llm.quality import sample

#: Labelled rows the chain is fitted on, at most (about) this many a class.
TRAIN_ROWS = 1500
PREFIXES = (4, 5)
#: Features of the models (at most one for each ``TEXTS_A_FEATURE`` texts),
#: those of a family that its link does not see, and texts a feature has to
#: occur in.
FEATURES, TEXTS_A_FEATURE, MARKERS, MIN_TEXTS = 512, 4, 16, 4
FAMILIES, FOLDS = 3, 5
#: How sharply a text belongs to the nearest family.
SHARPNESS = 8.0
PENALTY = 0.5
REMEMBER = 300_000
CATEGORIES = [f"family_{k + 1}" for k in range(FAMILIES)]
ADDED = T.StructType([*(T.StructField(c, T.DoubleType()) for c in CATEGORIES), T.StructField("score", T.DoubleType())])


def features(text: str | None) -> set[bytes]:
    """Words, and word beginnings marked by a star."""
    words = set(words_of(text))
    return words | {w[:n] + b"*" for w in words for n in PREFIXES if len(w) >= n}


@dataclass
class Chain:
    """vocabulary: feature -> column; links: (weights of the features, weights
    of the links before, bias), the toxic label's last."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    links: list[tuple[np.ndarray, np.ndarray, float]] = field(default_factory=list)


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _fit_link(x: np.ndarray, before: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple:
    """Logistic regression by accelerated gradient steps towards ``y`` (0 to
    1), both classes weighted alike; a constant if there is one only."""
    n, f = x.shape
    if y.min() == y.max():
        return np.zeros(f, np.float32), np.zeros(before.shape[1]), -8.0 if y[0] == 0 else 8.0
    up, down = (0.5 / y.sum() * y).astype(np.float32), (0.5 / (n - y.sum()) * (1 - y)).astype(np.float32)
    w, c, b = np.zeros(f, np.float32), np.zeros(before.shape[1]), 0.0
    m = [np.zeros_like(w), np.zeros_like(c), 0.0]
    v = [np.zeros_like(w), np.zeros_like(c), 0.0]
    for step in range(1, steps + 1):
        p = _logistic(x @ w + before @ c + b)
        d = down * p - up * (1 - p)
        grads = [x.T @ d + PENALTY / n * w, before.T @ d + PENALTY / n * c, d.sum()]
        new = []
        for k, (a, g) in enumerate(zip((w, c, b), grads)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            new.append(a - 0.1 * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9 ** step))
                       / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8))
        w, c, b = new[0].astype(np.float32), new[1], float(new[2])
    return w, c, b


def _families(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """How much each toxic text belongs to each family (texts, families), and
    the features that mark each family most: spherical k-means over the texts'
    features, rare ones weighing more, from the text most like all and then the
    least alike ones."""
    rows = x * np.log((len(x) + 1) / (x.sum(axis=0) + 1)).astype(np.float64)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True) + 1e-12
    centers = [rows[np.argmax(rows @ rows.sum(axis=0))]]
    while len(centers) < min(FAMILIES, len(rows)):
        centers.append(rows[np.argmin(np.max([rows @ c for c in centers], axis=0))])
    for _ in range(20):
        share = np.exp(SHARPNESS * (rows @ np.array(centers).T))
        share /= share.sum(axis=1, keepdims=True)
        centers = [c / (np.linalg.norm(c) + 1e-12) for c in share.T @ rows]
    own = np.array(centers)
    above = own - (own.sum(axis=0) - own) / max(1, len(own) - 1)      # a center against the others' mean
    return share, [np.argsort(-a, kind="stable")[:min(MARKERS, x.shape[1] // 2)] for a in above]


def train(keys: list, texts: list[str], toxic: list[int]) -> Chain | None:
    """The chain; None unless both classes are there."""
    y = np.array(toxic, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    own = [features(t) for t in texts]
    count = {}
    for k, feats in enumerate(own):
        for f in feats:
            c = count.setdefault(f, [0, 0])
            c[toxic[k]] += 1
    positives, n = float(y.sum()), len(y)

    def telling(c):     # difference of the shares in both classes, in standard errors
        a, b = c[1] / positives, c[0] / (n - positives)
        s = (c[0] + c[1]) / n
        return (a - b) / np.sqrt(s * (1 - s) * (1 / positives + 1 / (n - positives)) + 1e-12)

    ranked = sorted(((telling(c), f) for f, c in count.items() if sum(c) >= MIN_TEXTS), key=lambda r: (-abs(r[0]), r[1]))
    ranked = ranked[:min(FEATURES, max(16, n // TEXTS_A_FEATURE))]
    chain = Chain({f: k for k, (_, f) in enumerate(ranked)})
    x = np.zeros((n, len(ranked)), np.float32)
    for k, feats in enumerate(own):
        for f in feats:
            if f in chain.vocabulary:
                x[k, chain.vocabulary[f]] = 1
    targets, hidden = np.zeros((n, FAMILIES + 1), np.float32), [np.zeros(0, int)] * (FAMILIES + 1)
    share, marks = _families(x[y == 1])
    targets[y == 1, :share.shape[1]] = share
    hidden[:len(marks)] = marks
    targets[:, -1] = y
    fold = np.array([zlib.crc32(f"fold {k}".encode()) % FOLDS for k in keys])
    before = np.zeros((n, FAMILIES + 1))
    for k in range(FAMILIES + 1):
        known, target = before[:, :k], targets[:, k]
        seen = x.copy()
        seen[:, hidden[k]] = 0              # their weights stay 0
        if k < FAMILIES:
            for held in range(FOLDS):
                rest = fold != held
                if rest.any() and not rest.all():
                    w, c, b = _fit_link(seen[rest], known[rest], target[rest])
                    before[~rest, k] = _logistic(seen[~rest] @ w + known[~rest] @ c + b)
        chain.links.append(_fit_link(seen, known, target))
    return chain


class _Columns(dict):
    """The feature columns of each word seen."""

    def __init__(self, vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        own = {word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)}
        found = self[word] = tuple(self.vocabulary[f] for f in own if f in self.vocabulary)
        return found


def probabilities(chain: Chain, texts: list[str | None], columns: dict) -> np.ndarray:
    """Probabilities (texts, links) of every link of the chain."""
    out = np.zeros((len(texts), len(chain.links)))
    weights = np.stack([w for w, _, _ in chain.links], axis=1).astype(np.float64)
    sums = np.zeros_like(out)
    for k, text in enumerate(texts):
        own = {c for word in set(words_of(text)) for c in columns[word]}
        if own:
            sums[k] = weights[sorted(own)].sum(axis=0)
    for k, (_, c, b) in enumerate(chain.links):
        out[:, k] = _logistic(sums[:, k] + out[:, :k] @ c + b)
    return out


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text",
        label: str = "toxic", train_rows: int = TRAIN_ROWS) -> Chain | None:
    rows = sample(docs, labels, label, learn_from, key, text, train_rows, "toxicity")
    return train([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, chain: Chain | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, the probability of each family, and ``score``, that
    of the toxic label."""

    memory: list[_Columns] = []     # one for each task

    def run(texts: list) -> dict:
        if chain is None:
            return {f.name: [0.0] * len(texts) for f in ADDED.fields}
        if not memory:
            memory.append(_Columns(chain.vocabulary))
        if len(memory[0]) > REMEMBER:
            memory[0].clear()
        p = probabilities(chain, texts, memory[0])
        return {f.name: p[:, k].tolist() for k, f in enumerate(ADDED.fields)}

    return map_texts(docs, text, keep, ADDED, run)
