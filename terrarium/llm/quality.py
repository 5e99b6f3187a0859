"""Quality classifier: a convolutional network over bytes, in numpy.

The UTF-8 bytes of a text are cut into overlapping chunks that cover all of
it.  In each chunk learned filters slide over the embedded bytes; the largest
response of every filter is kept.  The chunks' responses are averaged and
maximised over the document, and a dense layer turns both into one
probability.  Trained by gradient descent with both classes weighted alike.

Rows: null text counts as empty; an empty text has no response and gets the
probability of the dense layer's bias; repeated rows get equal scores; an
empty table gives an empty result; without rows of both classes to learn from
every score is the share of class 1 (0.5 without any).  Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import map_texts, training_part

CHUNK, OVERLAP = 512, 32
WIDTH, STRIDE, EMBED, FILTERS = 8, 2, 6, 24
#: Labelled rows the network is fitted on, at most (about) this many a class.
TRAIN_ROWS = 1500
#: Chunks of a document that a training step looks at.
TRAIN_CHUNKS = 8
#: Share of the class-1 texts of a step that are cut to so many bytes.
SHORT_SHARE, SHORT_BYTES = 0.2, (20, 160)
#: Chunks that go through the filters at once.
LANES = 256
ADDED = T.StructType([T.StructField("score", T.DoubleType())])


@dataclass
class Model:
    """embed: 256 x EMBED, row 0 (padding) is zero; filters: WIDTH * EMBED x
    FILTERS; dense: 2 FILTERS, for the mean and the largest response."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.dense, self.dense_bias]


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Chunks (n, CHUNK), padded with zeros, and the bytes in each."""
    step = CHUNK - OVERLAP
    n = 0 if not text else 1 + max(0, -(-(len(text) - CHUNK) // step))
    padded = np.zeros((n - 1) * step + CHUNK if n else 0, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    rows = np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (step, 1)) if n else padded.reshape(0, CHUNK)
    return rows, np.minimum(CHUNK, len(text) - step * np.arange(n))


def _windows(model: Model, rows: np.ndarray) -> np.ndarray:
    """What the filters see (chunks, places, WIDTH * EMBED)."""
    x = np.take(model.embed, rows.astype(np.intp), axis=0)
    places = (rows.shape[1] - WIDTH) // STRIDE + 1
    a, b, c = x.strides
    return np.lib.stride_tricks.as_strided(x, (len(rows), places, WIDTH * EMBED), (a, b * STRIDE, c))


def responses(model: Model, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and its place."""
    seen = _windows(model, rows)
    n, places, width = seen.shape
    got = (seen.reshape(-1, width) @ model.filters).reshape(n, places, -1)
    got += model.bias
    np.maximum(got, 0, out=got)
    short = sizes < rows.shape[1]
    if short.any():
        beyond = np.arange(places)[None, :] * STRIDE >= sizes[short][:, None]
        got[short] *= ~beyond[:, :, None]
    return got.max(axis=1), got


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    parts = [chunks(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p[1]) for p in parts])
    f = len(model.bias)
    mean, top = np.zeros((len(texts), f)), np.zeros((len(texts), f))
    if len(owner):
        rows, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        most = np.concatenate([responses(model, rows[i:i + LANES], sizes[i:i + LANES])[0]
                               for i in range(0, len(rows), LANES)]).astype(np.float64)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        own = owner[first]
        mean[own] = np.add.reduceat(most, first, axis=0) / np.diff(np.append(first, len(owner)))[:, None]
        top[own] = np.maximum.reduceat(most, first, axis=0)
    z = np.concatenate([mean, top], axis=1) @ model.dense + model.dense_bias[0]
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def gradients(model: Model, rows: np.ndarray, sizes: np.ndarray, owner: np.ndarray, labels: np.ndarray,
              weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients (in the order of ``arrays``); ``owner`` is ascending
    and names every document of ``labels``."""
    most, got = responses(model, rows, sizes)
    place = got.argmax(axis=1)
    f = len(model.bias)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    count = np.diff(np.append(first, len(owner)))
    mean = np.add.reduceat(most, first, axis=0) / count[:, None]
    top = np.maximum.reduceat(most, first, axis=0)
    both = np.concatenate([mean, top], axis=1)
    p = 1 / (1 + np.exp(-np.clip(both @ model.dense + model.dense_bias[0], -30, 30)))
    scale = weight / weight.sum()
    loss = float(-(scale * (labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9))).sum())
    d = (scale * (p - labels)).astype(np.float32)
    d_both = d[:, None] * model.dense[None, :]
    d_most = (d_both[:, :f] / count[:, None])[owner]
    is_top = (most == top[owner]).astype(np.float32)
    is_top /= np.add.reduceat(is_top, first, axis=0)[owner]          # equal chunks share it
    d_most = d_most + d_both[:, f:][owner] * is_top
    d_most = (d_most * (most > 0)).astype(np.float32)
    at = place[:, :, None] * STRIDE + np.arange(WIDTH)
    bytes_ = rows[np.arange(len(rows))[:, None, None], at]                     # chunks, filters, WIDTH
    seen = model.embed[bytes_].reshape(len(rows), f, -1)
    d_filters = np.einsum("nf,nfw->wf", d_most, seen, optimize=True)
    d_seen = d_most[:, :, None] * model.filters.T[None]
    d_embed = np.zeros_like(model.embed)
    np.add.at(d_embed, bytes_.reshape(-1), d_seen.reshape(-1, EMBED))
    d_embed[0] = 0
    return loss, [d_embed, d_filters, d_most.sum(axis=0), both.T @ d, np.array([d.sum()])]


def train(texts: list[str], labels: list[int], seed: int = 11, steps: int = 400, batch: int = 64,
          rate: float = 0.01) -> Model | None:
    """Fit with as many documents of either class in each step; None unless
    there are both."""
    docs = [(t or "").encode("utf-8") for t in texts]
    by = [[d for d, y in zip(docs, labels) if y == k and d] for k in (0, 1)]
    if not by[0] or not by[1]:
        return None
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                  rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
                  np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
                  np.zeros(1, np.float32))
    model.embed[0] = 0
    first, second = [np.zeros_like(a) for a in model.arrays()], [np.zeros_like(a) for a in model.arrays()]
    y = (np.arange(batch) % 2).astype(np.float32)
    for step in range(1, steps + 1):
        rows, sizes, owner = [], [], []
        for k in range(batch):
            own = by[k % 2]
            doc = own[rng.integers(len(own))]
            if k % 2 and rng.random() < SHORT_SHARE:
                # a good text is good in parts; short ones are rare as whole rows
                at, size = rng.integers(len(doc)), rng.integers(*SHORT_BYTES)
                doc = doc[at:at + size]
            r, s = chunks(doc)
            pick = np.sort(rng.permutation(len(s))[:TRAIN_CHUNKS])
            rows.append(r[pick])
            sizes.append(s[pick])
            owner += [k] * len(pick)
        _, grads = gradients(model, np.concatenate(rows), np.concatenate(sizes), np.array(owner), y,
                             np.ones(batch))
        pace = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for a, g, m, v in zip(model.arrays(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


def sample(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, key: str = "doc_id",
           text: str = "text", rows: int = TRAIN_ROWS, salt: str = "quality") -> list[tuple]:
    """(key, text, label) of at most about ``rows`` keys of either class,
    chosen by a hash of the key, in a fixed order.  A key with several labels
    counts with the smallest; one with several rows, however many, gives one
    text, the smallest of their parts.  A text gives ``TRAIN_CHARS``
    characters at most, so the driver gets no more than 2 x ``rows`` x
    ``TRAIN_CHARS`` of them (about)."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & learn_from)
             .groupBy(key).agg(F.min(label).alias("y")))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    scale = 1 << 30
    share = F.lit(0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(int(min(1.0, rows / n) * scale))).otherwise(share)
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(scale)) < share)
    # the chosen keys are bounded by ``rows``, so they go to the texts, not the texts to them
    part = training_part(text, F.lit(salt), F.col(key))
    got = (docs.select(key, part.alias(text)).join(F.broadcast(chosen), key)
           .groupBy(key, "y").agg(F.min(text).alias(text)).select(key, text, "y").collect())
    return sorted(((r[0], r[1] or "", r[2]) for r in got), key=lambda r: (r[0], r[1]))


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text",
        label: str = "quality", train_rows: int = TRAIN_ROWS) -> Model | float:
    """The network, or the share of class 1 if only one class is known."""
    rows = sample(docs, labels, label, learn_from, key, text, train_rows)
    model = train([r[1] for r in rows], [r[2] for r in rows])
    if model is not None:
        return model
    return sum(r[2] for r in rows) / len(rows) if rows else 0.5


def score(docs: DataFrame, model: Model | float, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus the probability of label 1 of every row."""

    def run(texts: list) -> dict:
        if not isinstance(model, Model):
            return {"score": [float(model)] * len(texts)}
        return {"score": scores(model, [(t or "").encode("utf-8") for t in texts]).tolist()}

    return map_texts(docs, text, keep, ADDED, run)
