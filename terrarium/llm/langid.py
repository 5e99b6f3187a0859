"""Language identification: a bidirectional gated recurrent network over bytes.

Every text becomes its UTF-8 bytes.  A forward and a backward recurrent layer
read them; a softmax over both states labels every byte with a language, and
the byte probabilities are averaged into one distribution for the document.
The network is trained in numpy by backpropagation through time.

Long texts are read in segments of ``SEGMENT`` bytes, each with ``CONTEXT``
bytes on either side that warm the recurrent states up and get no label, so
every byte of the text is labelled exactly once and no text is cut off.

Rows: null text, or one without any letter -> ``und`` with score 0.0 and no
byte labelled; empty text likewise; repeated rows are scored alike, each on
its own; an empty table gives an empty result; a table without any row to
learn from gives ``und`` for all rows.  Ties between languages go to the
alphabetically first one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrarium.llm.common import map_texts, training_part

UNKNOWN = "und"
HIDDEN = 10
SEGMENT, CONTEXT = 352, 16
#: Segments that go through the network side by side.
LANES = 2048
#: Rows the network is fitted on, at most (about) this many a language.
TRAIN_ROWS = 600
LETTER = regex.compile(r"\p{L}")
ADDED = T.StructType([T.StructField("lang_pred", T.StringType()),
                      T.StructField("score", T.DoubleType())])


@dataclass
class Model:
    """Weights; a cell is a direction's inputs (gates x 256 x H, a row for
    each byte, biases included) and recurrent weights (gates x H x H).
    Gates: update, reset, candidate."""

    languages: list[str]
    cells: list[tuple[np.ndarray, np.ndarray]]
    out: np.ndarray        # 2H x languages
    out_bias: np.ndarray   # languages


def new_model(languages: list[str], rng: np.random.Generator, hidden: int = HIDDEN) -> Model:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    cells = [(normal(3, 256, hidden, scale=0.3), normal(3, hidden, hidden, scale=hidden ** -0.5))
             for _ in range(2)]
    return Model(languages, cells, normal(2 * hidden, len(languages), scale=hidden ** -0.5),
                 np.zeros(len(languages), np.float32))


def _states(cell, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (steps, lanes, H) of one direction for bytes (steps, lanes).
    At a zero byte, which pads a text, the state is zero.

    With ``trace``, what backpropagation needs is appended for each step."""
    inputs, recurrent = cell
    h = recurrent.shape[-1]
    n, lanes = steps.shape
    half = np.float32(0.5)
    gate_in, gate_rec = inputs[:2] * half, recurrent[:2] * half  # logistic(x) = (1 + tanh(x / 2)) / 2
    out = np.empty((n, lanes, h), np.float32)
    state = np.zeros((lanes, h), np.float32)
    gates, u2 = np.empty((2, lanes, h), np.float32), np.empty((2, lanes, h), np.float32)
    cand, u = np.empty((lanes, h), np.float32), np.empty((lanes, h), np.float32)
    z, r = gates
    padded = (steps == 0).any(axis=1).tolist()
    for t in range(n):
        byte = steps[t]
        np.take(gate_in[0], byte, axis=0, out=z, mode="clip")
        np.take(gate_in[1], byte, axis=0, out=r, mode="clip")
        np.matmul(state, gate_rec, out=u2)
        gates += u2
        np.tanh(gates, out=gates)
        gates *= half
        gates += half
        np.take(inputs[2], byte, axis=0, out=cand, mode="clip")
        np.matmul(state, recurrent[2], out=u)
        if trace is not None:
            part = u.copy()
        u *= r
        cand += u
        np.tanh(cand, out=cand)
        if trace is not None:
            trace.append((state, z.copy(), r.copy(), part, cand.copy()))
        new = out[t]
        np.subtract(state, cand, out=new)
        new *= z
        new += cand
        if padded[t]:
            new[byte == 0] = 0
        state = new
    return out


def forward(model: Model, steps: np.ndarray) -> np.ndarray:
    """Language probabilities (steps, lanes, languages) of every byte."""
    steps = steps.astype(np.intp)
    ahead = _states(model.cells[0], steps)
    back = _states(model.cells[1], steps[::-1])[::-1]
    h = ahead.shape[2]
    logits = np.matmul(ahead, model.out[:h])
    logits += np.matmul(back, model.out[h:])
    logits += model.out_bias
    return _softmax(logits)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over the last axis, in place.  Logits of this network are small (its
    states lie between -1 and 1), so exp needs no shift; the clip is a guard."""
    flat = logits.reshape(-1, logits.shape[-1])
    np.clip(flat, -60, 60, out=flat)
    np.exp(flat, out=flat)
    flat /= flat @ np.ones((flat.shape[1], flat.shape[1]), flat.dtype)
    return logits


def gradients(model: Model, steps: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    """Loss and gradients (in the order of ``_arrays``) for bytes (steps,
    lanes), a label for each lane, and a weight for each byte."""
    steps = steps.astype(np.intp)
    traces = [[], []]
    ahead = _states(model.cells[0], steps, traces[0])
    back = _states(model.cells[1], steps[::-1], traces[1])[::-1]
    both = np.concatenate([ahead, back], axis=2)
    h = ahead.shape[2]
    p = _softmax(np.matmul(both, model.out) + model.out_bias)
    lanes = np.arange(steps.shape[1])
    scale = weight / max(weight.sum(), 1.0)
    loss = float(-(np.log(p[:, lanes, labels] + 1e-9) * scale).sum())
    d = p.copy()
    d[:, lanes, labels] -= 1
    d *= scale[:, :, None]
    flat = d.reshape(-1, d.shape[2])
    d_out = both.reshape(-1, 2 * h).T @ flat
    d_both = np.matmul(d, model.out.T)
    grads = []
    for k, (cell, trace) in enumerate(zip(model.cells, traces)):
        order = steps if k == 0 else steps[::-1]
        d_states = d_both[:, :, :h] if k == 0 else d_both[::-1, :, h:]
        grads += _through_time(cell, trace, order, d_states)
    return loss, [*grads, d_out.astype(np.float32), flat.sum(axis=0)]


def _through_time(cell, trace, steps, d_states):
    inputs, recurrent = cell
    h = recurrent.shape[-1]
    d_rec = np.zeros_like(recurrent)
    d_in = np.empty((3, *steps.shape, h), np.float32)
    carry = np.zeros_like(trace[0][0])
    for t in range(len(trace) - 1, -1, -1):
        state, z, r, part, cand = trace[t]
        d = (d_states[t] + carry) * (steps[t] != 0)[:, None]
        d_cand = d * (1 - z) * (1 - cand * cand)
        d_gates = (d * (state - cand) * z * (1 - z), d_cand * part * r * (1 - r), d_cand * r)
        carry = d * z
        for k, g in enumerate(d_gates):
            carry += g @ recurrent[k].T
            d_rec[k] += state.T @ g
        d_in[0, t], d_in[1, t], d_in[2, t] = d_gates[0], d_gates[1], d_cand
    # the gradient of a byte's row is the sum over all places of that byte
    order = np.argsort(steps.ravel(), kind="stable")
    bytes_, first = np.unique(steps.ravel()[order], return_index=True)
    d_inputs = np.zeros_like(inputs)
    for k in range(3):
        d_inputs[k, bytes_] = np.add.reduceat(d_in[k].reshape(-1, h)[order], first, axis=0)
    return [d_inputs, d_rec]


def _arrays(model: Model) -> list[np.ndarray]:
    return [a for cell in model.cells for a in cell] + [model.out, model.out_bias]


def train(texts: list[str], langs: list[str], seed: int = 7, rounds: int = 400,
          lanes: int = 192, steps: int = 64, rate: float = 0.02) -> Model | None:
    """Fit by backpropagation through time on windows drawn from anywhere in
    the texts, equally many from each language; None without labelled text."""
    by: dict[str, list[np.ndarray]] = {}
    for text, lang in zip(texts, langs):
        if text and lang is not None and LETTER.search(text):
            by.setdefault(lang, []).append(np.frombuffer(text.encode("utf-8"), np.uint8))
    languages = sorted(by)
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    model = new_model(languages, rng)
    params = _arrays(model)
    first, second = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    for step in range(1, rounds + 1):
        batch = np.zeros((steps, lanes), np.uint8)
        weight = np.zeros((steps, lanes), np.float32)
        labels = np.arange(lanes) % len(languages)
        for lane, label in enumerate(labels):
            docs = by[languages[label]]
            doc = docs[rng.integers(len(docs))]
            size = int(rng.integers(8, steps + 1))     # short texts are learned too
            at = rng.integers(max(1, len(doc) - size + 1))
            piece = doc[at:at + size]
            batch[:len(piece), lane] = piece
            weight[:len(piece), lane] = 1
        _, grads = gradients(model, batch, labels, weight)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1.0, step / 20) * (1 - 0.9 * step / rounds) * min(1.0, 1.0 / (norm + 1e-9))
        for a, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


def segments(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (SEGMENT + 2 CONTEXT, segments), the document of each segment,
    and the first and last step of each segment that get a label."""
    width = SEGMENT + 2 * CONTEXT
    counts = [-(-len(d) // SEGMENT) for d in docs]
    owner = np.repeat(np.arange(len(docs)), counts)
    rows = np.zeros((len(owner), width), np.uint8)
    stop = np.empty(len(owner), np.int64)
    k = 0
    for d, n in zip(docs, counts):
        if not n:
            continue
        padded = np.zeros(n * SEGMENT + 2 * CONTEXT, np.uint8)
        padded[CONTEXT:CONTEXT + len(d)] = np.frombuffer(d, np.uint8)
        rows[k:k + n] = np.lib.stride_tricks.as_strided(padded, (n, width), (SEGMENT, 1))
        stop[k:k + n] = CONTEXT + SEGMENT
        stop[k + n - 1] = CONTEXT + len(d) - (n - 1) * SEGMENT
        k += n
    return rows, owner, np.full(len(owner), CONTEXT), stop


def document_probabilities(model: Model, docs: list[bytes]) -> np.ndarray:
    """Mean of the byte probabilities of each document (documents, languages);
    zeros for an empty one."""
    total = np.zeros((len(docs), len(model.languages)))
    rows, owner, start, stop = segments(docs)
    # short segments last, so that a group of them ends as soon as its bytes do
    order = np.argsort(-stop, kind="stable")
    for i in range(0, len(order), LANES):
        own = order[i:i + LANES]
        width = min(rows.shape[1], int(stop[own].max()) + CONTEXT)
        p = forward(model, np.ascontiguousarray(rows[own, :width].T))
        if int(stop[own].min()) == CONTEXT + SEGMENT:
            sums = p[CONTEXT:CONTEXT + SEGMENT].sum(axis=0)
        else:
            at = np.arange(width)[:, None]
            p *= ((at >= start[own]) & (at < stop[own]))[:, :, None]
            sums = p.sum(axis=0)
        np.add.at(total, owner[own], sums.astype(np.float64))
    lengths = np.array([len(d) for d in docs], float)
    return total / np.maximum(lengths, 1)[:, None]


def predict(model: Model | None, texts: list[str | None]) -> dict:
    known = [model is not None and t is not None and LETTER.search(t) is not None for t in texts]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if any(known):
        at = [i for i, k in enumerate(known) if k]
        p = document_probabilities(model, [texts[i].encode("utf-8", "replace") for i in at])
        best = p.argmax(axis=1)
        for i, k, row in zip(at, best.tolist(), p):
            langs[i], scores[i] = model.languages[k], float(min(1.0, row[k]))
    return {"lang_pred": langs, "score": scores}


def fit(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang",
        key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model | None:
    """Train on about ``train_rows`` keys of each language among the rows that
    meet ``learn_from``, chosen by a hash of the key (of the text where the key
    is null).  A key with several rows, however many, gives one text a
    language, and a text gives ``TRAIN_CHARS`` characters at most, so the
    driver gets no more than ``train_rows`` x ``TRAIN_CHARS`` of them a language
    (about).  Rows of one repeated key count once, so a table made of few keys
    is learned from as few texts."""
    own = docs.filter(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = own.groupBy(F.col(lang).alias("lang")).count().collect()
    parts = None
    scale = 1 << 30
    seed = F.when(F.col(key).isNull(), F.xxhash64(F.lit("langid"), F.col(text))).otherwise(
        F.xxhash64(F.lit("langid"), F.col(key)))
    for row in sorted(counts, key=lambda r: r["lang"]):
        share = int(min(1.0, train_rows / row["count"]) * scale)
        rule = (F.col(lang) == row["lang"]) & (
            F.pmod(seed, F.lit(scale)) < F.lit(share))
        parts = rule if parts is None else parts | rule
    if parts is None:
        return None
    chosen = own.filter(parts).select(F.col(key).alias("k"), seed.alias("seed"), F.col(lang).alias("l"),
                                      training_part(text, F.lit("langid"), seed).alias("t"))
    rows = sorted(chosen.groupBy("k", "seed", "l").agg(F.min("t").alias("t")).collect(),
                  key=lambda r: (str(r["l"]), r["k"] is None, r["k"], r["t"]))
    return train([r["t"] for r in rows], [r["l"] for r in rows])


def identify(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus lang_pred and score of every row."""
    return map_texts(docs, text, keep, ADDED, lambda texts: predict(model, texts))
