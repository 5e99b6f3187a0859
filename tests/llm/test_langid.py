import numpy as np
import pytest
from pyspark.sql import functions as F

from terrarium.llm import langid, queries

from .rows import LONG, frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    texts = ["the cat sat on the mat and the dog was there with them"] * 5 + [
        "der hund und die katze sind nicht in dem haus für heute"] * 5
    return langid.train(texts, ["en"] * 5 + ["de"] * 5, rounds=60, lanes=32, steps=32)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    m = langid.new_model(["a", "b"], rng, 4)
    m.cells = [tuple(x.astype(float) for x in c) for c in m.cells]
    steps = rng.integers(0, 5, (6, 3)).astype(np.uint8)
    labels, weight = np.array([0, 1, 0]), np.ones((6, 3))
    _, grads = langid.gradients(m, steps, labels, weight)
    for a, g in zip(langid._arrays(m), grads):
        i = tuple(rng.integers(0, n) for n in a.shape)
        if a.ndim == 3 and a.shape[1] == 256:
            i = (i[0], int(steps[2, 1]), i[2])
        old, e = a[i], 0.02
        a[i] = old + e
        up, _ = langid.gradients(m, steps, labels, weight)
        a[i] = old - e
        down, _ = langid.gradients(m, steps, labels, weight)
        a[i] = old
        assert abs((up - down) / 2 / e - g[i]) < 2e-3


def test_every_byte_is_labelled_once():
    for n in (0, 1, 351, 352, 353, 5000):
        rows, owner, start, stop = langid.segments([b"a" * n, b"bb"])
        assert (stop - start)[owner == 0].sum() == n and (stop - start)[owner == 1].sum() == 2


def test_document_probability_does_not_depend_on_its_neighbours(model):
    docs = [b"the cat was there", "für die katze".encode(), b"x", LONG[:3000].encode()]
    together = langid.document_probabilities(model, docs)
    for k, d in enumerate(docs):
        assert np.allclose(together[k], langid.document_probabilities(model, [d])[0], atol=1e-4)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-3)


def test_edge_rows(spark, model):
    got = langid.identify(frame(spark, extra=True), model, ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 9 and got[0].asDict().keys() == {"doc_id", "lang_pred", "score"}
    for k in (2, 3, 4, 7):
        assert by[k]["lang_pred"] == "und" and by[k]["score"] == 0.0
    assert by[1]["lang_pred"] == by[6]["lang_pred"] == "en" and by[1]["score"] == by[6]["score"]
    assert 0 <= by[5]["score"] <= 1 and by[None]["lang_pred"] == "en"


def test_empty_table_and_nothing_to_learn(spark):
    empty = frame(spark, [])
    assert langid.fit(empty, F.lit(True)) is None
    assert langid.identify(empty, None, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in langid.identify(frame(spark), None, ["doc_id"]).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = queries.op3_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.join(docs, "doc_id").filter("held_out and lang_pred != 'und'")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.95
    assert got.count() == docs.count()


def test_number_characters_are_no_letters():
    model = langid.new_model(["aa", "bb"], np.random.default_rng(0))
    texts = ["\u00bd \u00be", "x\u00b2", "\u00b2\u00b3 \u2460\u2461", "\u2167 12", "\u4eca", "_ 1", None]
    got = langid.predict(model, texts)
    assert [x == "und" for x in got["lang_pred"]] == [True, False, True, True, False, True, True]
    assert all(s == 0.0 for s, x in zip(got["score"], got["lang_pred"]) if x == "und")


def test_probabilities_equal_a_plain_forward_pass(model):
    def cell(weights, data):
        inputs, recurrent = (w.astype(float) for w in weights)
        state, out = np.zeros(inputs.shape[-1]), []
        for byte in data:
            z = 1 / (1 + np.exp(-(inputs[0, byte] + state @ recurrent[0])))
            r = 1 / (1 + np.exp(-(inputs[1, byte] + state @ recurrent[1])))
            new = np.tanh(inputs[2, byte] + r * (state @ recurrent[2]))
            state = z * state + (1 - z) * new
            out.append(state)
        return out

    for text in (b"the cat", "für die katze und den hund".encode(), b"a"):
        both = np.concatenate([cell(model.cells[0], text), cell(model.cells[1], text[::-1])[::-1]], axis=1)
        logits = both @ model.out + model.out_bias
        p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        assert np.allclose(langid.document_probabilities(model, [text])[0], p.mean(axis=0), atol=1e-3)


@pytest.mark.parametrize("key", ["5", "CAST(NULL AS BIGINT)"])
def test_repeated_and_missing_keys_send_a_bounded_sample(spark, monkeypatch, key):
    got = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: got.append((texts, langs)))
    docs = spark.range(4000).selectExpr(f"{key} AS doc_id", "concat('text ', id, repeat(' wort', 8000)) AS text",
                                        "if(id % 2 = 0, 'en', 'de') AS lang")
    langid.fit(docs, F.lit(True), train_rows=50)
    (texts, langs), = got
    if key == "5":
        assert len(texts) <= 2
    else:
        assert 60 < len(texts) < 150 and set(langs) == {"en", "de"}
    assert all(len(t) == 1 << 14 for t in texts)
