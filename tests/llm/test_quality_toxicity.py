import numpy as np
import pytest
from pyspark.sql import functions as F

from terrarium.llm import quality, queries, toxicity

from .rows import frame

SF = "/root/testdata/sf0.01"


def small_network():
    rng = np.random.default_rng(0)
    m = quality.Model(rng.normal(0, .5, (256, quality.EMBED)),
                      rng.normal(0, .3, (quality.WIDTH * quality.EMBED, quality.FILTERS)),
                      rng.normal(0, .1, quality.FILTERS), rng.normal(0, .5, 2 * quality.FILTERS), np.zeros(1))
    m.embed[0] = 0
    return m


def test_chunks_cover_every_byte():
    for n in (1, 511, 512, 513, 992, 993, 5000):
        text = bytes((k % 255) + 1 for k in range(n))
        rows, sizes = quality.chunks(text)
        step = quality.CHUNK - quality.OVERLAP
        joined = bytearray(n)
        for k, (row, size) in enumerate(zip(rows, sizes)):
            assert 0 < size <= quality.CHUNK
            joined[k * step:k * step + size] = row[:size].tobytes()
        assert bytes(joined) == text
    assert len(quality.chunks(b"")[1]) == 0


def test_gradients_match_differences():
    m, rng = small_network(), np.random.default_rng(1)
    parts = [quality.chunks(d) for d in (b"hello world this is a test" * 40, b"short" * 30, b"zz y" * 200)]
    rows, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    owner = np.repeat(np.arange(3), [len(p[1]) for p in parts])
    y, w = np.array([0, 1, 1.0]), np.ones(3)
    _, grads = quality.gradients(m, rows, sizes, owner, y, w)
    for k, a in enumerate(m.arrays()):
        i = tuple(rng.integers(0, n) for n in a.shape)
        i = (ord("o"), i[1]) if k == 0 else i
        old, e = a[i], 1e-5
        a[i] = old + e
        up, _ = quality.gradients(m, rows, sizes, owner, y, w)
        a[i] = old - e
        down, _ = quality.gradients(m, rows, sizes, owner, y, w)
        a[i] = old
        assert abs((up - down) / 2 / e - grads[k][i]) < 1e-4


def test_scores_do_not_depend_on_the_batch():
    m = small_network()
    texts = [b"", b"a", b"some text " * 300, b"x" * 600]
    together = quality.scores(m, texts)
    assert np.allclose(together, [quality.scores(m, [t])[0] for t in texts])


def test_quality_edge_rows(spark):
    for model in (small_network(), 0.25):
        rows = quality.score(frame(spark, extra=True), model, ["doc_id"]).collect()
        by = {r["doc_id"]: r["score"] for r in rows}
        assert len(rows) == 9 and all(0 <= s <= 1 for s in by.values())
        assert by[1] == by[6] and by[2] == by[3]
    assert quality.score(frame(spark, []), 0.5, ["doc_id"]).count() == 0


def test_fit_without_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(spark)
    assert quality.fit(docs, labels.filter("false"), F.lit(True)) == 0.5
    assert quality.fit(docs, labels.filter("doc_id = 1"), F.lit(True)) == 0.0     # the smallest label counts
    assert toxicity.fit(docs, labels.filter("doc_id = 1"), F.lit(True)) is None
    rows = toxicity.score(docs, None, ["doc_id"]).collect()
    assert {r["score"] for r in rows} == {0.0} and len(rows) == 9


def test_toxicity_chain_uses_earlier_links():
    rng = np.random.default_rng(0)
    names = [f"w{k}" for k in range(60)]
    texts, toxic = [], []
    for k in range(400):
        words = list(rng.choice(names, 12))
        bad = k % 3 == 0
        if bad:
            words += list(rng.choice(["foulword", "vileword"] if k % 2 else ["nastyterm", "rudeterm"], 2))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    chain = toxicity.train(list(range(400)), texts, toxic)
    assert [len(c) for _, c, _ in chain.links] == [0, 1, 2, 3]
    p = toxicity.probabilities(chain, texts, toxicity._Columns(chain.vocabulary))
    assert (((p[:, -1] >= 0.5) == np.array(toxic)).mean()) > 0.98
    again = toxicity.probabilities(chain, texts[:1], toxicity._Columns(chain.vocabulary))
    assert np.allclose(again, p[:1])


def test_toxicity_edge_rows(spark):
    chain = toxicity.train(list(range(40)), ["good clean words here", "awful stuff fox"] * 20, [0, 1] * 20)
    rows = toxicity.score(frame(spark, extra=True), chain, ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 9 and by[1]["score"] == by[6]["score"]
    assert by[2]["score"] == by[3]["score"]
    assert toxicity.score(frame(spark, []), chain, ["doc_id"]).count() == 0


@pytest.mark.parametrize("query, label, column, least", [
    (queries.op1_quality, "quality", "predicted", 0.9), (queries.op6_toxicity, "toxic", "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, column, least):
    got = query(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    right, n = got.join(labels, "doc_id").filter("held_out").agg(
        F.avg((F.col(column) == F.col("y")).cast("int")), F.count("*")).first()
    assert n > 40 and right > least
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_scores_equal_a_plain_forward_pass():
    m = small_network()
    texts = [b"", b"short one", b"twelve bytes", bytes((7 * k) % 251 + 1 for k in range(1500))]

    def plain(text):
        means, tops, n = np.zeros(quality.FILTERS), np.zeros(quality.FILTERS), 0
        at = 0
        while text and (at == 0 or at + quality.OVERLAP < len(text)):
            chunk = text[at:at + quality.CHUNK]
            best = np.zeros(quality.FILTERS)
            for place in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
                if place >= len(chunk):
                    break
                window = [chunk[place + k] if place + k < len(chunk) else 0 for k in range(quality.WIDTH)]
                seen = np.concatenate([m.embed[b] for b in window])
                for f in range(quality.FILTERS):
                    best[f] = max(best[f], float(seen @ m.filters[:, f]) + m.bias[f])
            means, tops, n = means + best, np.maximum(tops, best), n + 1
            at += quality.CHUNK - quality.OVERLAP
        z = float(np.concatenate([means / max(n, 1), tops]) @ m.dense) + m.dense_bias[0]
        return 1 / (1 + np.exp(-z))

    assert np.allclose(quality.scores(m, texts), [plain(t) for t in texts], atol=1e-5)


def toxic_texts():
    rng = np.random.default_rng(3)
    names = [f"w{k}" for k in range(40)]
    kinds = [["foulword", "vileword", "grimword"], ["nastyterm", "rudeterm", "meanterm"]]
    toxic = [int(k % 3 == 0) for k in range(300)]
    return [" ".join([*rng.choice(names, 8), *(rng.choice(kinds[k % 2], 2) if bad else [])])
            for k, bad in enumerate(toxic)], toxic


def test_probabilities_equal_a_plain_chain():
    texts, toxic = toxic_texts()
    chain = toxicity.train(list(range(300)), texts, toxic)
    some = [*texts[:20], "", None, "unknownword foulword foulword"]
    got = toxicity.probabilities(chain, some, toxicity._Columns(chain.vocabulary))
    for text, row in zip(some, got):
        before = []
        for weights, earlier, bias in chain.links:
            z = bias + sum(float(weights[c]) for f, c in chain.vocabulary.items() if f in toxicity.features(text))
            z += sum(c * p for c, p in zip(earlier, before))
            before.append(1 / (1 + np.exp(-z)))
        assert np.allclose(row, before, atol=1e-5)


def test_families_are_clusters_that_hide_their_marks():
    texts, toxic = toxic_texts()
    vocabulary = sorted(set().union(*map(toxicity.features, texts)))
    x = np.array([[f in toxicity.features(t) for f in vocabulary] for t, y in zip(texts, toxic) if y], np.float32)
    share, marks = toxicity._families(x)
    assert np.allclose(share.sum(axis=1), 1) and len(marks) == toxicity.FAMILIES
    chain = toxicity.train(list(range(300)), texts, toxic)
    for weights, _, _ in chain.links[:-1]:
        hidden = min(toxicity.MARKERS, len(chain.vocabulary) // 2)
        assert (weights == 0).sum() >= hidden
    assert (chain.links[-1][0] != 0).sum() > len(chain.vocabulary) // 2


def test_the_sample_is_bounded_by_keys_and_characters(spark):
    long = "ab " * 50_000
    docs = spark.range(3000).selectExpr("id % 3 AS doc_id", f"concat(id, ' {'x' * 40}') AS text").union(
        spark.createDataFrame([(3, long), (4, None), (None, "no key")], "doc_id long, text string"))
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(6)], "doc_id long, quality int, toxic int")
    rows = quality.sample(docs, labels, "quality", F.lit(True))
    assert [r[0] for r in rows] == [0, 1, 2, 3, 4] and [r[2] for r in rows] == [0, 1, 0, 1, 0]
    assert rows[0][1].startswith("0 x") and rows[4][1] == ""
    assert len(rows[3][1]) == 1 << 14 and rows[3][1] in long
