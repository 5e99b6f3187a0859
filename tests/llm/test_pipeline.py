import hashlib

from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from terrarium.llm import bpe, decontam, langid, simhash
from terrarium.llm.common import crc_mod, table

from .rows import EDGE, frame, write_tables
from .test_repeats import brute
from .test_simhash import groups_of, plain_fingerprint

import numpy as np

SF = "/root/testdata/sf0.001"


def by_hand(rows, items, languages):
    """{doc_id: text} after all filters, without Spark."""
    left = {k: t for k, t in rows if languages[k][0] != "und" and languages[k][1] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
    prints = {k: plain_fingerprint(t) for k, t in left.items()}
    values = np.array(sorted(set(prints.values())), np.uint64)
    root = dict(zip(values.tolist(), groups_of(values, simhash.RADIUS)))
    first = {}
    for k in sorted(left):
        first.setdefault(root[prints[k]], k)
    left = {k: left[k] for k in first.values()}
    cut = brute(list(left.items()))
    left = {k: cut[k, t][0] for k, t in left.items() if cut[k, t][0].strip() or not cut[k, t][1]}
    plain = {k: b" " + b" ".join(decontam.words_of(t)) + b" " for k, t in left.items()}
    return {k: t for k, t in left.items()
            if not any(b" " + b" ".join(decontam.words_of(i)) + b" " in plain[k] for i in items)}


def test_run_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs, crc_mod("doc_id", 4) != 2)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    predicted = langid.predict(model, [t for _, t in rows])
    languages = {k: (a, b) for (k, _), a, b in zip(rows, predicted["lang_pred"], predicted["score"])}
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    want = by_hand(rows, items, languages)
    library = Tokenizer.from_file(public_tokenizers.path(bpe.DEFAULT_FILE))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == want.keys() and len(got) < len(rows)
    for k, r in got.items():
        ids = library.encode(want[k], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(want[k].encode()).hexdigest()


def test_stages_take_edge_rows_and_clashing_columns(spark, tmp):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog. It was not amused by that at all.")],
                                  "item_id long, text string")
    for name, rows, kept in (("edge", EDGE, {5, None}), ("empty", [], set())):
        docs = frame(spark, rows, extra=True)
        folder = write_tables(spark, f"{tmp}/{name}", docs, benchmark=items)
        docs = table(spark, folder, "documents")
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == columns and out.dtypes == docs.dtypes
                out.write.parquet(f"{tmp}/{name}-{k}")
                docs = spark.read.parquet(f"{tmp}/{name}-{k}")
        assert {r["doc_id"] for r in docs.collect()} == kept
        assert out.count() == len(kept)


def test_text_length_follows_the_text(spark):
    line = "One two three four five six seven eight nine."
    rows = [(1, line + "\nmine", "en", "s", len(line) + 5), (2, line + "\nyours", "en", "s", len(line) + 6),
            (3, line, "en", "s", len(line))]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeated_passages(
        spark, frame(spark, rows), SF).collect()}
    assert got == {1: (line + "\nmine", len(line) + 5), 2: ("yours", 5)}
