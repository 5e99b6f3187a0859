import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terrarium.llm import bpe, queries

from .rows import EDGE, frame

SF = "/root/testdata/sf0.01"
FILE = public_tokenizers.path(bpe.DEFAULT_FILE)


@pytest.fixture(scope="module")
def both():
    with open(FILE) as f:
        return bpe.Tokenizer(f.read()), Tokenizer.from_file(FILE)


def test_matches_the_library_on_odd_texts(both):
    own, library = both
    rng = random.Random(1)
    pool = [chr(c) for c in range(0x250)] + list("   　​一١²Ⅷ́\x1c\x1f") + [
        chr(0x1F600), "<|endoftext|>", "'s", "'ll", " ", "  ", "\n", " \n "]
    for _ in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_partial_characters_decode_like_the_library(both):
    own, library = both
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_and_forgetting(both, monkeypatch):
    own, library = both
    text = "ab" * 20_000 + " " + "x" * 5000
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "REMEMBER", 2)
    assert own.encode("forget all of these words now") == library.encode("forget all of these words now").ids


def test_query_against_the_library(spark, both):
    library = both[1]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op7_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_edge_rows(spark):
    docs = frame(spark, extra=True)
    got = bpe.round_trip(docs, ["doc_id"], ids=True).collect()
    texts = {r[0]: r[1] for r in EDGE}
    assert len(got) == 9
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3)} == {0}
    assert bpe.round_trip(frame(spark, []), ["doc_id"]).count() == 0
    assert bpe.encode(docs, ["doc_id"]).columns == ["doc_id", "ids"]
