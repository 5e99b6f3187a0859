import random
import re

from terrarium.llm import license_texts, licenses, queries

from .rows import frame

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    out = []
    for label, phrase in license_texts.PHRASES:
        p = phrase.split()
        out += [(label, i) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(out)


def test_base_places_against_plain_search():
    scanner, rng = licenses.Scanner(), random.Random(0)
    words = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "the", "x", "é", "under"]
    for _ in range(1500):
        text = rng.choice([" ", "-", ", "]).join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        text = text.upper() if rng.random() < 0.4 else text
        n, places, _ = scanner.scan(text)
        assert (n, sorted(places)) == base(text)


def test_matching_statistics_against_all_runs():
    scanner, rng = licenses.Scanner(), random.Random(1)
    sources = [w for _, _, w in scanner.templates] + [w for _, w in scanner.phrases]
    runs = {tuple(w[i:j]) for w in sources for i in range(len(w)) for j in range(i + 1, min(len(w), i + 22) + 1)}
    for _ in range(80):
        words = []
        while len(words) < 40:
            own = rng.choice(sources)
            i = rng.randrange(len(own))
            words += own[i:i + rng.randint(1, 7)]
        longest = [max((n for n in range(1, min(j + 1, 21) + 1) if tuple(words[j + 1 - n:j + 1]) in runs), default=0)
                   for j in range(len(words))]
        want = {(j - n + 1, n) for j, n in enumerate(longest) if n >= licenses.MIN_MATCH
                and (j + 1 == len(words) or longest[j + 1] <= n)}
        assert {(m.start, m.size) for m in scanner.matches([scanner.number[w] for w in words], 0, [])} == want


def test_templates_whole_changed_and_partial():
    scanner = licenses.Scanner()
    for label, name, text in license_texts.TEMPLATES:
        n = len(licenses.words_of(text))
        spans = scanner.scan(f"some code {text} more code")[2]
        assert (label, name, 2, n + 1, 1.0) in spans
    words = license_texts.MIT.split()
    words[30:32] = ["Anton", "Berta", "Caesar"]
    spans = scanner.scan("x " + " ".join(words))[2]
    assert [s[1] for s in spans] == ["mit-text"] and 0.9 < spans[0][4] < 1
    assert scanner.scan(" ".join(license_texts.MIT.split()[:60]))[2] == []
    twice = scanner.scan(license_texts.ISC + " and then once more " + license_texts.ISC)[2]
    assert [s[1] for s in twice] == ["isc-text"] * 2


def test_query_against_plain_search(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op9_license_scan(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n, places = base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert r["first_word"] == (min(p[1] for p in places) if places else None)
        assert r["last_word"] == (max(p[1] for p in places) if places else None)
        assert r["base_labels"] == ",".join(sorted({p[0] for p in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")


def test_edge_rows(spark):
    got = licenses.scan(frame(spark, extra=True), ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 9 and by[2]["n_words"] == by[3]["n_words"] == by[4]["n_words"] == 0
    assert by[1]["n_words"] == 17 and by[5]["n_words"] == 40_000 and by[7]["spans"] == []
    assert licenses.scan(frame(spark, []), ["doc_id"]).count() == 0
