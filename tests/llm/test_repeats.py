import random
import zlib

import pytest
from pyspark.sql import functions as F

from terrarium.llm import queries, repeats

from .rows import EDGE, frame

SF = "/root/testdata/sf0.001"


def brute(rows):
    """{(key, text): (remaining text, removed spans)} without Spark."""
    seen = {}
    own = {(k, t) for k, t in rows}

    def hash_of(t):
        # only the order among equal keys depends on it; the tests have none
        return zlib.crc32((t or "").encode())

    units = {}
    for k, t in own:
        for digest, level, start in repeats.hashed_units(t or ""):
            rank = (k is not None, k or 0, hash_of(t), start)
            units.setdefault((k, t), []).append((digest, level, start, rank))
            if digest not in seen or rank < seen[digest]:
                seen[digest] = rank
    out = {}
    for k, t in own:
        gone = [(lv, s) for d, lv, s, rank in units.get((k, t), []) if seen[d] != rank]
        spans = repeats.cuts(t, gone) if gone else []
        out[k, t] = ("".join(t[a:b] for a, b in repeats.kept(t, spans)) if spans else t, spans)
    return out


def prose(rng, sentences, words=(6, 14)):
    return " ".join(" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9)))
                             for _ in range(rng.randint(*words))).capitalize() + "." for _ in range(sentences))


def test_planted_passage_inside_other_prose(spark):
    rng = random.Random(4)
    passage = prose(rng, 8)
    rows, clean = [], {}
    for k in range(40):
        a, b = prose(rng, 6), prose(rng, 6)
        text = f"{a[:-5]} {passage} {b}" if k % 2 else f"{a}\n{b}"
        rows.append((k, text, "en", "s", len(text)))
        if k % 2 == 0:
            clean[k] = text
    got = {r["doc_id"]: r for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    inner = ". ".join(passage.split(". ")[2:-2])
    for k, text, *_ in rows:
        if k in clean or k == 1:
            assert got[k]["text"] == text and got[k]["removed"] == []
        else:
            assert inner not in got[k]["text"] and len(got[k]["text"]) < len(text) - len(inner) + 5
            cut = "".join(text[s["start"]:s["stop"]] for s in got[k]["kept"])
            assert cut == got[k]["text"]
    assert inner in got[1]["text"]


def test_passage_without_sentence_ends_inside_other_prose(spark):
    """Long sentences are cut by their own words, whatever stands around."""
    rng = random.Random(9)
    passage = prose(rng, 1, (70, 70))[:-1]
    rows = [(k, f"{prose(rng, 1, (30, 30))[:-1]} {passage} {prose(rng, 1, (30, 30))}", "en", "s", 0) for k in range(6)]
    got = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    words = passage.lower().split()
    assert got[0] == rows[0][1]
    for k in range(1, 6):
        left = got[k].lower().split()
        assert sum(w in set(left) for w in words) < 35 and len(left) >= 60


def test_every_passage_of_51_words_is_found():
    """Long sentences, with and without short ones among them, in other prose."""
    rng = random.Random(5)

    def some(n, ends):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=7)) + ("." if rng.random() < ends else "")
                        for _ in range(n))

    for trial in range(400):
        passage = some(51, (0, 0, 0.05, 0.5)[trial % 4])
        texts = [f"{some(rng.randint(0, 40), 0)} {passage} {some(rng.randint(0, 40), 0)}".strip() for _ in range(2)]
        got = brute(list(enumerate(texts)))
        assert got[0, texts[0]] == (texts[0], [])
        (a, b), = got[1, texts[1]][1]
        at = texts[1].index(passage)
        assert at <= a and b <= at + len(passage) and len(texts[1][a:b].split()) >= repeats.RUN_WORDS
    runs = [" ".join(["so"] * n) for n in (60, 75, 90)] + [" ".join(["on and"] * n) for n in (40, 55)]
    got = brute(list(enumerate(runs)))
    assert all(len(got[k, t][0].split()) < 51 for k, t in enumerate(runs) if k not in (0, 3))


def test_repeated_lines_and_short_units(spark):
    line = "One two three four five six seven eight nine."
    rows = [(1, f"{line}\nOwn words here.\n{line}", "en", "s", 0), (2, f"Other text. Own words here.\n{line.upper()}", "en", "s", 0),
            (3, "Own words here.", "en", "s", 0)]
    got = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: f"{line}\nOwn words here.\n", 2: "Other text. Own words here.\n", 3: "Own words here."}


def test_short_units_between_repeated_pieces_stay_unless_they_repeat(spark):
    opening = "This opening line stands before every list that the site has shown so far."
    closing = "This closing line stands after every list that the site has shown so far."
    bodies = ["Red fox. Blue jay.\nGrey owl.\n", "Iron. Zinc.\nPure gold.\nTin.\n", "Iron. Zinc.\nPure gold.\nTin.\n"]
    rows = [(k, f"{opening}\n{body}{closing}", "en", "s", 0) for k, body in enumerate(bodies)]
    # inside one line, too
    rows += [(k + 10, t.replace("\n", " "), "en", "s", 0) for k, t, *_ in rows[:2]]
    got = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert got[0] == rows[0][1]
    assert got[1] == bodies[1] and got[2] == ""
    assert "Iron. Zinc. Pure gold. Tin." not in got[11] and "Red fox." not in got[10]
    # short words alone do not make up a run
    rows = [(1, "Uno dos tres. Si. No. Ya. Cuatro cinco seis.", "es", "s", 0),
            (2, "Uno dos tres. " + "Oui. Non. " * 2 + "Bon. Mal. Ici. La. Un. Deux. Dix. Cent. Mer. Sel. Cuatro cinco seis.", "fr", "s", 0)]
    got = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert got == {k: t for k, t, *_ in rows}


def test_texts_of_one_key_with_the_same_32_bit_hash_are_two_documents(spark):
    line = "One two three four five six seven eight nine."
    a = spark.range(150_000).select(F.concat(F.lit(line + "\n"), "id").alias("a"))
    b = spark.range(150_000).select(F.concat(F.lit("This line stands in no other document but number "), "id").alias("b"))
    pair = a.join(b, F.hash("a") == F.hash("b")).first()
    rows = [(1, line, "en", "s", 0), (5, pair["a"], "en", "s", 0), (5, pair["b"], "en", "s", 0)]
    got = [r["text"] for r in repeats.remove_repeats(frame(spark, rows)).collect()]
    assert sorted(got) == sorted([line, pair["a"].split("\n")[1], pair["b"]])


def test_units_of_repeated_rows_are_listed_once(spark):
    rng = random.Random(3)
    text = prose(rng, 30)
    rows = [(1, text, "en", "s", 0)] + [(2, text, "en", "s", 0)] * 50
    (found,) = repeats.repeated_units(frame(spark, rows).repartition(5)).collect()
    starts = [(u["level"], u["start"]) for u in found["units"]]
    assert sorted(starts) == sorted((level, s) for _, level, s in repeats.hashed_units(text))
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted(r["text"] for r in got) == [""] * 50 + [text]


def test_edge_rows(spark):
    docs = frame(spark, extra=True)
    got = repeats.remove_repeats(docs, removed="went_1", kept_spans="stayed_1")
    assert got.columns == [*docs.columns, "went_1", "stayed_1"]
    rows = got.collect()
    want = brute([(r[0], r[1]) for r in EDGE])
    assert len(rows) == 9
    for r in rows:
        assert (r["text"], [tuple(s) for s in r["went_1"]]) == want[r["doc_id"], next(
            t for k, t, *_ in EDGE if k == r["doc_id"])]
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_query_against_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(docs)
    got = queries.op10_repeated_units(spark, sf).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        assert (r["text"], [tuple(s) for s in r["removed"]]) == want[r["doc_id"], texts[r["doc_id"]]]
        assert r["chars_removed"] == len(texts[r["doc_id"]]) - len(r["text"])


def plain_words(text):
    """(start, stop, lower-case word) by the rule, a character at a time."""
    out, at = [], None

    def alone(c):
        return ord(c) >= repeats.WIDE or any(a <= ord(c) <= b for a, b in repeats.UNSPACED)

    for i, c in enumerate(text + " "):
        if at is not None and (c.isspace() or alone(c) or alone(text[at])):
            out.append((at, i, "".join(x.lower() if len(x.lower()) == 1 else x for x in text[at:i])))
            at = None
        if at is None and not c.isspace():
            at = i
    return out


SAMPLES = ["", " ", "one", "One two.\nThree \u00a0four\u3000five!", "\u4eca\u65e5\u306f abc\u3002x\ny", "\u0130stanbul \u00c9T\u00c9 a\U00020001b",
           "He said \"no.\" Then (why?) ...", "x" * 900 + " y", "\r\n\t a"]


@pytest.mark.parametrize("block", [1 << 18, 7])
def test_words_by_the_rule(monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = random.Random(1)
    texts = SAMPLES + ["".join(rng.choices("ab. \n\u4eca\u0e01\U0002f800Z", k=200)) for _ in range(20)]
    hashes = {}
    for text in texts:
        w, _ = repeats.words_of(text)
        want = plain_words(text)
        assert list(zip(w.start.tolist(), w.stop.tolist())) == [x[:2] for x in want]
        for h, (_, _, word) in zip(w.hash.tolist(), want):
            assert hashes.setdefault(word, h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_units_do_not_depend_on_their_neighbours():
    rng = random.Random(2)
    texts = SAMPLES + [prose(rng, 12).replace(". ", rng.choice([". ", ".\n"])) for _ in range(30)]
    u = repeats.units_of(texts)
    for k, text in enumerate(texts):
        own = repeats.units_of([text])
        at = u.text == k
        for name in ("level", "start", "stop", "words", "d1", "d2", "hashed"):
            assert (getattr(u, name)[at] == getattr(own, name)).all()
        pieces = [(a, b) for a, b, lv in zip(own.start, own.stop, own.level) if lv == repeats.PIECE]
        # the pieces hold all words, in order
        assert [x for a, b in pieces for x in plain_words(text[a:b])] == [
            (s - a, e - a, x) for a, b in pieces for s, e, x in plain_words(text) if a <= s < b]
        assert sum(own.words[own.level == repeats.PIECE]) == len(plain_words(text))
        assert all(len(plain_words(text[a:b])) <= repeats.WINDOW for a, b in pieces)


def test_wrapped_lines_and_scripts_without_spaces(spark):
    """The same passage in lines of another width, and in Chinese prose."""
    rng = random.Random(8)
    passage = prose(rng, 6, (10, 10)).split()
    wrapped = "\n".join(" ".join(passage[i:i + 7]) for i in range(0, len(passage), 7))
    han = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(120))
    others = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(40)) for _ in range(2)]
    rows = [(1, prose(rng, 2) + " " + " ".join(passage), "en", "s", 0), (2, wrapped + "\n" + prose(rng, 2), "en", "s", 0),
            (3, others[0] + han, "zh", "s", 0), (4, han + others[1], "zh", "s", 0)]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert got[1]["removed"] == [] and got[3]["removed"] == []
    for k, n in ((2, 60), (4, 120)):
        gone = sum(len(plain_words(rows[k - 1][1][s["start"]:s["stop"]])) for s in got[k]["removed"])
        assert n - 2 * repeats.WINDOW <= gone <= n
