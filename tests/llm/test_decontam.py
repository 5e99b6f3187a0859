import random

from terrarium.llm import decontam, queries

from .rows import EDGE, frame

SF = "/root/testdata/sf0.01"
ITEMS = "item_id long, text string"


def bench(spark):
    return [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def test_wand_returns_all_above_the_threshold(spark):
    items, rng = bench(spark), random.Random(0)
    for block in (1, 2, 32):
        index = decontam.build_index(items, block=block)
        for _ in range(60):
            words = [w for _, t in rng.sample(items, 2) for w in decontam.words_of(t)]
            terms = sorted({index.terms[w] for w in rng.sample(words, rng.randint(1, len(words)))})
            threshold = rng.choice([0.02, 0.1, 0.3, 0.6])
            score = {}
            for t in terms:
                for item, w in zip(*index.postings[t][:2]):
                    score[item] = score.get(item, 0) + w
            want = {i for i, s in score.items() if s >= threshold - 1e-9}
            got = decontam.wand(index, terms, threshold)
            parts = [h for k in range(0, len(items), index.block)
                     for h in decontam.wand(index, terms, threshold, k, k + index.block)]
            assert {i for i, _ in got} == want == {i for i, _ in parts} and len(got) == len(want)


def test_query_against_search_for_the_whole_items(spark):
    items = bench(spark)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    plain = {k: b" ".join(decontam.words_of(t)) for k, t in docs}
    want = {(k, i) for k, words in plain.items() for i, t in items
            if b" " + b" ".join(decontam.words_of(t)) + b" " in b" " + words + b" "}
    got = queries.op2_decontaminate(spark, SF).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 20
    texts = dict(docs)
    for r in got:
        item = decontam.words_of(dict(items)[r["item_id"]])
        assert set(item) <= set(decontam.words_of(texts[r["doc_id"]][r["start"]:r["stop"]]))
        assert 0.999 < r["score"] < 1.001 and r["question_overlap"] == r["answer_overlap"] == 1.0


def test_question_alone_or_changed_case(spark):
    item = "What is the tallest mountain of the northern range? Answer: Mount Velor of the seven peaks."
    index = decontam.build_index([(1, item), (2, "Some other question about rivers and lakes? Answer: the Tarn.")])
    question, answer = decontam.split_item(item)
    assert "Answer" in question or answer.strip().startswith("Mount")
    hits = decontam.search(index, [f"before it. {item.upper()} after it.", question, "nothing of it", None, ""])
    assert [(place, hit[0]) for place, hit in hits] == [(0, 1)]
    assert decontam.split_item("One. Two three. Four five six.")[1] == "Four five six."
    assert decontam.split_item("one two three four five six seven eight")[1] == "seven eight"
    assert decontam.split_item("") == ("", "")


def test_edge_rows_and_shards(spark):
    items = [(1, EDGE[0][1]), (2, None), (3, ""), (4, EDGE[0][1]), (None, "An item without an id but with some words.")]
    items = spark.createDataFrame(items, ITEMS)
    docs = frame(spark, extra=True)
    for shard_bytes in (1 << 20, 60):
        got = decontam.contaminated(docs, items, shard_bytes=shard_bytes).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 4), (6, 1), (6, 4)]
        left = decontam.without_leaks(docs, items, shard_bytes=shard_bytes)
        assert left.columns == docs.columns and left.count() == 7
    empty = spark.createDataFrame([], ITEMS)
    assert decontam.contaminated(docs, empty).count() == 0
    assert decontam.without_leaks(docs, empty).count() == 9
    assert decontam.contaminated(frame(spark, []), items).count() == 0


def test_scripts_without_spaces_and_marks(spark):
    zh = "\u957f\u57ce\u6700\u9ad8\u7684\u5cf0\u5728\u54ea\u91cc\uff1f\u5b83\u5728\u4eac\u57ce\u7684\u5317\u9762\u5c71\u4e0a\u3002"
    ja = "\u3053\u306e\u5ddd\u306e\u540d\u524d\u306f\u4f55\u3067\u3059\u304b\uff1f\u7b54\u3048\u306f\u9577\u826f\u5ddd\u3067\u3059\u3002"
    items = [(1, zh), (2, ja), (3, "Quelle est la plus haute montagne \u00ab du nord \u00bb ? C'est le mont V\u00e9lor, l'a\u00een\u00e9.")]
    index = decontam.build_index(items)
    page = "\u4eca\u5929\u6211\u4eec\u8bf4\u8fd9\u4e2a\u3002"
    texts = [page + zh + page, page * 3, "\u6628\u65e5\u3001" + ja, "x " + items[2][1].replace("\u00ab ", "\u201c").replace(" \u00bb", "\u201d")]
    hits = decontam.search(index, texts)
    assert [(place, hit[0]) for place, hit in hits] == [(0, 1), (2, 2), (3, 3)]
    for place, hit in hits[:2]:
        item = decontam.words_of(dict(items)[hit[0]])
        assert set(item) <= set(decontam.words_of(texts[place][hit[4]:hit[5]]))
    assert decontam.split_item(zh)[1] == zh[10:]


def test_words_and_spans_agree():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices("ab1 _-.\u00e9e\u0301\u4eca\u3002\u0915\u093f\u0e01\u201c\u0130\u00df\U00020001", k=40))
        assert len(decontam.words_of(text)) == len(decontam.WORD.findall(text))
