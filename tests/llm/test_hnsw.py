import numpy as np
from pyspark.sql import functions as F

from terrarium.llm import hnsw, queries

SF = "/root/testdata/sf0.1"


def brute(vectors, ids, query_ids, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in query_ids:
        s = unit @ unit[ids.index(q)]
        own = sorted((-round(x, 12), i) for x, i in zip(s, ids) if i != q)[:k]
        out[q] = [i for _, i in own]
    return out


def test_choose_and_reachability():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(900, 16))
    g = hnsw.build(v)
    seen, todo = {g.entry}, [g.entry]
    while todo:
        for x in g.layers[0][g.place[0][todo.pop()]].tolist():
            if x >= 0 and x not in seen:
                seen.add(x)
                todo.append(x)
    assert len(seen) == len(v)
    for layer in g.layers:
        for row in layer:
            own = row[row >= 0]
            assert len(set(own.tolist())) == len(own)


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, v = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in queries.op4_hnsw(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        a, b = v[ids.index(r["query_id"])], v[ids.index(r["vec_id"])]
        assert abs(r["score"] - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
    want = brute(v, ids, [i for i in ids if i % 50 == 0], 5)
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.95


def test_shards_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)).round(3)
    rows = [(k, base[k].tolist()) for k in range(300)]
    rows += [(1000 + k, base[0].tolist()) for k in range(40)]           # a group of copies
    bad = [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] * 4), (2003, [float("nan")] * 8),
           (2004, [float("inf")] * 8), (None, base[1].tolist()), (2005, []), (3, base[3].tolist())]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("id", "v", "shard", "rank", "score", "query")})
    asked = df.filter("vec_id % 50 = 0")
    got = {}
    for r in hnsw.nearest(df, asked, shard_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    ids = [r[0] for r in rows]
    want = brute(np.array([r[1] for r in rows]), ids, [i for i in ids if i % 50 == 0], 5)
    assert got.keys() == want.keys()
    assert got[0] == [1000, 1001, 1002, 1003, 1004] and got[1000] == [0, 1001, 1002, 1003, 1004]
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9


def test_few_candidates_other_lengths_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 3.0]), (50, [1.0, 2.0, 3.0])],
                               "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in
           hnsw.nearest(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    empty = df.filter("false")
    assert hnsw.nearest(empty, empty).count() == 0


def test_every_shard_is_a_task_of_its_own(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    graphs = hnsw.index(df, "vec_id", "embedding", 5, shard_rows=128)
    shards = graphs.count()
    assert shards == 12 and len(graphs.inputFiles()) == shards
