import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrarium.llm import queries, vector_codes

SF = "/root/testdata/sf0.01"


def plain(rows):
    """The contract in plain Python: {vec_id: (code, error)}, label errors, digest."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    own = len(kept[0][1]) // 16
    part = [[r[1][p * own:(p + 1) * own] for r in kept] for p in range(16)]
    books = [[list(x) for x in part[p][:64]] for p in range(16)]

    def near(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return min(range(len(far)), key=lambda e: (far[e], e)), min(far)

    for _ in range(2):
        for p in range(16):
            to = [near(p, x)[0] for x in part[p]]
            for e in set(to):
                mine = [x for x, t in zip(part[p], to) if t == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out, errors = [], {}
    for k, (i, _, label) in enumerate(kept):
        got = [near(p, part[p][k]) for p in range(16)]
        out.append((i, "".join(f"{e:02x}" for e, _ in got), sum(d for _, d in got), label))
        errors[label] = errors.get(label, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, c, e, errors[label], sha) for i, c, e, label in out)


def test_gathers_equal_plain_distances():
    rng = np.random.default_rng(3)
    rows, book = rng.integers(-300, 300, (500, 32)), rng.integers(-300, 300, (64, 32))
    book[7] = book[3]                                   # a tie
    index, error = vector_codes.assign(rows, book)
    far = ((rows.reshape(500, 1, 16, 2) - book.reshape(1, 64, 16, 2)) ** 2).sum(axis=3)
    assert (index == far.argmin(axis=1).T).all() and (error == far.min(axis=1).T).all()


def test_query_against_plain_python(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in table.collect()]
    got = sorted(tuple(r) for r in queries.op12_vector_codes(spark, SF).collect())
    assert got == plain(rows)


def test_bad_rows_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=32).round(2).tolist(), None if k % 4 == 0 else k % 3) for k in range(150)]
    rows += [(3, rows[3][1], 0), (200, [-0.0] * 32, 1), (201, [1e4] * 32, 1)]
    bad = [(300, None, 1), (301, [None] + [1.0] * 31, 1), (302, [float("nan")] * 32, 1),
           (303, [float("-inf")] * 32, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("x") for c in ("key", "v", "x", "width", "code", "error", "most", "own", "books")})
    got = sorted(tuple(r) for r in vector_codes.compress(df.repartition(5)).collect())
    assert got == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_nothing_kept(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(df).count() == 0


def test_lengths_large_values_and_null_keys(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [], 1), (None, [0.5] * 16, None), (4, [1e300] * 16, None),
            (5, [-1e300] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in vector_codes.compress(df).collect()}
    assert len(got) == 5 and got[1]["error"] == 0 and got[2]["code"] == "00" * 16
    assert got[4]["error"] == 0 and got[None]["label_error"] == 0
