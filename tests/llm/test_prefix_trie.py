import hashlib
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from terrarium.llm import prefix_trie, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn int, role string, text string"


def plain(rows):
    """The contract in plain Python."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = convs.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        path = tuple(base[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, d == len(path)))
    out = []
    for path, members in nodes.items():
        ids = sorted(c for c, _ in members)
        below = [p for p in nodes if p[:len(path)] == path]
        leaf = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        done = ",".join(str(c) for c in sorted(c for c, e in members if e))
        out.append((ids[0], len(path), min(c for c, _ in nodes[path[:-1]]) if path else None, len(ids),
                    sum(len(p) == len(path) + 1 for p in below), len(leaf), saved,
                    hashlib.sha256(done.encode()).hexdigest()))
    return sorted(out, key=str)


def of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some(seed, n=120, long=40):
    """Conversations that share heads, bodies and ends, one of them long."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(0, 5)) if c != 41 else long):
            rows.append((c * int(rng.choice([1, 1, 1, -1])), t, str(rng.choice(["user", "bot"])),
                         str(rng.choice(["a b", "c", "", "d\te  f"]))))
    return rows


def test_slots_are_minimal_perfect_and_verified():
    keys = np.random.default_rng(0).integers(-2**63, 2**63 - 1, (5000, 3))
    table = prefix_trie.Slots(keys)
    assert sorted(table.find(keys).tolist()) == list(range(5000))
    other = keys.copy()
    other[:, 2] += 1
    assert (table.find(other) == -1).all()
    assert len(prefix_trie.Slots(keys[:0]).find(keys)) == 5000
    assert (prefix_trie.Slots(keys[:1]).find(keys[:1]) == 0).all()


def test_running_sums_over_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), k, int(rng.integers(-2**62, 2**62))) for g in (1, 2, 2, 3) for k in range(1000 if g == 3 else 7)]
    rows = [(g, k * 2 + i % 2, x) for i, (g, k, x) in enumerate(rows)]
    rows = list({(g, k): (g, k, x) for g, k, x in rows}.values())
    df = spark.createDataFrame(rows, "g long, k long, x long")
    got = {(r["g"], r["k"]): (r["nth"], r["x"]) for r in prefix_trie.running(df, "g", ["k"], ["x"]).collect()}
    for g in (1, 2, 3):
        total = 0
        for n, (_, k, x) in enumerate(sorted(r for r in rows if r[0] == g)):
            total ^= x
            assert got[g, k] == (n, total)


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert of(queries.op13_conversation_trie(spark, SF)) == plain(rows)


def test_heavy_nodes_and_shards(spark, monkeypatch):
    rows = some(2)
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    for subtree, shard in ((1, 1), (6, 8), (10_000, 10_000)):
        monkeypatch.setattr(prefix_trie, "SUBTREE", subtree)
        monkeypatch.setattr(prefix_trie, "SHARD", shard)
        assert of(prefix_trie.trie(df)) == want


def test_runs_of_many_members(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_BYTES", 60)
    rows = [(c, 0, "user", "hello") for c in range(0, 4000, 20)]
    assert of(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(7))) == plain(rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(None, 0, "user", "x"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, "a", "z"), (0, 1, "a", "b"),
            (1, 0, "user", "one"), (1, 0, "user", "one"), (1, 0, "user", "one"), (2, 0, "", ""), (2, 5, "u", "w " * 50_000),
            (40, 0, "user", "x y"), (47, 0, "user", "x y"), (61, 3, "user", "alone"), (-3, 1, "user", "minus"),
            (62, 0, "u", "p"), (62, 1, "u", "q"), (63, 0, "u", "p"), (63, 1, "u", "q")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("conv", "nth", "depth", "x1", "part", "n", "base", "h", "head", "size", "pos", "c", "t")})
    assert of(prefix_trie.trie(df)) == plain(rows)
    assert prefix_trie.trie(df.filter("false")).count() == 0
    assert prefix_trie.trie(df.filter("conv_id is null")).count() == 0
