import numpy as np
import xxhash

from pyspark.sql import functions as F

from terrarium.llm import queries, simhash
from terrarium.llm.components import components

from .rows import EDGE, frame

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups_of(values, radius):
    n = len(values)
    near = np.array([[(int(a) ^ int(b)).bit_count() <= radius for b in values] for a in values])
    label = np.arange(n)
    while True:
        new = np.array([label[near[i]].min() for i in range(n)])
        if (new == label).all():
            return label
        label = new


def noisy(rng, n, centers, flips):
    out = rng.integers(0, 2 ** 63, centers, dtype=np.uint64)[rng.integers(0, centers, n)]
    for i in range(n):
        for b in rng.integers(0, 64, rng.integers(0, flips)):
            out[i] ^= np.uint64(1) << np.uint64(b)
    return np.unique(out)


def test_bit_sliced_comparison_matches_popcounts():
    rng = np.random.default_rng(1)
    for radius in (1, 2, 3, 4, 7):
        v = noisy(rng, 300, 3, 9)
        i, j = rng.integers(0, len(v), 500), rng.integers(0, len(v), 500)
        want = [(int(a) ^ int(b)).bit_count() <= radius for a, b in zip(v[i], v[j])]
        assert (simhash.near_pairs(v[i], v[j], radius) == want).all()
        assert (simhash.group_roots(v, radius) == groups_of(v, radius)).all()


def test_every_pair_within_the_radius_meets_in_a_table():
    rng = np.random.default_rng(2)
    for _ in range(500):
        flips = rng.permutation(64)[:3]
        x = sum(1 << int(b) for b in flips)
        assert any(x & m == 0 for m in simhash.masks())


def test_links_give_all_groups_also_from_split_buckets(spark):
    rng = np.random.default_rng(3)
    v = noisy(rng, 400, 4, 5)
    signed = [(int(x) - (1 << 64) if x >= 1 << 63 else int(x),) for x in v.tolist()]
    df = spark.createDataFrame(signed, "fp long")
    want = groups_of(v, 3)
    for bucket in (4096, 16):
        found = {r["node"]: r["root"] for r in components(simhash.links(df, bucket=bucket)).collect()}
        got = [found.get(s[0], s[0]) for s in signed]
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(v)) for j in range(i))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 40)] + [(3, 3), (None, 4), (2, 1)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in range(7, 40)}, 1: 1, 2: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_match_plain_ones():
    for text in (*[r[1] for r in EDGE], "a", "a b", "A b\x0bC", "É é É ß ẞ\xa0x y", "x " * 50):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    values = np.array(sorted(set(prints.values())), np.uint64)
    root = dict(zip(values.tolist(), groups_of(values, 3)))
    first = {}
    for d, p in sorted(prints.items()):
        first.setdefault(root[p], d)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op8_simhash(spark, SF).collect()}
    assert got == {d: (f"{p:016x}", first[root[p]]) for d, p in prints.items()}


def test_edge_rows_and_keep_one(spark):
    docs = frame(spark, extra=True)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == 9
    by = {r["doc_id"]: r for r in found}
    assert by[6]["component_id"] == 1 and by[None]["component_id"] is None
    assert by[2]["fp"] == by[3]["fp"] == by[4]["fp"] == 0 and by[4]["component_id"] == 2
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    ids = sorted((r["doc_id"] for r in left.collect()), key=str)
    assert ids == sorted([1, 2, 5, 7, None], key=str)
    empty = frame(spark, [])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_keep_one_without_any_key(spark):
    docs = frame(spark).withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.keep_one(docs).count() == 5
