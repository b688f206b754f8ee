import random

import pytest
import xxhash
from pyspark.sql import functions as F

from crashgrid.llm import components, simhash
from crashgrid.llm.queries import QUERIES
from crashgrid.llm.shared import Scratch

from .conftest import SF


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    """rows of (id, fingerprint) -> smallest id reachable over links of 4 bits."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if bin(a ^ b).count("1") <= 4:
                parent[root(b)] = root(a)
    least = {}
    for i, f in rows:
        r = root(f)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return sorted(((i, f"{f:016x}", least[root(f)]) for i, f in rows), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(map(tuple, QUERIES["op2_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert got == slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in docs])


def test_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "A b c d e", 0), (1, "A b c d e", 0), (5, "a B C d  e", 1), (2, None, 2), (3, "", 3), (None, " \n", 4), (9, "one", 5), (8, "one two", 5), (7, long, 6), (None, "alone here now", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=str)
    assert got == slow_components([(i, slow_fingerprint(t)) for i, t, _ in rows])
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 7, 8, 9]


@pytest.mark.parametrize("max_bucket", [2, 64])
def test_crowded_buckets_lose_no_link(spark, max_bucket):
    """A dense ball of fingerprints, a chain and scattered ones, by either way."""
    r = random.Random(1)
    centre, chain = r.getrandbits(64), r.getrandbits(64)
    fps = {r.getrandbits(64) for _ in range(50)}
    for _ in range(150):
        fps.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))))
    for k in range(12):
        chain ^= sum(1 << b for b in r.sample(range(64), 4))
        fps.add(chain)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    scratch = Scratch(spark, "test")
    edges = simhash.links(df, scratch, 4, max_bucket)
    for a, b in edges.collect():
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 4
    roots = {x.node: x.root for x in components.connected_components(edges, scratch).collect()}
    groups = {}
    for f, s in zip(fps, signed):
        groups.setdefault(roots.get(s, s), set()).add(f)
    want = {}
    for f, _, c in [(f, x, c) for (f, x, c) in slow_components([(f, f) for f in fps])]:
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(200)] + [(200, 7), (3, 3)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    edges = spark.createDataFrame(path + hub, "a long, b long").withColumn("extra", F.lit(1))
    got = {r.node: r.root for r in components.connected_components(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 400)}
    assert components.connected_components(edges.limit(0), Scratch(spark, "test")).count() == 0
