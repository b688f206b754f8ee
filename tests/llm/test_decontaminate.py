import random
import re

import numpy as np
import pytest

from crashgrid.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def slow(docs, items, window=10):
    wins = {}
    for item, t in items:
        w = words(t)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = []
    for doc, t in docs:
        w, hit, got = words(t), set(), set()
        for m in {len(x) for x in wins}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in wins:
                    hit |= set(range(i, i + m))
                    got |= wins[tuple(w[i : i + m])]
        listed = sorted(str(i) for i in got if i is not None)
        out.append((doc, len(w), len(hit), len(listed), listed, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS key", "1 AS hash")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS id")
    return sorted((tuple(r) for r in D.contamination(d, i).collect()), key=str)


def test_random_texts_equal_brute_force(spark):
    r = random.Random(4)
    draw = lambda n, k: " ".join(r.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i, draw(r.randint(0, 25), 4)) for i in range(25)]
    docs = [(i, draw(r.randint(0, 60), 4)) for i in range(60)]
    docs += [(100 + i, draw(5, 8) + " " + t + " " + draw(5, 8)) for i, t in items if t]
    assert run(spark, docs, items) == slow(docs, items)


def test_cases(spark):
    passage = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich heute Nacht"
    long = " ".join(f"w{i}" for i in range(40_000))
    items = [(1, passage), (2, "only three words"), (3, None), (4, ""), (None, "no id here"), (5, passage), (10, "one"), (6, "a b c d e f")]
    docs = [
        (1, f"x {passage.upper()} y"), (1, f"x {passage} y"), (1, f"x {passage} y"), (2, None), (3, ""), (None, f"{passage}!"),
        (4, "Only--three\nWORDS; no id here."), (5, long + " " + passage), (6, " ".join(passage.split()[:9])), (7, "One a b c d e f a b c d e f"),
    ]
    assert run(spark, docs, items) == slow(docs, items)
    empty = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert D.contamination(empty, bench).count() == 0
    some = spark.createDataFrame(docs, "doc_id long, text string")
    assert D.contamination(some, bench.limit(0)).where("contaminated").count() == 0
    kept = D.drop_contaminated(some, bench.where("item_id = 1"))
    assert kept.columns == some.columns
    assert {r.doc_id for r in kept.collect()} == {x[0] for x in slow(docs, items[:1]) if not x[5]}


@pytest.mark.parametrize("n", [0, 4, 5, 6, 40])
def test_winnowing_selects_in_every_run(n):
    grams = np.random.default_rng(n).integers(0, 9, n).astype(np.uint64)
    got = set(D.winnowed(grams, 5).tolist())
    for i in range(max(0, n - 4)):
        low = min(grams[i : i + 5])
        assert max(k for k in range(i, i + 5) if grams[k] == low) in got
    assert len(got) == 0 if n < 5 else got
