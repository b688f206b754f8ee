"""Merkle manifests against a tree built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from crashgrid.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]))


def tree(nodes, fanout):
    """(root, the siblings before and after each leaf's way, level by level)"""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, a in zip(ways, at):
            start = a - a % fanout
            way.append(("".join(nodes[start:a]), "".join(nodes[a + 1 : start + fanout])))
        at = [a // fanout for a in at]
        nodes = [H(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], ways


def plain(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = []
    for g in order:
        leaves = sorted((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)) for r in groups[g])
        below.append((leaves, *tree([x[2] for x in leaves], fanout)))
    if not below:
        return []
    root, tops = tree([b[1] for b in below], fanout)
    return sorted(
        (leaf, sub, root, tuple(way + top))
        for (leaves, sub, ways), top in zip(below, tops) for (_, _, leaf), way in zip(leaves, ways)
    )


def built(df, **options):
    rows = merkle.manifest(df, **options).collect()
    return sorted((r.leaf, r.subroot, r.root, tuple((x.before, x.after) for x in r.proof)) for r in rows)


def corpus(spark, sizes):
    """Groups of the given sizes, a null one first, with nulls, empties and repeats."""
    rows = []
    for g, n in enumerate(sizes):
        lang = None if g == 0 else f"l{g:02d}é"
        rows += [(i * 7 % n, f"text {i} of {g} ü", lang, None if i % 5 == 0 else "web", None if i % 4 == 0 else i) for i in range(n)]
    rows += [(None, None, None, None, None), (3, "", "l01é", "", 0), (3, "", "l01é", "", 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("fanout, block_leaves", [(2, 2), (2, 8), (3, 9), (4, 4096), (5, 6)])
def test_equals_plain_trees(spark, fanout, block_leaves):
    df = corpus(spark, [40, 1, 17, 9, 3, 30, 2])
    assert built(df, fanout=fanout, block_leaves=block_leaves) == plain([r.asDict() for r in df.collect()], fanout)


def test_one_leaf_one_group_and_no_rows(spark):
    df = corpus(spark, [1])
    one = df.where("doc_id = 0")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root == leaf_of(one.first().asDict()) and row.proof == []
    assert merkle.manifest(df.limit(0)).collect() == []


def test_long_text_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "é" * 300_000, "en", "s", 5), (2, "x", "en", "s", 1)], SCHEMA)
    wide = df.withColumns({c: F.lit(0) for c in ("leaf", "grp", "pos", "block", "n", "node", "root", "_part")})
    assert built(wide) == built(df) == plain([r.asDict() for r in df.collect()], 2)


def test_fold_finds_what_was_changed(spark):
    df = corpus(spark, [12, 5, 9])
    forged = merkle.leaf_digest("doc_id", "source", "lang", "n_chars", F.when(F.col("doc_id") == 2, "forged").otherwise(F.col("text")))
    found = merkle.manifest(df, fanout=3, block_leaves=9, carry={"seen": forged})
    rows = found.select("doc_id", "root", merkle.fold(F.col("seen"), F.col("proof")).alias("got")).collect()
    assert {r.doc_id for r in rows if r.got != r.root} == {2}


def test_fanout_below_two_is_an_error(spark):
    with pytest.raises(ValueError):
        merkle.manifest(corpus(spark, [2]), fanout=1)
