"""Merkle manifest of a dataset by butterfly exchange.

Rows are leaves; the leaves of each group (a language, say) form a tree, and the
groups' roots form one more tree on top. A node's digest is the SHA-256 of its
children's hexadecimal digests joined, ``fanout`` children to a node, the last
run of a level as many as are left, even one.

Leaves are cut at aligned places into blocks of ``fanout**k`` leaves. Each block
hashes its own subtree. Then blocks swap subtree roots round by round: in round
r the blocks at the same place below ``fanout`` neighbouring subtrees form one
exchange group, each receives the roots of the others, hashes their common
ancestor for itself and appends what it received to its proof. After the last
round every block holds the root and its whole upper proof; nothing is handed
down. A subtree at the end of a level may have fewer blocks than its
neighbours: it sends its root to all their places, once each.

No group of rows is larger than a block or ``fanout`` exchange partners, so
neither a language that holds a third of the rows nor many languages make one
large task. Places of leaves come from ``operators.ranking.with_global_rank``.

Cases: a null group is the first group; a null id sorts first; equal ids are
ordered by their leaves, and equal rows are leaves of their own, as often as
they occur. A null or empty field has a digest of its own ("-" or "0:"). A text
is hashed by the JVM as it lies, however long, and is not moved. Columns that
are not fields are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import with_global_rank
from .shared import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves in a block at most; a block is the largest power of the fanout within.
BLOCK_LEAVES = 4096

LEVEL = T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
PROOF = T.ArrayType(LEVEL)


def leaf_digest(*fields: str | Column) -> Column:
    """SHA-256 of the fields joined, each as its UTF-8 byte count, ":" and value;
    a null field is "-". Numbers are in decimal."""
    parts = []
    for field in fields:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its way up lead to."""
    return F.aggregate(proof, leaf, lambda node, level: F.sha2(F.concat(level["before"], node, level["after"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.flatten(F.transform(proof, lambda level: F.array(level["before"], level["after"]))), "")


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _height(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    height = 0
    while n > 1:
        n, height = -(-n // fanout), height + 1
    return height


def _levels(leaves: list[str], fanout: int, height: int) -> list[list[str]]:
    """A block's nodes, leaves first, ``height`` levels above them."""
    levels = [leaves]
    for _ in range(height):
        below = levels[-1]
        levels.append([_hash(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def _block_levels(leaves: pa.Table, fanout: int, k: int) -> list[list[str]]:
    n = leaves["n"][0].as_py()
    return _levels(leaves["leaf"].to_pylist(), fanout, min(k, _height(n, fanout)))


def _root_of_block(fanout: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        top = _block_levels(table, fanout, k)[-1][0]
        return table.select(["grp", "block", "n"]).slice(0, 1).append_column("node_digest", pa.array([top]))

    return run


def _proofs_of_block(fanout: int, k: int, carried: Sequence[str]):
    def run(table: pa.Table, upper: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        levels = _block_levels(table, fanout, k)
        above = [(x["before"], x["after"]) for x in upper["proof"][0].as_py()]
        before, after = [], []
        for leaf in range(table.num_rows):
            at = leaf
            for nodes in levels[:-1]:
                start = at - at % fanout
                before.append("".join(nodes[start:at]))
                after.append("".join(nodes[at + 1 : start + fanout]))
                at //= fanout
            before.extend(b for b, _ in above)
            after.extend(a for _, a in above)
        height = len(levels) - 1 + len(above)
        pairs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
        offsets = pa.array([i * height for i in range(table.num_rows + 1)], pa.int32())
        same = {c: pa.array([upper[c][0].as_py()] * table.num_rows, pa.string()) for c in ("subroot", "root")}
        return pa.table({
            "id": table["id"], "grp": table["grp"], "leaf": table["leaf"], **same,
            "proof": pa.ListArray.from_arrays(offsets, pairs), **{c: table[c] for c in carried},
        })

    return run


def _swap(members: DataFrame, scope: Sequence[str], fanout: int, width: Column, active: Column) -> DataFrame:
    """One round: members at the same place below neighbouring nodes meet.

    A member is a block: its ``node`` at this level within ``scope``, the number
    of blocks below that node (``size``), its own place among them (``place``)
    and the node's digest. ``width`` is the largest size in its run of nodes: a
    smaller node is sent to each place up to it. Members not ``active`` have
    reached the top of their scope and stay as they are.
    """
    state = [c for c in members.columns if c not in ("node", "size", "place", "node_digest")]
    places = F.when(active, F.sequence("place", width - 1, "size")).otherwise(F.array("place"))
    sent = (
        members.withColumn("_active", active)
        .withColumn("_to", F.explode(places))
        .select(
            *[F.col(c).alias(f"_{c}") for c in scope],
            F.when(F.col("_active"), F.floor(F.col("node") / fanout)).otherwise(F.lit(-1) - F.col("block")).alias("_run"),
            "_to",
            F.struct(
                "node", "size", "place", "node_digest", "_active", (F.col("_to") == F.col("place")).alias("own"),
                F.when(F.col("_to") == F.col("place"), F.struct(*state)).alias("state"),
            ).alias("m"),
        )
    )
    met = sent.groupBy(*[f"_{c}" for c in scope], "_run", "_to").agg(F.array_sort(F.collect_list("m")).alias("run"))
    one = met.select("run", F.explode("run").alias("m")).where("m.own")
    me = F.col("m.node")
    joined = lambda test: F.array_join(F.transform(F.filter("run", test), lambda x: x["node_digest"]), "")
    size_before = F.aggregate(F.filter("run", lambda x: x["node"] < me), F.lit(0).cast("long"), lambda s, x: s + x["size"])
    level = F.struct(joined(lambda x: x["node"] < me).alias("before"), joined(lambda x: x["node"] > me).alias("after"))
    act = F.col("m._active")
    return one.select(
        *[F.col(f"m.state.{c}").alias(c) for c in state if c != "proof"],
        F.when(act, F.floor(me / fanout)).otherwise(me).alias("node"),
        F.when(act, F.aggregate("run", F.lit(0).cast("long"), lambda s, x: s + x["size"])).otherwise(F.col("m.size")).alias("size"),
        F.when(act, size_before + F.col("m.place")).otherwise(F.col("m.place")).alias("place"),
        F.when(act, F.sha2(joined(lambda x: F.lit(True)), 256)).otherwise(F.col("m.node_digest")).alias("node_digest"),
        F.when(act, F.concat("m.state.proof", F.array(level))).otherwise(F.col("m.state.proof")).alias("proof"),
    )


def _group_widths(groups: DataFrame, fanout: int, rounds: int) -> DataFrame:
    """Per group and round above the groups' roots: the blocks below the largest
    node of the run that the group's node belongs to."""
    each = groups.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    power = F.pow(F.lit(fanout), F.col("_round")).cast("long")
    each = each.withColumn("_node", F.floor(F.col("g") / power))
    sizes = each.groupBy("_round", "_node").agg(F.sum("blocks").alias("_size"))
    run = Window.partitionBy("_round", F.floor(F.col("_node") / fanout))
    widths = sizes.withColumn("_width", F.max("_size").over(run))
    return (
        each.join(widths, ["_round", "_node"])
        .groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("_round", "_width"))), lambda x: x["_width"]).alias("widths"))
    )


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    fanout: int = 2,
    block_leaves: int = BLOCK_LEAVES,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, group, ``leaf``, ``subroot`` (its group's
    root), ``root`` and ``proof``, the siblings before and after its way up at
    each level. ``carry`` adds columns computed from the row, such as a digest to
    hold against the proof with :func:`fold`. See the module for the rules."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    scratch = Scratch(docs.sparkSession, "merkle")
    k = 1
    while fanout ** (k + 1) <= block_leaves:
        k += 1
    carry = carry or {}
    carried = [f"_carry{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf_digest(*fields).alias("leaf"),
        *[c.alias(name) for c, name in zip(carry.values(), carried)],
    )
    placed = with_global_rank(rows, [F.col("id").asc_nulls_first(), "leaf"], alias="pos", within=["grp"], total="n")
    leaves = scratch.write(placed.withColumn("block", F.floor((F.col("pos") - 1) / fanout**k)), "leaves")

    by_block = leaves.groupBy("grp", "block")
    block_type = T.StructType([leaves.schema["grp"], leaves.schema["block"], leaves.schema["n"], T.StructField("node_digest", T.StringType())])
    blocks = scratch.write(by_block.applyInArrow(_root_of_block(fanout, k), block_type), "blocks")
    members = _exchange(blocks, fanout, k)
    upper = scratch.write(members.select("grp", "block", "subroot", F.col("node_digest").alias("root"), "proof"), "upper")

    out_type = T.StructType([
        T.StructField("id", leaves.schema["id"].dataType), T.StructField("grp", leaves.schema["grp"].dataType),
        *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root")],
        T.StructField("proof", PROOF), *[leaves.schema[c] for c in carried],
    ])
    found = by_block.cogroup(upper.groupBy("grp", "block")).applyInArrow(_proofs_of_block(fanout, k, carried), out_type)
    names = dict(zip(carried, carry))
    return found.select(
        F.col("id").alias(id_col), F.col("grp").alias(group_col), "leaf", "subroot", "root", "proof",
        *[F.col(c).alias(names[c]) for c in carried],
    )


def _exchange(blocks: DataFrame, fanout: int, k: int) -> DataFrame:
    """All rounds, within the groups and then across them. What comes to the
    driver is two numbers: the groups and the most leaves of one."""
    per_block = fanout**k
    groups = blocks.groupBy("grp").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("blocks"))
    groups = with_global_rank(groups, [F.col("grp").asc_nulls_first()], alias="g").withColumn("g", F.col("g") - 1)
    n_groups, most = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("blocks"), F.lit(0))).first()
    across = _height(n_groups, fanout)
    known = groups.select(F.col("grp").alias("_grp"), "g", F.col("blocks").alias("_blocks"))
    if across:
        known = known.join(_group_widths(groups, fanout, across), "g")
    members = blocks.join(known, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp").withColumns({
        "node": F.col("block"), "size": F.lit(1).cast("long"), "place": F.lit(0).cast("long"),
        "proof": F.array().cast(PROOF),
    })
    for r in range(_height(most, fanout)):
        full = fanout**r
        nodes = F.ceil(F.col("_blocks") / full)
        first = F.floor(F.col("node") / fanout) * fanout  # the first node of a run of two or more is full
        width = F.when(first + 1 < nodes, F.lit(full).cast("long")).otherwise(F.col("size"))
        members = _swap(members, ["g"], fanout, width, nodes > 1)
    members = members.withColumns({"subroot": F.col("node_digest"), "node": F.col("g")})
    for s in itertools.count():
        if s >= across:
            return members
        members = _swap(members, [], fanout, F.get("widths", F.lit(s)), F.lit(True))
