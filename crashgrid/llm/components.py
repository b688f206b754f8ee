"""Connected components by alternating large-star and small-star steps.

Only grouped minima and equi-joins: a node's neighbours are never gathered, so
a hub with a third of all links costs one partial aggregate and a join whose
hot key the skew split may divide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 40) -> DataFrame:
    """``edges`` (a, b) longs -> one row (node, root) per node that is not its
    own root; root is the smallest node reachable. No edge: no row. Loops,
    repeated and reversed edges change nothing; edges with a null are ignored.
    """
    links = scratch.write(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links0"
    )
    seen = _mark(links)
    for i in range(1, max_rounds + 1):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large, f"large{i}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        links = scratch.write(small, f"links{i}")
        scratch.drop(f"large{i}")
        scratch.drop(f"links{i - 1}")
        now = _mark(links)
        if now == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
