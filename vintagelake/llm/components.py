"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import drop_stage, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction over edges (a, b) with a < b.

    Large star: every node links its larger neighbours to the smallest of its
    neighbourhood.  Small star: every node links its smaller neighbours, and
    itself, to the smallest of them.  Only minima are aggregated; no node's
    neighbourhood is ever gathered in a row.
    """
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    joined = around.join(least, around["u"] == least["c"])
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            least.select(F.col("m").alias("a"), F.col("c").alias("b")))
    return out.where(F.col("a") < F.col("b")).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the
    smallest node of the component.  Nodes that are their own root are left out.

    Every round is written to the shared checkpoint folder; the loop ends when
    a round changes nothing, which two sums per round tell.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current = stage(ordered.where("a < b").distinct(), "links")
    last = None
    for _ in range(most_rounds):
        following = stage(_star(_star(current, large=True), large=False), "links")
        drop_stage(current)
        # a forest of stars is a fixed point: as many edges as nodes below a root, and the same edges
        mark = following.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        current = following
        if mark == last:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        last = mark
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
