"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import write_and_read


def _settled(pairs: DataFrame) -> bool:
    """Whether the pairs are stars: a node points at one root, and no root points on."""
    ends = (pairs.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
            .union(pairs.select("v", F.lit(0), F.lit(1))))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return nodes.agg(F.count(F.when(F.col("out") + F.col("in") > 1, 1))).first()[0] == 0


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component
    is its smallest node. Null ends and self loops are dropped, repeated edges
    count once, no edges give no rows.

    A large-star round points each larger neighbour of u at the smallest one; a
    small-star round does it for u and its smaller neighbours; the pairs become a
    forest of stars after O(log^2) rounds. Minima are aggregated before the
    shuffle; a hot node's pairs meet its one minimum in a join that adaptive
    execution can split. Each round is written below spark.checkpoint.dir.
    """
    pairs = (edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    pairs = write_and_read(pairs, "components")
    for _ in range(max_rounds):
        if _settled(pairs):
            break
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # as many rows as pairs, repeated ones among them
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        pairs = write_and_read(small, "components")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return (pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))


def merged(label: DataFrame, edges: DataFrame) -> DataFrame:
    """``label`` (node, component) after further edges (a, b): components of the
    components that these connect, so that earlier edges aren't gone through again."""
    one, two = (label.select(F.col("node").alias(c), F.col("component").alias(f"l{c}")) for c in "ab")
    between = write_and_read(
        edges.join(one, "a", "left").join(two, "b", "left")
        .select("a", "b", "la", "lb"), "between")
    moved = components(between.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    new = (between.filter("la IS NULL").select(F.col("a").alias("node"))
           .union(between.filter("lb IS NULL").select("b")).distinct())
    nodes = label.select("node", "component").union(new.select("node", F.col("node").alias("component")))
    moved = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return (nodes.join(moved, "component", "left")
            .select("node", F.coalesce("to", "component").alias("component")))
