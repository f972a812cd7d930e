"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _facts(edges: DataFrame) -> tuple:
    """Number and digest sum of the edges: equal sets of edges have equal ones."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of the component, for each node of edges (a, b), both long.

    Each round points a node's larger, then its smaller neighbours at the least of them; the edges end as stars, and
    rounds go on until they do. Their number grows with the logarithm of the longest path. Edges are written once a
    round, so lineage stays short, and those of the round before are deleted.
    """
    pairs = lambda df, u, v: df.select(F.col(u).alias("u"), F.col(v).alias("v"))
    now = written(edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(), "edges")
    facts = _facts(now)
    while True:
        # Large star: over all neighbours, those above a node go to the least of the node and its neighbours.
        both = pairs(now, "u", "v").unionByName(pairs(now, "v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours go to the least of these.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        after = written(large.join(small, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "edges")
        # Done when every node has one edge and no root is a leaf, which is when nothing has changed.
        before, facts = facts, _facts(after)
        done = before == facts and now.join(after, ["u", "v"], "left_anti").isEmpty()
        forget(now)
        now = after
        if done:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
