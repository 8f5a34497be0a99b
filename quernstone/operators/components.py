"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round of star contraction over (u, v): each node's neighbours are linked to the least of them.

    Neighbour lists stay rows, so a node with very many links is never held by one task.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = near.join(low, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of an edge, component being the least node of it.

    Alternating large-star and small-star rounds; the edges and each round are written tables, so edges are computed once and lost executors cost no
    restart. A node with very many links is a skewed key of a sort-merge join, which adaptive execution splits.
    Edges with a null end are ignored, loops make a component of their own; an empty table gives an empty result.
    """
    pairs = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null").distinct(), "edges")
    nodes = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).distinct()
    now = pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    mark = None
    for _ in range(most_rounds):
        now = materialize(_stars(_stars(now, True), False), "edges")
        new = tuple(now.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return nodes.join(now, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))
