"""Distributed connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``id, root``: one root for each component of the undirected ``edges``.

    Each round maps every node to the neighbour (or itself) of the least hash
    and contracts the edges, so that the nodes left shrink by a factor; the
    maps are composed at the end.  All state is in tables: nothing but "is it
    empty" reaches the driver, a node's neighbours are only ever aggregated,
    and the joins with a node of many edges are plain equi-joins, which
    adaptive execution splits.  Self-loops and nulls are left out.
    """
    left = cut_lineage(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
                       .filter((F.col("u") != F.col("v"))).distinct(), "edges")
    rooted = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        best = both.groupBy("u").agg(F.min(rank("v")).alias("b"))
        step = cut_lineage(best.select("u", F.least(F.col("b"), rank("u"))["n"].alias("to")), "labels")
        rooted = step.select(F.col("u").alias("id"), F.col("to").alias("root")) if rooted is None else (
            rooted.join(step.select(F.col("u").alias("root"), "to"), "root", "left")
            .select("id", F.coalesce("to", "root").alias("root")))
        rooted = cut_lineage(rooted, "roots")
        left = cut_lineage(
            left.join(step, "u").select("v", F.col("to").alias("a"))
            .join(step.select(F.col("u").alias("v"), F.col("to").alias("b")), "v")
            .filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    return rooted if rooted is not None else left.select(F.col("u").alias("id"), F.col("v").alias("root"))
