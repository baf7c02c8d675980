"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborstar.llm._store import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node of its component.

    Every round reduces by key with map-side combination and joins the minimum back, so a node with
    very many neighbours is one row per task in the reduction, and AQE may split it in the join. Each
    round is written to the shared folder; the driver only compares a count and a checksum.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "small-star")
        before, state = state, _state(edges)
        if state == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
