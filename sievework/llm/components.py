"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """Per node of the edges (a, b): node and component, the smallest node that it is connected with.

    Alternating stars: each round ties the larger neighbours of a node to its smallest neighbour, then the smaller ones,
    until nothing changes; a component of n nodes needs about log(n) squared rounds at most, one star needs one. The
    edges never become more than twice the first ones. Every round is a stored table; only two numbers come to the driver.
    """
    spark = edges.sparkSession
    low, high = F.least("a", "b"), F.greatest("a", "b")
    current = stored(edges.filter("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    seen = _digest(current)
    if not seen[0]:
        return spark.createDataFrame([], "node long, component long")
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        others = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stored(others.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
