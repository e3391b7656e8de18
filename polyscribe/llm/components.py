"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a minimum a node with map-side combine and a join back, so a hub's edges are spread like
any other rows; every step's result is written to the shared folder. The number of steps grows with the
logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscribe.llm.common import discard, materialise


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(node, component): for every node of an edge between different nodes, the smallest node it reaches."""

    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(low, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        stars = joined.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return stars.unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    def signature(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = materialise(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    seen = signature(now)
    if not seen[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(most):
        after = materialise(small(large(now)), "edges")
        discard(now)
        now, before = after, seen
        seen = signature(now)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
