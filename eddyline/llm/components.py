"""Connected components of a link table, for links beyond any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import written


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Every node hands its neighbours to the smallest one it knows (itself included)."""
    if larger_only:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    smallest = pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("m"))
    # A node with very many neighbours meets its one row here; adaptive execution splits it.
    met = pairs.join(smallest, "u")
    if larger_only:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links(a, b)`` the smallest node reachable.

    Alternating large and small stars, until a round changes nothing; the number of
    rounds grows with the logarithm of the longest chain. Each round is written to the
    shared folder, so a lost executor repeats one round at most.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    seal = None
    while True:
        edges = written(_stars(_stars(edges, False), True), "stars")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == seal:
            break
        seal = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
