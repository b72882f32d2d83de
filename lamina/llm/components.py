"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.store import saved


def _linked_to_smallest(edges: DataFrame, both: bool, larger_only: bool) -> DataFrame:
    """Each node's neighbours (its larger ones, or its smaller ones) are linked to the smallest of all.

    Only minima are aggregated and joined back, so no node's neighbours are ever gathered.
    """
    there = edges.select(F.col("a").alias("n"), F.col("b").alias("m"))
    pairs = there.unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("m"))) if both else there
    least = pairs.groupBy("n").agg(F.least(F.min("m"), F.first("n")).alias("low"))
    joined = pairs.join(least, "n")
    if larger_only:
        joined = joined.where("m > n")
    linked = joined.select(F.col("m").alias("x"), F.col("low").alias("y"))
    if not larger_only:
        linked = linked.unionByName(least.select(F.col("n").alias("x"), F.col("low").alias("y")))
    return linked.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (smallest node reachable) for every node of `a`-`b` edges.

    Nulls and loops are left out. Each round is written to the shared folder; it
    ends when a round changes no edge, after a number of rounds logarithmic in
    the longest path. The driver sees one count and one sum a round.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = _state(edges)
    while True:
        large = _linked_to_smallest(edges, both=True, larger_only=True)
        small = _linked_to_smallest(
            large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
            both=False, larger_only=False)
        edges = saved(small)
        state = _state(edges)
        if state == seen or not state[0]:
            break
        seen = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots)
