"""Connected components of an edge table, by alternating stars.

Each round runs a large star (every neighbour above a node is linked to the
smallest neighbour) and a small star (every neighbour below it likewise)
until the edges stand still; rounds grow with the logarithm of a component's
size, not with its diameter. A node's neighbours are never gathered: the
minimum is a grouped aggregate with map-side combine, joined back to the
edges from a written table, so that a hub's edges can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import materialize


def _linked_to_least(edges: DataFrame, reflexive: bool) -> DataFrame:
    """For edges u -> v: (v, least) where least is the smallest of u's
    neighbours (and u itself if ``reflexive``), as (high, low) pairs."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("least")), "cc-least")
    if reflexive:
        least = least.withColumn("least", F.least("u", "least"))
    pairs = edges.join(least, "u")
    moved = pairs.where(F.col("v") > F.col("u")) if reflexive else pairs
    out = moved.select(F.col("v").alias("high"), F.col("least").alias("low"))
    if not reflexive:
        out = out.unionByName(least.select(F.col("u").alias("high"), F.col("least").alias("low")))
    return materialize(out.where("high <> low").distinct(), "cc-edges")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low")),
                           F.bit_xor(F.xxhash64("low", "high"))).first())


def least_members(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node of its component for every node that
    has an edge and is not itself the smallest. Loops and repeats are fine."""
    now = materialize(edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
                      .where("high <> low").distinct(), "cc-edges")
    state = _state(now)
    while state[0]:
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            now.select(F.col("low").alias("u"), F.col("high").alias("v")))
        now = _linked_to_least(both, reflexive=True)
        now = _linked_to_least(now.select(F.col("high").alias("u"), F.col("low").alias("v")), reflexive=False)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("high").alias("node"), F.col("low").alias("root"))
