"""Connected components by alternating large-star and small-star rounds.

Edges are narrow (two ids).  A round is two grouped minima joined back to the
edges, so no neighbourhood is ever gathered in a task; hot centres are skewed
joins that the adaptive planner splits.  Each round is a written table in the
shared folder; the one before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (moved.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct())


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``links``: pairs of ids.  Returns (node, component) for every node that
    differs from its component's smallest id; no row means: its own component.
    NULL ends and self links are ignored, repeated links count once."""
    edges = materialize(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        after = materialize(_small_star(_large_star(edges)), "stars")
        drop_materialized(edges)
        before, edges, state = state, after, _state(after)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
