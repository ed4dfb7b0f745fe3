"""Connected components of a graph too large for one task or the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): component is the smallest node that can be reached.

    Alternates the large-star and small-star rewrites until no edge changes. Each is a minimum per node (summed before
    the shuffle) joined back to the edges, so a hub's edges never meet in one task. Every round is a written table.
    Self-loops and repeated edges are allowed; nulls are dropped. An empty graph gives no rows.
    """
    # every edge points from the larger node to the smaller
    stars = materialize(_oriented(edges.select(F.col("a"), F.col("b")).dropna()))
    before = _state(stars)
    for _ in range(max_rounds):
        for step in (_large_star, _small_star):
            lowest = _lowest(stars)
            after = materialize(step(stars, lowest))
            discard(stars, lowest)
            stars = after
        now = _state(stars)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _lowest(stars: DataFrame) -> DataFrame:
    """The smallest neighbour of each node that has a smaller one. Written, so that the joins with it shuffle both sides and AQE may split hubs."""
    return materialize(stars.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))


def _large_star(stars: DataFrame, lowest: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    # a node without a smaller neighbour is its own minimum
    moved = stars.join(lowest, stars.b == lowest.u, "left").select(F.col("a"), F.coalesce("m", "b").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(stars: DataFrame, lowest: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    joined = stars.join(lowest, stars.a == lowest.u).select("a", "b", "m")
    return _oriented(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))))
