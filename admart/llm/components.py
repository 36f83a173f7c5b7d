"""Connected components of an edge table by alternating star contraction, in DataFrame joins.

Every round hooks each node's larger neighbours to its smallest neighbour (large star), then its smaller
ones (small star), until the edges stand still; each node then points at its component's smallest node.
Neighbour minima are aggregates with map-side combine, so a hub is no hot group, and the join that hands
them back is a plain equi-join, whose large partitions Spark can split. Rounds are tables in the shared
folder; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step; edges have a > b."""
    both = edges.select("a", "b")
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return made.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; long, not null) other than the roots."""
    now = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        now = materialize(_star(_star(now, large=True), large=False), "edges")
    raise RuntimeError(f"components still change after {max_rounds} rounds")
