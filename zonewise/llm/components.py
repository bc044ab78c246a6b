"""Connected components of a graph that may be far larger than one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewise.session import checkpointed

#: Rows of a few numbers that a join sends to every task, some 120 bytes of the driver each; more are shuffled.
BROADCAST_ROWS = 100_000


def bounded(side: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """`side` of a join, of `rows` rows at most: it is sent to every task if these are few (`most`), and never
    otherwise. Spark would go by the size of files, which knows neither how they are packed nor what an explode makes
    of them."""
    return F.broadcast(side) if rows <= (BROADCAST_ROWS if most is None else most) else side.hint("merge")


def _lowest(edges: DataFrame, rows: int) -> DataFrame:
    """Each of at most `rows` edges with the smallest neighbour of its `u`, or `u` itself."""
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
    return edges.join(bounded(low, rows), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (u, v): the component is its smallest node.

    Alternating stars: every node tells its larger neighbours, then its smaller ones, of the smallest node it knows,
    until each component is a star around its smallest node. A round is two aggregates and joins over the
    edges, written to the shared folder; the number of rounds grows with the logarithm of the longest path.
    Self loops and repeated edges do no harm; an empty graph has no rows.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    edges = checkpointed(edges, "edges")
    mark = None
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if seen == mark or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        mark = seen
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rows = 2 * seen[0]
        large = _lowest(both, rows).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        small = _lowest(large, rows)
        edges = small.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v").union(
            small.select("u", F.col("low").alias("v"))).distinct()
        edges = checkpointed(edges, "edges")
