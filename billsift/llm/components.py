"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billsift.llm.tables import kept, small


def _fingerprint(edges: DataFrame) -> tuple:
    """One row that differs between different sets of edges (count and two 64-bit sums)."""
    bits = F.lit(0xFFFFFFFF)
    low, high = F.xxhash64("a", "b").bitwiseAND(bits), F.shiftrightunsigned(F.xxhash64("b", "a"), 32)
    return tuple(edges.agg(F.count("*"), F.sum(low), F.sum(high)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, root`` for each end of an edge ``a, b`` (both long): the smallest id reachable.

    Each round connects every vertex's larger neighbours to its smallest neighbour,
    then its smaller neighbours likewise, which leaves a star per component after a
    number of rounds that grows with the logarithm of the graph. A round's edges are
    written to the shared folder; minima combine before they are shuffled, and up to a
    million of them are sent to the edges, so that the edges of a hub stay where they
    are; beyond that the join shuffles and AQE splits a hub. Nothing but a count and two
    checksums of a round's edges reaches the driver.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = kept(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    before = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
        wide = both.filter("b > a").join(small(least), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        wide = kept(wide.filter("a <> b").distinct(), "edges")
        least = wide.groupBy("a").agg(F.min("b").alias("least"))
        low = wide.join(least, "a")
        narrow = low.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        narrow = narrow.union(least.select("a", F.col("least").alias("b"))).distinct()
        narrow = kept(narrow, "edges")
        now = _fingerprint(narrow)
        if now == before:
            roots = narrow.select(F.col("a").alias("id"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("id"), "root").distinct())
        edges, before = narrow, now
