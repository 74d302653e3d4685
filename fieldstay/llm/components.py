"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.storage import materialise, release


def _stored(least: DataFrame) -> DataFrame:
    """One row a node, written first: the join's sides are then plain exchanges, and a node with a third of all edges
    can be divided."""
    return materialise(least, "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
    return (
        both.join(least, F.col("a") == F.col("n")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them; in every edge a > b."""
    least = _stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m"))
    below = edges.join(least, F.col("a") == F.col("n")).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    low = F.col("a").bitwiseXOR(F.shiftleft("b", 1))
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(low)).first())


def stars(edges: DataFrame) -> DataFrame:
    """``(a, b)``: each node that has a link and is not the smallest of its component, with that smallest node.

    ``edges`` has two long columns ``a > b``. A round is one job over the edges; the number of rounds grows with the
    logarithm of the longest chain. Only a count and two checksums reach the driver. No edges give no rows.
    """
    now = materialise(edges.distinct(), "edges")
    seen = _signature(now)
    while seen[0]:
        large = materialise(_large_star(now), "edges")
        release(now)
        after = materialise(_small_star(large), "edges")
        release(large)
        now, before, seen = after, seen, _signature(after)
        if seen == before:
            break
    return now
