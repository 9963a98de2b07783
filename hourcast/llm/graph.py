"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.text import stored


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of an edge a - b.

    Alternates large-star and small-star steps: each step hangs neighbours on their
    smallest one, so a node never gathers its neighbours, only their minimum. Steps
    are written to the shared folder; their number grows with the logarithm of the
    longest path.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        "edges",
    )
    before = None
    while (state := _fingerprint(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = stored(small, "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
