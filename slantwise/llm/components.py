"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slantwise.session import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    flipped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").unionByName(flipped)


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every linked node; the root is the least node reachable.

    ``links`` has columns ``a`` and ``b`` of one ordered type. Large-star and
    small-star steps alternate: every node hands its larger, then its smaller,
    neighbours to the least node it knows, until only stars around the roots are
    left. A node with very many links is folded to one minimum per task before the
    shuffle. Rounds grow with the logarithm of the longest path and go on until one
    changes nothing; each is stored in the shared folder. Self-links and links with a
    null end are ignored.
    """
    now = materialize(links.where(F.col("a") != F.col("b")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        pairs = _both_ways(now)
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = pairs.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        others = low.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(least.select("a", F.col("m").alias("b")).unionByName(others).where(F.col("a") != F.col("b")).distinct(), "links")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
