"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """Rows (u, v) with m, the least of u and all its v."""
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (u, v: long) but the roots; root is the least node reachable.

    Each round writes its edges to the shared folder, so a lost executor costs one round at most; the
    number of rounds grows with the logarithm of the longest chain. Only two numbers a round reach the driver.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        rows = _with_least(stored(large, "large"))
        small = rows.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(rows.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "small")
        mark = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
