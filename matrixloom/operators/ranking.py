"""Places of all rows in an order, without one task that sorts them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import stored


#: Rows that one task may sort.
FEW = 100_000


def numbered(df: DataFrame, order: list[str | Column], name: str = "place", start: int = 0, few: int = FEW) -> DataFrame:
    """``df`` with the place of every row in the order, from ``start``: above ``few`` rows from numbers within ranges of the keys, and the ranges' offsets."""
    df = stored(df, "unordered")
    if df.count() <= few:
        return df.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("long") + (start - 1))
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # A row's id is its range's number times 2**33 and its place in the range. Ranges come from a sample, so they are drawn once.
    dealt = stored(dealt.withColumn("id_", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumns({"range_": F.shiftright("id_", 33), "place_": F.col("id_").bitwiseAND((1 << 33) - 1)})
    counts = dealt.groupBy("range_").agg(F.count("*").alias("n_"))
    before = F.coalesce(F.sum("n_").over(W.orderBy("range_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row a range
    out = dealt.join(F.broadcast(counts.select("range_", before.alias("before_"))), "range_")
    return out.withColumn(name, F.col("before_") + F.col("place_") + start).drop("id_", "range_", "place_", "before_")
