"""Exact quantiles by distributed selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import stored

#: Distinct values that a key, or a range of a key, is sorted with at once; bins of a range that has more.
LIMIT, BINS = 1 << 17, 1 << 12


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, v_, n_): how often each key has each value, in the shared folder; rows with a null key are left out."""
    counts = df.dropna(subset=keys).groupBy(*keys, F.col(value).cast("double").alias("v_")).agg(F.count("*").alias("n_"))
    return stored(counts, "value-counts")


def quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float], name: str = "q", limit: int = LIMIT, bins: int = BINS) -> DataFrame:
    """(keys, ``name``: array): the exact quantiles of each key's values, in the order asked for, interpolated between neighbours.

    Values are counted first. A key of more than ``limit`` distinct values is cut into ``bins`` equal ranges, and only those that hold a
    wanted rank go on, until none has more: so no task sorts more than that many values, and none is held in a buffer. Nulls do not count, NaN
    is the largest value, a key without values has nulls; rows with a null key are left out.
    """
    return quantiles_of(value_counts(df, keys, value), keys, probabilities, name, limit, bins)


def quantiles_of(counts: DataFrame, keys: list[str], probabilities: list[float], name: str = "q", limit: int = LIMIT, bins: int = BINS) -> DataFrame:
    """``quantiles`` of ``value_counts``."""
    known = counts.filter("v_ is not null")
    near = [rank(p * (F.col("total_") - 1)).cast("long") for p in probabilities for rank in (F.floor, F.ceil)]
    ranks = F.array_sort(F.array_distinct(F.array(*near)))
    every, most = known.groupBy(*keys).agg(F.count("*").alias("d")).agg(F.sum("d"), F.max("d")).first()
    if (most or 0) <= limit:
        whole = known.withColumn("total_", F.sum("n_").over(W.partitionBy(*keys))).withColumn("below_", F.lit(0).cast("long"))
        found = at_ranks(whole.withColumn("ranks_", ranks).withColumn("lo_", F.lit(0.0)), keys)
    else:
        whole = known.groupBy(*keys).agg(F.sum("n_").alias("total_"), F.count("*").alias("distinct_"), F.min("v_").alias("lo_"), F.max("v_").alias("hi_"))
        ranges = whole.withColumn("ranks_", ranks).withColumn("below_", F.lit(0).cast("long"))
        # Keys of over a hundredth of all values: a hundred at most.
        ranges = ranges.withColumn("hot_", F.col("distinct_") > max(limit, every / 100))
        while most > limit:
            ranges = stored(narrowed(known, ranges, keys, limit, bins), "ranges")
            most = ranges.agg(F.max("distinct_")).first()[0]
        found = at_ranks(within(known, ranges, keys), keys)
    at = F.map_from_entries(F.collect_set(F.struct("rank_", "v_")))
    rows = found.groupBy(*keys).agg(at.alias("at_"), F.first("total_").alias("total_"))

    def interpolated(p: float) -> Column:
        place = p * (F.col("total_") - 1)
        low, high = F.floor(place), F.ceil(place)
        a, b = F.element_at("at_", low), F.element_at("at_", high)
        return F.when(low == high, a).otherwise((high - place) * a + (place - low) * b)

    out = rows.select(*keys, F.array(*map(interpolated, probabilities)).alias(name))
    empty = counts.groupBy(*keys).agg(F.count("v_").alias("any_")).filter("any_ = 0").select(*keys, F.array(*(F.lit(None).cast("double") for _ in probabilities)).alias(name))
    return out.unionByName(empty)


def within(known: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Values with the range of their key that they are in. Hot keys' ranges, a hundred keys at most, are broadcast."""
    inside = "v_ >= lo_ and v_ <= hi_"
    ranges = ranges.drop("distinct_")
    few = F.broadcast(ranges.filter("hot_"))
    plain = known.join(F.broadcast(ranges.filter("hot_").select(*keys).distinct()), keys, "left_anti").join(ranges.filter("not hot_"), keys)
    return plain.filter(inside).unionByName(known.join(few, keys).filter(inside))


def narrowed(known: DataFrame, ranges: DataFrame, keys: list[str], limit: int, bins: int) -> DataFrame:
    """``ranges`` with those of more than ``limit`` distinct values cut to the bins that hold their ranks."""
    wide = ranges.filter(F.col("distinct_") > limit)
    rows = within(known, wide, keys)
    # Differences of halves don't overflow; the least value has bin 0 and the largest, with NaN and infinities, one of the last two.
    share = F.coalesce(F.try_divide(F.col("v_") / 2 - F.col("lo_") / 2, F.col("hi_") / 2 - F.col("lo_") / 2), F.lit(0.0))
    place = F.when(F.col("v_") == F.col("lo_"), -1).when(F.isnan("v_"), bins + 1).when(F.col("v_") == F.col("hi_"), bins).when(F.isnan(share), F.when(F.col("v_") < 0, 0).otherwise(bins - 1)).otherwise(F.least(F.lit(bins - 1), F.floor(share * bins)))
    cells = rows.withColumn("bin_", place.cast("long")).groupBy(*keys, "lo_", "hi_", "below_", "total_", "ranks_", "hot_", "bin_").agg(F.sum("n_").alias("n_"), F.count("*").alias("distinct_"), F.min("v_").alias("least_"), F.max("v_").alias("most_"))
    before = F.coalesce(F.sum("n_").over(W.partitionBy(*keys, "lo_", "below_").orderBy("bin_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumn("below_", F.col("below_") + before)
    cells = cells.withColumn("ranks_", F.filter("ranks_", lambda r: (r >= F.col("below_")) & (r < F.col("below_") + F.col("n_")))).filter(F.size("ranks_") > 0)
    cut = cells.select(*keys, "total_", "distinct_", F.col("least_").alias("lo_"), F.col("most_").alias("hi_"), "ranks_", "below_", "hot_")
    return ranges.filter(F.col("distinct_") <= limit).unionByName(cut)


def at_ranks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, total_, rank_, v_): the value at each wanted rank, of values with their ranges."""
    before = F.coalesce(F.sum("n_").over(W.partitionBy(*keys, "lo_", "below_").orderBy("v_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("at_", F.col("below_") + before)
    hit = F.filter("ranks_", lambda r: (r >= F.col("at_")) & (r < F.col("at_") + F.col("n_")))
    return rows.select(*keys, "total_", F.explode(hit).alias("rank_"), "v_")
