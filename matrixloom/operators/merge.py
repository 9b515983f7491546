"""Merging of two datasets: counts by key, matrices and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import apart


def counts(a: DataFrame, b: DataFrame, key: str, sample: str, value: str, drop: bool = False) -> DataFrame:
    """Long counts of both. Keys that one side lacks count 0 in its samples; with ``drop`` only keys of both sides that have no null stay."""
    whole = a.unionByName(b)
    if drop:
        keys = a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")
        keys = keys.join(whole.filter(F.col(value).isNull()).select(key), key, "left_anti")
        return whole.join(keys, key, "left_semi")
    # A key's counts become one map; samples are few, so each row gets the list of them.
    samples = whole.agg(F.array_sort(F.collect_set(sample)).alias("samples_"))  # one row
    kept = F.collect_list(F.when(F.col(sample).isNotNull(), F.struct(F.col(sample).alias("s"), F.col(value).alias("v"))))
    by_key = whole.groupBy(key).agg(kept.alias("counts_")).crossJoin(F.broadcast(samples))
    own = F.flatten(F.transform("samples_", lambda s: F.coalesce(F.nullif(F.filter("counts_", lambda c: c["s"] == s), F.array().cast(by_key.schema["counts_"].dataType)), F.array(F.struct(s.alias("s"), F.lit(0.0).alias("v"))))))
    rows = by_key.select(key, F.explode(own).alias("c"))
    return rows.select(key, F.col("c.s").alias(sample), F.coalesce("c.v", F.lit(0.0)).alias(value)).select(*a.columns)


def schema_report(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """Columns of both, in a's order, and columns of one side only."""
    common = [c for c in a.columns if c in b.columns]
    return common, sorted({*a.columns} ^ {*b.columns})


def rows(a: DataFrame, b: DataFrame, ids: list[str], check: bool = True) -> DataFrame:
    """Rows of both, over the columns of both; rows with the same ids fail the job."""
    if check:
        a = apart(a, b, ids)
    common, _ = schema_report(a, b)
    return a.select(*common).unionByName(b.select(*common))


def matrices(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Matrix entries of both at the positions that both have."""
    both = a.select(*keys).distinct().join(b.select(*keys).distinct(), keys, "left_semi")
    common, _ = schema_report(a, b)
    return a.select(*common).unionByName(b.select(*common)).join(both, keys, "left_semi")
