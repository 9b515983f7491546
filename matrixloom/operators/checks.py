"""Checks that raise or report. Those on names run no job, those on rows stop at the first offender.

``one_a_key``, ``no_doubles`` and ``apart`` are parts of a plan: they run with it, and fail its job.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Metadata names that the build makes itself: fixed values.
RESERVED = ["trna", "iso", "amino", "deseq2_sizefactor", "refseq", "dataset", "pseudogene"]


class CheckError(ValueError):
    """A check has failed."""


def metadata_names(names: list[str], width: int | None = None) -> list[str]:
    """Checked names of metadata columns; ``width``, the number of columns in the rows, pads with obs_i or cuts."""
    if taken := [n for n in names if n in RESERVED]:
        raise CheckError(f"reserved metadata columns: {taken}")
    if len(set(names)) != len(names):
        raise CheckError(f"duplicate metadata columns: {sorted({n for n in names if names.count(n) > 1})}")
    if names[:2] != ["sample", "group"]:
        raise CheckError("the first metadata columns must be sample and group")
    if width is not None and width != len(names):
        warnings.warn(f"metadata has {len(names)} names for {width} columns", stacklevel=2)
        names = [*names, *(f"obs_{i}" for i in range(width - len(names)))][:width]
    return names


def run_info(info: dict[str, str]) -> None:
    """The run must have made fragments; its version should be known."""
    if "--nofrag" in info.get("command", ""):
        raise CheckError("the run was made with --nofrag")
    if info.get("git version", "Cannot find git version") == "Cannot find git version":
        warnings.warn("the run's version is unknown", stacklevel=2)


def has_columns(df: DataFrame, names: list[str]) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise CheckError(f"no such columns: {missing}")


def named(config: dict) -> dict:
    if not config.get("name"):
        raise CheckError("a configuration needs a name")
    return config


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def no_duplicates(df: DataFrame, keys: list[str]) -> None:
    if found := duplicates(df, keys).limit(1).collect():
        raise CheckError(f"duplicate key: {found[0].asDict()}")


def one_a_key(value: Column, keys: list[str]) -> Column:
    """An aggregate: the only value of a group; more than one row fails the job."""
    key = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), F.first(F.col(k).cast("string"))) for k in keys))
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("duplicate key: "), key))).otherwise(F.first(value))


def no_doubles(df: DataFrame, keys: list[str], item: str) -> DataFrame:
    """(keys): the distinct keys of ``df``; an ``item`` that a key has twice fails the job. A key's items are few."""
    sizes = df.groupBy(*keys).agg(F.count(item).alias("rows_"), F.size(F.collect_set(item)).alias("items_"))
    key = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys))
    return sizes.filter(F.when(F.col("rows_") > F.col("items_"), F.raise_error(F.concat(F.lit(f"duplicate {item}: "), key)).cast("boolean")).otherwise(True)).select(*keys)


def apart(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """``a``; keys that are in ``b`` too fail the job. Only keys are shuffled, and one row is joined to all."""
    shared = a.select(*keys).join(b.select(*keys), keys, "left_semi")
    key = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    found = shared.agg(F.min(key).alias("in_both"))  # one row
    return a.crossJoin(F.broadcast(found)).filter(F.when(F.col("in_both").isNotNull(), F.raise_error(F.concat(F.lit("in both: "), "in_both")).cast("boolean")).otherwise(True)).drop("in_both")


def key_mismatch(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with the side."""
    left, right = a.select(*keys).distinct(), b.select(*keys).distinct()
    return left.join(right, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, keys, "left_anti").withColumn("side", F.lit("right")))


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> None:
    if found := key_mismatch(a, b, keys).limit(1).collect():
        raise CheckError(f"keys do not match: {found[0].asDict()}")


def no_overlap(a: DataFrame, b: DataFrame, keys: list[str]) -> None:
    if found := a.select(*keys).join(b.select(*keys), keys, "left_semi").limit(1).collect():
        raise CheckError(f"in both: {found[0].asDict()}")


def dependent(df: DataFrame, key: str, label: str) -> None:
    """Each key must have one label."""
    if found := broken_dependencies(df, key, label).limit(1).collect():
        raise CheckError(f"more than one {label}: {found[0].asDict()}")


def broken_dependencies(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(label).alias("n_labels")).filter("n_labels > 1")


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls): one row for each column that has nulls."""
    wide = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return wide.unpivot([], columns, "column", "nulls").filter("nulls > 0")


def samples_with_nulls(df: DataFrame, columns: list[str], sample: str = "sample") -> DataFrame:
    """(sample, columns): the columns in which each sample has nulls."""
    lost = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)))
    return df.select(sample, F.explode(lost).alias("column")).groupBy(sample).agg(F.array_sort(F.collect_set("column")).alias("columns"))
