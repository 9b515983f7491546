"""Filters from configurations: lists of values to keep or to leave out, by column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import has_columns, named


def predicate(include: dict[str, list] | None, exclude: dict[str, list] | None) -> Column:
    """All of the includes and none of the excludes; a null is in no list and is left out by either."""
    parts = [F.col(k).isin(*v) for k, v in (include or {}).items()]
    parts += [~F.col(k).isin(*v) & F.col(k).isNotNull() for k, v in (exclude or {}).items()]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def rows(df: DataFrame, config: dict) -> DataFrame:
    """Rows that the configuration's obs and obs_r keep."""
    named(config)
    has_columns(df, [*config.get("obs", {}), *config.get("obs_r", {})])
    return df.filter(predicate(config.get("obs"), config.get("obs_r")))


def columns(x: DataFrame, config: dict) -> DataFrame:
    """Matrix entries that the configuration's var and var_r keep."""
    named(config)
    has_columns(x, [*config.get("var", {}), *config.get("var_r", {})])
    return x.filter(predicate(config.get("var"), config.get("var_r")))


def side_table(counts: DataFrame, kept: DataFrame, sample: str, keys: list[str]) -> DataFrame:
    """Category counts whose sample or group survives. ``keys``: columns of ``kept`` whose values name count columns."""
    alive = reduce(DataFrame.unionByName, (kept.select(F.col(k).alias(sample)) for k in keys)).distinct()
    return counts.join(alive, sample, "left_semi")


def entries(x: DataFrame, coverage: list[str] | None = None, gaps: bool = True, group: str | None = None) -> DataFrame:
    """Entries of the wanted coverage types, without gap positions, with a known group."""
    out = x.filter(F.col("coverage").isin(*coverage)) if coverage else x
    out = out if gaps else out.filter(~F.col("gap"))
    return out.filter(F.col(group).isNotNull()) if group else out


def enough(df: DataFrame, keys: list[str], value: str, least: float) -> DataFrame:
    """Rows of keys whose mean ``value`` is at least ``least``."""
    good = df.groupBy(*keys).agg(F.avg(value).alias("level")).filter(F.col("level") >= least)
    return df.join(good, keys, "left_semi")
