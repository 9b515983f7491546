"""Differential abundance: fold changes and t-tests for every pair of groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import above, log2_ratio, minus_log10, nonzero, with_t_test
from .ranking import numbered


def group_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, sample deviation and count of ``value`` by ``keys``, rows with a null key left out."""
    known = df.dropna(subset=keys)
    return known.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n"))


def pairs_of(groups: Column) -> Column:
    """All pairs (x, y) with x.g < y.g of an array of structs; a feature has few groups, so this stays in the row."""
    return F.flatten(F.transform(groups, lambda x: F.transform(F.filter(groups, lambda y: y["g"] > x["g"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))


def tested(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., g1, g2, log2fc, pval) of rows with a ``pair``."""
    parts = {f"{n}{i}": F.col(f"pair.{side}.{f}") for i, side in ((1, "x"), (2, "y")) for n, f in (("g", "g"), ("m", "mean"), ("s", "sd"), ("n", "n"))}
    flat = pairs.select(*keep, *(v.alias(k) for k, v in parts.items()))
    flat = flat.withColumn("log2fc", log2_ratio(F.col("m1"), F.col("m2"))).withColumns({"m1": nonzero(F.col("m1")), "m2": nonzero(F.col("m2"))})
    return with_t_test(flat, *(F.col(x) for x in ("m1", "s1", "n1", "m2", "s2", "n2"))).select(*keep, "g1", "g2", "log2fc", "pval")


def log2fc(df: DataFrame, feature: str, group: str, value: str, cutoff: float = 80, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., feature, g1, g2, log2fc, pval) for every pair of groups g1 < g2.

    A feature takes part if the mean of its group means is at least ``cutoff`` (to nine digits) and it has mean, deviation and count in every
    group that has a feature with a value (within ``by``).
    """
    return log2fc_cutoffs(df, feature, group, value, [cutoff], by).drop("cutoff")


def log2fc_cutoffs(df: DataFrame, feature: str, group: str, value: str, cutoffs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """``log2fc`` for several cutoffs in one job: statistics and tests are made once, then each cutoff keeps its rows."""
    stats = group_stats(df, [*by, feature, group], value)
    one = F.struct(F.col(group).alias("g"), "mean", "sd", "n")
    wide = stats.groupBy(*by, feature).agg(F.avg("mean").alias("level"), F.collect_list(F.when(F.col("sd").isNotNull(), one)).alias("groups"))
    number = stats.filter("n > 0").groupBy(*by).agg(F.count_distinct(group).alias("n_groups"))
    wide = wide.join(number, list(by)) if by else wide.crossJoin(number)  # one row
    full = wide.filter((F.size("groups") == F.col("n_groups")) & ~above(F.lit(min(cutoffs)), F.col("level")))
    pairs = full.select(*by, F.col(feature).alias("feature"), "level", F.explode(pairs_of(F.col("groups"))).alias("pair"))
    out = tested(pairs, [*by, "feature", "level"])
    limits = F.explode(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: ~above(c, F.col("level")))).alias("cutoff")
    return out.select(*by, limits, "feature", "g1", "g2", "log2fc", "pval")


def log2fc_compare(df: DataFrame, entity: str, first: str, second: str, value: str) -> DataFrame:
    """(entity, cgrp1, g1, g2, log2fc, pval): pairs of ``second`` within each ``first``, for those values of ``second`` that all of ``first`` have."""
    known = df.dropna(subset=[entity, first, second])
    has = known.select(first, second).distinct()
    every = has.agg(F.count_distinct(first).alias("n_first"))
    common = has.groupBy(second).agg(F.count("*").alias("n")).crossJoin(every).filter("n = n_first").select(second)
    cells = has.join(common, second, "left_semi").agg(F.count("*").alias("n_cells"))
    stats = group_stats(known, [entity, first, second], value).join(common, second, "left_semi").filter("sd is not null")
    whole = stats.withColumn("cells", F.count("*").over(W.partitionBy(entity))).crossJoin(cells).filter("cells = n_cells")
    one = F.struct(F.col(second).alias("g"), "mean", "sd", "n")
    wide = whole.groupBy(entity, first).agg(F.collect_list(one).alias("groups"))
    pairs = wide.select(F.col(entity).alias("entity"), F.col(first).alias("cgrp1"), F.explode(pairs_of(F.col("groups"))).alias("pair"))
    return tested(pairs, ["entity", "cgrp1"])


def with_large(compared: DataFrame, least: float = 1) -> DataFrame:
    """``compared`` with is_large: whether the fold change is shown, being at least ``least`` either way."""
    return compared.withColumn("is_large", F.coalesce(F.abs("log2fc") >= least, F.lit(False)))


def entity_order(compared: DataFrame) -> DataFrame:
    """Entities by mean absolute log2 fold change, with their place from 0."""
    means = compared.groupBy("entity").agg(F.avg(F.abs("log2fc")).alias("mean_abs"))
    return numbered(means, ["mean_abs", "entity"]).withColumn("place", F.col("place").cast("int"))


def ends(df: DataFrame, keys: tuple[str, ...], value: str, tie: str, bound: int) -> DataFrame:
    """Each task's rows that may be among the ``bound`` largest or smallest of their keys, ties by ``tie``: 2 x ``bound`` a task and key.

    A null is the smallest value and NaN the largest, as in sorting.
    """

    def cut(table: pa.Table) -> pa.Table:
        values = table[value].combine_chunks()
        level = np.unique(values.to_numpy(zero_copy_only=False), return_inverse=True)[1] + 1  # NaN is the last
        level[values.is_null().to_numpy(zero_copy_only=False)] = 0
        name = pc.rank(table[tie].combine_chunks(), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        key = np.zeros(len(level), np.int64)
        for k in keys:
            code = table[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
            key = np.unique(np.array([key, code]), axis=1, return_inverse=True)[1].ravel()
        keep = np.zeros(len(level), bool)
        for order in (np.lexsort((name, -level, key)), np.lexsort((name, level, key))):
            start = np.searchsorted(key[order], key[order])
            keep[order] |= np.arange(len(order)) - start < bound
        return table.filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if len(held) > 16:
                held = cut(pa.Table.from_batches(held)).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield from cut(pa.Table.from_batches(held)).to_batches()

    return df.mapInArrow(run, df.schema)


def heatmap(diff: DataFrame, bound: int = 25, keys: tuple[str, ...] = ("g1", "g2")) -> DataFrame:
    """The ``bound`` largest and smallest fold changes of each pair, each row once, with -log10 p. Only each task's ends are shuffled."""
    diff = ends(diff, keys, "log2fc", "feature", bound)
    up = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("log2fc"), "feature"))
    down = F.row_number().over(W.partitionBy(*keys).orderBy("log2fc", "feature"))
    out = diff.withColumn("up", up).withColumn("down", down).filter((F.col("up") <= bound) | (F.col("down") <= bound))
    return out.drop("up", "down").withColumn("log10p", minus_log10(F.col("pval")))


def volcano(diff: DataFrame, fold: float = 1.5) -> DataFrame:
    """Fold change, -log10 p and flags: beyond the fold lines, and above -log10 p of 1.3 and of 3."""
    out = diff.withColumn("log10p", minus_log10(F.col("pval")))
    return out.withColumns({
        "is_up": F.col("log2fc") >= fold, "is_down": F.col("log2fc") <= -fold,
        "sig_05": F.coalesce(F.col("log10p") >= 1.3, F.lit(False)), "sig_001": F.coalesce(F.col("log10p") >= 3, F.lit(False)),
    })
