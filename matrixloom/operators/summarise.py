"""Group summaries, shares, profiles and intervals behind the bar, radar, count and coverage figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import dealt
from .quantiles import quantiles_of, value_counts
from .ranking import numbered

METHODS = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def statistics(known: DataFrame, keys: list[str], value: str, methods: list[str]) -> DataFrame:
    """(keys, methods...) of rows without null keys. With a median, which is selected (see ``quantiles``), all come from one table of values and their counts."""
    if "median" not in methods:
        return known.groupBy(*keys).agg(*(METHODS[m](value).cast("double").alias(m) for m in methods))
    counts = value_counts(known, keys, value)
    number = F.sum(F.when(F.col("v_").isNotNull(), F.col("n_")).otherwise(0))
    total = F.sum(F.col("v_") * F.col("n_"))
    made = {"mean": F.try_divide(total, number), "sum": total, "count": number.cast("double"), "max": F.max("v_"), "min": F.min("v_")}
    out = counts.groupBy(*keys).agg(F.count("*").alias("rows_"), *(made[m].alias(m) for m in methods if m != "median"))
    median = quantiles_of(counts, keys, [0.5]).select(*keys, F.col("q")[0].alias("median"))
    return out.join(median, keys, "left").select(*keys, *methods)


def share(value: str, *keys: str) -> Column:
    return F.try_divide(F.col(value), F.sum(value).over(W.partitionBy(*keys)))


def ordinals(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """(column, place): 0-based place of each value by name, or by the mean of column ``by``."""
    key = F.avg(F.expr(f"try_cast({by} as double)")) if by else F.lit(0.0)
    table = df.groupBy(column).agg(key.alias("key"))
    return numbered(table, ["key", column]).select(column, F.col("place").cast("int").alias("place"))


def bars(df: DataFrame, column: str, group: str, value: str, sort_by: str | None = None, excluded: tuple[str, ...] = (), amino: str = "amino") -> DataFrame:
    """Rows whose ``amino`` is in ``excluded`` left out: mean, median, max, sum and count per (column, group), missing combinations as 0, each also as share of its
    group, the column's place, and where its sum's share begins when the group's shares are stacked."""
    names = ["mean", "median", "max", "sum", "count"]
    known = df.dropna(subset=[column, group])
    known = known.filter(~F.coalesce(F.col(amino).isin(*excluded), F.lit(False))) if excluded else known
    stats = statistics(known, [column, group], value, names)
    every = stats.select(column).distinct().crossJoin(stats.select(group).distinct())
    full = every.join(stats, [column, group], "left").fillna(0.0, names)
    full = full.withColumns({f"{m}_share": F.coalesce(share(m, group), F.lit(0.0)) for m in names})
    full = full.join(ordinals(known, column, sort_by), column)
    before = W.partitionBy(group).orderBy("place", column).rowsBetween(W.unboundedPreceding, -1)
    return full.withColumn("stack_from", F.coalesce(F.sum("sum_share").over(before), F.lit(0.0)))


def bar_rows(table: DataFrame, column: str, group: str) -> DataFrame:
    """``bars`` with the row in which each bar is drawn, from 0: by place, then by group."""
    return numbered(table, ["place", column, group], "row")


def labels(df: DataFrame, key: str, label: str) -> DataFrame:
    """One label for each key: the least."""
    return df.groupBy(key).agg(F.min(label).alias(label))


def with_category(df: DataFrame, known: DataFrame, key: str, category: str) -> DataFrame:
    """``df`` with the category of each row's key, as a sample's group, from any table that has both; a key that has several gets the least, an unknown one null."""
    return dealt(df, labels(known.dropna(subset=[key]), key, category), [key])


def distinct_labels(df: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label): the keys' labels, with the key in brackets behind a label that several keys have."""
    named = labels(df, key, label)
    shared = named.groupBy(label).agg(F.count("*").alias("keys_")).filter("keys_ > 1")
    out = named.join(shared, label, "left")
    return out.select(key, F.when(F.col("keys_").isNotNull(), F.concat(F.col(label).cast("string"), F.lit(" ("), F.col(key).cast("string"), F.lit(")"))).otherwise(F.col(label).cast("string")).alias(label))


def radar(df: DataFrame, iso: str, group: str, value: str, methods: list[str] | None = None, entity: str | None = None, dropped: tuple[str, ...] = (), least_iso: int = 3, least_percent: float = 1) -> DataFrame:
    """(iso, group, method, value, percent): each group's share of an iso in percent of the iso's total over groups.

    Isos whose least percent is not above ``least_percent`` go. With ``entity``, only entities of at least ``least_iso`` isos
    stay; isos in ``dropped`` go after that count.
    """
    known = df.dropna(subset=[iso, group])
    keys = [iso, group] if entity is None else [entity, iso, group]
    if entity is not None:
        rich = known.groupBy(entity).agg(F.count_distinct(iso).alias("n")).filter(F.col("n") >= least_iso)
        known = known.join(rich, entity, "left_semi")
    if dropped:
        known = known.filter(~F.col(iso).isin(*dropped))
    methods = methods or ["mean", "median", "max", "sum"]
    stats = statistics(known, keys, value, methods)
    long = stats.unpivot(keys, methods, "method", "value")
    cell = [k for k in keys if k != group] + ["method"]
    long = long.withColumn("percent", 100 * F.col("value") / F.nullif(F.sum("value").over(W.partitionBy(*cell)), F.lit(0.0)))
    return long.withColumn("least", F.min("percent").over(W.partitionBy(*cell))).filter(F.col("least") > least_percent).drop("least")


def percentages(counts: DataFrame, key: str, sample: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Each count in percent of its sample, and where its bar begins if bars are stacked in reverse order of keys."""
    keys = [*by, sample]
    out = counts.withColumn("percent", 100 * F.try_divide(F.col(value), F.sum(value).over(W.partitionBy(*keys))))
    above = W.partitionBy(*keys).orderBy(F.desc(key)).rowsBetween(W.unboundedPreceding, -1)
    return out.withColumn("stack_from", F.coalesce(F.sum("percent").over(above), F.lit(0.0)))


def combined(counts: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """Counts of a group's samples by mean and by sum."""
    return counts.groupBy(key, group).agg(F.avg(value).alias("mean"), F.sum(value).alias("sum"))


def profile(df: DataFrame, entity: str, position: str, group: str, value: str, methods: list[str] | None = None) -> DataFrame:
    """Values by (entity, position, group): mean, median, max, min and sum, or those asked for."""
    known = df.dropna(subset=[entity, position, group])
    return statistics(known, [entity, position, group], value, methods or ["mean", "median", "max", "min", "sum"])


def band(df: DataFrame, entity: str, position: str, group: str, value: str, low: float = 20) -> DataFrame:
    """Mean with two standard errors on each side; low_coverage: the entity's upper bound stays below ``low``."""
    known = df.dropna(subset=[entity, position, group])
    stats = known.groupBy(entity, position, group).agg(F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value) / F.sqrt(F.count(value)), F.lit(0.0)).alias("se"))
    out = stats.select(entity, position, group, "mean", (F.col("mean") - 2 * F.col("se")).alias("lower"), (F.col("mean") + 2 * F.col("se")).alias("upper"))
    return out.withColumn("low_coverage", F.max("upper").over(W.partitionBy(entity)) < low)


def profile_order(profiles: DataFrame, group: str, value: str = "mean") -> DataFrame:
    """Groups by mean profile, the largest first, with their place from 0."""
    levels = profiles.groupBy(group).agg(F.avg(value).alias("level"))
    return numbered(levels, [F.desc("level"), group]).withColumn("place", F.col("place").cast("int"))


def natural_order(name: str | Column) -> list[Column]:
    """Sort keys: prefix up to the last hyphen, then the number after it (of up to 38 digits; what is no number comes first)."""
    c = F.col(name) if isinstance(name, str) else name
    number = F.nullif(F.regexp_extract(c, "-([0-9]{1,38})$", 1), F.lit("")).cast("decimal(38,0)")
    return [F.regexp_extract(c, "^(.*)-[^-]*$", 1), number, c]


def natural_places(names: DataFrame, name: str) -> DataFrame:
    """``names`` with the place of every row in natural order, from 1."""
    return numbered(names, natural_order(name), start=1)


def scaled_profile(df: DataFrame, keys: list[str], position: str, value: str, method: str = "sum") -> DataFrame:
    """(keys, position, share): values by position scaled to 1 within ``keys``; keys without signal go, and rows with a null key."""
    table = statistics(df.dropna(subset=[*keys, position]), [*keys, position], value, [method]).withColumnRenamed(method, "value")
    whole = F.sum("value").over(W.partitionBy(*keys))
    return table.withColumn("whole", whole).filter("whole <> 0").select(*keys, position, (F.col("value") / F.col("whole")).alias("share"))


def peaks(shares: DataFrame, keys: list[str], position: str, least: float = 0.1) -> DataFrame:
    """(keys, start, end, midpoint, label): maximal runs of positions whose share is at least ``least``."""
    high = shares.filter(F.col("share") >= least)
    island = F.col(position) - F.row_number().over(W.partitionBy(*keys).orderBy(position))
    runs = high.withColumn("island", island).groupBy(*keys, "island").agg(F.min(position).alias("start"), F.max(position).alias("end"))
    label = F.when(F.col("start") == F.col("end"), F.col("start").cast("string")).otherwise(F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")))
    return runs.select(*keys, "start", "end", ((F.col("start") + F.col("end")) / 2).alias("midpoint"), label.alias("label"))
