"""The long matrix: reshaping, keys, normalisation, read totals, region statistics, fragment classes, sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import above
from ..tables import stored
from .checks import one_a_key

#: Coverage types that are raw counts and are divided by the size factor, and the others: fixed values.
RAW_TYPES = ["adenines", "thymines", "cytosines", "guanines", "deletions"]
COVERAGE_TYPES = [
    "coverage", "readstarts", "readends", "uniquecoverage", "multitrnacoverage", "multianticodoncoverage", "multiaminocoverage",
    "tRNAreadstotal", "mismatchedbases", "deletedbases", *RAW_TYPES,
]
TOTAL_TYPES = ["fiveprime", "threeprime", "wholecounts", "other"]


def to_long(df: DataFrame, keys: list[str], measures: list[str], name: str = "coverage", value: str = "value") -> DataFrame:
    """One row per key and measure, in a single pass."""
    return df.select(*keys, *(F.col(m).cast("double").alias(m) for m in measures)).unpivot(keys, measures, name, value)


def long_sums(df: DataFrame, keys: list[str], measures: dict[str, Column], name: str = "coverage", value: str = "value") -> DataFrame:
    """(keys, name, value): sums of ``measures`` by keys. They are added up side by side and become rows afterwards, so a row is shuffled once for all of them."""
    sums = df.groupBy(*keys).agg(*(F.sum(m.cast("double")).alias(n) for n, m in measures.items()))
    return to_long(sums, keys, list(measures), name, value)


def wide_sums(df: DataFrame, keys: list[str], column: str, value: str, columns: list) -> DataFrame:
    """``to_wide`` of the sums of ``value`` by keys and ``column``, in one aggregation."""
    return df.groupBy(*keys).agg(*(F.sum(F.when(F.col(column) == c, F.col(value))).alias(str(c)) for c in columns))


def to_wide(long: DataFrame, keys: list[str], column: str, value: str, columns: list, check: bool = True) -> DataFrame:
    """One column for each of ``columns``, which are given so that no job has to find them; duplicates fail the job."""
    if check:
        long = long.groupBy(*keys, column).agg(one_a_key(F.col(value), [*keys, column]).alias(value))
    return long.groupBy(*keys).pivot(column, columns).agg(F.first(value))


def parse_keys(df: DataFrame, key: str) -> DataFrame:
    """feature, sample, pseudogene, amino and iso of a key ``<feature>_<sample>``, split at the first underscore."""
    parts = F.split(key, "_", 2)
    f = F.split(F.col("feature"), "-", 5)
    out = df.withColumn("feature", parts[0]).withColumn("sample", F.get(parts, F.lit(1)))
    return out.withColumns({"pseudogene": f[0], "amino": F.get(f, F.lit(1)), "iso": F.get(f, F.lit(2))})


def read_types(df: DataFrame, key: str) -> DataFrame:
    """The distinct read types of keys ``<feature>_<readtype>``."""
    return df.select(F.get(F.split(key, "_"), F.lit(1)).alias("readtype")).filter("readtype is not null").distinct()


def ordered_positions(df: DataFrame, position: str, order: str) -> DataFrame:
    """Distinct positions by first appearance in ``order``."""
    return df.groupBy(position).agg(F.min(order).alias("first_seen"))


def with_metadata(x: DataFrame, meta: DataFrame, sample: str = "sample") -> DataFrame:
    """``x`` with its sample's metadata; a sample that has none gets nulls."""
    return x.join(meta, sample, "left")


def normalised(x: DataFrame, factors: DataFrame, sample: str = "sample", coverage: str = "coverage", value: str = "value", raw_types: list[str] = RAW_TYPES) -> DataFrame:
    """Raw coverage types divided by their sample's size factor; the others pass through. Adds norm and size_factor."""
    out = x.join(factors, sample, "left")
    return out.withColumn("norm", F.when(F.col(coverage).isin(raw_types), F.try_divide(value, "size_factor")).otherwise(F.col(value)))


def normalised_sums(df: DataFrame, keys: list[str], measures: list[str], factors: DataFrame, sample: str = "sample", raw_types: list[str] = RAW_TYPES) -> DataFrame:
    """(keys, coverage, norm): sums of what ``normalised`` makes of the measures' rows; a row meets its factor once for all measures."""
    parts = {m: F.try_divide(F.col(m).cast("double"), "size_factor") if m in raw_types else F.col(m) for m in measures}
    return long_sums(df.join(factors, sample, "left"), keys, parts, value="norm")


def raw_layer(x: DataFrame, value: str = "norm") -> DataFrame:
    return x.withColumn("raw", F.col(value) * F.col("size_factor"))


def read_counts(unique: DataFrame, every: DataFrame, factors: DataFrame, keys: tuple[str, str, str] = ("feature", "readtype", "sample"), obs: DataFrame | None = None) -> DataFrame:
    """(feature, sample, readtype, unique_raw, unique_norm, all_raw, all_norm) from unique raw and normalised counts.

    A row for each read type and each (feature, sample) of ``obs``, or else of both tables. A feature without counts of a read type
    has 0; one with some, but none for the sample, has null there.
    """
    feature, readtype, sample = keys
    rows = unique.select(*keys, "value", F.lit(True).alias("is_u")).unionByName(every.select(*keys, "value", F.lit(False).alias("is_u")))
    rows = stored(rows.withColumn("value", F.col("value").cast("double")), "counts")  # both tables are made and read once
    types = rows.agg(F.collect_set(F.struct(readtype)).alias("types_"))  # one row with a dozen read types
    seen = rows.groupBy(feature).agg(*(F.collect_set(F.when(side, F.col(readtype))).alias(f"seen_{n}") for n, side in (("u", F.col("is_u")), ("a", ~F.col("is_u")))))
    whole = F.col(feature).isNotNull() & F.col(sample).isNotNull() & F.col(readtype).isNotNull()
    out = rows.groupBy(feature, sample).agg(F.collect_list(F.when(whole, F.struct(readtype, "value", "is_u"))).alias("cells_"))
    if obs is not None:
        out = obs.select(feature, sample).distinct().join(out, [feature, sample], "left")
    out = out.join(seen, feature, "left").join(factors, sample, "left").crossJoin(F.broadcast(types))
    out = out.withColumn(readtype, F.explode("types_")).withColumn(readtype, F.col(readtype)[readtype])

    def values(unique_: bool) -> Column:
        mine = F.transform(F.filter("cells_", lambda x: (x[readtype] == F.col(readtype)) & (x["is_u"] == unique_)), lambda x: x["value"])
        return F.explode(F.when(F.size(mine) > 0, mine).otherwise(F.array(F.lit(None).cast("double"))))

    out = out.withColumn("u", values(True)).withColumn("a", values(False))
    raw, norm = (F.when(F.coalesce(F.array_contains(f"seen_{n}", F.col(readtype)), F.lit(False)), F.col(n)).otherwise(0.0) for n in ("u", "a"))
    return out.select(*keys, raw.alias("unique_raw"), F.try_divide(raw, F.col("size_factor")).alias("unique_norm"), (norm * F.col("size_factor")).alias("all_raw"), norm.alias("all_norm"))


def read_totals(counts: DataFrame, keys: list[str], readtype: str = "readtype", types: list[str] = TOTAL_TYPES, values: list[str] | None = None) -> DataFrame:
    """Sums over the four read types; nulls count nothing."""
    values = values or ["unique_raw", "unique_norm", "all_raw", "all_norm"]
    return counts.filter(F.col(readtype).isin(types)).groupBy(*keys).agg(*(F.coalesce(F.sum(v), F.lit(0.0)).alias(f"total_{v}") for v in values))


def region_stats(x: DataFrame, keys: list[str], value: str = "value", half: str = "half", location: str = "location") -> DataFrame:
    """Means and population deviations by region, over all coverage types, in one pass."""
    def only(column: str, name: str) -> Column:
        return F.when(F.col(column) == name, F.col(value))

    halves = ["fiveprime", "center", "threeprime"]
    stems = {"stem5": "fiveprime_acceptorstem", "stem3": "threeprime_acceptorstem"}
    return x.groupBy(*keys).agg(
        *(F.avg(only(half, h)).alias(f"mean_{h}") for h in halves),
        *(F.stddev_pop(only(half, h)).alias(f"sd_{h}") for h in halves),
        *(F.avg(only(location, s)).alias(f"mean_{n}") for n, s in stems.items()),
        F.stddev_pop(value).alias("sd_all"),
    )


def fragment_class(stats: DataFrame, fiveprime: str = "fp", threeprime: str = "tp", total: str = "total", low: float = 20) -> DataFrame:
    """The fragment label of each row of ``region_stats`` with its normalised unique five-prime, three-prime and total reads.

    Numbers that are equal to nine digits are not above each other.
    """
    c, fp, tp = F.col, F.coalesce(F.col(fiveprime), F.lit(0.0)), F.coalesce(F.col(threeprime), F.lit(0.0))
    close5 = above(c("sd_fiveprime"), F.abs(c("mean_center") - c("mean_stem5")))
    close3 = above(c("sd_threeprime"), F.abs(c("mean_center") - c("mean_stem3")))
    label = (
        F.when(~above(F.coalesce(F.col(total), F.lit(0.0)), F.lit(low)), "low_coverage")
        .when(above(fp, F.abs(tp + 2 * c("sd_all"))), F.when(close5, "fiveprime_half").otherwise("fiveprime_fragment"))
        .when(above(tp, F.abs(fp + 2 * c("sd_all"))), F.when(close3, "threeprime_half").otherwise("threeprime_fragment"))
        .when(above(F.abs(c("mean_fiveprime") - c("mean_threeprime")), c("sd_all")), "other_fragment")
        .when(above(F.abs(c("mean_stem5") - c("mean_stem3")), c("mean_center") + c("sd_center")), "multiple_fragment")
        .otherwise("whole")
    )
    return stats.withColumn("fragment", label)


def sequences(bases: DataFrame, keys: list[str], order: str = "pos_ord", base: str = "base", rna: bool = False) -> DataFrame:
    """Each key's bases in order as one string; ``rna`` writes U for T. A key's positions are few, so the list is small."""
    letter = F.translate(base, "Tt", "Uu") if rna else F.col(base)
    return bases.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), letter.alias("b")))), lambda x: x["b"]), "").alias("sequence"))


def text_sequences(df: DataFrame, key: str, text: str, letters: dict[str, str], other: str, period: int, least: int, rna: bool = False) -> DataFrame:
    """(key, sequence): the bases of each text's characters, without those whose place modulo ``period`` is at least ``least``.

    ``letters`` maps lower-case ASCII letters to bases. A text becomes its sequence within its row; only keys are shuffled. The texts of a key
    that has several are merged place by place, as by ``sequences``.
    """
    both = letters | {c.upper(): b for c, b in letters.items()}
    said = "".join(both)
    mark = next(c for c in "#*+~" if c not in both)  # any other character
    bases = "".join(both.values()) + other
    plain = F.translate(F.regexp_replace(text, "[^" + "".join(f"\\x{ord(c):02x}" for c in said) + "]", mark), said + mark, bases.replace("T", "U").replace("t", "u") if rna else bases)
    kept = F.regexp_replace(plain, f"(.{{{least}}}).{{1,{period - least}}}", "$1") if least < period else plain
    texts = df.select(key, text).filter(F.length(text) > 0)
    several = stored(texts.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(F.col(key).alias("several_")), "several")
    same = F.col(key).eqNullSafe(F.col("several_"))
    once = texts.join(several, same, "left_anti").select(key, kept.alias("sequence"))
    rows = texts.join(several, same).select(key, F.posexplode(F.split(plain, "")).alias("place", "base"))
    rows = rows.filter((F.col("base") != "") & (F.col("place") % period < least))
    return once.filter(F.length("sequence") > 0).unionByName(sequences(rows, [key], "place"))


def trimmed(bases: DataFrame, drop_cca: bool = True, drop_gaps: bool = False, position: str = "position") -> DataFrame:
    """Bases without the one before the first, without the CCA tail and, if asked for, without gaps."""
    out = bases.filter(F.col(position) != "-1")
    out = out.filter(~F.col(position).isin("74", "75", "76")) if drop_cca else out
    return out.filter(~F.col(position).rlike("a|b|e|-1")) if drop_gaps else out


def mean_profiles(x: DataFrame, reads: DataFrame, feature: str, group: str, columns: list[str], value: str, first: list[str], order: str, cutoff: float = 20, excluded: tuple[str, ...] = ("Und",), amino: str = "amino", compat: bool = False) -> DataFrame:
    """Mean of ``value`` by (feature, group, columns...), with the metadata ``first`` of the least ``order``.

    Groups with fewer than ``cutoff`` reads go; the reads are the group's mean, with ``compat`` those of its least ``order``.
    ``reads`` has feature, group, order, amino, reads and the metadata.
    """
    level = F.min_by("reads", order) if compat else F.avg("reads")
    meta = reads.filter(~F.col(amino).isin(*excluded)).groupBy(feature, group).agg(level.alias("reads"), *(F.min_by(c, order).alias(c) for c in first))
    return x.groupBy(feature, group, *columns).agg(F.avg(value).alias("mean")).join(meta.filter(F.col("reads") >= cutoff), [feature, group])
