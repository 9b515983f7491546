"""From a run's tables to a dataset, and the cluster and heatmap plans."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import positions
from ..operators import checks, cluster, differ, matrix, scale, select
from ..tables import stored


def dataset(coverage: DataFrame, factors: DataFrame, unique: DataFrame, every: DataFrame, meta: DataFrame, name: str, compat: bool = False, info: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The tables x, obs, obs_counts, seq and positions of a run.

    ``unique`` and ``every``: (feature, readtype, sample, value). ``meta``: one row a sample. ``info``: the run's information.
    Names and nulls are checked here, nulls in the observations by a warning. A feature that has a position twice in a sample, and a sample
    that has metadata twice, fail whatever job makes obs, and so keep a dataset from being committed.
    """
    checks.metadata_names(meta.columns)
    if info is not None:
        checks.run_info(info)
    meta = meta.groupBy("sample").agg(checks.one_a_key(F.struct(*meta.columns[1:]), ["sample"]).alias("m")).select("sample", "m.*")
    where = positions.dimension(coverage.sparkSession, compat)
    rows = coverage.withColumnsRenamed({"Feature": "feature", "Sample": "sample"})
    long = matrix.to_long(rows, ["feature", "sample", "position"], matrix.COVERAGE_TYPES)
    x = matrix.normalised(long, factors).join(F.broadcast(where), "position", "left")
    x = x.select(F.lit(name).alias("dataset"), "feature", "sample", "coverage", "position", "pos_ord", "gap", "location", "half", F.col("norm").alias("value"), "size_factor")
    counts = matrix.read_counts(unique, every, factors, obs=rows)
    totals = matrix.read_totals(counts, ["feature", "sample"])
    stats = matrix.region_stats(x, ["feature", "sample"])
    one = counts.groupBy("feature", "sample").agg(
        F.max(F.when(F.col("readtype") == "fiveprime", F.col("unique_norm"))).alias("fp"), F.max(F.when(F.col("readtype") == "threeprime", F.col("unique_norm"))).alias("tp")
    )
    labelled = matrix.fragment_class(stats.join(one, ["feature", "sample"], "left").join(totals.select("feature", "sample", F.col("total_unique_norm").alias("total")), ["feature", "sample"], "left"))
    keyed = matrix.parse_keys(labelled.withColumn("key", F.concat_ws("_", "feature", "sample")), "key")
    keyed = keyed.join(checks.no_doubles(rows, ["feature", "sample"], "position"), ["feature", "sample"])
    obs = matrix.with_metadata(keyed, meta).join(factors, "sample", "left").join(totals, ["feature", "sample"], "left")
    obs = obs.withColumns({"dataset": F.lit(name), "id": F.concat_ws("_", F.lit(name), "feature", "sample")})
    if lost := checks.samples_with_nulls(obs, meta.columns[1:]).collect():  # a row a sample
        warnings.warn(f"null metadata: {[tuple(r) for r in lost]}", stacklevel=2)
    seq = rows.join(F.broadcast(where.select("position", "pos_ord")), "position", "left").select("feature", "sample", "position", "pos_ord", F.col("actualbase").alias("base"))
    return {"x": x, "obs": obs, "obs_counts": counts, "seq": seq, "positions": where}


def default_diffs(obs_counts: DataFrame, group: str, cutoffs: tuple[int, ...] = (20, 40, 80, 100, 200), value: str = "value", readtype: str = "readtype") -> DataFrame:
    """The differential table of all read types and cutoffs in one job."""
    return differ.log2fc_cutoffs(obs_counts, "feature", group, value, list(cutoffs), by=(readtype,))


def heatmap(counts: DataFrame, group: str, value: str, cutoff: float = 80, bound: int = 25, totals: tuple[str, ...] = ("total", "total_unique"), readtype: str = "readtype") -> DataFrame:
    """Heatmap rows of all read types but the totals."""
    diff = differ.log2fc(counts.filter(~F.col(readtype).isin(*totals)), "feature", group, value, cutoff, by=(readtype,))
    return differ.heatmap(diff, bound, (readtype, "g1", "g2"))


def heatmap_csv(heat: DataFrame, path: str, readtype: str = "readtype") -> None:
    """Heatmap rows as CSV, a folder for each read type; the read type's name is kept as a column too."""
    heat.withColumn("of_readtype", F.col(readtype)).write.mode("overwrite").option("header", True).partitionBy("of_readtype").csv(path)


#: Coverage types that clusters are made from unless others are given: fixed values.
CLUSTER_TYPES = ["uniquecoverage", "readstarts", "readends", "mismatchedbases", "deletions"]
#: Smallest neighbourhood of a core row and smallest cluster, by level: fixed values.
LEVELS = {"sample": (6, 30), "group": (3, 10)}


def clustered(x: DataFrame, keys: list[str], column: list[str], value: str, eps: float, min_samples: int = 6, min_cluster_size: int = 10, k: int = 2) -> DataFrame:
    """(keys, d1, d2, label): robust-scaled features, their projection and their density clusters."""
    scaled = scale.robust_scaled(x, column, value)
    vectors = scaled.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(*column, "scaled"))), lambda e: e["scaled"]).alias("vector"))
    # Keys get numbers of their own; the table is drawn once.
    vectors = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    labels = cluster.density_clusters(vectors, "row", "vector", eps, min_samples, min_cluster_size)
    return scale.embedded(vectors, "vector", k).join(labels.withColumnRenamed("id", "row"), "row").drop("row", "vector")


def cluster_levels(tables: dict[str, DataFrame], eps: dict[str, float], types: list[str] | None = None, extra: list[str] | None = None, cutoff: float = 20, levels: dict[str, tuple[int, int]] | None = None, overwrite: bool = False) -> dict[str, DataFrame]:
    """``tables`` of a dataset with clusters by sample and by group: columns <level>_cluster, _d1, _d2 in obs, and the table cluster_runinfo.

    Entries without gap positions, of the coverage ``types``, with the numeric columns ``extra`` of obs as further entries (null is 0); rows
    of amino Und and of fewer than ``cutoff`` unique reads take no part (a group's are those of its first row). A dataset that
    has clusters is refused unless ``overwrite``.
    """
    if "cluster_runinfo" in tables and not overwrite:
        raise checks.CheckError("the dataset has clusters already")
    types, levels, extra = types or CLUSTER_TYPES, levels or LEVELS, extra or []
    made = [f"{level}_{c}" for level in levels for c in ("cluster", "d1", "d2")]
    obs = tables["obs"].drop(*made)
    x = select.entries(tables["x"], types, gaps=False).select("feature", "sample", "coverage", "position", "value")
    if extra:
        x = x.unionByName(matrix.to_long(obs, ["feature", "sample"], extra).fillna(0.0, ["value"]).withColumn("position", F.lit("custom")))
    known = obs.filter(~F.coalesce(F.col("amino") == "Und", F.lit(False))).select("feature", "sample", "group", F.col("total_unique_raw").alias("reads"))
    out, info = obs, []
    for level, (samples, size) in levels.items():
        keys = ["feature", level]
        enough = known.groupBy(*keys).agg(F.min_by("reads", "sample").alias("reads")).filter(F.col("reads") >= cutoff)
        rows = x.join(known.select("feature", "sample", *([level] if level != "sample" else [])), ["feature", "sample"])
        means = rows.groupBy(*keys, "coverage", "position").agg(F.avg("value").alias("value")).join(enough.select(*keys), keys, "left_semi")
        found = clustered(means, keys, ["coverage", "position"], "value", eps[level], samples, size)
        out = out.join(found.select(*keys, F.col("label").alias(f"{level}_cluster"), F.col("d1").alias(f"{level}_d1"), F.col("d2").alias(f"{level}_d2")), keys, "left")
        info.append((level, float(eps[level]), samples, size, float(cutoff), ",".join(types), ",".join(extra)))
    run = obs.sparkSession.createDataFrame(info, "level string, eps double, min_samples int, min_cluster_size int, readcutoff double, coveragetypes string, extra string")
    return tables | {"obs": out, "cluster_runinfo": run}


def cluster_tables(tables: dict[str, DataFrame], level: str, category: str, masked: Column, name: str) -> dict[str, DataFrame] | None:
    """Centres and the mask report of a dataset's clusters at one level; nothing, with a warning, if it has no clusters."""
    if "cluster_runinfo" not in tables:
        warnings.warn("the dataset has no clusters: make them first", stacklevel=2)
        return None
    return {
        "centroids": cluster.centroids(tables["obs"], f"{level}_cluster", [f"{level}_d1", f"{level}_d2"], name),
        "masked": cluster.masked_categories(tables["obs"], category, masked),
    }
