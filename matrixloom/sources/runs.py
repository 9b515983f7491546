"""Readers of sequencing runs, and datasets of Parquet tables with CSV export.

Datasets and kept tables have versions. A version's tables are written to a folder of their own; then one row is appended to the table
``commits`` beside them, which makes it the current one. So a dataset can be saved over itself in the job that reads it, a writer that fails leaves the
last version in place, and readers keep the version that they found. Folders of old versions stay until they are cleared away.

Tables can be stored in buckets of a column, as x and obs_counts by feature: what groups or joins them by it later needs no shuffle.
"""

from __future__ import annotations

import csv
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import metadata_names
from ..operators.matrix import COVERAGE_TYPES


def coverage(spark: SparkSession, path: str) -> DataFrame:
    """Coverage rows: Feature, Sample, position, actualbase and the 15 coverage types."""
    schema = "Feature string, Sample string, position string, actualbase string, " + ", ".join(f"`{c}` double" for c in COVERAGE_TYPES)
    table = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    return nan_to_null(table)


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, kind in df.dtypes if kind in ("double", "float")})


def header(spark: SparkSession, path: str) -> str:
    """The first line of a text file."""
    return spark.read.text(path).first()["value"]


def size_factors(spark: SparkSession, path: str) -> DataFrame:
    """(sample, size_factor) of a one-row, space-separated table with a header."""
    wide = spark.read.option("sep", " ").option("header", True).csv(path)
    return wide.unpivot([], wide.columns, "sample", "size_factor").withColumn("size_factor", F.col("size_factor").cast("double"))


def delimited(spark: SparkSession, path: str, sep: str, names: list[str]) -> DataFrame:
    """All columns as strings, quotes read, without the first line; fields beyond ``names`` go, missing and empty ones are null."""
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    options = {"sep": sep, "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table = spark.read.options(**options).schema(schema).csv(path)
    return table.select(*(F.nullif(f"c{i}", F.lit("")).alias(n) for i, n in enumerate(names)))


def fields(line: str, sep: str) -> list[str]:
    return next(csv.reader([line], delimiter=sep))


def row_named(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """(key, sample, value) of a table whose header lacks the row names' column."""
    names = fields(header(spark, path), "\t")
    wide = delimited(spark, path, "\t", [key, *(f"value {i}" for i in range(len(names)))])  # rows have one field more than the header
    numbers = wide.select(key, *(F.expr(f"try_cast(`value {i}` as double)").alias(n) for i, n in enumerate(names)))
    return nan_to_null(numbers).unpivot([key], names, "sample", "value")


def split_read_types(counts: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Rows of features (with readtype), and all other rows."""
    ours = F.col(key).contains("tRNA") | F.col(key).contains("tRX")
    parts = F.split(key, "_", 2)
    return counts.filter(ours).select(parts[0].alias("feature"), F.get(parts, F.lit(1)).alias("readtype"), "sample", "value"), counts.filter(~ours)


def category_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(kind, key, sample, value) of several row-named tables."""
    tables = [row_named(spark, p).select(F.lit(kind).alias("kind"), "key", "sample", "value") for kind, p in paths.items()]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata, all strings, quotes read; the separator goes by the name's ending.

    Names are checked; rows of more fields than names get further names, surplus names go.
    """
    sep = "\t" if path.endswith(".tsv") else "," if path.endswith(".csv") else " "
    # Separators outside of quotes: an even number of quotes follows.
    outside = F.regexp_count("value", F.lit(f'{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).filter("line > 0").filter(F.trim("value") != "")
    width = lines.agg(F.max(outside + 1).alias("n")).first()["n"]
    return delimited(spark, path, sep, metadata_names(fields(header(spark, path), sep), width)).na.drop("all")


def run_info(spark: SparkSession, path: str) -> DataFrame:
    """One row with the map of a run's key-value lines; other lines are ignored."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).filter(F.size(parts) == 2).select(F.struct(parts[0].alias("k"), parts[1].alias("v")).alias("e"))
    return lines.agg(F.map_from_entries(F.collect_list("e")).alias("info"))


def configuration(text: str) -> dict:
    """A filter configuration from JSON text: name, obs, obs_r, var, var_r."""
    config = json.loads(text)
    if not config.get("name"):
        raise ValueError("a configuration needs a name")
    return config


COMMITS = "dataset string, version long, folder string, tables array<string>, buckets map<string, struct<column: string, number: int>>"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, version, folder, tables, buckets): what has been committed below ``path``."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{path}/commits")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], COMMITS)


def current(spark: SparkSession, path: str, dataset: str = "", version: int | None = None):
    """The row of ``commits`` with the dataset's last version, or the one asked for; None if there is none. Of two
    writers of one version the one with the lesser folder counts."""
    rows = commits(spark, path).filter(F.col("dataset") == dataset)
    rows = rows if version is None else rows.filter(F.col("version") == version)
    return rows.orderBy(F.desc("version"), "folder").first()


def save(tables: dict[str, DataFrame], path: str, partitions: dict[str, list[str]] | None = None, dataset: str = "", buckets: dict[str, tuple[str, int]] | None = None) -> int:
    """Write a dataset's tables as its next version below ``path``, which may be where they were read from; gives the version.

    ``partitions``: columns by table. ``buckets``: a column and the number of its buckets by table. Fails if another writer has committed this version first.
    """
    spark = next(iter(tables.values())).sparkSession
    before = current(spark, path, dataset)
    version = before["version"] + 1 if before else 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        keys = (partitions or {}).get(name)
        writer = df.write.partitionBy(*keys) if keys else df.write
        if name in (buckets or {}):
            column, number = buckets[name]
            table = f"bucketed_{uuid.uuid4().hex}"
            writer.bucketBy(number, column).sortBy(column).option("path", f"{path}/{folder}/{name}").saveAsTable(table)
            spark.sql(f"DROP TABLE {table}")  # its files stay
        else:
            writer.parquet(f"{path}/{folder}/{name}")
    spark.createDataFrame([(dataset, version, folder, list(tables), buckets or {})], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    if current(spark, path, dataset, version)["folder"] != folder:
        raise RuntimeError(f"version {version} has been committed by another writer")
    return version


def load(spark: SparkSession, path: str, names: list[str] | None = None, version: int | None = None, dataset: str = "") -> dict[str, DataFrame]:
    """Tables (all unless named) of the current version, or of the one given. Later saves do not change what was loaded."""
    found = current(spark, path, dataset, version)
    if found is None:
        raise FileNotFoundError(f"no such dataset: {path}")
    out = {}
    for name in names or found["tables"]:
        where = f"{path}/{found['folder']}/{name}"
        out[name] = spark.read.parquet(where)
        if name in found["buckets"]:
            # The session's catalogue has to know of the buckets; the files do not say.
            column, number = found["buckets"][name]
            table = f"{found['folder'].replace('-', '_')}_{name}"
            fields = ", ".join(f"`{c}` {kind}" for c, kind in out[name].dtypes)
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({fields}) USING parquet CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {number} BUCKETS LOCATION '{where}'")
            out[name] = spark.table(table)
    return out


def export_csv(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as CSV with a header; nested columns as JSON."""
    for name, df in tables.items():
        flat = [F.to_json(c).alias(c) if kind.startswith(("array", "map", "struct")) else F.col(c) for c, kind in df.dtypes]
        df.select(*flat).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def cached_diff(spark: SparkSession, path: str, config: str, compare: str, readtype: str, cutoff: int, make: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """A differential table kept under (config, compare, readtype, cutoff): read if it is there, else made and committed."""
    keys = {"config_name": config, "compare": compare, "readtype": readtype, "cutoff": cutoff}
    dataset = json.dumps(keys, sort_keys=True)
    if overwrite or current(spark, path, dataset) is None:
        save({"diff": make().withColumns({k: F.lit(v) for k, v in keys.items()})}, path, dataset=dataset)
    return load(spark, path, ["diff"], dataset=dataset)["diff"]
