"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where a local session has none (tests) a temporary folder is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what is read survives the loss of any executor, is computed once, and has a
    known size from which the optimiser picks a join.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")  # what this write has shuffled is not needed again
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def dealt(big: DataFrame, small: DataFrame, keys: list[str], share: int = 100) -> DataFrame:
    """Left join whose hot keys (at least 1 / ``share`` of the rows of ``big``, so at most ``share`` keys) are broadcast instead of shuffled.

    ``small`` has one row a key.
    """
    counts = stored(big.groupBy(*keys).agg(F.count("*").alias("hot_rows")), "key-counts")
    total = counts.agg(F.sum("hot_rows")).first()[0] or 0
    hot = counts.filter(F.col("hot_rows") >= max(2, math.ceil(total / share))).select(*keys, F.lit(True).alias("is_hot"))
    marked = big.join(F.broadcast(hot), keys, "left")
    few = small.join(F.broadcast(hot.drop("is_hot")), keys, "left_semi")
    plain = marked.filter("is_hot is null").drop("is_hot").join(small, keys, "left")
    return plain.unionByName(marked.filter("is_hot").drop("is_hot").join(F.broadcast(few), keys, "left"))


def texts_in_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no more than ``rows`` whole texts be on their way between Spark and Python at once, for the rest of the session."""
    if not 0 < int(spark.conf.get(BATCH)) <= rows:
        spark.conf.set(BATCH, str(rows))
