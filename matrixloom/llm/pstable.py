"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are normalised, so a cosine of c is a distance of sqrt(2 - 2 c). A hash of a vector is its projection on a normal random
direction, shifted at random and cut into steps of ``width`` distances; a table's bucket is a tuple of ``k`` such hashes. Rows that share a
bucket in any of ``tables`` tables are compared by exact cosine in doubles. ``plan`` chooses k so that unrelated rows fill buckets of
about ``fill`` rows, and as many tables as keep the chance that a pair at the least cosine meets in none below ``miss``; closer pairs
are missed far more rarely.

Equal vectors are one row with a weight. Buckets above ``tile`` rows are cut into tiles that meet pairwise in tasks of their own, so
none is skipped and none is held whole. A pair counts in the first table in which its rows meet: hashes are whole-number arithmetic in
doubles, so any task finds the same ones. Of a bucket's links only the number for each row and a spanning forest leave its task.
Tables are worked off ``at_once`` at a time, which bounds what is shuffled at once.

Defined results: vectors that are null, zero, empty or hold null or non-finite components, and rows without id, link with nothing
(a row without id has no component and is not kept); shorter vectors are filled with zeros; repeated rows are vectors of their own;
components are named by the smallest id; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..tables import dealt
from .common import quoted, stored
from .simhash import merge

SEED = 20_000_003
#: Vectors are rounded to 20 bits and directions to 12 for hashing: all sums are whole numbers below 2**53, exact in any order.
VECTOR, DIRECTION = 20, 12
MIX = np.uint64(0x9E3779B97F4A7C15)


def meets(far: float) -> float:
    """Chance that two rows share a hash of step 1 at the distance 1 / ``far``."""
    tail = 0.5 * math.erfc(far / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * far) * (1 - math.exp(-far * far / 2))


def plan(rows: int, least: float, miss: float, fill: int, width: float = 5.5) -> tuple[int, int, float]:
    """(k, tables, step) for so many distinct vectors."""
    near = max(math.sqrt(max(0.0, 2 - 2 * least)), 1e-3)
    step = width * near
    k = max(1, round(math.log(max(1.0, rows / fill)) / -math.log(meets(step / math.sqrt(2)))))
    return k, max(1, math.ceil(math.log(miss) / math.log1p(-(meets(width) ** k)))), step


class Hashes:
    """Buckets of unit vectors. ``count`` tables of ``k`` hashes; directions are made from the seed, dimension by dimension."""

    def __init__(self, k: int, count: int, step: float):
        self.k, self.count = k, count
        self.scale = 1 << VECTOR + DIRECTION
        self.step = max(1, round(step * self.scale))
        self.shift = np.random.default_rng([SEED, 0]).integers(0, self.step, k * count)
        self.by_dimension: list[np.ndarray] = []

    def directions(self, dimensions: int) -> np.ndarray:
        for d in range(len(self.by_dimension), dimensions):
            normal = np.random.default_rng([SEED, 1, d]).standard_normal(self.k * self.count)
            self.by_dimension.append(np.rint(normal * (1 << DIRECTION)))
        return np.array(self.by_dimension[:dimensions]).reshape(dimensions, -1)

    def buckets(self, unit: np.ndarray, a: int, b: int) -> np.ndarray:
        """For each row its buckets in tables a to b, as 64-bit numbers (tuples that share one only add comparisons)."""
        at = slice(a * self.k, b * self.k)
        whole = np.rint(unit * (1 << VECTOR)) @ self.directions(unit.shape[1])[:, at]
        steps = ((whole.astype(np.int64) + self.shift[at]) // self.step).astype(np.uint64).reshape(len(unit), b - a, self.k)
        out = np.zeros((len(unit), b - a), np.uint64)
        for i in range(self.k):
            out = (out ^ steps[:, :, i]) * MIX
            out ^= out >> np.uint64(29)
        return out.view(np.int64)


def classes(table: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, h1, h2) with nulls for those that link with nothing, and distinct vectors (node, h1, h2, v, size, id, n).

    Nodes are numbered by ascending least id, v is scaled and ``size`` is its length.
    """
    rows = table.select(quoted(id_column).cast("long").alias("id"), quoted(vector_column).alias("v"))
    whole = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    sound = F.col("id").isNotNull() & F.coalesce(whole, F.lit(False)) & F.coalesce(F.exists("v", lambda e: e != 0), F.lit(False))
    keyed = rows.withColumn("v", F.when(sound, F.col("v"))).select("id", "v", F.when(sound, F.xxhash64("v")).alias("h1"), F.when(sound, F.xxhash64(F.lit(1), "v")).alias("h2"))
    alone = keyed.filter("v is not null").groupBy("h1", "h2", "v").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    most = F.array_max(F.transform("v", lambda e: F.abs(e.cast("double"))))
    scaled = alone.withColumn("most", most).withColumn("v", F.when(F.col("most").between(1e-100, 1e100), F.transform("v", lambda e: e.cast("double"))).otherwise(F.transform("v", lambda e: e.cast("double") / F.col("most"))))
    sized = scaled.withColumn("size", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)))
    placed = sized.drop("most").repartitionByRange("id").sortWithinPartitions("id")
    return keyed.select("id", "h1", "h2"), stored(placed.withColumn("node", F.monotonically_increasing_id()), "classes")


def unit_vectors(lists: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Rows of length 1, filled with zeros."""
    counts = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(counts.max()) if len(counts) else 0))
    out[np.arange(out.shape[1]) < counts[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out / sizes[:, None]


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold whole groups of rows with equal first ``keys`` columns (long, never null; sorted), and where groups start."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]))
        if last := int(starts[-1]):
            yield batch.slice(0, last), starts[:-1]
        held = batch.slice(last)
    if held is not None:
        yield held, np.zeros(1, np.int64)


def linked(unit: np.ndarray, tile: np.ndarray, cross_only: bool, least: float, rows: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j with cosine >= ``least``; of two tiles that meet only those with a row in each."""
    for a in range(0, len(unit), rows):
        hit = unit[a : a + rows] @ unit[a:].T >= least
        i, j = np.nonzero(np.triu(hit, 1))
        i, j = i + a, j + a
        if cross_only:
            cross = tile[i] != tile[j]
            i, j = i[cross], j[cross]
        yield i, j


def compared(entries: DataFrame, hashes: Hashes, least: float) -> DataFrame:
    """(u, v, n): for each row u of a bucket the weight n of what it links with here first, and forest edges u, v (n null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in groups_of(batches, 4):
            ends = np.append(starts[1:], batch.num_rows)
            some = ends - starts > 1
            out: list[np.ndarray] = []
            for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True):
                part = batch.slice(a, b - a)
                at, own, node, n = (part.column(c).to_numpy() for c in ("at", "own", "node", "n"))
                unit = unit_vectors(part.column("v"), part.column("size").to_numpy())
                earlier = hashes.buckets(unit, 0, int(at[0]))
                weight, labels = np.zeros(len(n), np.int64), np.arange(len(n))
                for i, j in linked(unit, own, part.column("lo")[0] != part.column("hi")[0], least):
                    merge(labels, i, j)
                    new = ~(earlier[i] == earlier[j]).any(1)
                    np.add.at(weight, i[new], n[j[new]])
                    np.add.at(weight, j[new], n[i[new]])
                more, child = np.flatnonzero(weight), np.flatnonzero(labels != np.arange(len(n)))
                out += [np.array([node[more], np.full(len(more), -1), weight[more]]), np.array([node[child], node[labels[child]], np.full(len(child), -1)])]
            found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), *(pa.array(x, mask=x < 0) for x in found[1:])], ["u", "v", "n"])

    return entries.mapInArrow(run, "u long, v long, n long")


def filed(nodes: DataFrame, hashes: Hashes, a: int, b: int, vectors: bool) -> DataFrame:
    """(at, bucket) of each of the nodes in tables a to b, with what a comparison needs if ``vectors``."""
    more = ", node long, n long, size double, v array<double>" if vectors else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = unit_vectors(batch.column("v"), batch.column("size").to_numpy())
            found = hashes.buckets(unit, a, b)
            for t in range(a, b):
                columns = [pa.array(np.full(len(unit), t)), pa.array(found[:, t - a])] + [batch.column(c) for c in ("node", "n", "size", "v") if vectors]
                yield pa.RecordBatch.from_arrays(columns, ["at", "bucket", "node", "n", "size", "v"][: len(columns)])

    return nodes.mapInArrow(run, "at long, bucket long" + more)


def met(nodes: DataFrame, hashes: Hashes, a: int, b: int, tile: int) -> DataFrame:
    """Entries of tables a to b by (at, bucket, lo, hi): each meeting of tiles lo and hi of a bucket lies in one partition, in one run."""
    large = stored(filed(nodes, hashes, a, b, False).groupBy("at", "bucket").agg(F.count("*").alias("many")).filter(F.col("many") > tile), "large-buckets")
    cut = filed(nodes, hashes, a, b, True).join(large, ["at", "bucket"], "left")
    cut = cut.withColumn("tiles", F.coalesce(F.ceil(F.col("many") / tile), F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), "tiles")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    cut = cut.select("at", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "n", "size", "v")
    return cut.repartition("at", "bucket", "lo", "hi").sortWithinPartitions("at", "bucket", "lo", "hi", "node")


def near_duplicates(table: DataFrame, least: float = 0.9, miss: float = 1e-3, fill: int = 512, tile: int = 4096, at_once: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per row of ``table``: id, n_links (rows linked directly), component_id (least id reachable), kept (it is its component's first)."""
    rows, nodes = classes(table, id_column, vector_column)
    k, count, step = plan(nodes.count(), least, miss, fill)
    hashes = Hashes(k, count, step)
    found = [stored(compared(met(nodes, hashes, a, min(a + at_once, count), tile), hashes, least), "links") for a in range(0, count, at_once)]
    every = reduce(DataFrame.unionByName, found)
    weights = every.filter("n is not null").groupBy("u").agg(F.sum("n").alias("near")).withColumnRenamed("u", "node")
    roots = components(every.filter("n is null").select("u", "v"))
    member = nodes.select("node", "h1", "h2", "n").join(weights, "node", "left").join(roots, "node", "left")
    member = stored(member.select("h1", "h2", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")), "members")
    named = stored(dealt(member, nodes.select(F.col("node").alias("root"), F.col("id").alias("component_id")), ["root"]).drop("root"), "named")
    lone, linking = rows.filter("h1 is null"), rows.filter("h1 is not null")
    columns = ["id", "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")]
    out = dealt(linking, named, ["h1", "h2"]).select(*columns)
    return out.unionByName(lone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")).select(*columns))


#: The query's DuckDB twin: all pairs.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), s AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM s a JOIN s b ON a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(r, m) AS (
  SELECT r, vec_id FROM v UNION SELECT l.a, reach.m FROM reach JOIN l ON l.b = reach.r
), c AS (SELECT r, min(m) AS component_id FROM reach GROUP BY r), n AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""
