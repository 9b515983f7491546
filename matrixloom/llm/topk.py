"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components are floor(scale * x). Candidate rows are dealt into blocks of bounded size; a block's index has, for each
dimension and each quantised impact (component // ``step``), the posting segment of the rows with that impact. For a
query, a segment adds one number to its rows: the query's component times the impact's upper end (lower end for a negative one). Segments
are processed by descending contribution. A row's score is at most its sum plus the largest contributions still to come,
and at least its sum less the quantisation error. Processing stops only when this proves that few rows
can be among the best k; these possible members are scored exactly.

Queries are dealt into blocks too, and every query block meets every candidate block, so memory is bounded on both sides; of
each meeting only k rows a query are kept. Contributions are shifted so that none is negative.

Vectors with a component beyond 2**20 after scaling are not indexed: they are scored in Python's whole numbers, which neither
scaling nor a product can overflow.

Defined results: vectors that are null, or hold null or non-finite components, and rows without id take no part; shorter
vectors are filled with zeros; ties go to the smaller id; a query never meets rows with its own id; repeated rows are repeated
candidates but ask once; a score among the best that is beyond 2**63 - 1 either way ends the run with an error; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import quoted, stored

BLOCK, QUERIES = 8192, 512
#: Segments between two looks at the proof, and the share of rows that may remain possible when it stops.
LOOK, FEW = 256, 1 / 16
#: Largest component of an indexed vector: sums of products stay far below 2**53.
SMALL = 1 << 20
LONG = (1 << 63) - 1


class Index:
    """Posting segments of a block by dimension and quantised impact."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, step: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.step = ids[order], vectors[order], step
        level = self.vectors // step
        dims, levels, rows = [], [], []
        for d in range(level.shape[1]):
            by = np.argsort(level[:, d], kind="stable")
            edge = np.flatnonzero(np.diff(level[by, d])) + 1
            for part in np.split(by, edge):
                dims.append(d)
                levels.append(int(level[part[0], d]))
                rows.append(part)
        self.dims, self.levels, self.rows = np.array(dims), np.array(levels, np.int64), rows

    def possible(self, query: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """Rows that may be among the best k: all others are proved not to be. ``own``: rows that don't count."""
        n = len(self.ids)
        if n <= 4 * k:
            return np.arange(n)
        weight = query[self.dims]
        upper = np.where(weight >= 0, weight * (self.levels * self.step + self.step - 1), weight * self.levels * self.step)
        least = np.full(len(query), np.iinfo(np.int64).max)
        np.minimum.at(least, self.dims, upper)
        gain = upper - least[self.dims]
        error = int(np.abs(query).sum()) * (self.step - 1)
        order = np.lexsort((self.dims, -gain))
        dims, gain = self.dims[order], gain[order]
        sums = np.zeros(n)  # whole numbers below 2**53, so exact
        open_ = np.ones(n, bool)
        open_[own] = False
        if open_.sum() < k:
            return np.flatnonzero(open_)
        ahead = np.zeros(len(query), np.int64)
        may = open_
        for at in range(0, len(order), LOOK):
            parts = [self.rows[i] for i in order[at : at + LOOK].tolist()]
            sums += np.bincount(np.concatenate(parts), np.repeat(gain[at : at + LOOK], [len(p) for p in parts]), n)
            # Of each dimension the largest contribution still to come: the first that follows, so it is assigned last.
            ahead[:] = 0
            ahead[dims[at + LOOK :][::-1]] = gain[at + LOOK :][::-1]
            live = sums[open_]
            bar = np.partition(live, len(live) - k)[len(live) - k] - error
            may = open_ & (sums + int(ahead.sum()) >= bar)
            if may.sum() <= max(4 * k, FEW * n):
                break
        return np.flatnonzero(may)

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with id ``own``; ties to smaller ids."""
        a, b = np.searchsorted(self.ids, [own, own + 1])
        rows = self.possible(query, k, np.arange(a, b))
        rows = rows[(rows < a) | (rows >= b)]
        score = self.vectors[rows] @ query
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[order]], score[order]


class Block:
    """A block of candidates: indexed vectors, and those with large components."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: int, step: int):
        self.scale = scale
        large = (np.abs(vectors) > SMALL // scale).any(1)
        self.index = Index(ids[~large], np.floor(scale * vectors[~large]).astype(np.int64), step)
        self.ids, self.vectors = ids[large], whole_numbers(vectors[large], scale)

    def best(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows but those with id ``own``; ties to smaller ids."""
        small = self.index
        whole = whole_numbers(query, self.scale)
        found = scored(self.ids, self.vectors, whole)
        if (np.abs(query) <= SMALL // self.scale).all():
            found += zip(*(x.tolist() for x in small.best(np.floor(self.scale * query).astype(np.int64), own, k)), strict=True)
        else:
            found += scored(small.ids, small.vectors.astype(object), whole)
        return sorted((f for f in found if f[0] != own), key=lambda f: (-f[1], f[0]))[:k]


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python's whole numbers, which have no largest."""
    def one(x: float) -> int:
        y = scale * x
        return math.floor(y) if math.isfinite(y) else scale * int(x)  # so large a double is whole

    return np.array([one(x) for x in vectors.ravel().tolist()], object).reshape(vectors.shape)


def scored(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray) -> list[tuple[int, int]]:
    return list(zip(ids.tolist(), (vectors @ query).tolist(), strict=True)) if len(ids) else []


def whole_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v: array of doubles) of the rows that take part."""
    rows = table.select(quoted(id_column).cast("long").alias("id"), quoted(vector_column).alias("x"))
    sound = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull()).filter(F.coalesce(sound, F.lit(False)))
    return rows.select("id", F.transform("x", lambda e: e.cast("double")).alias("v"))


def blocked(rows: DataFrame, size: int, count: int, name: str) -> tuple[DataFrame, int]:
    """Rows with the number of their block; how many blocks there are. Blocks are random, so of much the same size."""
    n = max(1, math.ceil(count / size))
    return rows.withColumn(name, F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n)).cast("int")), n


def top(table: DataFrame, every: int, k: int = 5, scale: int = 256, step: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k best rows for each row whose id is divisible by ``every``."""
    rows = stored(whole_vectors(table, id_column, vector_column), "vectors")
    queries = stored(rows.filter(F.col("id") % every == 0).distinct(), "queries")
    sides, n = blocked(rows, BLOCK, rows.count(), "c")
    asked, m = blocked(queries, QUERIES, queries.count(), "q")
    # A meeting of a candidate block with a query block is a group of its own: the rows of both are sent to it.
    left = sides.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).select("c", "q", F.lit(False).alias("asks"), "id", "v")
    right = asked.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select("c", "q", F.lit(True).alias("asks"), "id", "v")

    def meet(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        ids = group.column("id").to_numpy()
        vectors = group.column("v").combine_chunks()
        sizes = pc.list_value_length(vectors).to_numpy()
        width = int(sizes.max())
        matrix = np.zeros((len(ids), width))
        matrix[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
        out: list[tuple[int, int, int]] = []
        if asks.any() and not asks.all() and width:
            block = Block(ids[~asks], matrix[~asks], scale, step)
            for own, query in zip(ids[asks].tolist(), matrix[asks], strict=True):
                out += [(own, *found) for found in block.best(query, own, k)]
        # A score that is no long only says on which side of all longs it lies.
        beyond = [(o[2] > LONG) - (o[2] < -LONG) for o in out]
        score = [0 if b else o[2] for o, b in zip(out, beyond, strict=True)]
        columns = [[o[0] for o in out], [o[1] for o in out], beyond, score]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(["query_id", "id", "beyond", "score"], columns, strict=True)})

    # A query row and a candidate row meet once, so equal rows here are repeated candidates.
    met = left.unionByName(right).groupBy("c", "q").applyInArrow(meet, "query_id long, id long, beyond long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), "id")
    best = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score among the best is no long")).cast("long"))
    return best.select("query_id", "rank", "id", score.alias("score"))


#: The query's DuckDB twin.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
