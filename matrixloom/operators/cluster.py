"""Density clusters of vectors at one density cut, with centroids and mask reports.

Rows within ``eps`` of at least ``min_samples`` rows (themselves included) are core rows; core rows within ``eps`` of each other
are linked; components of at least ``min_cluster_size`` are clusters, everything else is noise (-1).

Rows meet by an exact radius join. Vectors are turned to principal axes (any orthonormal axes are right; these prune best). Along the first
axes rows lie in cells of side ``eps``: rows at most ``eps`` apart lie in the same cell or in two that touch, and meet in one of them. A meeting of
more than ``tile`` rows is cut into tiles that meet pairwise in tasks of their own. Within a task rows are sorted into strips; by Cauchy-Schwarz two
vectors are at least as far apart as their leading coordinates and the lengths of what remains, so strips whose boxes of these are further than ``eps``
apart are not compared. Of what is compared only counts, or the edges of a spanning forest, leave the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import dealt, stored
from .components import components

#: Rows that the axes are taken from; leading coordinates of boxes; rows of a strip.
SAMPLE, LEADING, STRIP = 10_000, 8, 256


def axes(rows: DataFrame, vector: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The middle, the principal axes (columns, the widest first) and the widths along them of a sample of at most ``SAMPLE`` vectors.

    They only decide how well the join prunes: it is exact for any.
    """
    drawn = [r[0] for r in rows.select(vector).limit(SAMPLE).collect()]
    width = max((len(v) for v in drawn), default=0)
    matrix = np.zeros((len(drawn), width))
    for i, v in enumerate(drawn):
        matrix[i, : len(v)] = v
    if not matrix.size:
        return np.zeros(width), np.eye(width), np.zeros(width)
    middle = matrix.mean(0)
    turn = np.linalg.svd(matrix - middle, full_matrices=True)[2].T if len(drawn) <= width else np.linalg.eigh(np.cov(matrix.T).reshape(width, width))[1][:, ::-1]
    return middle, turn, np.ptp((matrix - middle) @ turn, axis=0)


@dataclass
class Join:
    """Rows by the tasks in which they meet: (cell, lo, hi, own, home, id, n, v), each run of equal (cell, lo, hi) whole in one partition.

    ``home``: whether the row lies in the cell; others are visitors from cells next to it, so that every pair meets once.
    """

    meet: DataFrame
    middle: np.ndarray
    turn: np.ndarray
    eps: float


def placed(rows: DataFrame, eps: float, tile: int, cells: int = 2) -> Join:
    """The radius join of ``rows`` (id, n, v: array of finite floats or doubles, of one width).

    There are cells along at most ``cells`` axes, and along none on which the rows are not wider than three cells: nearly all of them would
    visit one another's cells there, which sends every row several times and spares no comparison.
    """
    middle, turn, wide = axes(rows, "v")
    width = len(middle)
    cells = int((wide[:cells] > 3 * eps).sum())
    names = [f"c{i}" for i in range(cells)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = (matrix_of(batch.column("v"), width) - middle) @ turn[:, :cells]
            # A little wider than eps: coordinates are rounded.
            at = np.floor(v / (eps * (1 + 1e-9) + 1e-12)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "v")), *map(pa.array, at.T)], ["id", "n", "v", *names])

    turned = rows.select("id", "n", "v").mapInArrow(run, f"id long, n long, v {rows.schema['v'].dataType.simpleString()}" + "".join(f", {c} long" for c in names))
    turned = stored(turned, "turned")
    # Half of the cells around one, so that two cells meet in one of them only.
    steps = [s for s in product((-1, 0, 1), repeat=cells) if s > (0,) * cells]
    here = F.array(*names) if cells else F.array().cast("array<long>")
    spots = [F.struct(here.alias("cell"), F.lit(True).alias("home"))]
    spots += [F.struct(F.array(*(F.col(c) - s for c, s in zip(names, step, strict=True))).alias("cell"), F.lit(False).alias("home")) for step in steps]
    every = turned.withColumn("at", F.explode(F.array(*spots)))
    held = every.select("at").groupBy("at.cell").agg(F.count("*").alias("rows"), F.max("at.home").alias("lived_in"))
    known = stored(held.filter("lived_in").select("cell", F.ceil(F.col("rows") / tile).alias("tiles")), "cells")
    cut = every.select("id", "n", "v", "at.cell", "at.home").join(known, "cell")
    cut = cut.withColumn("own", F.pmod(F.xxhash64("id"), "tiles")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    cut = cut.select("cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "home", "id", "n", "v")
    return Join(cut.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi"), middle, turn, eps)


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Met:
    """Rows of one meeting, and how many pairs of them were compared."""

    def __init__(self, v: np.ndarray, join: tuple[np.ndarray, np.ndarray, float], cross_only: bool, own: np.ndarray, home: np.ndarray):
        middle, turn, eps = join
        turned = (v - middle) @ turn
        lead = turned[:, :LEADING]
        rest = np.sqrt((turned[:, LEADING:] ** 2).sum(1))
        key = lead[:, min(2, lead.shape[1] - 1)] if lead.shape[1] else rest
        self.order = np.argsort(key, kind="stable")
        self.v, self.own, self.home = v[self.order], own[self.order], home[self.order]
        self.box = np.concatenate([lead, rest[:, None]], axis=1)[self.order]
        self.eps, self.cross_only, self.compared = eps, cross_only, 0

    def allowed(self, strip: int, at: np.ndarray) -> int:
        """How many pairs the first ``strip`` of the rows ``at`` make with later ones, without pairs of visitors and, of two tiles, those of one."""

        def both(mask: np.ndarray) -> int:
            k, r = int(mask[:strip].sum()), int(mask[strip:].sum())
            return k * (k - 1) // 2 + k * r

        out, own = ~self.home[at], self.own[at]
        found = both(np.ones(len(at), bool)) - both(out)
        if self.cross_only:
            found -= sum(both(own == o) - both((own == o) & out) for o in np.unique(own))
        return found

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, distance) of rows at most eps apart, each pair once, by places in the given order."""
        starts = np.arange(0, len(self.v), STRIP)
        low, high = np.minimum.reduceat(self.box, starts, axis=0), np.maximum.reduceat(self.box, starts, axis=0)
        square = (self.v**2).sum(1)
        with_half, with_square = np.concatenate([self.v, np.full((len(self.v), 1), -0.5)], 1), np.concatenate([self.v, square[:, None]], 1)
        for s, a in enumerate(starts.tolist()):
            gap = np.maximum(0, np.maximum(low[s:] - high[s], low[s] - high[s:]))
            near = s + np.flatnonzero((gap**2).sum(1) <= (self.eps * (1 + 1e-9)) ** 2 + 1e-12)
            j_all = np.concatenate([np.arange(starts[t], min(starts[t] + STRIP, len(self.v))) for t in near.tolist()])
            i_all = np.arange(a, min(a + STRIP, len(self.v)))
            self.compared += self.allowed(len(i_all), j_all)
            slack = 1e-9 * (square[i_all].max(initial=0) + square[j_all].max(initial=0) + self.eps**2)
            # |x - y|^2 <= eps^2 as one product with a column more: x y - y^2 / 2 >= (x^2 - eps^2) / 2.
            i, j = np.nonzero(with_half[i_all] @ with_square[j_all].T >= (square[i_all][:, None] - self.eps**2 - slack) / 2)
            i, j = i_all[i], j_all[j]
            may = (i < j) & (self.home[i] | self.home[j])
            if self.cross_only:
                may &= self.own[i] != self.own[j]
            i, j = i[may], j[may]
            for k in range(0, len(i), 1 << 16):
                x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                d = np.sqrt(((self.v[x] - self.v[y]) ** 2).sum(1))
                keep = d <= self.eps
                yield self.order[x[keep]], self.order[y[keep]], d[keep]


def meetings(join: Join, schema: str, made: Callable[[np.ndarray, np.ndarray, Met], pa.RecordBatch]) -> DataFrame:
    """``made`` (ids, weights, met) of every meeting."""
    how = join.middle, join.turn, join.eps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            ends = whole_runs(held)
            for a, b in zip([0, *ends], ends, strict=False):
                yield one(held.slice(a, b - a))
            held = held.slice(ends[-1]) if ends else held
        if held is not None and held.num_rows:
            yield one(held)

    def one(run: pa.RecordBatch) -> pa.RecordBatch:
        own, home, ids, n = (run.column(c).to_numpy(zero_copy_only=False) for c in ("own", "home", "id", "n"))
        return made(ids, n, Met(matrix_of(run.column("v"), len(how[0])), how, run.column("lo")[0] != run.column("hi")[0], own, home))

    return join.meet.mapInArrow(run, schema)


def whole_runs(batch: pa.RecordBatch) -> list[int]:
    """Where runs of equal (cell, lo, hi) end; the last run is left out, since it may go on."""
    lo, hi = batch.column("lo").to_numpy(), batch.column("hi").to_numpy()
    cell = matrix_of(batch.column("cell"), int(np.diff(batch.column("cell").offsets.to_numpy()).max(initial=0))).astype(np.int64)
    new = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (cell[1:] != cell[:-1]).any(1)
    return (np.flatnonzero(new) + 1).tolist()


def neighbours(df: DataFrame, row: str, vector: str, eps: float, tile: int = 16384) -> DataFrame:
    """(a, b, d): all pairs a < b of rows at a distance of at most ``eps``. Rows need vectors of one width.

    There are as many rows as pairs: clusters are made from counts and forests instead.
    """
    rows = df.select(F.col(row).cast("long").alias("id"), F.lit(1).cast("long").alias("n"), F.col(vector).cast("array<double>").alias("v"))

    def made(ids: np.ndarray, n: np.ndarray, met: Met) -> pa.RecordBatch:
        found = [*met.pairs(), (np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        i, j, d = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(d)], ["a", "b", "d"])

    return meetings(placed(sound(rows), eps, tile), "a long, b long, d double", made)


def sound(rows: DataFrame) -> DataFrame:
    """Rows whose vector v is there, and finite throughout."""
    return rows.filter(F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))


def counted(join: Join) -> DataFrame:
    """(id, near): weight of the other rows within ``eps`` of each row that has any; compared: pairs compared in the row's meeting (in one row of each)."""

    def made(ids: np.ndarray, n: np.ndarray, met: Met) -> pa.RecordBatch:
        near = np.zeros(len(ids), np.int64)
        for i, j, _ in met.pairs():
            np.add.at(near, i, n[j])
            np.add.at(near, j, n[i])
        compared = np.zeros(len(ids), np.int64)
        compared[:1] = met.compared
        some = (near > 0) | (compared > 0)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(near[some]), pa.array(compared[some])], ["id", "near", "compared"])

    return meetings(join, "id long, near long, compared long", made).groupBy("id").agg(F.sum("near").alias("near"), F.sum("compared").alias("compared"))


def forest(join: Join) -> DataFrame:
    """Edges (u, v) that join all rows within ``eps`` of each other: a spanning forest of each meeting."""

    def made(ids: np.ndarray, n: np.ndarray, met: Met) -> pa.RecordBatch:
        root = np.arange(len(ids))
        for i, j, _ in met.pairs():
            joined(root, i, j)
        child = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[root[child]])], ["u", "v"])

    return meetings(join, "u long, v long", made)


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let ``root`` (each row's smallest so far, flat) join the sets of a and b."""
    while len(a):
        x, y = root[a], root[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def density_clusters(df: DataFrame, row: str, vector: str, eps: float, min_samples: int = 6, min_cluster_size: int = 10, tile: int = 16384) -> DataFrame:
    """(id, label): cluster number from 0, largest cluster first, or -1. Equal vectors are compared once and count as often as they occur.

    Vectors need one width; those that are null or hold null or non-finite numbers are noise.
    """
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"  # floats are sent as such, and compared as doubles
    keyed = df.select(F.col(row).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"))
    keyed = keyed.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})  # 128 bits stand for a vector
    nodes = stored(sound(keyed).groupBy("h1", "h2", "v").agg(F.min("id").alias("id"), F.count("*").alias("n")), "nodes")
    near = counted(placed(nodes, eps, tile))
    core = stored(nodes.join(near, "id", "left").filter(F.col("n") + F.coalesce("near", F.lit(0)) >= min_samples).select("id", "n", "v", "h1", "h2"), "core")
    roots = components(forest(placed(core, eps, tile)))
    member = core.join(roots, core.id == roots.node, "left").select("h1", "h2", "n", F.coalesce("root", "id").alias("root"))
    sizes = member.groupBy("root").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_cluster_size)
    numbered = sizes.select("root", (F.row_number().over(W.orderBy(F.desc("n"), "root")) - 1).alias("label"))  # clusters, not rows
    named = stored(member.join(numbered, "root").select("h1", "h2", "label"), "labels")
    return dealt(keyed.select("id", "h1", "h2"), named, ["h1", "h2"]).select("id", F.coalesce("label", F.lit(-1)).alias("label"))


def attach(df: DataFrame, clusters: DataFrame, keys: list[str]) -> DataFrame:
    """Cluster results by row or by (feature, group); rows that were not clustered have nulls."""
    return df.join(clusters, keys, "left")


def centroids(df: DataFrame, label: str, dims: list[str], name: str) -> DataFrame:
    """Centre and name of each cluster; noise and unclustered rows are left out."""
    known = df.filter(F.col(label).isNotNull() & (F.col(label) >= 0))
    return known.groupBy(label).agg(*(F.avg(d).alias(d) for d in dims), F.min(F.col(name).cast("string")).alias("name"), F.count("*").alias("n"))


def masked_categories(df: DataFrame, category: str, masked: Column) -> DataFrame:
    """(category, n, n_masked, state): whether a category's rows are masked fully, partly or not."""
    out = df.groupBy(category).agg(F.count("*").alias("n"), F.count_if(masked).alias("n_masked"))
    return out.withColumn("state", F.when(F.col("n_masked") == 0, "none").when(F.col("n_masked") == F.col("n"), "full").otherwise("partial"))
