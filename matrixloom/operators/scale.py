"""Correlation, scaling and principal components."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import stored
from .quantiles import quantiles


def group_means(df: DataFrame, feature: str, group: str, value: str, least: float | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., feature, g, v): mean value by feature and group; nothing (within ``by``, as of a read type) if no mean reaches ``least``."""
    means = df.dropna(subset=[*by, feature, group]).groupBy(*by, feature, group).agg(F.avg(value).alias("v")).withColumnRenamed(group, "g")
    if least is None:
        return means
    top = means.groupBy(*by).agg(F.max("v").alias("most")).filter(F.col("most") >= least)
    return means.join(top.select(*by), list(by), "left_semi") if by else means.crossJoin(top).drop("most")  # one row


def measure_means(df: DataFrame, feature: str, group: str, measures: list[str], least: float, by: str) -> DataFrame:
    """``group_means`` within each of several measures in columns, named in ``by``. They are averaged side by side and become rows afterwards."""
    wide = df.dropna(subset=[feature, group]).groupBy(feature, F.col(group).alias("g")).agg(*(F.avg(m).alias(m) for m in measures))
    means = stored(wide, "means")
    most = means.agg(*(F.max(m).alias(m) for m in measures)).first()  # one row
    high = [m for m in measures if most[m] is not None and most[m] >= least]
    if not high:
        return means.select(F.lit("").alias(by), feature, "g", F.lit(0.0).alias("v")).limit(0)
    return means.select(feature, "g", *high).unpivot([feature, "g"], high, by, "v").select(by, feature, "g", "v")


def paired(means: DataFrame, feature: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., g1, g2, x, y): values of every pair of groups g1 <= g2 on the features that both have."""
    few = means.filter(F.col(feature).isNotNull()).groupBy(*by, feature).agg(F.collect_list(F.struct("g", "v")).alias("all_"))  # a feature has few groups
    pairs = F.flatten(F.transform("all_", lambda a: F.transform(F.filter("all_", lambda b: a["g"] <= b["g"]), lambda b: F.struct(a["g"].alias("g1"), b["g"].alias("g2"), a["v"].alias("x"), b["v"].alias("y")))))
    return few.select(*by, feature, F.inline(pairs))


def correlations(means: DataFrame, feature: str, method: str = "pearson", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., g1, g2, r, r2) of every pair of groups, on pairwise complete features."""
    keys = [*by, "g1", "g2"]
    pairs = paired(means, feature, by).filter("x is not null and y is not null")
    if method == "kendall":
        return kendall(pairs, keys)
    if method == "spearman":
        pairs = stored(pairs, "pairs")
        for c in ("x", "y"):
            places = below(pairs.groupBy(*keys, c).agg(F.count("*").alias("n")), keys, c)
            pairs = pairs.join(places.select(*keys, c, (F.col("below") + (F.col("n") + 1) / 2).alias(f"r{c}")), [*keys, c])
        pairs = pairs.select(*keys, F.col("rx").alias("x"), F.col("ry").alias("y"))
    elif method != "pearson":
        raise ValueError(f"no such method: {method}")
    return pairs.groupBy(*keys).agg(F.corr("x", "y").alias("r")).withColumn("r2", F.col("r") * F.col("r"))


def below(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``counts`` (keys, value: distinct, n) with ``below``: how many of the same keys have smaller values.

    Values are dealt by range; sums within ranges are added to those of the ranges before, so no key's values meet in one task.
    """
    dealt = stored(counts.repartitionByRange(*keys, value).withColumn("range_", F.spark_partition_id()), "ranges")
    def before(order: str, *within: str) -> Column:
        return F.coalesce(F.sum("n").over(W.partitionBy(*keys, *within).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    totals = dealt.groupBy(*keys, "range_").agg(F.sum("n").alias("n"))
    offsets = totals.select(*keys, "range_", before("range_").alias("offset_"))  # a row a range
    inside = dealt.withColumn("inside_", before(value, "range_"))
    return inside.join(offsets, [*keys, "range_"]).withColumn("below", F.col("inside_") + F.col("offset_")).drop("range_", "inside_", "offset_")


def inversions(y: np.ndarray, n: np.ndarray) -> int:
    """Sum of n[i] * n[j] over i < j with y[i] > y[j], by merging sorted halves of all widths at once."""
    rank = np.unique(y, return_inverse=True)[1]
    total, width = 0, 1
    where = np.arange(len(rank))
    while width < len(rank):
        block = where // (2 * width)
        order = np.lexsort((rank, block))
        left = (order // width) % 2 == 0
        # Of each right element: the weight of the left ones of its block that are larger.
        weight = np.where(left, n[order], 0)
        seen = np.cumsum(weight)
        group = block[order] * (len(rank) + 1) + rank[order]
        last = np.searchsorted(group, group, "right") - 1  # equal ones count as seen
        end = np.searchsorted(block[order], block[order], "right") - 1
        total += int((n[order] * (seen[end] - seen[last]))[~left].sum())
        width *= 2
    return total


def kendall(pairs: DataFrame, keys: list[str], size: int = 4096, fan: int = 256) -> DataFrame:
    """Kendall's tau-b. Discordant pairs are counted by a merge sort over blocks of about ``size`` ranks of x.

    Blocks form a tree with ``fan`` children a node. Pairs of one block are counted by inversions; pairs of two blocks meet at one level
    of the tree, where a node's points are sorted by y: into chunks of about ``size``, counted by inversions of the child's number inside, and
    between chunks from the chunks' counts by child. Each level handles each point once and has fan / size counts a point, so the work
    is n log n. A value that fills a block or chunk is one of its own, and has no inversions.
    """
    points = stored(pairs.groupBy(*keys, "x", "y").agg(F.count("*").alias("n")), "points")
    blocks = with_block(points.groupBy(*keys, "x").agg(F.sum("n").alias("n")), keys, "x", size)
    placed = stored(points.join(blocks.withColumnsRenamed({"block": "bx", "alone": "ax"}), [*keys, "x"]), "placed")
    most = placed.agg(F.max("bx")).first()[0] or 0
    # A block of one value has no inversions and may be of any size.
    parts = [discordant(placed.filter("not ax"), keys, ["bx"], "x")]
    width = 1
    while width <= most:
        node = placed.withColumn("node", F.floor(F.col("bx") / (width * fan))).withColumn("child", F.floor(F.col("bx") / width) % fan)
        parts += merged(node.groupBy(*keys, "node", "child", "y").agg(F.sum("n").alias("n")), keys, size, fan)
        width *= fan
    against = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("d").alias("discordant"))

    def ties(*by: str) -> DataFrame:
        return points.groupBy(*keys, *by).agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("_".join(["ties", *by])))

    out = ties()
    for part in (against, ties("x"), ties("y"), ties("x", "y")):
        out = out.join(part, keys, "left")
    both = F.col("ties") - F.col("ties_x") - F.col("ties_y") + F.col("ties_x_y")  # concordant and discordant
    tau = F.try_divide(both - 2 * F.coalesce("discordant", F.lit(0)), F.sqrt(F.col("ties") - F.col("ties_x")) * F.sqrt(F.col("ties") - F.col("ties_y")))
    return out.select(*keys, tau.alias("r")).withColumn("r2", F.col("r") * F.col("r"))


def with_block(counts: DataFrame, keys: list[str], value: str, size: int) -> DataFrame:
    """(keys, value, block, alone): blocks of about ``size`` in the order of values; ``alone``: the value has one to itself."""
    places = below(counts, keys, value)
    alone = F.col("n") > size
    return places.select(*keys, value, (2 * F.floor(F.col("below") / size) + alone.cast("int")).alias("block"), alone.alias("alone"))


def discordant(points: DataFrame, keys: list[str], block: list[str], x: str) -> DataFrame:
    """(keys, d): pairs within blocks that x and y order differently. Blocks are bounded."""

    def count(table: pa.Table) -> pa.Table:
        rows = table.sort_by([(x, "ascending"), ("y", "ascending")])
        found = inversions(rows["y"].to_numpy(), rows["n"].to_numpy())
        return pa.table({**{k: table[k].slice(0, 1) for k in keys}, "d": pa.array([found], pa.int64())})

    schema = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys) + ", d long"
    return points.groupBy(*keys, *block).applyInArrow(count, schema)


def merged(points: DataFrame, keys: list[str], size: int, fan: int) -> list[DataFrame]:
    """(keys, d): discordant pairs of different children of a node, of points (keys, node, child, y, n)."""
    inner = [*keys, "node"]
    points = stored(points, "level")
    chunks = with_block(points.groupBy(*inner, "y").agg(F.sum("n").alias("n")), inner, "y", size)
    dealt = stored(points.join(chunks.withColumnRenamed("block", "chunk"), [*inner, "y"]), "chunks")
    within = discordant(dealt.filter("not alone"), keys, ["node", "chunk"], "child")
    cells = dealt.groupBy(*inner, "chunk", "child").agg(F.sum("n").alias("c"))
    # Of each chunk a row a child up to the last one, so that sums over lower chunks reach every cell.
    last = cells.groupBy(*inner).agg(F.max("child").alias("last"))
    grid = cells.select(*inner, "chunk").distinct().join(last, inner).withColumn("child", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last")
    full = grid.join(cells, [*inner, "chunk", "child"], "left").fillna(0, ["c"])
    # Of each cell: the points of lower chunks and higher children.
    lower = F.coalesce(F.sum("c").over(W.partitionBy(*inner, "child").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    higher = F.coalesce(F.sum("lower").over(W.partitionBy(*inner, "chunk").orderBy(F.desc("child")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    across = full.withColumn("lower", lower).withColumn("higher", higher).filter("c > 0")
    return [within, across.groupBy(*keys).agg(F.sum(F.col("c") * F.col("higher")).alias("d"))]


def standard_scaled(long: DataFrame, column: str, value: str) -> DataFrame:
    """Each column to mean 0 and population deviation 1; a constant column to 0."""
    stats = long.groupBy(column).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    scaled = (F.col(value) - F.col("mean")) / F.when(F.col("sd") == 0, 1.0).otherwise(F.col("sd"))
    return long.join(stats, column).withColumn("scaled", scaled).drop("mean", "sd")


def robust_scaled(long: DataFrame, columns: list[str], value: str) -> DataFrame:
    """Each column less its median, over its interquartile range (1 if that is 0); quantiles are exact."""
    stats = quantiles(long, columns, value, [0.25, 0.5, 0.75])
    wide = F.col("q")[2] - F.col("q")[0]
    scaled = (F.col(value) - F.col("q")[1]) / F.when(wide == 0, 1.0).otherwise(wide)
    return long.join(stats, columns).withColumn("scaled", scaled).drop("q")


def pca(long: DataFrame, row: str, column: str, value: str, columns: list, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """Loadings (column, component, loading) and variances (component, ratio, variance) of the standard-scaled matrix.

    The largest loading of each component is positive. ``columns`` are the matrix's columns: their number is bounded by the
    method, which gathers a column-by-column covariance.
    """
    k = min(k, len(columns))
    scaled = standard_scaled(long, column, value)
    wide = scaled.groupBy(row).pivot(column, columns).agg(F.first("scaled")).na.drop()
    vectors = wide.select(array_to_vector(F.array(*(F.col(f"`{c}`") for c in columns))).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
    matrix, ratio = model.pc.toArray(), model.explainedVariance.toArray()
    spark = long.sparkSession
    flip = [1 if matrix[abs(matrix[:, j]).argmax(), j] >= 0 else -1 for j in range(k)]
    loadings = [(str(c), j + 1, float(matrix[i, j] * flip[j])) for i, c in enumerate(columns) for j in range(k)]
    variance = scaled.groupBy(column).agg(F.var_samp("scaled").alias("v")).agg(F.sum("v").alias("total"))
    parts = spark.createDataFrame([(j + 1, float(ratio[j])) for j in range(k)], "component int, ratio double")
    return spark.createDataFrame(loadings, "column string, component int, loading double"), parts.crossJoin(variance).select("component", "ratio", (F.col("ratio") * F.col("total")).alias("variance"))


def pca_by_iteration(long: DataFrame, row: str, column: str, value: str, k: int = 5, more: int = 8, tolerance: float = 1e-6, rounds: int = 200) -> tuple[DataFrame, DataFrame]:
    """``pca`` for any number of columns: block power iteration on the long matrix, with ``more`` vectors than asked for.

    A round multiplies the block by the covariance, which is a join on columns and one on rows, and turns it to its own principal
    directions; only the block's inner products, a matrix of k + more, reach the driver. It ends when |C v - lambda v| of the first ``k`` is at most
    ``tolerance`` times the largest lambda, and fails after ``rounds``. Rows need a value in every column. A column's loading is found
    under its name as a string.
    """
    scaled = standard_scaled(long.withColumn(column, F.col(column).cast("string")), column, value).select(F.col(row).alias("row_"), F.col(column).alias("column"), F.col("scaled").alias("z"))
    scaled = stored(scaled, "scaled")
    n_rows, n_columns, squares = scaled.agg(F.count_distinct("row_"), F.count_distinct("column"), F.sum(F.col("z") * F.col("z"))).first()
    size = min(k + more, n_columns)
    start = F.array(*(F.xxhash64("column", F.lit(i)) / F.lit(2.0**63) for i in range(size)))
    block = scaled.select("column").distinct().withColumn("q", start)
    turn, settled = np.eye(size), False
    for at in range(rounds):
        q = block if at == 0 else turned(block, turn)
        scores = scaled.join(q, "column").groupBy("row_").agg(F.array(*(F.sum(F.col("z") * F.col("q")[i]) for i in range(size))).alias("y"))
        images = scaled.join(scores, "row_").groupBy("column").agg(F.array(*(F.sum(F.col("z") * F.col("y")[i]) / (n_rows - 1) for i in range(size))).alias("w"))
        block = stored(images.join(q, "column"), "block")
        products, along = inner_products(block, size)
        if at:
            left = np.sqrt(np.maximum(0, np.diag(products) - along**2))
            settled = bool((left[:k] <= tolerance * along[0]).all())
        if settled:
            break
        level, vectors = np.linalg.eigh(products)
        keep = level > level[-1] * 1e-24
        turn = np.where(keep, vectors / np.sqrt(np.where(keep, level, 1.0)), 0.0)[:, ::-1]
    if not settled:
        raise ValueError(f"no convergence in {rounds} rounds")
    k = min(k, size)
    spark = long.sparkSession
    firsts = block.select("column", F.posexplode(F.slice("q", 1, k)).alias("at", "loading"))
    sign = firsts.groupBy("at").agg(F.max_by(F.signum("loading"), F.struct(F.round(F.abs("loading"), 9), "column")).alias("sign"))
    loadings = firsts.join(F.broadcast(sign), "at").select("column", (F.col("at") + 1).alias("component"), (F.col("loading") * F.when(F.col("sign") < 0, -1.0).otherwise(1.0)).alias("loading"))
    total = squares / (n_rows - 1)
    variances = spark.createDataFrame([(j + 1, float(along[j] / total), float(along[j])) for j in range(k)], "component int, ratio double, variance double")
    return loadings, variances


def turned(block: DataFrame, turn: np.ndarray) -> DataFrame:
    """(column, q): w times ``turn``."""

    def run(batches):
        for batch in batches:
            w = batch.column("w").flatten().to_numpy().reshape(-1, len(turn))
            offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * len(turn))
            yield pa.RecordBatch.from_arrays([batch.column("column"), pa.ListArray.from_arrays(offsets, pa.array((w @ turn).ravel()))], ["column", "q"])

    return block.select("column", "w").mapInArrow(run, "column string, q array<double>")


def inner_products(block: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All w_i w_j, and q_i w_i; a task gives one row a product."""

    def run(batches):
        total = np.zeros((size + 1, size))
        for batch in batches:
            w, q = (batch.column(c).flatten().to_numpy().reshape(-1, size) for c in ("w", "q"))
            total += np.concatenate([w.T @ w, (q * w).sum(0)[None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "p"])

    out = np.zeros((size + 1) * size)
    for r in block.select("w", "q").mapInArrow(run, "at long, p double").groupBy("at").agg(F.sum("p").alias("p")).collect():
        out[r["at"]] = r["p"]
    return out.reshape(size + 1, size)[:size], out[size * size :]


def residuals(long: DataFrame, row: str, column: str, value: str, loadings: DataFrame, variances: DataFrame) -> DataFrame:
    """(component, residual): the largest |C v - lambda v| over a component's columns, C being the covariance of the standard-scaled matrix.

    Two joins with the loadings; neither C nor a row of the matrix is made.
    """
    scaled = standard_scaled(long, column, value).withColumn("column", F.col(column).cast("string")).select(row, "column", "scaled")
    scores = scaled.join(loadings, "column").groupBy(row, "component").agg(F.sum(F.col("scaled") * F.col("loading")).alias("score"))
    number = scaled.agg(F.count_distinct(row).alias("rows_"))  # one row
    image = scaled.join(scores, row).groupBy("component", "column").agg(F.sum(F.col("scaled") * F.col("score")).alias("image"))
    both = image.join(loadings, ["component", "column"]).join(variances, "component").crossJoin(number)
    return both.groupBy("component").agg(F.max(F.abs(F.col("image") / (F.col("rows_") - 1) - F.col("variance") * F.col("loading"))).alias("residual"))


def embedded(df: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """``df`` with d1 ... dk: its vectors' projection on their first k principal components, signs fixed by the largest loading."""
    rows = df.withColumn("v_", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=k, inputCol="v_", outputCol="p_").fit(rows)
    matrix = model.pc.toArray()
    signs = [1.0 if matrix[abs(matrix[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    out = model.transform(rows).withColumn("a_", vector_to_array("p_"))
    return out.withColumns({f"d{j + 1}": F.col("a_")[j] * signs[j] for j in range(k)}).drop("v_", "p_", "a_")
