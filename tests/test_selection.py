"""Operators that select, count or meet without holding a group: against their definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixloom.operators import cluster, differ, logo, scale, summarise
from matrixloom.operators.quantiles import quantiles
from matrixloom.operators.ranking import numbered

INF, NAN = math.inf, math.nan


def brute_neighbours(v, eps):
    d = np.sqrt(((v[:, None] - v[None, :]) ** 2).sum(2))
    return {(int(i), int(j)): d[i, j] for i, j in zip(*np.nonzero(np.triu(d <= eps, 1)))}


@pytest.mark.parametrize(("dims", "spread", "eps", "tile"), [(20, 1.0, 5.2, 4096), (3, 4.0, 0.9, 16), (1, 5.0, 0.05, 4096), (12, 0.2, 0.8, 20)])
def test_radius_join_finds_all_pairs(spark, dims, spread, eps, tile):
    v = spread * np.random.default_rng(1).standard_normal((300, dims))
    v[50:60] = v[40:50] + eps / math.sqrt(dims)  # at about the radius
    want = brute_neighbours(v, eps)
    assert 10 < len(want) < 300 * 299 / 2
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "i long, x array<double>")
    got = cluster.neighbours(rows, "i", "x", eps, tile).collect()
    assert len(got) == len(want) and {(r.a, r.b): pytest.approx(r.d) for r in got} == want


def test_radius_join_on_a_grid_is_exact(spark):
    v = np.array([(i, j) for i in range(12) for j in range(12)], float)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "i long, x array<double>")
    got = {(r.a, r.b) for r in cluster.neighbours(rows, "i", "x", 1.0, 8).collect()}
    assert got == brute_neighbours(v, 1.0).keys()


def test_radius_join_compares_a_small_part_of_spread_rows(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((60, 16)).repeat(40, axis=0) * 6 + 0.1 * rng.standard_normal((2400, 16))
    rows = spark.createDataFrame([(i, 1, x.tolist()) for i, x in enumerate(v)], "id long, n long, v array<double>")
    join = cluster.placed(rows, 1.5, 4096)
    out = cluster.counted(join).agg(F.sum("near").alias("near"), F.sum("compared").alias("compared")).first()
    assert out.near == 2 * len(brute_neighbours(v, 1.5)) and out.compared < 0.1 * 2400 * 2399 / 2
    assert join.meet.count() <= 5 * 2400  # a home and four cells next to it
    close = spark.createDataFrame([(i, 1, x.tolist()) for i, x in enumerate(0.01 * v)], "id long, n long, v array<double>")
    assert cluster.placed(close, 100.0, 300).meet.count() <= 5 * 2400 * math.ceil(2400 / 300)


def test_clusters_leave_out_unsound_vectors(spark):
    rows = [(i, [0.0, i / 100]) for i in range(6)] + [(10, None), (11, [NAN, 0.0]), (12, [None, 0.0]), (13, [INF, 0.0])]
    got = {r.id: r.label for r in cluster.density_clusters(spark.createDataFrame(rows, "i long, x array<double>"), "i", "x", 0.5, 3, 3).collect()}
    assert got == {**dict.fromkeys(range(6), 0), **dict.fromkeys(range(10, 14), -1)}


def want_quantiles(values, probabilities):
    v = np.sort(np.array([x for x in values if x is not None], float))
    if not len(v):
        return [None] * len(probabilities)
    out = []
    for p in probabilities:
        at = p * (len(v) - 1)
        low, high = math.floor(at), math.ceil(at)
        out.append(v[low] if low == high else (high - at) * v[low] + (at - low) * v[high])
    return out


@pytest.mark.parametrize(("limit", "bins"), [(1 << 17, 4096), (5, 4), (1, 2)])
def test_quantiles_match_sorting(spark, limit, bins):
    rng = random.Random(3)
    groups = {
        ("a", 1): [rng.gauss(0, 1) for _ in range(200)],
        ("a", 2): [10.0 ** rng.uniform(-200, 200) * rng.choice([1, -1]) for _ in range(60)],
        ("b", 1): [float(rng.randint(0, 3)) for _ in range(50)] + [None] * 5,
        ("b", 2): [-INF, -INF, 1.0, 2.0, 3.0, 4.0, 5.0, INF, INF, NAN],
        ("c", 1): [7.0],
        ("c", 2): [None, None],
        ("d", 1): [1e308 * x for x in (-1.7, -1.0, 0.0, 0.5, 1.0, 1.7, 1.2, 0.7)],
    }
    df = spark.createDataFrame([(k, g, x) for (k, g), v in groups.items() for x in v] + [(None, 1, 5.0)], "k string, g int, x double")
    p = [0.5, 0.0, 0.25, 0.75, 1.0, 0.9]
    got = {(r.k, r.g): r.q for r in quantiles(df, ["k", "g"], "x", p, limit=limit, bins=bins).collect()}
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        assert got[key] == pytest.approx(want_quantiles(values, p), nan_ok=True), key
    assert quantiles(df.limit(0), ["k"], "x", [0.5]).count() == 0


def test_no_median_buffer_in_plans(spark):
    df = spark.createDataFrame([("a", "g", 1, 2.0), ("b", "h", 2, 3.0)], "c string, g string, p int, v double")
    for out in (summarise.bars(df, "c", "g", "v"), summarise.radar(df, "c", "g", "v"), summarise.profile(df, "c", "p", "g", "v"), scale.robust_scaled(df, ["c"], "v")):
        plan = out._jdf.queryExecution().executedPlan().toString().lower()
        assert "percentile" not in plan and "median(" not in plan


def test_letters_are_counted_as_arrays(spark):
    alphabet = logo.Alphabet({"a": "A", "é": "E", " ": "-"}, "T", 5)
    rows = [("x", "Aa É\U0001f600aaa", 2.0), ("x", None, 3.0), (None, "a\nb" * 40, 0.5), ("y", "", None), ("y", "Éa", None)]
    df = spark.createDataFrame(rows, "k string, text string, w double")
    want, weighted = {}, {}
    for k, text, w in rows:
        for i, c in enumerate(text or ""):
            key = (k, i % 5, {"a": "A", "é": "E", " ": "-"}.get(c.lower(), "T"))
            want[key] = want.get(key, 0) + 1
            weighted[key] = weighted.get(key, 0) + (w or 0)
    counted = logo.letter_arrays(df, "text", alphabet)
    for most in (1, 4096):
        got = {(r.k, r.position, r.base): r.n for r in logo.letter_sums(counted, ["k"], alphabet, most=most).collect()}
        assert got == want
    got = {(r.k, r.position, r.base): r.n for r in logo.letter_sums(counted, ["k"], alphabet, "w").collect()}
    assert got == {k: v for k, v in weighted.items() if v}
    assert logo.letter_sums(counted, [], alphabet).agg(F.sum("n")).first()[0] == sum(want.values())
    assert logo.letter_sums(logo.letter_arrays(df.limit(0), "text", alphabet), ["k"], alphabet).count() == 0


def test_both_ends_leave_a_task_with_few_rows(spark):
    rng = random.Random(5)
    values = [float(rng.randint(-30, 30)) for _ in range(500)] + [None, None, NAN, INF, -INF]
    rows = [("a", rng.choice(["x", "y", None]), f"f{i:03}", v, 0.5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g1 string, g2 string, feature string, log2fc double, pval double").repartition(3)
    cut = differ.ends(df, ("g1", "g2"), "log2fc", "feature", 7)
    assert cut.count() <= 3 * 3 * 14
    level = lambda v: (0, 0) if v is None else (2, 0) if math.isnan(v) else (1, v)
    want = set()
    for g in ("x", "y", None):
        own = [(level(r[3]), r[2]) for r in rows if r[1] == g]
        up = sorted(own, key=lambda r: ((-r[0][0], -r[0][1]), r[1]))[:7]
        want |= {(g, f) for _, f in up + sorted(own)[:7]}
    got = differ.heatmap(df, 7).collect()
    assert len(got) == len(want) and {(r.g2, r.feature) for r in got} == want


def brute_tau(x, y):
    s, t = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return (s * t).sum() / np.sqrt((s * s).sum() * (t * t).sum())


@pytest.mark.parametrize(("size", "fan"), [(4, 2), (3, 5), (16, 256), (4096, 256)])
def test_kendall_by_levels(spark, size, fan):
    rng = np.random.default_rng(6)
    x, y = rng.integers(0, 60, 240), rng.integers(0, 25, 240)
    x[:40], y[100:160] = 7, 3  # values that fill blocks
    u, v = rng.permutation(90), rng.permutation(90)
    rows = [("a", "b", float(p), float(q)) for p, q in zip(x, y)] + [("a", "c", float(p), float(q)) for p, q in zip(u, v)] + [("a", "d", 1.0, float(q)) for q in range(5)]
    got = {r.g2: r.r for r in scale.kendall(spark.createDataFrame(rows, "g1 string, g2 string, x double, y double"), ["g1", "g2"], size, fan).collect()}
    assert got == {"b": pytest.approx(brute_tau(x, y)), "c": pytest.approx(brute_tau(u, v)), "d": None}


def test_kendall_of_a_million_ranks(spark):
    """Sorted by x, y is cut into runs of 1,000 turned around: only pairs inside a run are discordant."""
    n, run = 1_000_000, 1000
    rows = spark.range(n).select(F.lit("a").alias("g1"), F.lit("b").alias("g2"), F.col("id").cast("double").alias("x"), (F.floor(F.col("id") / run) * run + run - 1 - F.col("id") % run).cast("double").alias("y"))
    pairs = n * (n - 1) / 2
    want = (pairs - 2 * (n / run) * run * (run - 1) / 2) / pairs
    assert scale.kendall(rows, ["g1", "g2"]).first().r == pytest.approx(want, abs=1e-12)
    turned = rows.withColumn("y", -F.col("y"))
    assert scale.kendall(turned, ["g1", "g2"]).first().r == pytest.approx(-want, abs=1e-12)


def test_natural_order_of_long_numbers(spark):
    names = ["a-5", "a-3000000000", "a-30000000000000000000", "a-x", "a-", "b-1", "a-1-2"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    want = ["a-", "a-x", "a-5", "a-3000000000", "a-30000000000000000000", "a-1-2", "b-1"]
    assert [r.f for r in df.orderBy(*summarise.natural_order("f")).collect()] == want
    assert [r.f for r in summarise.natural_places(df, "f").orderBy("place").collect()] == want
    for few in (0, 100):
        assert [r.f for r in numbered(df, summarise.natural_order("f"), few=few).orderBy("place").collect()] == want


def test_pca_by_iteration_needs_no_wide_table(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((80, 6)) @ (np.array([9, 7, 5, 4, 3, 2])[:, None] * rng.standard_normal((6, 150))) + 0.3 * rng.standard_normal((80, 150))
    long = spark.createDataFrame([(i, f"c{j}", float(v)) for i, r in enumerate(x) for j, v in enumerate(r)], "i int, c string, v double")
    loadings, variances = scale.pca_by_iteration(long, "i", "c", "v", 4)
    z = (x - x.mean(0)) / x.std(0)
    level, vectors = np.linalg.eigh(np.cov(z.T))
    got = {r.component: r for r in variances.collect()}
    for j in range(4):
        assert got[j + 1].variance == pytest.approx(level[-1 - j], rel=1e-7) and got[j + 1].ratio == pytest.approx(level[-1 - j] / level.sum(), rel=1e-7)
        own = {r["column"]: r.loading for r in loadings.filter(F.col("component") == j + 1).collect()}
        want = vectors[:, -1 - j] * np.sign(vectors[np.abs(vectors[:, -1 - j]).argmax(), -1 - j])
        assert np.array([own[f"c{i}"] for i in range(150)]) == pytest.approx(want, abs=1e-4)
    left = {r.component: r.residual for r in scale.residuals(long, "i", "c", "v", loadings, variances).collect()}
    assert max(left.values()) < 1e-4 * level[-1]
    with pytest.raises(ValueError):
        scale.pca_by_iteration(long, "i", "c", "v", 4, more=0, tolerance=1e-12, rounds=2)
