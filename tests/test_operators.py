import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixloom.functions import positions
from matrixloom.functions.stats import minus_log10, with_t_test
from matrixloom.operators import checks, cluster, differ, logo, matrix, merge, scale, select, summarise
from matrixloom.operators.components import components
from matrixloom.plans import build
from matrixloom.sources import runs


def test_t_test_values(spark):
    # p for given t and degrees of freedom: t = 2 with 4, t = 12.706 with 1, t = 1.96 with 5000.
    rows = [(2.0, 3), (12.706204736432095, 1.5), (1.96, 2501)]
    got = []
    for t, n in rows:
        sd = 1.0
        d = t * math.sqrt(2 * sd * sd / n)
        df = spark.createDataFrame([(d, 0.0, sd, float(n))], "m1 double, m2 double, s double, n double")
        got.append(with_t_test(df, *(F.col(c) for c in ("m1", "s", "n", "m2", "s", "n"))).first().pval)
    assert got[0] == pytest.approx(0.116116523516816, rel=1e-9)
    assert got[1] == pytest.approx(0.05, rel=1e-6)
    assert got[2] == pytest.approx(0.05005, abs=2e-5)


def test_zero_variance_and_zero_p(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0, 3.0), (1.0, 1.0, 0.0, 3.0)], "a double, b double, s double, n double")
    p = [r.pval for r in with_t_test(df, F.col("a"), F.col("s"), F.col("n"), F.col("b"), F.col("s"), F.col("n")).collect()]
    assert p == [0.0, None]
    assert spark.range(1).select(minus_log10(F.lit(0.0)).alias("x")).first().x == math.inf


def test_fold_change_is_antisymmetric_and_needs_complete_groups(spark):
    rows = [("f", g, v) for g, vs in {"a": [1, 2, 3], "b": [4, 5, 9]}.items() for v in vs] + [("h", "a", 5.0), ("h", "b", 1.0), ("h", "b", 2.0)]
    df = spark.createDataFrame([(f, g, float(v)) for f, g, v in rows], "f string, g string, v double")
    out = differ.log2fc(df, "f", "g", "v", 0).collect()
    assert [(r.feature, r.g1, r.g2) for r in out] == [("f", "a", "b")]  # h has one row in a, so no deviation
    assert out[0].log2fc == pytest.approx(math.log2(6 / 2))
    swapped = df.withColumn("g", F.when(F.col("g") == "a", "z").otherwise(F.col("g")))
    assert differ.log2fc(swapped, "f", "g", "v", 0).first().log2fc == pytest.approx(-math.log2(6 / 2))


def test_positions():
    assert positions.labels()[:2] == ["-1", "0"] and len(positions.labels()) == 1 + 77 + 3 + 19
    assert positions.region("27") == ("fiveprime_anticodonstem", "center")
    assert positions.region("27", compat=True) == (None, None)
    assert positions.region("17a") == ("dloop", "fiveprime") and positions.region("e20") == (None, None)
    assert positions.region("30a") == (None, None) and positions.region("e3") == ("extensionloop", "threeprime")


FRAGMENTS = [
    # fp, tp, total, mean 5', mean centre, mean 3', sd 5', sd centre, sd 3', stem 5', stem 3', sd
    ("low_coverage", 0, 0, 20, *[1] * 9),
    ("fiveprime_half", 50, 1, 60, 1, 5, 1, 2, 1, 1, 4, 1, 1),
    ("fiveprime_fragment", 50, 1, 60, 1, 9, 1, 2, 1, 1, 4, 1, 1),
    ("threeprime_half", 1, 50, 60, 1, 5, 1, 1, 1, 2, 1, 4, 1),
    ("threeprime_fragment", 1, 50, 60, 1, 9, 1, 1, 1, 2, 1, 4, 1),
    ("other_fragment", 10, 10, 60, 9, 5, 1, 1, 1, 1, 1, 1, 1),
    ("multiple_fragment", 10, 10, 60, 1, 1, 1, 1, 1, 1, 9, 1, 1),
    ("whole", 10, 10, 60, 1, 1, 1, 1, 1, 1, 1, 1, 1),
]


def test_fragment_classes(spark):
    names = "want fp tp total mean_fiveprime mean_center mean_threeprime sd_fiveprime sd_center sd_threeprime mean_stem5 mean_stem3 sd_all".split()
    df = spark.createDataFrame([(f[0], *map(float, f[1:])) for f in FRAGMENTS], names)
    assert all(r.want == r.fragment for r in matrix.fragment_class(df).collect())


def test_long_and_wide_round_trip(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, None)], "k int, a double, b double")
    long = matrix.to_long(df, ["k"], ["a", "b"])
    assert long.count() == 4
    wide = matrix.to_wide(long, ["k"], "coverage", "value", ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == [(1, 2.0, 3.0), (2, 4.0, None)]
    with pytest.raises(Exception, match="duplicate key: k="):
        matrix.to_wide(long.union(long), ["k"], "coverage", "value", ["a", "b"]).collect()


def test_name_checks():
    assert checks.metadata_names(["sample", "group", "x"], 3) == ["sample", "group", "x"]
    with pytest.warns(UserWarning):
        assert checks.metadata_names(["sample", "group"], 3) == ["sample", "group", "obs_0"]
    for bad in (["sample", "group", "amino"], ["sample", "group", "x", "x"], ["group", "sample"]):
        with pytest.raises(checks.CheckError):
            checks.metadata_names(bad)
    with pytest.raises(checks.CheckError):
        checks.run_info({"command": "run --nofrag"})
    with pytest.raises(checks.CheckError):
        checks.named({})


def test_row_checks(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string")
    with pytest.raises(checks.CheckError):
        checks.no_overlap(a, b, ["k"])
    with pytest.raises(checks.CheckError):
        checks.same_keys(a, b, ["k"])
    with pytest.raises(checks.CheckError):
        checks.dependent(a.union(b), "k", "v") or checks.dependent(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), "k", "v")
    with pytest.raises(checks.CheckError):
        checks.has_columns(a, ["nothing"])
    assert [tuple(r) for r in checks.null_report(a, ["k", "v"]).collect()] == [("v", 1)]
    assert [tuple(r) for r in checks.samples_with_nulls(a.withColumnRenamed("k", "sample"), ["v"]).collect()] == [(2, ["v"])]


def test_exclusion_without_inclusion(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    kept = select.rows(df, {"name": "n", "obs_r": {"g": ["a"]}})
    assert [r.g for r in kept.collect()] == ["b"]


def test_merge_commutes(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 1, 2.0)], "key string, sample int, value double")
    b = spark.createDataFrame([("y", 2, 3.0), ("z", 2, None)], "key string, sample int, value double")
    for drop in (False, True):
        left, right = (sorted(map(tuple, merge.counts(p, q, "key", "sample", "value", drop).collect())) for p, q in ((a, b), (b, a)))
        assert left == right
    assert left == [("y", 1, 2.0), ("y", 2, 3.0)]
    assert merge.schema_report(a, b.withColumn("extra", F.lit(1))) == (["key", "sample", "value"], ["extra"])


def test_peaks(spark):
    rows = [("s", i, v) for i, v in enumerate([0.2, 0.05, 0.3, 0.25, 0.0, 0.2])]
    got = summarise.peaks(spark.createDataFrame(rows, "k string, p int, share double"), ["k"], "p").orderBy("start").collect()
    assert [(r.start, r.end, r.label) for r in got] == [(0, 0, "0"), (2, 3, "2-3"), (5, 5, "5")]


def test_spearman_is_invariant_and_kendall_matches_definition(spark):
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 6, 40), rng.integers(0, 6, 40)
    rows = [(i, "a", float(v)) for i, v in enumerate(x)] + [(i, "b", float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "f int, g string, v double")
    cubed = df.withColumn("v", F.pow("v", 3))
    one, two = (scale.correlations(d, "f", "spearman").filter("g1 < g2").first().r for d in (df, cubed))
    assert one == pytest.approx(two)
    s = np.sign(x[:, None] - x[None, :]) * np.sign(y[:, None] - y[None, :])
    ties = np.sqrt((np.sign(x[:, None] - x[None, :]) ** 2).sum() * (np.sign(y[:, None] - y[None, :]) ** 2).sum())
    assert scale.correlations(df, "f", "kendall").filter("g1 < g2").first().r == pytest.approx(s.sum() / ties)


def test_pca_matches_eigenvalues(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4))
    rows = [(i, j, float(m[i, j])) for i in range(50) for j in range(4)]
    _, variance = scale.pca(spark.createDataFrame(rows, "r int, c int, v double"), "r", "c", "v", [0, 1, 2, 3], 3)
    z = (m - m.mean(0)) / m.std(0)
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    got = sorted(variance.collect(), key=lambda r: r.component)
    assert [r.ratio for r in got] == pytest.approx((values / values.sum())[:3].tolist())
    assert [r.variance for r in got] == pytest.approx(values[:3].tolist())


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_density_clusters_match_brute_force(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 0.2, (30, 3)), rng.normal(3, 0.2, (20, 3)), rng.uniform(-9, 9, (10, 3))])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = {r.id: r.label for r in cluster.density_clusters(spark.createDataFrame(rows, "i long, x array<double>"), "i", "x", 0.6, 5, 8).collect()}
    near = np.linalg.norm(v[:, None] - v[None, :], axis=2) <= 0.6
    core = np.flatnonzero(near.sum(1) >= 5)
    label = {int(i): int(i) for i in core}
    for _ in core:
        for i in core:
            label[int(i)] = min(label[int(j)] for j in core if near[i, j])
    groups = {}
    for i, r in label.items():
        groups.setdefault(r, []).append(i)
    big = sorted((g for g in groups.values() if len(g) >= 8), key=lambda g: (-len(g), g[0]))
    want = dict.fromkeys(range(len(v)), -1) | {i: n for n, g in enumerate(big) for i in g}
    assert got == want


def test_run_directory_to_dataset(spark, tmp_path):
    types = matrix.COVERAGE_TYPES
    features, samples = ["tRNA-Ala-AGC-1", "tRX-Gly-GCC-2"], ["s_1", "s_2"]
    spots = ["-1", "1", "17a", "30", "e20", "76"]
    lines = ["\t".join(["Feature", "Sample", "position", "actualbase", *types])]
    lines += ["\t".join([f, s, p, "A", *("4" if t == "adenines" else "2" for t in types)]) for f in features for s in samples for p in spots]
    (tmp_path / "x-coverage.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "sf.txt").write_text("s_1 s_2\n2.0 1.0\n")
    (tmp_path / "counts.txt").write_text("s_1\ts_2\n" + "\n".join(f"{f}_{r}\t30\t40" for f in features for r in ("fiveprime", "wholecounts")) + "\nGENE\t1\t2\n")
    (tmp_path / "meta.csv").write_text("sample,group\ns_1,g1\ns_2,g2\n")
    (tmp_path / "info.txt").write_text("git version\t1\ncommand\trun it\nnoise\n")
    ours, genes = runs.split_read_types(runs.row_named(spark, str(tmp_path / "counts.txt")))
    assert genes.count() == 2 and ours.count() == 8
    unique = ours.filter("feature <> 'tRX-Gly-GCC-2'")
    meta = runs.metadata(spark, str(tmp_path / "meta.csv"))
    tables = build.dataset(runs.coverage(spark, str(tmp_path / "x-coverage.txt")), runs.size_factors(spark, str(tmp_path / "sf.txt")), unique, ours, meta, "x")
    assert tables["x"].count() == 2 * 2 * 6 * 15
    halved = tables["x"].filter("coverage = 'adenines' and sample = 's_1'").select("value").distinct().collect()
    assert [r.value for r in halved] == [2.0]
    obs = {(r.feature, r["sample"]): r for r in tables["obs"].collect()}
    assert len(obs) == 4
    one = obs["tRNA-Ala-AGC-1", "s_1"]
    assert (one.pseudogene, one.amino, one.iso, one.group, one.id) == ("tRNA", "Ala", "AGC", "g1", "x_tRNA-Ala-AGC-1_s_1")
    assert one.total_unique_raw == 60 and one.total_unique_norm == 30 and one.total_all_raw == 120
    assert obs["tRX-Gly-GCC-2", "s_2"].total_unique_raw == 0
    assert runs.run_info(spark, str(tmp_path / "info.txt")).first().info == {"git version": "1", "command": "run it"}
    runs.save(tables, str(tmp_path / "out"), {"x": ["dataset", "coverage"]})
    again = runs.load(spark, str(tmp_path / "out"), list(tables))
    assert again["x"].count() == tables["x"].count()
    runs.export_csv({"obs": again["obs"]}, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/obs")).count() == 4
    assert runs.configuration(json.dumps({"name": "n"})) == {"name": "n"}


def test_cached_diff(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.createDataFrame([("f", "a", "b", 1.0, 0.5)], "feature string, g1 string, g2 string, log2fc double, pval double")

    path = str(tmp_path / "diff")
    for overwrite in (False, False, True):
        assert runs.cached_diff(spark, path, "default", "group", "total", 80, make, overwrite).count() == 1
    assert len(calls) == 2


def test_natural_places_cover_all_names(spark):
    names = [f"{p}-{i}" for p in "abc" for i in range(1, 301)] + ["c", "c-x"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "f string").repartition(7)
    got = [r.f for r in summarise.natural_places(df, "f").orderBy("place").collect()]
    assert got == ["c", *names[:600], "c-x", *names[600:900]]
    places = [r.place for r in summarise.natural_places(df, "f").collect()]
    assert sorted(places) == list(range(1, 903))


def test_natural_order(spark):
    df = spark.createDataFrame([("a-10",), ("a-2",), ("b-1",)], "f string")
    assert [r.f for r in df.orderBy(*summarise.natural_order("f")).collect()] == ["a-2", "a-10", "b-1"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "f string, g string, v double")
    assert differ.log2fc(none, "f", "g", "v", 0).count() == 0
    assert summarise.bars(none, "f", "g", "v").count() == 0
    assert scale.correlations(scale.group_means(none, "f", "g", "v"), "f").count() == 0


def test_clustered_plan(spark):
    rng = np.random.default_rng(4)
    rows = [(f"f{i}", c, float(rng.normal(10 * (i % 2), 0.1))) for i in range(40) for c in range(4)]
    out = build.clustered(spark.createDataFrame(rows, "f string, c int, v double"), ["f"], "c", "v", 0.5)
    labels = {r.f: r.label for r in out.collect()}
    assert len(labels) == 40 and len({labels[f"f{i}"] for i in range(0, 40, 2)}) == 1


def test_kendall_in_blocks(spark):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 30, 200), rng.integers(0, 12, 200)
    x[:70] = 7  # a value that fills blocks
    y[40:120] = np.where(rng.random(80) < 0.7, 3, y[40:120])
    pairs = spark.createDataFrame([("a", "b", float(p), float(q)) for p, q in zip(x, y)], "g1 string, g2 string, x double, y double")
    s, t = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    want = (s * t).sum() / np.sqrt((s * s).sum() * (t * t).sum())
    for size in (5, 16, 4096):
        assert scale.kendall(pairs, ["g1", "g2"], size).first().r == pytest.approx(want)


def test_places_below(spark):
    rows = [("a", v, v % 3 + 1) for v in range(50)] + [("b", v, 2) for v in range(7)]
    got = {(r.k, r.v): r.below for r in scale.below(spark.createDataFrame(rows, "k string, v int, n int"), ["k"], "v").collect()}
    assert got == {(k, v): sum(n for j, u, n in rows if j == k and u < v) for k, v, _ in rows}


def test_group_without_values_does_not_count(spark):
    rows = [("f", g, v) for g, vs in {"a": [1.0, 2.0, 3.0], "b": [4.0, 5.0, 9.0]}.items() for v in vs] + [("f", "c", None), (None, "d", 1.0)]
    out = differ.log2fc(spark.createDataFrame(rows, "f string, g string, v double"), "f", "g", "v", 0)
    assert [(r.g1, r.g2) for r in out.collect()] == [("a", "b")]
    flagged = differ.with_large(spark.createDataFrame([(1.0,), (-1.5,), (0.9,), (None,)], "log2fc double")).collect()
    assert [r.is_large for r in flagged] == [True, True, False, False]


def test_read_counts_of_missing_types_and_samples(spark):
    unique = spark.createDataFrame([("f", "fiveprime", "s1", 4.0), ("g", "threeprime", "s1", 6.0)], "feature string, readtype string, sample string, value double")
    every = spark.createDataFrame([("f", "fiveprime", "s1", 3.0), ("f", "fiveprime", "s2", 5.0), ("f", "other", "s1", 1.0)], unique.schema)
    factors = spark.createDataFrame([("s1", 2.0), ("s2", 1.0)], "sample string, size_factor double")
    got = {(r.feature, r["sample"], r.readtype): (r.unique_raw, r.unique_norm, r.all_raw, r.all_norm) for r in matrix.read_counts(unique, every, factors).collect()}
    assert got["f", "s1", "fiveprime"] == (4.0, 2.0, 6.0, 3.0) and got["f", "s2", "fiveprime"] == (None, None, 5.0, 5.0)
    assert got["f", "s1", "other"] == (0.0, 0.0, 2.0, 1.0) and got["f", "s2", "other"][3] is None
    assert got["g", "s1", "threeprime"] == (6.0, 3.0, 0.0, 0.0) and len(got) == 9
    obs = spark.createDataFrame([("h", "s1")], "feature string, sample string")
    totals = matrix.read_totals(matrix.read_counts(unique, every, factors, obs=obs), ["feature", "sample"]).collect()
    assert [tuple(r) for r in totals] == [("h", "s1", 0.0, 0.0, 0.0, 0.0)]


def test_blank_wins_over_gap(spark):
    cells = spark.createDataFrame([(p, b, float(n)) for p in (1, 2, 3) for b, n in zip("ACGT", [(9.0, 1, 1, 1), (1.0, 1, 1, 1), (9.0, 1, 1, 1)][p - 1])], "p int, base string, n double")
    ref = spark.createDataFrame([(1, "-", 1.0), (2, "-", 1.0), (3, "C", 1.0)], "p int, consensus string, share double")
    assert {r.p: r.consensus for r in logo.read_consensus(cells, ref, ["p"]).collect()} == {1: "-", 2: "", 3: "A"}


def test_logo_switches(spark):
    rows = [(f, p, positions.region(p)[0], "a" in p or "e" in p or p == "-1") for f in ("tRNA-Ala-AGC-1", "tRX-Gly-GCC-2") for p in ("-1", "1", "17a", "e3", "44", "e20", "75")]
    x = spark.createDataFrame(rows, "feature string, position string, location string, gap boolean")
    shown = lambda **o: sorted(r.position for r in logo.logo_entries(x, **o).filter("feature like 'tRNA%'").collect())
    assert shown() == ["1", "17a", "44", "e20", "e3"] and shown(drop_cca=False)[3] == "75"
    assert shown(size="noloop") == ["1", "17a", "44", "e20"] and shown(size="sprinzl") == ["1", "44"]
    assert logo.logo_entries(x, drop_pseudogenes=True).filter("feature like 'tRX%'").count() == 0
    assert logo.logo_entries(x, features=["tRX-Gly-GCC-2"]).select("feature").distinct().count() == 1
    with pytest.raises(ValueError):
        logo.logo_entries(x, "wide")


def test_region_values():
    spots = {n: positions.region(str(n)) for n in range(-1, 77)}
    assert [spots[n][0] for n in (10, 13, 22, 25)] == ["dstem"] * 4 and [spots[n][0] for n in (49, 53, 61, 65)] == ["tstem"] * 4
    assert {spots[n] for n in range(44, 49)} == {("anticodon_to_t_internal", "threeprime")} and spots[26] == ("d_to_anticodon_internal", "fiveprime")
    assert len({r[0] for r in spots.values()} | {"extensionloop"}) == 13


def test_metadata_is_padded_and_cut(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("sample\tgroup\ns1\tg1\tx\ns2\tg2\n")
    with pytest.warns(UserWarning):
        meta = runs.metadata(spark, str(tmp_path / "m.tsv"))
    assert meta.columns == ["sample", "group", "obs_0"] and sorted(map(tuple, meta.collect())) == [("s1", "g1", "x"), ("s2", "g2", None)]
    (tmp_path / "n.csv").write_text("sample,group,more\ns1,g1\n")
    with pytest.warns(UserWarning):
        assert runs.metadata(spark, str(tmp_path / "n.csv")).columns == ["sample", "group"]


def test_clusters_count_equal_vectors(spark):
    rows = [(i, [0.0, 0.0]) for i in range(4)] + [(10, [0.1, 0.0]), (11, [5.0, 5.0]), (12, [5.0, 5.0]), (13, None)]
    got = {r.id: r.label for r in cluster.density_clusters(spark.createDataFrame(rows[:-1], "i long, x array<double>"), "i", "x", 0.2, 4, 5).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 10: 0, 11: -1, 12: -1}
    assert cluster.density_clusters(spark.createDataFrame([], "i long, x array<double>"), "i", "x", 0.2).count() == 0


def test_cluster_levels(spark):
    rng = np.random.default_rng(7)
    x = [(f"tRNA-{i}", s, c, p, p == "17a", float(rng.normal(20 * (i % 2), 0.1))) for i in range(12) for s in ("s1", "s2") for c in ("uniquecoverage", "deletions", "coverage") for p in ("1", "2", "17a")]
    x = spark.createDataFrame(x, "feature string, sample string, coverage string, position string, gap boolean, value double")
    obs = [(f"tRNA-{i}", s, "g", "Und" if i == 11 else "Ala", 5.0 if i == 10 else 50.0, float(i % 2)) for i in range(12) for s in ("s1", "s2")]
    obs = spark.createDataFrame(obs, 'feature string, sample string, `group` string, amino string, total_unique_raw double, more double')
    out = build.cluster_levels({"x": x, "obs": obs}, {"sample": 0.5, "group": 0.5}, extra=["more"], levels={"sample": (2, 3), "group": (2, 3)})
    rows = {(r.feature, r["sample"]): r for r in out["obs"].collect()}
    assert len(rows) == 24 and rows["tRNA-10", "s1"].sample_cluster is None and rows["tRNA-11", "s1"].group_cluster is None
    for level in ("sample_cluster", "group_cluster"):
        even, odd = ({rows[f"tRNA-{i}", s][level] for i in range(k, 10, 2) for s in ("s1", "s2")} for k in (0, 1))
        assert len(even) == len(odd) == 1 and even != odd and -1 not in even | odd
    assert out["cluster_runinfo"].count() == 2
    with pytest.raises(checks.CheckError):
        build.cluster_levels(out, {"sample": 0.5, "group": 0.5})


def test_heatmap_csv(spark, tmp_path):
    heat = spark.createDataFrame([("f", "a", "b", 1.0, "x"), ("h", "a", "b", 2.0, "y")], "feature string, g1 string, g2 string, log2fc double, readtype string")
    build.heatmap_csv(heat, str(tmp_path / "h"))
    back = spark.read.option("header", True).csv(str(tmp_path / "h"))
    assert sorted((r.feature, r.readtype, r.of_readtype) for r in back.collect()) == [("f", "x", "x"), ("h", "y", "y")]


def test_bars_leave_out_aminos(spark):
    df = spark.createDataFrame([("p", "g", 1.0, "Ala"), ("q", "g", 3.0, "Und"), ("q", "g", 5.0, None)], "c string, g string, v double, amino string")
    assert {r.c: r.sum for r in summarise.bars(df, "c", "g", "v", excluded=("Und", "Sup")).collect()} == {"p": 1.0, "q": 5.0}


def test_cutoffs_and_fragments_hold_ties_whatever_the_last_digit(spark):
    # 0.1 + 0.2 is more than 0.3: sums in another order must not decide.
    rows = [("f", g, m + d) for g, m in (("a", 0.1), ("b", 0.2), ("c", 0.6)) for d in (-0.05, 0.05)]
    out = [differ.log2fc(spark.createDataFrame(r, "f string, g string, v double"), "f", "g", "v", 0.3).count() for r in (rows, rows[::-1])]
    assert out == [3, 3] and differ.log2fc(spark.createDataFrame(rows, "f string, g string, v double"), "f", "g", "v", 0.3000001).count() == 0
    names = [f.name for f in matrix.region_stats(spark.createDataFrame([], "k string, value double, half string, location string"), ["k"]).schema][1:]
    level = dict.fromkeys(names, 0.0) | {"mean_center": 99.0, "fp": 0.0, "tp": 0.0, "total": 99.0}
    stats = spark.createDataFrame([level | {"mean_fiveprime": 0.1 + 0.2, "sd_all": x} for x in (0.3, 0.1 + 0.2, 0.2999)])
    assert [r.fragment for r in matrix.fragment_class(stats).collect()] == ["whole", "whole", "other_fragment"]
    total = spark.createDataFrame([level | {"total": x} for x in (20.000000000000004, 20.001)])
    assert [r.fragment for r in matrix.fragment_class(total).collect()] == ["low_coverage", "whole"]


def test_minus_log10_of_one_has_no_sign(spark):
    assert math.copysign(1, spark.range(1).select(minus_log10(F.col("id") + 1.0).alias("x")).first().x) == 1


def test_sequences_of_texts_are_made_in_their_rows(spark):
    texts = [(1, "Tea at\nNoon, é\U0001f600 [x]^-\\ " * 20), (2, ""), (3, None), (4, "a" * 73), (5, "a" * 74 + "oE"), (6, "tat"), (6, "oo o"), (7, "b" * 150), (None, "a"), (None, "#o")]
    df = spark.createDataFrame(texts, "k long, text string").repartition(3)
    letters = {"a": "A", "e": "A", "o": "C", "t": "T", " ": "-"}
    got = {r.k: r.sequence for r in matrix.text_sequences(df, "k", "text", letters, "G", 76, 73, rna=True).collect()}
    want = {k: "".join(letters.get(c.lower(), "G") for i, c in enumerate(t) if i % 76 < 73).replace("T", "U") for k, t in texts if t}
    assert got == want | {6: "CUAC-UC", None: "AGC"}


def exchanged(df):
    """Columns of each exchange of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_measures_are_added_up_side_by_side(spark):
    rows = [("f", 1, 2.0, 5.0), ("f", 1, 4.0, None), ("f", 2, 1.0, 6.0), ("g", 3, None, 8.0)]
    df = spark.createDataFrame(rows, "f string, c int, a double, b double").withColumn("s", F.when(F.col("c") == 2, "s2").otherwise("s1"))
    long = matrix.long_sums(df, ["f"], {"a": F.col("a"), "b": F.col("b")})
    assert {(r.f, r.coverage): r.value for r in long.collect()} == {("f", "a"): 7.0, ("f", "b"): 11.0, ("g", "a"): None, ("g", "b"): 8.0}
    factors = spark.createDataFrame([("s1", 2.0)], "s string, size_factor double")
    norm = matrix.normalised_sums(df, ["f"], ["a", "b"], factors, "s", ["a"])
    plain = matrix.normalised(matrix.to_long(df, ["f", "s"], ["a", "b"]), factors, "s", raw_types=["a"]).groupBy("f", "coverage").agg(F.sum("norm").alias("norm"))
    assert sorted(map(str, norm.collect())) == sorted(map(str, plain.collect()))
    wide = matrix.wide_sums(df, ["f"], "c", "a", [1, 2, 4])
    assert exchanged(wide)[0] == 1 and {tuple(r) for r in wide.collect()} == {("f", 6.0, 1.0, None), ("g", None, None, None)}
    means = scale.measure_means(df, "f", "c", ["a", "b"], 8, "readtype")
    long = df.unpivot(["f", "c"], ["a", "b"], "readtype", "v")
    assert sorted(map(str, means.collect())) == sorted(map(str, scale.group_means(long, "f", "c", "v", 8, ("readtype",)).collect())) and means.count() == 3
    assert scale.measure_means(df, "f", "c", ["a", "b"], 9, "readtype").count() == 0
    pairs = scale.paired(means, "f", ("readtype",))
    assert exchanged(pairs)[0] == 1 and sorted((r.f, r.g1, r.g2, r.x, r.y) for r in pairs.collect()) == [("f", 1, 1, 5.0, 5.0), ("f", 1, 2, 5.0, 6.0), ("f", 2, 2, 6.0, 6.0), ("g", 3, 3, 8.0, 8.0)]


def test_read_counts_read_each_table_once(spark):
    rows = [("f", "x", "s1", 4.0), ("f", "x", "s1", 5.0), ("f", "y", "s2", 6.0), (None, "x", "s1", 7.0), ("f", None, "s1", 8.0), ("f", "x", None, 9.0)]
    unique = spark.createDataFrame(rows, "feature string, readtype string, sample string, value double")
    factors = spark.createDataFrame([("s1", 2.0)], "sample string, size_factor double")
    counts = matrix.read_counts(unique, unique.filter("sample = 's2'"), factors)
    assert exchanged(counts)[0] <= 5
    got = sorted([r.readtype, r.unique_raw, r.unique_norm, r.all_norm] for r in counts.filter("feature = 'f' and sample = 's1' and readtype is not null").collect())
    assert got == [["x", 4.0, 2.0, 0.0], ["x", 5.0, 2.5, 0.0], ["y", None, None, None]]
    assert {r.unique_raw for r in counts.filter("feature is null or readtype is null").collect()} == {0.0} and counts.count() == 4 * 3 + 1


def test_narrow_rows_meet_in_one_cell(spark):
    rng = np.random.default_rng(3)
    ball = rng.normal(size=(300, 5))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(ball / np.linalg.norm(ball, axis=1)[:, None])]
    df = spark.createDataFrame(rows, "id long, v array<float>").withColumn("n", F.lit(1).cast("long"))
    for eps, tile in ((0.8, 4096), (0.8, 100)):
        join = cluster.placed(df, eps, tile)
        meet = join.meet.groupBy("id").count().agg(F.max("count")).first()[0]
        assert join.meet.schema["v"].dataType.simpleString() == "array<float>" and meet == -(-300 // tile)
        v = np.array([r[1] for r in df.select("id", "v").orderBy("id").collect()])
        d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
        got = {r.id: r.near for r in cluster.counted(join).collect() if r.near}
        assert got == {i: int(k) - 1 for i, k in enumerate((d <= eps).sum(1)) if k > 1}
