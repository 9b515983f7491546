"""Readers, versions of datasets, and checks that are part of a plan."""

import pytest
from pyspark.sql import functions as F

from matrixloom.operators import checks, differ, matrix, merge
from matrixloom.plans import build
from matrixloom.sources import runs


def jobs(spark, make):
    """How many jobs ``make`` runs."""
    spark.sparkContext.setJobGroup("counted", "")
    try:
        make()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_quoted_metadata(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('sample,group,"a, note"\ns1,g1,"a, b"\ns2,g2,"say ""x"""\n\ns3,,\nsample,group,"a, note"\n')
    meta = runs.metadata(spark, str(path))
    assert meta.columns == ["sample", "group", "a, note"]
    assert sorted(tuple(r) for r in meta.collect()) == [("s1", "g1", "a, b"), ("s2", "g2", 'say "x"'), ("s3", None, None), ("sample", "group", "a, note")]
    (tmp_path / "m.txt").write_text('sample group\ns1 "one two"\n')
    assert [tuple(r) for r in runs.metadata(spark, str(tmp_path / "m.txt")).collect()] == [("s1", "one two")]


def test_row_that_equals_the_header_stays(spark, tmp_path):
    (tmp_path / "c.txt").write_text('1\t2\n"tRNA, 1"\t5\tx\n1\t2\n1\t2\t3\n')
    got = sorted((r.key, r["sample"], r.value) for r in runs.row_named(spark, str(tmp_path / "c.txt")).collect() if r.value is not None)
    assert got == [("1", "1", 2.0), ("1", "1", 2.0), ("1", "2", 3.0), ("tRNA, 1", "1", 5.0)]


def test_versions_of_a_dataset(spark, tmp_path):
    path = str(tmp_path / "d")
    with pytest.raises(FileNotFoundError):
        runs.load(spark, path)
    assert runs.save({"t": spark.range(3).toDF("x"), "u": spark.range(1).toDF("y")}, path) == 1
    first = runs.load(spark, path)
    assert sorted(first) == ["t", "u"]
    again = first["t"].withColumn("x", F.col("x") + 10).withColumn("z", F.lit(1))  # read and written over in one job
    assert runs.save({"t": again}, path, {"t": ["x"]}) == 2
    assert sorted(r.x for r in runs.load(spark, path)["t"].collect()) == [10, 11, 12]
    assert sorted(r.x for r in first["t"].collect()) == [0, 1, 2]  # what was loaded stays
    assert runs.load(spark, path, ["u"], version=1)["u"].count() == 1


def test_buckets_spare_the_shuffle_by_feature(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = [(f"f{i % 40}", rt, g, float(i % 13 + len(g))) for i in range(400) for rt in ("a", "b") for g in ("x", "yy")]
    counts = spark.createDataFrame(rows, "feature string, readtype string, grp string, value double")
    runs.save({"obs_counts": counts}, path, buckets={"obs_counts": ("feature", 8)})
    table = runs.load(spark, path)["obs_counts"]
    assert table.count() == 1600 and runs.load(spark, path)["obs_counts"].count() == 1600
    own, plain = (differ.log2fc(t, "feature", "grp", "value", 0) for t in (table, counts))
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, plain.collect()))
    assert "hashpartitioning(feature" in plain._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(feature" not in own._jdf.queryExecution().executedPlan().toString()


def test_tables_of_absent_clusters_are_skipped(spark):
    with pytest.warns(UserWarning):
        assert build.cluster_tables({"obs": spark.range(1)}, "sample", "amino", F.lit(True), "amino") is None
    obs = spark.createDataFrame([("A", 0, 1.0, 2.0), ("A", -1, 5.0, 5.0), ("B", 0, 3.0, 4.0)], "amino string, sample_cluster int, sample_d1 double, sample_d2 double")
    out = build.cluster_tables({"obs": obs, "cluster_runinfo": spark.range(1)}, "sample", "amino", F.col("sample_cluster") < 0, "amino")
    assert [(r.sample_d1, r.sample_d2, r.name, r.n) for r in out["centroids"].collect()] == [(2.0, 3.0, "A", 2)]
    assert {(r.amino, r.state) for r in out["masked"].collect()} == {("A", "partial"), ("B", "none")}


def test_failed_save_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "d")
    runs.save({"t": spark.range(3).toDF("x")}, path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        runs.save({"s": spark.range(1).toDF("y"), "t": broken}, path)
    assert sorted(r.x for r in runs.load(spark, path)["t"].collect()) == [0, 1, 2]
    assert runs.current(spark, path)["version"] == 1


def test_kept_differentials_survive_a_failed_remake(spark, tmp_path):
    path, diff = str(tmp_path / "diff"), spark.createDataFrame([("f", 1.0)], "feature string, log2fc double")
    kept = lambda make, cutoff=80, **o: runs.cached_diff(spark, path, "default", "group", "total", cutoff, make, **o)
    assert kept(lambda: diff).count() == 1

    def fails():
        raise ValueError("no")

    assert kept(fails).count() == 1
    with pytest.raises(ValueError):
        kept(fails, overwrite=True)
    assert [r.log2fc for r in kept(fails).collect()] == [1.0]
    own = kept(fails)
    assert kept(lambda: own.withColumn("log2fc", F.lit(2.0)).drop("config_name", "compare", "readtype", "cutoff"), overwrite=True).first().log2fc == 2.0
    assert kept(lambda: diff, cutoff=20).count() == 1 and kept(fails).first().log2fc == 2.0


def run_tables(spark, spots, meta=(("s", "g"),)):
    types = ", ".join(f"{c} double" for c in matrix.COVERAGE_TYPES)
    rows = [("tRNA-Ala-AGC-1", "s", p, "A", *[1.0] * 15) for p in spots]
    coverage = spark.createDataFrame(rows, f"Feature string, Sample string, position string, actualbase string, {types}")
    factors = spark.createDataFrame([("s", 2.0)], "sample string, size_factor double")
    counts = spark.createDataFrame([("tRNA-Ala-AGC-1", "fiveprime", "s", 3.0)], "feature string, readtype string, sample string, value double")
    return build.dataset(coverage, factors, counts, counts, spark.createDataFrame(list(meta), "sample string, group string"), "x")


def test_build_refuses_doubles(spark, tmp_path):
    tables = run_tables(spark, ["1", "2", "17a"])
    assert tables["obs"].count() == 1 and tables["x"].count() == 45
    with pytest.raises(Exception, match="duplicate position: feature=tRNA-Ala-AGC-1, sample=s"):
        runs.save(run_tables(spark, ["1", "2", "2"]), str(tmp_path / "d"))
    with pytest.raises(FileNotFoundError):
        runs.load(spark, str(tmp_path / "d"))
    with pytest.raises(Exception, match="duplicate key: sample=s"):
        run_tables(spark, ["1"], [("s", "g"), ("s", "h")])["obs"].collect()


def test_checks_run_within_the_job(spark):
    a, b = spark.range(10).toDF("k").withColumn("v", F.lit(1)), spark.range(10, 30).toDF("k").withColumn("v", F.lit(2))
    assert jobs(spark, lambda: merge.rows(a, b, ["k"])) == 0
    assert merge.rows(a, b, ["k"]).count() == 30 and merge.rows(a.limit(0), b, ["k"]).count() == 20
    with pytest.raises(Exception, match="in both: 9"):
        merge.rows(a, spark.range(9, 12).toDF("k").withColumn("v", F.lit(2)), ["k"]).collect()
    assert jobs(spark, lambda: matrix.to_wide(a.withColumn("c", F.lit("x")), ["k"], "c", "v", ["x"])) == 0
    with pytest.raises(Exception, match="duplicate v: k=1"):
        checks.no_doubles(a.union(a.filter("k = 1")), ["k"], "v").collect()


def test_merged_counts(spark):
    a = spark.createDataFrame([("x", "s1", 1.0), ("y", "s1", 2.0), ("x", "s2", None)], "key string, sample string, value double")
    b = spark.createDataFrame([("z", "s3", 3.0), ("x", "s3", 4.0)], a.schema)
    got = sorted(tuple(r) for r in merge.counts(a, b, "key", "sample", "value").collect())
    assert got == [("x", "s1", 1.0), ("x", "s2", 0.0), ("x", "s3", 4.0), ("y", "s1", 2.0), ("y", "s2", 0.0), ("y", "s3", 0.0), ("z", "s1", 0.0), ("z", "s2", 0.0), ("z", "s3", 3.0)]
    plan = merge.counts(a, b, "key", "sample", "value")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the row of samples
