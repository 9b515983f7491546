import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixloom.llm import pstable
from matrixloom.llm.queries import oracle_sql, queries
from tests.oracle import assert_same

NAN, INF = float("nan"), float("inf")


def brute(rows, least=0.9):
    """(id, n_links, component_id, kept) by all pairs."""
    sound = [i for i, (d, v) in enumerate(rows) if d is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max([len(rows[i][1]) for i in sound], default=0)
    unit = {i: np.array(rows[i][1] + [0.0] * (width - len(rows[i][1]))) for i in sound}
    unit = {i: (x / np.abs(x).max()) / np.linalg.norm(x / np.abs(x).max()) for i, x in unit.items()}
    near = {i: [j for j in sound if j != i and unit[i] @ unit[j] >= least] for i in sound}
    least_of = {i: rows[i][0] for i in range(len(rows))}
    while True:
        was = dict(least_of)
        for i in sound:
            least_of[i] = min([least_of[i], *(least_of[j] for j in near[i])])
        if was == least_of:
            break
    return sorted((repr((d, len(near.get(i, [])), least_of[i], d is not None and d == least_of[i])) for i, (d, _) in enumerate(rows)))


def own(spark, rows, kind="double", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("node", F.lit("clash")).withColumn("id", F.lit(1))
    found = pstable.near_duplicates(df, **more).collect()
    return sorted(repr((r.id, r.n_links, r.component_id, r.kept)) for r in found)


def clustered(seed, n, groups, spread, dims=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dims))
    v = centres[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, dims))
    return [(int(i) * 3 % 1009, x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize(("fill", "tile"), [(512, 4096), (8, 7)])
def test_links_match_brute_force(spark, fill, tile):
    rows = clustered(1, 160, 30, 0.25)
    rows += [(2000 + i, rows[0][1]) for i in range(20)] + [(3000 + i, [2.0 * x for x in rows[i][1]]) for i in range(9)]
    assert own(spark, rows, fill=fill, tile=tile, miss=1e-6, at_once=5) == brute(rows)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, NAN]), (6, [1.0, -INF]), (7, [1.0]), (8, [3.0, 0.0]), (9, [1.0, 0.1])]
    rows += [(None, [1.0, 0.0]), (None, None), (5, [0.0, 1.0]), (5, [0.0, 1.0]), (11, [0.0, 1e300]), (12, [1e-300, 2e-300]), (13, [-1.0, 0.0]), (5, [1.0, 0.0])]
    assert own(spark, rows) == brute(rows)
    assert own(spark, [], "float") == []
    assert own(spark, [(4, None)]) == [repr((4, 0, 4, True))]


def test_recall_and_plan():
    """Found shares of pairs at the least cosine agree with the plan, and unrelated rows seldom meet."""
    rng = np.random.default_rng(3)
    k, count, step = pstable.plan(51_000, 0.9, 1e-2, 512)
    hashes = pstable.Hashes(k, count, step)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.standard_normal((3000, 64))
    b -= (b * a).sum(1)[:, None] * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1)[:, None]
    same = hashes.buckets(a, 0, count) == hashes.buckets(b, 0, count)
    assert 0.98 <= same.any(1).mean() < 1
    unrelated = hashes.buckets(a, 0, count)
    assert (unrelated[:-1] == unrelated[1:]).mean() < 3 * 512 / 51_000
    for chunk in (1, 7, 3000):  # any batch gives the same buckets
        assert (hashes.buckets(a[:chunk], 2, 5) == unrelated[:chunk, 2:5]).all()


def test_query_matches_sql(spark):
    assert assert_same(spark, "/root/testdata/sf0.01", queries()["op11_pstable"], oracle_sql()["op11_pstable"]) == 500
