"""Exact neighbours against all distances, and how many distances the join looks at."""

import numpy as np
import pytest

from oreline.operators import neighbors as N


def _clustered(n, clusters, dims=64, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, (clusters, dims))
    return centres[rng.integers(0, clusters, n)] + rng.normal(0, 0.5, (n, dims))


def _table(spark, x, key):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], f"{key} long, x array<double>").repartition(8)


def _brute(q, p, k):
    return np.argsort(N._distances(q, p), axis=1, kind="stable")[:, :k]


def _got(df, k, rows):
    out = np.full((rows, k), -1)
    for r in df.collect():
        out[r.qid, r["rank"] - 1] = r.pid
    return out


@pytest.mark.parametrize("dims,clusters", [(64, 20), (3, 400)])
def test_equals_all_distances(spark, dims, clusters):
    p, q = _clustered(3000, clusters, dims), _clustered(200, clusters, dims)[:200] + 0.1
    p[100:160] = p[100]                                   # copies: ties by id
    q[0] = p[100]
    got = _got(N.nearest(_table(spark, q, "qid"), _table(spark, p, "pid"), 5, leaf_rows=64), 5, len(q))
    assert (got == _brute(q, p, 5)).all()


def test_shapeless_data_and_rows_of_the_table(spark):
    x = np.random.default_rng(1).normal(size=(1500, 12))
    df = _table(spark, x, "pid")
    got = _got(N.nearest(df.withColumnRenamed("pid", "qid"), df, 4, same_rows=True, leaf_rows=64), 4, len(x))
    d = N._distances(x, x)
    np.fill_diagonal(d, np.inf)
    assert (got == np.argsort(d, axis=1, kind="stable")[:, :4]).all()


def test_groups_smaller_than_k_and_missing_groups(spark):
    x = np.random.default_rng(2).normal(size=(1200, 4))
    grp = np.where(np.arange(1200) < 3, "tiny", np.where(np.arange(1200) % 2, "odd", "even"))
    points = spark.createDataFrame([(i, str(g), r.tolist()) for i, (g, r) in enumerate(zip(grp, x))], "pid long, grp string, x array<double>")
    queries = spark.createDataFrame([(0, "tiny", [0.0] * 4), (1, "odd", [0.0] * 4), (2, "none", [0.0] * 4)], "qid long, grp string, x array<double>")
    rows = N.nearest(queries, points, 5, leaf_rows=64).collect()
    for qid, name in ((0, "tiny"), (1, "odd")):
        ids = np.flatnonzero(grp == name)
        want = ids[_brute(np.zeros((1, 4)), x[ids], 5)[0]].tolist()
        assert [r.pid for r in sorted(rows, key=lambda r: r["rank"]) if r.qid == qid] == want
    assert not [r for r in rows if r.qid == 2]


def test_values_that_are_not_finite_come_last(spark):
    x = np.random.default_rng(4).normal(size=(800, 3))
    x[5] = np.nan
    got = _got(N.nearest(_table(spark, x[:1], "qid"), _table(spark, x, "pid"), 3, leaf_rows=64), 3, 1)
    assert (got == _brute(x[:1], x, 3)).all()


def test_few_distances_and_growth_below_quadratic(spark):
    counts = []
    for n in (4000, 8000):
        df = _table(spark, _clustered(n, 40), "pid")
        counts.append(N.compared_pairs(df.withColumnRenamed("pid", "qid"), df, 5, leaf_rows=64))
        assert counts[-1] < 0.10 * n * n
    assert counts[1] < 3.6 * counts[0]


def test_a_query_is_sent_to_blocks_not_to_every_leaf(spark, monkeypatch):
    """Rows without clusters visit nearly all leaves; each is sent to a bounded number of tiles all the same."""
    x = np.random.default_rng(6).normal(size=(3000, 12))
    df, sent, visited = _table(spark, x, "pid"), [], N._visited

    def counted(routed, *more):
        sent.append(routed.count())
        return visited(routed, *more)
    monkeypatch.setattr(N, "_visited", counted)
    monkeypatch.setattr(N, "POINT_BLOCK", 64)
    monkeypatch.setattr(N, "QUERY_BLOCK", 64)
    got = _got(N.nearest(df.withColumnRenamed("pid", "qid"), df, 4, same_rows=True, leaf_rows=60), 4, len(x))
    d = N._distances(x, x)
    np.fill_diagonal(d, np.inf)
    assert (got == np.argsort(d, axis=1, kind="stable")[:, :4]).all()
    assert sum(sent) < 20 * len(x)
