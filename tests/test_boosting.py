import numpy as np
import pytest

from oreline.operators import boosting
from oreline.operators.boosting import Boosted

RNG = np.random.default_rng(5)
X = np.column_stack([RNG.integers(0, 40, 400), RNG.integers(0, 30, 400), RNG.integers(0, 6, 400)]).astype(float)
CLASSES = (X[:, 0] > 20).astype(int) + (X[:, 1] > 17) + 2 * (RNG.random(400) < .1)


def frame(spark, x=X, y=CLASSES, parts=2):
    rows = [(list(map(float, a)), float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(parts)


def grown(x, g, h, depth, leaf):
    """Values of a least-squares tree on g, by trying all cuts; leaves step along sum(g) / sum(h)."""
    out = np.zeros(len(x))

    def grow(rows, left):
        best = (1e-12, None)
        for f in range(x.shape[1]) if left else ():
            v = np.unique(x[rows, f])
            for cut in (v[:-1] + v[1:]) / 2:
                go = x[rows, f] <= cut
                a, b = rows[go], rows[~go]
                gain = len(a) * len(b) / len(rows) * (g[a].mean() - g[b].mean()) ** 2
                if min(len(a), len(b)) >= leaf and gain > best[0] + 1e-10:
                    best = (gain, (a, b))
        if best[1]:
            grow(best[1][0], left - 1), grow(best[1][1], left - 1)
        else:
            out[rows] = g[rows].sum() / h[rows].sum()
    grow(np.arange(len(x)), depth)
    return out


def brute(x, y, rounds, depth, leaf=1, rate=.1):
    k = int(y.max()) + 1
    score = np.tile(np.log(np.bincount(y.astype(int)) / len(y)), (len(y), 1))
    if k == 2:
        score = score[:, 1:] - score[:, :1]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score)) if k == 2 else np.exp(score) / np.exp(score).sum(1, keepdims=True)
        hit = (y[:, None] == 1) if k == 2 else (y[:, None] == np.arange(k))
        share = 1 if k == 2 else (k - 1) / k
        score = score + rate * share * np.column_stack(
            [grown(x, hit[:, c] - p[:, c], p[:, c] * (1 - p[:, c]), depth, leaf) for c in range(p.shape[1])])
    return score


def test_multinomial_scores_equal_all_cuts_tried(spark):
    model = Boosted(3, 3, min_samples_leaf=4, keep_rounds=2).fit(frame(spark))
    assert np.allclose(model.scores(X), brute(X, CLASSES, 3, 3, 4), atol=1e-8)
    assert len(model.rounds) == 3 and all(len(trees) == 5 for trees in model.rounds)


def test_two_classes_have_one_tree(spark):
    y = (CLASSES > 0).astype(float) * 1.0
    model = Boosted(2, 2).fit(frame(spark, y=y * 7))
    assert model.labels == [0.0, 7.0] and all(len(trees) == 1 for trees in model.rounds)
    assert np.allclose(model.scores(X), brute(X, y, 2, 2), atol=1e-8)
    seen = {r.prediction for r in model.transform(frame(spark, y=y)).collect()}
    assert seen <= {0.0, 7.0}


def test_values(spark):
    y = 3 * X[:, 0] - X[:, 1] ** 2 + 50
    model = Boosted(2, 3, learning_rate=.5, task="regression").fit(frame(spark, y=y))
    score = np.full(len(y), y.mean())
    for _ in range(2):
        score = score + .5 * grown(X, y - score, np.ones(len(y)), 3, 1)
    assert np.allclose(model.scores(X)[:, 0], score, atol=1e-5)


def test_model_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    found = [Boosted(2, 2).fit(frame(spark, parts=parts)).leaves() for parts in (1, 3, 8)]
    monkeypatch.setattr(boosting, "DENSE_CELLS", 0)
    found.append(Boosted(2, 2).fit(frame(spark, parts=3)).leaves())
    assert all(f == found[0] for f in found)


def test_weights_stand_for_copies(spark):
    w = 1 + (np.arange(len(X)) % 2)
    rows = [(X[i].tolist(), float(CLASSES[i]), float(w[i])) for i in range(len(X))]
    weighted = Boosted(1, 2).setWeightCol("w").fit(spark.createDataFrame(rows, "features array<double>, label double, w double"))
    copied = Boosted(1, 2).fit(frame(spark, np.repeat(X, w, 0), np.repeat(CLASSES, w)))
    assert np.allclose(weighted.scores(X), copied.scores(X), atol=1e-8)


def test_wide_columns_are_cut_at_quantiles(spark):
    x = np.arange(500.0)[:, None]
    model = Boosted(1, 1, max_bins=10).fit(frame(spark, x, x[:, 0] >= 250))
    assert np.allclose(model.cuts[0], np.quantile(x[:, 0], np.arange(1, 10) / 10))
    assert sorted((path, n) for _, _, path, n, _ in model.leaves()) == [("L", 250), ("R", 250)]


def test_edges(spark):
    schema = "features array<double>, label double"
    with pytest.raises(ValueError):
        Boosted(1).fit(spark.createDataFrame([], schema))
    one = Boosted(3).fit(spark.createDataFrame([([1.0], 4.0), ([2.0], 4.0)], schema))
    rows = [([1.0], 0.0), ([1.0], 0.0), ([float("nan")], 1.0), ([None], 1.0), ([2.0], 0.0), (None, 1.0), ([5.0], None), ([1.0], 0.0)]
    odd = spark.createDataFrame(rows, schema)
    assert [r.prediction for r in one.transform(odd).collect()] == [None if r[0] is None else 4.0 for r in rows]
    model = Boosted(5, 2).fit(odd)
    assert {(r.features[0] == 1.0, r.prediction) for r in model.transform(odd).where("label IS NOT NULL AND features IS NOT NULL AND features[0] = 1").collect()} == {(True, 0.0)}
    same = Boosted(2).fit(spark.createDataFrame([([3.0], 0.0), ([3.0], 1.0), ([3.0], 2.0)], schema))
    assert same.rounds == [] and np.allclose(same.scores(np.array([[3.0]])), np.log(1 / 3))
