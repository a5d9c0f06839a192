import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import cluster as C
from oreline.operators import hierarchy as H
from oreline.operators import evaluate as E
from oreline.operators import metrics as M
from oreline.operators import models as L
from oreline.operators import neighbors as N
from oreline.operators import neural as NN
from oreline.operators import reduce as R
from oreline.operators import resample as B
from oreline.operators import split as P


def frame(spark, n=120, classes=(0, 1, 2), seed=0):
    rng = np.random.default_rng(seed)
    y = rng.choice(classes, n, p=None)
    x = rng.normal(size=(n, 2)) + 3 * np.column_stack([y, y % 2])
    return spark.createDataFrame([(i, int(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)], "row_id bigint, label int, a double, b double")


def test_confusion_scores(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)] * 4
    df = spark.createDataFrame(pairs, "y int, p int")
    s = M.weighted_scores(df, "y", "p").first()
    assert np.allclose([s.accuracy, s.precision_weighted, s.recall_weighted, s.f1_weighted], [.7, .72, .7, .7030], atol=1e-4)
    rates = {r.actual: r.rate for r in M.class_rates(M.confusion(df, "y", "p")).collect()}
    assert np.allclose([rates[0], rates[1]], [.75, .6667], atol=1e-4)


def test_regression_errors(spark):
    e = M.regression_errors(spark.createDataFrame([(1., 1.), (2., 3.), (4., 3.)], "y double, p double"), "y", "p").first()
    assert np.allclose([e.RMSE, e.MAE, e.ER, e.R2], [.8165, .6667, .2857, .5714], atol=1e-4)


def test_time_folds(spark):
    df = spark.createDataFrame([(i, f"2024-01-{i + 1:02d}") for i in range(10)], "i int, d string").withColumn("ts", F.to_timestamp_ntz("d"))
    assert [r.fold for r in P.time_folds(df, "ts", 3).orderBy("i").collect()] == [0] * 4 + [1, 1, 2, 2, 3, 3]


def test_fold_guards(spark):
    df = spark.createDataFrame([(i, 0 if i else 1) for i in range(9)], "row_id int, label int")
    assert P.stratified_kfold(df, "row_id", "label", 3)[1] == 3
    two = spark.createDataFrame([(i, int(i < 2)) for i in range(9)], "row_id int, label int")
    folds, k = P.stratified_kfold(two, "row_id", "label", 5)
    assert k == 2 and {r.fold for r in folds.collect()} == {0, 1}


def test_balancing(spark):
    df = spark.createDataFrame([(i, 0 if i < 30 else 1 if i < 37 else 2, float(i), float(i % 5)) for i in range(40)], "row_id bigint, label int, a double, b double")
    over = B.oversample(df, "row_id", "label")
    assert {r["count"] for r in over.groupBy("label").count().collect()} == {30}
    under = B.undersample(df, "row_id", "label")
    assert {r["count"] for r in under.groupBy("label").count().collect()} == {3} and under.join(df, "row_id", "left_anti").isEmpty()
    made = B.smote(df, "row_id", "label", ["a", "b"])
    assert {r["count"] for r in made.groupBy("label").count().collect()} == {30}
    at = {r.row_id: r for r in df.collect()}
    for r in made.where("source IS NOT NULL").collect():
        s, n = at[r.source], at[r.neighbour]
        assert s.label == n.label == r.label and r.source != r.neighbour
        assert abs(r.a - (s.a + r.gap * (n.a - s.a))) < 1e-9
    weights = {r.label: r.weight for r in B.class_weights(spark.createDataFrame([(0,)] * 3 + [(1,)], "label int"), "label").collect()}
    assert np.allclose([weights[0], weights[1]], [.6667, 2.0], atol=1e-4)


@pytest.mark.parametrize("copies", [False, True])
def test_neighbours_equal_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(N, "POINT_BLOCK", 16)
    monkeypatch.setattr(N, "QUERY_BLOCK", 16)
    x = np.random.default_rng(1).normal(size=(150, 3))
    if copies:
        x[:60] = x[0]                  # a third and more of the rows are one point
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "pid bigint, x array<double>")
    got = N.nearest(df.withColumnRenamed("pid", "qid"), df, 4, same_rows=True, leaf_rows=20).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert len(got) == 600
    for r in got:
        order = sorted((j for j in range(150) if j != r.qid), key=lambda j: (round(d[r.qid, j], 12), j))
        assert abs(r.dist - d[r.qid, order[r["rank"] - 1]]) < 1e-9


def test_neighbours_when_the_row_itself_is_not_among_the_first(spark):
    """Copies with smaller keys come first; the own row must still be left out exactly."""
    df = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(12)] + [(12, [5.0, 5.0])], "pid bigint, x array<double>")
    got = N.nearest(df.withColumnRenamed("pid", "qid"), df, 3, same_rows=True).where("qid = 11").orderBy("rank").collect()
    assert [r.pid for r in got] == [0, 1, 2]


def test_ridge_and_lasso_closed_forms(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [2.0, -1.0, 0.0] + 4 + rng.normal(0, .3, 200)
    df = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(200)], "row_id bigint, label double, a double, b double, c double")
    rows = L.Prepared(df, ["a", "b", "c"], True).apply(df, ["row_id", "label"])
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 7 * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(L.ridge({"alpha": 7.0}).fit(rows).coefficients, want, atol=1e-6)
    w = np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rest = y - y.mean() - z @ w + z[:, j] * w[j]
            c = z[:, j] @ rest / 200
            w[j] = np.sign(c) * max(abs(c) - .5, 0)
    assert np.allclose(L.lasso({"alpha": .5}).fit(rows).coefficients, w, atol=1e-4)


@pytest.mark.parametrize("name", ["KNN", "Decision Tree", "AdaBoost"])
def test_classifiers_learn(spark, name):
    df = P.stratified_split(frame(spark), "row_id", "label")
    params = {"AdaBoost": {"n_estimators": 6, "max_depth": 2}}.get(name, {})
    _, tables = E.train_classifier(df, ["a", "b"], L.CLASSIFIERS[name], params)
    assert tables["global"].first().accuracy > 0.8


def test_parameter_check():
    assert L.accepts(L.decision_tree({}), "weightCol") and L.accepts(L.random_forest({}), "seed") and not L.accepts(L.knn({}), "weightCol")


def test_unsupported_weights_give_null(spark):
    out = E.benchmark_balancing(frame(spark, 60), ["a", "b"], L.knn, {"n_neighbors": 3}, 2)
    assert {r.Balance for r in out.where("Promedio IS NULL").collect()} == {"class_weight"} and out.count() == 5


def test_components(spark):
    df = frame(spark)
    pcs = R.principal_components(df, ["a", "b"], 2)
    at = np.array([[r.PC1, r.PC2] for r in pcs.coordinates(df, ["row_id"]).collect()])
    assert abs(np.corrcoef(at.T)[0, 1]) < 1e-8 and abs(pcs.share.sum() - 100) < 1e-8 and np.allclose(at.mean(0), 0, atol=1e-9)


def test_array_components_equal_numpy(spark):
    x = np.random.default_rng(7).normal(size=(80, 5)) @ np.diag([3, 2, 1, .5, .1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id bigint, x array<double>")
    pcs = R.array_components(df, "x", 2)
    got = np.array([[r.PC1, r.PC2] for r in pcs.coordinates(df, "x", ["row_id"]).orderBy("row_id").collect()])
    _, s, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs((x - x.mean(0)) @ v[:2].T), atol=1e-8)
    assert np.allclose(pcs.share, (s ** 2 / (s ** 2).sum() * 100)[:2])


def as_vectors(df):
    return df.select("row_id", F.array("a", "b").alias("x"))


def test_kmeans_restarts_share_their_passes(spark):
    """The best of separate fits, with fewer jobs than these take."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    x = np.random.default_rng(5).normal(size=(600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id bigint, x array<double>")
    sc = spark.sparkContext
    sc.setJobGroup("together", "")
    rows, centres, cost = C.kmeans(df, 3, 100, 4)
    sc.setJobGroup("apart", "")
    fits = [KMeans(k=3, maxIter=100, seed=42 + i, featuresCol="v").fit(df.withColumn("v", array_to_vector("x")).persist()) for i in range(4)]
    sc.setLocalProperty("spark.jobGroup.id", None)
    best = min(fits, key=lambda m: m.summary.trainingCost)
    assert abs(cost - best.summary.trainingCost) < 1e-6
    assert np.allclose(centres, sorted(c.tolist() for c in best.clusterCenters()), atol=1e-9)
    jobs = [len(sc.statusTracker().getJobIdsForGroup(g)) for g in ("together", "apart")]
    assert jobs[0] < 0.75 * jobs[1], jobs


def test_kmeans_cost_falls_with_k(spark):
    v = as_vectors(frame(spark))
    costs = [C.kmeans(v, k, 50, 2)[2] for k in (1, 2, 3)]
    assert costs[0] >= costs[1] >= costs[2]


def test_medoids_are_rows(spark):
    v = as_vectors(frame(spark))
    rows, medoids, cost = C.kmedoids(v, 3, 5, 2)
    points = [r.x for r in v.collect()]
    assert all(m in points for m in medoids) and abs(rows.agg(F.sum("distance")).first()[0] - cost) < 1e-9


@pytest.mark.parametrize("method", ["single", "complete", "average", "ward"])
def test_merge_heights_equal_a_naive_tree(method):
    x = np.random.default_rng(3).normal(size=(25, 2))
    groups, heights = [[i] for i in range(25)], []

    def gap(a, b):
        d = np.sqrt(((x[a][:, None] - x[b][None]) ** 2).sum(2))
        if method == "ward":
            return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(x[a].mean(0) - x[b].mean(0))
        return {"single": d.min(), "complete": d.max(), "average": d.mean()}[method]

    while len(groups) > 1:
        h, i, j = min((gap(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        heights.append(h)
        groups[i] += groups.pop(j)
    assert np.allclose(H.merge_tree(x, np.ones(25), method)["height"], heights)


def test_hierarchical_labels(spark):
    rows, merges = H.hierarchical(as_vectors(frame(spark)), 3)
    assert rows.select("cluster").distinct().count() == 3 and merges.count() == 119


@pytest.mark.parametrize("activation,head", [("relu", "softmax"), ("tanh", "sigmoid"), ("tanh", "linear")])
def test_gradient_by_differences(activation, head):
    rng = np.random.default_rng(0)
    sizes = [3, 4, 2 if head == "softmax" else 1]
    shapes, x = NN.layer_shapes(sizes), rng.normal(size=(6, 3))
    y = rng.integers(0, 2, 6).astype(float)
    flat = NN.initial_weights(sizes, activation)
    _, g = NN.loss_and_gradient(x, y, flat, shapes, activation, head)
    for i in range(0, len(flat), 3):
        e = np.zeros_like(flat)
        e[i] = 1e-6
        up, down = (NN.loss_and_gradient(x, y, flat + s * e, shapes, activation, head)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - g[i]) < 1e-4


def test_networks_learn(spark):
    df = P.stratified_split(frame(spark, 200), "row_id", "label")
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    nets = {"adam": NN.Mlp((16,), "relu", "adam", 25, rate=0.02, batch=16), "lbfgs": NN.Mlp((8,), "tanh", "lbfgs", 30)}
    out = NN.compare_networks(train, test, ["a", "b"], nets)
    assert out.agg(F.min("accuracy")).first()[0] > 0.8


def test_adam_weights_do_not_depend_on_the_layout(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(420, 2)).round(2).tolist() + [[0.5, 0.25]] * 180          # one row is repeated 180 times
    rows = [(v, float(v[0] * v[1] > 0)) for v in x]
    df = spark.createDataFrame(rows, "features array<double>, label double")

    def weights(frame):
        return NN.Mlp((12, 6), "relu", "adam", 4, batch=100, rate=0.01, patience=99).fit(frame).flat

    def same(a, b):
        return np.allclose(a, b, rtol=0, atol=1e-12)          # the order of sums inside a matrix product is not ours

    one = weights(df.repartition(1))
    assert same(one, weights(df.repartition(3))) and same(one, weights(df.orderBy("label").repartition(8)))
    monkeypatch.setattr(NN, "BLOCK_VALUES", 45)               # 40 blocks of 15 rows, folded in two levels
    cut = weights(df.repartition(1))
    assert same(cut, weights(df.repartition(8))) and not same(cut, one)


def test_adam_equals_a_plain_loop(spark):
    """Full batches of one block: the same steps as Adam written out."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(24, 2))
    y = x[:, 0] - 2 * x[:, 1]
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "features array<double>, label double")
    model = NN.Mlp((5,), "tanh", "adam", 30, "regression", batch=24, penalty=0.0, patience=99).fit(df)
    shapes = NN.layer_shapes([2, 5, 1])
    w = NN.initial_weights([2, 5, 1], "tanh", 42)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, 31):
        g = NN.loss_and_gradient(x, y, w, shapes, "tanh", "linear")[1] / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.001 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    assert np.allclose(model.flat, w, atol=1e-9)


def test_support_vector_regression_fits_a_curve(spark):
    x = np.linspace(-3, 3, 200)
    df = spark.createDataFrame([(i, float(np.sin(v)), float(v)) for i, v in enumerate(x)], "row_id bigint, label double, a double")
    rows = L.Prepared(df, ["a"], True).apply(df, ["row_id", "label"])
    model = NN.KernelSvr(width=100, iterations=60, epsilon=0.01).fit(rows)
    assert M.regression_errors(model.transform(rows), "label", "prediction").first().RMSE < 0.1


def test_evolution_keeps_the_best(spark):
    out = E.evolve(frame(spark, 90), ["a", "b"], L.decision_tree, {"max_depth": ("int", 1, 4)}, population=2, generations=1, n_folds=2)
    best = {g: s for g, s in out.groupBy("generation").agg(F.max("score")).collect()}
    assert best[1] >= best[0]


def test_border_between_classes_and_numbers(spark):
    rows = spark.range(4000)
    for values in (1, 19, 20, 300):
        df = rows.select(F.when(F.col("id") % 7 > 0, F.col("id") % values).alias("label"))
        assert E.few_values(df, "label") == (values < 20)
    assert E.few_values(rows.where("false").withColumnRenamed("id", "label"), "label")
