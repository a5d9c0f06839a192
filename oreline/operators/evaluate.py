"""Fit-and-score runs, cross-validation, model and balancing comparisons, evolutionary search."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import metrics as M
from . import models
from . import resample as R
from .split import kfold, stratified_kfold, time_folds

CLASSIFICATION_LIMIT = 20        # fewer distinct targets than this means classification


def _balanced(train: DataFrame, method: str | None, features: list[str], seed: int) -> DataFrame:
    if method in (None, "none"):
        return train
    if method == "oversample":
        return R.oversample(train, "row_id", "label", seed).drop("copy")
    if method == "undersample":
        return R.undersample(train, "row_id", "label", seed)
    if method == "smote":
        made = R.smote(train, "row_id", "label", features, seed=seed)
        # synthetic rows get keys that no original row has
        key = F.when(F.col("source").isNull(), F.monotonically_increasing_id()).otherwise(-F.monotonically_increasing_id() - 1)
        return materialize(made.select(key.alias("row_id"), "label", *features))
    raise ValueError(f"unknown balancing method {method!r}")


def fit_predict(train: DataFrame, test: DataFrame, features: list[str], factory, params: dict | None = None, scale: bool = True,
                balance: str | None = None, class_weight: str | None = None, seed: int = 42):
    """Balance, impute and scale on the training rows only, fit, predict the test rows.

    Returns (model, predictions with row_id, label, prediction).
    """
    train = _balanced(train, balance, features, seed)
    ready = models.Prepared(train, features, scale)
    rows = ready.apply(train, ["row_id", "label"])
    learner = factory(dict(params or {}))
    if class_weight == "balanced":
        if not models.accepts(learner, "weightCol"):
            raise ValueError("this model takes no row weights")
        rows = R.class_weights(rows, "label")
        learner = learner.setWeightCol("weight")
    rows = rows.persist()
    try:
        model = learner.fit(rows)
        out = model.transform(ready.apply(test, ["row_id", "label"])).select("row_id", "label", "prediction")
        return model, materialize(out)
    finally:
        rows.unpersist()


def train_classifier(df: DataFrame, features: list[str], factory, params=None, **options) -> tuple:
    """Fit on ``split = 'train'`` and report on ``'test'``: (model, {table name: DataFrame})."""
    df = materialize(df)
    model, predicted = fit_predict(df.where("split = 'train'"), df.where("split = 'test'"), features, factory, params, **options)
    counts = M.confusion(predicted.withColumn("prediction", F.col("prediction").cast("double")).withColumn("label", F.col("label").cast("double")), "label", "prediction")
    return model, {"confusion": counts, "global": M.accuracy_table(counts), "classes": M.class_rates(counts)}


def train_regressor(df: DataFrame, features: list[str], factory, params=None, **options) -> tuple:
    """Fit on ``split = 'train'`` and report on ``'test'``: (model, error table)."""
    df = materialize(df)
    model, predicted = fit_predict(df.where("split = 'train'"), df.where("split = 'test'"), features, factory, params, **options)
    return model, M.regression_errors(predicted, "label", "prediction")


def assign_folds(df: DataFrame, method: str, k: int, label: str = "label", ts: str | None = None, seed: int = 42) -> tuple[DataFrame, list]:
    """Table with ``fold`` and the list of (test fold, training condition)."""
    if method == "kfold":
        out = kfold(df, "row_id", k, seed)
    elif method == "stratified":
        out, k = stratified_kfold(df, "row_id", label, k, seed)
    elif method == "timeseries":
        out = time_folds(df, ts or "row_id", k)
        return out, [(i, F.col("fold") < i) for i in range(1, k + 1)]
    else:
        raise ValueError("cv_method must be 'kfold', 'stratified' or 'timeseries'")
    return out, [(i, F.col("fold") != i) for i in range(k)]


def few_values(df: DataFrame, column: str, limit: int = CLASSIFICATION_LIMIT) -> bool:
    """Whether the column has fewer than ``limit`` distinct values, nulls aside; counted exactly, no further than needed."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit).count() < limit


def cross_validate(df: DataFrame, features: list[str], factory, params=None, n_folds: int = 10, cv_method: str = "kfold", scoring=None,
                   scale: bool = True, balance: str | None = None, class_weight: str | None = None, ts: str | None = None,
                   name: str = "model", threads: int = 4, seed: int = 42) -> DataFrame:
    """Fold scores as (model, fold, metric, value).

    ``scoring`` is a scorer name; None reports all measures of the task, which is
    classification when the target has fewer than 20 distinct values. Folds are independent
    jobs and are submitted from a few driver threads.
    """
    placed, folds = assign_folds(df, cv_method, n_folds, ts=ts, seed=seed)
    rows = materialize(placed)
    if scoring is None:
        few = few_values(rows, "label")
        scores = ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted") if few else ("MSE", "MAE", "R2")
        make = M.weighted_scores if few else M.regression_errors
    else:
        make, column, sign = M.SCORERS[scoring]
        scores = (column,)

    def one(fold):
        number, training = fold
        _, predicted = fit_predict(rows.where(training), rows.where(F.col("fold") == number), features, factory, params, scale,
                                   balance, class_weight, seed)
        row = make(predicted, "label", "prediction").first()
        return [(name, int(number), scoring or s, (sign if scoring else 1) * float(row[s])) for s in scores]

    with ThreadPoolExecutor(max_workers=threads) as pool:
        done = list(pool.map(inheritable_thread_target(df.sparkSession)(one), folds))
    return df.sparkSession.createDataFrame([r for part in done for r in part], "model string, fold int, metric string, value double")


def benchmark_classifiers(df: DataFrame, features: list[str], n_folds: int = 5, cv_method: str = "stratified", balance: str | None = None,
                          settings: dict | None = None, scale: bool = True) -> DataFrame:
    """The registered classifiers by cross-validation: mean scores, best F1 first."""
    defaults = {"KNN": {"n_neighbors": 5}}
    df, out = materialize(df), None
    for name, factory in models.CLASSIFIERS.items():
        params = (settings or {}).get(name, defaults.get(name, {}))
        one = cross_validate(df, features, factory, params, n_folds, cv_method, None, scale, balance, name=name)
        out = one if out is None else out.unionByName(one)
    wide = out.groupBy("model").pivot("metric", ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted"]).agg(F.avg("value"))
    return wide.toDF("Modelo", "Accuracy", "Precision", "Recall", "F1").orderBy(F.desc("F1"), "Modelo")


def benchmark_regressors(df: DataFrame, features: list[str], settings: dict | None = None) -> DataFrame:
    """The registered regressors on one split, least RMSE first. Tree models are not scaled."""
    df, out = materialize(df), None
    for name, factory in models.REGRESSORS.items():
        scale = name not in ("Decision Tree", "Random Forest", "XGBoost")
        _, errors = train_regressor(df, features, factory, (settings or {}).get(name, {}), scale=scale)
        one = errors.select(F.lit(name).alias("Modelo"), "RMSE", "MAE", "ER")
        out = one if out is None else out.unionByName(one)
    return out.orderBy("RMSE", "Modelo")


def benchmark_balancing(df: DataFrame, features: list[str], factory=models.random_forest, params=None, n_folds: int = 5,
                        scoring: str = "accuracy", cv_method: str = "stratified", scale: bool = True) -> DataFrame:
    """The same model without and with each balancing method: mean and std, best first.

    Models without row weights get NULL for ``class_weight``.
    """
    df, rows = materialize(df), []
    for method in ("none", "oversample", "undersample", "smote", "class_weight"):
        weight = "balanced" if method == "class_weight" else None
        if weight and not models.accepts(factory(dict(params or {})), "weightCol"):
            rows.append((method, None, None))
            continue
        scores = cross_validate(df, features, factory, params, n_folds, cv_method, scoring, scale,
                                None if weight else method, weight, name=method)
        s = scores.agg(F.avg("value"), F.stddev_pop("value")).first()
        rows.append((method, float(s[0]), float(s[1])))
    out = df.sparkSession.createDataFrame(rows, "Balance string, Promedio double, Std double")
    return out.orderBy(F.desc_nulls_last("Promedio"), "Balance")


# Search spaces, (kind, low, high) per parameter.
FOREST_SPACE = {"n_estimators": ("int", 50, 200), "max_depth": ("int", 3, 20), "min_samples_split": ("int", 2, 10), "min_samples_leaf": ("int", 1, 5)}
BOOSTING_SPACE = {"n_estimators": ("int", 50, 200), "learning_rate": ("real", 0.01, 0.3), "max_depth": ("int", 3, 10), "min_samples_split": ("int", 2, 10)}


def evolve(df: DataFrame, features: list[str], factory, space: dict, scoring: str = "accuracy", population: int = 8, generations: int = 8,
           n_folds: int = 3, seed: int = 42) -> DataFrame:
    """Evolutionary search over a parameter space; an individual's fitness is a Spark cross-validation.

    The driver holds only the population. Returns one row per evaluated individual:
    (generation, params, score), best first.
    """
    rng, known = random.Random(seed), {}
    df = materialize(df)

    def draw(kind, low, high):
        return rng.randint(low, high) if kind == "int" else round(rng.uniform(low, high), 4)

    def fitness(one):
        key = tuple(sorted(one.items()))
        if key not in known:
            scores = cross_validate(df, features, factory, one, n_folds, "stratified" if scoring == "accuracy" else "kfold", scoring, scale=False)
            known[key] = float(scores.agg(F.avg("value")).first()[0])
        return known[key]

    people, history = [{k: draw(*v) for k, v in space.items()} for _ in range(population)], []
    for generation in range(generations + 1):
        ranked = sorted(people, key=fitness, reverse=True)
        history += [(generation, one, fitness(one)) for one in ranked]
        if generation == generations:
            break
        children = [ranked[0]]
        while len(children) < population:
            mother, father = (max(rng.sample(ranked, min(3, len(ranked))), key=fitness) for _ in range(2))
            child = {k: (mother if rng.random() < 0.5 else father)[k] for k in space}
            for k, v in space.items():
                if rng.random() < 0.2:
                    child[k] = draw(*v)
            children.append(child)
        people = children
    table = [(g, {k: float(v) for k, v in one.items()}, s) for g, one, s in history]
    return df.sparkSession.createDataFrame(table, "generation int, params map<string,double>, score double").orderBy(F.desc("score"), "generation")
