"""Supervised models behind one interface: ``factory(params) -> learner``, ``learner.fit(df) -> model``,
``model.transform(df)`` adds ``prediction``. Rows carry ``row_id``, ``features`` (vector) and ``label``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import neighbors as N
from . import scale as S
from .boosting import Boosted

MAX_DEPTH = 30           # deepest tree the tree learners accept; stands for "unlimited"


class Prepared:
    """Median imputation and optional scaling learned on training rows, then assembly."""

    def __init__(self, train: DataFrame, features: list[str], scale: bool):
        self.features, self.scale = features, scale
        self.stats = S.learn(train, features)
        complete = not any(self.stats[c]["missing"] for c in features)
        # filling changes mean and spread; without gaps the first statistics already hold
        self.spread = self.stats if complete or not scale else S.learn(
            S.impute_median(train, features, self.stats), features, median=False)

    def apply(self, df: DataFrame, keep: list[str]) -> DataFrame:
        out = S.impute_median(df, self.features, self.stats)
        if self.scale:
            out = S.standardize(out, self.features, self.spread)
        return VectorAssembler(inputCols=self.features, outputCol="features").transform(out).select(*keep, "features")


class Knn:
    """Majority vote of the nearest training rows; ties go to the smallest label."""

    def __init__(self, n_neighbors: int = 3):
        self.k, self.train = n_neighbors, None

    def fit(self, df: DataFrame) -> "Knn":
        model = Knn(self.k)
        model.train = df.select(F.col("row_id").alias("pid"), vector_to_array("features").alias("x"), "label")
        return model

    def transform(self, df: DataFrame) -> DataFrame:
        queries = df.select(F.col("row_id").alias("qid"), vector_to_array("features").alias("x"))
        near = N.nearest(queries, self.train.select("pid", "x"), self.k)
        votes = N.vote(near, self.train.select("pid", "label"))
        return df.join(votes.withColumnRenamed("qid", "row_id"), "row_id")


class AdaBoost:
    """SAMME boosting of depth-limited trees; the row weights are written out every few rounds."""

    def __init__(self, n_estimators: int = 50, max_depth: int = 1, learning_rate: float = 1.0, seed: int = 42, keep_rounds: int = 5):
        self.rounds, self.depth, self.rate, self.seed, self.keep_rounds = n_estimators, max_depth, learning_rate, seed, keep_rounds

    def fit(self, df: DataFrame) -> "AdaBoostModel":
        n, k = df.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
        rows = materialize(df.select("features", "label", F.lit(1.0 / n).alias("w")))
        trees, weights = [], []
        for i in range(self.rounds):
            tree = DecisionTreeClassifier(maxDepth=self.depth, weightCol="w", seed=self.seed).fit(rows)
            seen = tree.transform(rows).select("features", "label", "w", (F.col("prediction") != F.col("label")).alias("_miss"))
            miss, total = seen.agg(F.sum(F.when(F.col("_miss"), F.col("w")).otherwise(0.0)), F.sum("w")).first()
            error = miss / total
            if error >= 1 - 1 / k:
                break
            weight = self.rate * (math.log((1 - error) / max(error, 1e-10)) + math.log(k - 1))
            trees.append(tree), weights.append(weight)
            if error <= 0:
                break
            grown = F.col("w") / total * F.when(F.col("_miss"), math.exp(weight)).otherwise(1.0)
            rows = seen.select("features", "label", grown.alias("w"))
            if (i + 1) % self.keep_rounds == 0:
                rows = materialize(rows)
        return AdaBoostModel(trees, weights)


class AdaBoostModel:
    def __init__(self, trees, weights):
        self.trees, self.weights = trees, weights

    def transform(self, df: DataFrame) -> DataFrame:
        out, names = df, []
        for i, tree in enumerate(self.trees):
            names.append(f"_p{i}")
            out = tree.setPredictionCol(names[-1]).setRawPredictionCol("").setProbabilityCol("").transform(out)
        votes = F.array(*[F.struct(F.col(c).alias("y"), F.lit(w).alias("w")) for c, w in zip(names, self.weights)])
        classes = F.array_sort(F.array_distinct(F.transform(votes, lambda v: v["y"])))
        strength = F.transform(classes, lambda y: F.struct(
            F.aggregate(F.filter(votes, lambda v: v["y"] == y), F.lit(0.0), lambda s, v: s + v["w"]).alias("w"), (-y).alias("y")))
        return out.withColumn("prediction", -F.array_max(strength)["y"]).drop(*names)


def _depth(params, default=None):
    """The wanted depth; None means as deep as the tree learners go, which is ``MAX_DEPTH``."""
    depth = params.get("max_depth", default)
    if depth is not None and int(depth) > MAX_DEPTH:
        raise ValueError(f"max_depth {depth} is beyond the tree learners' limit of {MAX_DEPTH}")
    return MAX_DEPTH if depth is None else int(depth)


def _leaf(params):
    return max(int(params.get("min_samples_leaf", 1)), (int(params.get("min_samples_split", 2)) + 1) // 2)


def decision_tree(p: dict):
    return DecisionTreeClassifier(impurity="gini", maxDepth=_depth(p), minInstancesPerNode=_leaf(p), seed=p.get("seed", 42))


def random_forest(p: dict):
    return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)), maxDepth=_depth(p), featureSubsetStrategy="sqrt",
                                  minInstancesPerNode=_leaf(p), seed=p.get("seed", 42))


def gradient_boosting(p: dict):
    """Boosted trees, one multinomial model for all classes."""
    return Boosted(int(p.get("n_estimators", 100)), p.get("max_depth", 3), float(p.get("learning_rate", 0.1)),
                   int(p.get("min_samples_split", 2)), int(p.get("min_samples_leaf", 1)))


def ada_boost(p: dict):
    return AdaBoost(int(p.get("n_estimators", 50)), int(p.get("max_depth", 1)), float(p.get("learning_rate", 1.0)))


def knn(p: dict):
    return Knn(int(p.get("n_neighbors", 3)))


CLASSIFIERS: dict[str, Callable[[dict], object]] = {
    "KNN": knn, "Decision Tree": decision_tree, "Random Forest": random_forest, "XGBoost": gradient_boosting, "AdaBoost": ada_boost}


def accepts(learner, name: str) -> bool:
    """Does the learner take a parameter of this name (``weightCol``, ``seed``, ...)?"""
    if hasattr(learner, "hasParam"):
        return learner.hasParam(name)
    return hasattr(learner, name)


def linear(p: dict):
    return LinearRegression(regParam=0.0, solver="normal")


def lasso(p: dict):
    return LinearRegression(regParam=float(p.get("alpha", 0.1)), elasticNetParam=1.0, standardization=False, maxIter=1000, tol=1e-9)


class Ridge:
    """L2 regression with penalty ``alpha`` on the coefficients (intercept free).

    The library scales the label by its deviation, so the penalty is alpha / n * deviation.
    """

    def __init__(self, alpha: float = 1.0):
        self.alpha = alpha

    def fit(self, df: DataFrame):
        n, s = df.agg(F.count("label"), F.stddev_pop("label")).first()
        # solver uses the population-scaled label
        return LinearRegression(regParam=self.alpha / n * (s or 1.0), elasticNetParam=0.0, standardization=False, solver="normal").fit(df)


def ridge(p: dict):
    return Ridge(float(p.get("alpha", 1.0)))


def support_vector(p: dict):
    from .neural import KernelSvr
    return KernelSvr(c=float(p.get("C", 100)), epsilon=float(p.get("epsilon", 0.1)), width=int(p.get("width", 200)), iterations=int(p.get("iterations", 100)))


def tree_regressor(p: dict):
    return DecisionTreeRegressor(maxDepth=_depth(p, 3), minInstancesPerNode=_leaf(p), seed=p.get("seed", 42))


def forest_regressor(p: dict):
    return RandomForestRegressor(numTrees=int(p.get("n_estimators", 100)), maxDepth=_depth(p), featureSubsetStrategy="all",
                                 minInstancesPerNode=_leaf(p), seed=p.get("seed", 42))


def boosted_regressor(p: dict):
    return GBTRegressor(maxIter=int(p.get("n_estimators", 100)), maxDepth=_depth(p, 4), stepSize=float(p.get("learning_rate", 0.1)),
                        minInstancesPerNode=_leaf(p), seed=p.get("seed", 42))


REGRESSORS: dict[str, Callable[[dict], object]] = {
    "Lineal": linear, "Lasso": lasso, "Ridge": ridge, "SVM (RBF)": support_vector, "Decision Tree": tree_regressor,
    "Random Forest": forest_regressor, "XGBoost": boosted_regressor}
