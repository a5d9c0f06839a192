"""Perceptron queries on the labelled documents and the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import neural as NN
from ..operators import scale as S
from ..operators import split as P
from ..session import materialize
from .profiles import rounded
from .registry import query
from .supervised import DOC_FEATURES, PART_FEATURES, documents, parts


def _split_documents(spark, sf):
    parted = materialize(P.stratified_split(documents(spark, sf), "row_id", "label"))
    return parted.where("split = 'train'"), parted.where("split = 'test'")


def _predicted(spark, sf, network):
    train, test = _split_documents(spark, sf)
    _, out = NN.evaluate_network(train, test, DOC_FEATURES, network)
    return materialize(out)


@query("nn1_perceptron_adam")
def perceptron_adam(spark, sf):
    return _predicted(spark, sf, NN.Mlp((20, 10), "relu", "adam", 15, rate=0.01, batch=32))


@query("nn1_perceptron_lbfgs")
def perceptron_lbfgs(spark, sf):
    return _predicted(spark, sf, NN.Mlp((20, 10), "tanh", "lbfgs", 10))


@query("nn1_perceptron_values")
def perceptron_values(spark, sf):
    parted = materialize(P.random_split(parts(spark, sf), "row_id"))
    train, test = parted.where("split = 'train'"), parted.where("split = 'test'")
    _, out = NN.evaluate_network(train, test, PART_FEATURES, NN.Mlp((16,), "relu", "lbfgs", 10, task="regression"))
    return rounded(out, 4)


@query("nn2_dense_relu")
def dense_relu(spark, sf):
    return _predicted(spark, sf, NN.dense_network("relu", (16, 8), 10))


@query("nn3_dense_tanh")
def dense_tanh(spark, sf):
    return _predicted(spark, sf, NN.dense_network("tanh", (16, 8), 10))


@query("nn4_encoded_and_scaled",
       "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS label, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS x FROM orders")
def encoded_and_scaled(spark, sf):
    from ..sources.tables import table
    df, _ = S.label_index(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("x")), "o_orderstatus")
    return rounded(S.standardize(df, ["x"])).select("o_orderkey", "label", "x")


@query("nn5_network_metrics")
def network_metrics(spark, sf):
    out = _predicted(spark, sf, NN.Mlp((16,), "tanh", "lbfgs", 10))
    return rounded(M.accuracy_table(M.label_counts(out, "label", "prediction")))


@query("nn6_benchmark_networks")
def benchmark_networks(spark, sf):
    train, test = _split_documents(spark, sf)
    nets = {"MLP (relu+adam)": NN.Mlp((16, 8), "relu", "adam", 8, batch=32), "Densa ReLU": NN.dense_network("relu", (16, 8), 5),
            "Densa Tanh": NN.dense_network("tanh", (16, 8), 5)}
    return rounded(NN.compare_networks(train, test, DOC_FEATURES, nets))


@query("top3_best_network")
def best_network(spark, sf):
    return benchmark_networks(spark, sf).orderBy(F.desc("accuracy"), "Modelo").limit(1)


@query("nn7_best_network_classes")
def best_network_classes(spark, sf):
    """Three solver/activation pairs; class rates of the most accurate one."""
    train, test = _split_documents(spark, sf)
    best = None
    for name, act, solver in (("relu + adam", "relu", "adam"), ("tanh + adam", "tanh", "adam"), ("tanh + lbfgs", "tanh", "lbfgs")):
        _, out = NN.evaluate_network(train, test, DOC_FEATURES, NN.Mlp((16, 8), act, solver, 8, batch=32))
        counts = materialize(M.confusion(out.withColumn("label", F.col("label").cast("double")), "label", "prediction"))
        accuracy = M.accuracy_table(counts).first()["accuracy"]
        if best is None or accuracy > best[1]:
            best = (name, accuracy, counts)
    rates = M.class_rates(best[2])
    return rounded(best[2].join(rates, "actual").select(F.lit(best[0]).alias("Modelo"), "actual", "predicted", "n", "rate"))
