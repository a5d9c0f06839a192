"""Quality measures of predictions, all from grouped or global aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LABEL_LIMIT = 10_000


def label_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Dense confusion table (actual, predicted, n) over the sorted labels of both columns."""
    counts = label_counts(df, actual, predicted)
    both = counts.select(F.explode(F.array(F.col("actual"), F.col("predicted").cast(dict(counts.dtypes)["actual"]))).alias("v"))
    labels = sorted(r["v"] for r in both.where("v IS NOT NULL").distinct().limit(LABEL_LIMIT + 1).collect())
    if len(labels) > LABEL_LIMIT:
        raise ValueError(f"more than {LABEL_LIMIT} labels")
    kind = dict(counts.dtypes)["actual"]
    names = F.array(*[F.lit(v) for v in labels]).cast(f"array<{kind}>")
    spark = df.sparkSession
    cells = (spark.range(1).select(F.explode(names).alias("actual"))
             .select("actual", F.explode(names).alias("predicted")))
    full = cells.join(counts.select("actual", F.col("predicted").cast(kind).alias("predicted"), "n"), ["actual", "predicted"], "left")
    return full.select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def accuracy_table(counts: DataFrame) -> DataFrame:
    """Global accuracy and error, one row; from (actual, predicted, n)."""
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.agg((hit / F.sum("n")).alias("accuracy"), (1 - hit / F.sum("n")).alias("error"))


def class_rates(counts: DataFrame) -> DataFrame:
    """Hits over row total per class (the recall of the class); 0 when the class is empty."""
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.groupBy("actual").agg(F.coalesce(F.try_divide(hit, F.sum("n")), F.lit(0.0)).alias("rate"))


def weighted_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (0 where undefined), one row."""
    counts = label_counts(df, actual, predicted)
    both = F.array(F.struct(F.col("actual").cast("double").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed")),
                   F.struct(F.col("predicted").cast("double").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed")))
    hit = F.when(F.col("actual").cast("double") == F.col("predicted").cast("double"), F.col("n")).otherwise(0)
    per = (counts.withColumn("_hit", hit).select("_hit", F.posexplode(both).alias("_side", "_s"))
           .groupBy("_s.label").agg(F.sum("_s.support").alias("support"), F.sum("_s.claimed").alias("claimed"),
                                    F.sum(F.when(F.col("_side") == 0, F.col("_hit"))).alias("tp")))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("claimed")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    total = F.sum("support")
    return per.agg((F.sum("tp") / total).alias("accuracy"), (F.sum(p * F.col("support")) / total).alias("precision_weighted"),
                   (F.sum(r * F.col("support")) / total).alias("recall_weighted"), (F.sum(f1 * F.col("support")) / total).alias("f1_weighted"))


def regression_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE, ER (absolute error over absolute total), MSE and R2, one row."""
    y, e = F.col(actual).cast("double"), F.col(predicted).cast("double") - F.col(actual).cast("double")
    return df.agg(
        F.sqrt(F.avg(e * e)).alias("RMSE"), F.avg(F.abs(e)).alias("MAE"),
        F.try_divide(F.sum(F.abs(e)), F.sum(F.abs(y))).alias("ER"), F.avg(e * e).alias("MSE"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("R2"))


def class_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Plain means over the classes of both columns (0 where undefined), one row: macro precision, recall and F1, and the
    balanced accuracy, which is the mean recall of the classes that occur."""
    counts = label_counts(df, actual, predicted)
    both = F.array(F.struct(F.col("actual").cast("double").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed")),
                   F.struct(F.col("predicted").cast("double").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed")))
    hit = F.when(F.col("actual").cast("double") == F.col("predicted").cast("double"), F.col("n")).otherwise(0)
    per = (counts.withColumn("_hit", hit).select("_hit", F.posexplode(both).alias("_side", "_s")).groupBy("_s.label")
           .agg(F.sum("_s.support").alias("support"), F.sum("_s.claimed").alias("claimed"), F.sum(F.when(F.col("_side") == 0, F.col("_hit"))).alias("tp")))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("claimed")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return per.agg(F.avg(p).alias("precision_macro"), F.avg(r).alias("recall_macro"), F.avg(f1).alias("f1_macro"),
                   F.avg(F.when(F.col("support") > 0, r)).alias("balanced_accuracy"))


def relative_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Explained variance, mean absolute percentage error (over rows with an actual value other than 0) and largest error."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.agg((1 - F.try_divide(F.var_pop(e), F.var_pop(y))).alias("explained_variance"),
                  F.avg(F.try_divide(F.abs(e), F.abs(y))).alias("MAPE"), F.max(F.abs(e)).alias("max_error"))


# scorer name -> (aggregate table, column, sign); larger is better after the sign
SCORERS = {
    "accuracy": (weighted_scores, "accuracy", 1), "precision_weighted": (weighted_scores, "precision_weighted", 1),
    "recall_weighted": (weighted_scores, "recall_weighted", 1), "f1_weighted": (weighted_scores, "f1_weighted", 1),
    "r2": (regression_errors, "R2", 1), "neg_mean_squared_error": (regression_errors, "MSE", -1),
    "precision_macro": (class_scores, "precision_macro", 1), "recall_macro": (class_scores, "recall_macro", 1),
    "f1_macro": (class_scores, "f1_macro", 1), "balanced_accuracy": (class_scores, "balanced_accuracy", 1),
    "precision_micro": (weighted_scores, "accuracy", 1), "recall_micro": (weighted_scores, "accuracy", 1), "f1_micro": (weighted_scores, "accuracy", 1),
    "explained_variance": (relative_errors, "explained_variance", 1), "max_error": (relative_errors, "max_error", -1),
    "neg_mean_absolute_percentage_error": (relative_errors, "MAPE", -1),
    "neg_mean_absolute_error": (regression_errors, "MAE", -1), "neg_root_mean_squared_error": (regression_errors, "RMSE", -1),
}


def score(df: DataFrame, actual: str, predicted: str, name: str) -> float:
    if name not in SCORERS:
        raise ValueError(f"unknown scorer {name!r}")
    make, column, sign = SCORERS[name]
    return sign * float(make(df, actual, predicted).first()[column])


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean, population std, min and max per (model, metric) of a fold table."""
    return scores.groupBy("model", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
