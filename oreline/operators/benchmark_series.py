"""Comparison of forecast models on the tail of every series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import arima, smoothing
from .series import forecast_errors, positions, simple_forecasts, split_tail


def _aligned(forecasts: DataFrame, test: DataFrame) -> DataFrame:
    """Give step h the time of the h-th test point."""
    numbered = positions(test).select("series_id", F.col("pos").cast("int").alias("step"), F.col("ts").alias("_ts"))
    return forecasts.join(numbered, ["series_id", "step"]).select("series_id", "model", F.col("_ts").alias("ts"), "yhat")


def _complete(forecasts: DataFrame, test: DataFrame) -> DataFrame:
    """Drop a model for a series when a test point has no finite forecast."""
    want = test.groupBy("series_id").agg(F.count(F.lit(1)).alias("_want"))
    good = forecasts.where(F.col("yhat").isNotNull() & ~F.isnan("yhat"))
    have = good.groupBy("series_id", "model").agg(F.count(F.lit(1)).alias("_have"))
    keep = have.join(want, "series_id").where(F.col("_have") == F.col("_want")).select("series_id", "model")
    return good.join(keep, ["series_id", "model"])


def benchmark(series: DataFrame, test_size: float = 0.2, m: int | None = None, models=("hw", "hw_cal", "arima", "arima_cal"),
              order: arima.Order = arima.Order(1, 1, 1), step: float = 0.1, freq: str = "D") -> DataFrame:
    """MSE, RMSE, RE and CORR per series and model; ``"simple"`` adds mean, naive and drift."""
    parts = materialize(split_tail(series, test_size))
    train = parts.where("split = 'train'").select("series_id", "ts", "value")
    test = parts.where("split = 'test'").select("series_id", "ts", "value")
    longest = test.groupBy("series_id").count().agg(F.max("count")).first()[0] or 0
    if longest == 0:
        raise ValueError("the test part is empty")
    arms = []
    if "simple" in models:
        arms.append(_aligned(simple_forecasts(train, longest), test))
    if "hw" in models:
        arms.append(_aligned(smoothing.fit_forecast(train, longest, m=m, freq=freq), test))
    if "hw_cal" in models:
        arms.append(_aligned(smoothing.calibrated_forecast(train, test, longest, step, m=m, freq=freq), test))
    if "arima" in models:
        arms.append(_aligned(arima.forecast(train, longest, order), test))
    if "arima_cal" in models:
        arms.append(arima.calibrated_walk_forward(train, test, (0, 1), (0, 1), (0, 1)))
    made = arms[0]
    for one in arms[1:]:
        made = made.unionByName(one)
    return forecast_errors(_complete(materialize(made), test), test)
