"""Many series in one table ``(series_id, ts, value)``: repair, splits, simple forecasts, errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.dates import advance, epoch_seconds, frequency_of
from ..functions.numbers import pearson
from ..session import shuffle_width
from .quantiles import grouped_quantiles
from .ranking import even_cells, lagged, time_order

KEY = ["series_id"]


def positions(series: DataFrame) -> DataFrame:
    """Add the 1-based position ``pos`` and the series length ``n``."""
    return time_order(series, KEY, "ts")


def fill_missing(series: DataFrame) -> DataFrame:
    """Forward fill, then backward fill, per series.

    Inside a slice of time by window; across slices from the last (first) known value of the
    neighbouring slices, a table with one row per series and slice.
    """
    cell = even_cells(series, epoch_seconds(F.col("ts")), 4 * shuffle_width(series.sparkSession))
    cut = series.withColumn("_cell", cell)
    inside = W.partitionBy(*KEY, "_cell").orderBy("ts")
    local = cut.withColumns({
        "_f": F.last("value", True).over(inside.rowsBetween(W.unboundedPreceding, 0)),
        "_b": F.first("value", True).over(inside.rowsBetween(0, W.unboundedFollowing))})
    known = cut.where(F.col("value").isNotNull())
    ends = cut.groupBy(*KEY, "_cell").agg(F.count(F.lit(1)).alias("_rows")).join(
        known.groupBy(*KEY, "_cell").agg(F.max_by("value", "ts").alias("_last"), F.min_by("value", "ts").alias("_first")),
        [*KEY, "_cell"], "left")
    along = W.partitionBy(*KEY).orderBy("_cell")
    carry = ends.select(
        F.col("series_id").alias("_sid"), F.col("_cell").alias("_cc"),
        F.last("_last", True).over(along.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", True).over(along.rowsBetween(1, W.unboundedFollowing)).alias("_after"))
    joined = local.join(carry, F.col("series_id").eqNullSafe(F.col("_sid")) & (F.col("_cell") == F.col("_cc")))
    return joined.select("series_id", "ts", F.coalesce("_f", "_before", "_b", "_after").alias("value"))


def lag_difference(series: DataFrame, d: int = 1) -> DataFrame:
    """x(t) - x(t-d); the first d points have no difference."""
    lag = lagged(positions(series), KEY, "pos", {"_lag": ("value", d)})
    return lag.select("series_id", "ts", (F.col("value") - F.col("_lag")).alias("value"))


def lag_frame(series: DataFrame, p: int) -> DataFrame:
    """Supervised frame: the p previous values ``lag_p .. lag_1`` and the current one ``y``."""
    names = {f"lag_{k}": ("value", k) for k in range(p, 0, -1)}
    frame = lagged(positions(series), KEY, "pos", names).where(F.col("pos") > p)
    return frame.select("series_id", "ts", *names, F.col("value").alias("y"))


def split_tail(series: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Add ``split``: the last int(n * test_size) points of each series are the test part."""
    n_test = F.floor(F.col("n") * F.lit(float(test_size)))
    return positions(series).withColumn(
        "split", F.when(F.col("pos") > F.col("n") - n_test, "test").otherwise("train"))


def frequency(series: DataFrame) -> DataFrame:
    """(series_id, gap_days, freq) from the most common gap; ties go to the shorter gap."""
    gaps = lagged(positions(series), KEY, "pos", {"_prev": ("ts", 1)})
    counted = (gaps.where(F.col("_prev").isNotNull())
               .groupBy("series_id", F.datediff("ts", "_prev").alias("gap_days"))
               .agg(F.count(F.lit(1)).alias("_c")))
    usual = counted.groupBy("series_id").agg(
        F.max_by("gap_days", F.struct("_c", -F.col("gap_days"))).alias("gap_days"))
    return usual.withColumn("freq", frequency_of(F.col("gap_days")))


def summary(series: DataFrame) -> DataFrame:
    """Length, mean and end points of each series, one partial aggregate."""
    return series.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
        F.min_by("value", "ts").alias("first"), F.max_by("value", "ts").alias("last"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def info(series: DataFrame) -> DataFrame:
    """Describe every series: count, range, frequency, mean, std, min, quartiles, max."""
    base = series.groupBy("series_id").agg(
        F.count("value").alias("count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quart = grouped_quantiles(series, KEY, "value", [0.25, 0.5, 0.75]).select(
        "series_id", F.col("p1").alias("p25"), F.col("p2").alias("p50"), F.col("p3").alias("p75"))
    return base.join(quart, "series_id").join(frequency(series).select("series_id", "freq"), "series_id", "left")


def with_frequency(per_series: DataFrame, series: DataFrame, freq: str | None) -> DataFrame:
    """Add ``freq``: the given one, or the inferred one of each series when None."""
    if freq is not None:
        return per_series.withColumn("freq", F.lit(freq))
    return per_series.join(frequency(series).select("series_id", "freq"), "series_id", "left") \
        .withColumn("freq", F.coalesce("freq", F.lit("D")))


def horizon(per_series: DataFrame, steps: int) -> DataFrame:
    """One row per future step of each series: adds ``step`` and its time ``ts``.

    Needs ``last_ts`` and ``freq``.
    """
    return (per_series.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
            .withColumn("ts", advance(F.col("last_ts"), F.col("step"), F.col("freq"))))


def simple_forecasts(series: DataFrame, steps: int, models=("meanf", "naive", "drift"),
                     freq: str | None = "D", textbook_drift: bool = False) -> DataFrame:
    """Mean, last-value and drift forecasts (series_id, model, step, ts, yhat) from one aggregate.

    The drift slope is (last - first)/n and the first forecast equals the last value;
    ``textbook_drift`` uses (last - first)/(n - 1) and starts one slope later.
    """
    per = with_frequency(summary(series), series, freq)
    if textbook_drift:
        drift = F.col("last") + F.try_divide(F.col("last") - F.col("first"), F.col("n") - 1) * F.col("step")
    else:
        drift = F.col("last") + (F.col("last") - F.col("first")) / F.col("n") * (F.col("step") - 1)
    rules = {"meanf": F.col("mean"), "naive": F.col("last"), "drift": drift}
    arms = F.array(*[F.struct(F.lit(m).alias("model"), rules[m].alias("yhat")) for m in models])
    return (horizon(per, steps).select("series_id", "step", "ts", F.explode(arms).alias("_a"))
            .select("series_id", "_a.model", "step", "ts", "_a.yhat"))


def seasonal_naive(series: DataFrame, steps: int, h: int = 1, freq: str | None = "D") -> DataFrame:
    """Repeat the last h values in order."""
    tail = positions(series).where(F.col("pos") > F.col("n") - h)
    place = F.col("pos") - F.greatest(F.col("n") - h, F.lit(0))          # 1 .. h
    cycle = F.least(F.col("n"), F.lit(h))
    repeats = (tail.withColumn("_i", place).where(F.col("_i") <= steps)
               .withColumn("step", F.explode(F.sequence(F.col("_i"), F.lit(steps).cast("bigint"), cycle))))
    last = with_frequency(summary(series).select("series_id", "last_ts"), series, freq)
    return (repeats.select("series_id", F.col("step").cast("int").alias("step"), F.col("value").alias("yhat"))
            .join(last, "series_id")
            .select("series_id", F.lit("snaive").alias("model"), "step",
                    advance(F.col("last_ts"), F.col("step"), F.col("freq")).alias("ts"), "yhat"))


def forecast_errors(forecasts: DataFrame, actual: DataFrame, round_to: int | None = None) -> DataFrame:
    """RSS, MSE, RMSE, RE and CORR per series and model (CORR 0 when undefined)."""
    joined = forecasts.select("series_id", "model", "ts", "yhat").join(
        actual.select("series_id", "ts", "value"), ["series_id", "ts"])
    e = F.col("yhat") - F.col("value")
    out = joined.groupBy("series_id", "model").agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("RSS"), F.avg(e * e).alias("MSE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        F.try_divide(F.sum(F.abs(e)), F.sum(F.abs("value"))).alias("RE"),
        F.coalesce(pearson(F.col("value"), F.col("yhat")), F.lit(0.0)).alias("CORR"))
    if round_to is not None:
        out = out.withColumns({c: F.round(c, round_to) for c in ("RSS", "MSE", "RMSE", "RE", "CORR")})
    return out


def scaled_errors(errors: DataFrame, metrics=("MSE", "RMSE", "RE", "CORR")) -> DataFrame:
    """Per series and metric: minus the minimum, over the maximum, times 100.

    The table has one row per model, so the window stays small.
    """
    w = W.partitionBy("series_id")
    shifted = errors.withColumns({m: F.col(m) - F.min(m).over(w) for m in metrics})
    return shifted.withColumns({m: F.when(F.max(m).over(w) > 0, F.col(m) / F.max(m).over(w) * 100)
                                .otherwise(F.col(m)) for m in metrics}).select("series_id", "model", *metrics)


def error_radar(errors: DataFrame, metrics=("MSE", "RMSE", "RE", "CORR")) -> DataFrame:
    """Radar points; a series with a single model shows 100 on every axis."""
    alone = F.count(F.lit(1)).over(W.partitionBy("series_id")) == 1
    flagged = scaled_errors(errors, metrics).withColumn("_alone", alone)
    return flagged.withColumns({m: F.when(F.col("_alone"), F.lit(100.0)).otherwise(F.col(m)) for m in metrics}).drop("_alone")
