"""Time-series queries: daily event totals (5 series) and daily revenue per return flag."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import arima as A
from ..operators import benchmark_series as BS
from ..operators import series as S
from ..operators import smoothing as H
from ..operators import spectrum as P
from ..session import materialize, scratch_dir
from ..sources.csv import write_csv
from ..sources.series import checked_series, read_series, totals
from ..sources.tables import table
from .profiles import rounded
from .registry import query

_S = ("s AS (SELECT event_type AS series_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, "
      "round(sum(value), 4) AS value FROM events GROUP BY 1, 2), "
      "p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos, "
      "count(*) OVER (PARTITION BY series_id) AS n FROM s)")
_R = ("s AS (SELECT l_returnflag AS series_id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts, "
      "round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY 1, 2), "
      "p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos, "
      "count(*) OVER (PARTITION BY series_id) AS n FROM s)")
_SPLIT = (", cut AS (SELECT *, pos > n - CAST(floor(n * 0.2) AS BIGINT) AS held FROM p), "
          "train AS (SELECT series_id, ts, value, pos, count(*) OVER (PARTITION BY series_id) AS n FROM cut WHERE NOT held), "
          "test AS (SELECT series_id, ts, value, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS step FROM cut WHERE held)")


def daily_events(spark, sf):
    s = totals(table(spark, sf, "events").select("event_type", "ts", "value"), "event_type", "ts", "value")
    return s.withColumn("value", F.round("value", 4))


def daily_revenue(spark, sf):
    s = totals(table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice"),
               "l_returnflag", "l_shipdate", "l_extendedprice")
    return s.withColumn("value", F.round("value", 2))


def train_test(series, share=0.2):
    parts = materialize(S.split_tail(series, share))
    return (parts.where("split = 'train'").select("series_id", "ts", "value"),
            parts.where("split = 'test'").select("series_id", "ts", "value"))


@query("src3_series_load", f"WITH {_S} SELECT series_id, ts, value FROM s")
def series_load(spark, sf):
    path = f"{scratch_dir(spark)}/series-{uuid.uuid4().hex}"
    d = daily_events(spark, sf).select(F.expr("concat(day(ts), '/', month(ts), '/', year(ts))").alias("fecha"), "value",
                                       F.col("series_id").alias("serie"))
    write_csv(d, path)
    return read_series(spark, path, "fecha string, value double, serie string", series_col="serie")


_GAPS = "CASE WHEN extract(day FROM ts) % 5 = 0 OR extract(day FROM ts) = 1 THEN NULL ELSE value END"


@query("ts1_load_check_fill",
       f"WITH {_S}, g AS (SELECT series_id, ts, {_GAPS} AS value FROM s) SELECT series_id, ts, "
       "coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING), "
       "first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM g")
def load_check_fill(spark, sf):
    raw = daily_events(spark, sf).withColumn("value", F.expr("CASE WHEN day(ts) % 5 = 0 OR day(ts) = 1 THEN 'sin dato' ELSE cast(value AS string) END"))
    return S.fill_missing(checked_series(raw, "series_id", "ts", "value"))


@query("win2_forward_backward_fill",
       f"WITH {_R}, g AS (SELECT series_id, ts, CASE WHEN value < 200000 THEN NULL ELSE value END AS value FROM s) SELECT series_id, ts, "
       "coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING), "
       "first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM g")
def fill_both(spark, sf):
    return S.fill_missing(daily_revenue(spark, sf).withColumn("value", F.when(F.col("value") >= 200000, F.col("value"))))


@query("flt9_dated_points",
       f"WITH {_S}, g AS (SELECT series_id, ts, {_GAPS} AS value FROM s) SELECT series_id, ts, value FROM g WHERE value IS NOT NULL")
def dated_points(spark, sf):
    raw = daily_events(spark, sf).withColumn("value", F.expr("CASE WHEN day(ts) % 5 = 0 OR day(ts) = 1 THEN NULL ELSE value END"))
    return checked_series(raw, "series_id", "ts", "value").where(F.col("value").isNotNull())


@query("win1_lag_difference", f"WITH {_R} SELECT series_id, ts, round(value - lag(value, 2) OVER (PARTITION BY series_id ORDER BY ts), 2) AS value FROM s")
def lag_difference(spark, sf):
    return rounded(S.lag_difference(daily_revenue(spark, sf), 2), 2)


@query("win3_lag_frame", f"WITH {_R} SELECT series_id, ts, lag_3, lag_2, lag_1, value AS y FROM (SELECT *, "
       + ", ".join(f"lag(value, {k}) OVER (PARTITION BY series_id ORDER BY ts) AS lag_{k}" for k in (3, 2, 1)) + " FROM p) WHERE pos > 3")
def lag_frame(spark, sf):
    return S.lag_frame(daily_revenue(spark, sf), 3)


@query("win4_first_last_values", f"WITH {_S} SELECT series_id, min_by(value, ts) AS first, max_by(value, ts) AS last, count(*) AS n FROM s GROUP BY series_id")
def first_last(spark, sf):
    return S.summary(daily_events(spark, sf)).select("series_id", "first", "last", "n")


@query("win4_last_h_values", f"WITH {_S} SELECT series_id, ts, value FROM p WHERE pos > n - 4")
def last_h(spark, sf):
    return S.positions(daily_events(spark, sf)).where("pos > n - 4").select("series_id", "ts", "value")


_TAIL = f"WITH {_S} SELECT series_id, ts, value, CASE WHEN pos > n - CAST(floor(n * 0.2) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM p"


@query("win5_chronological_split", _TAIL)
def chronological_split(spark, sf):
    return S.split_tail(daily_events(spark, sf)).select("series_id", "ts", "value", "split")


@query("ts14_train_test_split", f"WITH {_R}{_SPLIT} SELECT series_id, held, count(*) AS n, min(ts) AS a, max(ts) AS b FROM cut GROUP BY 1, 2")
def train_test_split(spark, sf):
    d = S.split_tail(daily_revenue(spark, sf))
    return d.groupBy("series_id", (F.col("split") == "test").alias("held")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))


@query("win7_expanding_history",
       f"WITH {_S} SELECT series_id, ts, pos - 1 AS n_history, round(avg(value) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4) AS mean_history FROM p")
def expanding_history(spark, sf):
    """Walk-forward means from running sums: chunk totals plus a window inside the chunk."""
    placed = S.positions(daily_events(spark, sf)).withColumn("_chunk", F.floor((F.col("pos") - 1) / 1000000))
    from pyspark.sql import Window as W
    inside = W.partitionBy("series_id", "_chunk").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    chunks = placed.groupBy("series_id", "_chunk").agg(F.sum("value").alias("_v"))
    along = W.partitionBy("series_id").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = chunks.select("series_id", "_chunk", F.coalesce(F.sum("_v").over(along), F.lit(0.0)).alias("_carry"))
    run = placed.withColumn("_run", F.coalesce(F.sum("value").over(inside), F.lit(0.0))).join(carry, ["series_id", "_chunk"])
    return run.select("series_id", "ts", (F.col("pos") - 1).alias("n_history"),
                      F.round(F.try_divide(F.col("_run") + F.col("_carry"), F.col("pos") - 1), 4).alias("mean_history"))


_DAYGAP = ("g AS (SELECT series_id, datediff('day', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts) AS gap FROM p), "
           "c AS (SELECT series_id, gap, count(*) AS k FROM g WHERE gap IS NOT NULL GROUP BY 1, 2), "
           "f AS (SELECT series_id, gap, row_number() OVER (PARTITION BY series_id ORDER BY k DESC, gap) AS r FROM c) ")


@query("dat2_infer_frequency", f"WITH {_S}, {_DAYGAP} SELECT series_id, CAST(gap AS INTEGER) AS gap_days, "
       "CASE WHEN gap = 1 THEN 'D' WHEN gap = 7 THEN 'W' WHEN gap BETWEEN 28 AND 31 THEN 'ME' ELSE 'D' END AS freq FROM f WHERE r = 1")
def infer_frequency(spark, sf):
    return S.frequency(daily_events(spark, sf))


_M = ("s AS (SELECT o_orderpriority AS series_id, CAST(last_day(o_orderdate) AS TIMESTAMP) AS ts, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2), "
      "p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM s)")


def monthly_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    s = o.groupBy(F.col("o_orderpriority").alias("series_id"), F.last_day("o_orderdate").cast("timestamp_ntz").alias("ts")) \
        .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    return s


@query("ts2_frequency_and_future",
       f"WITH {_M}, {_DAYGAP} SELECT e.series_id, CASE WHEN gap BETWEEN 28 AND 31 THEN 'ME' WHEN gap = 7 THEN 'W' ELSE 'D' END AS freq, "
       "step :: INTEGER AS step, CAST(last_day(t + to_months(step :: INTEGER)) AS TIMESTAMP) AS ts FROM (SELECT series_id, max(ts) AS t FROM p GROUP BY 1) e JOIN f ON e.series_id = f.series_id AND r = 1, "
       "(SELECT unnest(range(1, 7)) AS step)")
def frequency_and_future(spark, sf):
    s = monthly_orders(spark, sf)
    per = S.with_frequency(S.summary(s).select("series_id", "last_ts"), s, None)
    return S.horizon(per, 6).select("series_id", "freq", "step", "ts")


@query("dat3_future_index", f"WITH {_S} SELECT series_id, CAST(step AS INTEGER) AS step, max(ts) + to_days(7 * step :: INTEGER) AS ts FROM s, (SELECT unnest(range(1, 5)) AS step) GROUP BY 1, 2")
def future_index(spark, sf):
    per = S.summary(daily_events(spark, sf)).select("series_id", "last_ts").withColumn("freq", F.lit("W"))
    return S.horizon(per, 4).select("series_id", "step", "ts")


@query("agg22_series_info",
       f"WITH {_S} SELECT series_id, count(value) AS count, min(ts) AS first_ts, max(ts) AS last_ts, 'D' AS freq, round(avg(value), 4) AS mean, "
       "round(stddev_samp(value), 4) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50, "
       "round(quantile_cont(value, 0.75), 4) AS p75, max(value) AS max FROM s GROUP BY series_id")
def series_info(spark, sf):
    return rounded(S.info(daily_events(spark, sf)), 4)


_H = "(SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS step)"


def _simple_sql(model, expr):
    return (f"WITH {_S}, e AS (SELECT series_id, avg(value) AS mean, min_by(value, ts) AS first, max_by(value, ts) AS last, count(*) AS n, max(ts) AS t FROM s GROUP BY 1) "
            f"SELECT series_id, '{model}' AS model, step, t + to_days(step) AS ts, round({expr}, 4) AS yhat FROM e, {_H}")


@query("ts3_mean_forecast", _simple_sql("meanf", "mean"))
def mean_forecast(spark, sf):
    return rounded(S.simple_forecasts(daily_events(spark, sf), 7, ("meanf",)), 4)


@query("ts4_naive_forecast", _simple_sql("naive", "last"))
def naive_forecast(spark, sf):
    return rounded(S.simple_forecasts(daily_events(spark, sf), 7, ("naive",)), 4)


@query("ts5_seasonal_naive",
       f"WITH {_S} SELECT p.series_id, 'snaive' AS model, step, t + to_days(step) AS ts, value AS yhat FROM p JOIN (SELECT series_id, max(ts) AS t FROM s GROUP BY 1) e "
       f"ON p.series_id = e.series_id, {_H} WHERE pos > n - 3 AND pos - (n - 3) - 1 = (step - 1) % 3")
def seasonal_naive(spark, sf):
    return S.seasonal_naive(daily_events(spark, sf), 7, 3)


@query("ts6_drift_forecast", _simple_sql("drift", "last + (last - first) / n * (step - 1)"))
def drift_forecast(spark, sf):
    return rounded(S.simple_forecasts(daily_events(spark, sf), 7, ("drift",)), 4)


_HW_FIXED = (
    f"WITH RECURSIVE {_S}, init AS (SELECT series_id, avg(value) FILTER (pos <= 7) AS l, "
    "(avg(value) FILTER (pos BETWEEN 8 AND 14) - avg(value) FILTER (pos <= 7)) / 7 AS b, "
    "list(value ORDER BY pos) FILTER (pos <= 7) AS y, any_value(n) AS n FROM p GROUP BY 1), "
    "hw AS (SELECT series_id, 7 :: BIGINT AS pos, l, b, list_transform(y, lambda v: v - l) AS s, 0.0 :: DOUBLE AS sse, n FROM init UNION ALL "
    "SELECT series_id, pos, l2, @B * (l2 - l) + (1 - @B) * b, list_concat(s[2:7], [@G * (value - l - b) + (1 - @G) * s[1]]), sse + (value - l - b - s[1]) ** 2, n FROM ("
    "SELECT h.series_id, p.pos, h.l, h.b, h.s, h.sse, h.n, p.value, @A * (p.value - h.s[1]) + (1 - @A) * (h.l + h.b) AS l2 "
    "FROM hw h JOIN p ON p.series_id = h.series_id AND p.pos = h.pos + 1))")


@query("ts7_holt_winters_fixed",
       _HW_FIXED.replace("@A", "0.3").replace("@B", "0.1").replace("@G", "0.2") +
       f" SELECT series_id, 'Holt-Winters' AS model, step, (SELECT max(ts) FROM s WHERE s.series_id = hw.series_id) + to_days(step) AS ts, "
       f"round(l + step * b + s[(step - 1) % 7 + 1], 4) AS yhat FROM hw, {_H} WHERE pos = n")
def holt_winters_fixed(spark, sf):
    return rounded(H.smooth_forecast(daily_events(spark, sf), 7, 0.3, 0.1, 0.2, 7), 4)


@query("ts7_holt_winters_fitted")
def holt_winters_fitted(spark, sf):
    return rounded(H.fit_forecast(daily_revenue(spark, sf), 14), 4)


_HW_GRID = (
    f"WITH RECURSIVE {_S}{_SPLIT}, grid AS (SELECT a / 4.0 AS a, b / 4.0 AS b, g / 4.0 AS g FROM (SELECT unnest(range(0, 5)) AS a), (SELECT unnest(range(0, 5)) AS b), (SELECT unnest(range(0, 5)) AS g)), "
    "init AS (SELECT series_id, avg(value) FILTER (pos <= 7) AS l, (avg(value) FILTER (pos BETWEEN 8 AND 14) - avg(value) FILTER (pos <= 7)) / 7 AS t, "
    "list(value ORDER BY pos) FILTER (pos <= 7) AS y, any_value(n) AS n FROM train GROUP BY 1), "
    "hw AS (SELECT series_id, a, b, g, 7 :: BIGINT AS pos, l, t, list_transform(y, lambda v: v - l) AS s, n FROM init, grid UNION ALL "
    "SELECT series_id, a, b, g, pos, l2, b * (l2 - l) + (1 - b) * t, list_concat(s[2:7], [g * (value - l - t) + (1 - g) * s[1]]), n FROM ("
    "SELECT h.*, p.pos AS pos_1, p.value, h.a * (p.value - h.s[1]) + (1 - h.a) * (h.l + h.t) AS l2 FROM hw h JOIN train p ON p.series_id = h.series_id AND p.pos = h.pos + 1) x(series_id, a, b, g, pos_0, l, t, s, n, pos, value, l2)), "
    "scored AS (SELECT hw.series_id, a, b, g, avg((l + step * t + s[(step - 1) % 7 + 1] - test.value) ** 2) AS mse FROM hw JOIN test ON test.series_id = hw.series_id WHERE hw.pos = n GROUP BY 1, 2, 3, 4) "
    "SELECT series_id, a :: DOUBLE AS alpha, b :: DOUBLE AS beta, g :: DOUBLE AS gamma, round(mse, 4) AS mse FROM scored QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY mse, a, b, g) = 1")


@query("ts8_holt_winters_calibrated", _HW_GRID)
def holt_winters_calibrated(spark, sf):
    train, test = train_test(daily_events(spark, sf))
    return H.calibrate(train, test, 0.25).select("series_id", "alpha", "beta", "gamma", F.round("mse", 4).alias("mse"))


@query("ts9_difference_order")
def difference_order(spark, sf):
    return A.difference_order(daily_revenue(spark, sf))


_AR1 = ("d AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id ORDER BY pos) AS w FROM p), "
        "l AS (SELECT *, lag(w) OVER (PARTITION BY series_id ORDER BY pos) AS w1 FROM d), "
        "f AS (SELECT series_id, sum(w * w1) / sum(w1 * w1) AS phi, max_by(value, pos) AS y, max_by(w, pos) AS w, max(ts) AS t FROM l WHERE w1 IS NOT NULL GROUP BY 1)")


@query("ts10_arima_110", f"WITH {_R}, {_AR1} SELECT series_id, 'ARIMA' AS model, step, t + to_days(step) AS ts, "
       f"round(y + w * phi * (1 - phi ** step) / (1 - phi), 2) AS yhat FROM f, {_H}")
def arima_110(spark, sf):
    return rounded(A.forecast(daily_revenue(spark, sf), 7, A.Order(1, 1, 0)), 2)


@query("ts10_arima_auto")
def arima_auto(spark, sf):
    return rounded(A.auto_forecast(daily_revenue(spark, sf), 7), 2)


@query("ts10_arima_seasonal")
def arima_seasonal(spark, sf):
    return rounded(A.forecast(daily_revenue(spark, sf), 14, A.Order(1, 0, 1, (1, 1, 0, 7))), 2)


@query("ts11_arima_calibrated")
def arima_calibrated(spark, sf):
    best = A.calibrate(daily_revenue(spark, sf), (0, 1, 2), None, (0, 1, 2))
    return rounded(best.select("series_id", "p", "d", "q", "aic"), 4)


_ARGRID = ("l AS (SELECT *, lag(value, 1) OVER w AS y1, lag(value, 2) OVER w AS y2 FROM p WINDOW w AS (PARTITION BY series_id ORDER BY pos)), "
           "one AS (SELECT series_id, count(*) AS k, regr_slope(value, y1) AS b, regr_syy(value, y1) * (1 - regr_r2(value, y1)) AS rss FROM l WHERE y2 IS NOT NULL GROUP BY 1)")


@query("ts11_arima_order_aic", f"WITH {_R}, {_ARGRID} SELECT series_id, 1 :: INTEGER AS p, round(b, 6) AS phi, round(k * ln(rss / k) + 6, 4) AS aic FROM one")
def arima_order_aic(spark, sf):
    fits = A.fit_grid(daily_revenue(spark, sf), [A.Order(1, 0, 0), A.Order(2, 0, 0)])
    return fits.where("p = 1").select("series_id", "p", F.round(F.col("coef")[1], 6).alias("phi"), F.round("aic", 4).alias("aic"))


@query("ts12_walk_forward_110",
       f"WITH {_R}{_SPLIT}, d AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id ORDER BY pos) AS w FROM cut), "
       "l AS (SELECT *, lag(w) OVER (PARTITION BY series_id ORDER BY pos) AS w1, lag(value) OVER (PARTITION BY series_id ORDER BY pos) AS y1 FROM d), "
       "m AS (SELECT *, sum(w * w1) OVER b / sum(w1 * w1) OVER b AS phi FROM l WINDOW b AS (PARTITION BY series_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) "
       "SELECT series_id, 'ARIMA' AS model, ts, round(y1 + phi * w1, 2) AS yhat FROM m WHERE held")
def walk_forward_110(spark, sf):
    train, test = train_test(daily_revenue(spark, sf))
    return rounded(A.walk_forward(train, test, A.Order(1, 1, 0)), 2)


@query("ts12_walk_forward_111")
def walk_forward_111(spark, sf):
    train, test = train_test(daily_revenue(spark, sf))
    return rounded(A.walk_forward(train, test, A.Order(1, 1, 1)), 2)


_SPEC = (f"WITH {_S}, c AS (SELECT *, value - avg(value) OVER (PARTITION BY series_id) AS x FROM p), "
         "k AS (SELECT series_id, n, pos, x, unnest(range(0, n // 2 + 1)) AS k FROM c), "
         "q AS (SELECT series_id, n, k, sum(x * cos(2 * pi() * k * (pos - 1) / n)) AS cc, sum(x * sin(2 * pi() * k * (pos - 1) / n)) AS ss FROM k GROUP BY 1, 2, 3), "
         "spec AS (SELECT series_id, k, k / n AS freq, (cc * cc + ss * ss) / n * CASE WHEN k = 0 OR 2 * k = n THEN 1 ELSE 2 END AS spec FROM q)")


@query("ts13_periodogram", _SPEC + " SELECT series_id, k, round(freq, 8) AS freq, round(spec, 2) + 0.0 AS spec FROM spec")
def periodogram(spark, sf):
    return P.periodogram(daily_events(spark, sf)).select("series_id", "k", F.round("freq", 8).alias("freq"), (F.round("spec", 2) + 0.0).alias("spec"))


@query("plt10_periodogram_curve", _SPEC.replace(_S, _R) + " SELECT series_id, k, round(freq, 8) AS freq, round(spec / 1e6, 0) + 0.0 AS spec FROM spec")
def periodogram_curve(spark, sf):
    return P.periodogram(daily_revenue(spark, sf)).select("series_id", "k", F.round("freq", 8).alias("freq"), (F.round(F.col("spec") / 1e6, 0) + 0.0).alias("spec"))


@query("top4_strongest_lines", _SPEC + " SELECT series_id, CAST(r AS INTEGER) AS rank, round(freq, 8) AS freq, round(1 / freq, 6) AS period FROM "
       "(SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY spec DESC, k) AS r FROM spec WHERE k > 0) WHERE r <= 3")
def strongest_lines(spark, sf):
    best = P.best_frequencies(P.periodogram(daily_events(spark, sf)), 3)
    return best.select("series_id", "rank", F.round("freq", 8).alias("freq"), F.round("period", 6).alias("period"))


_ERR_CTE = (f"WITH {_S}{_SPLIT}, e AS (SELECT series_id, avg(value) AS mean, min_by(value, ts) AS first, max_by(value, ts) AS last, count(*) AS n FROM train GROUP BY 1), "
            "fc AS (SELECT test.series_id, model, value AS y, CASE model WHEN 'meanf' THEN mean WHEN 'naive' THEN last ELSE last + (last - first) / n * (step - 1) END AS f "
            "FROM test JOIN e ON test.series_id = e.series_id, (SELECT unnest(['meanf', 'naive', 'drift']) AS model)), "
            "err AS (SELECT series_id, model, count(*) AS n, sum((f - y) ** 2) AS rss, avg((f - y) ** 2) AS mse, sqrt(avg((f - y) ** 2)) AS rmse, sum(abs(f - y)) / sum(abs(y)) AS re, "
            "CASE WHEN stddev_pop(f) < 1e-9 THEN 0 ELSE corr(f, y) END AS corr FROM fc GROUP BY 1, 2)")


def _simple_errors(spark, sf):
    train, test = train_test(daily_events(spark, sf))
    longest = test.groupBy("series_id").count().agg(F.max("count")).first()[0]
    made = BS._aligned(S.simple_forecasts(train, longest), test)
    flat = made.withColumn("yhat", F.round("yhat", 9))
    return S.forecast_errors(flat, test)


@query("agg16_forecast_errors", _ERR_CTE + ' SELECT series_id, model, n, round(rss, 4) AS "RSS", round(mse, 4) AS "MSE", round(rmse, 6) AS "RMSE", round(re, 6) AS "RE", round(corr, 6) AS "CORR" FROM err')
def forecast_errors(spark, sf):
    e = _simple_errors(spark, sf)
    return e.select("series_id", "model", "n", F.round("RSS", 4).alias("RSS"), F.round("MSE", 4).alias("MSE"),
                    *[F.round(c, 6).alias(c) for c in ("RMSE", "RE", "CORR")])


@query("ts15_error_table", _ERR_CTE + ' SELECT model, round(avg(rmse), 6) AS mean_rmse, round(avg(re), 6) AS mean_re FROM err GROUP BY model')
def error_table(spark, sf):
    return _simple_errors(spark, sf).groupBy("model").agg(F.round(F.avg("RMSE"), 6).alias("mean_rmse"), F.round(F.avg("RE"), 6).alias("mean_re"))


_SCALE = ", ".join(f"round(coalesce(({c} - min({c}) OVER w) / nullif(max({c}) OVER w - min({c}) OVER w, 0) * 100, 0), 4) AS \"{c.upper()}\"" for c in ("mse", "rmse", "re", "corr"))


@query("agg17_scaled_errors", _ERR_CTE + f" SELECT series_id, model, {_SCALE} FROM err WINDOW w AS (PARTITION BY series_id)")
def scaled_errors(spark, sf):
    return rounded(S.scaled_errors(_simple_errors(spark, sf)), 4)


@query("plt8_error_radar", _ERR_CTE + f" SELECT series_id, model, {_SCALE} FROM err WINDOW w AS (PARTITION BY series_id)")
def error_radar(spark, sf):
    return rounded(S.error_radar(_simple_errors(spark, sf)), 4)


@query("jn2_forecast_actual_join", _ERR_CTE + " SELECT series_id, model, y AS value, round(f, 3) AS yhat, round(f - y, 3) AS error FROM fc")
def forecast_actual(spark, sf):
    train, test = train_test(daily_events(spark, sf))
    longest = test.groupBy("series_id").count().agg(F.max("count")).first()[0]
    made = BS._aligned(S.simple_forecasts(train, longest), test)
    j = made.join(test, ["series_id", "ts"])
    return j.select("series_id", "model", "value", F.round("yhat", 3).alias("yhat"), F.round(F.col("yhat") - F.col("value"), 3).alias("error"))


@query("ts16_benchmark")
def benchmark(spark, sf):
    e = BS.benchmark(daily_events(spark, sf), 0.2, 7, ("hw", "hw_cal", "arima", "arima_cal", "simple"), step=0.25)
    return rounded(e, 4)


@query("plt10_series_line", f"WITH {_R} SELECT series_id, ts, value FROM s")
def series_line(spark, sf):
    return daily_revenue(spark, sf).select("series_id", "ts", "value")
