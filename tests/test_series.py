import datetime

import numpy as np
import pytest

from oreline.operators import arima as A
from oreline.operators import series as S
from oreline.operators import smoothing as H
from oreline.operators import spectrum as P
from oreline.sources.series import checked_series

DAY = datetime.datetime(2024, 1, 1)


def make(spark, values, name="s"):
    rows = [(name, DAY + datetime.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")


def yhat(df):
    return [round(r.yhat, 4) for r in df.orderBy("step").collect()]


def test_simple_forecasts(spark):
    assert yhat(S.seasonal_naive(make(spark, [5, 7, 9, 4]), 3, 2)) == [9, 4, 9]
    assert yhat(S.simple_forecasts(make(spark, [1, 3, 6]), 3, ("drift",))) == [6, 7.6667, 9.3333]
    assert yhat(S.simple_forecasts(make(spark, [1, 3, 6]), 2, ("drift",), textbook_drift=True)) == [8.5, 11.0]
    assert yhat(S.seasonal_naive(make(spark, [5, 7]), 3, 4)) == [5, 7, 5]


def test_lag_difference_and_fill(spark):
    assert [r.value for r in S.lag_difference(make(spark, [1, 2, 4, 7]), 2).orderBy("ts").collect()] == [None, None, 3.0, 5.0]
    assert [r.value for r in S.fill_missing(make(spark, [None, 1, None, None, 4, None])).orderBy("ts").collect()] == [1, 1, 1, 1, 4, 4]


def test_lags_across_chunks(spark):
    from oreline.operators.ranking import lagged
    whole = lagged(S.positions(make(spark, range(50))), ["series_id"], "pos", {"a": ("value", 3)}, chunk=7)
    assert [r.a for r in whole.orderBy("pos").collect()] == [None] * 3 + [float(i) for i in range(47)]


def test_split_with_empty_test_part(spark):
    assert {r.split for r in S.split_tail(make(spark, [1, 2, 3, 4]), 0.2).collect()} == {"train"}


def test_holt_winters_hand_case(spark):
    assert yhat(H.smooth_forecast(make(spark, [1, 2, 4]), 2, 0.5, 0.5)) == [4.75, 6.0]


def test_holt_winters_in_blocks_equals_one_block(spark, monkeypatch):
    rng = np.random.default_rng(1)
    t = np.arange(90)
    series = make(spark, 10 + 0.2 * t + 3 * np.sin(2 * np.pi * t / 7) + rng.normal(0, .5, 90))
    one = yhat(H.smooth_forecast(series, 10, 0.4, 0.2, 0.3, 7))
    placed = S.positions(series)
    whole = H._smooth(placed, None, np.array([0.1, 0.6]), True, 7, 2).orderBy("g").collect()
    monkeypatch.setattr(H, "BLOCK_POINTS", 14)
    assert yhat(H.smooth_forecast(series, 10, 0.4, 0.2, 0.3, 7)) == one
    cut = H._smooth(placed, None, np.array([0.1, 0.6]), True, 7, 2).orderBy("g").collect()
    assert np.allclose([r.sse for r in whole], [r.sse for r in cut]) and np.allclose([r.state for r in whole], [r.state for r in cut])


def test_fitted_smoothing_beats_a_fixed_guess(spark):
    t = np.arange(70)
    series = make(spark, 5 + 0.3 * t + 2 * np.cos(2 * np.pi * t / 7))
    best = H.fit_parameters(series, True, 7).first()
    fixed = H._smooth(S.positions(series), None, np.array([0.3]), True, 7, 1).first()
    assert best.sse <= fixed.sse + 1e-9


def test_periodogram(spark):
    wave = make(spark, np.sin(2 * np.pi * np.arange(8) / 4))
    spec = P.periodogram(wave)
    assert np.allclose([r.spec for r in spec.orderBy("k").collect()], [0, 0, 4, 0, 0])
    best = P.best_frequencies(spec, 1).first()
    assert (best.freq, best.period) == (0.25, 4.0)


def test_periodogram_in_blocks(spark, monkeypatch):
    series = make(spark, np.random.default_rng(2).normal(size=61))
    want = [r.spec for r in P.periodogram(series).orderBy("k").collect()]
    monkeypatch.setattr(P, "SHORT", 10)
    monkeypatch.setattr(P, "TILE", 9)
    assert np.allclose(want, [r.spec for r in P.periodogram(series).orderBy("k").collect()])


def test_errors(spark):
    actual = make(spark, [1, 2, 4])
    pred = make(spark, [1, 3, 3]).withColumnRenamed("value", "yhat").selectExpr("series_id", "'m' AS model", "ts", "yhat")
    e = S.forecast_errors(pred, actual, 4).first()
    assert (e.RMSE, e.RE, e.CORR) == (.8165, .2857, .7559)
    flat = pred.selectExpr("series_id", "model", "ts", "CAST(2 AS DOUBLE) AS yhat")
    assert S.forecast_errors(flat, actual).first().CORR == 0.0
    assert S.error_radar(S.forecast_errors(pred, actual)).first().RMSE == 100.0


def test_autoregression_recovers_its_coefficients(spark):
    rng, x = np.random.default_rng(3), [0.0, 0.0]
    for _ in range(1500):
        x.append(1.0 + 0.5 * x[-1] - 0.3 * x[-2] + rng.normal())
    coef = A.fit_grid(make(spark, x), [A.Order(2, 0, 0)]).first().coef
    assert np.allclose(coef, [1.0, 0.5, -0.3], atol=0.1)


def test_moving_average_part(spark):
    rng = np.random.default_rng(4)
    e = rng.normal(size=3000)
    x = np.cumsum(e[1:] + 0.6 * e[:-1])
    coef = A.fit_grid(make(spark, x), [A.Order(0, 1, 1)]).first().coef
    assert abs(coef[0] - 0.6) < 0.08


def test_order_of_differencing(spark):
    rng = np.random.default_rng(5)
    noise, walk = rng.normal(size=300), np.cumsum(rng.normal(size=300))
    both = make(spark, noise, "noise").unionByName(make(spark, walk, "walk"))
    assert {r.series_id: r.d for r in A.difference_order(both).collect()} == {"noise": 0, "walk": 1}


def test_walk_forward_refits_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.cumsum(rng.normal(size=80))
    series = S.split_tail(make(spark, x), 0.2)
    train, test = (series.where(f"split = '{p}'").select("series_id", "ts", "value") for p in ("train", "test"))
    want = [r.yhat for r in A.walk_forward(train, test, A.Order(1, 1, 0)).orderBy("ts").collect()]
    w = np.diff(x)
    for i, got in enumerate(want):
        at = 64 + i
        a, b = w[:at - 2], w[1:at - 1]
        assert abs(got - (x[at - 1] + (a @ b) / (a @ a) * w[at - 2])) < 1e-8
    monkeypatch.setattr(A, "CHUNK", 16)
    assert np.allclose(want, [r.yhat for r in A.walk_forward(train, test, A.Order(1, 1, 0)).orderBy("ts").collect()])


def test_missing_dates_raise(spark):
    df = spark.createDataFrame([("a", "31/12/2023", "1"), ("a", "nunca", "2")], "s string, d string, v string")
    with pytest.raises(ValueError):
        checked_series(df, "s", "d", "v")
