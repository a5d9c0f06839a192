"""Holt-Winters smoothing (additive trend and season) of many series.

The recursion is linear in its state (level, trend, season). A long series is cut in blocks:
each block is run from a zero state, block ends are chained by the power of one season's
transition, and each block is then run again from its true start. Short series, the usual
case, are one block. All parameter triples of a grid advance together as numpy vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .series import horizon, positions, with_frequency

# Seasonal period by frequency.
SEASON_BY_FREQUENCY = {"D": 7, "W": 52, "ME": 12}
BLOCK_POINTS = 100_000


def _run(y, phase, state, alpha, beta, gamma, m):
    """Advance ``state`` (rows: level, trend, m seasonal) over y; returns the squared-error sum."""
    level, trend, season = state[0], state[1], state[2:]
    sse = np.zeros_like(alpha)
    for i, v in enumerate(y):
        j = (phase + i) % m if m else 0
        s = season[j] if m else 0.0
        base = level + trend
        err = v - base - s
        sse += err * err
        new = alpha * (v - s) + (1 - alpha) * base
        if m:
            season[j] = gamma * (v - base) + (1 - gamma) * s
        trend = beta * (new - level) + (1 - beta) * trend if beta is not None else trend
        level = new
    state[0], state[1] = level, trend
    return sse


def _grid(center, offsets, has_trend, m):
    """Vectors of the parameter triples around a centre, clipped to [0, 1]."""
    a = np.clip(center[0] + offsets, 0, 1)
    b = np.clip(center[1] + offsets, 0, 1) if has_trend else np.zeros(1)
    g = np.clip(center[2] + offsets, 0, 1) if m else np.zeros(1)
    A, B, G = np.meshgrid(a, b, g, indexing="ij")
    return A.ravel(), (B.ravel() if has_trend else None), G.ravel()


def _start(y, width, has_trend, m):
    """First state from the first cycle(s) and the number of points it uses."""
    state = np.zeros((2 + m, width))
    if m:
        level = y[:m].mean()
        state[0] = level
        if has_trend:
            state[1] = (y[m:2 * m].mean() - level) / m
        state[2:] = (y[:m] - level)[:, None]
        return state, m
    state[0] = y[0]
    if has_trend:
        state[1] = y[1] - y[0]
        # the slope already uses the second point's direction; smoothing starts there
    return state, 1


def _cycle_power(alpha, beta, gamma, m, has_trend, cycles):
    """Transition of the state over ``cycles`` whole seasons for one parameter triple."""
    size = 2 + m
    step = np.eye(size)
    for j in range(max(m, 1)):
        cols = step.copy()
        base = cols[0] + cols[1]
        s = cols[2 + j] if m else np.zeros(size)
        new = -alpha * s + (1 - alpha) * base
        nxt = cols.copy()
        if has_trend:
            nxt[1] = beta * (new - cols[0]) + (1 - beta) * cols[1]
        if m:
            nxt[2 + j] = -gamma * base + (1 - gamma) * s
        nxt[0] = new
        step = nxt
    return np.linalg.matrix_power(step, cycles)


OUT = ("series_id string, block bigint, part int, g int, alpha double, beta double, gamma double, "
       "sse double, count bigint, state array<double>")


class _Smoother:
    """Settings shared by the block functions; picklable."""

    def __init__(self, offsets, parts, has_trend, m, block):
        self.offsets, self.parts, self.has_trend, self.m, self.block = offsets, parts, has_trend, m, block

    def triples(self, pdf):
        center = pdf[["ca", "cb", "cg"]].iloc[0].to_numpy(float)
        a, b, g = _grid(center, self.offsets, self.has_trend, self.m)
        idx = np.arange(len(a))[np.arange(len(a)) % self.parts == int(pdf["part"].iloc[0])]
        return idx, a[idx], (b[idx] if b is not None else None), g[idx]

    def rows(self, pdf, idx, a, b, g, state, sse, count):
        k = len(idx)
        return pd.DataFrame({
            "series_id": [pdf["series_id"].iloc[0]] * k, "block": [int(pdf["block"].iloc[0])] * k,
            "part": [int(pdf["part"].iloc[0])] * k, "g": idx.astype("int32"), "alpha": a,
            "beta": b if b is not None else np.full(k, np.nan), "gamma": g if self.m else np.full(k, np.nan),
            "sse": sse, "count": count, "state": list(state.T.copy())})

    def run_block(self, pdf, state):
        pdf = pdf.sort_values("pos")
        y = pdf["value"].to_numpy(float)
        idx, a, b, g = self.triples(pdf)
        phase = (int(pdf["pos"].iloc[0]) - 1) % self.m if self.m else 0
        used = 0
        if int(pdf["block"].iloc[0]) == 0:
            state, used = _start(y, len(idx), self.has_trend, self.m)
        elif state is None:
            state = np.zeros((2 + self.m, len(idx)))
        sse = _run(y[used:], (phase + used), state, a, b, g, self.m)
        return self.rows(pdf, idx, a, b, g, state, sse, len(y) - used)

    def one_pass(self, pdf):
        return self.run_block(pdf, None)

    def second_pass(self, pdf, starts):
        starts = starts.sort_values("g")
        state = np.stack(starts["state"].to_numpy()).T.copy() if len(starts) else None
        return self.run_block(pdf, state)

    def chain(self, pdf):
        """True start state of every block after the first, from the zero-state ends."""
        out = []
        for g, rows in pdf.sort_values(["g", "block"]).groupby("g"):
            first = rows.iloc[0]
            power = _cycle_power(first["alpha"], first["beta"], first["gamma"], self.m, self.has_trend,
                                 self.block // max(self.m, 1))
            state = np.array(first["state"])
            for _, r in rows.iloc[1:].iterrows():
                out.append((r["series_id"], int(r["block"]), int(r["part"]), int(g), state))
                state = power @ state + np.array(r["state"])
        return pd.DataFrame(out, columns=["series_id", "block", "part", "g", "state"])


def _smooth(placed: DataFrame, centers: DataFrame | None, offsets, has_trend: bool, m: int, parts: int) -> DataFrame:
    """Final state and SSE of every series and triple: (series_id, g, alpha, beta, gamma, sse, count, state)."""
    block = (BLOCK_POINTS // max(m, 1)) * max(m, 1)
    job = _Smoother(np.asarray(offsets, float), parts, has_trend, m, block)
    need = 2 * m if m else 2
    rows = placed.where(F.col("n") >= need).withColumn("block", F.floor((F.col("pos") - 1) / block))
    if centers is None:
        rows = rows.withColumns({c: F.lit(0.0) for c in ("ca", "cb", "cg")})
    else:
        rows = rows.join(centers, "series_id")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))) if parts > 1 \
        else rows.withColumn("part", F.lit(0))
    rows = rows.select("series_id", "block", "part", "pos", "value", "ca", "cb", "cg")
    longest = placed.agg(F.max("n")).first()[0] or 0
    ends = rows.groupBy("series_id", "block", "part").applyInPandas(lambda pdf: job.one_pass(pdf), OUT)
    if longest > block:
        starts = ends.groupBy("series_id", "part").applyInPandas(
            lambda pdf: job.chain(pdf), "series_id string, block bigint, part int, g int, state array<double>")
        ends = rows.groupBy("series_id", "block", "part").cogroup(
            starts.groupBy("series_id", "block", "part")).applyInPandas(
            lambda pdf, first: job.second_pass(pdf, first), OUT)
    return ends.groupBy("series_id", "g").agg(
        F.first("alpha").alias("alpha"), F.first("beta").alias("beta"), F.first("gamma").alias("gamma"),
        F.sum("sse").alias("sse"), F.sum("count").alias("count"), F.max_by("state", "block").alias("state"))


def _project(fitted: DataFrame, m: int) -> DataFrame:
    """Forecast from the final state: level + step * trend + the season of that step."""
    step = F.col("step")
    value = F.col("state")[0] + step * F.col("state")[1]
    if m:
        value = value + F.element_at("state", (F.pmod(F.col("n") + step - 1, F.lit(m)) + 3).cast("int"))
    return fitted.withColumn("yhat", value)


def _lengths(placed: DataFrame, series: DataFrame, freq) -> DataFrame:
    per = placed.groupBy("series_id").agg(F.max("n").alias("n"), F.max("ts").alias("last_ts"))
    return with_frequency(per, series, freq)


def smooth_forecast(series: DataFrame, steps: int, alpha: float, beta: float | None = None,
                    gamma: float | None = None, m: int = 0, freq: str | None = "D",
                    model: str = "Holt-Winters") -> DataFrame:
    """Forecast with given parameters (series_id, model, step, ts, yhat)."""
    if gamma is None:
        m = 0
    placed = positions(series)
    centers = placed.select("series_id").distinct().withColumns({
        "ca": F.lit(float(alpha)), "cb": F.lit(float(beta or 0.0)), "cg": F.lit(float(gamma or 0.0))})
    fitted = _smooth(placed, centers, [0.0], beta is not None, m, 1)
    # a series that is too short for the model keeps its rows, with NULL forecasts
    ahead = horizon(_lengths(placed, series, freq).join(fitted, "series_id", "left"), steps)
    return _project(ahead, m).select("series_id", F.lit(model).alias("model"), "step", "ts", "yhat")


def season_length(m: int | None, freq: str | None) -> int:
    """The given season length, else the usual one of the frequency (0 means no season)."""
    return SEASON_BY_FREQUENCY.get(freq or "D", 7) if m is None else m


def fit_parameters(series: DataFrame, trend: bool = True, m: int = 7, rounds: int = 3) -> DataFrame:
    """Parameters with the least squared one-step error, by a grid that is narrowed per series.

    Returns (series_id, alpha, beta, gamma, sse, count, state).
    """
    placed = materialize(positions(series))
    offsets, step, centers, best = np.linspace(0.05, 0.95, 7), 0.15, None, None
    for _ in range(rounds):
        tried = _smooth(placed, centers, offsets, trend, m, 1)
        best = materialize(tried.groupBy("series_id").agg(
            F.min_by(F.struct("alpha", "beta", "gamma", "sse", "count", "state"), F.struct("sse", "g")).alias("_b"))
            .select("series_id", "_b.*"))
        centers = best.select("series_id", F.col("alpha").alias("ca"), F.nanvl("beta", F.lit(0.0)).alias("cb"),
                              F.nanvl("gamma", F.lit(0.0)).alias("cg"))
        offsets = np.linspace(-step, step, 5)
        step /= 3
    return best


def fit_forecast(series: DataFrame, steps: int, trend: bool = True, m: int | None = None, freq: str | None = "D",
                 model: str = "Holt-Winters") -> DataFrame:
    """Forecast with fitted parameters; ``m=None`` takes the season of the frequency."""
    m = season_length(m, freq)
    placed = positions(series)
    best = fit_parameters(series, trend, m)
    ahead = horizon(_lengths(placed, series, freq).join(best, "series_id", "left"), steps)
    return _project(ahead, m).select("series_id", F.lit(model).alias("model"), "step", "ts", "yhat")


def calibrate(train: DataFrame, test: DataFrame, step: float = 0.1, trend: bool = True, m: int | None = None,
              freq: str | None = "D", parts: int = 8) -> DataFrame:
    """Grid 0, step, .., 1 in every parameter; the triple with the least error on ``test`` wins.

    Returns (series_id, alpha, beta, gamma, mse, state, n, last_ts, freq). Pass the tail of the
    training data as ``test`` to keep the real test part unseen.
    """
    m, values = season_length(m, freq), np.append(np.arange(0, 1, step), 1.0)
    placed = materialize(positions(train))
    fitted = _smooth(placed, None, values, trend, m, parts).join(_lengths(placed, train, freq), "series_id")
    width = test.groupBy("series_id").agg(F.count(F.lit(1)).alias("_h"))
    ahead = fitted.join(width, "series_id").withColumn("step", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_h"))))
    numbered = positions(test).select("series_id", F.col("pos").alias("step"), F.col("value").alias("_y"))
    scored = _project(ahead, m).join(numbered, ["series_id", "step"])
    per = scored.groupBy("series_id", "g").agg(F.avg(F.pow(F.col("yhat") - F.col("_y"), 2)).alias("mse"))
    best = per.groupBy("series_id").agg(F.min_by("g", F.struct("mse", "g")).alias("g"), F.min("mse").alias("mse"))
    return fitted.join(best, ["series_id", "g"]).select(
        "series_id", "alpha", "beta", "gamma", "mse", "state", "n", "last_ts", "freq")


def calibrated_forecast(train: DataFrame, test: DataFrame, steps: int, step: float = 0.1, trend: bool = True,
                        m: int | None = None, freq: str | None = "D", model: str = "Holt-Winters Calibrado") -> DataFrame:
    m = season_length(m, freq)
    best = calibrate(train, test, step, trend, m, freq)
    return _project(horizon(best, steps), m).select("series_id", F.lit(model).alias("model"), "step", "ts", "yhat")
