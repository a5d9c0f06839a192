"""ARIMA by regression for many series.

Estimation is the two-stage regression of Hannan and Rissanen (1982): a long autoregression
gives innovations, then the differenced series is regressed on its own lags and on lagged
innovations. Both stages are normal equations, that is, sums over rows. One lag frame feeds
everything; no series is ever gathered in one task. This is a consistent estimator, not the
exact state-space likelihood.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize
from .ranking import lagged
from .series import KEY, horizon, positions, with_frequency

# Fixed value: asymptotic 5 % point of the unit-root t statistic with a constant (MacKinnon).
UNIT_ROOT_5_PERCENT = -2.86154
CHUNK = 1 << 20


@dataclass(frozen=True)
class Order:
    """(p, d, q) with an optional seasonal part (P, D, Q, s)."""
    p: int
    d: int
    q: int
    seasonal: tuple = (0, 0, 0, 0)

    @property
    def ar(self):
        P, _, _, s = self.seasonal
        return sorted({*range(1, self.p + 1), *(s * i for i in range(1, P + 1))})

    @property
    def ma(self):
        _, _, Q, s = self.seasonal
        return sorted({*range(1, self.q + 1), *(s * i for i in range(1, Q + 1))})

    @property
    def polynomial(self) -> dict[int, float]:
        """Coefficients of (1 - B)^d (1 - B^s)^D by lag."""
        _, D, _, s = self.seasonal
        poly = np.array([1.0])
        for _ in range(self.d):
            poly = np.convolve(poly, [1.0, -1.0])
        for _ in range(D):
            poly = np.convolve(poly, [1.0] + [0.0] * (s - 1) + [-1.0])
        return {i: float(c) for i, c in enumerate(poly) if c}

    @property
    def constant(self) -> bool:
        return self.d == 0

    @property
    def long(self) -> int:
        return max(4, self.p + self.q + 2) if self.ma else 0


@dataclass
class LagFrame:
    """Rows with the level lags an order needs, and the expressions over them."""
    order: Order
    rows: DataFrame
    beta: list = field(default_factory=list)

    def level(self, lag):
        return F.col(f"_y{lag}") if lag else F.col("value")

    def w(self, lag=0):
        terms = [self.level(lag + j) * c for j, c in self.order.polynomial.items()]
        return sum(terms[1:], terms[0])

    def innovation(self, lag=0):
        fit = F.col("_b")[0]
        for i in range(1, self.order.long + 1):
            fit = fit + F.col("_b")[i] * self.w(lag + i)
        return self.w(lag) - fit

    def regressors(self):
        one = [F.lit(1.0)] if self.order.constant else []
        return one + [self.w(i) for i in self.order.ar] + [self.innovation(j) for j in self.order.ma]


def lag_rows(placed: DataFrame, order: Order, ahead: bool = False) -> LagFrame:
    """One pass over the positions that adds all level lags of ``order``.

    ``ahead`` also adds what a forecast starts from: every point inside the deepest lag.
    """
    ar = range(max([1, *order.ar])) if ahead else order.ar
    ma = range(max([0, *order.ma]) + 1) if ahead else [0, *order.ma]
    tail = max(order.polynomial) if ahead else 0
    w_lags = {0, *order.ar, *ar}
    for j in (ma if order.ma else ()):
        w_lags |= {j + i for i in range(order.long + 1)}
    levels = sorted(({a + b for a in w_lags for b in order.polynomial} | set(range(tail))) - {0})
    if levels:
        placed = lagged(placed, KEY, "pos", {f"_y{k}": ("value", k) for k in levels}, CHUNK)
    return LagFrame(order, placed)


def _moments(z: list) -> tuple:
    """Upper triangle of z z' and the test that a row is complete."""
    pairs = list(itertools.combinations_with_replacement(range(len(z)), 2))
    complete = F.lit(True)
    for c in z:
        complete = complete & c.isNotNull()
    return pairs, complete


def moment_table(frame: DataFrame, z: list, keys=("series_id",)) -> DataFrame:
    """Per group: number of complete rows and the moments, from partial aggregates."""
    pairs, complete = _moments(z)
    named = frame.select(*keys, *[c.alias(f"_z{i}") for i, c in enumerate(z)], complete.alias("_ok")).where("_ok")
    sums = [F.sum(F.col(f"_z{i}") * F.col(f"_z{j}")) for i, j in pairs]
    return named.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.array(*sums).alias("m"))


def _matrix(m, size):
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = m
    return full + np.triu(full, 1).T


def _solve(full, cols, target):
    """Least squares from moments; (coefficients, residual sum of squares)."""
    a, b = full[np.ix_(cols, cols)], full[cols, target]
    if len(cols):
        scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
        coef = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-12)[0] / scale
    else:
        coef = np.zeros(0)
    return coef, max(float(full[target, target] - coef @ b), 0.0)


def _least_squares(table: DataFrame, size: int, schema: str, pick) -> DataFrame:
    """Solve the small systems of a moment table, ``pick(row, matrix) -> rows``."""
    def job(batches):
        names = [f.split()[0] for f in schema.split(", ")]
        for pdf in batches:
            out = [r for row in pdf.itertuples() for r in pick(row, _matrix(np.asarray(row.m, float), size))]
            yield pd.DataFrame(out, columns=names)
    return table.mapInPandas(job, schema)


def _with_innovations(frame: LagFrame, fit_rows=None) -> LagFrame:
    """Fit the long autoregression per series and attach its coefficients as ``_b``."""
    order = frame.order
    if not order.ma:
        return frame
    z = [F.lit(1.0)] + [frame.w(i) for i in range(1, order.long + 1)] + [frame.w()]
    source = frame.rows if fit_rows is None else frame.rows.where(fit_rows)
    table = moment_table(source, z)
    k = len(z)
    betas = _least_squares(table, k, "series_id string, _b array<double>",
                           lambda row, full: [(row.series_id, list(_solve(full, list(range(k - 1)), k - 1)[0]))])
    return LagFrame(order, frame.rows.join(betas, "series_id"))


def _stable(coef):
    """Shrink a lag polynomial until its roots lie outside the unit circle."""
    coef = np.asarray(coef, float)
    if not len(coef) or not np.any(coef):
        return coef
    radius = max(abs(np.roots(np.concatenate([[1.0], -coef]))), default=0.0)
    return coef if radius < 0.999 else coef * (0.98 / radius) ** np.arange(1, len(coef) + 1)


def fit_grid(series: DataFrame, orders: list[Order], placed: DataFrame | None = None) -> DataFrame:
    """Coefficients and AIC of every order for every series.

    Orders with the same differencing share one lag frame and one moment table: the smaller
    models are sub-matrices of the largest one. Returns (series_id, p, d, q, coef, rows, sse, aic).
    """
    placed = positions(series) if placed is None else placed
    out = None
    for key, group in itertools.groupby(sorted(orders, key=lambda o: (o.d, o.seasonal)), key=lambda o: (o.d, o.seasonal)):
        group = list(group)
        top = Order(max(o.p for o in group), key[0], max(o.q for o in group), key[1])
        frame = _with_innovations(lag_rows(placed, top))
        z = frame.regressors() + [frame.w()]
        size, base = len(z), int(top.constant)
        place = {("ar", lag): base + i for i, lag in enumerate(top.ar)}
        place.update({("ma", lag): base + len(top.ar) + i for i, lag in enumerate(top.ma)})

        def pick(row, full, group=group, size=size, base=base, place=place):
            for o in group:
                cols = list(range(base)) + [place["ar", i] for i in o.ar] + [place["ma", j] for j in o.ma]
                if row.rows <= len(cols) + 1:
                    continue
                coef, rss = _solve(full, cols, size - 1)
                aic = row.rows * math.log(max(rss, 1e-300) / row.rows) + 2 * (len(cols) + 1)
                yield (row.series_id, o.p, o.d, o.q, [float(c) for c in coef], int(row.rows), rss, aic)

        fitted = _least_squares(moment_table(frame.rows, z), size,
                                "series_id string, p int, d int, q int, coef array<double>, rows bigint, sse double, aic double", pick)
        out = fitted if out is None else out.unionByName(fitted)
    return out


def best_order(fits: DataFrame) -> DataFrame:
    """The fit with the least AIC of each series (first order of the grid on ties)."""
    whole = F.struct("p", "d", "q", "coef", "rows", "sse", "aic")
    return (fits.groupBy("series_id").agg(F.min_by(whole, F.struct("aic", "p", "d", "q")).alias("_f"))
            .select("series_id", "_f.*"))


def forecast(series: DataFrame, steps: int, order: Order, freq: str | None = "D", model: str = "ARIMA",
             placed: DataFrame | None = None) -> DataFrame:
    """Fit one order and forecast ``steps`` ahead (series_id, model, step, ts, yhat)."""
    placed = materialize(positions(series)) if placed is None else placed
    fits = fit_grid(series, [order], placed).select("series_id", "coef")
    depth = max(order.polynomial)
    frame = _with_innovations(lag_rows(placed, order, ahead=True))
    ends = frame.rows.where(F.col("pos") == F.col("n")).select(
        "series_id", F.col("ts").alias("last_ts"),
        F.array(*[frame.level(i) for i in range(max(depth, 1))]).alias("levels"),
        F.array(*[frame.w(i) for i in range(max([1, *order.ar]))]).alias("ws"),
        (F.array(*[frame.innovation(j) for j in range(max(order.ma))]) if order.ma
         else F.array().cast("array<double>")).alias("es"))
    state = ends.join(fits, "series_id")
    ar, ma, poly, const = order.ar, order.ma, order.polynomial, order.constant

    def job(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                coef = np.asarray(r.coef, float)
                c = coef[0] if const else 0.0
                phi = np.zeros(max([0, *ar]))
                phi[[i - 1 for i in ar]] = coef[int(const):int(const) + len(ar)]
                theta = coef[int(const) + len(ar):]
                phi = _stable(phi)
                ws, es, levels = list(r.ws)[::-1], list(r.es)[::-1], list(r.levels)[::-1]
                for h in range(1, steps + 1):
                    w = c + sum(phi[i - 1] * ws[-i] for i in ar)
                    w += sum(t * es[-j] for t, j in zip(theta, ma))
                    y = w - sum(k * levels[-j] for j, k in poly.items() if j)
                    ws.append(w), es.append(0.0), levels.append(y)
                    out.append((r.series_id, h, float(y)))
            yield pd.DataFrame(out, columns=["series_id", "step", "yhat"])

    made = state.select("series_id", "coef", "levels", "ws", "es").where(
        ~F.exists("ws", lambda x: x.isNull())).mapInPandas(job, "series_id string, step int, yhat double")
    when = with_frequency(ends.select("series_id", "last_ts"), series, freq)
    times = horizon(when, steps).select("series_id", "step", "ts")
    return made.join(times, ["series_id", "step"]).select("series_id", F.lit(model).alias("model"), "step", "ts", "yhat")


def walk_forward(train: DataFrame, test: DataFrame, order: Order, model: str = "ARIMA") -> DataFrame:
    """One-step forecasts of the test points, refitted on all true values before each point.

    The refits share running sums of the moments, so a step costs one small solve. The long
    autoregression behind the innovations is fitted on the training part.
    """
    sizes = train.groupBy("series_id").agg(F.count(F.lit(1)).alias("_train"))
    both = train.select("series_id", "ts", "value").unionByName(test.select("series_id", "ts", "value"))
    placed = materialize(positions(both).join(sizes, "series_id"))
    frame = _with_innovations(lag_rows(placed, order), F.col("pos") <= F.col("_train"))
    z = frame.regressors() + [frame.w()]
    pairs, complete = _moments(z)
    size, k = len(z), len(z) - 1
    undo = F.lit(0.0)
    for j, c in order.polynomial.items():
        if j:
            undo = undo - frame.level(j) * c
    last = frame.level(1) if order.p or order.q or order.d else F.col("value")
    rows = frame.rows.select(
        "series_id", "ts", "pos", "_train", undo.alias("_undo"), complete.alias("_ok"),
        (F.col("_y1") if "_y1" in frame.rows.columns else last).alias("_last"),
        *[c.alias(f"_z{i}") for i, c in enumerate(z)])
    rows = materialize(rows.withColumn("_chunk", F.floor((F.col("pos") - 1) / CHUNK)))
    products = {f"_m{n}": F.when(F.col("_ok"), F.col(f"_z{i}") * F.col(f"_z{j}")) for n, (i, j) in enumerate(pairs)}
    rows = rows.withColumns(products)
    per_chunk = rows.groupBy("series_id", "_chunk").agg(*[F.sum(c).alias(c) for c in products])
    earlier = W.partitionBy("series_id").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = per_chunk.select("series_id", "_chunk", *[F.coalesce(F.sum(c).over(earlier), F.lit(0.0)).alias(f"{c}c") for c in products])
    before = W.partitionBy("series_id", "_chunk").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    running = (rows.withColumns({f"{c}r": F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in products})
               .join(carry, ["series_id", "_chunk"]).where(F.col("pos") > F.col("_train"))
               .select("series_id", "ts", "_undo", "_last", F.array(*[F.col(f"_z{i}") for i in range(k)]).alias("z"),
                       F.array(*[F.col(f"{c}r") + F.col(f"{c}c") for c in products]).alias("m")))

    def pick(row, full):
        coef, _ = _solve(full, list(range(k)), size - 1)
        z = np.asarray(row.z, float)
        value = float(coef @ z) + row.undo
        yield (row.series_id, row.ts, value if np.isfinite(value) else float(row.last))

    made = _least_squares(running.withColumnsRenamed({"_undo": "undo", "_last": "last"}), size,
                          "series_id string, ts timestamp_ntz, yhat double", pick)
    return made.select("series_id", F.lit(model).alias("model"), "ts", "yhat")


def difference_order(series: DataFrame, max_d: int = 2, max_lag: int | None = None) -> DataFrame:
    """Smallest d whose lag-d difference rejects a unit root at 5 %, else 1: (series_id, d).

    The augmented regression of each d is one moment table; its lag length is chosen by AIC
    from sub-matrices. Without ``max_lag`` every series has the bound 12 (n / 100)^(1/4) of its own length n.
    """
    placed = materialize(positions(series))
    bound = F.lit(max_lag) if max_lag is not None else F.ceil(12 * F.pow(F.col("n") / 100, F.lit(0.25)))
    if max_lag is None:
        max_lag = placed.agg(F.max(bound)).first()[0] or 1       # the widest frame that a series needs
    tests = None
    for d in range(max_d + 1):
        lags = {f"_y{k}": ("value", k) for k in range(1, d + max_lag + 2)}
        rows = lagged(placed, KEY, "pos", lags, CHUNK)

        def x(k, d=d):
            now = F.col(f"_y{k}") if k else F.col("value")
            return now - F.col(f"_y{k + d}") if d else now

        # lags beyond a series' own bound are 0 and not used, so they cost it no rows
        z = ([F.lit(1.0), x(1)] + [F.when(F.lit(i) <= bound, x(i) - x(i + 1)).otherwise(0.0) for i in range(1, max_lag + 1)]
             + [bound.cast("double"), x(0) - x(1)])
        size = len(z)

        def pick(row, full, d=d, size=size):
            most = int(round(full[0, size - 2] / row.rows))
            if row.rows + most + 1 < 10:
                return
            best = None
            for lag in range(most + 1):
                cols = list(range(2 + lag))
                free = row.rows - len(cols)
                if free < 2:
                    break
                coef, rss = _solve(full, cols, size - 1)
                aic = row.rows * math.log(max(rss, 1e-300) / row.rows) + 2 * len(cols)
                if best is None or aic < best[0]:
                    inverse = np.linalg.pinv(full[np.ix_(cols, cols)], hermitian=True)
                    error = math.sqrt(max(rss / free * inverse[1, 1], 1e-300))
                    best = (aic, coef[1] / error)
            if best is not None:
                yield (row.series_id, d, float(best[1]))

        one = _least_squares(moment_table(rows, z), size, "series_id string, d int, stat double", pick)
        tests = one if tests is None else tests.unionByName(one)
    chosen = tests.where(F.col("stat") < UNIT_ROOT_5_PERCENT).groupBy("series_id").agg(F.min("d").alias("_d"))
    names = placed.select("series_id").distinct()
    return names.join(chosen, "series_id", "left").select("series_id", F.coalesce("_d", F.lit(1)).alias("d"))


def grid(ps=(0, 1, 2), ds=(0, 1), qs=(0, 1, 2), seasonal=(0, 0, 0, 0)) -> list[Order]:
    """All orders of the grid but p = q = 0."""
    return [Order(p, d, q, seasonal) for p in ps for d in ds for q in qs if p or q]


def calibrate(train: DataFrame, ps=(0, 1, 2), ds=None, qs=(0, 1, 2), seasonal=(0, 0, 0, 0)) -> DataFrame:
    """Best order per series by AIC; without ``ds`` the neighbours of the tested d are tried."""
    if ds is not None:
        return best_order(fit_grid(train, grid(ps, ds, qs, seasonal)))
    tested = difference_order(train)
    fits = fit_grid(train, grid(ps, (0, 1, 2), qs, seasonal))
    near = fits.join(tested.withColumnRenamed("d", "_d"), "series_id").where(F.abs(F.col("d") - F.col("_d")) <= 1)
    return best_order(near.drop("_d"))


def _by_order(table: DataFrame, chosen: DataFrame, orders: list[Order], make) -> DataFrame:
    """Apply ``make(subset, order)`` to the series of every order of the grid that was chosen."""
    used = {(r["p"], r["d"], r["q"]) for r in chosen.select("p", "d", "q").distinct().collect()}
    out = None
    for o in orders:
        if (o.p, o.d, o.q) not in used:
            continue
        mine = chosen.where((F.col("p") == o.p) & (F.col("d") == o.d) & (F.col("q") == o.q)).select("series_id")
        one = make(mine, o)
        out = one if out is None else out.unionByName(one)
    return out


def calibrated_walk_forward(train: DataFrame, test: DataFrame, ps=(0, 1, 2), ds=(0, 1), qs=(0, 1, 2),
                            seasonal=(0, 0, 0, 0), model: str = "ARIMA Calibrado") -> DataFrame:
    """Order by AIC on the training part, then one-step forecasts of the test part."""
    chosen = materialize(calibrate(train, ps, ds, qs, seasonal))
    return _by_order(train, chosen, grid(ps, ds if ds is not None else (0, 1, 2), qs, seasonal),
                     lambda mine, o: walk_forward(train.join(mine, "series_id", "left_semi"),
                                                  test.join(mine, "series_id", "left_semi"), o, model))


def auto_forecast(series: DataFrame, steps: int, freq: str | None = "D", model: str = "ARIMA") -> DataFrame:
    """ARIMA(1, d, 1) with d from the unit-root test."""
    chosen = materialize(difference_order(series).select("series_id", F.lit(1).alias("p"), "d", F.lit(1).alias("q")))
    return _by_order(series, chosen, [Order(1, d, 1) for d in (0, 1, 2)],
                     lambda mine, o: forecast(series.join(mine, "series_id", "left_semi"), steps, o, freq, model))
