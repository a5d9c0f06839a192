"""Data-parallel multilayer perceptrons and a random-feature support vector regressor.

Full-data gradients: weights travel to the tasks, each task answers with one row of sums for its
rows, and the sums are added in a tree of tasks. Mini-batches: the rows are stored in blocks of a
random order that depends on the rows alone; every block takes the steps of a pass by itself and
the blocks' states are averaged after it. The driver keeps weights and optimizer state only.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import HASH_RANGE, hash32
from ..session import materialize, shuffle_width
from . import metrics as M
from . import scale as S
from .ranking import number_rows

BLOCK_VALUES = 1 << 20   # numbers of a block of training rows; smaller tables are one block
STAGE_PASSES = 100       # passes over a table of one block in one job
COPIES = 1 << 12
TREE_WIDTH = 32          # partial sums are folded on the cluster down to this many rows


def _pack(parts):
    return np.concatenate([p.ravel() for p in parts])


def _unpack(flat, shapes):
    out, at = [], 0
    for s in shapes:
        size = int(np.prod(s))
        out.append(flat[at:at + size].reshape(s))
        at += size
    return out


def layer_shapes(sizes):
    return [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,))]


def initial_weights(sizes, activation, seed=42):
    """Uniform start with the usual fan-in/fan-out bound."""
    rng, parts = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:]):
        bound = np.sqrt((2.0 if activation == "logistic" else 6.0) / (a + b))
        parts += [rng.uniform(-bound, bound, (a, b)), rng.uniform(-bound, bound, b)]
    return _pack(parts)


def forward(x, flat, shapes, activation, head):
    parts, h, layers = _unpack(flat, shapes), x, [x]
    for i in range(0, len(parts), 2):
        z = h @ parts[i] + parts[i + 1]
        if i + 2 < len(parts):
            h = np.maximum(z, 0) if activation == "relu" else np.tanh(z)
        elif head == "softmax":
            z = np.exp(z - z.max(1, keepdims=True))
            h = z / z.sum(1, keepdims=True)
        elif head == "sigmoid":
            h = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        else:
            h = z
        layers.append(h)
    return layers


def loss_and_gradient(x, y, flat, shapes, activation, head):
    """Summed loss and gradient; ``y`` is a class number (softmax, sigmoid) or a value (linear)."""
    layers, parts = forward(x, flat, shapes, activation, head), _unpack(flat, shapes)
    out = layers[-1]
    if head == "softmax":
        picked = out[np.arange(len(y)), y.astype(int)]
        loss, delta = -np.log(np.maximum(picked, 1e-12)).sum(), out.copy()
        delta[np.arange(len(y)), y.astype(int)] -= 1
    elif head == "sigmoid":
        p = np.clip(out[:, 0], 1e-12, 1 - 1e-12)
        loss, delta = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum(), out - y[:, None]
    else:
        delta = out - y[:, None]
        loss = 0.5 * (delta ** 2).sum()
    grads = [None] * len(parts)
    for i in range(len(parts) - 2, -1, -2):
        grads[i], grads[i + 1] = layers[i // 2].T @ delta, delta.sum(0)
        if i:
            h = layers[i // 2]
            delta = (delta @ parts[i].T) * ((h > 0) if activation == "relu" else (1 - h * h))
    return loss, _pack(grads)


def _fold(batches):
    total, first = None, True
    for pdf in batches:
        for v in pdf["v"]:
            total = np.array(v) if total is None else total + v
    if total is not None:
        yield pd.DataFrame({"v": [total]})


def tree_sum(df: DataFrame, partial, parts: int) -> np.ndarray:
    """Sum of the vectors that ``partial(batches of (x, y)) -> vector`` gives for each of the
    ``parts`` partitions."""
    def run(batches):
        value = partial((np.stack(b["x"].to_numpy()), b["y"].to_numpy(float)) for b in batches if len(b))
        if value is not None:
            yield pd.DataFrame({"v": [value]})
    sums = df.mapInPandas(run, "v array<double>")
    if parts > TREE_WIDTH:
        sums = sums.repartition(TREE_WIDTH).mapInPandas(_fold, "v array<double>")
    rows = sums.collect()                      # at most TREE_WIDTH rows of one weight vector
    return np.sum([r["v"] for r in rows], axis=0)


def count_rows(df: DataFrame) -> tuple[int, int]:
    """Number of rows and of non-empty partitions."""
    row = df.select(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)), F.count_distinct("p")).first()
    return row[0], row[1]


def training_blocks(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """(block, x, y): the rows in a random order that depends on their values and the seed alone, in even blocks of at
    most BLOCK_VALUES numbers, one row per block.

    Equal rows are counted and numbered again, so a frequent row is spread like others and never sorted in one task.
    """
    counted = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    # copies are numbered in two steps, so no array grows with the count of one row
    spans = counted.select("x", "y", "n", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / COPIES).cast("bigint"))).alias("span"))
    copies = spans.select("x", "y", F.explode(F.sequence(F.col("span") * COPIES, F.least((F.col("span") + 1) * COPIES, "n") - 1)).alias("copy"))
    drawn = copies.withColumn("h", hash32(F.xxhash64("x", "y", "copy"), seed))
    cell = F.floor(F.col("h") * (4 * shuffle_width(rows.sparkSession)) / F.lit(HASH_RANGE))
    numbered = number_rows(drawn, [], cell, ["h", "x", "y", "copy"], total="rows")
    blocks = F.ceil(F.col("rows") / max(1, BLOCK_VALUES // (width + 1)))
    dealt = numbered.select(F.expr("(pos - 1)").alias("at"), "rows", blocks.alias("blocks"), F.struct("pos", "x", "y").alias("r"))
    lists = dealt.groupBy(F.floor(F.col("at") * F.col("blocks") / F.col("rows")).alias("block")).agg(F.array_sort(F.collect_list("r")).alias("r"))
    return lists.select("block", F.flatten("r.x").alias("x"), F.col("r.y").alias("y"))


@dataclass
class AdamState:
    """Optimizer state between stages. ``epoch`` counts whole passes, ``stale`` those without progress."""
    flat: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: int = 0
    epoch: int = 0
    best: float = np.inf
    stale: int = 0
    loss: float = np.inf            # Arrow would turn NaN into NULL

    def step(self, g, rate):
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        self.flat = self.flat - rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)

    def end_pass(self, loss, tol):
        self.epoch, self.loss = self.epoch + 1, loss
        self.stale = 0 if loss < self.best - tol else self.stale + 1
        self.best = min(loss, self.best)

    def packed(self):
        return np.concatenate([self.flat, self.m, self.v, [self.t, self.epoch, self.best, self.stale, self.loss]])

    @classmethod
    def unpacked(cls, row):
        flat, m, v = np.split(row[:-5], 3)
        t, epoch, best, stale, loss = row[-5:]
        return cls(flat, m, v, round(t), round(epoch), best, round(stale), loss)


def _ordered_sum(df: DataFrame, blocks: int) -> np.ndarray:
    """Sum of the vectors of (block, v) in the order of the blocks, folded on the cluster down to TREE_WIDTH rows."""
    def fold(pdf):
        pdf = pdf.sort_values("block")
        return pd.DataFrame({"block": [pdf["block"].iloc[0] // TREE_WIDTH], "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0)]})
    while blocks > TREE_WIDTH:
        df = df.groupBy((F.col("block") / TREE_WIDTH).cast("bigint")).applyInPandas(fold, "block bigint, v array<double>")
        blocks = -(-blocks // TREE_WIDTH)
    return np.sum([r["v"] for r in sorted(df.collect(), key=lambda r: r["block"])], axis=0)


def adam_passes(blocks: DataFrame, count: int, state: AdamState, passes: int, gradient, batch: int, rate: float, seed: int,
                stop=None) -> tuple[AdamState, float]:
    """``passes`` passes of mini-batch Adam from the same state in every block; states are averaged by rows at the end.

    Batches are drawn from (seed, pass, block), so the weights depend on the rows only, not on partitions or tasks.
    ``gradient(x, y, w)`` gives (summed loss, summed gradient). With one block, ``stop(state, summed loss)`` closes a
    pass and says whether to end. Returns the state and the summed loss of the last pass.
    """
    def run(batches):
        for pdf in batches:
            for block, x, y in zip(pdf["block"], pdf["x"], pdf["y"]):
                x, y = np.asarray(x, float).reshape(len(y), -1), np.asarray(y, float)
                now, total = replace(state), 0.0
                for number in range(state.epoch, state.epoch + passes):
                    order, total = np.random.default_rng([seed, number, block]).permutation(len(y)), 0.0
                    for at in range(0, len(y), batch):
                        pick = order[at:at + batch]
                        loss, g = gradient(x[pick], y[pick], now.flat)
                        total += loss
                        now.step(g / len(pick), rate)
                    if stop and stop(now, total):
                        break
                yield pd.DataFrame({"block": [block], "v": [np.concatenate([now.packed() * len(y), [total, len(y)]])]})

    added = _ordered_sum(blocks.mapInPandas(run, "block bigint, v array<double>"), count)
    merged = AdamState.unpacked(added[:-2] / added[-1])
    return (merged if stop else replace(merged, epoch=state.epoch, best=state.best, stale=state.stale)), added[-2]


def _lbfgs(value_and_gradient, start, iterations, memory=10, tol=1e-5):
    """Limited-memory quasi-Newton with backtracking; the two-loop state lives on the driver."""
    x, (f, g) = start, value_and_gradient(start)
    pairs = []
    for _ in range(iterations):
        q, alphas = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (y @ s)
            alphas.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(g).sum())
        for (s, y), a in zip(pairs, reversed(alphas)):
            q += s * (a - (y @ q) / (y @ s))
        step, slope = 1.0, -(g @ q)
        while True:
            trial = x - step * q
            ft, gt = value_and_gradient(trial)
            if ft <= f + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = trial - x, gt - g
        if s @ y > 1e-12:
            pairs = (pairs + [(s, y)])[-memory:]
        done = abs(f - ft) < tol * max(1.0, abs(f))
        x, f, g = trial, ft, gt
        if done:
            break
    return x


class MlpModel:
    def __init__(self, flat, shapes, activation, head, classes, loss):
        self.flat, self.shapes, self.activation, self.head, self.classes, self.loss = flat, shapes, activation, head, classes, loss

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (class label or value) from ``features``."""
        flat, shapes, activation, head, classes = self.flat, self.shapes, self.activation, self.head, self.classes

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            out = forward(np.stack(x.to_numpy()), flat, shapes, activation, head)[-1]
            if head == "softmax":
                return pd.Series(np.asarray(classes, float)[out.argmax(1)])
            if head == "sigmoid":
                return pd.Series(np.asarray(classes, float)[(out[:, 0] > 0.5).astype(int)])
            return pd.Series(out[:, 0])

        return df.withColumn("prediction", predict(_as_array(df)))


def _as_array(df, column="features"):
    return F.col(column).cast("array<double>") if dict(df.dtypes)[column].startswith("array") else vector_to_array(column)


class Mlp:
    """Perceptron with relu or tanh layers; softmax / sigmoid head for classes, linear for values.

    ``solver='adam'`` runs up to ``max_iter`` passes of mini-batches and ends after ``patience`` passes whose mean loss
    did not improve by ``tol``. Tables of up to BLOCK_VALUES numbers are one block and take the steps of plain Adam;
    larger ones are averaged over their blocks after each pass. Weights are the same for every layout of the input.
    ``'lbfgs'`` uses exact full-data gradients.
    """

    def __init__(self, layers=(100, 50), activation="relu", solver="adam", max_iter=500, task="classification", batch=200,
                 rate=0.001, penalty=1e-4, binary_head=False, seed=42, tol=1e-4, patience=10):
        if activation not in ("relu", "tanh"):
            raise ValueError("activation must be 'relu' or 'tanh'")
        if solver not in ("adam", "lbfgs"):
            raise ValueError("solver must be 'adam' or 'lbfgs'")
        self.layers, self.activation, self.solver, self.max_iter, self.task = tuple(layers), activation, solver, max_iter, task
        self.batch, self.rate, self.penalty, self.binary_head, self.seed = batch, rate, penalty, binary_head, seed
        self.tol, self.patience = tol, patience

    def fit(self, df: DataFrame) -> MlpModel:
        rows = df.select(_as_array(df).alias("x"), F.col("label").cast("double").alias("y"))
        width = rows.select(F.size("x")).first()[0]
        classes, head, out = None, "linear", 1
        if self.task == "classification":
            classes = sorted(r[0] for r in rows.select("y").distinct().limit(10_001).collect())
            if len(classes) > 10_000:
                raise ValueError("more than 10000 classes")
            head, out = ("sigmoid", 1) if self.binary_head and len(classes) == 2 else ("softmax", len(classes))
            position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("y")) - 1
            rows = rows.withColumn("y", position.cast("double"))
        sizes = [width, *self.layers, out]
        shapes, activation = layer_shapes(sizes), self.activation
        flat = initial_weights(sizes, activation, self.seed)
        mask = self.penalty * _pack([np.full(s, 1.0 if len(s) == 2 else 0.0) for s in shapes])
        fit = self._fit_lbfgs if self.solver == "lbfgs" else self._fit_adam
        flat, loss = fit(rows, width, flat, mask, lambda x, y, w: loss_and_gradient(x, y, w, shapes, activation, head))
        return MlpModel(flat, shapes, activation, head, classes, loss)

    def _fit_lbfgs(self, rows, width, flat, mask, gradient):
        rows = rows.persist()
        n, parts = count_rows(rows)

        def full(w):
            def partial(blocks):
                total = None
                for x, y in blocks:
                    loss, g = gradient(x, y, w)
                    one = np.concatenate([[loss], g])
                    total = one if total is None else total + one
                return total
            total = tree_sum(rows, partial, parts)
            return total[0] / n + 0.5 * (mask * w * w).sum() / n, total[1:] / n + mask * w / n

        try:
            flat = _lbfgs(full, flat, self.max_iter)
            return flat, full(flat)[0]
        finally:
            rows.unpersist()

    def _fit_adam(self, rows, width, flat, mask, gradient):
        blocks = materialize(training_blocks(rows, width, self.seed))
        count, n = blocks.agg(F.count(F.lit(1)), F.sum(F.size("y"))).first()
        tol, patience = self.tol, self.patience
        state = AdamState(flat, np.zeros_like(flat), np.zeros_like(flat))

        def penalized(x, y, w):
            loss, g = gradient(x, y, w)
            return loss, g + mask * w * len(y) / n

        def closed(state, total):
            state.end_pass(total / n + 0.5 * (mask * state.flat * state.flat).sum() / n, tol)
            return state.stale >= patience

        while state.epoch < self.max_iter and state.stale < patience:
            if count == 1:
                passes = min(STAGE_PASSES, self.max_iter - state.epoch)
                state, _ = adam_passes(blocks, count, state, passes, penalized, self.batch, self.rate, self.seed, closed)
            else:
                state, total = adam_passes(blocks, count, state, 1, penalized, self.batch, self.rate, self.seed)
                closed(state, total)
        return state.flat, state.loss


class KernelSvr:
    """Approximate RBF support vector regression: random Fourier features (Rahimi and Recht, 2007)
    and a linear epsilon-insensitive fit with a squared hinge, by full-data quasi-Newton steps.

    The kernel width is 1 / (features * overall variance). Not the exact dual solution.
    """

    def __init__(self, c=100.0, epsilon=0.1, width=200, iterations=100, seed=42):
        self.c, self.epsilon, self.width, self.iterations, self.seed = c, epsilon, width, iterations, seed

    def fit(self, df: DataFrame) -> "KernelSvrModel":
        rows = df.select(_as_array(df).alias("x"), F.col("label").cast("double").alias("y")).persist()
        try:
            d = rows.select(F.size("x")).first()[0]
            moments = rows.select(F.explode("x").alias("v")).agg(F.var_pop("v")).first()[0] or 1.0
            n, parts = count_rows(rows)
            mean = rows.agg(F.avg("y")).first()[0]
            rng = np.random.default_rng(self.seed)
            directions = rng.normal(0, np.sqrt(2.0 / (d * moments)), (d, self.width))
            shift = rng.uniform(0, 2 * np.pi, self.width)
            eps, c = self.epsilon, self.c

            def value_and_gradient(w):
                def partial(blocks):
                    total = None
                    for x, y in blocks:
                        z = np.sqrt(2.0 / len(shift)) * np.cos(x @ directions + shift)
                        r = z @ w[:-1] + w[-1] - (y - mean)
                        over = np.sign(r) * np.maximum(np.abs(r) - eps, 0)
                        one = np.concatenate([[0.5 * (over ** 2).sum()], z.T @ over, [over.sum()]])
                        total = one if total is None else total + one
                    return total
                total = tree_sum(rows, partial, parts)
                keep = np.append(np.ones(len(w) - 1), 0.0) * w / (c * n)
                return total[0] / n + 0.5 * (keep @ w), total[1:] / n + keep

            w = _lbfgs(value_and_gradient, np.zeros(self.width + 1), self.iterations, tol=1e-7)
        finally:
            rows.unpersist()
        return KernelSvrModel(directions, shift, w, mean)


class KernelSvrModel:
    def __init__(self, directions, shift, w, mean):
        self.directions, self.shift, self.w, self.mean = directions, shift, w, mean

    def transform(self, df: DataFrame) -> DataFrame:
        directions, shift, w, mean = self.directions, self.shift, self.w, self.mean

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            z = np.sqrt(2.0 / len(shift)) * np.cos(np.stack(x.to_numpy()) @ directions + shift)
            return pd.Series(z @ w[:-1] + w[-1] + mean)

        return df.withColumn("prediction", predict(_as_array(df)))


def evaluate_network(train: DataFrame, test: DataFrame, features: list[str], network: Mlp, scale: bool = True) -> tuple:
    """Scale on train, fit, predict test: (model, predictions with row_id, label, prediction)."""
    stats = S.learn(train, features, median=False)

    def ready(df):
        out = S.standardize(df, features, stats) if scale else df
        return out.select("row_id", "label", F.array(*[F.col(c).cast("double") for c in features]).alias("features"))

    model = network.fit(ready(train))
    return model, model.transform(ready(test)).select("row_id", "label", "prediction")


def dense_network(activation: str, layers=(64, 32), epochs=100, batch=32, task="classification") -> Mlp:
    """Dense network trained for a fixed number of passes; a sigmoid head for two classes."""
    return Mlp(layers, activation, "adam", epochs, task, batch, penalty=0.0, binary_head=True, patience=epochs + 1)


def compare_networks(train: DataFrame, test: DataFrame, features: list[str], networks: dict[str, Mlp], scale: bool = True) -> DataFrame:
    """Result table of several networks, best first (accuracy, or RMSE for values)."""
    out, task = None, None
    for name, net in networks.items():
        task = net.task
        _, predicted = evaluate_network(train, test, features, net, scale)
        if task == "classification":
            one = M.accuracy_table(M.label_counts(predicted, "label", "prediction"))
        else:
            one = M.regression_errors(predicted, "label", "prediction").select("RMSE", "MAE", "R2")
        one = one.select(F.lit(name).alias("Modelo"), "*")
        out = one if out is None else out.unionByName(one)
    return out.orderBy(F.desc("accuracy") if task == "classification" else F.asc("RMSE"), "Modelo")


def default_networks(layers=(64, 32), epochs=50, batch=32, task="classification") -> dict[str, Mlp]:
    return {"MLP (relu+adam)": Mlp(layers, "relu", "adam", 500, task),
            "Densa ReLU": dense_network("relu", layers, epochs, batch, task),
            "Densa Tanh": dense_network("tanh", layers, epochs, batch, task)}
