"""Gradient boosting over histograms: one multinomial model for any number of classes, or squared error for values.

Features are cut into bins once and stored in blocks of rows. A level of a round is one job: tasks add the gradients of
their blocks by (tree, node, feature, bin), Spark sums them and finds the best cut by each feature for every node of all
classes' trees together. Gradients are added as integers, so a model depends on the rows alone, not on their order or partitions. The
driver holds the trees.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize
from .quantiles import column_quantiles

BLOCK_ROWS = 1 << 13       # rows of a stored block
DENSE_CELLS = 1 << 20      # histogram cells a task adds up before they leave it; more go out block by block
UNIT_BITS = 36             # a gradient is a whole number of 2 ** -36 of the largest possible one
FLAT = 1e-9                # sides whose means differ by less than this share of the largest gradient are not parted

_BLOCK = "n int, bins binary, y binary, w binary, score binary"
_CELLS = "tree int, node int, feature int, bin int, n bigint, w bigint, g bigint, h bigint"
_CELL_SCHEMA = pa.schema([(c, pa.int32()) for c in ("tree", "node", "feature", "bin")] + [(c, pa.int64()) for c in "nwgh"])


class Tree:
    """Nodes in the order they were made; a child pair is (left, left + 1), ``feature`` is -1 in a leaf."""

    def __init__(self):
        self.feature, self.bin, self.left, self.value, self.rows = [-1], [0], [-1], [0.0], [0]

    def split(self, node, feature, at, left, right):
        self.feature[node], self.bin[node], self.left[node] = feature, at, len(self.feature)
        for value, rows in (left, right):
            self.feature.append(-1), self.bin.append(0), self.left.append(-1), self.value.append(value), self.rows.append(rows)
        return self.left[node], self.left[node] + 1

    def place(self, bins):
        """Leaf of every row of a matrix of bins."""
        feature, cut, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        at, every = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = feature[at]
            if (f < 0).all():
                return at
            right = bins[every, np.maximum(f, 0)] > cut[at]
            at = np.where(f < 0, at, left[at] + right)

    def add_to(self, bins):
        return np.array(self.value)[self.place(bins)]


def _added(score, bins, rounds):
    for trees in rounds:
        for k, tree in enumerate(trees):
            score[:, k] += tree.add_to(bins)
    return score


def _probabilities(score):
    if score.shape[1] == 1:
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))
    e = np.exp(score - score.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _gradients(score, y, classes):
    """Negative gradient and curvature of each tree's loss; ``classes`` is 0 for values."""
    if not classes:
        return y[:, None] - score, np.ones_like(score)
    p = _probabilities(score)
    hit = (y[:, None] == 1) if classes == 2 else (y[:, None] == np.arange(classes))
    return hit - p, p * (1 - p)


def _binned(x, cuts):
    """Row goes left of cut j if x <= cut; missing values are right of all cuts."""
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint16)


def bin_cuts(rows: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """Cut points of each feature of ``x``: between all neighbouring values if there are at most ``max_bins``, else the
    exact quantiles at equal steps."""
    cols = rows.select(*[F.col("x")[f].alias(f"x{f}") for f in range(width)])
    names = cols.columns
    sizes = cols.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first().asDict()
    narrow = [f for f, c in enumerate(names) if sizes[c] <= 2 * max_bins]
    known: dict[int, list] = {f: [] for f in narrow}
    if narrow:
        # the sketch admits columns of few values only, so these lists are short
        pairs = cols.select(F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(names[f]).alias("v")) for f in narrow])).alias("s"))
        for r in pairs.select("s.f", "s.v").where("v IS NOT NULL AND NOT isnan(v)").distinct().collect():
            known[r.f].append(r.v)
    wide = [f for f in range(width) if f not in known or len(known[f]) > max_bins]
    quantiles = column_quantiles(cols, [names[f] for f in wide], [i / max_bins for i in range(1, max_bins)], sizes=sizes)
    out = []
    for f in range(width):
        if f in wide:
            out.append(np.unique([q for q in quantiles[names[f]] if q is not None]))
        else:
            v = np.sort(np.array(known[f], float))
            out.append((v[:-1] + v[1:]) / 2)
    return out


def _blocks(rows: DataFrame, cuts, start) -> DataFrame:
    """(n, bins, y, w, score): the rows in blocks of bytes."""
    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), BLOCK_ROWS):
                part = pdf.iloc[at:at + BLOCK_ROWS]
                bins = _binned(np.stack(part["x"].to_numpy()).astype(float), cuts)
                score = np.tile(np.asarray(start, float), (len(part), 1))
                yield pd.DataFrame({"n": [len(part)], "bins": [bins.tobytes()], "y": [part["y"].to_numpy(float).tobytes()],
                                    "w": [part["w"].to_numpy(float).tobytes()], "score": [score.tobytes()]})
    return rows.mapInPandas(run, _BLOCK)


def _read(batches, width, trees):
    for batch in batches:
        for r in batch.to_pylist():                # one entry per block, not per row
            n = r["n"]
            yield (np.frombuffer(r["bins"], np.uint16).reshape(n, width), np.frombuffer(r["y"]), np.frombuffer(r["w"]),
                   np.frombuffer(r["score"]).reshape(n, trees).copy())


def _advanced(blocks: DataFrame, width, trees, rounds) -> DataFrame:
    """The blocks with the rounds added to their scores."""
    def run(batches):
        for bins, y, w, score in _read(batches, width, trees):
            score = _added(score, bins, rounds)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int32()), "bins": [bins.tobytes()], "y": [y.tobytes()],
                                              "w": [w.tobytes()], "score": [score.tobytes()]})
    return blocks.mapInArrow(run, _BLOCK)


def _histograms(blocks: DataFrame, width, pending, growing, active, classes, bins_max, unit_w, unit_g) -> DataFrame:
    """Sums of the open nodes by (tree, node, feature, bin) for each task; ``active[k]`` lists tree k's open nodes."""
    trees = len(growing)
    slots = []
    for tree, nodes in zip(growing, active):
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        slots.append(slot)
    shapes = [(len(nodes), width, bins_max) for nodes in active]
    dense = sum(math.prod(s) for s in shapes) <= DENSE_CELLS

    def rows_of(sums):
        for k, cells in enumerate(sums):
            node, feature, at = np.nonzero(cells[0])
            if len(node):
                ids = [np.full(len(node), k), np.array(active[k])[node], feature, at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i.astype(np.int32)) for i in ids] + [pa.array(c[node, feature, at]) for c in cells], schema=_CELL_SCHEMA)

    def empty():
        return [np.zeros((4, *s), np.int64) for s in shapes]

    def run(batches):
        sums = empty()
        for bins, y, w, score in _read(batches, width, trees):
            g, h = _gradients(_added(score, bins, pending), y, classes)
            whole_w = np.rint(w * unit_w)
            for k, tree in enumerate(growing):
                if not len(active[k]):
                    continue
                slot = slots[k][tree.place(bins)]
                inside = slot >= 0
                # a block's sums stay below 2 ** 53, so adding them as doubles is exact
                values = (None, whole_w[inside], np.rint(g[inside, k] * w[inside] * unit_g), np.rint(h[inside, k] * w[inside] * unit_w))
                for f in range(width):
                    code = slot[inside] * bins_max + bins[inside, f]
                    for c, v in enumerate(values):
                        sums[k][c, :, f] += np.bincount(code, v, len(active[k]) * bins_max).astype(np.int64).reshape(-1, bins_max)
            if not dense:
                yield from rows_of(sums)
                sums = empty()
        if dense:
            yield from rows_of(sums)

    return blocks.mapInArrow(run, _CELLS)


def _best_cuts(cells: DataFrame, least_leaf: int, least_split: int, flat: float) -> DataFrame:
    """Best cut of every (tree, node, feature): largest drop of the squared error, then the first cut."""
    summed = (cells.repartition("tree", "node", "feature").groupBy("tree", "node", "feature", "bin")
              .agg(*[F.sum(c).alias(c) for c in "nwgh"]))
    node = W.partitionBy("tree", "node", "feature")
    run = node.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    sides = summed.select("tree", "node", "feature", "bin", *[F.sum(c).over(run).alias(f"{c}l") for c in "nwgh"],
                          *[F.sum(c).over(node).alias(f"{c}a") for c in "nwgh"])
    sides = sides.select("*", *[(F.col(f"{c}a") - F.col(f"{c}l")).alias(f"{c}r") for c in "nwgh"])
    real = {c: F.col(c).cast("double") for c in ("gl", "gr", "wl", "wr", "wa")}      # products of the sums leave the whole numbers' range
    apart = real["gl"] / real["wl"] - real["gr"] / real["wr"]
    gain = real["wl"] * real["wr"] / real["wa"] * apart * apart
    fit = ((F.col("nl") >= least_leaf) & (F.col("nr") >= least_leaf) & (F.col("na") >= least_split)
           & (F.col("wl") > 0) & (F.col("wr") > 0))
    ranked = sides.where(fit).where(F.abs(apart) > flat).select("tree", "node", "feature", F.struct(
        gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"),
        *[f"{c}{s}" for s in "lr" for c in "nwgh"]).alias("best"))
    return ranked.groupBy("tree", "node", "feature").agg(F.max("best").alias("best"))      # partitioned so already


class Boosted:
    """Boosting of regression trees: softmax over all classes (one logit for two), squared error for ``task='regression'``.

    Starts from the class shares or the mean; a leaf's value is one Newton step times ``learning_rate``. ``max_depth`` None
    grows until nothing is gained. Rows without a label or features, or without a positive weight, are not learned from;
    a missing number lies right of all cuts. An empty table raises ValueError; a single class gives a model without trees.
    """

    def __init__(self, n_estimators=100, max_depth=3, learning_rate=0.1, min_samples_split=2, min_samples_leaf=1,
                 task="classification", max_bins=256, keep_rounds=25, weightCol=None):
        if not 0 < learning_rate <= 1:
            raise ValueError("learning_rate must be above 0 and at most 1")
        if not 2 <= max_bins <= 1 << 16:
            raise ValueError("max_bins must be from 2 to 65536")
        self.rounds, self.depth, self.rate = n_estimators, max_depth, learning_rate
        self.least_split, self.least_leaf, self.task = min_samples_split, min_samples_leaf, task
        self.max_bins, self.keep_rounds, self.weightCol = max_bins, keep_rounds, weightCol

    def setWeightCol(self, name):
        self.weightCol = name
        return self

    def fit(self, df: DataFrame) -> "BoostedModel":
        vector = not dict(df.dtypes)["features"].startswith("array")
        x = vector_to_array("features") if vector else F.col("features").cast("array<double>")
        weight = F.col(self.weightCol).cast("double") if self.weightCol else F.lit(1.0)
        rows = df.where("features IS NOT NULL").select(
            x.alias("x"), F.col("label").cast("double").alias("y"), weight.alias("w")).where("y IS NOT NULL AND NOT isnan(y) AND w > 0")
        head = rows.agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w"), F.max(F.size("x")).alias("width"),
                        (F.max("y") - F.min("y")).alias("spread"), (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("mean")).first()
        if not head.n:
            raise ValueError("no rows to learn from")
        width, labels = head.width, None
        if self.task == "regression":
            classes, start, largest = 0, [head.mean], head.spread or 1.0
        else:
            shares = rows.groupBy("y").agg(F.sum("w").alias("w")).orderBy("y").collect()     # one row per class
            labels, share = [r.y for r in shares], np.array([r.w for r in shares])
            classes, largest, log = len(labels), 1.0, np.log(share / share.sum())
            start = log[1:] - log[:1] if classes == 2 else log
            place = F.element_at(F.create_map(*[F.lit(v) for i, y in enumerate(labels) for v in (y, float(i))]), F.col("y"))
            rows = rows.withColumn("y", place)
        cuts = bin_cuts(rows, width, self.max_bins)
        model = BoostedModel(cuts, start, [], labels)
        if classes == 1 or not any(len(c) for c in cuts):
            return model
        unit = 2.0 ** min(UNIT_BITS, 61 - math.ceil(math.log2(head.n + 1)))
        unit_w, unit_g = unit / head.w, unit / (head.w * largest)
        blocks = materialize(_blocks(rows, cuts, start)).persist()
        try:
            pending: list = []
            for _ in range(self.rounds):
                trees = self._round(blocks, width, pending, len(start), classes, max(map(len, cuts)) + 1, unit_w, unit_g)
                model.rounds.append(trees), pending.append(trees)
                if all(len(t.feature) == 1 for t in trees):
                    break                              # nothing left to gain, later rounds would be the same
                if len(pending) == self.keep_rounds:
                    kept = materialize(_advanced(blocks, width, len(start), pending)).persist()
                    blocks.unpersist()
                    blocks, pending = kept, []
            return model
        finally:
            blocks.unpersist()

    def _round(self, blocks, width, pending, count, classes, bins_max, unit_w, unit_g):
        """The trees of one round, grown level by level."""
        growing, active = [Tree() for _ in range(count)], [[0]] * count
        step = self.rate * ((classes - 1) / classes if classes > 2 else 1.0)
        level = 0
        while any(active) and (self.depth is None or level < self.depth):
            cells = _histograms(blocks, width, pending, growing, active, classes, bins_max, unit_w, unit_g)
            found = _best_cuts(cells, self.least_leaf, self.least_split, FLAT).collect()
            best_of = {}                               # from one row per open node and feature; ties go to the first feature
            for r in sorted(found, key=lambda r: r.best):
                best_of[r.tree, r.node] = r.best
            active = [[] for _ in growing]
            for (tree, node), best in sorted(best_of.items()):
                sides = []
                for s in "lr":
                    below = best[f"h{s}"] if classes else best[f"w{s}"]
                    value = best[f"g{s}"] / unit_g / (below / unit_w) if below > 0 else 0.0
                    sides.append((step * value, best[f"n{s}"]))
                active[tree] += growing[tree].split(node, -best["f"], -best["b"], *sides)
            level += 1
        return growing


class BoostedModel:
    """``rounds`` holds one list of trees per round, a tree per class; ``labels`` is None for values."""

    def __init__(self, cuts, start, rounds, labels):
        self.cuts, self.start, self.rounds, self.labels = cuts, np.asarray(start, float), rounds, labels

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Summed values of a matrix of rows: one column per tree of a round."""
        return _added(np.tile(self.start, (len(x), 1)), _binned(x, self.cuts), self.rounds)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (class label or value); rows without features get NULL."""
        vector = not dict(df.dtypes)["features"].startswith("array")
        x = vector_to_array("features") if vector else F.col("features").cast("array<double>")
        model = self

        @F.pandas_udf("double")
        def predict(rows: pd.Series) -> pd.Series:
            out, known = np.full(len(rows), np.nan), rows.notna().to_numpy()
            if known.any():
                score = model.scores(np.stack(rows[known].to_numpy()).astype(float))
                if model.labels is None:
                    out[known] = score[:, 0]
                elif score.shape[1] == 1 and len(model.labels) == 2:
                    out[known] = np.asarray(model.labels)[(score[:, 0] > 0).astype(int)]
                else:
                    out[known] = np.asarray(model.labels)[score.argmax(1)]
            return pd.Series(out).where(known, None).astype(object)

        return df.withColumn("prediction", predict(x))

    def leaves(self) -> list[tuple]:
        """(round, label, path, n_rows, value) of every leaf; the path is a string of L and R from the root."""
        out = []
        for number, trees in enumerate(self.rounds, 1):
            for k, tree in enumerate(trees):
                label = None if self.labels is None else float(self.labels[1 if len(self.labels) == 2 else k])
                open_nodes = [(0, "")]
                while open_nodes:
                    node, path = open_nodes.pop()
                    if tree.feature[node] < 0:
                        out.append((number, label, path, int(tree.rows[node]), float(tree.value[node])))
                    else:
                        open_nodes += [(tree.left[node], path + "L"), (tree.left[node] + 1, path + "R")]
        return out
