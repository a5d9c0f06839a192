"""Exact nearest neighbours as a partitioned join.

About sqrt(n) pivots, in two levels, file every point under a leaf. A leaf knows its number of rows
and, for its own pivot and for a few reference points shared by all leaves, the smallest and the
largest distance of its rows. The join has two rounds. In the first a query visits its own leaf
(and further ones until they hold k rows), which gives a true bound on the distance of its k-th
neighbour. In the second it visits the leaves that no reference point rules out by the triangle
inequality; branches are ruled out before their leaves. Neighbouring leaves form tiles, and a query is sent
once to a tile with the numbers of its leaves there. A tile of one leaf with many rows is cut in blocks, the
queries of a tile are too, so copies of one point, however many, never meet in one task. Blocks grow with the
table up to a bound, so a row is sent to about ``BLOCKS`` of them, not to one for each leaf. Inside a block one
matrix product a leaf finds the candidates, and their distances are then computed exactly. Only the k best of each
block leave it, in the second round only those within the bound.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.hashing import hash32
from ..session import materialize

LEAF_ROWS = 4096         # rows a leaf should hold on average at least, so that a leaf is worth a group and a second round
SPREAD = 256             # pivots picked far apart from each other; further ones are plain sample rows
SAMPLE = 4096
REFERENCES = 8
MAX_CELLS = 1_000_000
POINT_BLOCK = 4096       # rows of a block at least
QUERY_BLOCK = 4096
BLOCKS = 8               # blocks that a table is cut in on either side while they are not full
BLOCK_NUMBERS = 1 << 22  # numbers of the vectors of a full block
PAIRS = 1 << 20          # distances held at once
SLACK = 1e-9             # relative rounding allowed for in every bound


def _distances(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed dimension by dimension so equal points give equal values."""
    total = np.zeros((len(q), len(p)))
    for j in range(q.shape[1]):
        total += (q[:, j, None] - p[None, :, j]) ** 2
    return np.sqrt(total)


def _far_apart(x: np.ndarray, number: int) -> list[int]:
    """Rows picked one after the other, each as far as possible from those before it."""
    rows, far = [0], _distances(x, x[:1])[:, 0]
    while len(rows) < number:
        rows.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[rows[-1:]])[:, 0])
    return rows


def _pivots(sample: np.ndarray, number: int) -> np.ndarray:
    usable = sample[np.isfinite(sample).all(1)]
    if not len(usable):
        return np.zeros((1, sample.shape[1]))
    usable = usable[np.sort(np.unique(usable, axis=0, return_index=True)[1])]
    number = min(number, len(usable))
    rows = _far_apart(usable[:SAMPLE], min(number, SPREAD))
    others = np.setdiff1d(np.arange(len(usable)), rows)[:number - len(rows)]
    return usable[np.concatenate([rows, others]).astype(int)]


class _Tree:
    """Two levels of pivots and the reference points of the bounds."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.tops = pivots[:math.isqrt(len(pivots) - 1) + 1]
        under = _distances(pivots, self.tops).argmin(1)
        self.children = [np.flatnonzero(under == t) for t in range(len(self.tops))]
        self.refs = pivots[_far_apart(pivots, min(REFERENCES, len(pivots)))]

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of every row and the distance from its pivot."""
        top = _distances(x, self.tops).argmin(1)
        leaf, radius = np.zeros(len(x), np.int64), np.zeros(len(x))
        for t in np.unique(top):
            rows = np.flatnonzero(top == t)
            d = _distances(x[rows], self.pivots[self.children[t]])
            best = d.argmin(1)
            leaf[rows], radius[rows] = self.children[t][best], d[np.arange(len(rows)), best]
        return leaf, radius


class _Leaves:
    """Row numbers and distance ranges of the leaves of one group."""

    def __init__(self, tree: _Tree, frame: pd.DataFrame, rows: int):
        self.tree = tree
        self.cell, self.rows = frame["cell"].to_numpy(), frame["n"].to_numpy()
        ranges = [frame[[f"{side}{i}" for i in range(len(tree.refs) + 1)]].to_numpy() for side in ("lo", "hi")]
        self.lo, self.hi = ranges
        self.size = np.zeros(len(tree.pivots), np.int64)
        self.size[self.cell] = self.rows
        at = np.full(len(tree.pivots), -1)
        at[self.cell] = np.arange(len(self.cell))
        branches = [at[c][at[c] >= 0] for c in tree.children]
        self.branches = [b for b in branches if len(b)]
        # leaves of a branch in a row form tiles of ``rows`` rows or one leaf
        self.tile, tile, held = np.zeros(len(tree.pivots), np.int64), 0, 0
        for leaf in np.concatenate(self.branches).tolist():
            if held and held + self.rows[leaf] > rows:
                tile, held = tile + 1, 0
            self.tile[self.cell[leaf]] = tile
            held += self.rows[leaf]

    def homes(self, x: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): the own leaf of a query, or the nearest leaves that hold ``want`` rows (or all)."""
        own = self.tree.leaves(x)[0]
        full = self.size[own] >= want
        rows, cells = [np.flatnonzero(full)], [own[full]]
        left = np.flatnonzero(~full)
        step = max(1, 4_000_000 // len(self.cell))
        for at in range(0, len(left), step):
            part = left[at:at + step]
            order = np.argsort(_distances(x[part], self.tree.pivots[self.cell]), axis=1, kind="stable")
            before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
            i, j = np.nonzero(before < want)
            rows.append(part[i]), cells.append(self.cell[order[i, j]])
        return np.concatenate(rows), np.concatenate(cells)

    def within(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): leaves that may hold a point within ``bound`` of the query."""
        refs = _distances(x, self.tree.refs)
        reach = bound * (1 + SLACK) + 1e-12
        rows, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for branch in self.branches:
            live = np.flatnonzero(self._open(refs, self.lo[branch, 1:].min(0)[None], self.hi[branch, 1:].max(0)[None], reach)[:, 0])
            step = max(1, 4_000_000 // len(branch))
            for at in range(0, len(live), step):
                some = live[at:at + step]
                near = self._open(refs[some], self.lo[branch, 1:], self.hi[branch, 1:], reach[some])
                i, j = np.nonzero(near)
                if len(i):
                    own = np.sqrt(((x[some[i]] - self.tree.pivots[self.cell[branch[j]]]) ** 2).sum(1))
                    keep = ~self._apart(own, self.lo[branch[j], 0], self.hi[branch[j], 0], reach[some[i]])
                    rows.append(some[i[keep]]), cells.append(self.cell[branch[j[keep]]])
        return np.concatenate(rows), np.concatenate(cells)

    @staticmethod
    def _apart(d, lo, hi, reach):
        # a comparison with a missing number is false, so such leaves stay
        return np.maximum(d - hi, lo - d) > reach + SLACK * (d + hi)

    def _open(self, refs, lo, hi, reach):
        near = np.ones((len(refs), len(lo)), bool)
        for r in range(refs.shape[1]):
            near &= ~self._apart(refs[:, r, None], lo[None, :, r], hi[None, :, r], reach[:, None])
        return near


def _filed(tree):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                cell, radius = tree.leaves(x)
                yield pdf.assign(cell=cell.astype("int32"), r=list(np.column_stack([radius, _distances(x, tree.refs)])))
    return run


def _route(groups, want, second):
    """Tiles of a query with its leaves there: its homes in the first round, all others within its bound in the second."""
    def run(batches):
        for pdf in batches:
            for group, part in pdf.groupby("grp"):
                if group not in groups:
                    continue
                leaves = groups[group]
                x, bound = np.stack(part["x"].to_numpy()), part["bound"].to_numpy()
                rows, cells = leaves.homes(x, want)
                if second:
                    width = len(leaves.size)
                    seen = rows * width + cells
                    rows, cells = leaves.within(x, bound)
                    new = ~np.isin(rows * width + cells, seen)
                    rows, cells = rows[new], cells[new]
                if not len(rows):
                    continue
                tiles = leaves.tile[cells]
                order = np.lexsort((cells, tiles, rows))
                rows, tiles, cells = rows[order], tiles[order], cells[order].astype("int32")
                first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (tiles[1:] != tiles[:-1])))
                ends = np.append(first[1:], len(rows))
                for at in range(0, len(first), 20_000):
                    some = first[at:at + 20_000]
                    i = rows[some]
                    yield pd.DataFrame({"qid": part["qid"].to_numpy()[i], "grp": group, "x": list(x[i]), "bound": bound[i], "tile": tiles[some].astype("int32"),
                                        "cells": [cells[a:b] for a, b in zip(some, ends[at:at + 20_000])]})
    return run


def _best_pairs(q: np.ndarray, p: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of p, distance) of the k nearest of each row, ties to the smaller row of p; those beyond ``bound`` may be left out."""
    if not (np.isfinite(q).all() and np.isfinite(p).all()) or len(p) <= k:
        d = _distances(q, p)
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        return np.repeat(np.arange(len(q)), best.shape[1]), best.ravel(), np.take_along_axis(d, best, 1).ravel()
    qq, pp = (q * q).sum(1), (p * p).sum(1)
    rough = qq[:, None] + pp[None, :] - 2 * (q @ p.T)
    # rounding of the product, far above what the sums can lose
    error = 4 * np.finfo(float).eps * (q.shape[1] + 4) * (qq + pp.max())
    limit = np.where(np.isnan(bound), np.inf, bound) ** 2 * (1 + SLACK) + 2 * error
    near = rough <= limit[:, None]
    if near.sum() > 2 * k * len(q):
        limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * error)
        near = rough <= limit[:, None]
    i, j = np.nonzero(near)
    total = np.zeros(len(i))
    for axis in range(q.shape[1]):
        total += (q[i, axis] - p[j, axis]) ** 2
    dist = np.sqrt(total)
    order = np.lexsort((j, dist, i))
    i, j, dist = i[order], j[order], dist[order]
    first = np.searchsorted(i, np.arange(len(q)))
    keep = np.arange(len(i)) - first[i] < k
    return i[keep], j[keep], dist[keep]


def _block_best(k):
    def run(queries, points):
        if not len(queries) or not len(points):
            return pd.DataFrame({"qid": [], "pid": [], "dist": []})
        points = points.sort_values(["cell", "pid"], kind="stable")
        p, pid, cell = np.stack(points["x"].to_numpy()), points["pid"].to_numpy(), points["cell"].to_numpy()
        q, qid, bound = np.stack(queries["x"].to_numpy()), queries["qid"].to_numpy(), queries["bound"].to_numpy()
        cells = queries["cells"].to_numpy()
        row, leaf = np.repeat(np.arange(len(q)), [len(c) for c in cells]), np.concatenate(cells)
        order = np.argsort(leaf, kind="stable")
        row, leaf = row[order], leaf[order]
        found = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]]
        for c in np.unique(leaf).tolist():
            a, b = np.searchsorted(cell, (c, c + 1))
            mine = row[slice(*np.searchsorted(leaf, (c, c + 1)))]
            step = max(1, PAIRS // max(1, b - a))
            for at in range(0, len(mine) if b > a else 0, step):
                some = mine[at:at + step]
                i, j, dist = _best_pairs(q[some], p[a:b], k, bound[some])
                found.append([some[i], a + j, dist])
        i, j, dist = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((pid[j], dist, i))
        i, j, dist = i[order], j[order], dist[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        return pd.DataFrame({"qid": qid[i[keep]], "pid": pid[j[keep]], "dist": dist[keep]})
    return run


def _visited(routed: DataFrame, filed: DataFrame, leaves: DataFrame, want: int, rows: int) -> DataFrame:
    """The best ``want`` of every block a query visits: (qid, pid, dist)."""
    visits = routed.groupBy("grp", "tile").agg(F.count(F.lit(1)).alias("_v"))
    blocks = leaves.groupBy("grp", "tile").agg(F.ceil(F.sum("n") / max(POINT_BLOCK, rows)).alias("_pb"), F.count(F.lit(1)).alias("_leaves"))
    # only a tile of one leaf may hold more than a block
    blocks = blocks.withColumn("_pb", F.when(F.col("_leaves") == 1, F.col("_pb")).otherwise(1)).drop("_leaves")
    plan = materialize(blocks.join(visits, ["grp", "tile"]).withColumn("_qb", F.ceil(F.col("_v") / max(QUERY_BLOCK, rows))).drop("_v"))
    placed = materialize(leaves.join(plan, ["grp", "tile"]).select("grp", "cell", "tile", "_pb", "_qb"))
    # every block of queries of a tile meets every block of points of that tile exactly once
    qs = (routed.join(F.broadcast(plan), ["grp", "tile"])
          .withColumn("qb", F.pmod(hash32(F.col("qid"), 5), F.col("_qb")))
          .withColumn("pb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pb") - 1))))
    ps = (filed.join(F.broadcast(placed), ["grp", "cell"])
          .withColumn("pb", F.pmod(hash32(F.col("pid"), 6), F.col("_pb")))
          .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_qb") - 1))))
    key = ["grp", "tile", "pb", "qb"]
    return qs.select(*key, "qid", "x", "bound", "cells").groupBy(*key).cogroup(ps.select(*key, "cell", "pid", "x").groupBy(*key)).applyInPandas(
        _block_best(want), "qid bigint, pid bigint, dist double")


def _search(queries: DataFrame, points: DataFrame, want: int, leaf_rows: int):
    """(candidates (qid, pid, dist), visits (qid, grp, cell), leaves as a driver frame); None for an empty table."""
    def shaped(df, key):
        grp = F.col("grp").cast("string") if "grp" in df.columns else F.lit("all")
        return df.select(F.col(key).cast("bigint").alias(key), grp.alias("grp"), F.col("x").cast("array<double>").alias("x"))

    q, p = shaped(queries, "qid"), shaped(points, "pid")
    total = p.count()
    if total == 0:
        return None
    number = max(1, min(math.isqrt(total), total // leaf_rows))
    picked = p.orderBy(hash32(F.col("pid"), 11), "pid").limit(max(number, min(SAMPLE, 16 * number))).select("x").collect()
    tree = _Tree(_pivots(np.array([r["x"] for r in picked], float), number))
    filed = materialize(p.mapInPandas(_filed(tree), "pid bigint, grp string, x array<double>, cell int, r array<double>"))
    sides = [side(F.col("r")[i]).alias(f"{name}{i}") for name, side in (("lo", F.min), ("hi", F.max)) for i in range(len(tree.refs) + 1)]
    # one row per (group, leaf); the groups are classes, so this table is small, and checked
    cells = filed.groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("n"), *sides).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} leaves: too many groups")
    rows = max(1, min(total // BLOCKS, BLOCK_NUMBERS // max(1, tree.pivots.shape[1])))
    groups = {g: _Leaves(tree, c, max(POINT_BLOCK, rows)) for g, c in cells.groupby("grp")}
    tiles = pd.concat([pd.DataFrame({"grp": g, "cell": leaves.cell, "tile": leaves.tile[leaves.cell], "n": leaves.rows}) for g, leaves in groups.items()])
    tiles = queries.sparkSession.createDataFrame(tiles, "grp string, cell int, tile int, n bigint")
    schema = "qid bigint, grp string, x array<double>, bound double, tile int, cells array<int>"
    routed = materialize(q.withColumn("bound", F.lit(float("inf"))).mapInPandas(_route(groups, want, False), schema))
    best = _visited(routed, filed, tiles, want, rows)
    if cells["cell"].nunique() > 1:
        order = W.partitionBy("qid").orderBy("dist", "pid")
        best = materialize(best.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= want).drop("_at"))
        bounds = best.groupBy("qid").agg(F.max("dist").alias("bound"))
        again = materialize(q.join(bounds, "qid").mapInPandas(_route(groups, want, True), schema))
        best = best.unionByName(_visited(again, filed, tiles, want, rows))
        routed = routed.unionByName(again)
    return best, routed.select("qid", "grp", F.explode("cells").alias("cell")), cells


def nearest(queries: DataFrame, points: DataFrame, k: int, same_rows: bool = False, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The k nearest points of every query: (qid, pid, dist, rank), ties by ``pid``.

    ``queries`` is (qid, x) or (qid, grp, x), ``points`` (pid, x) or (pid, grp, x) with array
    features; with ``grp`` neighbours are searched inside the group. ``same_rows`` drops the
    pair of a row with itself. ``leaf_rows`` sets how fine the points are cut, not the result: smaller
    leaves compare fewer pairs and cost more groups.
    """
    found = _search(queries, points, k + 1 if same_rows else k, leaf_rows)
    if found is None:
        return queries.sparkSession.createDataFrame([], "qid bigint, pid bigint, dist double, rank int")
    best = found[0]
    if same_rows:
        best = best.where(F.col("qid") != F.col("pid"))
    order = W.partitionBy("qid").orderBy("dist", "pid")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def compared_pairs(queries: DataFrame, points: DataFrame, k: int, leaf_rows: int = LEAF_ROWS) -> int:
    """How many distances ``nearest`` looks at: rows of every leaf times the queries that visit it."""
    found = _search(queries, points, k, leaf_rows)
    if found is None:
        return 0
    visits = found[1].groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("v")).toPandas()
    both = visits.merge(found[2], on=["grp", "cell"])
    return int((both["v"] * both["n"]).sum())


def vote(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """Most common label among the neighbours of each query, ties to the smallest: (qid, prediction).

    ``labels`` is (pid, label) with numeric labels. A row that was copied keeps its id and label: each copy among
    the neighbours has one vote.
    """
    named = neighbours.join(labels.select("pid", "label").dropDuplicates(["pid"]), "pid")
    counts = named.groupBy("qid", "label").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("qid").agg(F.max_by("label", F.struct("_n", -F.col("label"))).alias("prediction"))


def nearest_centre(df: DataFrame, x: str, centres: list, metric: str = "euclidean", out: str = "cluster") -> DataFrame:
    """Index of the nearest of a few centres and the distance, as one expression per row."""
    points = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    step = (lambda a, b: (a - b) * (a - b)) if metric == "euclidean" else (lambda a, b: F.abs(a - b))
    values = F.col(x).cast("array<double>")
    best = F.array_min(F.transform(points, lambda c, i: F.struct(
        F.aggregate(F.zip_with(values, c, step), F.lit(0.0), lambda s, v: s + v).alias("d"), i.alias("i"))))
    placed = df.withColumn("_near", best)
    distance = F.sqrt(F.col("_near.d")) if metric == "euclidean" else F.col("_near.d")
    return placed.withColumns({out: F.col("_near.i"), "distance": distance}).drop("_near")
