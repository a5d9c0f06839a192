"""Hard negatives by an inverted multi-index with certified search.

Vectors are cut into two halves, and each half has a codebook of ``CODES`` centres, fitted by k-means on a bounded sample
(``SAMPLE_ROWS`` rows, first by a hash of their ids). A row lies in the cell of its two nearest centres. For an anchor a and
a cell (i, j) no score is above

    (a1 . c1[i] + |a1| r1[i])  +  (a2 . c2[j] + |a2| r2[j]),

r being the largest distance of a row from its centre. Both summands are sorted, and a heap walks the cells in falling order
of the sum (multi-sequence algorithm). The search stops when every wanted list is certified: its last entry is above the
next cell's bound, or the bound is below the list's window. So results are exact, recall is 1; the cells only save work.

All rows are indexed. They are dealt over shards of about ``SHARD_ROWS`` rows by a hash, so a cell that holds most rows is
cut like any other, and each shard has its own cells and radii. A task reads one shard, then a stream of anchors, and returns
the best few rows for each; lists of different shards are merged by a window of bounded length. Rows are moved once and never
meet in pairs.

Rows with a null id, label, vector or component, or with one that is not finite, take no part. Rows with one id count as one:
that of the smallest label, then vector. Shorter vectors are filled up with zeros. An empty table gives an empty result; other
columns are not read. Scores must fit a long.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .arrays import lean
from .runs import slices

CODES, SAMPLE_ROWS, SHARD_ROWS, SCALE = 16, 8192, 8192, 256
_EXACT = float(1 << 52)


def scaled(vectors: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v array<long>): the rows that take part, components floor(scale * x)."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    known = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = known.select("id", F.struct("label", F.transform("x", lambda c: F.floor(c * scale)).alias("v")).alias("row"))
    return rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as int64, filled up with zeros."""
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(at)
    if len(size) and (size == width).all():
        return flat[at[0]:at[-1]].reshape(-1, width).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(at[-1] - at[0]) - np.repeat(at[:-1] - at[0], size)] = flat[at[0]:at[-1]]
    return out


def codebook(points: np.ndarray, codes: int = CODES, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centres of ``points`` by k-means."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(codes, len(points)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        own = nearest(points, centres)
        for c in range(len(centres)):
            mine = own == c
            if mine.any():
                centres[c] = points[mine].mean(axis=0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(axis=1) - 2 * (points @ centres.T), axis=1)


class Shard:
    """Rows of one shard in the order of their cells, with the bounds of the cells."""

    def __init__(self, ids, labels, v, books):
        self.half = v.shape[1] // 2
        halves = v[:, :self.half].astype(np.float64), v[:, self.half:].astype(np.float64)
        codes = [nearest(x, c) for x, c in zip(halves, books)]
        far = [np.sqrt(((x - c[k]) ** 2).sum(axis=1)) for x, c, k in zip(halves, books, codes)]
        self.books, self.width = books, len(books[1])
        self.radius = [np.zeros(len(c)) for c in books]
        for r, k, d in zip(self.radius, codes, far):
            np.maximum.at(r, k, d * (1 + 1e-9) + 1e-6)
        cell = codes[0] * self.width + codes[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.v = ids[order], labels[order], v[order]
        self.most = float(np.abs(v).max(initial=0))
        self.quick = self.v.astype(np.float64)
        self.begin = np.searchsorted(cell[order], np.arange(len(books[0]) * self.width + 1))

    def walk(self, a: np.ndarray):
        """Yield (bound, first row, end) of the cells that hold rows, in falling order of the bound."""
        x = a.astype(np.float64)
        sides = []
        for part, book, r in zip((x[:self.half], x[self.half:]), self.books, self.radius):
            top = book @ part + np.sqrt(part @ part) * r
            order = np.argsort(-top, kind="stable")
            sides.append((order.tolist(), (top[order] + 1e-9 * np.abs(top[order]) + 1e-6).tolist()))
        (first, u), (second, w) = sides
        heap, begin = [(-(u[0] + w[0]), 0, 0)], self.begin
        while heap:
            low, i, j = heapq.heappop(heap)
            if j + 1 < len(w):                   # (i, j + 1) has one parent, (i + 1, 0) as well
                heapq.heappush(heap, (-(u[i] + w[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-(u[i + 1] + w[0]), i + 1, 0))
            cell = first[i] * self.width + second[j]
            if begin[cell + 1] > begin[cell]:
                yield -low, int(begin[cell]), int(begin[cell + 1])

    def scores(self, rows: np.ndarray, a: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(a).max(initial=0)) * len(a) < _EXACT:      # sums stay whole numbers in doubles
            return (self.quick[rows] @ a.astype(np.float64)).astype(np.int64)
        return self.v[rows] @ a

    def search(self, a: np.ndarray, wanted: np.ndarray, windows, keep: int) -> tuple[list, int]:
        """The ``keep`` best rows of each window (least, most score) among the rows marked ``wanted``; and rows scored.

        Certificates are tested when the number of visited cells has doubled.
        """
        found_rows, found, visited, open_cells, due, scored = [], [], 0, [], 1, 0
        best = [None] * len(windows)

        def settle():
            nonlocal open_cells, scored
            if not open_cells:
                return
            rows = np.concatenate([np.arange(s, e) for s, e in open_cells])
            open_cells = []
            rows = rows[wanted[rows]]
            scored += len(rows)
            found_rows.append(rows)
            found.append(self.scores(rows, a))
            rows, score = np.concatenate(found_rows), np.concatenate(found)
            for k, (least, most) in enumerate(windows):
                fits = np.flatnonzero((score >= least) & (score <= most))
                if len(fits) > 4 * keep:         # all that reach the last wanted score
                    edge = np.partition(score[fits], len(fits) - keep)[len(fits) - keep]
                    fits = fits[score[fits] >= edge]
                top = fits[np.lexsort((self.ids[rows[fits]], -score[fits]))[:keep]]
                best[k] = (rows[top], score[top])
        for bound, start, end in self.walk(a):
            if visited == due:
                settle()
                due *= 2
                if all(bound < least or (len(b[1]) == keep and b[1][-1] > bound) for (least, _), b in zip(windows, best)):
                    break
            open_cells.append((start, end))
            visited += 1
        settle()
        return [b if b is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for b in best], scored


def _searched(index: DataFrame, anchors: DataFrame, shards: int, width: int, books, find, schema: str) -> DataFrame:
    """``find(shard, anchor row) -> rows`` for each anchor (a_id, a_label, a_v, targets) on each shard."""
    none = F.lit(None).cast("array<struct<id:long,score:long>>")
    rows = index.select("shard", F.lit(0).alias("kind"), "id", "label", "v", none.alias("targets"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", "label", "v", "targets")
    both = rows.unionByName(asked).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches):
        have, parts, shard = None, [], None
        for (number, kind), part in slices(batches, ["shard", "kind"]):
            if number != have:
                have, parts, shard = number, [], None
            ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
            v = matrix(part.column("v"), width)
            if kind == 0:
                parts.append((ids, labels, v))
                continue
            if shard is None:
                parts = parts or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.int64))]
                shard = Shard(*[np.concatenate(x) for x in zip(*parts)], books)
                parts = []
            targets = part.column("targets").to_pylist()
            out = []
            for i in range(len(ids)):
                out += find(shard, int(ids[i]), int(labels[i]), v[i], targets[i])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
    names = [c.split()[0] for c in schema.split(", ")]
    return both.mapInArrow(lean(run), schema)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", label: Column | None = None,
                   every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = SCALE,
                   codes: int = CODES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides. An anchor's positives are its ``positives`` best other rows of the same
    label; for each, the ``negatives`` best rows of other labels with least * positive_score <= 100 * score <= most *
    positive_score are returned. Higher scores come first, ties by smaller id. ``label`` may replace the column ``label_col``.
    """
    rows = materialize(scaled(vectors, id_col, F.col(label_col) if label is None else label, vector_col, scale))
    size = rows.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width")).first()
    width, shards = max(2, size.width or 0), max(1, -(-size.rows // shard_rows))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toArrow().column("v").combine_chunks()
    points = matrix(sample, width).astype(np.float64)
    books = codebook(points[:, :width // 2], codes), codebook(points[:, width // 2:], codes)
    index = materialize(rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "label", "v"))
    anchors = rows.where(F.col("id") % every == 0)
    far = np.iinfo(np.int64)

    def same(shard, own, kind, v, _):
        (best,), _ = shard.search(v, (shard.labels == kind) & (shard.ids != own), [(far.min, far.max)], positives)
        return [(own, int(shard.ids[r]), s) for r, s in zip(*(x.tolist() for x in best))]

    def other(shard, own, kind, v, targets):
        windows = [(-(-least * t["score"] // 100), most * t["score"] // 100) for t in targets]
        best, _ = shard.search(v, shard.labels != kind, windows, negatives)
        return [(own, t["id"], t["score"], int(shard.ids[r]), s) for t, b in zip(targets, best) for r, s in zip(*(x.tolist() for x in b))]

    asked = anchors.withColumn("targets", F.lit(None).cast("array<struct<id:long,score:long>>"))
    near = _searched(index, asked, shards, width, books, same, "anchor_id long, id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    targets = materialize(near.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("targets")))
    # windows above no score, of negative ones, are empty
    targets = targets.select(F.col("anchor_id").alias("id"), F.filter("targets", lambda t: t["score"] >= 0).alias("targets")).where(F.size("targets") > 0)
    found = _searched(index, anchors.join(targets, "id"), shards, width, books, other,
                      "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
