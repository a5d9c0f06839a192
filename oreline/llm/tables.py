"""Small shared steps on DataFrames: slices of an order, membership filters, connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .arrays import lean

FILTER_BITS = 1 << 24                            # fixed: the filter has at most FILTER_BITS / 64 rows


def _slot(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))


def keep_likely(df: DataFrame, columns: list[str], ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids`` (same column order); no wanted row is lost.

    A bit table of fixed size (262,144 longs at most) is broadcast, so rows that cannot match are dropped
    before they are shuffled. Use it ahead of an exact join.
    """
    slot = _slot(*[F.col(c) for c in ids.columns])
    bits = (ids.select(F.shiftright(slot, 6).cast("int").alias("__word"), F.pmod(slot, F.lit(64)).cast("int").alias("__bit"))
            .groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits")))
    own = _slot(*[F.col(c) for c in columns])
    return (df.withColumn("__slot", own).withColumn("__word", F.shiftright("__slot", 6).cast("int"))
            .join(F.broadcast(bits), "__word")
            .where(F.expr("getbit(__bits, cast(pmod(__slot, 64) as int)) = 1")).select(*df.columns))


def _forest(batches):
    """Union-find over the edges (a, b) of one partition: (node, smallest node it is joined to) for all but the roots."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, root(x)) for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) of an edge table (a, b): every node with the smallest node reachable from it.

    Union-find over the cluster. Each partition first reduces its own edges to trees of depth one. As long as a node has
    two roots, or a root is elsewhere a child, a round hooks all neighbours of a node to the smallest of them, first the
    larger neighbours, then the smaller ones, and reduces again. Both halves of a round are aggregations with map-side
    combine and a join, so a hub node is never gathered in one task. Rounds are stored; their number grows with the
    logarithm of the longest chain.
    """
    def hooked(edges, up):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if up else edges
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = both.join(least, "a")
        if up:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        new = joined.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
        return new.where("a <> b").distinct()

    def reduced(edges):
        return materialize(edges.select("a", "b").mapInArrow(lean(_forest), "a long, b long"))

    edges = reduced(links.where("a <> b"))
    while True:
        named = (edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), "b"), F.struct(F.col("b").alias("node"), "b"))).alias("e"))
                 .groupBy("e.node").agg(F.min("e.b").alias("component"), F.max("e.b").alias("other")))
        if not named.where("component < other").take(1):
            return named.select("node", "component")
        edges = reduced(hooked(hooked(edges, True), False))
