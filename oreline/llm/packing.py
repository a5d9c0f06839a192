"""Best-fit packing planned on the histogram of lengths.

Documents become token pieces of at most ``capacity`` ids. Only the number of pieces of each length (``capacity``
rows at most) goes to the driver, which plans best fit over those counts, longest first: bins with the same space
left are one entry with a count. A piece's slot then follows from its rank within its length, found without ever
ranking a length in one task, so a length with most of the rows does no harm. The plan has at most about
``30 * capacity`` entries for any number of documents: a bin that takes pieces is left with less than half its space,
so it takes part in at most log2(capacity) steps.

Null text counts as empty: one piece with the end id alone. Repeated rows are packed each on its own; extra columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from . import pretokens as P
from .arrays import blocks, lean, strings

CAPACITY, END_ID = 1024, 2
TEXT_BLOCK = 1 << 20                             # a worker's arrays stay small beside the executor's heap
RANGES = 1024


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, in pieces.

    A document of more than ``capacity`` ids is cut; its first piece takes what is left over. ``tokenizer`` is a path
    every worker can read.
    """
    path = tokenizer or P.tokenizer_path("byte_bpe_50k.json")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        store = P.pieces(path)
        for batch in batches:
            for row, texts in blocks(strings(batch.column(1)), TEXT_BLOCK):
                codes, starts, at, _ = P.split(texts)
                ids, first = store.ids(store.numbers(P.hashes(codes, starts), codes, starts))
                ids = ids.astype("<u4", copy=False)
                bounds = first[at]
                size = np.diff(bounds) + 1
                number = -(-size // capacity)
                rest = size - (number - 1) * capacity
                doc = np.repeat(np.arange(len(texts)), number)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = np.where(nth == 0, 0, rest[doc] + (nth - 1) * capacity)
                length = np.where(nth == 0, rest[doc], capacity)
                raw = memoryview(ids).cast("B")
                begin = (bounds[doc] + start) * 4
                last = nth == number[doc] - 1
                stop = begin + (length - last) * 4
                crc = [zlib.crc32(end, zlib.crc32(raw[b:s])) if z else zlib.crc32(raw[b:s])
                       for b, s, z in zip(begin.tolist(), stop.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)).take(pa.array(doc)), pa.array(nth.astype(np.int32)), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(lean(run), "doc_id long, piece int, start long, length long, ids_crc32 long"))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: entries (length, first rank, first bin, pieces a bin, offset in the bin).

    Ranks of a length from ``first rank`` on fill the bins from ``first bin`` on, ``pieces a bin`` each.
    """
    out, bins, spaces, open_bins = [], {}, [], 0     # bins: space left -> runs [first bin, number of bins]
    def put(space, first, number):
        if number and space:
            if space not in bins:
                bins[space] = []
                insort(spaces, space)
            bins[space].append((first, number))
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(spaces, length)
            if k < len(spaces):
                space = spaces[k]
                first, number = bins[space].pop()
                if not bins[space]:
                    del bins[space], spaces[k]
            else:
                space, first = capacity, open_bins
                number = -(-left // (capacity // length))
                open_bins += number
            each = space // length
            full = min(number, left // each)
            out.append((length, rank, first, each, capacity - space))
            rank, left = rank + full * each, left - full * each
            put(space - each * length, first, full)
            if full < number and left:               # the last bin of the length takes fewer
                rank_here, left, some = rank, 0, left
                out.append((length, rank_here, first + full, some, capacity - space))
                put(space - some * length, first + full, 1)
                put(space, first + full + 1, number - full - 1)
            else:
                put(space, first + full, number - full)
    return out


def packed(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with doc_id, piece, start, length, ids_crc32) and their sequence_id and offset."""
    spark = parts.sparkSession
    parts = materialize(parts.withColumn("range", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(RANGES)).cast("int")))
    counts = materialize(parts.groupBy("length", "range").agg(F.count("*").alias("rows")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("rows").alias("n")).collect()}     # capacity rows at most
    steps = {}
    for length, rank, first, each, offset in plan(histogram, capacity):
        steps.setdefault(length, []).append((rank, first, each, offset))
    slots = spark.createDataFrame([(k, v) for k, v in steps.items()],
                                  "length long, steps array<struct<rank: long, first: long, each: long, offset: long>>")
    before = F.sum("rows").over(Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
    counts = counts.select("length", "range", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "range").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = parts.withColumn("nth", within).join(counts, ["length", "range"]).withColumn("rank", F.col("before") + F.col("nth") - 1)
    placed = ranked.join(F.broadcast(slots), "length")     # the plan is bounded by the capacity
    step = F.expr("element_at(steps, size(filter(steps, s -> s.rank <= rank)))")
    placed = placed.withColumn("step", step).withColumn("k", F.col("rank") - F.col("step.rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("step.first") + F.floor(F.col("k") / F.col("step.each"))).alias("sequence_id"),
                         (F.col("step.offset") + F.pmod("k", F.col("step.each")) * F.col("length")).alias("offset"))


def pack(docs: DataFrame, **options) -> DataFrame:
    return packed(pieces(docs, **options), options.get("capacity", CAPACITY))
