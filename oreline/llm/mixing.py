"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source's documents stand in a shuffled order (a hash of id and seed) and may be repeated ``cap`` times. A copy
gets a virtual finish time: the words of its source up to and with this copy, divided by the source's target. All
copies are ordered by that time over the whole table and taken until the total budget is reached, so at any point
each source has received words in proportion to its target.

No order is sorted in one task. The order within a source is cut into 4,096 equal ranges of the hash, the order by
finish time into 4,096 equal ranges of time for each unit (a source sends words at an even rate, so both kinds of
ranges hold about equal shares, also of a source with a third of all rows); totals of earlier ranges are added.

Null text has size 0. Null is a source of its own and comes last. A source without words has target 0 and takes
nothing. Equal rows are separate documents. An empty table gives an empty result. Columns of the input that are not
named stay out of the plan, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
RANGES = 4096                                    # 16**3: three hexadecimal digits of the hash
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, cap: float = 3) -> DataFrame:
    """(source, source_size, longest, place, target) from (source, size): ``share`` of all words, dealt by weight.

    A target above ``cap`` times its source stops there and the excess goes to the others by weight: sources are
    ordered by cap / weight, and the level is the greatest one that does not exceed the source's own. The table has
    one row for each source.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("longest"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    table = table.withColumn("place", place)
    table = table.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights)))))
    table = table.withColumn("limit", F.col("source_size") * float(cap)).withColumn("level", F.col("limit") / F.col("weight"))
    order = Window.orderBy("level", "place")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = table.withColumn("reach", (F.sum("source_size").over(everything) * float(share) - (F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit")))
                             / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    fits = F.when(F.col("reach") <= F.col("level"), F.col("reach"))
    table = table.withColumn("water", F.max(fits).over(everything))
    target = F.least("limit", F.coalesce(F.col("water") * F.col("weight"), F.col("limit")))
    return table.select("source", "source_size", "longest", "place", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        share: float = 1.0, cap: int = 3, seed: str = "mix") -> DataFrame:
    """(id, row_hash, size, source, source_size, target, taken, copies) for every row of ``docs``.

    ``row_hash`` is a hash of all columns of the row, ``copies`` how often the mix takes it and ``taken`` its words
    over all copies.
    """
    everything = F.xxhash64(*[F.col(c) for c in docs.columns])
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), everything.alias("row_hash"))
    slim = slim.withColumn("hash", F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":" + seed))))
    slim = materialize(slim.withColumn("range", F.substring("hash", 1, 3)))
    table = materialize(targets(slim, weights, share, cap))
    rows = slim.join(table, slim["source"].eqNullSafe(table["source"])).drop(table["source"])

    ranges = rows.groupBy("place", "range").agg(F.sum("size").alias("in_range"))
    before = F.sum("in_range").over(Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_range")
    ranges = materialize(ranges.select("place", "range", before.alias("before")))
    shuffled = Window.partitionBy("place", "range").orderBy("hash", "id", "row_hash")
    rows = rows.join(ranges, ["place", "range"])
    rows = rows.withColumn("nth", F.row_number().over(shuffled)).withColumn("upto", F.col("before") + F.sum("size").over(shuffled.rowsBetween(Window.unboundedPreceding, 0)))

    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
    finish = F.when(F.col("target") > 0, (F.col("copy") * F.col("source_size") + F.col("upto")) / F.col("target")).otherwise(F.lit(0.0))
    totals = table.agg(F.sum("source_size").alias("words"), F.sum("longest").alias("longest")).first()
    budget = (totals["words"] or 0) * float(share)
    # at this time every source has sent its target and its longest document more, so the budget is spent: 2 at most for a
    # full share; later copies are never taken and are only spread over slots behind all others
    over = 1 + (totals["longest"] or 0) / max(budget, 1.0)
    behind = int(over * RANGES) + 1 + F.pmod(F.xxhash64("hash", "copy"), F.lit(RANGES))
    copies = copies.withColumn("finish", finish).withColumn("slot", F.when(F.col("finish") <= over, F.floor(F.col("finish") * RANGES)).otherwise(behind))
    copies = materialize(copies.select("id", "row_hash", "size", "source", "source_size", "target", "place", "range", "nth", "copy", "finish", "slot"))

    slots = copies.groupBy("slot").agg(F.sum("size").alias("in_slot"))             # a few times RANGES rows
    upto = F.sum("in_slot").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    slots = slots.withColumn("slot_upto", upto).select("slot", (F.col("slot_upto") - F.col("in_slot")).alias("slot_before"))
    queue = Window.partitionBy("slot").orderBy("finish", "place", "range", "nth", "copy").rowsBetween(Window.unboundedPreceding, 0)
    served = copies.withColumn("run", F.sum("size").over(queue)).join(F.broadcast(slots), "slot")
    taken = (F.col("slot_before") + F.col("run") <= F.lit(budget)) & (F.col("size") > 0)
    return (served.groupBy("place", "range", "nth").agg(
        *[F.first(c).alias(c) for c in ("id", "row_hash", "size", "source", "source_size", "target")],
        F.sum(taken.cast("long")).alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))
        .select("id", "row_hash", "size", "source", "source_size", "target", "taken", "copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does, with all their columns."""
    counts = mix(docs, **options).groupBy("row_hash").agg(F.sum("copies").alias("__copies")).where("__copies > 0")
    keyed = docs.withColumn("__row", F.xxhash64(*[F.col(c) for c in docs.columns]))
    counts = materialize(counts.withColumnRenamed("row_hash", "__row"))
    # equal rows are interchangeable: the first of them stands for all copies
    one = keyed.join(counts, "__row").dropDuplicates(["__row"])
    return one.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)
