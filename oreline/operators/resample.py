"""Class balancing. Class counts (one row per class) reach the driver, rows never do."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import hash32, uniform
from ..session import materialize
from .neighbors import nearest
from .ranking import hash_order

CLASS_LIMIT = 10_000


def class_counts(df: DataFrame, label: str) -> dict:
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(CLASS_LIMIT + 1).collect()
    if len(rows) > CLASS_LIMIT:
        raise ValueError(f"more than {CLASS_LIMIT} classes")
    return {r[label]: r["n"] for r in rows}


def _draws(spark, small: dict, top: int, label_type: str, seed: int) -> DataFrame:
    """Numbered draws (class, j, pick) that lift every class of ``small`` to ``top`` rows;
    ``pick`` is a position inside the class."""
    out = None
    for value, n in sorted(small.items()):
        one = spark.range(1, top - n + 1).select(
            F.lit(value).cast(label_type).alias("_y"), F.col("id").alias("_j"),
            (hash32(F.lit(value), F.col("id"), seed) % n + 1).alias("_pick"))
        out = one if out is None else out.unionByName(one)
    return out


def oversample(df: DataFrame, row_id: str, label: str, seed: int = 42) -> DataFrame:
    """Add random copies until every class has the size of the largest; ``copy`` is 0 for originals."""
    counts = class_counts(df, label)
    if len(counts) <= 1 or len(set(counts.values())) == 1:
        return df.withColumn("copy", F.lit(0).cast("bigint"))
    top = max(counts.values())
    draws = _draws(df.sparkSession, {v: c for v, c in counts.items() if c < top}, top, dict(df.dtypes)[label], seed)
    # only the growing classes take part; skewed picks of a tiny class are split by the adaptive join
    growing = df.where(F.col(label).isin(*[v for v, c in counts.items() if c < top]))
    placed = hash_order(growing, row_id, seed, [label], "_pos", None)
    copies = placed.join(draws, (F.col(label) == F.col("_y")) & (F.col("_pos") == F.col("_pick")))
    return df.withColumn("copy", F.lit(0).cast("bigint")).unionByName(
        copies.select(*df.columns, F.col("_j").alias("copy")))


def undersample(df: DataFrame, row_id: str, label: str, seed: int = 42) -> DataFrame:
    """Random rows of every class, as many as the smallest class has."""
    counts = class_counts(df, label)
    if len(counts) <= 1:
        return df
    placed = hash_order(df.where(F.col(label).isNotNull()), row_id, seed, [label], "_pos", None)
    return placed.where(F.col("_pos") <= min(counts.values())).drop("_pos")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * class size) as a column."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    pairs = [e for v, c in counts.items() for e in (F.lit(v), F.lit(n / (k * c)))]
    return df.withColumn(out, F.create_map(*pairs)[F.col(label)])


def smote(df: DataFrame, row_id: str, label: str, features: list[str], k: int = 4, seed: int = 42) -> DataFrame:
    """Synthetic rows on the segment between a row and one of its k nearest rows of the class.

    Missing values are filled with the column median first. Returns (features, label,
    ``source``, ``neighbour``, ``gap``); the last three are NULL for the original rows.
    Classes with a single row stay as they are.
    """
    from . import scale as S
    df = materialize(df.select(row_id, label, *features))
    stats = S.learn(df, features)
    filled = S.impute_median(df, features, stats).select(F.col(row_id).cast("bigint").alias("_id"), F.col(label), *features)
    counts = class_counts(df, label)
    top = max(counts.values())
    extra = [F.lit(None).cast("bigint").alias("source"), F.lit(None).cast("bigint").alias("neighbour"), F.lit(None).cast("double").alias("gap")]
    original = filled.select(*features, label, *extra)
    small = {v: c for v, c in counts.items() if 2 <= c < top}
    if not small:
        return original
    minority = materialize(filled.where(F.col(label).isin(*small)).withColumn("x", F.array(*[F.col(c).cast("double") for c in features])))
    points = minority.select(F.col("_id").alias("pid"), F.col(label).alias("grp"), "x")
    near = nearest(points.withColumnRenamed("pid", "qid"), points, k, same_rows=True)
    near = near.select(F.col("qid").alias("_id"), F.col("rank").alias("_rank"), F.col("pid").alias("neighbour"))
    draws = _draws(df.sparkSession, small, top, dict(df.dtypes)[label], seed)
    placed = hash_order(minority.select("_id", label), "_id", seed, [label], "_pos", None)
    sizes = F.create_map(*[e for v, c in small.items() for e in (F.lit(v), F.lit(min(k, c - 1)))])
    chosen = (draws.join(placed, (F.col(label) == F.col("_y")) & (F.col("_pos") == F.col("_pick")))
              .withColumn("_rank", (hash32(F.col("_y"), F.col("_j"), seed, "n") % sizes[F.col("_y")] + 1).cast("int"))
              .withColumn("gap", uniform(F.col("_y"), F.col("_j"), seed, "g")))
    a = minority.select("_id", F.col("x").alias("_a"))
    b = minority.select(F.col("_id").alias("neighbour"), F.col("x").alias("_b"))
    made = chosen.join(near, ["_id", "_rank"]).join(a, "_id").join(b, "neighbour")
    mixed = F.zip_with("_a", "_b", lambda u, v: F.struct(u.alias("u"), v.alias("v")))
    cells = [(mixed[i]["u"] + F.col("gap") * (mixed[i]["v"] - mixed[i]["u"])).alias(c) for i, c in enumerate(features)]
    synthetic = made.select(*cells, F.col("_y").alias(label), F.col("_id").alias("source"), "neighbour", "gap")
    return original.select(*[F.col(c).cast("double").alias(c) for c in features], label, "source", "neighbour", "gap").unionByName(synthetic)
