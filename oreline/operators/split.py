"""Train/test splits and folds by a hash of the row key: repeatable and independent of layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ranking import hash_order, time_order


def random_split(df: DataFrame, row_id: str, test_size: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``split``; exactly ceil(n * test_size) rows are test rows."""
    placed = hash_order(df, row_id, seed)
    return placed.withColumn("split", F.when(F.col("pos") <= F.ceil(F.col("n") * test_size), "test").otherwise("train")).drop("pos", "n")


def stratified_split(df: DataFrame, row_id: str, label: str, test_size: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``split``; every class gives round(share * class size) test rows."""
    placed = hash_order(df, row_id, seed, [label])
    return placed.withColumn("split", F.when(F.col("pos") <= F.round(F.col("n") * test_size), "test").otherwise("train")).drop("pos", "n")


def kfold(df: DataFrame, row_id: str, k: int = 10, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0 .. k-1, sizes differ by at most one."""
    return hash_order(df, row_id, seed, total=None).withColumn("fold", ((F.col("pos") - 1) % k).cast("int")).drop("pos")


def stratified_kfold(df: DataFrame, row_id: str, label: str, k: int = 10, seed: int = 42) -> tuple[DataFrame, int]:
    """Folds inside every class; returns the table and the number of folds used.

    A class with a single row falls back to plain folds; more folds than the smallest class
    has rows are reduced to its size.
    """
    smallest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0] or 0
    if smallest < 2:
        return kfold(df, row_id, k, seed), k
    k = min(k, smallest)
    placed = hash_order(df, row_id, seed, [label], total=None)
    return placed.withColumn("fold", ((F.col("pos") - 1) % k).cast("int")).drop("pos"), k


def time_folds(df: DataFrame, ts: str, k: int = 5, tie: list[str] | None = None) -> DataFrame:
    """Add ``fold`` for expanding windows: fold i (1..k) is tested on its rows and trained on
    all rows with a smaller fold; 0 is only trained on. The test size is n // (k + 1)."""
    placed = time_order(df, [], ts, tie)
    size = F.floor(F.col("n") / (k + 1))
    back = F.col("n") - F.col("pos")                                     # 0 for the last row
    return placed.withColumn("fold", F.greatest(F.lit(0), k - F.floor(back / size)).cast("int")).drop("pos", "n")
