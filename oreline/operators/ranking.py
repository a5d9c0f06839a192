"""Positions inside groups without ever sorting one group in one task.

A window over ``PARTITION BY group`` sorts a hot group in a single task. Here each group is
first cut into buckets that respect the order; rows are numbered inside (group, bucket) and
the row counts of the earlier buckets are added. Totals per bucket are a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.dates import epoch_seconds
from ..functions.hashing import HASH_RANGE, hash32
from ..session import shuffle_width

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def number_rows(df: DataFrame, keys: list[str], bucket: Column, order: list,
                out: str = "pos", total: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group.

    ``bucket`` must be non-decreasing along ``order``. ``total`` names an optional column
    with the number of rows of the group.
    """
    tagged = df.withColumn("_bkt", bucket)
    by_bucket = W.partitionBy(*keys, "_bkt").orderBy(*order)
    counts = tagged.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    along = W.partitionBy(*keys).orderBy("_bkt") if keys else W.partitionBy(F.lit(0)).orderBy("_bkt")
    whole = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    offsets = counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bkt").alias("_obkt"),
        (F.sum("_cnt").over(along) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(whole).alias("_tot"))
    left = tagged.withColumn("_rn", F.row_number().over(by_bucket))
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = left.join(offsets, [*cond, F.col("_bkt").eqNullSafe(F.col("_obkt"))], "inner")
    cols = [F.col(c) for c in df.columns]
    cols.append((F.col("_off") + F.col("_rn")).cast("bigint").alias(out))
    if total:
        cols.append(F.col("_tot").cast("bigint").alias(total))
    return joined.select(*cols)


def hash_order(df: DataFrame, row_id: str, seed: int = 42, strata: list[str] | None = None,
               out: str = "pos", total: str | None = "n") -> DataFrame:
    """Position of each row in a pseudo-random order, overall or inside each stratum."""
    buckets = 4 * shuffle_width(df.sparkSession)
    h = df.withColumn("_h", hash32(F.col(row_id), seed))
    cell = F.floor(F.col("_h") * buckets / F.lit(HASH_RANGE))
    return number_rows(h, list(strata or []), cell, ["_h", row_id], out, total).drop("_h")


def even_cells(df: DataFrame, value: Column, cells: int) -> Column:
    """Number of the cell of ``value`` when ``df`` is cut into cells of about equal row counts.

    The cut points are approximate quantiles (one mergeable sketch), so one far value does not put all other rows into
    one cell; the number is found by a binary search in the plan.
    """
    cells = max(1, min(cells, 256))
    cuts = df.agg(F.percentile_approx(value, [i / cells for i in range(1, cells)] or [0.5], 20 * cells)).first()[0] or []
    cuts = sorted(set(cuts))

    def search(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(float(cuts[mid])), search(lo, mid)).otherwise(search(mid + 1, hi))
    return search(0, len(cuts))


def time_order(df: DataFrame, keys: list[str], ts: str, tie: list[str] | None = None,
               out: str = "pos", total: str | None = "n") -> DataFrame:
    """Chronological position of each row inside its series.

    Series are cut into slices of time that hold about equal numbers of rows.
    """
    seconds = epoch_seconds(F.col(ts)) if dict(df.dtypes)[ts] not in _NUMERIC else F.col(ts).cast("double")
    cell = even_cells(df, seconds, 4 * shuffle_width(df.sparkSession))
    return number_rows(df, keys, cell, [ts, *(tie or [])], out, total)


def lagged(df: DataFrame, keys: list[str], pos: str, columns: dict[str, tuple[str, int]],
           chunk: int = 1 << 20) -> DataFrame:
    """Add lags by position: ``columns`` maps a new name to (source column, lag).

    Each series is cut in chunks of ``chunk`` positions; the last rows of a chunk travel to
    the next one as context, so no task sees more than one chunk.
    """
    deepest = max(lag for _, lag in columns.values())
    own = F.floor((F.col(pos) - 1) / chunk)
    end = F.floor((F.col(pos) - 1 + deepest) / chunk)
    spread = (df.withColumn("_own", own)
              .withColumn("_chunk", F.explode(F.sequence(own, end))))
    along = W.partitionBy(*keys, "_chunk").orderBy(pos)
    added = {name: F.lag(src, lag).over(along) if lag else F.col(src)
             for name, (src, lag) in columns.items()}
    return (spread.withColumns(added).where(F.col("_chunk") == F.col("_own"))
            .drop("_own", "_chunk"))
