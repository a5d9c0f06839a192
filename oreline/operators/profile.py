"""Table profiling: summaries, frequencies, correlations and the tables behind the usual plots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.numbers import pearson
from .quantiles import column_quantiles, present


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*numeric_names(df))


def _rows_per_column(one_row: DataFrame, columns: list[str], parts: list[str]) -> DataFrame:
    """Turn one wide row with a struct per column into (column, part, part, ...)."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(c)[p].alias(p) for p in parts])
                      for c in columns])
    return one_row.select(F.explode(items).alias("_s")).select("_s.*")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles (interpolated), max, nulls: one row per column."""
    columns = columns or numeric_names(df)
    parts = ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "nulls"]
    values = df.agg(*[F.struct(
        F.count(present(c)).alias("count"), F.avg(present(c)).alias("mean"), F.stddev_samp(present(c)).alias("std"),
        F.min(present(c)).alias("min"), F.max(present(c)).alias("max"), F.count_if(present(c).isNull()).alias("nulls"),
        F.approx_count_distinct(present(c)).alias("distinct")).alias(c) for c in columns]).first()
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], sizes={c: values[c]["distinct"] for c in columns})
    rows = [(c, *(values[c][p] for p in parts[:4]), *quartiles[c], values[c]["max"], values[c]["nulls"]) for c in columns]
    kinds = ["bigint"] + ["double"] * 7 + ["bigint"]
    return df.sparkSession.createDataFrame(rows, "column string, " + ", ".join(f"{p} {k}" for p, k in zip(parts, kinds)))


def overview(df: DataFrame) -> DataFrame:
    """One row per column: rows, type, nulls."""
    aggs = [F.struct(F.count(F.lit(1)).alias("rows"), F.lit(t).alias("type"),
                     F.count_if(F.col(c).isNull()).alias("nulls")).alias(c) for c, t in df.dtypes]
    return _rows_per_column(df.agg(*aggs), df.columns, ["rows", "type", "nulls"])


def correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pairwise complete Pearson coefficients as (var1, var2, corr), one aggregate for all pairs."""
    columns = columns or numeric_names(df)
    values = df.select(*[present(c).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = values.agg(*[pearson(F.col(a), F.col(b)).alias(f"_r{k}") for k, (a, b) in enumerate(pairs)])
    cells = []
    for k, (a, b) in enumerate(pairs):
        for u, v in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(u).alias("var1"), F.lit(v).alias("var2"), F.col(f"_r{k}").alias("corr")))
    return wide.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Frequency of each value, most frequent first (ties by value); missing values are left out."""
    counts = (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n")))
    ordered = counts.orderBy(F.desc("n"), column)
    return ordered.limit(n) if n else ordered


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every class."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(column, "n", share_of_total(counts, "n").alias("share"))


def share_of_total(counts: DataFrame, column: str):
    """Share of each row of a count table in the total, which is a one-row aggregate."""
    return F.col(column) / counts.agg(F.sum(column)).scalar()


def pivot_count(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Cross table of counts, absent combinations 0."""
    return df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0)


def histogram(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Equal-width bins over the common range of the columns: (column, bin, lo, hi, n).

    The range is one aggregate; rows are folded to at most ``bins`` counts per column map-side.
    """
    values = df.select(*[present(c).alias(c) for c in columns])
    ends = values.agg(F.least(*[F.min(c) for c in columns], F.lit(None)).alias("lo"),
                      F.greatest(*[F.max(c) for c in columns], F.lit(None)).alias("hi")).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n bigint")
    lo, hi = ends["lo"], ends["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    long = values.unpivot([], columns, "column", "x").where(F.col("x").isNotNull())
    cell = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = long.groupBy("column", cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("column", "bin", (F.lit(lo) + F.col("bin") * width).alias("lo"),
                         (F.lit(lo) + (F.col("bin") + 1) * width).alias("hi"), "n")


def boxplot(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Quartiles and whiskers (last data point within 1.5 interquartile ranges) per column."""
    columns = columns or numeric_names(df)
    limits = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    parts = ["lo", "p25", "p50", "p75", "hi", "outliers"]
    aggs = []
    for c in columns:
        x = present(c)
        q1, q2, q3 = limits[c]
        inside = _inside_whiskers(x, q1, q3)
        aggs.append(F.struct(
            F.min(F.when(inside, x)).alias("lo"), F.lit(q1).cast("double").alias("p25"),
            F.lit(q2).cast("double").alias("p50"), F.lit(q3).cast("double").alias("p75"),
            F.max(F.when(inside, x)).alias("hi"), F.count_if(~inside).alias("outliers")).alias(c))
    return _rows_per_column(df.agg(*aggs), columns, parts)


def _inside_whiskers(x, q1, q3):
    if q1 is None:
        return F.lit(None).cast("boolean")
    return x.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))


def outliers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The points outside the whiskers as (column, value)."""
    columns = columns or numeric_names(df)
    limits = column_quantiles(df, columns, [0.25, 0.75])
    keep = F.lit(False)
    for c in columns:
        keep = keep | ((F.col("column") == c) & ~_inside_whiskers(F.col("value"), *limits[c]))
    long = df.select(*[present(c).alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return long.where(keep)


def density(df: DataFrame, column: str, points: int = 200, resolution: int = 0) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth n^(-1/5) * sample std.

    Equal values are folded to counts first, and a value meets only the grid points within 39 bandwidths, beyond which
    the kernel is 0 in double precision, so the curve is exact. A caller who wants less work for a wide column may ask
    for an approximation: ``resolution`` cells to which the values are folded.
    """
    x = present(column)
    stats = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("s"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    schema = "x double, density double"
    if not stats["n"] or not stats["s"]:
        return df.sparkSession.createDataFrame([], schema)
    band = stats["s"] * stats["n"] ** -0.2
    span = stats["hi"] - stats["lo"]
    start, step = stats["lo"] - span / 2, 2 * span / (points - 1)
    values = df.where(x.isNotNull()).select(x.alias("v"))
    if resolution:
        cell = span / resolution
        values = values.select((F.lit(stats["lo"]) + (F.floor((F.col("v") - stats["lo"]) / cell) + 0.5) * cell).alias("v"))
    weighted = values.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    from ..functions.numbers import gaussian
    place = (F.col("v") - F.lit(start)) / F.lit(step)
    reach = 39 * band / step
    first = F.greatest(F.ceil(place - reach), F.lit(0)).cast("int")
    last = F.least(F.floor(place + reach), F.lit(points - 1)).cast("int")
    near = weighted.withColumn("i", F.explode(F.when(first <= last, F.sequence(first, last))))
    gx = F.lit(start) + F.col("i") * F.lit(step)
    sums = near.groupBy("i").agg((F.sum(F.col("w") * gaussian(gx - F.col("v"), F.lit(band))) / F.lit(float(stats["n"]))).alias("density"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    return grid.join(sums, "i", "left").select(gx.alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def visual_profile(df: DataFrame, columns: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables behind boxplot, density, histogram and correlation map."""
    columns = columns or numeric_names(df)
    curves = None
    for c in columns:
        one = density(df, c).select(F.lit(c).alias("column"), "x", "density")
        curves = one if curves is None else curves.unionByName(one)
    return {"boxplot": boxplot(df, columns), "density": curves,
            "histogram": histogram(df, columns), "correlation": correlation(df, columns)}
