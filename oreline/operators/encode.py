"""Numeric encoding of mixed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..functions.text import to_number
from ..session import materialize, shuffle_width
from .profile import categorical_names
from .quantiles import column_quantiles


def one_hot(df: DataFrame, columns: list[str] | None = None, limit: int = 2000) -> DataFrame:
    """Replace each categorical column by 0/1 columns ``column_value`` (values sorted).

    NULL gives zeros everywhere. Every value becomes a column, so the number of values is
    checked; use ``codes`` for wider domains.
    """
    columns = columns or categorical_names(df)
    if not columns:
        return df
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    found = (texts.unpivot([], columns, "column", "value").where(F.col("value").isNotNull())
             .distinct().limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"more than {limit} distinct values: use codes() instead")
    keep = [F.col(c) for c in df.columns if c not in columns]
    flags = [F.when(F.col(c).cast("string") == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}")
             for c in columns for v in sorted(r["value"] for r in found if r["column"] == c)]
    return df.select(*keep, *flags)


def code_table(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values with their 0-based position in sorted order: (value, code).

    Values are range-partitioned, numbered per partition and shifted by the sizes of the
    partitions before, so a wide domain never meets in one task.
    """
    distinct = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    ranged = materialize(distinct.repartitionByRange(shuffle_width(df.sparkSession), "value")
                         .withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_part"))
                                    - F.col("_n")).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy("value"))
    return (ranged.withColumn("_rn", inside).join(before, "_part")
            .select("value", (F.col("_before") + F.col("_rn") - 1).cast("int").alias("code")))


def codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by its category code; NULL becomes -1.

    The join is an outer join on the value; adaptive execution broadcasts the small code
    tables and splits skewed values otherwise.
    """
    out = df
    for c in columns:
        lookup = materialize(code_table(df, c)).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        out = out.join(lookup, out[c] == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    return out.select(*[F.coalesce(F.col(f"_c_{c}"), F.lit(-1)).alias(c) if c in columns else F.col(c)
                        for c in df.columns])


def coerce_numeric(df: DataFrame, exclude: tuple = (), threshold: float = 0.5) -> DataFrame:
    """Make every column numeric.

    A column of which more than ``threshold`` of the rows read as numbers (decimal comma
    allowed) keeps its numbers and fills the rest with the median; any other column becomes
    category codes. One aggregate decides for all columns.
    """
    names = [c for c in df.columns if c not in exclude]
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def number(c):
        if isinstance(kinds[c], T.NumericType):
            x = F.col(c).cast("double")
            return F.when(F.isnan(x), None).otherwise(x)
        if isinstance(kinds[c], T.StringType):
            return to_number(F.replace(F.col(c), F.lit(","), F.lit(".")))
        return F.lit(None).cast("double")

    rates = df.agg(*[F.try_divide(F.count(number(c)), F.count(F.lit(1))).alias(c) for c in names]).first()
    as_number = [c for c in names if (rates[c] or 0) > threshold]
    as_code = [c for c in names if c not in as_number]
    medians = column_quantiles(df.select(*[number(c).alias(c) for c in as_number]), as_number, [0.5])
    filled = {c: F.coalesce(number(c), F.lit(float(medians[c][0] or 0.0))) for c in as_number}
    out = df.withColumns(filled) if filled else df
    out = codes(out, as_code) if as_code else out
    return out.select(*[F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in df.columns])
