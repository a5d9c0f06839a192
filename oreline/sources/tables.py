"""Parquet tables and the validity rule of an input table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require_nonempty(df: DataFrame, min_rows: int = 1, min_cols: int = 1) -> DataFrame:
    """Return ``df`` unchanged or raise when it has too few rows or columns."""
    if len(df.columns) < min_cols:
        raise ValueError(f"need at least {min_cols} columns, got {len(df.columns)}")
    if min_rows > 0 and df.select(F.lit(1)).limit(min_rows).count() < min_rows:
        raise ValueError(f"need at least {min_rows} rows")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean missing; keep only NULL."""
    return df.select(*[
        F.when(F.isnan(f.name), None).otherwise(F.col(f.name)).alias(f.name)
        if f.dataType.typeName() in ("double", "float") else F.col(f.name)
        for f in df.schema.fields])
