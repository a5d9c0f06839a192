"""Time series from CSV files or from event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import parse_day_first
from ..functions.text import to_number
from .csv import read_csv


def checked_series(df: DataFrame, series: str | None, ts: str, value: str) -> DataFrame:
    """To ``(series_id, ts, value)``; a missing date raises, a bad value becomes NULL."""
    kinds = dict(df.dtypes)
    date = parse_day_first(F.col(ts)) if kinds[ts] == "string" else F.col(ts).cast("timestamp_ntz")
    number = to_number(F.col(value)) if kinds[value] == "string" else F.col(value).cast("double")
    out = df.select((F.col(series) if series else F.lit("series")).cast("string").alias("series_id"),
                    date.alias("ts"), F.nanvl(number, F.lit(None).cast("double")).alias("value"))
    bad = out.agg(F.count_if(F.col("ts").isNull())).first()[0]
    if bad:
        raise ValueError(f"{bad} rows without a readable date")
    return out


def read_series(spark: SparkSession, path: str, schema: str | None = None, date_col: str = "fecha",
                value_col: str | None = None, series_col: str | None = None, **dialect) -> DataFrame:
    """A CSV of day-first dates; the value defaults to the first column that is not the date."""
    df = read_csv(spark, path, schema, **dialect)
    if value_col is None:
        value_col = [c for c in df.columns if c not in (date_col, series_col)][0]
    return checked_series(df, series_col, date_col, value_col)


def totals(df: DataFrame, series: str, ts: str, value: str, unit: str = "day") -> DataFrame:
    """Sum of a value per series and calendar unit."""
    return (df.groupBy(F.col(series).cast("string").alias("series_id"),
                       F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("ts"))
            .agg(F.sum(F.col(value).cast("double")).alias("value")))
