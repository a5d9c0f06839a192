"""CSV dialects: separator, decimal comma, named index column."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
             decimal: str = ".", index_col: str | int | None = None, header: bool = True) -> DataFrame:
    """Read a CSV with a header; a missing path or malformed row raises.

    With a schema nothing is sampled; without one the types are inferred from all rows. Decimal-comma numbers are read as
    text and converted (without a schema: text columns all of whose values are such numbers). ``index_col``, a name or a
    position, becomes the first column.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = (spark.read.option("header", header).option("sep", sep).option("mode", "FAILFAST")
              .option("multiLine", False))
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if decimal != "." and texts:
            number = rf"^\s*[+-]?(\d+({re.escape(decimal)}\d*)?|{re.escape(decimal)}\d+)([eE][+-]?\d+)?\s*$"
            fits = df.agg(*[(F.bool_and(F.col(c).isNull() | F.col(c).rlike(number)) & (F.count(c) > 0)).alias(c) for c in texts]).first()
            df = df.withColumns({c: F.replace(F.trim(c), F.lit(decimal), F.lit(".")).cast("double") for c in texts if fits[c]})
    elif decimal == ".":
        df = reader.schema(schema).csv(path)
    else:
        numeric = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
        text = T.StructType([T.StructField(f.name, T.StringType() if f.name in numeric else f.dataType)
                             for f in schema.fields])
        df = reader.schema(text).csv(path)
        df = df.withColumns({c: F.replace(F.col(c), F.lit(decimal), F.lit(".")).cast(t) for c, t in numeric.items()})
    if isinstance(index_col, int):
        index_col = df.columns[index_col]
    if index_col is not None:
        df = df.select(index_col, *[c for c in df.columns if c != index_col])
    return df


def write_csv(df: DataFrame, path: str, sep: str = ",", decimal: str = ".", index: str | None = None,
              mode: str = "errorifexists") -> str:
    """Write a folder of CSV parts with headers and return its path.

    ``index`` names a column to put first; without it that column is not written specially.
    """
    if index is not None:
        df = df.select(index, *[c for c in df.columns if c != index])
    if decimal != ".":
        df = df.withColumns({f.name: F.replace(F.col(f.name).cast("string"), F.lit("."), F.lit(decimal))
                             for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))})
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path
