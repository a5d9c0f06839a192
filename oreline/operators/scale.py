"""Scaling and imputation; statistics come from one aggregate and enter as literals."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from .quantiles import column_quantiles, present


@dataclass
class Statistics:
    """Per-column numbers learned on one table and applied to others."""
    values: dict[str, dict[str, float]] = field(default_factory=dict)

    def __getitem__(self, column):
        return self.values[column]


def learn(df: DataFrame, columns: list[str], median: bool = True) -> Statistics:
    """Mean, population std, min, max, missing rows and (optionally) median of each column."""
    parts = {c: [F.avg(present(c)).alias("mean"), F.stddev_pop(present(c)).alias("std"), F.min(present(c)).alias("min"),
                 F.max(present(c)).alias("max"), F.count_if(present(c).isNull()).alias("missing")] for c in columns}
    if median:
        for c in columns:
            parts[c].append(F.approx_count_distinct(present(c)).alias("distinct"))
    row = df.agg(*[F.struct(*parts[c]).alias(c) for c in columns]).first()
    stats = {c: {k: (0.0 if v is None else v) for k, v in row[c].asDict().items()} for c in columns}
    if median:
        sizes = {c: stats[c].pop("distinct") for c in columns}
        for c, q in column_quantiles(df, columns, [0.5], sizes=sizes).items():
            stats[c]["median"] = q[0] or 0.0
    return Statistics(stats)


def standardize(df: DataFrame, columns: list[str], stats: Statistics | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    stats = stats or learn(df, columns, median=False)
    return df.withColumns({c: (F.col(c) - stats[c]["mean"]) / (stats[c]["std"] or 1.0) for c in columns})


def impute_median(df: DataFrame, columns: list[str], stats: Statistics) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                         F.lit(float(stats[c]["median"]))) for c in columns})


def min_max(df: DataFrame, columns: list[str], stats: Statistics | None = None) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    stats = stats or learn(df, columns, median=False)
    return df.withColumns({c: (F.col(c) - stats[c]["min"]) / ((stats[c]["max"] - stats[c]["min"]) or 1.0)
                           for c in columns})


def min_max_inverse(df: DataFrame, columns: list[str], stats: Statistics) -> DataFrame:
    return df.withColumns({c: F.col(c) * ((stats[c]["max"] - stats[c]["min"]) or 1.0) + stats[c]["min"]
                           for c in columns})


def max_abs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Divide each column by its largest absolute value (bars of centroid tables)."""
    top = df.agg(*[F.max(F.abs(c)).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c) / float(top[c] or 1.0) for c in columns})


def radar(df: DataFrame, columns: list[str]) -> DataFrame:
    """Min-max to 0..100 per column; a constant column shows 50."""
    stats = learn(df, columns, median=False)
    out = {}
    for c in columns:
        span = stats[c]["max"] - stats[c]["min"]
        out[c] = (F.col(c) - stats[c]["min"]) / span * 100 if span else F.lit(50.0)
    return df.withColumns(out)


def label_index(df: DataFrame, column: str, out: str = "label", limit: int = 10_000) -> tuple[DataFrame, list]:
    """Classes to 0..k-1 in sorted order; returns the table and the class list."""
    classes = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect())
    if len(classes) > limit:
        raise ValueError(f"more than {limit} classes")
    code = F.array_position(F.array(*[F.lit(v) for v in classes]), F.col(column)) - 1
    return df.withColumn(out, code.cast("int")), classes


def index_label(df: DataFrame, column: str, classes: list, out: str) -> DataFrame:
    """Back from 0..k-1 to the classes."""
    return df.withColumn(out, F.element_at(F.array(*[F.lit(v) for v in classes]), (F.col(column) + 1).cast("int")))


def pool_image(df: DataFrame, pixels: str, side: int = 16, block: int = 4, how: str = "mean") -> DataFrame:
    """Mean or max pooling of a flattened square image, block by block.

    The blocks of one image are cut out of its own array, so no row is shuffled.
    """
    per_side = side // block
    cells = []
    for r in range(per_side):
        for c in range(per_side):
            rows = [F.slice(pixels, (r * block + i) * side + c * block + 1, block) for i in range(block)]
            cell = F.concat(*rows)
            if how == "max":
                cells.append(F.array_max(cell).cast("double"))
            else:
                total = F.aggregate(cell, F.lit(0.0), lambda s, v: s + v.cast("double"))
                cells.append(total / float(block * block))
    return df.withColumn(pixels, F.array(*cells))
