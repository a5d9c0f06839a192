"""Principal components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import pearson
from . import scale as S


@dataclass
class Components:
    columns: list[str]
    stats: object
    loadings: np.ndarray          # variables x components
    share: np.ndarray             # per cent of the variance
    scaled: bool

    def coordinates(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Add PC1, PC2, ... of each row; rows are centred (and scaled) with the learned statistics."""
        cells = []
        for k in range(self.loadings.shape[1]):
            total = F.lit(0.0)
            for j, c in enumerate(self.columns):
                spread = (self.stats[c]["std"] or 1.0) if self.scaled else 1.0
                total = total + (F.col(c) - self.stats[c]["mean"]) / spread * F.lit(float(self.loadings[j, k]))
            cells.append(total.alias(f"PC{k + 1}"))
        return df.select(*keep, *cells)

    def variance(self, spark) -> DataFrame:
        return spark.createDataFrame([(f"PC{k + 1}", float(v)) for k, v in enumerate(self.share)], "component string, share double")

    def correlations(self, df: DataFrame) -> DataFrame:
        """Correlation of each variable with each component: (variable, component, corr)."""
        names = [f"PC{k + 1}" for k in range(self.loadings.shape[1])]
        both = self.coordinates(df, self.columns)
        wide = both.agg(*[pearson(F.col(c), F.col(n)).alias(f"{i}_{k}") for i, c in enumerate(self.columns) for k, n in enumerate(names)])
        cells = [F.struct(F.lit(c).alias("variable"), F.lit(n).alias("component"), F.col(f"{i}_{k}").alias("corr"))
                 for i, c in enumerate(self.columns) for k, n in enumerate(names)]
        return wide.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")


def _signed(loadings: np.ndarray) -> np.ndarray:
    """Flip components so that the first of the largest loadings is positive."""
    loadings = loadings.copy()
    for k in range(loadings.shape[1]):
        size = np.abs(loadings[:, k])
        if loadings[np.argmax(size >= size.max() - 1e-9), k] < 0:
            loadings[:, k] *= -1
    return loadings


def principal_components(df: DataFrame, columns: list[str], n: int = 2, scale: bool = True) -> Components:
    """Components of the centred (and scaled) columns. Signs: the first of the largest loadings is positive."""
    stats = S.learn(df, columns, median=False)
    centred = df.select(*[((F.col(c) - stats[c]["mean"]) / ((stats[c]["std"] or 1.0) if scale else 1.0)).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=columns, outputCol="x").transform(centred)
    model = PCA(k=n, inputCol="x", outputCol="pc").fit(vectors)
    return Components(columns, stats, _signed(model.pc.toArray()), model.explainedVariance.toArray() * 100, scale)


@dataclass
class ArrayComponents:
    mean: list[float]
    loadings: np.ndarray
    share: np.ndarray

    def coordinates(self, df: DataFrame, x: str, keep: list[str]) -> DataFrame:
        """PC1, PC2, ... of each row, computed along the array."""
        mean = F.array(*[F.lit(v) for v in self.mean])
        centred = F.zip_with(F.col(x).cast("array<double>"), mean, lambda v, m: v - m)
        cells = []
        for k in range(self.loadings.shape[1]):
            weights = F.array(*[F.lit(float(v)) for v in self.loadings[:, k]])
            cells.append(F.aggregate(F.zip_with(centred, weights, lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v).alias(f"PC{k + 1}"))
        return df.select(*keep, *cells)


def array_components(df: DataFrame, x: str, n: int = 2) -> ArrayComponents:
    """Components of an array column as it is (centred, not scaled); wide arrays stay one column."""
    rows = df.select(F.posexplode(x).alias("i", "v")).groupBy("i").agg(F.avg(F.col("v").cast("double")).alias("m")).orderBy("i").collect()
    model = PCA(k=n, inputCol="_v", outputCol="pc").fit(df.select(array_to_vector(F.col(x).cast("array<double>")).alias("_v")))
    return ArrayComponents([r["m"] for r in rows], _signed(model.pc.toArray()), model.explainedVariance.toArray() * 100)
