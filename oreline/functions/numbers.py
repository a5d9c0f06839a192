"""Numeric column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def bipolar_sigmoid(x: Column) -> Column:
    """2 / (1 + e^-x) - 1."""
    return F.tanh(x / 2)


def weighted_sum(x: Column, weights, bias: float = 0.0) -> Column:
    """Dot product of an array column with weights, plus the bias."""
    w = weights if isinstance(weights, Column) else F.array(*[F.lit(float(v)) for v in weights])
    products = F.zip_with(x, w, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(float(bias)), lambda s, v: s + v)


def squared_distance(x: Column, centre) -> Column:
    """Squared Euclidean distance between an array column and a point."""
    c = centre if isinstance(centre, Column) else F.array(*[F.lit(float(v)) for v in centre])
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def pearson(x: Column, y: Column) -> Column:
    """Pearson coefficient over rows with both values; NULL when one side is constant."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def gaussian(distance: Column, bandwidth: Column) -> Column:
    z = distance / bandwidth
    return F.exp(-z * z / 2) / (bandwidth * math.sqrt(2 * math.pi))
