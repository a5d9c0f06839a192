"""Periodogram of many series.

A series of up to ``SHORT`` points is one group. A longer one, of any length n, is a convolution with a chirp (Bluestein) of
length M = R * C, a power of two, and that is done by the four-step transform: the points are laid out as R residues times C
places; transforms along the places, a twiddle factor, then transforms along the residues. The product with the
transformed chirp stays inside the groups of the second step, and the way back takes the same steps. So a spectrum costs three
shuffles of M values in tiles, and a task holds ``TILE`` lines of about sqrt(M) values.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from .series import positions

SHORT = 1 << 16          # points of the longest series that is one group
TILE = 64                # lines of a long series in one group
_TILES = "series_id string, n bigint, across int, along int, re array<double>, im array<double>"


def _short_spectrum(pdf: pd.DataFrame) -> pd.DataFrame:
    x = pdf.sort_values("pos")["value"].to_numpy()
    n = len(x)
    power = np.abs(np.fft.rfft(x - x.mean())) ** 2 / n
    k = np.arange(len(power))
    power[1:(n + 1) // 2] *= 2
    return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "k": k, "freq": k / n, "spec": power})


def shape_of(n: int) -> tuple[int, int]:
    """(R, C): powers of two whose product holds the convolution of n points."""
    bits = max(2, (2 * n - 1 - 1).bit_length())
    return 1 << bits // 2, 1 << bits - bits // 2


def _turn(numerator: np.ndarray, denominator: int) -> np.ndarray:
    return np.exp(-2j * np.pi * (numerator % denominator) / denominator)


def _chirp(t: np.ndarray, n: int) -> np.ndarray:
    return _turn(t * t, 2 * n)


def _tiles(series, n, across: int, grids: list[np.ndarray], axis: int) -> pd.DataFrame:
    """A group's lines cut along ``axis``; the tiles of several grids lie one behind the other."""
    rows = []
    for along in range(-(-grids[0].shape[axis] // TILE)):
        part = np.concatenate([np.take(g, np.arange(along * TILE, min((along + 1) * TILE, g.shape[axis])), axis).ravel() for g in grids])
        rows.append((series, n, across, along, part.real, part.imag))
    return pd.DataFrame(rows, columns=["series_id", "n", "across", "along", "re", "im"])


def _assembled(pdf: pd.DataFrame, shape: tuple[int, int], axis: int, grids: int) -> list[np.ndarray]:
    """Tiles put together along ``axis``."""
    parts = []
    for re, im in pdf.sort_values("across")[["re", "im"]].itertuples(index=False):
        both = (np.asarray(re) + 1j * np.asarray(im)).reshape(grids, -1)
        parts.append([g.reshape((-1, shape[1]) if axis == 0 else (shape[0], -1)) for g in both])
    return [np.concatenate([p[i] for p in parts], axis=axis) for i in range(grids)]


def _residues(pdf: pd.DataFrame) -> pd.DataFrame:
    """Step one for residues of the places: points and chirp, transformed along the places."""
    series, n, across = pdf["series_id"].iloc[0], int(pdf["n"].iloc[0]), int(pdf["across"].iloc[0])
    r, c = shape_of(n)
    lines = np.arange(across * TILE, min((across + 1) * TILE, r))
    t = pdf["pos"].to_numpy() - 1
    points = np.zeros((len(lines), c), complex)
    points[t % r - lines[0], t // r] = (pdf["value"] - pdf["_mean"]).to_numpy() * _chirp(t, n)
    place = lines[:, None] + r * np.arange(c)[None, :]
    near = np.minimum(place, r * c - place)
    chirp = np.where(near < n, np.conj(_chirp(near, n)), 0)
    twiddle = _turn(lines[:, None] * np.arange(c)[None, :], r * c)
    return _tiles(series, n, across, [np.fft.fft(g, axis=1) * twiddle for g in (points, chirp)], 1)


def _middle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Step two for some frequencies modulo C: both transforms end here, their product is taken, and the way back begins."""
    series, n, own = pdf["series_id"].iloc[0], int(pdf["n"].iloc[0]), int(pdf["along"].iloc[0])
    r, c = shape_of(n)
    columns = np.arange(own * TILE, min((own + 1) * TILE, c))
    points, chirp = (np.fft.fft(g, axis=0) for g in _assembled(pdf, (r, len(columns)), 0, 2))
    twiddle = np.conj(_turn(np.arange(r)[:, None] * columns[None, :], r * c))
    return _tiles(series, n, own, [np.fft.ifft(points * chirp, axis=0) * twiddle], 0)


def _powers(pdf: pd.DataFrame) -> pd.DataFrame:
    """Step three for residues: squared values of the frequencies up to n / 2."""
    series, n, own = pdf["series_id"].iloc[0], int(pdf["n"].iloc[0]), int(pdf["along"].iloc[0])
    r, c = shape_of(n)
    lines = np.arange(own * TILE, min((own + 1) * TILE, r))
    (grid,) = _assembled(pdf, (len(lines), c), 1, 1)
    power = np.abs(np.fft.ifft(grid, axis=1)) ** 2
    k = lines[:, None] + r * np.arange(c)[None, :]
    keep = k <= n // 2
    return pd.DataFrame({"series_id": series, "n": n, "k": k[keep], "_p": power[keep]})


def periodogram(series: DataFrame) -> DataFrame:
    """One-sided density of the mean-removed series: (series_id, k, freq, spec)."""
    placed = positions(series)
    longest = placed.agg(F.max("n")).first()[0] or 0
    short = placed.where(F.col("n") <= SHORT).select("series_id", "pos", "value")
    out = short.groupBy("series_id").applyInPandas(
        _short_spectrum, "series_id string, k bigint, freq double, spec double")
    if longest <= SHORT:
        return out
    means = series.groupBy("series_id").agg(F.avg("value").alias("_mean"))
    long = placed.where(F.col("n") > SHORT).join(means, "series_id")
    # the shape of a series follows from its length alone: R is 2 to half the bits of 2 n - 2, see shape_of
    bits = F.length(F.bin(2 * F.col("n") - 2))
    residue = F.pmod(F.col("pos") - 1, F.pow(F.lit(2), F.floor(bits / 2)).cast("bigint"))
    first = long.withColumn("across", F.floor(residue / TILE).cast("int")).groupBy("series_id", "across").applyInPandas(_residues, _TILES)
    middle = first.groupBy("series_id", "along").applyInPandas(_middle, _TILES)
    power = middle.groupBy("series_id", "along").applyInPandas(_powers, "series_id string, n bigint, k bigint, _p double")
    doubled = F.when((F.col("k") == 0) | (F.col("k") * 2 == F.col("n")), 1.0).otherwise(2.0)
    return out.unionByName(power.select(
        "series_id", "k", (F.col("k") / F.col("n")).alias("freq"), (doubled * F.col("_p") / F.col("n")).alias("spec")))


def best_frequencies(spectrum: DataFrame, best: int = 3) -> DataFrame:
    """The strongest lines of each series, index 0 left out, with their periods 1/f."""
    order = W.partitionBy("series_id").orderBy(F.desc("spec"), "k")
    return (spectrum.where("k > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
            .select("series_id", "rank", "freq", (1 / F.col("freq")).alias("period"), "spec"))
