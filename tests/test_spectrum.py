"""Spectra of long series against numpy's."""
import numpy as np
from pyspark.sql import functions as F

from oreline.operators import spectrum as S


def one_sided(x):
    power = np.abs(np.fft.rfft(x - x.mean())) ** 2 / len(x)
    power[1:(len(x) + 1) // 2] *= 2
    return power


def made(spark, sizes):
    frames = [spark.range(n).select(F.lit(name).alias("series_id"), F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("ts"),
                                    (F.sin(F.col("id") * 0.37) * 3 + F.cos(F.col("id") * F.col("id") * 0.001) + (F.col("id") % 7)).alias("value"))
              for name, n in sizes.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def check(spark, sizes):
    got = S.periodogram(made(spark, sizes)).toPandas()
    for name, n in sizes.items():
        part = got[got["series_id"] == name].sort_values("k")
        i = np.arange(n, dtype=float)
        wanted = one_sided(np.sin(i * 0.37) * 3 + np.cos(i * i * 0.001) + i % 7)
        assert np.array_equal(part["k"], np.arange(n // 2 + 1)) and np.allclose(part["freq"], np.arange(n // 2 + 1) / n)
        assert np.allclose(part["spec"], wanted, rtol=1e-6, atol=1e-6 * wanted.max())


def test_series_of_any_length_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(S, "SHORT", 100)
    check(spark, {"prime": 5003, "power": 4096, "odd": 1001, "even": 130, "short": 37})


def test_a_long_series(spark):
    check(spark, {"long": (1 << 17) + 29})


def test_shapes():
    for n in (2, 3, 100, 4096, 5003, 1 << 20):
        r, c = S.shape_of(n)
        assert r * c >= 2 * n - 1 and c in (r, 2 * r) and r * c < 4 * n
