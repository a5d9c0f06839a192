"""Hand-checked text, number and date cases."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from oreline.functions import dates as D
from oreline.functions import text as X
from oreline.operators import encode as E
from oreline.operators import profile as P
from oreline.operators import scale as S
from oreline.operators.quantiles import column_quantiles, grouped_quantiles


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expr, kind="string"):
    return [r[0] for r in column(spark, values, kind).orderBy("i").select(expr(F.col("v"))).collect()]


def test_parse_price(spark):
    assert apply(spark, ["₡1,234.56", "₡1.234,56", "$ 12", "..", "abc", None], X.parse_price) == [1234.56, 1.23456, 12.0, None, None, None]


def test_clean_text_collapses_unicode_space(spark):
    assert apply(spark, ["  a  \n b ", None], X.clean_text) == ["a b", None]


def test_weight(spark):
    assert apply(spark, ["Atún 85 G", "Saco 1,5 kg", "Pelota"], X.weight_number) == [85.0, 1.5, None]
    assert apply(spark, ["Atún 85 G", "Saco 1,5 kg", "Pelota"], X.weight_unit) == ["g", "kg", None]


def test_fixture_line(spark):
    out = X.parse_fixtures(column(spark, ["- Liga: A vs. B", "sin partido"]), "v").collect()
    assert [(r.competition, r.home, r.away) for r in out] == [(" Liga", " A ", " B")]


def test_largest_integer(spark):
    assert apply(spark, ["?page=2&ref=x", "/p/17", "none"], X.largest_integer) == [2, 17, None]


def test_price_range(spark):
    assert apply(spark, [4999.99, 5000.0, 24999.99, 25000.0, None], X.price_range, "double") == ["BAJO", "MEDIO", "MEDIO", "ALTO", None]


def test_replacement_syntax(spark):
    df = X.clean_columns(column(spark, ["ab-12"]), ["v", "missing"], [(r"(\w+)-(\d+)", r"\2$\1")])
    assert df.first().v == "12$ab"


def test_extract_groups_needs_all(spark):
    df = X.extract_groups(column(spark, ["k: 1 ", "k only", ""]), "v", {"a": r"^(\w)", "b": r":(.+)"})
    assert [(r.a, r.b) for r in df.collect()] == [("k", "1")]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([(0, "1,5", "a"), (1, "2", "b"), (2, "x", "1"), (3, "4", None)], "i int, n string, c string")
    out = E.coerce_numeric(df, exclude=("i",)).orderBy("i").collect()
    assert [r.n for r in out] == [1.5, 2.0, 2.0, 4.0]
    assert [r.c for r in out] == [1.0, 2.0, 0.0, -1.0]


def test_population_scaling_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, k double")
    out = S.standardize(df, ["x", "k"]).orderBy("x").collect()
    assert [round(r.x, 4) for r in out] == [-1.069, -0.2673, 1.3363]
    assert {r.k for r in out} == {0.0}
    assert {r.k for r in S.radar(df, ["x", "k"]).collect()} == {50.0}


def test_correlation_with_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, k double")
    cells = {(r.var1, r.var2): r["corr"] for r in P.correlation(df).collect()}
    assert cells["x", "k"] is None and abs(cells["x", "x"] - 1) < 1e-12


def test_quartiles(spark):
    row = P.describe(spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "x double")).first()
    assert (row.p25, row.p50, row.p75) == (1.75, 2.5, 3.25)


def test_bracketed_quantiles_equal_the_exact_ones(spark):
    df = spark.range(20000).select((F.pmod(F.xxhash64("id"), F.lit(9973)) / 7.0).alias("x"), (F.col("id") % 3).alias("g"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    exact = column_quantiles(df, ["x"], probs)["x"]
    narrowed = column_quantiles(df, ["x"], probs, limit=50)["x"]
    assert all(abs(a - b) < 1e-9 for a, b in zip(exact, narrowed))
    for row in grouped_quantiles(df, ["g"], "x", [0.25, 0.9]).collect():
        one = column_quantiles(df.where(F.col("g") == row.g), ["x"], [0.25, 0.9])["x"]
        assert abs(row.p1 - one[0]) < 1e-9 and abs(row.p2 - one[1]) < 1e-9


def test_day_first(spark):
    assert apply(spark, ["03/02/2024", "2024-02-03", "x"], D.parse_day_first) == [datetime.datetime(2024, 2, 3)] * 2 + [None]


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "i int, c string")
    assert [tuple(r) for r in E.one_hot(df).orderBy("i").collect()] == [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0)]


def test_pooling_matches_numpy(spark):
    image = np.arange(256, dtype=float).reshape(16, 16) % 37
    df = spark.createDataFrame([(image.ravel().tolist(),)], "p array<double>")
    for how, fn in (("mean", np.mean), ("max", np.max)):
        want = [fn(image[r:r + 4, c:c + 4]) for r in range(0, 16, 4) for c in range(0, 16, 4)]
        assert np.allclose(S.pool_image(df, "p", how=how).first().p, want)


def test_grouped_quantiles_narrow_large_groups(spark):
    """One group of nearly all rows with one far value, one of few, one with a null key, one without values."""
    rng = np.random.default_rng(4)
    hot = np.concatenate([rng.normal(size=3000), [1e300, -1e300], np.full(500, 0.25)])
    rows = [("hot", float(v)) for v in hot] + [("few", 1.0), ("few", 4.0), ("few", float("nan"))]
    rows += [(None, float(v)) for v in range(101)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    want = {"hot": np.quantile(hot, probs), "few": np.quantile([1.0, 4.0], probs), None: np.quantile(np.arange(101.0), probs)}
    for limit in (20, 100_000):
        got = {r.g: list(r)[1:] for r in grouped_quantiles(df, ["g"], "x", probs, limit).collect()}
        assert set(got) == set(want)
        for g, values in want.items():
            assert np.allclose(got[g], values, rtol=1e-12)
    assert grouped_quantiles(df.limit(0), ["g"], "x", [0.5]).isEmpty()
