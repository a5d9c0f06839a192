"""Cases that used to give wrong answers."""
import datetime as dt
import math

from pyspark.sql import functions as F

from oreline.functions import text as T
from oreline.operators import arima, basket, neighbors, profile, series, smoothing
from oreline.operators.ranking import even_cells


def test_a_copied_row_votes_once_for_each_copy(spark):
    near = spark.createDataFrame([(1, 10, 1), (1, 10, 2), (1, 11, 3)], "qid long, pid long, rank int")
    labels = spark.createDataFrame([(10, 0.0), (10, 0.0), (11, 1.0)], "pid long, label double")
    assert neighbors.vote(near, labels).first().prediction == 0.0
    # two of class 0 and one row of class 1 that stands three times in the training table
    near = spark.createDataFrame([(1, 10, 1), (1, 12, 2), (1, 11, 3)], "qid long, pid long, rank int")
    labels = spark.createDataFrame([(10, 0.0), (12, 0.0), (11, 1.0), (11, 1.0), (11, 1.0)], "pid long, label double")
    assert neighbors.vote(near, labels).first().prediction == 0.0


def test_calibration_does_not_depend_on_the_scale(spark):
    day = dt.datetime(2024, 1, 1)
    values = [10 + i % 7 + 0.3 * i + (i * 37 % 11) / 5 for i in range(42)]
    best = []
    for scale in (1.0, 1e-5):
        rows = [("a", day + dt.timedelta(days=i), v * scale) for i, v in enumerate(values)]
        train, test = (spark.createDataFrame(x, "series_id string, ts timestamp_ntz, value double") for x in (rows[:35], rows[35:]))
        r = smoothing.calibrate(train, test, 0.25).first()
        best.append((r.alpha, r.beta, r.gamma))
    assert best[0] == best[1]


def test_nan_is_missing(spark):
    d = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (float("nan"), 1.0), (None, 2.0)], "x double, y double")
    r = {(c.var1, c.var2): c["corr"] for c in profile.correlation(d).collect()}
    assert not math.isnan(r["x", "y"]) and r["x", "y"] > 0.9
    bins = profile.histogram(d, ["x"], 2).collect()
    assert sum(b.n for b in bins) == 3 and all(not math.isnan(b.lo) for b in bins)
    assert profile.outliers(d, ["x"]).count() == 0
    assert not any(math.isnan(p.density) for p in profile.density(d, "x", 10).collect())


def test_python_patterns(spark):
    d = spark.createDataFrame([("Atún 85",)], "s string")
    assert T.extract_groups(d, "s", {"w": r"(?P<k>\w+)"}).first()["w"] == "Atún"
    assert d.select(T.substitute(F.col("s"), [(r"(?P<a>\w+) (\d+)", r"\2 \g<a>")]).alias("s")).first().s == "85 Atún"


def test_cells_hold_even_shares(spark):
    d = spark.range(20_000).select((F.col("id") + 1_000_000).cast("double").alias("t")).unionByName(spark.createDataFrame([(-1e9,)], "t double"))
    sizes = [r["count"] for r in d.groupBy(even_cells(d, F.col("t"), 32).alias("c")).count().collect()]
    assert len(sizes) == 32 and max(sizes) <= 2 * 20_001 / 32


def test_short_series_keep_their_rows(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("long", day + dt.timedelta(days=i), float(i % 7)) for i in range(30)] + [("short", day + dt.timedelta(days=i), 1.0) for i in range(3)]
    s = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")
    got = smoothing.smooth_forecast(s, 2, 0.5, 0.1, 0.1, 7).collect()
    assert sorted((r.series_id, r.yhat is None) for r in got) == [("long", False)] * 2 + [("short", True)] * 2


def test_lag_bound_is_each_series_own(spark):
    day = dt.datetime(2020, 1, 1)
    rng = lambda i: ((i * 7919) % 1009) / 1009 - 0.5
    one = [("a", day + dt.timedelta(days=i), sum(rng(j) for j in range(i)) * 0.2 + i * 0.01) for i in range(60)]
    two = [("b", day + dt.timedelta(days=i), rng(i * 3)) for i in range(400)]
    make = lambda rows: spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")
    alone = {r.series_id: r.d for rows in (one, two) for r in arima.difference_order(make(rows)).collect()}
    assert {r.series_id: r.d for r in arima.difference_order(make(one + two)).collect()} == alone


def test_fill_with_one_far_date(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("a", dt.datetime(1900, 1, 1), 5.0)] + [("a", day + dt.timedelta(days=i), None if i % 3 else float(i)) for i in range(1, 50)]
    got = series.fill_missing(spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")).orderBy("ts").collect()
    last, wanted = None, []
    for _, _, v in rows:
        last = v if v is not None else last
        wanted.append(last)
    assert [r.value for r in got] == wanted


def test_extreme_weights_end(spark):
    items = spark.createDataFrame([("a", 1e12), ("b", 1.0), ("c", 1.0)], "item string, w double")
    groups = spark.range(40).select("id", F.lit(3).alias("k"))
    rows = basket.weighted_sample(groups, "id", "k", items, "item", "w").collect()
    by = {}
    for r in rows:
        by.setdefault(r["id"], {})[r["pick"]] = r["item"]
    assert len(by) == 40 and all(set(v) == {1, 2, 3} and set(v.values()) == {"a", "b", "c"} and v[1] == "a" for v in by.values())
    assert {v[2] for v in by.values()} == {"b", "c"}


def test_decimal_comma_without_a_schema(spark, tmp_path):
    from oreline.sources import csv, series as files
    (tmp_path / "a.csv").write_text("fecha;valor;texto;vacio\n01/02/2024;1,5;x;\n02/02/2024;-2;1,y;\n")
    d = csv.read_csv(spark, str(tmp_path / "a.csv"), sep=";", decimal=",", index_col=1)
    assert d.columns[0] == "valor" and [r.valor for r in d.orderBy("fecha").collect()] == [1.5, -2.0]
    assert dict(d.dtypes)["texto"] == "string"
    s = files.read_series(spark, str(tmp_path / "a.csv"), sep=";", decimal=",").orderBy("ts").collect()
    assert [(r.ts.day, r.ts.month, r.value) for r in s] == [(1, 2, 1.5), (2, 2, -2.0)]


def test_a_failing_page_leaves_its_error(spark):
    from oreline.operators import pages
    d = spark.createDataFrame([(1, "u", "<p>"), (2, "bad", "")], "page_id bigint, url string, html string")

    def fn(page_id, url, html):
        yield (len(html),)
        if url == "bad":
            raise ValueError("no")
    got = {r.page_id: (r.n, r.error) for r in pages.map_pages(d, fn, "n bigint").collect()}
    assert got == {1: (3, None), 2: (None, "ValueError: no")}
