"""Profiling, numeric and scaling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import encode as E
from ..operators import profile as P
from ..operators import scale as S
from ..sources.tables import table
from .registry import query

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, digits=6, only=None):
    names = only or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


def _describe_sql(table_name, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, "
        f"round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max, count(*) - count({c}) AS nulls FROM {table_name}"
        for c in cols)


@query("agg1_describe", _describe_sql("lineitem", LINE_COLS))
def describe(spark, sf):
    return rounded(P.describe(table(spark, sf, "lineitem"), LINE_COLS), 4)


@query("agg2_overview", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, '{t}' AS type, count(*) - count({c}) AS nulls FROM customer"
    for c, t in [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]))
def overview(spark, sf):
    return P.overview(table(spark, sf, "customer"))


def _corr_sql(table_name, cols):
    return " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS corr FROM {table_name}"
                              for a in cols for b in cols)


@query("agg3_correlation", _corr_sql("lineitem", LINE_COLS))
def correlation(spark, sf):
    return rounded(P.correlation(table(spark, sf, "lineitem"), LINE_COLS))


@query("plt4_correlation_map", _corr_sql("part", ["p_partkey", "p_size", "p_retailprice"]))
def correlation_map(spark, sf):
    return rounded(P.correlation(table(spark, sf, "part"), ["p_partkey", "p_size", "p_retailprice"]))


@query("agg4_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 3")
def value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "events"), "event_type", 3)


@query("agg5_class_shares", "SELECT quality, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY quality")
def class_shares(spark, sf):
    return rounded(P.class_shares(table(spark, sf, "labels"), "quality"))


@query("agg9_pivot_count",
       "SELECT o_orderstatus, " + ", ".join(f"count(*) FILTER (o_orderpriority = '{v}') AS \"{v}\"" for v in
                                            ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " FROM orders GROUP BY o_orderstatus")
def pivot_count(spark, sf):
    return P.pivot_count(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority",
                         ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


def _box_sql(table_name, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", min({c}) FILTER (ok) AS lo, any_value(p25) AS p25, any_value(p50) AS p50, any_value(p75) AS p75, "
        f"max({c}) FILTER (ok) AS hi, count(*) FILTER (NOT ok) AS outliers FROM (SELECT {c}, p25, p50, p75, "
        f"{c} BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25) AS ok FROM {table_name}, "
        f"(SELECT quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM {table_name}))"
        for c in cols)


@query("plt1_boxplot", "SELECT \"column\", round(lo, 4) AS lo, round(p25, 4) AS p25, round(p50, 4) AS p50, round(p75, 4) AS p75, round(hi, 4) AS hi, outliers FROM ("
       + _box_sql("events", ["value"]) + " UNION ALL " + _box_sql("events", ["user_id"]) + ")")
def boxplot(spark, sf):
    return rounded(P.boxplot(table(spark, sf, "events"), ["value", "user_id"]), 4)


@query("plt1_outliers", "SELECT 'value' AS \"column\", value FROM events, (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events) "
       "WHERE NOT value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)")
def outliers(spark, sf):
    return P.outliers(table(spark, sf, "events"), ["value"])


@query("plt2_histogram",
       "WITH x AS (SELECT 'l_quantity' AS \"column\", l_quantity AS v FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem), "
       "e AS (SELECT min(v) AS a, max(v) AS b FROM x) "
       "SELECT \"column\", CAST(least(floor((v - a) / ((b - a) / 10)), 9) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY 1, 2")
def histogram(spark, sf):
    return P.histogram(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], 10).select("column", "bin", "n")


@query("plt3_density",
       "WITH s AS (SELECT count(l_quantity) AS n, stddev_samp(l_quantity) AS sd, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem), "
       "g AS (SELECT i, lo - (hi - lo) / 2 + i * (2 * (hi - lo) / 49) AS x, sd * n ** -0.2 AS h, n FROM s, (SELECT unnest(range(0, 50)) AS i)), "
       "w AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1) "
       "SELECT round(x, 6) AS x, round(sum(c * exp(-0.5 * ((x - v) / h) * ((x - v) / h)) / (h * sqrt(2 * pi()))) / any_value(n), 8) AS density FROM g, w GROUP BY i, x")
def density(spark, sf):
    out = P.density(table(spark, sf, "lineitem"), "l_quantity", points=50, resolution=0)
    return out.select(F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query("plt5_visual_profile",
       "SELECT 'boxplot' AS part, 2 :: BIGINT AS n UNION ALL SELECT 'correlation', 4 UNION ALL "
       "SELECT 'density', 400 UNION ALL SELECT 'histogram', (WITH x AS (SELECT 'a' AS c, l_discount AS v FROM lineitem UNION ALL SELECT 'b', l_tax FROM lineitem), "
       "e AS (SELECT min(v) AS lo, max(v) AS hi FROM x) SELECT count(*) FROM (SELECT DISTINCT c, least(floor((v - lo) / ((hi - lo) / 10)), 9) FROM x, e))")
def visual_profile(spark, sf):
    parts = P.visual_profile(table(spark, sf, "lineitem"), ["l_discount", "l_tax"])
    out = None
    for name in sorted(parts):
        one = parts[name].agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


_MIXED = ("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'n/a' "
          "ELSE replace(CAST(o_totalprice AS VARCHAR), '.', ',') END AS amount, "
          "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_custkey FROM orders")


@query("num1_coerce_numeric",
       f"WITH m AS ({_MIXED}), x AS (SELECT *, try_cast(replace(amount, ',', '.') AS DOUBLE) AS a FROM m), "
       "c AS (SELECT priority, dense_rank() OVER (ORDER BY priority) - 1 AS code FROM (SELECT DISTINCT priority FROM m WHERE priority IS NOT NULL)) "
       "SELECT o_orderkey, round(coalesce(a, (SELECT median(a) FROM x)), 6) AS amount, coalesce(code, -1) :: DOUBLE AS priority, o_custkey :: DOUBLE AS o_custkey "
       "FROM x LEFT JOIN c ON x.priority = c.priority")
def coerce_numeric(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders_num1")
    mixed = spark.sql(_MIXED.replace("FROM orders", "FROM orders_num1").replace("AS VARCHAR", "AS STRING"))
    out = E.coerce_numeric(mixed, exclude=("o_orderkey",))
    return out.withColumn("amount", F.round("amount", 6))


@query("win6_category_codes",
       "SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS p_name FROM part")
def category_codes(spark, sf):
    return E.codes(table(spark, sf, "part").select("p_partkey", "p_name"), ["p_name"]).withColumn("p_name", F.col("p_name").cast("bigint"))


def _z(c):
    return f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"


@query("num2_standardize", f"SELECT l_orderkey, l_linenumber, l_partkey, {_z('l_quantity')}, {_z('l_tax')} FROM lineitem")
def standardize(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    return rounded(S.standardize(df, ["l_quantity", "l_tax"]))


@query("num3_min_max", "SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS scaled, "
       "round(c_acctbal, 4) AS restored FROM customer")
def min_max(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    stats = S.learn(df, ["c_acctbal"])
    scaled = S.min_max(df, ["c_acctbal"], stats).withColumn("scaled", F.round("c_acctbal", 6))
    back = S.min_max_inverse(scaled, ["c_acctbal"], stats)
    return back.select("c_custkey", "scaled", F.round("c_acctbal", 4).alias("restored"))


@query("num4_median_imputation",
       "WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS v FROM lineitem), "
       "m AS (SELECT median(v) AS m FROM t WHERE l_orderkey % 4 <> 0) "
       "SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(v, m), 4) AS v FROM t, m")
def median_imputation(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS v")
    stats = S.learn(df.where("l_orderkey % 4 <> 0"), ["v"])
    return rounded(S.impute_median(df, ["v"], stats), 4)


_CENTRES = ("WITH c AS (SELECT c_mktsegment, avg(c_acctbal) AS bal, avg(c_nationkey) AS nat FROM customer GROUP BY 1) ")


@query("num5_max_abs", _CENTRES + "SELECT c_mktsegment, round(bal / max(abs(bal)) OVER (), 6) AS bal, round(nat / max(abs(nat)) OVER (), 6) AS nat FROM c")
def max_abs(spark, sf):
    c = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("bal"), F.avg("c_nationkey").alias("nat"))
    return rounded(S.max_abs(c, ["bal", "nat"]))


@query("num5_radar_scale", _CENTRES + "SELECT c_mktsegment, round((bal - min(bal) OVER ()) / (max(bal) OVER () - min(bal) OVER ()) * 100, 4) AS bal, "
       "round((nat - min(nat) OVER ()) / (max(nat) OVER () - min(nat) OVER ()) * 100, 4) AS nat, 50.0 :: DOUBLE AS fixed FROM c")
def radar_scale(spark, sf):
    c = table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.avg("c_acctbal").alias("bal"), F.avg("c_nationkey").alias("nat"), F.max(F.lit(7.0)).alias("fixed"))
    return rounded(S.radar(c, ["bal", "nat", "fixed"]), 4)


@query("num6_label_index", "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS label, o_orderpriority AS back FROM orders")
def label_index(spark, sf):
    df, classes = S.label_index(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")
    return S.index_label(df, "label", classes, "back").select("o_orderkey", "label", "back")


def _pool_sql(agg):
    return ("WITH px AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) "
            f"SELECT vec_id, (i // 8) // 4 AS r, (i % 8) // 4 AS c, round({agg}(CAST(v AS DOUBLE)), 6) AS v FROM px GROUP BY 1, 2, 3")


def _pooled(spark, sf, how):
    df = S.pool_image(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", 8, 4, how)
    return df.select("vec_id", F.posexplode("embedding").alias("i", "v")).select(
        "vec_id", F.floor(F.col("i") / 2).alias("r"), (F.col("i") % 2).cast("bigint").alias("c"), F.round("v", 6).alias("v"))


@query("num7_pool_mean", _pool_sql("avg"))
def pool_mean(spark, sf):
    return _pooled(spark, sf, "mean")


@query("num7_pool_max", _pool_sql("max"))
def pool_max(spark, sf):
    return _pooled(spark, sf, "max")


@query("num8_bipolar_sigmoid",
       "SELECT vec_id, round(2 / (1 + exp(-(embedding[1] :: DOUBLE + 0.5 * embedding[2] :: DOUBLE - 0.25 * embedding[3] :: DOUBLE + 0.3))) - 1, 6) AS y FROM embeddings")
def bipolar_sigmoid(spark, sf):
    h = N.weighted_sum(F.slice("embedding", 1, 3), [1.0, 0.5, -0.25], 0.3)
    return table(spark, sf, "embeddings").select("vec_id", F.round(N.bipolar_sigmoid(h), 6).alias("y"))
