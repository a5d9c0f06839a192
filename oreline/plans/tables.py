"""Projection, filter, sort and set queries; CSV and JSON sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import encode as E
from ..operators import profile as P
from ..session import scratch_dir
from ..sources import csv as C
from ..sources import json_pages as J
from ..sources.tables import nan_to_null, require_nonempty, table
from .registry import query


def _csv_copy(spark, sf, name, columns, **dialect):
    """Write columns of a table as CSV in the shared folder and return the path."""
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    return C.write_csv(table(spark, sf, name).select(*columns), path, **dialect)


@query("src1_csv_load", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_load(spark, sf):
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    path = _csv_copy(spark, sf, "customer", cols)
    return C.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")


@query("src2_validated_table", "SELECT p_partkey, p_name, p_retailprice FROM part")
def validated_table(spark, sf):
    return nan_to_null(require_nonempty(table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), 1, 1))


@query("src4_csv_semicolon_decimal_comma",
       "SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem")
def csv_semicolon(spark, sf):
    cols = ["l_extendedprice", "l_discount", "l_orderkey", "l_linenumber"]
    path = _csv_copy(spark, sf, "lineitem", cols, sep=";", decimal=",")
    return C.read_csv(spark, path, "l_extendedprice double, l_discount double, l_orderkey bigint, l_linenumber int",
                      sep=";", decimal=",", index_col="l_orderkey")


@query("snk1_csv_export", "SELECT l_orderkey, l_linenumber, replace(CAST(l_tax AS VARCHAR), '.', ',') AS l_tax FROM lineitem")
def csv_export(spark, sf):
    path = _csv_copy(spark, sf, "lineitem", ["l_tax", "l_orderkey", "l_linenumber"], sep="|", decimal=",", index="l_orderkey")
    return C.read_csv(spark, path, "l_orderkey bigint, l_tax string, l_linenumber int", sep="|")


def _event_bodies(spark, sf):
    """Event records in page bodies of 1000 records each, the last page without cursor."""
    ev = table(spark, sf, "events")
    page = F.floor(F.col("event_id") / 1000)
    rec = F.struct("event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    pages = ev.groupBy(page.alias("page_no")).agg(F.collect_list(rec).alias("hits"))
    last = ev.agg(F.max(page)).first()[0]
    cursor = F.when(F.col("page_no") < F.lit(last), F.col("page_no").cast("string"))
    return pages.select("page_no", F.to_json(F.struct("hits", cursor.alias("cursor"))).alias("body"))


@query("src5_json_pages",
       "SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_pages(spark, sf):
    recs = J.read_pages(_event_bodies(spark, sf), "event_id bigint, event_type string, value double, k bigint")
    return recs.select("record.*")


@query("src6_flatten_products",
       "SELECT p_name AS \"Nombre\", p_brand AS \"Marca\", p_type AS \"Mascota\", '' AS \"Tipo\", p_brand AS \"Subcategoria\", "
       "'' AS \"Edad\", '' AS \"Tamano\", p_retailprice AS \"Precio\", CAST(CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size END AS DOUBLE) AS \"Descuento_pct\", "
       "p_size % 2 = 0 AS \"Disponible\", CAST(CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size * 10 END AS DOUBLE) AS \"VentasMes\", p_partkey FROM part")
def flatten_products(spark, sf):
    parts = table(spark, sf, "part")
    size = F.col("p_size")
    # every second product has a zero amount, so its price must come from the base price
    detail = F.struct(F.when(size % 2 == 0, F.col("p_retailprice")).otherwise(0.0).alias("amount"),
                      F.col("p_retailprice").alias("basePrice"),
                      F.when(size % 3 != 0, size.cast("double")).alias("percentDiscount"),
                      (size % 2 == 0).alias("productAvailable"))
    rec = F.struct(F.col("p_name").alias("zooDescripcionZoomies"), F.col("p_brand").alias("marca"),
                   F.col("p_type").alias("zoomiesParent3"), F.col("p_brand").alias("zoomiesParent"),
                   F.when(size % 5 != 0, size * 10.0).alias("lastMonthSales"),
                   F.create_map(F.lit("501"), detail).alias("storeDetail"))
    bodies = parts.select(F.col("p_partkey").alias("page_no"),
                          F.to_json(F.struct(F.array(rec).alias("hits"), F.lit("next").alias("cursor"))).alias("body"))
    recs = J.read_pages(bodies, J.PRODUCT_SCHEMA)
    return J.flatten_products(recs.withColumnRenamed("page_no", "p_partkey"), keep=("p_partkey",))


@query("prj1_numeric_columns",
       "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def numeric_columns(spark, sf):
    return P.numeric_only(table(spark, sf, "lineitem"))


def _flags_sql(col, values):
    return ", ".join(f"CASE WHEN {col} = '{v}' THEN 1.0 ELSE 0.0 END :: DOUBLE AS \"{col}_{v}\"" for v in values)


@query("prj2_one_hot",
       "SELECT o_orderkey, " + _flags_sql("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
       + ", " + _flags_sql("o_orderstatus", ["F", "O", "P"]) + " FROM orders")
def one_hot(spark, sf):
    return E.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("prj3_restored_table", "SELECT s_suppkey, s_name, s_acctbal, 0.0 :: DOUBLE AS edited FROM supplier")
def restored_table(spark, sf):
    original = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    # tables are immutable: after an edit the first handle still reads the source
    edited = original.withColumn("s_acctbal", F.lit(0.0))
    return original.join(edited.select("s_suppkey", F.col("s_acctbal").alias("edited")), "s_suppkey")


@query("prj4_drop_target", "SELECT l_quantity, l_extendedprice, l_discount FROM lineitem")
def drop_target(spark, sf):
    return table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax").drop("l_tax")


@query("prj5_price_range",
       "SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'BAJO' WHEN o_totalprice < 25000 THEN 'MEDIO' ELSE 'ALTO' END AS range FROM orders")
def price_range(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.price_range(F.col("o_totalprice")).alias("range"))


_BLANK = "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END"


@query("prj6_replace_empty", f"SELECT c_custkey, CASE WHEN {_BLANK} = '' THEN 'OTRO' ELSE {_BLANK} END AS segment FROM customer")
def replace_empty(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.expr(_BLANK).alias("segment"))
    return X.replace_empty(df, ["segment"])


@query("prj7_truncate_and_scale",
       "SELECT o_orderkey, substr(o_orderpriority, 1, 4) AS short, round(o_totalprice / 1000000, 9) AS millions FROM orders")
def truncate_and_scale(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 4).alias("short"), F.round(F.col("o_totalprice") / 1e6, 9).alias("millions"))


@query("flt1_conjunctive_filter",
       "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') "
       "AND c_acctbal IS NOT NULL AND c_acctbal > 0")
def conjunctive_filter(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return df.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_acctbal").isNotNull() & (F.col("c_acctbal") > 0))


@query("flt2_point_lookup", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_orderkey = 14 OR l_extendedprice <= 1000")
def point_lookup(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice").where("l_orderkey = 14 OR l_extendedprice <= 1000")


@query("flt3_drop_missing_keep_valid",
       "SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL AND lang IN ('en', 'fr')")
def drop_missing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").dropna(subset=["quality"]) \
        .where(F.col("lang").isin("en", "fr")).select("doc_id", "lang", "quality")


@query("top1_sorted_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def sorted_head(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("top2_largest_first_wins", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey LIMIT 15")
def largest(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity") \
        .orderBy(F.desc("l_quantity"), "l_orderkey", "l_linenumber", "l_partkey").limit(15)


@query("plt9_top_products", "SELECT p_partkey, substr(p_name, 1, 45) AS name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def top_products(spark, sf):
    return table(spark, sf, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10) \
        .select("p_partkey", F.substring("p_name", 1, 45).alias("name"), "p_retailprice")


@query("plt9_category_frequency", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 20")
def category_frequency(spark, sf):
    return P.value_counts(table(spark, sf, "part"), "p_brand", 20)


@query("set1_concat_unequal_columns",
       "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL "
       "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def concat_unequal(spark, sf):
    a = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    b = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    return a.unionByName(b, allowMissingColumns=True)


@query("udf2_native_row_functions",
       "SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'BAJO' WHEN o_totalprice < 300000 THEN 'MEDIO' ELSE 'ALTO' END AS range, "
       "lower(trim(regexp_replace(o_orderpriority, '[^A-Z]+', ' ', 'g'))) AS priority FROM orders")
def native_row_functions(spark, sf):
    """What per-row callbacks did, as expressions."""
    return table(spark, sf, "orders").select(
        "o_orderkey", X.price_range(F.col("o_totalprice"), 100000, 300000).alias("range"),
        F.lower(X.clean_text(X.substitute(F.col("o_orderpriority"), [("[^A-Z]+", " ")]))).alias("priority"))
