"""Text and date expression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..sources.tables import table
from .registry import query


@query("str1_clean_text", "SELECT doc_id, regexp_replace(regexp_replace(text, '[\\s\\x{00a0}\\x{2028}\\x{2029}\\x{3000}\\x{0085}\\x{000b}]+', ' ', 'g'), '^ +| +$', '', 'g') AS text FROM documents")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("text"))


_PRICE = "'₡ ' || CAST(l_partkey % 9 + 1 AS VARCHAR) || ',' || lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') || '.' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')"
_PRICE_VALUE = "(l_partkey % 9 + 1) * 1000 + l_suppkey % 1000 + l_linenumber / 100.0"


@query("str2_parse_price", f"SELECT l_orderkey, l_linenumber, l_partkey, round({_PRICE_VALUE}, 2) :: DOUBLE AS price FROM lineitem")
def parse_price(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_PRICE.replace("VARCHAR", "STRING")).alias("p"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.round(X.parse_price(F.col("p")), 2).alias("price"))


@query("str3_clean_prices", "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE round(o_totalprice, 4) END AS price FROM orders")
def clean_prices(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.expr(
        "CASE WHEN o_orderkey % 11 = 0 THEN 'agotado' ELSE concat('$ ', format_number(o_totalprice, 4), ' ') END").alias("price"))
    out = X.clean_prices(df, ["price", "no_such_column"])
    return out.withColumn("price", F.round("price", 4))


@query("str4_clean_columns", "SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', '', 'g'), '([a-z]+)\\.example', '<\\1>', 'g') AS url FROM pages")
def clean_columns(spark, sf):
    df = table(spark, sf, "pages").select("page_id", "url")
    return X.clean_columns(df, ["url", "absent"], [(r"^https?://", ""), (r"([a-z]+)\.example", r"<\1>")])


@query("str5_extract_groups",
       "SELECT page_id, regexp_extract(url, '://([^/]+)/', 1) AS host, trim(regexp_extract(url, '/([a-z]{2})/', 1)) AS lang, "
       "regexp_extract(url, 'page=(\\d+)', 1) AS page FROM pages WHERE regexp_matches(url, '://([^/]+)/') AND regexp_matches(url, '/([a-z]{2})/') AND regexp_matches(url, 'page=(\\d+)')")
def extract_groups(spark, sf):
    df = table(spark, sf, "pages").select("page_id", "url")
    return X.extract_groups(df, "url", {"host": r"://([^/]+)/", "lang": r"/([a-z]{2})/", "page": r"page=(\d+)"}).drop("url")


_WEIGHT = "p_name || ' ' || CASE p_size % 4 WHEN 0 THEN '1,5 Kg' WHEN 1 THEN CAST(p_size AS VARCHAR) || ' G' WHEN 2 THEN CAST(p_size AS VARCHAR) || '.25lbs' ELSE 'suelto' END"


def _weighed(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.expr(_WEIGHT.replace("VARCHAR", "STRING")).alias("name"))


@query("str6_weight_and_unit",
       "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 1.5 WHEN 1 THEN p_size * 1.0 WHEN 2 THEN p_size + 0.25 END :: DOUBLE AS weight, "
       "CASE p_size % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'g' WHEN 2 THEN 'lbs' END AS unit FROM part")
def weight_and_unit(spark, sf):
    return _weighed(spark, sf).select("p_partkey", X.weight_number(F.col("name")).alias("weight"), X.weight_unit(F.col("name")).alias("unit"))


@query("str7_presentation",
       "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Lata' WHEN 1 THEN 'bolsa' END AS kind FROM part")
def presentation(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.expr(
        "concat(p_name, CASE p_size % 3 WHEN 0 THEN ' en Lata y bolsa' WHEN 1 THEN ' bolsa' ELSE ' bolsas' END)").alias("name"))
    return df.select("p_partkey", X.presentation(F.col("name")).alias("kind"))


@query("str8_split_lines", "SELECT doc_id, unnest(string_split(replace(text, chr(160), ' '), chr(10))) AS line FROM documents")
def split_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(X.split_lines(F.col("text"))).alias("line"))


@query("str9_parse_fixtures",
       "SELECT l_orderkey, l_linenumber, l_partkey, ' ' || l_returnflag AS competition, ' S' || l_suppkey || ' ' AS home, ' P' || l_partkey AS away FROM lineitem WHERE l_suppkey % 3 <> 0")
def parse_fixtures(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(
        "CASE WHEN l_suppkey % 3 = 0 THEN concat('- ', l_returnflag, ': descanso') "
        "ELSE concat('- ', l_returnflag, ': S', l_suppkey, ' vs. P', l_partkey) END").alias("line"))
    return X.parse_fixtures(df, "line").drop("line")


@query("str10_strip_seeding", "SELECT c_custkey, regexp_replace(c_name || ' (' || c_nationkey || ')', '[()]|\\d+', '', 'g') AS name FROM customer")
def strip_seeding(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.strip_seeding(F.concat("c_name", F.lit(" ("), "c_nationkey", F.lit(")"))).alias("name"))


@query("str11_scraped_price", "SELECT p_partkey, round(p_retailprice * 10, 2) AS price FROM part")
def scraped_price(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.expr(
        "concat('Precio actual\n$', format_number(p_retailprice * 10, 2))").alias("price"))
    out = X.clean_prices(df, ["price"], X.SCRAPED_PRICE_SUBSTITUTIONS)
    return out.withColumn("price", F.round("price", 2))


_OFFER = "CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN '$10.00 - $20.00' ELSE '$' || CAST(p_size AS VARCHAR) || '.50' END"


@query("str12_default_price", f"SELECT p_partkey, CASE WHEN p_size % 3 < 2 THEN '$0.00' ELSE {_OFFER} END AS price FROM part")
def default_price(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.default_price(F.expr(_OFFER.replace("VARCHAR", "STRING"))).alias("price"))


@query("str13_largest_integer", "SELECT page_id, list_max(list_transform(regexp_extract_all(url, '\\d+'), lambda x: CAST(x AS BIGINT))) AS top FROM pages")
def largest_integer(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.largest_integer(F.col("url")).alias("top"))


@query("str14_page_urls",
       "WITH p AS (SELECT page_id, unnest(range(1, page_id % 5 + 1)) AS page FROM pages) "
       "SELECT page_id, page, 'https://shop.example.org/' || page_id || '?page=' || page || '&grid' AS url FROM p")
def page_urls(spark, sf):
    df = table(spark, sf, "pages").select("page_id", F.concat(F.lit("https://shop.example.org/"), "page_id", F.lit("?page={page}&grid")).alias("base"),
                                          (F.col("page_id") % 5).alias("total"))
    return X.page_urls(df, "base", "total").select("page_id", "page", "url")


@query("flt4_matching_text", "SELECT doc_id, lang FROM documents WHERE text <> '' AND regexp_matches(text, '\\d{3,}')")
def matching(spark, sf):
    return X.matching(table(spark, sf, "documents").select("doc_id", "lang", "text"), "text", r"\d{3,}").select("doc_id", "lang")


@query("dat1_day_first_dates", "SELECT o_orderkey, o_orderdate AS d FROM orders")
def day_first(spark, sf):
    text = F.expr("concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate))")
    return table(spark, sf, "orders").select("o_orderkey", D.parse_day_first(text).alias("d"))
