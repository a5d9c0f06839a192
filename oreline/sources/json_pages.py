"""Stored response bodies of a paged JSON service.

Bodies are rows ``(page_no, body STRING)``, or ``(own STRING, body STRING)`` with the cursor each page was
asked for by. Paging ends at the first body without a cursor or that is not readable, as a live client would
stop there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize

# Field names of the product service and the labels of the flat table.
PRODUCT_SCHEMA = (
    "zooDescripcionZoomies string, marca string, zoomiesParent3 string, zoomiesParent2 string, "
    "zoomiesParent string, zooEdad string, ecoTamano string, lastMonthSales double, "
    "storeDetail map<string, struct<amount: double, basePrice: double, percentDiscount: double, "
    "productAvailable: boolean>>")
PRODUCT_STORE = "501"
PRODUCT_TEXT_FIELDS = {
    "Nombre": "zooDescripcionZoomies", "Marca": "marca", "Mascota": "zoomiesParent3",
    "Tipo": "zoomiesParent2", "Subcategoria": "zoomiesParent", "Edad": "zooEdad", "Tamano": "ecoTamano"}


def parse_body(bodies: DataFrame, item_schema: str, items: str = "hits", cursor: str = "cursor") -> DataFrame:
    """Parse every body once: (page_no, items, cursor, readable)."""
    envelope = T.StructType.fromDDL(f"`{items}` array<struct<{_struct_body(item_schema)}>>, `{cursor}` string")
    parsed = bodies.withColumn("_p", F.from_json("body", envelope))
    return parsed.select(
        "page_no", F.col("_p")[items].alias("items"), F.col("_p")[cursor].alias("cursor"),
        F.try_parse_json("body").isNotNull().alias("readable"))


def _struct_body(ddl: str) -> str:
    return T.StructType.fromDDL(ddl).simpleString()[len("struct<"):-1]


def read_pages(bodies: DataFrame, item_schema: str, items: str = "hits", cursor: str | None = "cursor") -> DataFrame:
    """All records of all pages up to the end of the cursor chain: (page_no, pos, record)."""
    parsed = parse_body(bodies, item_schema, items, cursor or "cursor")
    if cursor:
        # two scalar subqueries: nothing runs while the plan is built
        last = parsed.agg(F.min(F.when(F.col("cursor").isNull() | (F.col("cursor") == ""), F.col("page_no")))).scalar()
        broken = parsed.agg(F.min(F.when(~F.col("readable"), F.col("page_no")))).scalar()
        parsed = parsed.where(F.coalesce(F.col("page_no") <= last, F.lit(True)) & F.coalesce(F.col("page_no") < broken, F.lit(True)))
    else:
        parsed = parsed.where("readable")
    return parsed.select("page_no", F.posexplode("items").alias("pos", "record"))


def read_chain(bodies: DataFrame, item_schema: str, items: str = "hits", cursor: str = "cursor", own: str = "own") -> DataFrame:
    """All records in the order of the cursors: (rank, own, pos, record).

    The page whose ``own`` is null or empty is the first (rank 0); every other one follows the page whose body
    names its ``own``. The chain ends at a page without a cursor, at a cursor no page has, before a page that is
    not readable, and where it would come back to a page it has read. Pages it never reaches are left out. Of
    several pages with one ``own`` the smallest body counts. No first page: no rows.

    Ranks come from pointer doubling: round i knows the page 2^i steps ahead of every page and doubles the part
    of the chain that is ranked, so a chain of n pages takes log2(n) rounds of equal joins.
    """
    envelope = T.StructType.fromDDL(f"`{items}` array<struct<{_struct_body(item_schema)}>>, `{cursor}` string")
    name = F.coalesce(F.col(own), F.lit(""))
    pages = materialize(bodies.groupBy(name.alias("own")).agg(F.min("body").alias("body"))
                        .where(F.try_parse_json("body").isNotNull()).withColumn("_p", F.from_json("body", envelope))
                        .select("own", F.col("_p")[items].alias("items"), F.nullif(F.col("_p")[cursor], F.lit("")).alias("next")))
    known = pages.select(F.col("own").alias("next"))
    ahead = materialize(pages.where("next is not null").select("own", "next").join(known, "next").select("own", "next"))
    ranked = materialize(pages.where("own = ''").select("own", F.lit(0).cast("bigint").alias("rank")))
    step = 1
    while True:
        further = ranked.join(ahead, "own").select(F.col("next").alias("own"), (F.col("rank") + step).alias("rank"))
        fresh = materialize(further.groupBy("own").agg(F.min("rank").alias("rank")).join(ranked, "own", "left_anti"))
        if fresh.isEmpty():
            break
        ranked = materialize(ranked.unionByName(fresh))
        jump = ahead.select(F.col("own").alias("next"), F.col("next").alias("_far"))
        ahead = materialize(ahead.join(jump, "next").select("own", F.col("_far").alias("next")))
        step *= 2
    return pages.join(ranked, "own").select("rank", "own", F.posexplode("items").alias("pos", "record"))


def flatten_products(records: DataFrame, store: str = PRODUCT_STORE, keep: tuple = ()) -> DataFrame:
    """Nested product records to the flat 11-column table with its defaults.

    A zero amount counts as missing and falls back to the base price. ``keep`` names columns
    beside the record that stay in front.
    """
    detail = F.col("record.storeDetail")[store]
    price = F.coalesce(F.nullif(detail["amount"], F.lit(0.0)), detail["basePrice"])
    return records.select(
        *keep, *[F.coalesce(F.col(f"record.{src}"), F.lit("")).alias(name) for name, src in PRODUCT_TEXT_FIELDS.items()],
        price.alias("Precio"),
        F.coalesce(detail["percentDiscount"], F.lit(0.0)).alias("Descuento_pct"),
        F.coalesce(detail["productAvailable"], F.lit(False)).alias("Disponible"),
        F.coalesce(F.col("record.lastMonthSales"), F.lit(0.0)).alias("VentasMes"))
