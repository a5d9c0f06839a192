"""Web-mining queries on the stored pages and on product pages composed from ``part``."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import pages as H
from ..sources.tables import table
from .registry import query


def stored(spark, sf):
    return table(spark, sf, "pages")


def shop(spark, sf):
    """One page of product cards per 20 parts; every third part is on offer, every fifth sold out."""
    p = table(spark, sf, "part")
    card = F.concat(
        F.lit("<div class='item card' data-id="), "p_partkey", F.lit("><h2 class=title><a href=\"/p/"), "p_partkey", F.lit("\"> "), "p_name",
        F.lit(" </a></h2><br><img src=\"/img/"), "p_partkey", F.lit(".png\"><span class=\"price money\"><span>Precio</span><span>$"),
        F.format_number(F.col("p_retailprice") * 10, 2), F.lit("</span></span>"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("<em class=offer>$"), "p_size", F.lit("</em>"))).otherwise(""),
        F.when(F.col("p_partkey") % 5 == 0, "<b class='sold-out'>Agotado</b>").otherwise(""), F.lit("</div>"))
    row = F.concat(F.lit("<tr><td>"), "p_partkey", F.lit("</td><td> "), "p_name", F.lit("</td><td>"), "p_size", F.lit("</tr>"))
    grouped = (p.select(F.floor(F.col("p_partkey") / 20).alias("page_id"), F.struct("p_partkey", card.alias("card"), row.alias("row")).alias("_c"))
               .groupBy("page_id").agg(F.array_sort(F.collect_list("_c")).alias("_c")))
    html = F.concat(
        F.lit("<html><head><title>Tienda &amp; "), "page_id", F.lit("</title><meta name=\"description\" content=\"Lista "), "page_id",
        F.lit("\"><meta name=author content='A B'></head><body><!-- x --><nav><a class=pg href=\"?page=1\">1</a><a class=pg href=\"?page="),
        F.col("page_id") + 7, F.lit("\">&gt;</a></nav><main>"), F.array_join(F.transform("_c", lambda c: c["card"]), "\n"),
        F.lit("</main><table><thead><tr><th>id</th><th> name</th><th>size</th></tr></thead><tbody>"),
        F.array_join(F.transform("_c", lambda c: c["row"]), ""), F.lit("</tbody></table></body></html>"))
    return grouped.select("page_id", F.concat(F.lit("https://shop.example.org/?page="), "page_id").alias("url"), html.alias("html"))


_PART = "p_partkey // 20 AS page_id, CAST(p_partkey % 20 AS INTEGER) AS pos"
_PRICE = "'$' || format('{:t,.2f}', round(p_retailprice * 10, 2))"


@query("src7_parsed_pages",
       "SELECT page_id, url, len(regexp_extract_all(html, '<a href')) AS links, len(regexp_extract_all(html, '<li>')) AS items, "
       "CAST(list_aggregate(list_transform(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1), lambda t: length(t)), 'sum') AS BIGINT) AS item_chars FROM pages")
def parsed_pages(spark, sf):
    parsed = H.parse(stored(spark, sf))
    tagged = lambda tag: F.filter("elements", lambda e: e["tag"] == tag)
    chars = F.aggregate(tagged("li"), F.lit(None).cast("long"), lambda n, e: F.coalesce(n, F.lit(0)) + e["t1"] - e["t0"])
    return parsed.select("page_id", "url", F.size(tagged("a")).cast("long").alias("links"), F.size(tagged("li")).cast("long").alias("items"), chars.alias("item_chars"))


@query("src9_html_tables", "SELECT p_partkey // 20 AS page_id, CAST(p_partkey % 20 AS INTEGER) AS \"row\", CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def html_tables(spark, sf):
    cells = H.table_cells(shop(spark, sf))
    return cells.groupBy("page_id", "row").pivot("col", [0, 1, 2]).agg(F.first("text")).toDF("page_id", "row", "id", "name", "size")


@query("web1_table_cells", "SELECT p_partkey // 20 AS page_id, CAST(p_partkey % 20 AS INTEGER) AS \"row\", c AS col, ['id', 'name', 'size'][c + 1] AS header, "
       "[CAST(p_partkey AS VARCHAR), p_name, CAST(p_size AS VARCHAR)][c + 1] AS text FROM part, (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS c)")
def table_cells(spark, sf):
    return H.table_cells(shop(spark, sf))


@query("web2_text_by_selector", f"SELECT {_PART}, p_name AS text FROM part")
def text_by_selector(spark, sf):
    return H.select_text(shop(spark, sf), "main > div.item h2.title a")


@query("web2_text_of_list_items",
       "WITH m AS (SELECT page_id, regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1) AS t FROM pages) "
       "SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(t) AS t FROM m) GROUP BY page_id")
def text_of_list_items(spark, sf):
    return H.select_text(stored(spark, sf), "nav li > a").groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


@query("web3_links", "SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href FROM pages")
def links(spark, sf):
    return H.links(stored(spark, sf)).select("page_id", "href")


@query("flt5_links_containing", "SELECT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href FROM pages) WHERE contains(href, 'th')")
def links_containing(spark, sf):
    return H.links(stored(spark, sf), "th").select("page_id", "href")


@query("web4_images", f"SELECT {_PART}, '/img/' || p_partkey || '.png' AS src FROM part")
def images(spark, sf):
    return H.images(shop(spark, sf))


@query("web5_metadata", "SELECT DISTINCT p_partkey // 20 AS page_id, 'Tienda & ' || (p_partkey // 20) AS titulo, 'Lista ' || (p_partkey // 20) AS descripcion, "
       "CAST(NULL AS VARCHAR) AS keywords, 'A B' AS autor FROM part")
def metadata(spark, sf):
    return H.metadata(shop(spark, sf))


@query("web5_titles", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) = '' AS blank, CAST(NULL AS VARCHAR) AS descripcion FROM pages")
def titles(spark, sf):
    m = H.metadata(stored(spark, sf))
    return m.select("page_id", (F.coalesce("titulo", F.lit("")) == "").alias("blank"), "descripcion")


@query("web6_product_cards", f"SELECT {_PART}, p_name AS \"Nombre\", 'Precio' || {_PRICE} AS \"Precio\", CASE WHEN p_partkey % 3 = 0 THEN '$' || p_size END AS \"PrecioDescuento\", "
       "CASE WHEN p_partkey % 5 = 0 THEN 'Sí' ELSE 'No' END AS \"Agotado\" FROM part")
def product_cards(spark, sf):
    return H.products(shop(spark, sf), "div.item", "h2.title", "span.price", "em.offer", ".sold-out")


@query("web7_structured_list", f"SELECT {_PART}, p_name AS titulo, {_PRICE} AS precio, CASE WHEN p_partkey % 3 = 0 THEN '$' || p_size END AS oferta FROM part")
def structured_list(spark, sf):
    df = H.structured_list(shop(spark, sf), ".card", {"titulo": "h2 > a", "precio": "//span[contains(@class,'price')]/span[2]", "oferta": "em"})
    return df


@query("web8_attributes", f"SELECT {_PART}, p_name AS texto, '/p/' || p_partkey AS href, CAST(NULL AS VARCHAR) AS title FROM part")
def attributes(spark, sf):
    return H.attributes(shop(spark, sf), "h2 a[href]", ["href", "title"])


_ZIP = ("WITH n AS (SELECT p_partkey // 20 AS page_id, p_partkey % 20 AS pos, p_name FROM part), "
        "o AS (SELECT p_partkey // 20 AS page_id, row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS pos, '$' || p_size AS offer FROM part WHERE p_partkey % 3 = 0) ")


@query("web9_text_columns", _ZIP + "SELECT n.page_id, CAST(n.pos AS INTEGER) AS pos, p_name AS nombre, offer AS oferta FROM n LEFT JOIN o ON n.page_id = o.page_id AND n.pos = o.pos")
def text_columns(spark, sf):
    return H.text_columns(shop(spark, sf), {"nombre": ("h2", {"class": "title"}), "oferta": ("em", None)})


@query("jn8_zip_padded", _ZIP + "SELECT n.page_id, CAST(n.pos AS INTEGER) AS pos, p_name AS a, offer AS b FROM n LEFT JOIN o ON n.page_id = o.page_id AND n.pos = o.pos")
def zip_padded(spark, sf):
    lists = H.values(shop(spark, sf), {"a": ("h2", "text"), "b": ("em", "text")})
    return H.zip_padded(lists, ["page_id"], {"a": F.col("a"), "b": F.col("b")})


@query("jn7_child_under_parent", f"SELECT {_PART}, p_name AS nombre FROM part")
def child_under_parent(spark, sf):
    return H.structured_list(shop(spark, sf), "div[data-id]", {"nombre": "a"})


@query("web10_path_text", f"SELECT {_PART}, p_name AS value FROM part")
def path_text(spark, sf):
    return H.path_values(shop(spark, sf), "//h2[@class='title']/a")


@query("web10_path_inner_html", f"SELECT {_PART}, '<a href=\"/p/' || p_partkey || '\"> ' || p_name || ' </a>' AS value FROM part")
def path_inner_html(spark, sf):
    return H.path_values(shop(spark, sf), "//div[contains(@class,'card')]/h2", "innerHTML")


@query("web10_path_attribute", f"SELECT {_PART}, '/p/' || p_partkey AS value FROM part")
def path_attribute(spark, sf):
    return H.path_values(shop(spark, sf), "//h2/a[@href]", "href")


@query("web11_rendered_products", _ZIP.replace("'$' || p_size", "'$' || p_size") +
       f", pr AS (SELECT p_partkey // 20 AS page_id, p_partkey % 20 AS pos, {_PRICE} AS price FROM part) "
       "SELECT n.page_id AS \"Pagina\", CAST(n.pos AS INTEGER) AS pos, p_name AS \"Nombre\", price AS \"Precio\", offer AS \"Descuento\" FROM n JOIN pr ON n.page_id = pr.page_id AND n.pos = pr.pos LEFT JOIN o ON n.page_id = o.page_id AND n.pos = o.pos")
def rendered_products(spark, sf):
    return H.rendered_products(shop(spark, sf), "//h2[@class='title']/a", "//span[contains(@class,'price')]/span[2]", "//em[@class='offer']")


@query("web12_page_totals", "SELECT DISTINCT p_partkey // 20 AS page_id, p_partkey // 20 + 7 AS total FROM part")
def page_totals(spark, sf):
    return H.page_total(shop(spark, sf), "//a[contains(@class,'pg')]")


@query("web12_absolute_links", "SELECT page_id, CASE WHEN href[1] = '/' THEN 'https://shop.example.org' ELSE '' END || href AS url FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href FROM pages)")
def absolute_links(spark, sf):
    base = F.when(F.col("href").startswith("/"), F.lit("https://shop.example.org")).otherwise("")
    return H.links(stored(spark, sf)).select("page_id", F.concat(base, "href").alias("url"))


def _count_tags(page_id, url, html):
    if "spam-farm" in url:
        raise ValueError("blocked host")
    return [(len(re.findall("<p>", html)), len(html))]


@query("udf1_page_callback", "SELECT page_id, CASE WHEN NOT bad THEN CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) END AS paragraphs, CASE WHEN NOT bad THEN length(html) END AS size, "
       "CASE WHEN bad THEN 'ValueError: blocked host' END AS error FROM (SELECT *, contains(url, 'spam-farm') AS bad FROM pages)")
def page_callback(spark, sf):
    return H.map_pages(table(spark, sf, "pages"), _count_tags, "paragraphs bigint, size bigint")


@query("udf1_failed_pages", "SELECT page_id, 'ValueError: blocked host' AS error FROM pages WHERE contains(url, 'spam-farm')")
def failed_pages(spark, sf):
    done = H.map_pages(table(spark, sf, "pages"), _count_tags, "paragraphs bigint, size bigint")
    return done.where("error IS NOT NULL").select("page_id", "error")


@query("jn9_cursor_chain", "SELECT event_id // 1000 AS page_no, count(*) AS n FROM events GROUP BY 1")
def cursor_chain(spark, sf):
    from ..sources import json_pages as J
    from .tables import _event_bodies
    recs = J.read_pages(_event_bodies(spark, sf), "event_id bigint, event_type string, value double, k bigint")
    return recs.groupBy("page_no").agg(F.count(F.lit(1)).alias("n"))


def _linked_bodies(spark, sf):
    """Pages of 50 events named by opaque tokens; page p names p + 3, so two thirds are orphans, some of them in loops."""
    page = F.floor(F.col("event_id") / 50)
    token = lambda p: F.md5(p.cast("string"))
    follower = F.when((F.col("page_no") % 3 == 1) & (F.col("page_no") % 30 == 28), F.col("page_no") - 27).otherwise(F.col("page_no") + 3)
    pages = table(spark, sf, "events").groupBy(page.alias("page_no")).agg(F.collect_list(F.struct("event_id", "value")).alias("hits"))
    return pages.select(F.when(F.col("page_no") != 0, token(F.col("page_no"))).alias("own"),
                        F.to_json(F.struct("hits", token(follower).alias("cursor"))).alias("body"))


@query("jn9_cursor_links",
       "WITH RECURSIVE pages AS (SELECT event_id // 50 AS p, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1), "
       "chain AS (SELECT p, CAST(0 AS BIGINT) AS rank FROM pages WHERE p = 0 UNION ALL "
       "SELECT pages.p, c.rank + 1 FROM chain c JOIN pages ON pages.p = c.p + 3) "
       "SELECT rank, first_event, n FROM chain JOIN pages USING (p)")
def cursor_links(spark, sf):
    from ..sources import json_pages as J
    recs = J.read_chain(_linked_bodies(spark, sf), "event_id bigint, value double")
    return recs.groupBy("rank").agg(F.min("record.event_id").alias("first_event"), F.count(F.lit(1)).alias("n"))
