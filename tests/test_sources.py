import json

import pytest

from oreline.session import materialize, scratch_dir
from oreline.sources import csv as C
from oreline.sources import json_pages as J
from oreline.sources.tables import require_nonempty


def test_csv_round_trip_with_decimal_comma(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5, "a"), (2, None, "b;c")], "id int, x double, t string")
    path = C.write_csv(df, str(tmp_path / "out"), sep=";", decimal=",")
    back = C.read_csv(spark, path, "id int, x double, t string", sep=";", decimal=",", index_col="t")
    assert back.columns == ["t", "id", "x"] and sorted(back.collect()) == [("a", 1, 1.5), ("b;c", 2, None)]


def test_missing_file_raises(spark):
    with pytest.raises(Exception):
        C.read_csv(spark, "/no/such/file.csv", "a int")


def test_validation(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(ValueError):
        require_nonempty(empty)
    require_nonempty(empty, min_rows=0)


def bodies(spark, *pages):
    return spark.createDataFrame([(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(pages)], "page_no int, body string")


def records(df):
    return sorted((r.page_no, r.record.a) for r in df.collect())


def test_paging_stops_at_the_first_page_without_cursor(spark):
    df = bodies(spark, {"hits": [{"a": 1}], "cursor": "x"}, {"hits": [{"a": 2}]}, {"hits": [{"a": 3}], "cursor": "y"})
    assert records(J.read_pages(df, "a int")) == [(0, 1), (1, 2)]


def test_paging_stops_before_a_broken_page(spark):
    df = bodies(spark, {"hits": [{"a": 1}], "cursor": "x"}, "{broken", {"hits": [{"a": 3}]})
    assert records(J.read_pages(df, "a int")) == [(0, 1)]


def test_missing_item_field_is_an_empty_page(spark):
    df = bodies(spark, {"cursor": "x"}, {"hits": [{"a": 2}]})
    assert records(J.read_pages(df, "a int")) == [(1, 2)]


def test_product_defaults(spark):
    df = bodies(spark, {"hits": [{"marca": "M", "storeDetail": {"501": {"amount": 0, "basePrice": 9.5}}}, {"zooEdad": "x"}]})
    out = J.flatten_products(J.read_pages(df, J.PRODUCT_SCHEMA)).orderBy("Marca").collect()
    assert [(r.Marca, r.Precio, r.Descuento_pct, r.Disponible, r.VentasMes) for r in out] == [("", None, 0.0, False, 0.0), ("M", 9.5, 0.0, False, 0.0)]


def test_intermediate_tables_live_in_the_shared_folder(spark):
    kept = materialize(spark.range(3))
    assert scratch_dir(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    assert all(scratch_dir(spark) in f for f in kept.inputFiles())


def chain(spark, *pages):
    rows = [(own, p if isinstance(p, str) else json.dumps(p)) for own, p in pages]
    got = J.read_chain(spark.createDataFrame(rows, "own string, body string").repartition(4), "a int").collect()
    return [r.record.a for r in sorted(got, key=lambda r: (r["rank"], r.pos))]


def page(a, cursor=None):
    return {"hits": [{"a": a}], **({"cursor": cursor} if cursor else {})}


def test_chain_is_read_in_cursor_order_without_loops_and_orphans(spark):
    names = [None] + [f"c{(i * 37) % 101}" for i in range(1, 23)]
    pages = [(n, page(i, names[i + 1] if i < 22 else None)) for i, n in enumerate(names)]
    orphans = [("o1", page(900, "o2")), ("o2", page(901, "o1")), ("o3", page(902, names[5])), ("o4", page(903))]
    assert chain(spark, *orphans, *pages[::-1]) == list(range(23))


@pytest.mark.parametrize("pages,want", [
    ([(None, page(0, "b")), ("b", page(1, "c")), ("c", page(2, "b"))], [0, 1, 2]),       # comes back: every page once
    ([(None, page(0, "b")), ("b", page(1, "gone")), ("x", page(9, ""))], [0, 1]),        # a cursor no page has
    ([("", page(0, "b")), ("b", "{broken"), ("c", page(2))], [0]),                       # not readable
    ([(None, page(0, "b")), ("b", page(5)), ("b", page(4)), ("b", page(4))], [0, 4]),    # stored more than once
    ([("b", page(0, "c"))], []),                                                         # no first page
    ([(None, page(3))], [3])])
def test_ends_of_a_chain(spark, pages, want):
    assert chain(spark, *pages) == want
