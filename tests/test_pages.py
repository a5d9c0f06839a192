import random
import time

import pytest

from oreline.operators import pages as H

HTML = """<html><head><title> T &amp; x </title><meta name="author" content="me"></head><body>
<!-- note --><div class="item big" id=one><h2>Uno</h2><p>a<p>b <b>c</b></p></p><br><img src=""><img src='/i.png'></div>
<div class="item"><h2><a href="/dos">Dos</a></h2><span data-x="1">1</span><span>2</span></div>
<script>var s = "<p>no</p>";</script></body></html>"""


@pytest.fixture(scope="module")
def page(spark):
    return H.parse(spark.createDataFrame([(1, "u", HTML), (2, "v", None)], "page_id bigint, url string, html string"))


def texts(page, selector):
    return [r.text for r in H.select_text(page, selector).where("page_id = 1").orderBy("pos").collect()]


def test_selectors(page):
    assert texts(page, "div.item h2") == ["Uno", "Dos"]
    assert texts(page, "#one > h2") == ["Uno"]
    assert texts(page, "div > a") == [] and texts(page, "div a") == ["Dos"]
    assert texts(page, "[data-x=1]") == ["1"] and texts(page, "span[data-x]") == ["1"]
    assert texts(page, "//div[@class='item']/span[2]") == ["2"]
    assert texts(page, "//div[contains(@class,'big')]/h2") == ["Uno"]


def test_unclosed_paragraph_nests_and_scripts_are_no_text(page):
    assert texts(page, "p") == ["abc", "bc"]
    assert texts(page, "body") == ["UnoabcDos12"]


def test_inner_html(page):
    assert [r.value for r in H.path_values(page, "//h2", "innerHTML").orderBy("pos").collect()] == ["Uno", '<a href="/dos">Dos</a>']


def test_metadata_and_images(page):
    m = H.metadata(page).where("page_id = 1").first()
    assert (m.titulo, m.autor, m.descripcion) == ("T & x", "me", None)
    assert [r.src for r in H.images(page).collect()] == ["/i.png"]


def test_padding(page):
    rows = H.text_columns(page, {"h": ("h2", None), "s": ("span", None), "d": ("div", {"class": "big"})}).where("page_id = 1").orderBy("pos").collect()
    assert [(r.h, r.s is None, r.d is None) for r in rows] == [("Uno", False, False), ("Dos", False, True)]


def test_bad_selectors_raise():
    for bad in ("", "a:hover", "+ b", "a >", "a,", "a[b", "a ! b", ":nth-of-type(x)"):
        with pytest.raises(ValueError):
            H.css_steps(bad)
    with pytest.raises(ValueError):
        H.path_steps("//a[last()]")


SIBLINGS = """<ul><li class="a x">1</li><li data-k="pre-mid-end">2</li>t<li>3</li><b>4</b><li lang="">5</li></ul><ol><li>6</li></ol>"""


@pytest.mark.parametrize("selector, want", [
    ("ol li, b, b", "46"), ("li.a + li", "2"), ("li.a ~ li", "235"), ("li ~ b + li", "5"), ("ul li:nth-of-type(2), ol > li", "26"),
    ("[data-k^=pre]", "2"), ("[data-k$='end']", "2"), ('li[data-k*="d-e"]', "2"), ("[class~=x]", "1"), ("[data-k^='']", ""),
    ("li[lang]", "5"), ("[lang='']", "5"), ("li:first-of-type", "16"), ("ul + ol li", "6"), ("ul > b, ul > li.x", "14")])
def test_lists_siblings_and_attribute_operators(selector, want):
    page = H._Elements(SIBLINGS)
    assert "".join(page.value(i, "text") for i in H.Matcher([selector])(page)[0]) == want


def _plain(page, selector):
    """Matches by trying every element against every chain from its last step backwards."""
    def holds(e, steps):
        if e < 0:
            return False
        number, parent, tag, nth, attrs, *_, before = page.items[e]
        step = steps[-1]
        if step.tag not in (None, tag) or step.nth not in (None, nth) or not all(
                n in attrs and H._TESTS[k](attrs[n], w) for k, n, w in step.tests):
            return False
        if len(steps) == 1:
            return step.relation != ">" or parent < 0
        at = parent if step.relation in " >" else before
        while at >= 0:
            if holds(at, steps[:-1]):
                return True
            if step.relation in ">+":
                return False
            at = page.items[at][1] if step.relation == " " else page.items[at][-1]
        return False
    return [e for e in range(len(page.items)) if any(holds(e, c) for c in H._chains(selector))]


def test_drawn_pages_against_plain_evaluation():
    rng = random.Random(5)
    for _ in range(150):
        html = "".join(rng.choice(["<a>", "<b k=v>", "<c k='vw'>", "</a>", "</b>", "</c>", "<br>", "t"]) for _ in range(60))
        page = H._Elements(html)
        for selector in ("a b", "a > b", "a + b, c", "a ~ c > b", "* b ~ a", "a b c", "[k^=v] a", "//a/b[1]", "/a//c", "b:nth-of-type(2) *"):
            assert H.Matcher([selector])(page)[0] == _plain(page, selector), (html, selector)
        boxes, hits = H.Matcher(["b", "a"])(page)
        inside = {c: [h for h in hits if c < h <= page.items[c][9]] for c in boxes}
        assert H._first_inside(page, boxes, hits) == {c: h[0] for c, h in inside.items() if h}
        assert all(page.inside(hits, c) == h for c, h in inside.items())


def test_containers_cost_grows_with_the_page():
    def seconds(cards):
        page = H._Elements("".join(f"<div class=c><h2>n{i}</h2><i>{i}</i></div>" for i in range(cards)))
        best = 9.0
        for _ in range(3):
            start = time.perf_counter()
            boxes, names, marks = H.Matcher(["div.c", "h2", "div > i"])(page)
            assert len(H._first_inside(page, boxes, names)) == len(H._first_inside(page, boxes, marks)) == cards
            best = min(best, time.perf_counter() - start)
        return best
    assert seconds(16_000) < 8 * seconds(4_000)


def test_nested_containers_and_empty_pages(spark):
    html = "<div><div><p>a</p></div><p>b</p></div><div></div>"
    pages = spark.createDataFrame([("x", html), ("y", ""), ("z", None)], "page_id string, html string")
    rows = H.structured_list(pages, "div", {"first": "p", "page text": "i"}).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [("x", 0, "a", None), ("x", 1, "a", None), ("x", 2, None, None)]
    assert {r.page_id: r.total for r in H.page_total(pages, "//a").collect()} == dict.fromkeys("xyz")
    assert H.table_cells(pages).count() == 0 and H.links(pages.limit(0)).count() == 0


def test_expressions_run_on_a_stream(spark, tmp_path):
    """Page mining needs no state, so the same expressions run on a stream."""
    spark.createDataFrame([(1, "u", HTML)], "page_id bigint, url string, html string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("page_id bigint, url string, html string").parquet(str(tmp_path / "in"))
    q = (H.links(H.parse(stream)).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(60)
    assert [r.href for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["/dos"]
