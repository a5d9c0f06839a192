"""Mining stored web pages ``(page_id, url, html)``.

A page is parsed inside its row into a list of elements in document order. The selectors of a
query are evaluated in one pass over that list: an element carries the set of selector steps that
it, its ancestors and its earlier siblings match, as bits, so a step is decided by its neighbours
alone and the cost grows with the page, not with elements times matches. Containers and the
matches inside them meet in a merge of two lists in document order. Only what was asked for
leaves the task; nothing is shuffled. Operators read ``page_id`` and ``html``, whether the table
was parsed before or not.

Selectors are CSS: type, ``.class``, ``#id``, ``[a]``, ``[a=v]``, ``[a~=v]``, ``[a^=v]``, ``[a$=v]``,
``[a*=v]``, ``:nth-of-type(n)``, ``:first-of-type``, descendant, ``>``, ``+``, ``~`` and lists with
commas; or the path subset ``//tag[@a='v'][contains(@a,'v')][n]/tag``. Elements nest as written: an
unclosed tag stays open until an enclosing one closes, void tags never open. A null page has no
elements.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Elements without content and elements whose content is not text.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(("script", "style"))

CHUNK = 1 << 23          # characters of pages whose results leave a task together

ELEMENT = ("struct<id: int, parent: int, tag: string, nth: int, attrs: map<string,string>, anc: array<int>, "
           "t0: int, t1: int, i0: int, i1: int>")


class _Elements(HTMLParser):
    """Collects elements as [id, parent, tag, nth, attributes, text span, inner span, last descendant,
    sibling before], and the page text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.lines = [0]
        for line in html.split("\n")[:-1]:
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.html, self.items, self.open, self.same, self.latest = html, [], [], {}, {}
        self.text, self.length, self.pending = [], 0, []
        self.feed(html)
        self.close()
        self._flush()
        while self.open:
            self._finish(len(html))
        self.text = "".join(self.text)

    def _at(self):
        line, col = self.getpos()
        return self.lines[line - 1] + col

    def _flush(self):
        piece = "".join(self.pending).strip()
        self.pending = []
        if piece and not (self.open and self.items[self.open[-1]][2] in RAW_TAGS):
            self.text.append(piece)
            self.length += len(piece)

    def handle_starttag(self, tag, attrs):
        self._flush()
        parent = self.open[-1] if self.open else -1
        nth = self.same[parent, tag] = self.same.get((parent, tag), 0) + 1
        at = self._at() + len(self.get_starttag_text() or "")
        pairs = {}
        for name, value in attrs:
            pairs[name] = "" if value is None else value
        number = len(self.items)
        self.items.append([number, parent, tag, nth, pairs, self.length, self.length, at, at, number, self.latest.get(parent, -1)])
        self.latest[parent] = number
        if tag not in VOID_TAGS:
            self.open.append(number)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._finish(self._at())

    def _finish(self, at):
        item = self.items[self.open.pop()]
        item[6], item[8], item[9] = self.length, at, len(self.items) - 1

    def handle_endtag(self, tag):
        self._flush()
        if any(self.items[i][2] == tag for i in self.open):
            while self.items[self.open[-1]][2] != tag:
                self._finish(self._at())
            self._finish(self._at())

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def value(self, number, what):
        """``text``, ``innerHTML`` or ``@attribute`` of an element."""
        item = self.items[number]
        if what == "text":
            return self.text[item[5]:item[6]]
        return self.html[item[7]:item[8]] if what == "innerHTML" else item[4].get(what[1:])

    def inside(self, found, root):
        """The part of ``found`` (ids in document order) that lies below the root."""
        return found[bisect_right(found, root):bisect_right(found, self.items[root][9])]


_FIELDS = pa.struct([("id", pa.int32()), ("parent", pa.int32()), ("tag", pa.string()), ("nth", pa.int32()),
                     ("attrs", pa.map_(pa.string(), pa.string())), ("anc", pa.list_(pa.int32())),
                     ("t0", pa.int32()), ("t1", pa.int32()), ("i0", pa.int32()), ("i1", pa.int32())])


def _parse_batches(batches):
    """Parse the pages of a batch into one flat table of elements, handed over column by column."""
    for batch in batches:
        texts, items, ends = [], [], [0]
        for html in batch.column("html").to_pylist():
            page = _Elements(html or "")
            texts.append(page.text)
            above = []
            for number, parent, *rest in page.items:
                above.append(above[parent] + [parent] if parent >= 0 else [])
                items.append((number, parent, *rest[:3], above[number], *rest[3:7]))
            ends.append(len(items))
        columns = list(zip(*items)) or [()] * len(_FIELDS)
        arrays = [pa.array([list(a.items()) for a in c] if f.name == "attrs" else c, type=f.type) for f, c in zip(_FIELDS, columns)]
        flat = pa.StructArray.from_arrays(arrays, fields=list(_FIELDS))
        elements = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("html"), pa.array(texts, pa.string()), elements],
            names=["page_id", "url", "html", "text", "elements"])


def parse(pages: DataFrame) -> DataFrame:
    """Pages to (page_id, url, html, text, elements): one row per page, elements in document order."""
    return pages.select("page_id", "url", "html").mapInArrow(
        _parse_batches, f"page_id {dict(pages.dtypes)['page_id']}, url string, html string, text string, elements array<{ELEMENT}>")


@dataclass
class Step:
    """One compound selector and how it relates to the one before it."""
    relation: str = " "          # " " below, ">" child, "+" next sibling, "~" later sibling; a first step with ">" is a root
    tag: str | None = None
    tests: list = field(default_factory=list)          # (kind, attribute, value)
    nth: int | None = None


_CSS_PART = re.compile(r"""(?P<tag>[\w-]+|\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|:nth-of-type\(\s*(?P<nth>\d+)\s*\)|(?P<first>:first-of-type)
    |\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?P<q>["']?)(?P<val>.*?)(?P=q)\s*)?\]""", re.X)
_CSS_TOKEN = re.compile(r"""(?:\[(?:"[^"]*"|'[^']*'|[^\]"'])*\]|\([^)]*\)|[^\s>+~,\[(])+|[>+~,]|\S""")
_CSS_TESTS = {"=": "equal", "~=": "word", "^=": "starts", "$=": "ends", "*=": "part"}


def css_steps(selector: str) -> list[list[Step]]:
    """The alternatives of a selector, each a list of steps."""
    chains, steps, relation = [], [], None
    for token in [*_CSS_TOKEN.findall(selector), ","]:
        if token == ",":
            if not steps or relation:
                raise ValueError(f"empty part in selector {selector!r}")
            chains.append(steps)
            steps = []
        elif token in (">", "+", "~"):
            if relation or not steps and token != ">":
                raise ValueError(f"unsupported selector {selector!r}")
            relation = token
        else:
            steps.append(_css_step(token, relation or " ", selector))
            relation = None
    return chains


def _css_step(token, relation, selector):
    step, end = Step(relation), 0
    for m in _CSS_PART.finditer(token):
        if m.start() != end or m["tag"] and end:
            break
        end = m.end()
        if m["tag"]:
            step.tag = None if m["tag"] == "*" else m["tag"].lower()
        elif m["cls"]:
            step.tests.append(("word", "class", m["cls"]))
        elif m["id"]:
            step.tests.append(("equal", "id", m["id"]))
        elif m["nth"] or m["first"]:
            step.nth = int(m["nth"] or 1)
        else:
            step.tests.append((_CSS_TESTS[m["op"]] if m["op"] else "has", m["attr"].lower(), m["val"]))
    if end != len(token):
        raise ValueError(f"unsupported selector {selector!r}")
    return step


_PATH_STEP = re.compile(r"(//?)([\w-]+|\*)((?:\[[^\]]*\])*)")
_PATH_TEST = re.compile(r"""\[\s*(?:@([\w-]+)\s*=\s*(["'])(.*?)\2|contains\(\s*@([\w-]+)\s*,\s*(["'])(.*?)\5\s*\)|@([\w-]+)|(\d+))\s*\]""")


def path_steps(path: str) -> list[Step]:
    steps, end = [], 0
    for m in _PATH_STEP.finditer(path.strip()):
        if m.start() != end:
            raise ValueError(f"unsupported path {path!r}")
        end = m.end()
        step = Step(">" if m[1] == "/" else " ", None if m[2] == "*" else m[2].lower())
        at = 0
        for t in _PATH_TEST.finditer(m[3]):
            at = t.end()
            if t[1]:
                step.tests.append(("equal", t[1], t[3]))
            elif t[4]:
                step.tests.append(("contains", t[4], t[6]))
            elif t[7]:
                step.tests.append(("has", t[7], None))
            else:
                step.nth = int(t[8])
        if at != len(m[3]):
            raise ValueError(f"unsupported path {path!r}")
        steps.append(step)
    if end != len(path.strip()) or not steps:
        raise ValueError(f"unsupported path {path!r}")
    return steps


_TESTS = {
    "has": lambda v, want: True,
    "equal": lambda v, want: v == want,
    "contains": lambda v, want: want in v,
    "word": lambda v, want: want in v.split(),
    "starts": lambda v, want: want != "" and v.startswith(want),
    "ends": lambda v, want: want != "" and v.endswith(want),
    "part": lambda v, want: want != "" and want in v,
}


def _chains(selector) -> list[list[Step]]:
    """Alternatives of a CSS selector or a path; lists of steps are taken as they are."""
    if not isinstance(selector, str):
        return selector
    return [path_steps(selector)] if selector.lstrip().startswith("/") else css_steps(selector)


class Matcher:
    """Evaluates several selectors in one pass over the elements of a page."""

    def __init__(self, selectors):
        self.by_tag, self.ends, bit = {}, [], 1
        for selector in selectors:
            end = 0
            for steps in _chains(selector):
                before = 0
                for step in steps:
                    self.by_tag.setdefault(step.tag, []).append((bit, before, step))
                    before, bit = bit, bit << 1
                end |= before
            self.ends.append(end)

    def __call__(self, page: _Elements) -> list[list[int]]:
        """Ids of the matches of every selector, in document order."""
        found = [[] for _ in self.ends]
        own, above, left = [], [], []          # steps matched by the element, by its ancestors, by its earlier siblings
        anything = self.by_tag.get(None, [])
        for number, parent, tag, nth, attrs, *_, before in page.items:
            above.append(own[parent] | above[parent] if parent >= 0 else 0)
            left.append(own[before] | left[before] if before >= 0 else 0)
            met = {" ": above[number], ">": own[parent] if parent >= 0 else 0, "+": own[before] if before >= 0 else 0, "~": left[number]}
            mine = 0
            for steps in (self.by_tag.get(tag, ()), anything):
                for bit, needed, step in steps:
                    if needed and not met[step.relation] & needed or not needed and step.relation == ">" and parent >= 0:
                        continue
                    if (step.nth is None or step.nth == nth) and all(
                            name in attrs and _TESTS[kind](attrs[name], want) for kind, name, want in step.tests):
                        mine |= bit
            own.append(mine)
            if mine:
                for ids, end in zip(found, self.ends):
                    if mine & end:
                        ids.append(number)
        return found


def _first_inside(page, containers, found) -> dict[int, int]:
    """First match below each container. Both lists are in document order; a container waits until a match comes
    and leaves then: with that match if it is still open, else without."""
    first, waiting, at = {}, [], 0
    for number in found:
        while at < len(containers) and containers[at] < number:
            waiting.append(containers[at])
            at += 1
        first.update((c, number) for c in waiting if page.items[c][9] >= number)
        waiting.clear()
    return first


_ARROW = {IntegerType(): pa.int32(), StringType(): pa.string(), ArrayType(StringType()): pa.list_(pa.string())}


def _per_page(pages: DataFrame, emit, columns: dict) -> DataFrame:
    """(page_id, columns): the tuples that ``emit(page)`` lists for every page."""
    types = [_ARROW[t] for t in columns.values()]

    def table(batch, at, rows):
        cells = zip(*rows) if rows else ((),) * len(types)
        return pa.RecordBatch.from_arrays([batch.column("page_id").take(pa.array(at, pa.int64())),
                                           *[pa.array(c, t) for c, t in zip(cells, types)]], names=["page_id", *columns])

    def run(batches):
        for batch in batches:
            at, rows, size = [], [], 0
            for i, html in enumerate(batch.column("html")):
                html = html.as_py() or ""
                out = emit(_Elements(html))
                rows += out
                at += [i] * len(out)
                size += len(html)
                if size > CHUNK:
                    yield table(batch, at, rows)
                    at, rows, size = [], [], 0
            yield table(batch, at, rows)

    schema = StructType([StructField("page_id", pages.schema["page_id"].dataType), *[StructField(n, t) for n, t in columns.items()]])
    return pages.select("page_id", "html").mapInArrow(run, schema)


def values(pages: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """One row per page with a list for every name: ``wanted`` maps it to (selector, ``text`` | ``innerHTML`` |
    ``@attribute``). Lists are in document order; an absent attribute is NULL."""
    matcher, kinds = Matcher([s for s, _ in wanted.values()]), [k for _, k in wanted.values()]

    def emit(page):
        return [tuple([page.value(i, kind) for i in ids] for ids, kind in zip(matcher(page), kinds))]
    return _per_page(pages, emit, dict.fromkeys(wanted, ArrayType(StringType())))


def _listed(pages: DataFrame, selector, kind: str, name: str) -> DataFrame:
    return values(pages, {"_v": (selector, kind)}).select("page_id", F.posexplode("_v").alias("pos", name))


def select_text(pages: DataFrame, selector: str) -> DataFrame:
    """Text of every match, its stripped runs joined: (page_id, pos, text)."""
    return _listed(pages, selector, "text", "text")


def links(pages: DataFrame, contains: str | None = None) -> DataFrame:
    """Every ``a`` with an address, optionally only those that contain a text: (page_id, pos, href)."""
    out = _listed(pages, "a[href]", "@href", "href")
    return out if contains is None else out.where(F.col("href").contains(contains))


def images(pages: DataFrame, attribute: str = "src") -> DataFrame:
    """Non-empty attribute of every image: (page_id, pos, src)."""
    sources = values(pages, {"_v": ("img", "@" + attribute)})
    return sources.select("page_id", F.posexplode(F.filter("_v", lambda s: s.isNotNull() & (s != ""))).alias("pos", "src"))


def metadata(pages: DataFrame) -> DataFrame:
    """Title, description, keywords and author of each page; NULL when absent."""
    found = values(pages, {"titulo": ("title", "text"), **{
        column: (f"meta[name={name}]", "@content") for column, name in
        (("descripcion", "description"), ("keywords", "keywords"), ("autor", "author"))}})
    return found.select("page_id", *[F.get(c, F.lit(0)).alias(c) for c in found.columns[1:]])


def structured_list(pages: DataFrame, parent: str, fields: dict[str, str]) -> DataFrame:
    """One row per container, one column per field selector (text of the first match inside, else NULL)."""
    matcher = Matcher([parent, *fields.values()])

    def emit(page):
        containers, *found = matcher(page)
        firsts = [_first_inside(page, containers, ids) for ids in found]
        return [(pos, *[page.value(f[c], "text") if c in f else None for f in firsts]) for pos, c in enumerate(containers)]
    return _per_page(pages, emit, {"pos": IntegerType(), **dict.fromkeys(fields, StringType())})


def products(pages: DataFrame, container: str, name: str | None = None, price: str | None = None,
             discount: str | None = None, sold_out: str | None = None) -> DataFrame:
    """Product cards: Nombre, Precio, PrecioDescuento, Agotado ('Sí' / 'No')."""
    wanted = {"Nombre": name, "Precio": price, "PrecioDescuento": discount, "Agotado": sold_out}
    cards = structured_list(pages, container, {k: v for k, v in wanted.items() if v})

    def cell(k):
        value = F.col(k) if wanted[k] else F.lit(None).cast("string")
        return F.when(value.isNotNull(), "Sí").otherwise("No") if k == "Agotado" else value
    return cards.select("page_id", "pos", *[cell(k).alias(k) for k in wanted])


def attributes(pages: DataFrame, selector: str, names: list[str]) -> DataFrame:
    """Text and the given attributes of every match; absent attributes are NULL."""
    matcher = Matcher([selector])

    def emit(page):
        return [(pos, page.value(i, "text"), *[page.value(i, "@" + n) for n in names]) for pos, i in enumerate(matcher(page)[0])]
    return _per_page(pages, emit, {"pos": IntegerType(), "texto": StringType(), **dict.fromkeys(names, StringType())})


def zip_padded(df: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """Unequal lists side by side, short ones padded with NULL: (keys, pos, columns)."""
    lists = df.select(*keys, *[c.alias(n) for n, c in columns.items()])
    return (lists.select(*keys, F.posexplode(F.arrays_zip(*columns)).alias("pos", "_z"))
            .select(*keys, "pos", *[F.col("_z")[n].alias(n) for n in columns]))


def value_columns(pages: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """The lists of ``values`` side by side, padded: (page_id, pos, columns)."""
    return zip_padded(values(pages, wanted), ["page_id"], {n: F.col(n) for n in wanted})


def text_columns(pages: DataFrame, groups: dict[str, tuple]) -> DataFrame:
    """Several element groups as columns: ``groups`` maps a name to (tag, {attribute: value})."""
    def group(tag, attrs):
        return [[Step(" ", tag, [("word" if k == "class" and " " not in v else "equal", k, v) for k, v in (attrs or {}).items()])]]
    return value_columns(pages, {n: (group(*g), "text") for n, g in groups.items()})


def path_values(pages: DataFrame, path: str, attribute: str | None = None) -> DataFrame:
    """Text (default), ``innerHTML`` or an attribute of every match of a path query."""
    kind = "text" if attribute is None else attribute if attribute == "innerHTML" else "@" + attribute
    return _listed(pages, path, kind, "value")


def rendered_products(pages: DataFrame, names: str, prices: str, discounts: str | None = None) -> DataFrame:
    """Name, price and discount lists of rendered pages, padded, with the page number ``Pagina``."""
    wanted = {"Nombre": (names, "text"), "Precio": (prices, "text")}
    if discounts:
        wanted["Descuento"] = (discounts, "text")
    return value_columns(pages, wanted).withColumnRenamed("page_id", "Pagina")


def page_total(pages: DataFrame, path: str, attribute: str = "href") -> DataFrame:
    """Largest integer in the attribute of the pagination links of each page."""
    digits = F.flatten(F.transform("_v", lambda v: F.regexp_extract_all(F.coalesce(v, F.lit("")), F.lit(r"\d+"), F.lit(0))))
    return values(pages, {"_v": (path, "@" + attribute)}).select(
        "page_id", F.array_max(F.transform(digits, lambda d: d.try_cast("bigint"))).alias("total"))


def table_cells(pages: DataFrame, selector: str = "table", index: int = 0) -> DataFrame:
    """Cells of the index-th table of each page: (page_id, row, col, header, text).

    Headers come from ``thead``; rows from ``tbody`` when there is one, else from the table.
    """
    matcher = Matcher([selector, "thead", "tbody", "th", "td, th", "tr"])

    def emit(page):
        tables, heads, bodies, names, cells, rows = matcher(page)
        if index >= len(tables):
            return []
        top = tables[index]
        head, body = page.inside(heads, top)[:1], (page.inside(bodies, top) or [top])[0]
        header = [page.value(i, "text") for i in page.inside(names, head[0])] if head else []
        filled = [line for line in (page.inside(cells, r) for r in page.inside(rows, body)) if line]
        return [(row, col, header[col] if col < len(header) else None, page.value(i, "text"))
                for row, line in enumerate(filled) for col, i in enumerate(line)]
    return _per_page(pages, emit, {"row": IntegerType(), "col": IntegerType(), "header": StringType(), "text": StringType()})


def map_pages(pages: DataFrame, fn, schema: str) -> DataFrame:
    """User function over pages: ``fn(page_id, url, html) -> iterable of tuples`` per page.

    ``page_id`` leads every output row, so page order is kept, and ``error`` ends it: NULL, or on a page where the
    function raises one row with the message and no values. A user who only wants results filters on it.
    """
    columns = [p.strip().split()[0].split(":")[0] for p in schema.split(",")]

    def run(batches):
        for pdf in batches:
            out = []
            for page_id, url, html in pdf[["page_id", "url", "html"]].itertuples(index=False):
                try:
                    rows = [(page_id, *r, None) for r in fn(page_id, url, html)]
                except Exception as e:
                    rows = [(page_id, *[None] * len(columns), f"{type(e).__name__}: {e}")]
                out.extend(rows)
            # objects keep whole numbers whole beside the NULLs of failed pages
            yield pd.DataFrame(out, columns=["page_id", *columns, "error"], dtype=object)
    return pages.select("page_id", "url", "html").mapInPandas(run, f"page_id bigint, {schema}, error string")
