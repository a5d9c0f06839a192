"""Jaccard join, spelling variants and hard negatives against brute force."""
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.llm import jaccard, negatives, queries, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")


def shingle_set(text, width=3):
    w = WORD.findall(ascii_lower(text))
    return {tuple(w)} - {()} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def joined(rows, percent=90):
    """doc_id -> (n, component) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 10 * len(a) >= 8 * len(b) and 10 * len(b) >= 8 * len(a):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(s), doc if not s else least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def collected(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(frame).collect()), key=repr)


def test_jaccard_join_of_families(spark):
    """Copies with few and many edits around bases, chains of copies, and texts that share most of a passage."""
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 4000, n)]
    texts = []
    for size, edits, copies in ((60, 1, 40), (120, 3, 60), (200, 8, 30), (400, 6, 30), (30, 1, 20), (900, 20, 12)):
        base = word(size)
        texts.append(base)
        for _ in range(copies):
            own = list(base)
            for at in rng.choice(size, rng.integers(0, edits + 1), replace=False):
                own[at] = f"x{rng.integers(0, 10 ** 6)}"
            texts.append(own)
    chain = word(150)
    for i in range(25):                          # each copy differs a little from the one before
        chain = chain[:6 * i] + word(2) + chain[6 * i + 2:]
        texts.append(chain)
    passage = word(300)
    texts += [passage + word(int(rng.integers(5, 40))) for _ in range(40)] + [["one"], ["ONE"], ["one", "two"], []]
    order = rng.permutation(len(texts))
    rows = [(int(i), " ".join(texts[k])) for i, k in enumerate(order)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collected(frame) == joined(rows)


def test_blocks_and_the_rest(spark, monkeypatch):
    """The same result with blocks of a few rows, and from the lists alone when no set has been compared with a pivot."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 500, 80)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in rng.choice(80, rng.integers(0, 7), replace=False):
            own[at] = f"x{rng.integers(0, 30)}"
        rows.append((i, " ".join(own)))
    frame, wanted = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), joined(rows)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    assert collected(frame) == wanted
    monkeypatch.setattr(jaccard, "_derived", lambda near, component, percent: spark.createDataFrame([], "a long, b long"))
    near = jaccard.compared
    monkeypatch.setattr(jaccard, "compared", lambda pairs, texts, width, lower, percent: near(pairs, texts, width, lower, percent) if percent == 90
                        else near(pairs.where("false"), texts, width, lower, percent))
    rest = jaccard._rest
    monkeypatch.setattr(jaccard, "_rest", lambda lists, near, component, classes, percent: rest(
        lists.withColumn("p", F.lit(-1)), near.where("false"), component.where("false"), classes, percent))
    assert collected(frame) == wanted


def test_jaccard_lists_are_filtered_and_cut_in_one_join(spark):
    """A list whose open entries are one component is left out by the join that numbers the blocks of the others."""
    entries = [(1, c, 100, 0, 100, 100) for c in (1, 2, 100)] + [(2, c, 100, 0, 200, 100) for c in (3, 4, 200)]
    lists = spark.createDataFrame(entries, "key long, c long, n long, pos int, p long, m long")
    near = spark.createDataFrame([], "c long, p long, n long, m long, common long")
    component = spark.createDataFrame([(3, 3), (4, 3)], "node long, component long")
    classes = spark.createDataFrame([(c, bytes(64)) for c in range(1, 5)], "th long, short binary")
    found = jaccard._rest(lists, near, component, classes, 90)
    assert [tuple(r) for r in found.collect()] == [(2, 1, 100, 100)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 2



def test_jaccard_join_of_tables_and_edges(spark, documents, edge, empty):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert collected(documents) == joined(rows)
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert collected(edge) == joined(rows)
    assert jaccard.jaccard_join(empty).count() == 0


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(1)
    for n, m, both in ((50, 60, 40), (100, 100, 100), (900, 1100, 800), (64, 65, 10)):
        pool = rng.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
        x, y = pool[:n], pool[n - both:]
        bits = [np.frombuffer(jaccard.parity_bits(s), np.uint8) for s in (x, y)]
        for i in (0, 1):
            assert jaccard.differing(bits, i, np.array([1 - i]))[0] <= n + m - 2 * both


def misspelled_words(rows, every=199, least=6, times=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= times}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelled(words):
    out, forms = {}, {}
    for w, n in words.items():
        others = [x for x in words if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
        out[w] = [forms[w], None, n, len(others), words[best] if forms[w] else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def told(frame, **options):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame, **options).collect()}


def test_spelling_variants_of_tables_and_edges(spark, documents, edge, empty):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert told(documents) == spelled(misspelled_words(rows))
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert told(edge) == spelled(misspelled_words(rows))
    assert spelling.variants(empty).count() == 0


def test_spelling_chains_ties_and_runs_of_letters(spark):
    counts = {"letter": 125, "lettes": 25, "lettess": 5, "better": 125, "bettter": 6, "betttter": 1, "añadir": 10, "anadir": 2, "aãadir": 2, "aaaaaa": 3,
              "aaaaa": 30, "aaaaaaa": 15}
    rows = [(None if i % 3 else i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for every in (2, 199, 1 << 40):
        words = misspelled_words(rows, every, 5, 1)
        assert told(frame, every=every, least=5, times=1) == spelled(words)
    assert told(frame, every=1 << 40, least=5, times=1)["lettess"][:2] == ("lettes", "letter")


def brute_negatives(rows, labels):
    v = {i: np.floor(np.array(x, np.float64) * 256).astype(np.int64) for i, x in rows}
    out = []
    for a in sorted(v):
        if a % 50:
            continue
        score = {b: int(v[a] @ v[b]) for b in v if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if labels[b] == labels[a]][:5]:
            fits = [b for b in order if labels[b] != labels[a] and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out += [(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(fits[:3])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,codes", [(8192, 16), (70, 4), (1000, 1)])
def test_hard_negatives(spark, shard_rows, codes):
    """Clustered vectors, many copies of one vector, ties, and rows that take no part."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12))
    x = centres[rng.integers(0, 8, 400)] + 0.3 * rng.normal(size=(400, 12))
    x[100:230] = x[100]
    rows = [(int(i), [float(np.float32(c)) for c in x[i]]) for i in range(400)]
    labels = {i: int(rng.integers(0, 4)) for i in range(400)}
    odd = [(500, None, 1), (550, [0.1] * 11 + [None], 1), (600, [float("nan")] * 12, 1), (650, [float("inf")] * 12, 1), (700, [0.2] * 12, None), (None, [0.2] * 12, 1)]
    table = [(i, v, labels[i]) for i, v in rows] + [(i, v, labels[i]) for i, v in rows[:60]] + odd
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1)).withColumn("shard", F.lit(2)).repartition(4)
    got = negatives.hard_negatives(frame, shard_rows=shard_rows, codes=codes)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, labels)


def test_hard_negatives_of_few_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(make([])).count() == 0
    assert negatives.hard_negatives(make([(0, [1.0, 2.0], 1)])).count() == 0
    short = negatives.hard_negatives(make([(0, [], 1), (1, [1.0], 1), (2, [2.0, 1.0, 4.0], 2)]))
    assert [tuple(r) for r in short.collect()] == [(0, 1, 1, 2, 0, 0)]
    got = negatives.hard_negatives(make([(0, [1.0], 1), (1, [1.0], 1), (2, [0.75, 3.0], 2), (3, [0.75], 2), (4, [-1.0], 1)]))
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 3, 65536, 49152)]


def test_the_walk_is_ordered_and_stops_early(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 1000
    v = (centres[rng.integers(0, 12, 6000)] + rng.normal(size=(6000, 16)) * 20).astype(np.int64)
    books = tuple(negatives.codebook(h.astype(float), 16) for h in (v[:, :8], v[:, 8:]))
    shard = negatives.Shard(np.arange(6000), np.zeros(6000, np.int64), v, books)
    work = []
    for a in v[:20]:
        bounds = [(b, s, e) for b, s, e in shard.walk(a)]
        assert sum(e - s for _, s, e in bounds) == 6000 and all(x[0] >= y[0] for x, y in zip(bounds, bounds[1:]))
        assert all((shard.v[s:e] @ a).max() <= b for b, s, e in bounds)
        (best,), scored = shard.search(a, np.ones(6000, bool), [(np.iinfo(np.int64).min, np.iinfo(np.int64).max)], 5)
        assert best[1].tolist() == sorted((shard.v @ a).tolist(), reverse=True)[:5]
        work.append(scored)
    assert np.median(work) < 3000


def test_queries_read_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.QUERIES["op11_ngram_jaccard_join"](spark, sf).columns == ["doc_id", "n_shingles", "component_id"]
    assert queries.QUERIES["op12_spelling_variants"](spark, sf).columns == ["word", "form", "root", "n", "n_near", "form_n"]
