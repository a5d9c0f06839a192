"""Document operators against brute force."""
import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreline.llm import fingerprints, mixing, neardup, passages, quality, secrets
from oreline.llm.arrays import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def shingle_set(text, width, lower=True):
    words = WORD.findall((text or "").translate(LOWER) if lower else (text or ""))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute_components(rows, width, percent=80):
    """Smallest id reachable, per row number; rows are (id, text)."""
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    owners = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for o in owners[g]:
                common[o] += 1
            owners[g].append(i)
        for o, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[o]) - k):
                parent[find(i)] = find(o)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            r = find(i)
            least[r] = min(key, least.get(r, key))
    return [(key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(rows)]


def none_first(rows):
    return sorted(rows, key=lambda t: tuple((v is not None, v) for v in t))


def near_copies(spark):
    """A hub with copies that differ from each other, chains, one word in many, and a shared passage."""
    rng = np.random.default_rng(3)
    word = lambda: "w" + str(rng.integers(0, 3000))
    hub = [word() for _ in range(60)]
    rows = [" ".join(hub)]
    for _ in range(60):
        w = list(hub)
        w[int(rng.integers(0, 60))] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(200)]
    for i in range(12):
        chain = chain[:i * 15] + [word()] + chain[i * 15 + 1:]
        rows.append(" ".join(chain))
    passage = [word() for _ in range(30)]
    rows += [" ".join(passage + [word() for _ in range(12)]) for _ in range(50)]
    rows += [" ".join(["a"] * n) for n in (1, 2, 3, 4, 5, 9)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")


def test_near_duplicates(spark, documents, edge, empty):
    for docs in (documents, edge, near_copies(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        wanted = brute_components(rows, 4)
        got = neardup.near_duplicates(docs, width=4, lower=True).collect()
        assert none_first([(r.doc_id, r.n_shingles, r.component_id) for r in got]) == none_first(wanted)
        assert all(r.kept == (r.component_id is None or r.doc_id == r.component_id) for r in got)
    assert neardup.near_duplicates(empty).count() == 0


def test_keep_one_keeps_whole_rows(edge):
    kept = neardup.keep_one(edge)
    assert kept.columns == edge.columns
    # of 10 and 11 (equal), 9 and the row without an id (near), and the three equal texts one each stays
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 9, 10]


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    common, left, right = (mix(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (300, 60, 60))
    a, b = np.concatenate([common, left]), np.concatenate([right, common])
    sig = neardup.superminhash(np.concatenate([a, b]), np.array([0, 360, 720]))
    assert abs((sig[0] == sig[1]).mean() - 300 / 420) < 0.12
    assert (neardup.superminhash(a[::-1].copy(), np.array([0, 360])) == sig[:1]).all()
    one = neardup.superminhash(a[:1], np.array([0, 1]))[0] >> np.uint64(40)
    assert sorted(one.tolist()) == list(range(neardup.SLOTS))      # a single element fills the slots in steps 0, 1, 2 ...


def test_quality_measures(edge, documents, empty):
    for docs in (edge, documents):
        rows = {}
        for r in docs.collect():
            text = r.text or ""
            words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
            runs = defaultdict(list)
            for i in range(len(words) - 7):
                runs[tuple(words[i:i + 8])].append(i)
            covered = {j for at in runs.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
            rows[(r.doc_id, text)] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        got = quality.measures(docs, keep=("doc_id", "text")).collect()
        assert len(got) == docs.count()
        for r in got:
            assert rows[(r.doc_id, r.text or "")] == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert quality.good(empty).count() == 0 and quality.good(edge).columns == edge.columns


def test_quality_keeps_clean_and_drops_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = quality.judged(docs, keep=("doc_id", "quality")).collect()
    assert all(r.kept for r in rows if r.quality == 1 and not r.base_failed)
    assert sum(r.kept for r in rows if r.quality == 0) < 0.25 * sum(r.quality == 0 for r in rows)


def test_mixing(edge, documents, empty):
    for docs in (documents, edge):
        got = mixing.mix(docs).collect()
        assert len(got) == docs.count()
        total = sum(r.size for r in got)
        assert sum(r.taken for r in got) <= total
        sources = {r.source: (r.source_size, r.target) for r in got}
        # deal by weight again and again until no source is above its limit
        names = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        limit = {s: 3 * sources[s][0] for s in names}
        fixed = {}
        while True:
            rest = [s for s in names if s not in fixed]
            level = (total - sum(fixed.values())) / max(sum(weight[s] for s in rest), 1)
            over = [s for s in rest if level * weight[s] > limit[s]]
            if not over:
                break
            fixed.update((s, limit[s]) for s in over)
        for s in names:
            assert sources[s][1] == pytest.approx(fixed.get(s, level * weight[s]))
            most = max(r.size for r in got if r.source == s)
            assert abs(sum(r.taken for r in got if r.source == s) - sources[s][1]) <= 2 * max(r.size for r in got) + most
        assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in got)
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
        mixed = mixing.mixed(docs)
        assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_fingerprints(spark, documents, edge, empty):
    got = {r.doc_id: r for r in fingerprints.neighbour_fingerprints(documents, slice_mb=1).collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in documents.collect()), reverse=True)
    assert len(got) == len(rows)
    one = lambda t: tuple(x[0] for x in fingerprints.signatures(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])))
    write = lambda s: f"{1 << int(s[0])}:{s[1].decode()}:{s[2].decode()}"
    near = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (write(one(text)), write(one(edited)))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if len(text) > 300:
            near.append((r.near_edited, r.near_next))
    assert np.mean([a > b for a, b in near]) > 0.8
    assert fingerprints.neighbour_fingerprints(edge).count() == edge.count()
    assert fingerprints.neighbour_fingerprints(empty).count() == 0
    # many slices give what one slice gives
    few = {r.doc_id: r for r in fingerprints.neighbour_fingerprints(documents, slice_mb=10_000).collect()}
    assert few == got


def test_likeness_is_edit_distance():
    rng = np.random.default_rng(0)
    letters = fingerprints.ALPHABET[:6]
    left = [letters[rng.integers(0, 6, n)].tobytes() for n in rng.integers(0, 65, 200)]
    right = [bytes(x for x in s if rng.random() > 0.1) if i % 2 else letters[rng.integers(0, 6, 30)].tobytes() for i, s in enumerate(left)]
    for a, b, got in zip(left, right, fingerprints._alike(left, right)):
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i, j] = table[i - 1, j - 1] + 1 if x == y else max(table[i - 1, j], table[i, j - 1])
        run = min(7, len(a), len(b))
        shared = {a[i:i + run] for i in range(len(a) - run + 1)} & {b[i:i + run] for i in range(len(b) - run + 1)} if run else len(a) == len(b)
        wanted = (2 * table[-1, -1] / (len(a) + len(b)) if a or b else 1.0) if shared else 0.0
        assert got == pytest.approx(wanted)


def test_secrets(documents, edge, empty):
    model = secrets.default_model()
    text = 'é Token = "abcdef12" x AKIA' + "Z9" * 9 + " " + "0a" * 13 + " pass ſecret=aaaaaaaa password=abc password:defghi9 " + "q8ZkX2vLw0TgY7rBn4MsPd1" + " get_item_from_list_2024 "
    base, every = secrets.all_spans(text, model)
    assert [(text[s:e], secrets.KINDS[k]) for s, k, e in base] == [
        ('Token = "abcdef12', "assign"), ("AKIA" + "Z9" * 9, "access"), ("0a" * 13, "hex"), ("password:defghi9", "assign")]
    assert [text[s:e] for s, k, e in every if k == 3] == ["q8ZkX2vLw0TgY7rBn4MsPd1"]
    right = [model.is_random(s) == label for s, label in secrets.labelled_samples(seed=99, number=800)]
    assert np.mean(right) > 0.93
    for docs in (documents, edge):
        rows = secrets.scan(docs).collect()
        assert len(rows) == docs.count()
        clean = secrets.masked(docs)
        assert clean.columns == docs.columns and clean.count() == docs.count()
        assert secrets.scan(clean).agg(F.sum("n_access") + F.sum("n_hex")).first()[0] in (0, None)
    assert secrets.scan(empty).count() == 0


def test_secret_models_on_held_out_strings():
    model = secrets.default_model()
    rng = np.random.default_rng(4242)
    for name, letters in secrets.ALPHABETS.items():
        for length in (12, 16, 24, 40):
            drawn = ["".join(letters[j] for j in rng.integers(0, len(letters), length)) for _ in range(400)]
            assert np.mean([model.is_random(t) for t in drawn]) >= 0.9, (name, length)
    ordinary = [t for t, label in secrets.labelled_samples(seed=99, number=20000) if not label]
    assert np.mean([model.is_random(t) for t in ordinary]) <= 0.001
    for text in ("", "123456789012345", "a" * 30, "abcdefghijklmnop", "internationalization", "/usr/share/python/libraries", "----------------"):
        assert not model.is_random(text)


def test_rest_of_a_token_beside_base_spans():
    model = secrets.default_model()
    text = "x " + "0a1b" * 7 + "/q8ZkX2vLw0TgY7r" + "+AKIA" + "Z9" * 10 + " tail"
    base, every = secrets.all_spans(text, model)
    assert [text[s:e] for s, k, e in base] == ["0a1b" * 7, "AKIA" + "Z9" * 10]
    assert [text[s:e] for s, k, e in every if k == 3] == ["/q8ZkX2vLw0TgY7r+"]
    inside = [(2, 0, 9), (4, 1, 6), (8, 2, 12)]
    assert secrets._uncovered(0, 20, inside) == [(0, 2), (12, 20)] and secrets._uncovered(5, 7, inside) == []


def test_base_counts_equal_sql(documents):
    import duckdb
    planted = " api_KEY: 'k9/x.y=z secret=ab Password=\"" + "0a" * 14 + " AKIA" + "X7" * 9 + " AKIAX1 " + "beef" * 5 + " "
    documents = documents.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(planted), "text", F.lit(planted))).otherwise(F.col("text")))
    frame = documents.select("doc_id", "text").toPandas()  # noqa: F841
    word = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    want = duckdb.sql(f"""SELECT doc_id, len(list_filter(regexp_extract_all(text, '({word})["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)),
        len(list_filter(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)),
        len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda x: length(x) >= 24)) FROM frame""").fetchall()
    got = secrets.scan(documents).select("doc_id", "n_assign", "n_access", "n_hex").collect()
    assert sorted(map(tuple, got)) == sorted((i, a or 0, b or 0, c or 0) for i, a, b, c in want) and sum(r.n_hex + r.n_assign for r in got)


def brute_passages(rows, least=50):
    """Documents that share ``least`` words in a row with another document."""
    owners = defaultdict(set)
    for key, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - least + 1):
            owners[tuple(words[i:i + least])].add(key)
    return {k for ids in owners.values() if len(ids) > 1 for k in ids}


def test_passages(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = passages.repeated_passages(docs).collect()
    assert brute_passages(rows) <= {r.doc_id for r in found}
    texts = {k: WORD.findall(t) for k, t in rows}
    groups = defaultdict(list)
    for r in found:
        assert r.last_word - r.first_word + 1 >= 50 and r.last_word < len(texts[r.doc_id])
        groups[r.passage].append(r)
    for members in groups.values():              # every member is near the side it was compared with
        assert len({r.doc_id for r in members}) > 1
        sets = [shingle_set(" ".join(texts[r.doc_id][r.first_word:r.last_word + 1]), 5, lower=False) for r in members]
        best = max(sum(len(a & b) >= 0.75 * len(a | b) for b in sets) for a in sets)
        assert best == len(sets)
    assert passages.repeated_passages(empty).count() == 0
    passages.repeated_passages(edge).collect()


def test_edited_passages_are_found(spark):
    rng = np.random.default_rng(8)
    word = lambda: "w" + str(rng.integers(0, 100000))
    rows, shared = [], [word() for _ in range(120)]
    for i in range(20):
        own = list(shared)
        own[int(rng.integers(10, 110))] = word()
        rows.append((i, " ".join([word() for _ in range(80)] + own + [word() for _ in range(60)])))
    rows += [(100 + i, " ".join(word() for _ in range(300))) for i in range(20)]
    rows += [(200 + i, " ".join([word() for _ in range(70)] + shared[:30] + [word() for _ in range(70)])) for i in range(10)]
    found = {r.doc_id for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == set(range(20))


def test_compact_windows_are_a_partition():
    rng = np.random.default_rng(4)
    for n, least in ((60, 7), (200, 46), (46, 46), (30, 46), (90, 5)):
        values = rng.integers(1, 40 if n == 90 else 1 << 40, n).astype(np.uint64)
        root, start, end = passages.compact_windows(values, least)
        for i in range(n):
            for j in range(i + least - 1, n):
                holds = (start <= i) & (i <= root) & (root <= j) & (j <= end)
                assert holds.sum() == 1 and values[root[holds]][0] == values[i:j + 1].min()


def test_components(spark):
    from oreline.llm.tables import components
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    wanted = {x: root(x) for x in {v for e in edges for v in e if e[0] != e[1]}}
    for parts in (1, 7):
        got = components(spark.createDataFrame(edges, "a long, b long").repartition(parts)).collect()
        assert {r.node: r.component for r in got} == wanted and len(got) == len(wanted)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_runs_with_two_shifts():
    x = np.arange(100, dtype=np.uint32)
    y = np.concatenate([x[50:], np.arange(1000, 2000, dtype=np.uint32), x[:50]]).astype(np.uint32)
    assert sorted(passages.matched_runs(x, y, 46, 80)) == [(0, 49, 1050, 1099), (50, 99, 0, 49)]


def test_runs_that_fail_as_a_whole_give_their_parts():
    x, y, at = [], [], []
    for i in range(3):                           # three exact stretches, 7 words between them here and 30 there
        exact = list(range(1000 * i, 1000 * i + 56))
        at.append((len(x), len(x) + 55, len(y), len(y) + 55))
        x += exact + list(range(10_000 + 100 * i, 10_011 + 100 * i))
        y += exact + list(range(20_000 + 100 * i, 20_034 + 100 * i))
    assert sorted(passages.matched_runs(np.array(x, "<u4"), np.array(y, "<u4"), 46, 80)) == at
    x = np.arange(400, dtype="<u4")
    y = x.copy()
    for i in (30, 60, 90):                       # similar in the first 120 words, loosely so behind them
        y[i:i + 4] += 5000
    for i in range(120, 400, 14):
        y[i:i + 9] += 5000
    runs = passages.matched_runs(x, y, 46, 80)
    assert any(a <= 5 and b >= 115 and c <= 5 and d >= 115 for a, b, c, d in runs)


def test_both_places_of_a_passage_in_the_other_text():
    x = np.arange(60, dtype="<u4")
    y = np.concatenate([np.arange(900, 930), x, np.arange(700, 740), x]).astype("<u4")
    for shift in (None, 30, 130):
        assert sorted((c, d) for a, b, c, d in passages.matched_runs(x, y, 46, 80, shift)) == [(30, 89), (130, 189)]


def _own_words(seed):
    rng = np.random.default_rng(seed)
    return lambda n: ["w" + str(x) for x in rng.integers(0, 1_000_000, n)]


def _places(spark, rows):
    """Words of each document that are in a passage."""
    out = defaultdict(set)
    for r in passages.repeated_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")).collect():
        out[r.doc_id] |= set(range(r.first_word, r.last_word + 1))
    return out


def test_header_and_footer_around_bodies_of_different_length(spark):
    for seed in range(3):
        words = _own_words(seed)
        head, foot = words(60), words(60)
        rows = [(i, head + words(n) + foot) for i, n in enumerate((110, 140, 170, 95, 118))]
        found = _places(spark, rows)
        for k, w in rows:
            assert set(range(60)) | set(range(len(w) - 60, len(w))) <= found[k]


def _phrase_twice(seed, groups):
    """Groups of three: a phrase with two surroundings, and one text that shares the first, one that shares the second."""
    words, rows = _own_words(seed), []
    for i in range(groups):
        phrase, one, two = words(40), words(20), words(20)
        rows.append((3 * i, words(70) + phrase + one + words(80) + phrase + two + words(30)))
        rows.append((3 * i + 1, words(90) + phrase + one + words(60)))
        rows.append((3 * i + 2, words(50) + phrase + two + words(80)))
    return rows


def test_a_phrase_that_is_twice_in_the_partner(spark):
    found = _places(spark, _phrase_twice(5, 30))
    for i in range(30):
        assert set(range(70, 130)) | set(range(210, 270)) <= found[3 * i]
        assert set(range(90, 150)) <= found[3 * i + 1] and set(range(50, 110)) <= found[3 * i + 2]


def test_links_of_many_places():
    rng = np.random.default_rng(3)
    root = np.sort(rng.choice(4000, 300, replace=False))
    place = (root << 32) | (np.minimum(root, 60) << 17) | (70 << 2)
    parts = list(passages._joined(place, place[:40], size=1000))
    assert max(p.shape[1] for p in parts) <= 1000 and sum(p.shape[1] for p in parts) == 300 * 40
    links = np.concatenate(parts, axis=1)
    slim = passages._widest(links)
    covered = lambda ls: {(s, x) for a, b, s, _ in ls.T.tolist() for x in range(a, b + 1)}
    assert covered(slim) == covered(links)
    # a far shift that starts in front does not swallow what lies before its end
    assert passages.sweep_links(np.array([[0, 170, 10], [55, 229, 40], [0, -30, 500], [0, 1, 2]])) == [
        (0, 55, 0, 0, 1), (10, 40, 500, 500, 4), (170, 229, -30, -30, 2)]


def _edited_copies(seed, groups, copies=6):
    """Groups of a passage of 150 words and copies with three edited words each, 40 words apart; the rest is each text's own."""
    words, rows = _own_words(seed), []
    for g in range(groups):
        base = words(150)
        rows.append((100 * g, words(60) + base + words(40)))
        for i in range(copies):
            own = list(base)
            for at in range(18 + 6 * i, 18 + 6 * i + 81, 40):
                own[at] = words(1)[0]
            rows.append((100 * g + 1 + i, words(50 + i) + own + words(30 + i)))
    return rows


def test_copies_that_are_only_like_their_base(spark):
    rows = _edited_copies(11, 12)
    found = _places(spark, rows)
    assert {k for k, _ in rows} == set(found)
    whole = sum(len(found[k] & set(range(49 + k % 100, 199 + k % 100))) >= 120 for k, _ in rows if k % 100)
    assert whole == 12 * 6


def test_a_passage_whose_roots_are_frequent_phrases(spark):
    words = _own_words(21)
    passage = words(60)
    text = spark.createDataFrame([(1, " ".join(passage))], "doc_id long, text string")
    roots = {r.place >> 32 for r in passages.windows(text).collect()}
    frequent = [passage[max(0, r - 1):r + 6] for r in sorted(roots)]
    rows = [(i, words(40) + passage + words(30)) for i in (1, 2)]
    rows += [(100 + i, [w for f in frequent for w in words(60) + f] + words(60)) for i in range(60)]
    assert set(_places(spark, rows)) == {1, 2}


def test_links_of_a_phrase_that_is_repeated():
    def places(first, step, n):
        root = first + step * np.arange(n)
        back = np.where(np.arange(n) == 0, 7, step - 1)
        return (root << 32) | (back << 17) | ((root[-1] + 9 - root) << 2) | 1
    for step in (1, 6):
        own, other = places(20, step, 300), places(50, step, 200)
        every = np.concatenate([passages._link(np.repeat(own[i:i + 1], 200), other) for i in range(300)], axis=1)
        parts = list(passages._joined(np.flip(own), other, size=100))
        links = np.concatenate(parts, axis=1)
        assert links.shape[1] == 300 + 200 - 1 and max(p.shape[1] for p in parts) <= 200
        assert set(map(tuple, passages._widest(links).T.tolist())) == set(map(tuple, passages._widest(every).T.tolist()))
        assert passages.sweep_links(links) == passages.sweep_links(every)


def test_a_line_in_many_texts_makes_no_blocks(spark):
    words = _own_words(31)
    line, twin = words(18), words(70)
    rows = [(i, words(50) + line + words(50)) for i in range(600)] + [(1000 + i, words(20) + line + twin + words(30 + i)) for i in range(2)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    texts = docs.select(F.xxhash64("text").alias("th"), F.monotonically_increasing_id().alias("id"), "doc_id", "text")

    def cells(batches):
        for batch in batches:
            th, ids, text = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
            w = passages.Words(passages.strings(text))
            found, _, begin = passages.shingles(w.hashes(), w.at, 5)
            found = (found >> np.uint64(32)).astype("<u4")
            yield pa.RecordBatch.from_pydict({"key": [1] * len(th), "th": th, "root": [55] * len(th), "s": [0] * len(th), "doc_id": ids,
                                              "body": [found[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])]})
    table = texts.mapInArrow(cells, "key long, th long, root long, s long, doc_id long, body binary")
    kept = passages._alike_around(table, 46, 36).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {1000, 1001}


def test_passages_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = (sorted(map(tuple, passages.repeated_passages(docs.repartition(n, "doc_id")).collect())) for n in (3, 7))
    assert one == two


def test_pairs_without_a_passage_are_told_by_counts(monkeypatch):
    """texts of one repeated line, and scattered common shingles, are not searched for runs."""
    line = np.arange(31, dtype="<u4")
    like = line.copy()
    like[:12] += 5000
    loose = np.arange(300, dtype="<u4")
    loose[np.arange(300) % 3 == 0] += 9000
    searched, plain = [], passages._runs
    monkeypatch.setattr(passages, "_runs", lambda *a: searched.append(1) or plain(*a))
    assert passages.matched_runs(np.tile(line, 12), np.tile(like, 12), 46, 80, 0) == []
    assert passages.matched_runs(np.arange(300, dtype="<u4"), loose, 46, 80, 0) == []
    assert not searched
    assert passages.matched_runs(np.tile(line, 3), np.tile(line, 3), 46, 80, 0) and searched


def test_no_stretch_with_the_wanted_similarity_is_told_off():
    rng = np.random.default_rng(14)
    for _ in range(60):
        x, y = (rng.integers(0, rng.choice([6, 30, 90]), rng.integers(8, 40)).astype("<u4") for _ in "ab")
        if rng.random() < 0.5:
            y = np.concatenate([x[rng.integers(0, 5):], y[:5]])
        here, there = passages._Side(x, 6), passages._Side(y, 6)
        balance = here.balance(np.isin(x, y), 80)
        sizes = [len(set(x[a:a + 6].tolist())) for a in range(len(x) - 5)]
        assert here.least == min(sizes)
        for a in range(len(x) - 5):
            for b in range(a + 5, len(x)):
                inside = set(x[a:b + 1].tolist())
                if 100 * len(inside & set(y.tolist())) >= 80 * len(inside):
                    assert passages._possible(balance, a, b, 6)
                    assert 100 * len(set(x.tolist()) & set(y.tolist())) >= 80 * here.least
        for a, b, c, d in passages._compared(here, there, 6, 80):
            left, right = set(x[a:b + 1].tolist()), set(y[c:d + 1].tolist())
            assert 100 * len(left & right) >= 80 * len(left | right) and min(b - a, d - c) >= 5
