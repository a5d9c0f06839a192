"""Exact Jaccard join of documents on word shingles, with set-relation skipping.

Equal sets are one class. The distinct shingles of a class are ordered, rare ones first, and the first n - ceil(s * n) + 1 of
them are filed in an index: two sets of similarity s or more meet in the list of their first common shingle. An entry holds
the size of its set and the position of the shingle in it.

*Lists are not read pair by pair.* In each list the set that meets most others is the pivot, and every other entry is compared
with the pivot only. A comparison keeps the differences of the two sets (``gone``: places of the pivot's shingles that the
member lacks; ``come``: shingles it has besides) when their similarity is 2 s - 1 or more.

*Answers from answers.* 1 - Jaccard is a metric. If y is linked to the pivot x, then whatever is linked to y has a similarity of
2 s - 1 or more to x, so it is among the sets whose differences from x are known. The overlap of two such sets follows from
their differences alone, |y & z| = |x| - |gone(y) | gone(z)| + |come(y) & come(z)|, without reading the sets again
(``_derived``). That settles groups of near copies of any size: members linked to one pivot are one component already, only
those between 2 s - 1 and s are met with others, in blocks of bounded size.

*Blocks skipped by position.* What may be missing are links between entries of a list that are both not linked to its pivot
and of which one is not near it (``_rest``). Lists are cut by size bands and into blocks; a
part whose positions leave too few shingles is skipped, as are parts of one component. In a block entries are sorted by position,
so that for each the tail of the list falls away. Parity bits of the sets (about one bit a shingle, ``SHORT_BITS`` bytes in a
list, in full for single pairs) bound the overlap from above; what is left is compared in full.

All bounds are exact, so no link is lost and none is added; a pair is never emitted unless both bounds let it pass.

Null text counts as empty: no shingles, linked with nothing. Repeated rows are one class. A row without an id takes part; its
component is the smallest id reachable, null if there is none. Texts are read whole. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize, shuffle_width
from .arrays import blocks, lean, mix, strings
from .neardup import _sums, set_shingles
from .runs import whole
from .tables import components, keep_likely

COUNTERS = 1 << 16                               # slots of the table of shingle counts that goes to every task
BLOCK_ROWS, BLOCK_SHINGLES = 256, 400_000
SHORT_BITS = 64                                  # bytes of parity bits at most that an entry of a list carries


def shingle_counts(docs: DataFrame, text_col: str, width: int, lower: bool) -> np.ndarray:
    """Documents a shingle is in, by slots of its hash: a table of fixed size."""
    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, part in blocks(strings(batch.column(0))):
                found, _ = set_shingles(part, width, lower)
                total += np.bincount((found >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "times"])
    told = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(count), "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times")).toPandas()
    out = np.zeros(COUNTERS, np.int64)
    out[told["slot"].to_numpy(np.int64)] = told["times"].to_numpy(np.int64)
    return np.minimum(out, (1 << 31) - 1).astype(np.int32)


def parity_bits(hashes: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of 64 or more slots, about one slot a shingle."""
    size = 1 << max(6, math.ceil(math.log2(max(1, len(hashes)))))
    odd = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int = SHORT_BITS) -> bytes:
    """The parity bits of fewer slots: slots are the low bits of a hash, so halves fold onto each other."""
    out = np.frombuffer(bits, np.uint8)
    while len(out) > size:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out.tobytes()


def differing(bits: list[np.ndarray], a: int, others: np.ndarray) -> np.ndarray:
    """At least how many shingles ``a`` and each of the others do not share."""
    out = np.zeros(len(others), np.int64)
    sizes = np.array([len(bits[i]) for i in others.tolist()])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = np.stack([bits[i] for i in others[at].tolist()])
        one = bits[a]
        one = np.frombuffer(folded(one.tobytes(), rows.shape[1]), np.uint8)
        while rows.shape[1] > len(one):
            rows = rows[:, :rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2:]
        out[at] = np.bitwise_count(rows ^ one).sum(axis=1)
    return out


def summaries(docs: DataFrame, id_col: str, text_col: str, width: int, lower: bool, percent: int) -> DataFrame:
    """(id, th - a hash of the text -, n, s1, s2 - two hashes of the set -, prefix array<long>, bits, short binary) for each document."""
    often = shingle_counts(docs, text_col, width, lower)

    def run(batches):
        for batch in batches:
            for row, texts in blocks(strings(batch.column(2))):
                found, begin = set_shingles(texts, width, lower)
                n = np.diff(begin)
                owner = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((found, often[(found >> np.uint64(48)).astype(np.int64)], owner))
                keep = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
                first = order[np.arange(len(order)) - begin[owner] < keep[owner]]
                offsets = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)
                bits = [parity_bits(found[a:b]) for a, b in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)), batch.column(1).slice(row, len(texts)), pa.array(n, pa.int64()),
                    pa.array(_sums(found, begin).view(np.int64)), pa.array(_sums(mix(found ^ np.uint64(77)), begin).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[first].view(np.int64))), pa.array(bits, pa.binary()),
                    pa.array([folded(b) for b in bits], pa.binary())], names=["id", "th", "n", "s1", "s2", "prefix", "bits", "short"])
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
            .mapInArrow(lean(run), "id long, th long, n long, s1 long, s2 long, prefix array<long>, bits binary, short binary"))


def needed(percent: int, a: Column, b: Column) -> Column:
    """The least overlap of sets of sizes a and b with the wanted similarity."""
    return F.ceil((a + b) * percent / (100 + percent) - F.lit(1e-9))


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (c, p, n, m) whose parity bits allow the wanted similarity."""
    def run(batches):
        for batch in batches:
            left, right = ([np.frombuffer(b, np.uint8) for b in batch.column(i).to_pylist()] for i in (4, 5))
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.array([differing([x, y], 0, np.array([1]))[0] for x, y in zip(left, right)], np.int64)
            good = (total - apart) * (100 + percent) >= 2 * percent * total
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)], names=["c", "p", "n", "m"]).filter(pa.array(good, pa.bool_()))
    sides = (pairs.join(classes.select(F.col("th").alias("c"), F.col("bits").alias("x")), "c")
             .join(classes.select(F.col("th").alias("p"), F.col("bits").alias("y")), "p"))
    return sides.select("c", "p", "n", "m", "x", "y").mapInArrow(lean(run), "c long, p long, n long, m long")


def compared(pairs: DataFrame, texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """(c, p, n, m, common, gone, come) of the pairs (c, p, n, m) with a similarity of ``percent``/100 or more.

    The members of a pivot p follow it in a sorted stream, which holds one pivot's set at a time; the members of a pivot are dealt
    over blocks of bounded size, so its text is sent once for each block.
    """
    pairs = materialize(pairs)
    wanted = materialize(pairs.select(F.explode(F.array("c", "p")).alias("th")).distinct())
    # an inner join: a semi join would be pushed below the filter and move every text
    found = materialize(keep_likely(texts, ["th"], wanted).join(wanted, "th").dropDuplicates(["th"]))
    sizes = pairs.groupBy("p").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("number"))
    members = pairs.join(sizes, "p").select("p", "c", F.pmod(F.xxhash64("c"), F.col("number")).cast("int").alias("block"))
    members = materialize(members)
    rows = members.join(found, members["c"] == found["th"]).select("p", "block", F.lit(1).alias("kind"), "c", "text")
    heads = members.select("p", "block").distinct().join(found, F.col("p") == F.col("th")).select("p", "block", F.lit(0).alias("kind"), F.col("p").alias("c"), "text")
    both = rows.unionByName(heads).repartition(shuffle_width(pairs.sparkSession), "p", "block").sortWithinPartitions("p", "block", "kind", "c")

    def run(batches):
        pivot = np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            p, kind, c = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for row, part in blocks(strings(batch.column(4))):
                sets, begin = set_shingles(part, width, lower)
                for i in range(len(part)):
                    own = sets[begin[i]:begin[i + 1]]
                    if not kind[row + i]:
                        pivot = own
                        continue
                    at = np.searchsorted(pivot, own)
                    there = at < len(pivot)
                    there[there] = pivot[at[there]] == own[there]
                    common = int(there.sum())
                    if common * 100 >= percent * (len(own) + len(pivot) - common):
                        left = np.ones(len(pivot), bool)
                        left[at[there]] = False
                        out.append((c[row + i], p[row + i], len(own), len(pivot), common, np.flatnonzero(left).astype("<i4").tobytes(), own[~there].tobytes()))
            kinds = (pa.int64(),) * 5 + (pa.binary(),) * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(7)], names=["c", "p", "n", "m", "common", "gone", "come"])
    return both.mapInArrow(lean(run), "c long, p long, n long, m long, common long, gone binary, come binary")


def _one_each(a, b, component):
    """Of links between rows a and b one for each pair of components."""
    x, y = np.minimum(component[a], component[b]), np.maximum(component[a], component[b])
    if not len(a):
        return a, b
    _, first = np.unique(np.stack([x, y]), axis=1, return_index=True)
    return a[first], b[first]


def _dealt(rows: DataFrame, keys: list[str], weight: Column, by: str, only: Column) -> DataFrame:
    """Every two blocks of bounded size of a group meet under one (i, j); ``own`` is a row's block.

    ``only`` is an aggregate of a group; groups for which it does not hold are left out.
    """
    number = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(weight) / BLOCK_SHINGLES)).cast("int").alias("number")
    number = rows.groupBy(*keys).agg(number, only.alias("only")).where("only").drop("only")
    cells = rows.join(materialize(number), keys).withColumn("own", F.pmod(F.xxhash64(by), F.col("number")).cast("int"))
    cells = cells.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("number") - 1)))
    cells = cells.withColumn("i", F.least("own", "met")).withColumn("j", F.greatest("own", "met")).drop("met", "number")
    return cells.repartition(shuffle_width(rows.sparkSession), *keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _derived(near: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets near one pivot and of different components, from their differences."""
    state = _with_component(near, component, "c").select("p", "c", "n", "m", "gone", "come", "component")

    def run(batches):
        for (_, i, j), table in whole(batches, ["p", "i", "j"]):
            c, n, m, component, own = (table.column(x).to_numpy() for x in ("c", "n", "m", "component", "own"))
            gone = [np.frombuffer(b, "<i4").astype(np.uint64) for b in table.column("gone").to_pylist()]
            come = [np.frombuffer(b, np.uint64) for b in table.column("come").to_pylist()]
            lost = np.array([len(x) for x in gone], np.float32)
            shared = _common(gone), _common(come)
            common = m[0] - (lost[:, None] + lost[None, :] - shared[0]) + shared[1]
            good = (common * 100 >= percent * (n[:, None] + n[None, :] - common)) & (component[:, None] != component[None, :])
            if i != j:                           # pairs inside a block are seen where the block meets itself
                good &= own[:, None] != own[None, :]
            a, b = _one_each(*np.nonzero(np.triu(good, 1)), component)
            yield pa.RecordBatch.from_arrays([pa.array(c[a], pa.int64()), pa.array(c[b], pa.int64())], names=["a", "b"])
    mixed = F.min("component") < F.max("component")
    weight = (F.octet_length("gone") / 4 + F.octet_length("come") / 8).cast("long")
    return _dealt(state, ["p"], weight, "c", mixed).mapInArrow(lean(run), "a long, b long")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of all pairs of sets, by a matrix product over blocks of elements."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = times[column] > 1
    row, column = row[twice], np.unique(column[twice], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (start, start + 4096))
        dense = np.zeros((len(sets), 4096), np.float32)
        dense[row[a:b], column[a:b] - start] = 1
        out += dense @ dense.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _with_component(rows: DataFrame, component: DataFrame, by: str) -> DataFrame:
    named = component.select(F.col("node").alias(by), "component")
    return rows.join(named, by, "left").withColumn("component", F.coalesce("component", by))


def _rest(lists: DataFrame, near: DataFrame, component: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidates (c, p, n, m) among entries of a list that are both not linked to its pivot, one of them not near it."""
    linked = F.col("common") * 100 >= percent * (F.col("n") + F.col("m") - F.col("common"))
    told = near.select("c", "p", linked.alias("linked"), F.lit(False).alias("far"))
    state = lists.where("c <> p").join(told, ["c", "p"], "left").withColumn("far", F.coalesce("far", F.lit(True)))
    state = state.where(~F.coalesce("linked", F.lit(False)))
    state = materialize(_with_component(state, component, "c").select("key", "c", "n", "pos", "far", "component"))
    # sets of similar size are in one band or in neighbouring ones; a group holds a band and the next
    band = F.floor(F.log("n") / -math.log(percent / 100)).cast("int")
    state = state.withColumn("band", band).withColumn("group", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    mixed = state.groupBy("key", "group").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("far").alias("far"), F.min("pos").alias("front"))
    mixed = materialize(mixed.where("lo < hi and far").select("key", "group", "front"))
    # positions may not add up to more than the sets may differ by; the larger set has at most n / similarity shingles
    reach = F.col("n") * ((1 + 100 / percent) * (1 - 2 * percent / (100 + percent))) + F.lit(1e-6)
    state = materialize(state.join(mixed, ["key", "group"]).where(F.col("pos") + F.col("front") <= reach).drop("front"))
    state = state.join(classes.select(F.col("th").alias("c"), F.col("short").alias("bits")), "c")

    def run(batches):
        for (_, group, i, j), table in whole(batches, ["key", "group", "i", "j"]):
            if table.num_rows < 2:
                continue
            table = table.sort_by("pos")
            c, n, pos, far, component, band, own = (table.column(x).to_numpy() for x in ("c", "n", "pos", "far", "component", "band", "own"))
            bits = [np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()]
            out = []
            for a in range(len(c) - 1):
                most = n[a] * (1 + 100 / percent)
                end = np.searchsorted(pos, most * (1 - 2 * percent / (100 + percent)) - pos[a] + 1e-6, "right")
                b = np.arange(a + 1, max(a + 1, int(end)))
                total = n[a] + n[b]
                least = np.ceil(total * percent / (100 + percent) - 1e-9)
                fits = (component[b] != component[a]) & (far[b] | far[a]) & ((band[b] == group) | (band[a] == group))
                fits &= (total - pos[b] - pos[a] >= 2 * least) & (np.minimum(n[b] - pos[b], n[a] - pos[a]) >= least)
                fits &= (n[b] * 100 >= n[a] * percent) & (n[a] * 100 >= n[b] * percent)
                if i != j:
                    fits &= own[b] != own[a]
                b = b[fits]
                if len(b):
                    out += [(a, x) for x in b[(total[fits] - differing(bits, a, b)) >= 2 * least[fits]].tolist()]
            if out:
                a, b = np.array(out).T
                up = c[a] > c[b]
                a, b = np.where(up, a, b), np.where(up, b, a)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (c[a], c[b], n[a], n[b])], names=["c", "p", "n", "m"])
    mixed = F.min("component") < F.max("component")
    return _dealt(state, ["key", "group"], F.lit(0), "c", mixed & F.max("far")).mapInArrow(lean(run), "c long, p long, n long, m long").distinct()


def _linked(classes: DataFrame, texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """(node, component) among the classes (th, n, prefix, bits, short); nodes without a link may be left out."""
    wide = max(1, 2 * percent - 100)
    cells = classes.select(F.col("th").alias("c"), "n", F.posexplode("prefix").alias("pos", "key"))
    sizes = cells.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    cells = materialize(cells.join(sizes, "key"))
    fame = cells.groupBy("c").agg(F.sum("members").alias("fame"))
    cells = materialize(cells.join(fame, "c").select("key", "c", "n", "pos", "fame"))
    pivots = cells.groupBy("key").agg(F.min(F.struct((-F.col("fame")).alias("less"), "c", "n")).alias("pivot"))
    lists = materialize(cells.join(pivots, "key").select("key", "c", "n", "pos", F.col("pivot.c").alias("p"), F.col("pivot.n").alias("m")))
    pairs = lists.where((F.col("c") != F.col("p")) & (F.col("n") * 100 >= F.col("m") * wide) & (F.col("m") * 100 >= F.col("n") * wide))
    pairs = pairs.select("c", "p", "n", "m").distinct()
    near = materialize(compared(_possible(pairs, classes, wide), texts, width, lower, wide))
    is_link = F.col("common") * 100 >= percent * (F.col("n") + F.col("m") - F.col("common"))
    as_link = lambda found: found.where(is_link).select(F.greatest("c", "p").alias("a"), F.least("c", "p").alias("b"))
    as_edge = lambda known: known.select(F.col("node").alias("a"), F.col("component").alias("b"))
    component = materialize(components(as_link(near)))
    component = materialize(components(_derived(near, component, percent).unionByName(as_edge(component))))
    more = compared(_possible(_rest(lists, near, component, classes, percent), classes, percent), texts, width, lower, percent)
    return components(as_link(more).unionByName(as_edge(component)))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, lower: bool = True, percent: int = 90) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Sets of word shingles (the whole sequence of shorter texts) link when 100 * intersection >= ``percent`` * union;
    ``component_id`` is the smallest id reachable.
    """
    told = materialize(summaries(docs, id_col, text_col, width, lower, percent))
    key = ["s1", "s2", "n"]
    full = told.where("n > 0")
    # copies are combined before the shuffle
    body = F.min_by(F.struct("prefix", "bits", "short"), "th").alias("body")
    classes = materialize(full.groupBy(*key).agg(F.min("th").alias("th"), F.min("id").alias("least"), body).select(*key, "th", "least", "body.*"))
    leaders, classes = classes.select(*key, "th", "least"), classes.select("th", "n", "prefix", "bits", "short")
    texts = docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    linked = _linked(classes, texts, width, lower, percent)
    leaders = leaders.join(linked, leaders["th"] == linked["node"], "left").withColumn("component", F.coalesce("component", "th"))
    least = leaders.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(leaders.join(least, "component").select(*key, "component_id"))
    out = told.select("id", *key).join(named, key, "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
