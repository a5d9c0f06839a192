"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find.

Method. Every shingle of a document draws a random permutation of the signature's slots and one rank per step;
step j puts ``j + rank`` into the slot that the permutation visits at step j, and each slot keeps its minimum.
A document is done as soon as all slots hold values below the next step, so long documents need one step only.
Bands of equal slots meet in buckets; a bucket never emits all its pairs. First the member that meets most others is
compared with the rest of its bucket, and links are merged into components (union-find over the cluster); that settles
groups of near copies. Where a bucket still holds members of different components, those members go on whose rarest
shingles meet (``_prefixes``, an exact bound that frees texts which merely share a passage). They form small families; a
family is compared in blocks of bounded size (``_compared``), and only links leave a block.

Missed links. A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**36 = 6e-7. Candidates whose
signatures agree in fewer than ``SLACK`` of the slots are dropped before the exact check; at similarity 0.8 that
is over six standard deviations away. All other pairs are decided on full sets.

Null text counts as empty: no shingles, linked with nothing, a component of its own. Equal sets are one class from
the start, so copies never meet in buckets. Repeated rows of one id are one document each and fall into the same
component when their texts agree. A row without an id takes part; its component is the smallest id reachable, null
if there is none, and it is kept only in the latter case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .arrays import Words, blocks, lean, mix, shingles, strings
from .tables import components, keep_likely

BANDS, ROWS = 36, 5
SLOTS = BANDS * ROWS
SLACK = 0.6
COUNTERS = 1 << 16
BLOCK_ROWS, BLOCK_SHINGLES = 256, 200_000
_STEP = np.uint64(40)


def superminhash(hashes: np.ndarray, begin: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (rows x slots, uint64) of the sets hashes[begin[i]:begin[i + 1]]; empty sets give the maximum."""
    rows = len(begin) - 1
    sig = np.full(rows * slots, np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(begin))
    active, drawn = np.arange(len(hashes)), []
    for j in range(slots):
        if not len(active):
            break
        rand = mix(hashes[active] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        pick = j + (((rand & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        slot = pick
        for i in range(j - 1, -1, -1):           # where the earlier swaps of the permutation have moved that place
            slot = np.where(slot == drawn[i], i, slot)
        value = (np.uint64(j) << _STEP) | (mix(rand) >> np.uint64(24))
        np.minimum.at(sig, row[active] * slots + slot, value)
        full = sig.reshape(rows, slots).max(axis=1) < (np.uint64(j + 1) << _STEP)
        going = ~full[row[active]]
        if going.all():
            drawn.append(pick)
        else:
            active, pick = active[going], pick[going]
            drawn = [d[going] for d in drawn] + [pick]
    return sig.reshape(rows, slots)


def distinct_sorted(hashes: np.ndarray, begin: np.ndarray):
    """The distinct hashes of each row, ascending, and their new row offsets."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.argsort(hashes, kind="stable")
    h, r = hashes[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[fresh], r[fresh]
    back = np.argsort(r, kind="stable")
    return h[back], np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(begin) - 1))])


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[begin[1:]] - total[begin[:-1]]


def set_shingles(texts: pa.Array, width: int, lower: bool):
    """Distinct shingle hashes of each text, with row offsets."""
    words = Words(texts)
    hashes, _, begin = shingles(words.hashes(lower), words.at, width, short=True)
    return distinct_sorted(hashes, begin)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, lower: bool = False) -> DataFrame:
    """(id, th - a hash of the text -, n, s1, s2 - two hashes of the set -, bands array<long>, sketch binary) for each document."""
    def run(batches):
        for batch in batches:
            for row, texts in blocks(strings(batch.column(2))):
                hashes, begin = set_shingles(texts, width, lower)
                sig = superminhash(hashes, begin)
                count = np.diff(begin)
                band = np.zeros((len(texts), BANDS), np.uint64)
                for r in range(ROWS):
                    band = mix(band * np.uint64(0xD6E8FEB86659FD93) + sig[:, r::ROWS])
                band = mix(band + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
                sketch = (mix(sig) >> np.uint64(56)).astype(np.uint8)
                offsets = np.concatenate([[0], np.cumsum(np.where(count > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)), batch.column(1).slice(row, len(texts)), pa.array(count, pa.int64()),
                    pa.array(_sums(hashes, begin).view(np.int64)), pa.array(_sums(mix(hashes ^ np.uint64(77)), begin).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(band[count > 0].ravel().view(np.int64))),
                    pa.array([s.tobytes() for s in sketch], pa.binary())], names=["id", "th", "n", "s1", "s2", "bands", "sketch"])
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
            .mapInArrow(lean(run), "id long, th long, n long, s1 long, s2 long, bands array<long>, sketch binary"))


def _agreement(pairs: DataFrame, sig: DataFrame) -> DataFrame:
    """Pairs whose sketches agree in at least SLACK of the slots."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (2, 3))
            close = (left == right).mean(axis=1) >= SLACK
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(close))
    sides = (pairs.join(sig.select(F.col("th").alias("a"), F.col("sketch").alias("sa")), "a")
             .join(sig.select(F.col("th").alias("b"), F.col("sketch").alias("sb")), "b"))
    return sides.select("a", "b", "sa", "sb").mapInArrow(lean(run), "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of the full shingle sets; ``texts`` has (th, text)."""
    def run(batches):
        for batch in batches:
            left, right = strings(batch.column(2)), strings(batch.column(3))
            good = np.zeros(batch.num_rows, bool)
            for row, part in blocks(left):
                a, at = set_shingles(part, width, lower)
                b, bt = set_shingles(right.slice(row, len(part)), width, lower)
                for i in range(len(part)):
                    x, y = a[at[i]:at[i + 1]], b[bt[i]:bt[i + 1]]
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    good[row + i] = common > 0 and common * 100 >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct()
    # an inner join: a semi join would be pushed below the filter and move every text
    found = materialize(keep_likely(texts, ["th"], wanted).join(wanted, "th").dropDuplicates(["th"]))
    sides = (pairs.join(found.select(F.col("th").alias("a"), F.col("text").alias("ta")), "a")
             .join(found.select(F.col("th").alias("b"), F.col("text").alias("tb")), "b"))
    return sides.select("a", "b", "ta", "tb").mapInArrow(lean(run), "a long, b long")


def _ordered(cells: DataFrame) -> DataFrame:
    """(key, th, n, turn) of buckets with two members or more; ``turn``: who meets most others comes first."""
    sizes = cells.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    cells = materialize(cells.join(sizes, "key"))
    fame = cells.groupBy("th").agg(F.sum("members").alias("fame"))
    turn = F.struct((-F.col("fame")).alias("fame"), F.col("th").alias("by"))
    return materialize(cells.join(fame, "th").select("key", "th", "n", turn.alias("turn")))


def _mixed(cells: DataFrame, component: DataFrame) -> DataFrame:
    """(key, th, component) of the buckets (key, th) whose members are of different components."""
    state = cells.join(component.withColumnRenamed("node", "th"), "th", "left").withColumn("component", F.coalesce("component", "th"))
    state = materialize(state)
    mixed = state.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return materialize(state.join(materialize(mixed), "key"))


def _prefixes(texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """(key, th, n): each text's rarest shingles, as many as it may lack at the wanted similarity, and one more.

    Two sets of similarity s share s * max(n, m) elements or more, so whatever common order the shingles have, their first
    n - ceil(s * n) + 1 meet. Rare ones first: a passage that thousands of texts share is in no prefix unless it fills
    the text. The order is by counts in ``COUNTERS`` slots, a table of fixed size that goes to every task.
    """
    def count(batches):
        for batch in batches:
            total = np.zeros(COUNTERS, np.int64)
            for _, part in blocks(strings(batch.column(1))):
                found, _ = set_shingles(part, width, lower)
                total += np.bincount((found >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "times"])
    counted = texts.select("th", "text").mapInArrow(lean(count), "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times")).toPandas()
    often = np.zeros(COUNTERS, np.int64)
    often[counted["slot"].to_numpy(np.int64)] = counted["times"].to_numpy(np.int64)
    often = np.minimum(often, (1 << 31) - 1).astype(np.int32)

    def cut(batches):
        for batch in batches:
            for row, part in blocks(strings(batch.column(1))):
                found, begin = set_shingles(part, width, lower)
                keys, owners, sizes = [], [], []
                times = often[(found >> np.uint64(48)).astype(np.int64)]
                for i, th in enumerate(batch.column(0).slice(row, len(part)).to_pylist()):
                    own, seen = found[begin[i]:begin[i + 1]], times[begin[i]:begin[i + 1]]
                    n = len(own)
                    keep = n - -(-n * percent // 100) + 1 if n else 0
                    first = np.lexsort((own, seen))[:keep]
                    keys.append(own[first].view(np.int64))
                    owners.append(np.full(keep, th, np.int64))
                    sizes.append(np.full(keep, n, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, owners, sizes)], names=["key", "th", "n"])
    return texts.select("th", "text").mapInArrow(lean(cut), "key long, th long, n long")


def _compared(families: DataFrame, texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """Links (a, b) between members (th, family, component) of one family and different components.

    A family is cut into blocks of bounded size and every two blocks meet in one task, which counts the common shingles
    of all pairs at once by a matrix product; only links leave it.
    """
    def pack(batches):
        for batch in batches:
            for row, part in blocks(strings(batch.column(3))):
                found, begin = set_shingles(part, width, lower)
                body = [found[x:y].tobytes() for x, y in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(row, len(part)) for i in range(3)] + [
                    pa.array(np.diff(begin), pa.int64()), pa.array(body, pa.binary())], names=["th", "family", "component", "n", "body"])
    sets = materialize(texts.join(families, "th").select("th", "family", "component", "text")
                       .mapInArrow(lean(pack), "th long, family long, component long, n long, body binary"))
    number = sets.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("number"))
    cells = sets.join(materialize(number), "family").withColumn("own", F.pmod(F.xxhash64("th"), F.col("number")).cast("int"))
    cells = cells.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("number") - 1)))
    cells = cells.select("family", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), "own", "th", "component", "n", "body")

    def meet(table):
        th, component, n, own = (table.column(c).to_numpy() for c in ("th", "component", "n", "own"))
        found = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint64)
        row = np.repeat(np.arange(len(th)), n)
        _, column, times = np.unique(found, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        common = np.zeros((len(th), len(th)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, (start, start + 4096))
            dense = np.zeros((len(th), 4096), np.float32)
            dense[row[a:b], column[a:b] - start] = 1
            common += dense @ dense.T
        good = (common > 0) & (common * 100 >= percent * (n[:, None] + n[None, :] - common)) & (component[:, None] != component[None, :])
        if len(np.unique(own)) > 1:              # pairs inside a block are seen where the block meets itself
            good &= own[:, None] != own[None, :]
        a, b = np.nonzero(np.triu(good, 1))
        return pa.table({"a": th[a], "b": th[b]})
    return cells.groupBy("family", "i", "j").applyInArrow(meet, "a long, b long")


def _linked(classes: DataFrame, texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """(node, component) among the classes (th, n, bands, sketch); nodes without a link may be left out."""
    cells = _ordered(classes.select("th", "n", F.explode("bands").alias("key")))
    first = materialize(cells.groupBy("key").agg(F.min(F.struct("turn", "th", "n")).alias("p")).select("key", F.col("p.th").alias("p"), F.col("p.n").alias("p_n")))
    pairs = (cells.join(first, "key").where(
        (F.col("th") != F.col("p")) & (F.col("n") * 100 >= F.col("p_n") * percent) & (F.col("p_n") * 100 >= F.col("n") * percent))
        .select(F.greatest("th", "p").alias("a"), F.least("th", "p").alias("b")).distinct())
    links = verified(materialize(_agreement(pairs, classes)), texts, width, lower, percent)
    component = materialize(components(links))
    # buckets that still hold different components, without the member that has met all others there
    rest = cells.select("key", "th").join(first.select("key", F.col("p").alias("th")), ["key", "th"], "left_anti")
    left = _mixed(rest, component).select("th").distinct()
    left = materialize(keep_likely(texts, ["th"], left).join(left, "th").dropDuplicates(["th"]))
    # of these only texts whose rarest shingles meet can be alike; they form families
    rest = _mixed(_prefixes(left, width, lower, percent).select("key", "th"), component)
    star = rest.join(materialize(rest.groupBy("key").agg(F.min("th").alias("b"))), "key").select(F.col("th").alias("a"), "b")
    families = components(star).withColumnRenamed("node", "th").withColumnRenamed("component", "family")
    families = materialize(families.join(rest.select("th", "component").distinct(), "th"))
    more = _compared(families, left, width, lower, percent)
    return components(more.unionByName(component.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, lower: bool = False,
            percent: int = 80) -> DataFrame:
    """(id, th, n, component - null for empty sets -, component_id) for every row of ``docs``; ``th`` is a hash of the text."""
    sig = materialize(signatures(docs, id_col, text_col, width, lower))
    key = ["s1", "s2", "n"]
    full = sig.where("n > 0")
    leaders = materialize(full.groupBy(*key).agg(F.min("th").alias("th"), F.min("id").alias("least")))
    classes = materialize(full.join(leaders.select("th"), "th", "left_semi").dropDuplicates(["th"]).select("th", "n", "bands", "sketch"))
    texts = docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    linked = _linked(classes, texts, width, lower, percent)
    leaders = leaders.join(linked, leaders["th"] == linked["node"], "left").withColumn("component", F.coalesce("component", "th"))
    least = leaders.groupBy("component").agg(F.min("least").alias("component_id"))
    leaders = leaders.join(least, "component").select(*key, "component", "component_id")
    out = sig.select("id", "th", *key).join(materialize(leaders), key, "left")
    return out.select("id", "th", "n", "component", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, lower: bool = False,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of similarity ``percent``/100 or more.
    """
    found = grouped(docs, id_col, text_col, width, lower, percent)
    kept = F.coalesce(F.col("component_id") == F.col("id"), F.col("component_id").isNull())
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, lower: bool = True,
             percent: int = 80) -> DataFrame:
    """One row of each group of near copies, whole and with all its columns.

    It has the smallest id of the group (rows without an id come last), of several such rows the smallest text
    hash; equal rows count once. Texts without words are linked with nothing and all stay.
    """
    found = grouped(docs, id_col, text_col, width, lower, percent)
    best = found.where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("best"))
    best = materialize(best.select(F.col("best.id").alias("__id"), F.col("best.th").alias("__th")))
    wordy = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = docs.where(wordy).withColumn("__id", F.col(id_col).cast("long")).withColumn("__th", F.xxhash64(text_col))
    chosen = (named.alias("d").join(best.alias("b"), (F.col("d.__th") == F.col("b.__th")) & F.col("d.__id").eqNullSafe(F.col("b.__id")), "left_semi")
              .dropDuplicates(["__th", "__id"]).select(*docs.columns))
    return docs.where(~wordy).unionByName(chosen)
