"""Context-triggered piecewise hashing: fingerprints of texts and their likeness.

A rolling hash of the last seven bytes ends a chunk wherever its low bits are zero, so boundaries depend on content
and survive insertions. Each chunk is hashed to one of 64 characters. A fingerprint is ``size:first:second``: the
signature at block size ``size`` (a power of two, the smallest that yields at most 64 chunks) and at twice that size.
Two fingerprints are comparable when a block size is common to both; likeness is 1 minus the insertions and deletions
between the signatures over their joint length, if they share a run of seven characters (or all of a shorter one),
else 0. Signatures have at most 64 characters, so the edit distance runs in one machine word per pair.

Null text counts as empty, its fingerprint is ``1::``; two empty texts are alike (1), an empty and another are not (0).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import shuffle_width
from .arrays import mix, powers, raw, strings

WINDOW, LENGTH, RUN = 7, 64, 7
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(0xC7F))
_LEVELS = 40


def _rolling(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the last WINDOW bytes at each place, within its text."""
    values = _BYTES[data]
    out = values.copy()
    for back in range(1, WINDOW):
        out[back:] += values[:-back] * np.uint64(pow(0x9E3779B97F4A7C15, back, 1 << 64))
    for row in np.flatnonzero(np.diff(at) > 0) if len(at) > 2 else ():
        start, end = at[row], min(at[row] + WINDOW - 1, at[row + 1])
        if start:                                # the first bytes of a text do not see the text before it
            head = values[start:end].copy()
            for back in range(1, end - start):
                head[back:] += values[start:end - back] * np.uint64(pow(0x9E3779B97F4A7C15, back, 1 << 64))
            out[start:end] = head
    return mix(out)


def signatures(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """(block size exponent, signature, signature at twice the size) of each text data[at[i]:at[i + 1]]."""
    rows = len(at) - 1
    n = len(data)
    if not n:
        return np.zeros(rows, np.int64), [b""] * rows, [b""] * rows
    rolled = _rolling(data, at)
    up, down = powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:n], dtype=np.uint64)])
    exponent = np.zeros(rows, np.int64)
    first, second = [b""] * rows, [b""] * rows
    ends = [np.arange(1, n + 1)]
    for k in range(_LEVELS):                     # a boundary at size 2**k has k zero bits in its rolling hash
        ends.append(ends[-1][(rolled[ends[-1] - 1] >> np.uint64(k)) & np.uint64(1) == 0])
        if not len(ends[-1]):
            break
    counts = np.stack([np.searchsorted(e, at[1:], "right") - np.searchsorted(e, at[:-1], "right") for e in ends])
    fits = counts < LENGTH                       # the rest after the last boundary is one more chunk
    exponent = np.where(fits.any(axis=0), fits.argmax(axis=0), len(ends) - 1)
    for out, shift in ((first, 0), (second, 1)):
        for k in np.unique(exponent):
            which = np.flatnonzero(exponent == k)
            e = ends[min(k + shift, len(ends) - 1)] if k + shift < len(ends) else np.zeros(0, np.int64)
            lo, hi = np.searchsorted(e, at[which], "right"), np.searchsorted(e, at[which + 1], "right")
            for row, a, b in zip(which.tolist(), lo.tolist(), hi.tolist()):
                cut = e[a:b]
                start, stop = at[row], at[row + 1]
                if stop == start:
                    continue
                if not len(cut) or cut[-1] != stop:
                    cut = np.append(cut, stop)
                begin = np.concatenate([[start], cut[:-1]])
                value = mix((sums[cut] - sums[begin]) * down[begin])
                out[row] = ALPHABET[(value >> np.uint64(58)).astype(np.int64)][:LENGTH].tobytes()
    return exponent, first, second


def _codes(signatures_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, signatures_), np.int64, len(signatures_))
    joined = b"".join(s.ljust(LENGTH, b"\0") for s in signatures_)
    table = np.full(256, 64, np.uint8)
    table[ALPHABET] = np.arange(64)
    return table[np.frombuffer(joined, np.uint8).reshape(-1, LENGTH)], size


def _alike(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Likeness of signatures pair by pair, by the longest common subsequence held in the bits of one word."""
    pairs = len(left)
    a, na = _codes(left)
    b, nb = _codes(right)
    places = np.zeros((pairs, 65), np.uint64)    # for each character the bits of its places in a
    rows = np.arange(pairs)
    for i in range(LENGTH):
        live = i < na
        places[rows[live], a[live, i]] |= np.uint64(1) << np.uint64(i)
    state = np.full(pairs, np.iinfo(np.uint64).max, np.uint64)
    for j in range(LENGTH):
        hit = state & places[rows, b[:, j]]
        new = (state + hit) | (state - hit)
        state = np.where(j < nb, new, state)
    used = np.where(na >= 64, np.iinfo(np.uint64).max, (np.uint64(1) << np.minimum(na, 63).astype(np.uint64)) - np.uint64(1))
    common = np.bitwise_count(~state & used).astype(np.int64)
    score = np.where(na + nb > 0, 2 * common / np.maximum(na + nb, 1), 1.0)
    run = np.minimum(RUN, np.minimum(na, nb))
    shared = np.zeros(pairs, bool)
    for width in np.unique(run):
        which = np.flatnonzero(run == width)
        if not width:
            shared[which] = na[which] == nb[which]
            continue
        grams = []
        for codes, size in ((a, na), (b, nb)):
            gram = np.zeros((len(which), LENGTH - width + 1), np.uint64)
            for i in range(width):
                gram = (gram << np.uint64(6)) | (codes[which, i:LENGTH - width + 1 + i] & 63).astype(np.uint64)
            gram[np.arange(LENGTH - width + 1)[None, :] > (size[which] - width)[:, None]] = np.iinfo(np.uint64).max
            grams.append(np.sort(gram + (np.arange(len(which), dtype=np.uint64) << np.uint64(44))[:, None] * (gram != np.iinfo(np.uint64).max), axis=1))
        x, y = (g[g != np.iinfo(np.uint64).max] for g in grams)
        shared[which[np.unique((np.intersect1d(x, y) >> np.uint64(44)).astype(np.int64))]] = True
    return np.where(shared, score, 0.0)


def likeness(left, right) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints given as (exponents, first, second)."""
    (ka, a1, a2), (kb, b1, b2) = left, right
    out = np.zeros(len(ka))
    for gap, pairs in ((0, ((a1, b1), (a2, b2))), (1, ((a2, b1),)), (-1, ((a1, b2),))):
        which = np.flatnonzero(kb - ka == gap)
        for x, y in pairs:
            if len(which):
                got = _alike([x[i] for i in which], [y[i] for i in which])
                # at equal sizes the finer signature decides; the coarser one helps when the finer shares no run
                out[which] = np.maximum(out[which], got)
    empty_a, empty_b = (np.fromiter((not s for s in side[1]), bool, len(ka)) for side in (left, right))
    out[empty_a != empty_b] = 0.0
    out[empty_a & empty_b] = 1.0
    return out


def _written(prints) -> list[str]:
    return [f"{1 << int(k)}:{x.decode()}:{y.decode()}" for k, x, y in zip(*prints)]


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_mb: int = 4) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text is the text whose last floor(n/2) characters are replaced by the first as many of the next
    document by descending id (after the last, the first). Rows of one id follow by a hash of the text; rows without
    an id come last.

    One shuffle: texts go to slices of the id order, cut at quantiles of the ids so that slices hold about ``slice_mb``
    MB each, and are sorted there; the first row of each slice is also sent to the slice before it.
    """
    key = F.col(id_col).cast("long")
    base = docs.select(key.alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = base.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    number = max(1, min(1 << 12, -(-size // (slice_mb << 20))))
    cuts = base.agg(F.percentile_approx("doc_id", [i / number for i in range(1, number)] or [0.5], 10 * number).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts)) if number > 1 else []
    # slice numbers rise with descending ids; nulls are last
    slot = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.lit(len(cuts)) - _below(F.col("doc_id"), cuts))
    tagged = base.withColumn("slice", slot.cast("int")).withColumn("tie", F.xxhash64("text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("back"), F.col("tie").alias("tie"))
    heads = tagged.groupBy("slice").agg(F.min(order).alias("head")).orderBy("slice").collect()      # one row a slice
    ahead = {heads[i]["slice"]: heads[i - 1]["slice"] for i in range(len(heads))}      # the first goes to the last
    names = [(h["slice"], ahead[h["slice"]], h["head"]["none"], h["head"]["back"], h["head"]["tie"]) for h in heads]
    guests = base.sparkSession.createDataFrame(names, "slice int, to int, none boolean, back long, tie long")
    guests = F.broadcast(guests.groupBy("slice").agg(F.first(F.struct("to", "none", "back", "tie")).alias("guest")))
    sent = tagged.join(guests, "slice", "left")
    is_head = ((F.col("guest.none") == F.col("doc_id").isNull()) & F.col("guest.back").eqNullSafe(-F.col("doc_id")) & (F.col("guest.tie") == F.col("tie")))
    places = F.when(F.coalesce(is_head, F.lit(False)), F.array(F.struct(F.col("slice").alias("to"), F.lit(0).alias("guest")),
                                                               F.struct(F.col("guest.to").alias("to"), F.lit(1).alias("guest"))))
    places = F.coalesce(places, F.array(F.struct(F.col("slice").alias("to"), F.lit(0).alias("guest"))))
    sent = sent.withColumn("place", F.explode(places)).select("place.to", "place.guest", "doc_id", "tie", "text")
    dealt = (sent.repartition(max(shuffle_width(docs.sparkSession), 1), "to")
             .sortWithinPartitions("to", "guest", F.col("doc_id").desc_nulls_last(), "tie"))
    return dealt.select("to", "guest", "doc_id", "text").mapInArrow(
        _edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _below(column, cuts: list):
    """How many of the sorted cuts lie at or below the value, by a search over an array."""
    if not cuts:
        return F.lit(0)
    array = F.array(*[F.lit(int(c)) for c in cuts])
    return F.size(F.filter(array, lambda c: c <= column))


def _edited(batches):
    """Rows come sorted by slice and order; each is finished when the next one of its slice is there."""
    schema = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(rows):
        """rows: (id, text, next text)."""
        own = [t for _, t, _ in rows]
        texts, number = [], {}                   # a next text is mostly the own text of the row behind it
        for t in own + [n for _, _, n in rows]:
            if id(t) not in number:
                number[id(t)] = len(texts)
                texts.append(t)
        edited = []
        for _, t, n in rows:
            half = len(t) // 2
            edited.append(t[:len(t) - half] + n[:half])
        every = []
        for part in (texts, edited):
            column = pa.array(part, pa.string())
            data, at = raw(column)
            every.append(signatures(data, at))
        pick = lambda side: tuple(np.array(x, object)[side] if isinstance(x, list) else x[side] for x in every[0])
        mine, following = (pick([number[id(r[i])] for r in rows]) for i in (1, 2))
        changed = every[1]
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _, _ in rows], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(_written(mine), pa.string()),
            pa.array(_written(changed), pa.string()), pa.array(likeness(mine, changed)), pa.array(likeness(mine, following))], names=schema)

    ready, held, size = [], None, 0              # held: the row that waits for its next, with its slice
    for batch in batches:
        slices, guests, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        texts = strings(batch.column(3))
        for i, (to, guest, key) in enumerate(zip(slices, guests, ids)):
            text = texts[i].as_py()
            if held is not None and held[0] == to:
                ready.append((held[1], held[2], text))
                size += len(held[2]) + len(text)
            held = None if guest else (to, key, text)
            if size > 1 << 20:
                yield finish(ready)
                ready, size = [], 0
    if ready:
        yield finish(ready)
