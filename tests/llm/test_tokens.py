"""Pre-tokens, token counts and packing against the library."""
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from oreline.llm import packing, pretokens as P, tokens
from oreline.llm.arrays import blocks

TRICKY = [
    "", " ", "\n\n", "a", "don't we'll I've it's 's ''s 'tis '", "  two  spaces\n\n new\tline  ", "x<|endoftext|>y <|endoftext|> z",
    "ünïcode ßtraße 日本語 😀😀 ½ ² ٣", "12345 67,89 a1b2", "!!!??? ...'re 're'vex", " nbsp em \u0085", "don 't 'd'd'm'LL", "end ", "\r\n\x0b\x0c ",
]
PATH = P.tokenizer_path("byte_bpe_50k.json")


def ids(texts):
    return [e.ids for e in P.library(PATH).encode_batch(list(texts), add_special_tokens=False)]


def through_pieces(texts):
    store, out = P.pieces(PATH), []
    for _, part in blocks(pa.array(texts, pa.string()), 200):
        codes, starts, at, _ = P.split(part)
        got, first = store.ids(store.numbers(P.hashes(codes, starts), codes, starts))
        out += [got[first[a]:first[b]].tolist() for a, b in zip(at[:-1], at[1:])]
    return out


def test_pieces_equal_library():
    assert through_pieces(TRICKY * 3) == ids(TRICKY * 3)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aZé日1½ ' \n\t  .,!<|>stremvld😀")), max_size=24), min_size=1, max_size=4))
def test_pieces_equal_library_on_drawn_texts(texts):
    assert through_pieces(texts) == ids(texts)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(P.Pieces, "LIMIT", 3)
    assert through_pieces(TRICKY * 2) == ids(TRICKY * 2)


def test_counts(documents, edge, empty):
    for docs in (documents, edge):
        rows = docs.select("doc_id", "text").collect()
        wanted = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), len(x), len(x) > 1024)
                        for r, x in zip(rows, ids(r.text or "" for r in rows)))
        for head in (1 << 19, 100):
            got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit)
                         for r in tokens.token_counts(docs, head=head).collect())
            assert got == wanted
    assert tokens.token_counts(empty).count() == 0


def check_packing(rows, docs, capacity=1024):
    texts = docs.select("doc_id", "text").collect()
    wanted = []
    for r, x in zip(texts, ids(r.text or "" for r in texts)):
        x = x + [2]
        cuts = sorted({0, *range(len(x) % capacity, len(x), capacity)}) if len(x) > capacity else [0]
        wanted += [(r.doc_id, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:] + [len(x)]))]
    key = lambda t: tuple(-1 if v is None else v for v in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(wanted, key=key)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // capacity) * 1.06 + 1


def test_packing(documents, edge, empty):
    for docs in (documents, edge):
        check_packing(packing.pack(docs).collect(), docs)
    assert packing.pack(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40))
def test_plan_fits_every_piece(histogram):
    steps = packing.plan(histogram, 64)
    bins = {}
    for i, (length, rank, first, each, offset) in enumerate(steps):
        later = [s[1] for s in steps[i + 1:] if s[0] == length]
        for k in range((later[0] if later else histogram[length]) - rank):
            bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert sum(len(b) for b in bins.values()) == sum(histogram.values())
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    # as good as best fit over single pieces
    left = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [i for i, x in enumerate(left) if x >= length]
            if fits:
                left[min(fits, key=left.__getitem__)] -= length
            else:
                left.append(64 - length)
    assert len(bins) == len(left)
