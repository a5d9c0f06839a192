"""Pre-tokens of the byte-level BPE files, found for whole blocks of text at once.

The library's split pattern is
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
All of it can be said with runs of letters, numbers, white space and other characters: a space joins the run after
it, longer white space leaves its last character to the next token, and a contraction cuts an apostrophe run of its
own together with the letters behind it. The special string of the file is a token of its own wherever it stands.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa

from .arrays import CACHES, mix, powers, raw

SPECIAL = "<|endoftext|>"                        # fixed value: the special token of the file
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point; white space as Unicode's White_Space property."""
    out = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            out[code] = LETTER
        elif kind == "N":
            out[code] = NUMBER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def split(texts: pa.Array):
    """(codes, starts, rows, special): code points, where each pre-token starts, first token of each row, special ones.

    Tokens end where the next one starts; the last one ends with ``codes``.
    """
    data, at = raw(texts)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(codes)
    rows = len(at) - 1
    # row offsets in code points
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = lead[at]
    if not n:
        return codes, np.zeros(0, np.int64), np.zeros(rows + 1, np.int64), np.zeros(0, bool)
    kind = _classes()[codes]
    edge = np.zeros(n + 1, bool)                 # a text or special string begins here
    edge[at] = True
    special = _special_places(codes, at)
    if len(special):
        edge[special] = edge[special + len(SPECIAL)] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # contractions: an apostrophe alone in its run, not behind a joined space, and letters behind it
    quote = np.flatnonzero((codes == 39) & start)
    if len(quote):
        joined = np.zeros(len(quote), bool)
        has = quote > 0
        joined[has] = (codes[quote[has] - 1] == 32) & ~edge[quote[has]]
        quote = quote[~joined]
        nxt = np.minimum(quote + 1, n - 1)
        quote = quote[(quote + 1 < n) & ~edge[nxt] & (kind[nxt] == LETTER)]
        for size in (1, 2):
            ends = quote + 1 + size
            fits = ends <= n
            q, e = quote[fits], ends[fits]
            good = np.zeros(len(q), bool)
            for tail in _CONTRACTIONS:
                if len(tail) == size:
                    good |= np.logical_and.reduce([codes[q + 1 + i] == ord(c) for i, c in enumerate(tail)])
            if size == 2:
                good &= ~edge[q + 2]
            q, e = q[good], e[good]
            start[q + 1] = False                 # the letters belong to the apostrophe
            start[e[e < n]] = True
    # white space: the last character of a run before other text leaves the run; a space joins the text
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last] = True
    blank = last[codes[last] == 32]
    start[blank + 1] = False
    inside = np.zeros(n, bool)
    for i in range(1, len(SPECIAL)):
        inside[special + i] = True
    start[inside] = False
    starts = np.flatnonzero(start)
    is_special = np.zeros(n + 1, bool)
    is_special[special] = True
    return codes, starts, np.searchsorted(starts, at), is_special[starts]


def _special_places(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    places = np.flatnonzero(codes[:len(codes) - len(SPECIAL) + 1] == ord(SPECIAL[0])) if len(codes) >= len(SPECIAL) else np.zeros(0, np.int64)
    for i, c in enumerate(SPECIAL):
        places = places[codes[places + i] == ord(c)]
    row = np.searchsorted(at, places, "right")
    return places[at[np.minimum(row, len(at) - 1)] >= places + len(SPECIAL)]


@functools.lru_cache(maxsize=1)
def _code_values() -> np.ndarray:
    return mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x51ED27))


def hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(codes))
    values = _code_values()[codes]
    values *= up[:len(values)]
    return mix(np.add.reduceat(values, starts) * down[starts])


def text_of(codes: np.ndarray, starts: np.ndarray, which: np.ndarray) -> list[str]:
    """The strings of the tokens numbered ``which``."""
    ends = np.append(starts[1:], len(codes))
    whole = codes.tobytes().decode("utf-32-le")
    return [whole[s:e] for s, e in zip(starts[which].tolist(), ends[which].tolist())]


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer of a file, one thread; loaded once in each worker."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Pieces:
    """Ids of pre-tokens by hash, filled with the library's own encoding of each distinct pre-token.

    One object lives in each worker. It forgets everything when it holds ``LIMIT`` tokens, so its memory is
    bounded; forgetting costs time, never results.
    """

    LIMIT, SLOTS = 500_000, 18

    def __init__(self, path: str):
        self.tokenizer = library(path)
        self.clear()

    def clear(self):
        self.keys, self.begin, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.where = np.zeros(0, np.int64)       # sorted key -> number of the token
        self.flat = np.zeros(0, np.uint32)
        self.slot_key = np.zeros(1 << self.SLOTS, np.uint64)
        self.slot_no = np.full(1 << self.SLOTS, -1, np.int64)

    def numbers(self, found: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of each token; ``begin`` and ``count`` then give its place in ``flat``."""
        if len(self.keys) > self.LIMIT:
            self.clear()
        slot = (found >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        out = self.slot_no[slot]
        out[self.slot_key[slot] != found] = -1
        miss = np.flatnonzero(out < 0)
        if len(miss):
            unique, first, back = np.unique(found[miss], return_index=True, return_inverse=True)
            place = np.searchsorted(self.keys, unique)
            known = place < len(self.keys)
            known[known] = self.keys[place[known]] == unique[known]
            number = np.full(len(unique), -1, np.int64)
            number[known] = self.where[place[known]]
            new = np.flatnonzero(~known)
            if len(new):
                texts = text_of(codes, starts, miss[first[new]])
                ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
                number[new] = len(self.count) + np.arange(len(new))
                self.begin = np.append(self.begin, len(self.flat) + np.cumsum(size) - size)
                self.count = np.append(self.count, size)
                self.flat = np.append(self.flat, flat)
                self.where = np.insert(self.where, place[new], number[new])
                self.keys = np.insert(self.keys, place[new], unique[new])
            out[miss] = number[back]
            at = (unique >> np.uint64(64 - self.SLOTS)).astype(np.int64)
            self.slot_key[at], self.slot_no[at] = unique, number
        return out

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the first id of each token (with the end appended)."""
        size = self.count[numbers]
        ends = np.cumsum(size)
        starts = ends - size
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(self.begin[numbers] - starts, size) + np.arange(total)
        return self.flat[place], np.append(starts, total)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def forget() -> None:
    """Drop the tokenizers and their pieces; a later task loads them again."""
    pieces.cache_clear()
    library.cache_clear()


CACHES.append(forget)
