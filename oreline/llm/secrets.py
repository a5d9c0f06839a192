"""Secret spans: fixed patterns, and character Markov models for what no pattern names.

First-order models of the 66 symbols are trained from labelled samples: one of ordinary strings (identifiers, joined words and
runs of the alphabet), and one of random strings for every set of character classes (lower case, upper case,
digits). A candidate is a run of at least ``LEAST`` of ``[A-Za-z0-9+/_=-]`` with a letter and at least
``DISTINCT`` different characters, none five times in a row, without the parts that base spans
cover; it is a secret when the log-likelihood ratio of the random model of its classes to the ordinary one, averaged over its
characters, exceeds the threshold of its length and classes. Runs of digits alone are never candidates: a random number looks
like any other. The base patterns always count; the models only add spans.

Null text counts as empty. Rows are judged alone; repeated rows, ties and other columns do not matter; an empty table gives
an empty result.
"""

from __future__ import annotations

import builtins
import functools
import hashlib
import keyword
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import lean, strings

KINDS = ("assign", "access", "hex", "random")
# The base patterns. Letters of the first are taken in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = 12
DISTINCT = 5
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
REPEAT = re.compile(r"(.)\1{4}")
LENGTHS = (16, 24, 40)               # borders of the length classes that have thresholds of their own

# Frequent words and word parts of seven languages: ordinary strings join them.
WORDS = """the and that with for this from have are was not but they which their will would about there when your said each time
other into more some could them these than then now only over also after first people because well even under between
der die das und ist nicht mit auf ein eine sich von dem den des auch als nach wie oder aber noch wird sind werden haben durch
schon zwischen heit keit lich ung schaft isch ver ge be zer
le la les une est que dans qui pour pas sur avec sont mais nous vous leur cette comme tout plus elle ment eux aux ait eau ou
el los las una por con para del pero como sobre entre todo cuando muy desde ser dad mente ando idad
di che non sono della nel anche gli questo zione het een van niet zijn voor tion ness able ing ly""".split()

SYMBOLS = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
_INDEX = np.full(128, -1, np.int64)
_INDEX[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))


ALPHABETS = {
    "hex": string.digits + "abcdef", "lower": string.ascii_lowercase, "upper": string.ascii_uppercase, "letters": string.ascii_letters,
    "lower and digits": string.ascii_lowercase + string.digits, "upper and digits": string.ascii_uppercase + string.digits,
    "letters and digits": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/",
    "base64 of addresses": string.ascii_letters + string.digits + "-_"}
SERIES = (string.ascii_lowercase, string.ascii_uppercase, string.digits + string.ascii_lowercase, "qwertyuiopasdfghjklzxcvbnm")


def _ordinary(rng, names) -> str:
    draw = rng.random()
    if draw < 0.04:                                          # a run of the alphabet or the keyboard
        row = SERIES[int(rng.integers(len(SERIES)))]
        return row[int(rng.integers(0, len(row) - LEAST)):]
    case = int(rng.integers(4))
    if draw < 0.42:
        text = "".join(WORDS[j] for j in rng.integers(0, len(WORDS), int(rng.integers(3, 8))))
        return text.title() if case == 0 else text.upper() if case == 1 else text
    parts = [names[j] for j in rng.integers(0, len(names), int(rng.integers(1, 5)))]
    tail = str(int(rng.integers(0, 3000))) if rng.random() < 0.4 else ""
    return ("_", "-", "/", "=", "")[int(rng.integers(5))].join(p.title() if case == 0 else p.upper() if case == 1 else p for p in parts) + tail


def labelled_samples(seed: int = 7, number: int = 24000):
    """(text, is_random): seeded random strings over several alphabets, and ordinary strings, all of at least ``LEAST`` characters."""
    rng = np.random.default_rng(seed)
    alphabets = list(ALPHABETS.values())
    for i in range(number):
        letters = alphabets[i % len(alphabets)]
        yield "".join(letters[j] for j in rng.integers(0, len(letters), int(rng.integers(LEAST, 48)))), True
    names = sorted(set(keyword.kwlist + dir(builtins) + dir(str) + dir(np) + dir(re) + dir(hashlib)))
    made = 0
    while made < number:
        text = _ordinary(rng, names)
        if len(text) >= LEAST:
            made += 1
            yield text, False


def _classes(text: str) -> int:
    """1 for lower case, 2 for upper case, 4 for digits, summed over what the text holds."""
    return bool(_LOWER.search(text)) + 2 * bool(_UPPER.search(text)) + 4 * bool(_DIGIT.search(text))


_LOWER, _UPPER, _DIGIT = re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]")


class Markov:
    """Log-ratios of the transitions of random and of ordinary strings, and the thresholds between them.

    Every second sample is kept out of the fit and sets the thresholds, one for each length and set of classes: above
    ``ordinary`` of the ordinary strings and as high as the share ``missed`` of random strings allows (a fifth of it where digits,
    which words of unknown languages lack, tell them apart).
    """

    def __init__(self, samples, smoothing: float = 0.5, ordinary: float = 0.9995, missed: float = 0.04):
        n = len(SYMBOLS)
        samples = [(s, bool(label)) for s, label in samples]
        counts = {}
        for text, label in samples[::2]:
            at = self.places(text)
            for key in ((_classes(text), None) if label else ("ordinary",)):
                np.add.at(counts.setdefault(key, np.zeros((n + 1, n))), (np.concatenate([[n], at[:-1]]), at), 1)
        usual = np.log(self._rates(counts.pop("ordinary", np.zeros((n + 1, n))) + smoothing))
        # transitions of random strings lean on the frequencies of their characters; row n: the first character
        self.ratios = {key: np.log(self._rates(c + 0.02 + 20 * (c.sum(0) + 1e-9) / (c.sum() + n * 1e-9))) - usual for key, c in counts.items()}
        self.ratios.setdefault(None, -np.log(n) - usual)
        scores = {True: {}, False: {}}
        for text, label in samples[1::2]:
            value = self.score(text)
            for key in (self._bin(text), None):
                scores[label].setdefault(key, []).append(value)
        self.thresholds = {key: float(np.quantile(values, ordinary)) for key, values in scores[False].items()}
        self.thresholds.setdefault(None, 0.0)
        for key, values in scores[True].items():
            if key is not None and len(values) >= 40:
                least = float(np.quantile(values, missed / 5 if key[1] & 4 else missed))
                self.thresholds[key] = max(self.thresholds.get(key, self.thresholds[None]), least)

    @staticmethod
    def _rates(counts: np.ndarray) -> np.ndarray:
        return counts / counts.sum(axis=1, keepdims=True)

    @staticmethod
    def _bin(text: str) -> tuple[int, int]:
        return sum(len(text) >= border for border in LENGTHS), _classes(text)

    @staticmethod
    def places(text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("ascii", "ignore"), np.uint8)
        at = _INDEX[codes & 127]
        return at[at >= 0]

    def score(self, text: str) -> float:
        at = self.places(text)
        if not len(at):
            return 0.0
        ratio = self.ratios.get(_classes(text))
        if ratio is None:
            ratio = self.ratios[None]
        return float(ratio[np.concatenate([[len(SYMBOLS)], at[:-1]]), at].mean())

    def is_random(self, text: str) -> bool:
        return bool(_classes(text) & 3) and len(set(text)) >= DISTINCT and not REPEAT.search(text) and self.score(text) > self.thresholds.get(self._bin(text), self.thresholds[None])


@functools.cache
def default_model() -> Markov:
    return Markov(labelled_samples())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns: leftmost, not overlapping within a kind, failing ones dropped."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _uncovered(start: int, end: int, base: list, first: int = 0) -> list[tuple[int, int]]:
    """Parts of [start, end) outside the base spans from number ``first`` on, which come sorted by their start."""
    parts = []
    for i in range(first, len(base)):
        s, _, e = base[i]
        if s >= end:
            break
        if e > start:
            if s > start:
                parts.append((start, s))
            start = e
    if start < end:
        parts.append((start, end))
    return parts


def all_spans(text: str, model: Markov) -> tuple[list, list]:
    """(base spans, all spans) of a text."""
    base = base_spans(text)
    more, first = [], 0
    for m in CANDIDATE.finditer(text):
        while first < len(base) and base[first][2] <= m.start():
            first += 1
        more += [(s, 3, e) for s, e in _uncovered(*m.span(), base, first) if e - s >= LEAST and model.is_random(text[s:e])]
    return base, sorted(base + more)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples=None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans): spans are ``kind:start:end`` in code points."""
    model = Markov(samples) if samples is not None else default_model()

    def run(batches):
        for batch in batches:
            rows = [all_spans(t, model) for t in strings(batch.column(1)).to_pylist()]
            count = lambda k: pa.array([sum(x[1] == k for x in both[1]) for both in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[count(k) for k in range(4)], pa.array([_join(b) for b, _ in rows], pa.string()),
                 pa.array([_join(a) for _, a in rows], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(run), "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string"))


def masked(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", length_col: str | None = "n_chars", samples=None) -> DataFrame:
    """All rows of ``docs`` with every secret span replaced; ``length_col``, if it is there, is set to the new length."""
    model = Markov(samples) if samples is not None else default_model()

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for s, _, e in all_spans(text, model)[1]:
            if s >= at:
                out += [text[at:s], mask]
            at = max(at, e)
        return "".join(out) + text[at:] if out else text

    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            column = pa.array([clean(t) for t in batch.column(place).to_pylist()], pa.string())
            yield batch.set_column(place, batch.schema.field(place).with_type(pa.string()), column)
    out = docs.mapInArrow(lean(run), docs.schema)
    if length_col and length_col in docs.columns:
        new = F.length(text_col).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(new))
    return out
