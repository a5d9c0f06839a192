"""Quality classifier: a byte-level convolutional network in numpy.

A text is read whole as overlapping chunks of bytes. Each byte has a small learned vector; learned filters slide over a
chunk and the maximum of each filter is its feature. A chunk's features give one number, and the mean, the least and the
greatest of a text's chunks are combined into one probability. Only the bytes of the text enter a score.

The network is fitted on the driver on ``sample_rows`` labelled texts at most (chosen by a hash of the id, texts of up to
``sample_bytes`` bytes), so fitting costs the same for any table; scoring runs over all rows in tasks. Fixed seeds make
reruns agree.

Null text counts as empty and gets the score of one chunk of padding. Repeated rows and ties do not matter, extra columns
are not read, an empty table gives an empty result. Without labels of both kinds every score is the share of label 1
(one half without any label).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import blocks, raw, strings

CHUNK, STEP = 512, 384                           # bytes of a chunk, bytes between chunk starts
DIM, FILTERS, TAPS = 4, 16, 4                    # byte vector, filters, byte pairs under a filter
PAD = 256
SAMPLE_ROWS, SAMPLE_BYTES = 2400, 24_000


def chunk_bytes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK byte numbers with PAD behind the end, first chunk of each text)."""
    size = np.diff(at)
    number = np.maximum(1, -(-(size - (CHUNK - STEP)) // STEP))
    first = np.concatenate([[0], np.cumsum(number)])
    text = np.repeat(np.arange(len(size)), number)
    start = at[text] + (np.arange(first[-1]) - first[text]) * STEP
    place = start[:, None] + np.arange(CHUNK)
    inside = place < at[text + 1][:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(place, len(data))], PAD).astype(np.int64), first


class Network:
    """Parameters and both directions; all arrays are float32."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"bytes": draw(257, DIM, scale=0.5), "filters": draw(TAPS, 2 * DIM, FILTERS, scale=0.25),
                  "bias": np.zeros(FILTERS, np.float32), "out": draw(FILTERS, scale=0.3), "shift": np.zeros(1, np.float32),
                  "join": np.array([0.5, 0.5, 0.0], np.float32)}
        self.p["bytes"][PAD] = 0

    def features(self, chunks: np.ndarray):
        """(chunks x FILTERS maxima, their places, the byte-pair vectors)."""
        n = len(chunks)
        pairs = self.p["bytes"][chunks].reshape(n * (CHUNK // 2), 2 * DIM)
        wide = CHUNK // 2 - TAPS + 1
        total = np.zeros((n, wide, FILTERS), np.float32)
        for t in range(TAPS):
            total += (pairs @ self.p["filters"][t]).reshape(n, CHUNK // 2, FILTERS)[:, t:t + wide]
        return total, pairs.reshape(n, CHUNK // 2, 2 * DIM)

    def scores(self, chunks: np.ndarray, first: np.ndarray, part: int = 256) -> np.ndarray:
        """Probability of label 1 of each text."""
        value = np.empty(len(chunks), np.float32)
        for i in range(0, len(chunks), part):
            top = self.features(chunks[i:i + part])[0].max(axis=1) + self.p["bias"]
            value[i:i + part] = np.maximum(top, 0) @ self.p["out"] + self.p["shift"]
        return _sigmoid(self._joined(value, first)[0])

    def _joined(self, value, first):
        n = np.diff(first)
        mean = np.add.reduceat(value, first[:-1]) / n
        least, most = np.minimum.reduceat(value, first[:-1]), np.maximum.reduceat(value, first[:-1])
        parts = np.stack([mean, least, most], axis=1).astype(np.float64)
        return parts @ self.p["join"].astype(np.float64), parts

    def gradients(self, chunks, first, labels, weights):
        """(loss, gradient of every parameter) on some texts."""
        total, pairs = self.features(chunks)
        top = total.max(axis=1) + self.p["bias"]
        place = total.argmax(axis=1)
        hidden = np.maximum(top, 0)
        value = hidden @ self.p["out"] + self.p["shift"]
        logit, parts = self._joined(value, first)
        score = _sigmoid(logit)
        error = ((score - labels) * weights / weights.sum())
        text = np.repeat(np.arange(len(labels)), np.diff(first))
        join = self.p["join"]
        down = error[text] * join[0] / np.diff(first)[text]
        for k, edge in ((1, parts[:, 1]), (2, parts[:, 2])):
            hit = value.astype(np.float64) == edge[text]
            share = np.bincount(text, hit, len(labels))
            down = down + hit * error[text] * join[k] / np.maximum(share, 1)[text]
        down = down.astype(np.float32)
        g = {"join": (error @ parts).astype(np.float32), "out": down @ hidden, "shift": down.sum(keepdims=True)}
        back = down[:, None] * self.p["out"][None, :] * (top > 0)
        g["bias"] = back.sum(axis=0)
        g["filters"] = np.zeros_like(self.p["filters"])
        g["bytes"] = np.zeros_like(self.p["bytes"])
        row = np.arange(len(chunks))[:, None]
        for t in range(TAPS):
            seen = pairs[row, place + t]                     # chunks x FILTERS x 2 DIM
            g["filters"][t] = np.einsum("cfd,cf->df", seen, back)
            push = back[:, :, None] * self.p["filters"][t].T[None]
            for half in (0, 1):
                np.add.at(g["bytes"], chunks[row, 2 * (place + t) + half], push[:, :, half * DIM:(half + 1) * DIM])
        g["bytes"][PAD] = 0
        loss = -(weights * np.where(labels > 0, np.log(score + 1e-9), np.log(1 - score + 1e-9))).sum() / weights.sum()
        return loss, g


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[str], labels: list[int], epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Network | float:
    """The network fitted by Adam, or the share of label 1 if there is only one kind of label."""
    y = np.array(labels, np.float64)
    if len(y) == 0 or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    net, rng = Network(seed), np.random.default_rng(seed)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    batch = max(4, min(batch, len(y) // 20))
    ready = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        ready.append(chunk_bytes(data, np.array([0, len(data)]))[0])
    step = 0
    total = max(1, epochs * -(-len(y) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), batch):
            which = order[i:i + batch]
            parts = [ready[j] for j in which]
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            _, g = net.gradients(np.concatenate(parts), first, y[which], np.ones(len(which)))
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for k, v in net.p.items():
                m, s = state[k]
                m += 0.1 * (g[k] - m)
                s += 0.01 * (g[k] ** 2 - s)
                v -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int, most: int) -> tuple[list, list]:
    """Texts and labels of ``rows`` labelled documents at most, by a hash of the id."""
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropDuplicates(["id"])
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(2 * rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.octet_length("text") <= most)
    picked = texts.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(rows).toPandas()
    return picked["text"].tolist(), picked["label"].tolist()


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    def run(batches):
        for batch in batches:
            for row, texts in blocks(strings(batch.column(1)), 1 << 18):
                if isinstance(model, float):
                    got = np.full(len(texts), model)
                else:
                    data, at = raw(texts)
                    got = model.scores(*chunk_bytes(data, at)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(got)], names=["doc_id", "score"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
