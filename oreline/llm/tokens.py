"""Token counts from distinct pre-tokens.

The pieces of each distinct pre-token of the corpus are counted once, with the library. Documents then need only their
pre-token frequencies: the most frequent pre-tokens (a table of fixed size, ``HEAD`` entries at most) are looked up in the
task that reads the text, all others go through a join on their hash, and the products are summed. No ids of a document
are ever made.

Null text counts as empty (0 tokens). Each row is counted on its own, repeated rows too; extra columns are not read. An
empty table gives an empty result. Pre-tokens are told apart by a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import pretokens as P
from .arrays import blocks, raw, strings

HEAD = 1 << 19
TEXT_BLOCK = 4 << 20


def vocabulary(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(hash, frequency, pieces) of every distinct pre-token of the corpus."""
    path = tokenizer or P.tokenizer_path("byte_bpe_50k.json")

    def distinct(batches):
        for batch in batches:
            for _, texts in blocks(strings(batch.column(0)), TEXT_BLOCK):
                codes, starts, _, _ = P.split(texts)
                _, first, count = np.unique(P.hashes(codes, starts), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(P.text_of(codes, starts, first), pa.string()), pa.array(count, pa.int64())],
                                                 names=["token", "frequency"])

    def counted(batches):
        tokenizer = P.library(path)
        for batch in batches:
            tokens = batch.column(0)
            if not len(tokens):
                continue
            data, at = raw(tokens)
            codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            encoded = tokenizer.encode_batch(tokens.to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([
                pa.array(P.hashes(codes, lead[at[:-1]]).view(np.int64)), batch.column(1),
                pa.array([len(e) for e in encoded], pa.int64())], names=["hash", "frequency", "pieces"])
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(distinct, "token string, frequency long")
    return (found.groupBy("token").agg(F.sum("frequency").alias("frequency"))
            .mapInArrow(counted, "hash long, frequency long, pieces long"))


def _head(vocab: DataFrame, size: int):
    """The most frequent pre-tokens, ``size`` at most: sorted hashes, their pieces, and the least band of frequency."""
    band = F.floor(F.log2("frequency") * 16).cast("int")
    counts = {r.band: r["n"] for r in vocab.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}   # 1,024 bands at most
    least, total = 2000, 0
    for b in sorted(counts, reverse=True):
        if total + counts[b] > size:
            break
        least, total = b, total + counts[b]
    rows = vocab.where(band >= least).select("hash", "pieces").toPandas()
    keys = rows["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["pieces"].to_numpy(np.int64)[order], vocab.where(band < least)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 limit: int = 1024, head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``."""
    vocab = materialize(vocabulary(docs, text_col, tokenizer))
    keys, sizes, rest = _head(vocab, head)

    def run(batches):
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, texts in blocks(strings(batch.column(1)), TEXT_BLOCK):
                codes, starts, at, _ = P.split(texts)
                unique, back = np.unique(P.hashes(codes, starts), return_inverse=True)
                place = np.minimum(np.searchsorted(keys, unique), max(len(keys) - 1, 0))
                known = keys[place] == unique if len(keys) else np.zeros(len(unique), bool)
                size = np.where(known, sizes[place] if len(keys) else 0, 0)
                total = np.concatenate([[0], np.cumsum(size[back])])
                uid = row_no + np.arange(len(texts))
                row_no += len(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(uid), batch.column(0).slice(row, len(texts)), pa.array(np.diff(raw(texts)[1])),
                    pa.array(total[at[1:]] - total[at[:-1]]), pa.array(uid), pa.array(np.zeros(len(texts), np.int64))], names=names)
                tail = np.flatnonzero(~known[back])
                doc = np.searchsorted(at, tail, "right") - 1
                pair, times = np.unique(doc * max(len(unique), 1) + back[tail], return_counts=True)
                doc, token = np.divmod(pair, max(len(unique), 1))
                none = pa.nulls(len(pair), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(uid[doc]), none, none, none, pa.array(unique[token].view(np.int64)), pa.array(times)], names=names)
    names = ["uid", "doc_id", "n_bytes", "known", "hash", "times"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "uid long, doc_id long, n_bytes long, known long, hash long, times long")
    # rows of documents carry times 0, so a chance match of their key adds nothing
    joined = rows.join(rest.select("hash", "pieces"), "hash", "left")
    n = F.sum(F.coalesce("known", F.lit(0)) + F.coalesce(F.col("times") * F.col("pieces"), F.lit(0)))
    out = joined.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), n.alias("n_tokens"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
