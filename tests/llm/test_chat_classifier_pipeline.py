"""Chat formatting, the classifier, the pipeline, and every query against its SQL."""
import hashlib
import os
import sys

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from check_oracle import compare, connect  # noqa: E402
from oreline.llm import chat, classifier, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
TEXT = st.text(st.sampled_from(list("<>|[]/\\sINTSYend a\n")), max_size=30)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<|sep|>", "a\\"]), TEXT), max_size=5))
def test_chat_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.read(text) == turns
    assert [chat.unescape(text[s:e]) for s, e in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count("<|") == 3 * len(turns) and not any(c in text for c in ("</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_reply_trees(spark):
    rows = [("t", 1, None, "user", "root", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 3, 1, "assistant", "good", 2.0),
            ("t", 4, 3, "user", "more", 2.0), ("t", 5, 4, "assistant", "end", 5.0), ("t", 6, 2, "user", None, 1.0),
            ("u", 1, 9, None, "orphan", 1.0), ("v", 1, 2, "user", "cycle", 1.0), ("v", 2, 1, "user", "cycle", 1.0)]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r.tree, r.place): chat.read(r.conversation) for r in chat.formatted(messages, keep=2).collect()}
    assert got == {("t", 1): [("user", "root"), ("assistant", "good"), ("user", "more"), ("assistant", "end")],
                   ("t", 2): [("user", "root"), ("assistant", "bad"), ("user", "")], ("u", 1): [("", "orphan")]}
    long = spark.range(300).select(F.lit("w").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
                                   F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(0.0).alias("score"))
    one = chat.formatted(long).collect()
    assert len(one) == 1 and [t for _, t in chat.read(one[0].conversation)] == [str(i) for i in range(300)]
    assert chat.formatted(messages.where("false")).count() == 0


def test_chains_take_repeated_rows_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (None, 3, None, "x")]
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert got[1].n_turns == 3 and got[1].turns_sha256 == hashlib.sha256(b"user\na\nuser\na\nassistant\n\n").hexdigest()
    assert got[None].n_turns == 1


def test_network_gradients():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 2600).astype(np.uint8)
    chunks, first = classifier.chunk_bytes(data, np.array([0, 0, 700, 2600]))
    net = classifier.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3)
    _, g = net.gradients(chunks, first, y, w)
    for name, at in (("out", (3,)), ("bias", (2,)), ("filters", (1, 2, 3)), ("bytes", (int(data[10]), 1)), ("join", (1,)), ("shift", (0,))):
        old = net.p[name][at]
        loss = []
        for step in (2e-3, -2e-3):
            net.p[name][at] = old + step
            loss.append(net.gradients(chunks, first, y, w)[0])
        net.p[name][at] = old
        assert (loss[0] - loss[1]) / 4e-3 == pytest.approx(g[name][at], abs=2e-2, rel=0.2)


def test_chunks_cover_every_byte():
    for n in (0, 1, 383, 384, 512, 513, 896, 5000):
        data = (np.arange(n) % 251).astype(np.uint8)
        chunks, first = classifier.chunk_bytes(data, np.array([0, n]))
        assert first.tolist() == [0, len(chunks)]
        seen = {(i * classifier.STEP + j): b for i, c in enumerate(chunks.tolist()) for j, b in enumerate(c) if b != classifier.PAD}
        assert [seen.get(k) for k in range(n)] == data.tolist()


def test_classifier_on_held_out_rows(spark, edge, empty):
    scored = queries.QUERIES["op10_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    model = classifier.fit(["good text here"] * 30 + ["$$$ ### ***"] * 30, [1] * 30 + [0] * 30)
    assert classifier.score(edge, model).count() == edge.count() and classifier.score(empty, model).count() == 0
    assert classifier.fit([], []) == 0.5 and classifier.fit(["a"], [1]) == 1.0


def test_pipeline(spark, documents, monkeypatch):
    stored, store = [], corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda d: stored.append(store(d)) or stored[-1])
    done = corpus_pipeline.run(spark, SF).collect()
    assert len(stored) == 4 and all(d.columns == documents.columns for d in stored)
    good, single, masked, mix = ([r.doc_id for r in d.select("doc_id").collect()] for d in stored)
    assert 0 < len(single) < len(good) < documents.count() and sorted(masked) == sorted(single) and set(mix) <= set(masked)
    assert sorted(r.doc_id for r in done if r.piece == 0) == sorted(mix)
    wanted = [r.doc_id for r in queries.quality.judged(documents).where("kept").collect()]
    assert sorted(good) == sorted(wanted)
    assert all(r.n_chars == len(r.text) for r in stored[2].collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, message
