"""Chat formatting of reply trees.

Messages point to their parent. Iterative self-joins double the distance each message sees towards its root, so a tree
of depth d takes log2(d) rounds; the same jump tables then enumerate the root-to-leaf paths of the chosen leaves. Leaves
of a tree are ranked by the mean score of their path (ties: the deeper, then the smaller leaf), and each chosen path is
formatted as one conversation.

Template: ``<|start|>role<|sep|>text<|end|>\\n`` for each turn. Control strings of this and other common templates are
broken inside roles and texts by a backslash behind their first character; backslashes are doubled, so the text can be
read back exactly. The loss mask covers the text of each assistant turn.

Null texts and roles count as empty. Equal rows are separate messages. A message whose parent is missing is a root; messages
on a cycle have no root and are left out. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>\n"
_CONTROL = re.compile(r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])")
_TURN = re.compile(r"<\|start\|>(.*?)<\|sep\|>(.*?)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, spans under the loss mask) of (role, text) turns."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def jump_tables(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(jumps, reach): jumps[k] has (tree, node, to) with the ancestor 2**k steps up; reach has, for every message with
    a root, its depth and the summed score of its path. ``messages``: tree, node, parent, score."""
    ids = messages.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = materialize(messages.join(ids, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("to"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")))
    # only messages that have not reached their root go on, so a few long chains do not move the others again
    done, active = state.where("to is null"), state.where("to is not null")
    jumps, rounds = [], messages.count().bit_length()
    while active.take(1) and len(jumps) <= rounds:
        jumps.append(active.select("tree", "node", "to"))
        far = done.unionByName(active).select("tree", F.col("node").alias("to"), F.col("to").alias("to2"), F.col("total").alias("total2"), F.col("depth").alias("depth2"))
        state = materialize(active.join(far, ["tree", "to"]).select(
            "tree", "node", F.col("to2").alias("to"), (F.col("total") + F.col("total2")).alias("total"), (F.col("depth") + F.col("depth2")).alias("depth")))
        done, active = done.unionByName(state.where("to is null")), state.where("to is not null")
    return jumps, done.drop("to")


def paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, place, leaf, node, depth) of the ``keep`` best root-to-leaf paths of each tree."""
    jumps, reach = jump_tables(messages)
    parents = messages.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = reach.join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy((-F.col("total") / F.col("depth")), -F.col("depth"), "node")
    best = leaves.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    rows = materialize(best.select("tree", "place", F.col("node").alias("leaf"), "node"))
    for jump in reversed(jumps):                 # every distance is a sum of distinct powers of two
        further = rows.join(jump, ["tree", "node"]).select("tree", "place", "leaf", F.col("to").alias("node"))
        rows = materialize(rows.unionByName(further))
    return rows.join(reach.select("tree", "node", "depth"), ["tree", "node"])


def formatted(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, place, conversation, loss) for each chosen path; ``messages``: tree, node, parent, role, text, score.

    ``loss`` holds the (start, end) spans, in characters, that a model is trained on. One conversation is one row, so its
    turns meet in one task.
    """
    chosen = paths(messages.select("tree", "node", "parent", "score"), keep).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    turn = F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = chosen.groupBy("tree", "place").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches):
        for batch in batches:
            done = [render([(t["role"], t["text"]) for t in turns]) for turns in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.string()),
                 pa.array([[{"start": s, "end": e} for s, e in d[1]] for d in done], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["tree", "place", "conversation", "loss"])
    return whole.mapInArrow(run, "tree string, place int, conversation string, loss array<struct<start: long, end: long>>")


def chains(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as messages: each turn replies to the one before it (ties by role and text)."""
    tree = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = conversations.select(tree.alias("tree"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.withColumn("node", F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long"))
    return materialize(rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")))


def digests(done: DataFrame) -> DataFrame:
    """What can be read back from ``formatted``: turns, text under the loss mask, length."""
    def run(batches):
        for batch in batches:
            rows = []
            for tree, text, loss in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read(text)
                under = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                rows.append((None if tree == "null" else int(tree), len(turns),
                             hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             len(under), hashlib.sha256(under.encode()).hexdigest(), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(6)], names=names)
    return done.select("tree", "conversation", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
