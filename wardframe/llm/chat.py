"""Chat formatting over a prefix tree of conversations.

Conversations that share their first turns share the nodes of a tree; each node is emitted once, depth
first, in one long sequence.  A node carries its place in the sequence, the position of its first token in
its conversation, the intervals of the sequence that it may attend to (its ancestors) and its loss span.
The token unit is the code point.

Template: ``### <role>: <text></turn>\\n``.  Inside roles and texts a backslash goes before every backslash,
``###`` and ``</turn>``, in roles also before ``:``, so reading back is exact.

Depth-first order is the order of the conversations' lists of node digests: conversations are range
partitioned and sorted by it, a node belongs to the first conversation that holds it (pre-aggregated), and
places are running sums per range shifted by the totals of earlier ranges.  One conversation is one
training sequence and the largest group held by a task.

Defined cases: null texts and roles are empty; rows with the same conversation and turn are ordered by role
and text; null turns come first; rows with a null conversation id are one conversation; equal conversations
share all nodes and still give a row each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.sources.scratch import materialised

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?)</turn>\n", re.S)


def formatted_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """The turn in the template and the span of its text."""
    head = "### " + _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role or "") + ": "
    body = _CONTROL.sub(lambda m: "\\" + m[0], text or "")
    return head + body + "</turn>\n", len(head), len(head) + len(body)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_back(output: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of an output."""
    return [(unescaped(role), unescaped(text)) for role, text in _TURN.findall(output)]


_PATH = "array<struct<node:string,length:long,position:long,output:string,loss_start:int,loss_end:int>>"


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, keys, paths = [], [], []
        for conv, turns in zip(batch["conv"], batch["turns"], strict=True):
            digest, position, path = b"", 0, []
            for turn in turns:
                output, lo, hi = formatted_turn(turn["role"], turn["text"])
                digest = hashlib.blake2b(digest + output.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                loss = turn["role"] == "assistant"
                path.append({"node": digest.hex(), "length": len(output), "position": position, "output": output, "loss_start": lo if loss else None, "loss_end": hi if loss else None})
                position += len(output)
            ids.append(conv)
            keys.append([p["node"] for p in path])
            paths.append(path)
        yield pd.DataFrame({"conv": pd.Series(ids, dtype="Int64"), "key": keys, "path": paths})


def prefix_tree(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Nodes and leaves.

    nodes: node, owner, depth, start, end (places in the sequence), position, output, loss_start, loss_end,
    ancestors (intervals it attends to besides itself).  leaves: conv, rank, depth, node, one row per turn.
    """
    entry = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    grouped = rows.select(F.col(conv).cast("long").alias("conv"), entry.alias("e")).groupBy("conv").agg(F.sort_array(F.collect_list("e")).alias("turns"))
    paths = grouped.mapInPandas(_paths, f"conv long, key array<string>, path {_PATH}")
    # written as sorted, so the numbers given to the rows stay
    ranked = materialised(materialised(paths, "paths").orderBy("key", "conv").withColumn("rank", F.monotonically_increasing_id()).drop("key"), "ranked")
    turns = ranked.select("conv", "rank", F.posexplode("path").alias("depth", "p"))
    held = turns.groupBy(F.col("p.node").alias("node")).agg(F.min("rank").alias("owner"), F.first("depth").alias("depth"), F.first(F.col("p.length")).alias("length"), F.first(F.col("p.position")).alias("position"))
    held = held.withColumn("range", F.shiftright("owner", 33))
    to = F.sum("length").over(Window.partitionBy("range").orderBy("owner", "depth"))
    placed = materialised(held.withColumn("to", to), "placed")
    totals = placed.groupBy("range").agg(F.sum("length").alias("all"))  # one row per range
    shift = totals.alias("x").join(F.broadcast(totals).alias("y"), F.col("y.range") < F.col("x.range")).groupBy(F.col("x.range").alias("range")).agg(F.sum("y.all").alias("shift"))
    placed = placed.join(F.broadcast(shift), "range", "left").withColumn("end", F.col("to") + F.coalesce("shift", F.lit(0))).withColumn("start", F.col("end") - F.col("length"))
    placed = materialised(placed.select("node", "owner", "depth", "start", "end", "position"), "placed")
    own = turns.select(F.col("rank").alias("owner"), F.col("p.node").alias("node"), F.col("p.output").alias("output"), F.col("p.loss_start").alias("loss_start"), F.col("p.loss_end").alias("loss_end"))
    emitting = placed.select("owner").distinct()
    chain = turns.join(emitting, F.col("rank") == F.col("owner"), "left_semi").select(F.col("rank").alias("owner"), F.col("p.node").alias("node"))
    chain = chain.join(placed.select("node", "depth", "start", "end"), "node").groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("depth", "start", "end"))).alias("chain"))
    nodes = placed.join(own, ["owner", "node"]).join(chain, "owner").withColumn(
        "ancestors", F.transform(F.filter("chain", lambda c: c["depth"] < F.col("depth")), lambda c: F.struct(c["start"], c["end"]))).drop("chain")
    return materialised(nodes, "nodes"), turns.select("conv", "rank", "depth", F.col("p.node").alias("node"))


def outputs(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """conv, rank, output, loss: every conversation read from the tree, with the loss spans in its output."""
    parts = leaves.join(nodes.select("node", "position", "output", "loss_start", "loss_end"), "node")
    part = F.struct("depth", "output", F.when(F.col("loss_start").isNotNull(), F.struct((F.col("position") + F.col("loss_start")).alias("a"), (F.col("position") + F.col("loss_end")).alias("b"))).alias("loss"))
    sorted_parts = parts.groupBy("conv", "rank").agg(F.sort_array(F.collect_list(part)).alias("p"))
    return sorted_parts.select("conv", "rank", F.array_join(F.transform("p", lambda x: x["output"]), "").alias("output"),
                               F.filter(F.transform("p", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss"))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for conv, output, loss in zip(batch["conv"], batch["output"], batch["loss"], strict=True):
            turns = read_back(output)
            spoken = "".join(f"{r}\n{t}\n" for r, t in turns)
            learnt = "".join(unescaped(output[s["a"]:s["b"]]) for s in loss)
            sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (spoken, learnt)]
            out.append((conv, len(turns), sha[0], len(learnt), sha[1], len(output)))
        yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})


@query("op9_prefix_tree_chat")
def op9(spark, folder):
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return outputs(*prefix_tree(rows)).mapInPandas(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
