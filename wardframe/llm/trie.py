"""Prefix trie of conversations by vertical bitmaps.

Conversations lie in the order of their ids and are cut into shards of ``shard`` turns (one at least).  A shard
indexes (position, turn) to the bitset of its conversations; a node is its members' bitset, and a depth-first walk
intersects it with the postings of the next position to get the children, their popcounts and the list of
conversations that end there.  A node is named by a 128-bit digest chained along its turns, so the shards'
nodes meet in one aggregation: popcounts add up, the smallest member wins, and end lists follow each other in the
order of the shards, which is the order of the ids.

Sums over subtrees need no ancestors per node.  A node belongs to its smallest member, and the nodes of one
conversation are a chain down to its end.  A subtree is the chain below its top plus the whole chains of all its
other members, so a running sum along each chain and one sum over members give every subtree.

Defined cases: rows with a null id take no part; null turns come first, ties within a turn are ordered by
the digest of role and text, repeated rows are turns of their own; null roles and texts are empty; an empty
table gives no rows; extra columns are not read.  A conversation without an own turn left is still a member.
A shard holds a long conversation whole (40 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.llm.text import WORD_PATTERN
from wardframe.sources.scratch import materialised

SHARD = 1 << 16
#: conversations in a group that borrow the beginning of its first, and the most turns that they borrow
FAMILY, BORROWED = 20, 3
_NODE = "d1 long, d2 long, u1 long, u2 long, depth long, words long, least long, n long, members array<long>, ends string"
_MASK = (1 << 64) - 1


def turns_of(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """c, pos (from 1), t1, t2 (128-bit digest of role and text), words."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_))

    def half(at: int) -> F.Column:  # 64 bits as a signed number
        high, low = (F.conv(F.substring(digest, at + i, 8), 16, 10).cast("long") for i in (0, 8))
        return F.shiftleft(high, 32).bitwiseOR(low)

    lean = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), half(1).alias("t1"), half(17).alias("t2"), F.regexp_count(text_, F.lit(WORD_PATTERN)).cast("long").alias("words"))
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    return lean.withColumn("pos", F.row_number().over(order)).drop("turn")


def rebuilt(turns: DataFrame) -> DataFrame:
    """c, pos, t1, t2, words after each conversation's first h turns gave way to those of its family's first; a row with pos 0 for each."""
    h = F.crc32(F.col("c").cast("string").cast("binary")) % (BORROWED + 1)
    convs = turns.where("pos = 1").select("c", h.cast("long").alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base"))
    heads = turns.where((F.col("pos") <= BORROWED) & (F.col("c") % FAMILY == 0)).select(F.col("c").alias("base"), "pos", "t1", "t2", "words")
    lent = convs.join(heads, "base").where("pos <= h").select("c", "pos", "t1", "t2", "words")
    sizes = heads.groupBy("base").agg(F.count("*").alias("size"))
    mine = turns.withColumn("h", h).where(F.col("pos") > F.col("h")).withColumn("base", F.col("c") - F.col("c") % FAMILY).join(sizes, "base", "left").select(
        "c", (F.col("pos") - F.col("h") + F.least(F.col("h"), F.coalesce("size", F.lit(0)))).alias("pos"), "t1", "t2", "words")
    zero = F.lit(0).cast("long")
    return convs.select("c", zero.alias("pos"), zero.alias("t1"), zero.alias("t2"), zero.alias("words")).unionByName(lent).unionByName(mine)


def _below(d1: int, d2: int, t1: int, t2: int) -> tuple[int, int]:
    """The digest of a child from its parent's and the turn's."""
    raw = hashlib.blake2b(b"".join(x.to_bytes(8, "little", signed=True) for x in (d1, d2, t1, t2)), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def walk(convs: list[int], paths: list[list[tuple]]) -> list[tuple]:
    """The nodes of one shard, depth first; ``convs`` ascend and ``paths`` hold their (t1, t2, words)."""
    postings: dict[tuple, int] = {}
    longer: list[int] = []  # by depth, the conversations with more turns
    for i, path in enumerate(paths):
        for depth, turn in enumerate(path):
            at = (depth, turn[0], turn[1])
            postings[at] = postings.get(at, 0) | 1 << i
            if depth == len(longer):
                longer.append(0)
            longer[depth] |= 1 << i
    nodes, stack = [], [((1 << len(convs)) - 1, 0, 0, 0, None, None, 0)]
    while stack:
        bits, depth, d1, d2, u1, u2, words = stack.pop()
        on = bits & longer[depth] if depth < len(longer) else 0
        members = [convs[i] for i in _ones(bits)]
        nodes.append((d1, d2, u1, u2, depth, words, members[0], bits.bit_count(), members, ",".join(str(convs[i]) for i in _ones(bits & ~on))))
        while on:
            turn = paths[(on & -on).bit_length() - 1][depth]
            child = on & postings[depth, turn[0], turn[1]]
            on &= ~child
            stack.append((child, depth + 1, *_below(d1, d2, turn[0], turn[1]), d1, d2, turn[2]))
    return nodes


def _ones(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _shards(limit: int):
    """Nodes of the shards of one partition, whose rows come by conversation and position."""
    columns = [c.split()[0] for c in _NODE.split(", ")]

    def closed(convs: list[int], paths: list[list[tuple]]) -> Iterator[pd.DataFrame]:
        nodes = walk(convs, paths)
        for at in range(0, len(nodes), 4096):
            parts = zip(columns, zip(*nodes[at:at + 4096], strict=True), strict=True)
            yield pd.DataFrame({name: pd.array(part, dtype="Int64") if name in ("u1", "u2") else part for name, part in parts})  # never through floats

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        convs, paths, held = [], [], 0
        for batch in batches:
            for c, pos, t1, t2, words in zip(*(batch[x].tolist() for x in ("c", "pos", "t1", "t2", "words")), strict=True):
                if pos == 0:
                    if held >= limit:
                        yield from closed(convs, paths)
                        convs, paths, held = [], [], 0
                    convs.append(c)
                    paths.append([])
                else:
                    paths[-1].append((t1, t2, words))
                held += 1
        if convs:
            yield from closed(convs, paths)
    return run


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of each node's end lists, which follow each other; only the running digest is held."""
    now, running, out = None, None, []
    for batch in batches:
        for d1, d2, ends in zip(batch["d1"].tolist(), batch["d2"].tolist(), batch["ends"], strict=True):
            if (d1, d2) != now:
                if now is not None:
                    out.append((*now, running.hexdigest()))
                now, running = (d1, d2), hashlib.sha256(ends.encode())
            else:
                running.update(b"," + ends.encode())
        if out:
            yield pd.DataFrame(out, columns=["d1", "d2", "ends_sha256"])
            out = []
    if now is not None:
        yield pd.DataFrame([(*now, running.hexdigest())], columns=["d1", "d2", "ends_sha256"])


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", shard: int = SHARD) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node."""
    turns = materialised(turns_of(rows, conv, turn, role, text), "turns")
    ordered = rebuilt(turns).repartitionByRange("c").sortWithinPartitions("c", "pos")
    local = materialised(ordered.mapInPandas(_shards(shard), _NODE), "local-nodes")

    merged = materialised(local.groupBy("d1", "d2").agg(
        F.first("u1").alias("u1"), F.first("u2").alias("u2"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.min("least").alias("conv_id"), F.sum("n").alias("n_convs")), "nodes")
    children = merged.where("u1 IS NOT NULL").groupBy(F.col("u1").alias("d1"), F.col("u2").alias("d2")).agg(F.count("*").alias("n_children"))
    with_children = merged.join(children, ["d1", "d2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))

    # each chain from its end upwards
    chain = Window.partitionBy("conv_id")
    upwards = chain.orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaf, saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("words")
    chained = materialised(with_children.withColumn("leaf", leaf).withColumn("saved", saved).select(
        "*", F.sum("leaf").over(upwards).alias("leaves_below"), F.sum("saved").over(upwards).alias("saved_below")), "chains")
    # the top of a chain holds its totals
    tops = chained.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"), F.min("depth").alias("top"))
    tops = materialised(tops, "chain-totals")
    members = local.select("d1", "d2", "depth", F.explode("members").alias("conv_id"))
    others = members.join(tops, "conv_id").where("depth < top").groupBy("d1", "d2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved_others"))

    ends = local.where("ends <> ''").select("d1", "d2", "least", "ends").repartition("d1", "d2").sortWithinPartitions("d1", "d2", "least").mapInPandas(
        _digests, "d1 long, d2 long, ends_sha256 string")
    parents = merged.select(F.col("d1").alias("u1"), F.col("d2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    return chained.join(others, ["d1", "d2"], "left").join(ends, ["d1", "d2"], "left").join(parents, ["u1", "u2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves_below") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved_below") + F.coalesce("saved_others", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


SQL = r"""
WITH own AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                            ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT c, turns, c - c % 20 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
  FROM hashed a LEFT JOIN own b ON b.c = a.base),
member AS (
  SELECT c, d, len(path) AS size, CAST(path[1:d] AS VARCHAR) AS node, CASE WHEN d > 0 THEN CAST(path[1:d - 1] AS VARCHAR) END AS up,
         CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT node, d, any_value(up) AS up, any_value(words) AS words, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends_sha256
  FROM member GROUP BY node, d),
kids AS (SELECT n.*, (SELECT count(*) FROM node k WHERE k.d = n.d + 1 AND k.up = n.node) AS n_children FROM node n),
below AS (
  SELECT a.node, a.d, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((k.n_convs - 1) * k.words) AS saved_tokens
  FROM kids k JOIN member a ON a.c = k.conv_id AND a.d <= k.d GROUP BY a.node, a.d)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.n_children AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM kids n JOIN below b USING (node, d) LEFT JOIN node p ON p.node = n.up AND p.d = n.d - 1
"""


@query("op12_vertical_trie", SQL)
def op12(spark, folder):
    return prefix_trie(table(spark, folder, "conversations"))
