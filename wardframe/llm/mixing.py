"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Texts are cut into blocks of at most ``block_words`` words.  Each source has a target in words; its block
quota is whole passes over its blocks plus the first part of their keyed permutation.  A tree over the
output shards splits the quotas of all sources exactly: each inner node draws its left child's blocks from
its own by the multivariate hypergeometric law.  A source's permuted draws are then dealt out to the shards
in runs as long as their quotas, so shards hold disjoint blocks, and each shard is shuffled by hash.

The permutation of a source is the order of a hash of (document, block).  It is cut into cells of about
``CELL_BLOCKS`` blocks, so ranks and running totals inside a source need no group larger than a cell; one
row per cell carries the totals.  Targets are found from the per-source table by repeated aggregation.

Defined cases: null or empty texts have no blocks and take nothing; a null source is the last source;
repeated rows are documents of their own; ties in the hash are broken by row; an empty table gives no
rows; extra columns are not read.  At most 1e9 blocks are drawn (raise ``block_words`` beyond).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.llm.text import WORD
from wardframe.sources.scratch import materialised

BLOCK_WORDS, CELL_BLOCKS, SHARD_BLOCKS, REPEATS = 64, 20_000, 50_000, 3
_BITS = 60


def blocks_of(text: str | None, block_words: int) -> list[tuple[int, int, int]]:
    """(start, end, words) character spans that tile a text with words."""
    ends = [m.end() for m in WORD.finditer(text or "")]
    out, start = [], 0
    for i in range(0, len(ends), block_words):
        last = min(i + block_words, len(ends))
        end = ends[last - 1] if last < len(ends) else len(text)
        out.append((start, end, last - i))
        start = end
    return out


def slim(docs: DataFrame, key: str, source: str, text: str, block_words: int, tag: str | None = None) -> DataFrame:
    """row, key, source, digest, size and the words of every block; written once, so rows keep their number."""
    @F.pandas_udf("array<int>")
    def counts(texts: pd.Series) -> pd.Series:
        return pd.Series([[b[2] for b in blocks_of(t, block_words)] for t in texts], dtype=object)

    return materialised(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(source).alias("source"),
        F.md5(F.concat(F.coalesce(F.col(tag or key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))).alias("digest"), counts(F.col(text)).alias("words"),
    ).withColumn("size", F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)), "mix-rows")


def source_targets(rows: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, n_blocks, weight, target.  One row per source; the driver sees totals only."""
    ordered = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.size("words")).alias("n_blocks"))
    ordered = materialised(ordered.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    before, offsets = 0, []
    for p, n in sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):  # one row per partition
        offsets.append((p, before))
        before += n
    if not offsets:
        return ordered.select("source", "source_size", "n_blocks", F.lit(1.0).alias("weight"), F.lit(0.0).alias("target"))
    shift = F.create_map(*[F.lit(v) for pair in offsets for v in pair])[part]
    weighted = ordered.withColumn("weight", ((shift + F.col("at").bitwiseAND((1 << 33) - 1)) % 3 + 1).cast("double"))
    cap, total = F.lit(float(repeats)) * F.col("source_size"), None
    level = -1.0
    while True:  # each round caps more sources; ends when no further one is above its cap
        over = cap <= F.lit(level) * F.col("weight")
        seen = weighted.agg(F.sum("source_size").alias("t"), F.sum(F.when(over, cap)).alias("c"), F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        total = float(seen["t"] or 0)
        following = (total - float(seen["c"] or 0.0)) / seen["w"] if seen["w"] else level
        if following <= level:
            break
        level = following
    return weighted.select("source", "source_size", "n_blocks", "weight", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def drawn_blocks(rows: DataFrame, targets: DataFrame, seed: int = 2) -> DataFrame:
    """row, key, block, words, source, rank (in the source's permutation) and times the mix takes it."""
    bits = F.greatest(F.lit(0), F.least(F.lit(30), F.ceil(F.log2(F.col("n_blocks") / CELL_BLOCKS)))).cast("int")
    goal = targets.withColumn("bits", F.when(F.col("n_blocks") > CELL_BLOCKS, bits).otherwise(0)).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("int")
    ).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    goal = goal.select(F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s")).alias("sid"), "bits", "passes", "rest", "n_blocks")
    sid = F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s"))
    blocks = rows.select("row", "key", "digest", sid.alias("sid"), F.posexplode("words").alias("block", "words"))
    blocks = blocks.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "digest", "block"), 64 - _BITS))
    small = materialised(goal, "mix-goals")
    blocks = blocks.join(small, "sid").withColumn("cell", F.expr(f"shiftright(h, {_BITS} - bits)"))
    cells = blocks.groupBy("sid", "cell").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    ahead = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("sid", "cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("w0"))
    inside = Window.partitionBy("sid", "cell").orderBy("h", "block", "row")
    ranked = blocks.join(cells, ["sid", "cell"]).withColumn("rank", F.col("n0") + F.row_number().over(inside) - 1)
    ranked = ranked.withColumn("words_to", F.col("w0") + F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    extra = (F.col("words_to") - F.col("words") / 2.0 <= F.col("rest")) & (F.col("passes") < REPEATS)
    return ranked.select("sid", "row", "key", "block", "words", "rank", "n_blocks", (F.col("passes") + extra.cast("int")).alias("times"))


def split_quotas(quotas: DataFrame, n_shards: int, seed: int = 2, levels: int = 4) -> DataFrame:
    """sid, shard, quota: every source's draws dealt over the shards by the splitting tree.

    ``quotas`` holds sid and quota.  One group per tree node, with one row per source that it holds.
    """
    schema = "sid struct<n:boolean,s:string>, lo int, hi int, quota long"

    def split(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("sid", key=lambda c: c.map(lambda s: (s["n"], s["s"])))
        out: list[pd.DataFrame] = []

        def down(part: pd.DataFrame, lo: int, hi: int, left: int) -> None:
            if hi - lo <= 1 or not left:
                out.append(part.assign(lo=lo, hi=hi))
                return
            mid, colours = (lo + hi) // 2, part["quota"].to_numpy(np.int64)
            capacity = int(colours.sum()) * (mid - lo) // (hi - lo)
            drawn = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(colours, capacity, method="marginals")
            down(part.assign(quota=drawn)[drawn > 0], lo, mid, left - 1)
            down(part.assign(quota=colours - drawn)[colours > drawn], mid, hi, left - 1)

        down(frame, int(frame["lo"].iloc[0]), int(frame["hi"].iloc[0]), levels)
        return pd.concat(out)[["sid", "lo", "hi", "quota"]]

    tree, depth = quotas.select("sid", F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), "quota"), int(np.ceil(np.log2(max(1, n_shards))))
    for _ in range(-(-depth // levels)):
        tree = tree.groupBy("lo", "hi").applyInPandas(split, schema)
    return tree.select("sid", F.col("lo").alias("shard"), "quota")


def mix(drawn: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 2) -> DataFrame:
    """row, key, block, words, draw, shard, place: the mix in its shards, each in shuffled order.

    A run of a source's draws belongs to one shard; a draw finds its run through the draws' own cells of
    1024, each of which meets only the runs that overlap it.
    """
    draws = drawn.where("times > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("pass"))
    draws = draws.withColumn("draw", F.col("pass") * F.col("n_blocks") + F.col("rank"))
    quotas = materialised(draws.groupBy("sid").agg(F.count("*").alias("quota")), "mix-quotas")
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    shards = split_quotas(quotas, max(1, -(-total // shard_blocks)), seed)
    to = F.sum("quota").over(Window.partitionBy("sid").orderBy("shard"))
    runs = shards.select("sid", "shard", to.alias("to"), (to - F.col("quota")).alias("start"))
    runs = runs.select("*", F.explode(F.sequence(F.shiftright("start", 10), F.shiftright(F.col("to") - 1, 10))).alias("near"))
    placed = draws.withColumn("near", F.shiftright("draw", 10)).join(runs, ["sid", "near"]).where("draw >= start AND draw < to")
    return placed.select("row", "key", "block", "words", "draw", "shard", F.xxhash64(F.lit(seed), "row", "block", "pass").alias("place"), "pass")


def mixture(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", block_words: int = BLOCK_WORDS,
            tag: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' sizes, the targets of their sources and the placed blocks; ``tag`` seeds the permutation."""
    rows = slim(docs, key, source, text, block_words, tag)
    targets = materialised(source_targets(rows), "mix-targets")
    return rows, targets, mix(drawn_blocks(rows, targets))


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents with their own columns: one row per document and pass, its drawn blocks in order."""
    kept = materialised(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-docs")
    _, _, placed = mixture(kept.select(F.col("__row").alias("k"), F.col(key).alias("tag"), F.col(source).alias("s"), F.col(text).alias("t")), "k", "s", "t", block_words, "tag")
    chosen = placed.groupBy(F.col("key").alias("__row"), "pass").agg(F.sort_array(F.collect_list("block")).alias("__blocks"))

    @F.pandas_udf("string")
    def joined(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for t, chosen_blocks in zip(texts, lists, strict=True):
            spans = blocks_of(t, block_words)
            out.append(t if len(chosen_blocks) == len(spans) else "".join(t[spans[b][0]:spans[b][1]] for b in chosen_blocks).strip())
        return pd.Series(out, dtype=object)

    out = kept.join(chosen, "__row").withColumn(text, joined(F.col(text), F.col("__blocks")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


@query("op2_source_mix")
def op2(spark, folder):
    rows, targets, placed = mixture(table(spark, folder, "documents"))
    taken = placed.groupBy("row").agg(F.sum("words").alias("taken"))
    goals = targets.select(F.col("source").alias("s"), "source_size", "target")
    return rows.join(goals, F.col("source").eqNullSafe(F.col("s"))).join(taken, "row", "left").select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
