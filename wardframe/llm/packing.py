"""Best-fit packing of documents into bins under conflicts.

A bin holds at most ``capacity`` words, one document of a source and one of a duplicate cluster.  Texts equal
up to case and white space are one cluster, and so are near copies (``neardup``, at ``NEAR_PERCENT``).  Longer
documents are cut: full pieces fill bins of their own, the last piece is packed.  Pieces are dealt by hash
into shards of about ``SHARD_PIECES`` rows (without texts), so copies and hot sources spread evenly; in a
shard pieces come by falling size, bins are ordered by what is left and carry bitmaps of their sources and
clusters, and the search goes from the tightest bin that fits to its successors until one is compatible.

Defined cases: null or wordless texts have no words and stay out (``bin`` is null); a null source is a source
of its own; repeated rows are copies; ties are ordered by digest and id; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.neardup import components, judged
from wardframe.llm.registry import query, table
from wardframe.llm.text import WORD_PATTERN
from wardframe.sources.scratch import materialised

CAPACITY, SHARD_PIECES, NEAR_PERCENT = 2048, 4000, 80


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, taken in the given order."""
    open_bins: list[tuple[int, int]] = []  # (what is left, bin), sorted
    with_source: list[int] = []
    with_cluster: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = 1 << source, 1 << cluster
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (with_source[open_bins[at][1]] & s or with_cluster[open_bins[at][1]] & c):
            at += 1
        if at < len(open_bins):
            left, b = open_bins.pop(at)
        else:
            left, b = capacity, len(with_source)
            with_source.append(0)
            with_cluster.append(0)
        with_source[b] |= s
        with_cluster[b] |= c
        placed.append((b, capacity - left))
        if left > size:
            insort(open_bins, (left - size, b))
    return placed


def near_clusters(docs: DataFrame, text: str) -> DataFrame:
    """digest, near, words: the duplicate cluster of each text, near copies and texts alike up to case and white space linked together."""
    found = judged(docs.select(F.monotonically_increasing_id().alias("k"), F.col(text).alias("t")), "k", "t", NEAR_PERCENT)
    labels = materialised(found.where("tkey IS NOT NULL").groupBy("tkey").agg(
        F.min("component_id").alias("c"), F.min("alike").alias("alike"), F.min("words").alias("words")), "near")
    least = labels.groupBy("alike").agg(F.min("c").alias("a"), F.max("c").alias("last")).where("a < last").select("alike", "a")
    links = labels.join(least, "alike").select("a", F.col("c").alias("b"))  # case beyond ASCII is no shingle's matter
    if not links.isEmpty():
        labels = labels.join(components(links), F.col("c") == F.col("node"), "left").withColumn("c", F.coalesce("root", "c"))
    return labels.select(F.col("tkey").alias("digest"), F.concat(F.lit("n"), F.col("c").cast("string")).alias("near"), "words")


def pack(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", capacity: int = CAPACITY, cluster: Column | None = None) -> DataFrame:
    """key, piece, first_word, n_words, bin, place (of the piece's first word in the bin).

    ``cluster`` names the duplicate cluster of a row; by default equal texts up to case and white space and near copies.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(source).alias("source"), F.md5(body).alias("digest"),
        *([] if cluster is None else [cluster.cast("string").alias("cluster"), F.regexp_count(body, F.lit(WORD_PATTERN)).cast("long").alias("words")]))
    if cluster is None:  # null texts have no label and no words
        rows = rows.join(near_clusters(docs, text), "digest", "left").withColumn("words", F.coalesce("words", F.lit(0))).withColumnRenamed("near", "cluster")
    rows = materialised(rows, "pack-rows")
    full = F.floor(F.col("words") / capacity)
    rows = rows.withColumn("full", full).withColumn("rest", F.col("words") - full * capacity)
    n = rows.where("rest > 0").count()
    key_type = dict(rows.dtypes)["key"]
    schema = f"key {key_type}, piece long, first_word long, n_words long, bin string, place long"
    shards = max(1, -(-n // SHARD_PIECES))

    def shard_bins(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["rest", "digest", "key", "row"], ascending=[False, True, True, True])
        sources = pd.factorize(frame["source"], use_na_sentinel=False)[0].tolist()
        clusters = pd.factorize(frame["cluster"], use_na_sentinel=False)[0].tolist()
        placed = best_fit(frame["rest"].tolist(), sources, clusters, capacity)
        shard = int(frame["shard"].iloc[0])
        return pd.DataFrame({
            "key": frame["key"], "piece": frame["full"], "first_word": frame["full"] * capacity, "n_words": frame["rest"],
            "bin": [f"s{shard}-{b}" for b, _ in placed], "place": [o for _, o in placed]})

    last = rows.where("rest > 0").withColumn("shard", F.pmod(F.xxhash64("digest", "key", "row"), F.lit(shards)))
    packed = last.select("shard", "row", "key", "source", "cluster", "digest", "full", "rest").groupBy("shard").applyInPandas(shard_bins, schema)
    zero = F.lit(0).cast("long")
    whole = rows.where("full > 0").select("key", "row", F.explode(F.sequence(zero, F.col("full") - 1)).alias("piece")).select(
        "key", "piece", (F.col("piece") * capacity).alias("first_word"), F.lit(capacity).cast("long").alias("n_words"),
        F.concat_ws("-", F.lit("f"), "row", "piece").alias("bin"), zero.alias("place"))
    none = rows.where("words = 0").select("key", zero.alias("piece"), zero.alias("first_word"), zero.alias("n_words"), F.lit(None).cast("string").alias("bin"), zero.alias("place"))
    return packed.unionByName(whole).unionByName(none).withColumnRenamed("key", key)


@query("op10_conflict_best_fit")
def op10(spark, folder):
    return pack(table(spark, folder, "documents"))
