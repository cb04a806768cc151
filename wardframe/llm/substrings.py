"""Removal of word passages that an earlier document holds, by seed and extend.

Documents meet on winnowed anchors (the least of the word grams of each window).  No pair of documents is joined
and no match extended word by word: passages around the anchor, in steps of whole runs, 16 starts and single
starts, are grouped by their hashes (``repeats``), so a passage in thousands of documents is compared by sorting and never by
pairs.  Every match of at least ``width`` words is kept.

Equal texts are one text with the least id before any of this.  Defined cases: null or empty texts have no
words; shorter texts lose nothing; rows that share an id are one document for "smaller id", so neither
removes from the other; a null id comes after every other; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.llm.repeats import covered, repeated_starts
from wardframe.llm.text import word_hashes, words_of
from wardframe.sources.scratch import bucketed

WIDTH, GRAM = 50, 8
_LAST = (1 << 63) - 1


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """key, n_words, n_removed, kept_sha256, kept (text), removed (word runs start, end)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("doc"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("uid"))
    once = bucketed(rows.groupBy("uid").agg(F.first("text").alias("text"), F.min("doc").alias("doc")), "texts", "uid")
    spans = repeated_starts(once, word_hashes, width, gram, first_stays=True)
    schema = "uid binary, n_words long, n_removed long, kept_sha256 string, kept string, removed array<struct<start:long,end:long>>"

    def cut(batches):
        for batch in batches:
            out = []
            for uid, body, runs in zip(batch["uid"], batch["text"], batch["spans"], strict=True):
                words = words_of(body)
                gone = covered(len(words), width, runs)
                step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                pairs = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
                kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
                out.append((uid, len(words), int(gone.sum()), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(), kept, pairs))
            yield pd.DataFrame(out, columns=["uid", "n_words", "n_removed", "kept_sha256", "kept", "removed"])

    results = once.withColumnRenamed("doc", "first_doc").join(spans.hint("shuffle_hash"), "uid", "left").mapInPandas(cut, schema)
    firsts = once.select("uid", F.col("doc").alias("first_doc"))
    out = rows.select("key", "doc", "uid").join(firsts, "uid").join(results, "uid")
    # a later copy of the same text goes wholly once it holds one window
    later = (F.col("doc") > F.col("first_doc")) & (F.col("n_words") >= width)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return out.select(
        F.col("key").alias(key), "n_words", F.when(later, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(later, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(later, F.lit("")).otherwise(F.col("kept")).alias("kept"), F.when(later, whole).otherwise(F.col("removed")).alias("removed"))


@query("op7_seed_and_extend")
def op7(spark, folder):
    return remove_passages(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
