"""Removal of byte strings that occur more than once, by grouping hashes of anchored passages.

No suffix is sorted: passages at anchors are range-partitioned by sampled splitters on the hash of their core
(what all windows of a record share), sorted by hashes and grouped with equal neighbours, also across boundaries (``repeats``).  Sorting the
suffixes of every byte would shuffle a prefix of hundreds of bytes per input byte; the anchors keep the
result and cut the records to about one per 170 bytes, with hashes in place of the bytes compared.

Equal texts are one text with a count before any of this; a text of at least one width with a count of two
goes wholly.  Defined cases: null is the empty text; repeated rows are copies; shorter texts lose nothing;
matches never cross documents; very long texts are read whole; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.llm.repeats import covered, repeated_starts
from wardframe.sources.scratch import bucketed

WIDTH, GRAM = 400, 48


def byte_symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """key, n_bytes, removed (byte runs start, end), n_removed, n_spans, kept_sha256, kept (the bytes that stay)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("uid"))
    once = bucketed(rows.groupBy("uid").agg(F.first("text").alias("text"), F.count("*").alias("copies")), "texts", "uid")
    spans = repeated_starts(once.where(F.octet_length("text") >= width).select("uid", F.lit(0).cast("long").alias("doc"), "text"), byte_symbols, width, gram, first_stays=False)

    schema = "uid binary, n_bytes long, removed array<struct<start:long,end:long>>, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def cut(batches):
        for batch in batches:
            out = []
            for uid, body, copies, runs in zip(batch["uid"], batch["text"], batch["copies"], batch["spans"], strict=True):
                raw = np.frombuffer(body.encode("utf-8", "surrogatepass"), np.uint8)
                gone = np.ones(len(raw), bool) if copies > 1 and len(raw) >= width else covered(len(raw), width, runs)
                step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                pairs = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
                kept = raw[~gone].tobytes()
                out.append((uid, len(raw), pairs, int(gone.sum()), len(pairs), hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["uid", "n_bytes", "removed", "n_removed", "n_spans", "kept_sha256", "kept"])

    results = once.join(spans.hint("shuffle_hash"), "uid", "left").mapInPandas(cut, schema)
    return rows.select(F.col("key").alias(key), "uid").join(results, "uid").drop("uid")


@query("op4_suffix_ranges")
def op4(spark, folder):
    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
