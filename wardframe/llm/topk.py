"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Vectors are turned into integers and dealt into blocks; in a block every dimension has its list of rows in
the order of their value.  A query walks its lists from the end that its sign prefers, scores what it meets
by random access, and stops once it has met the whole block or the bound (the sum of its weights times the last values seen) is below its
kth score; equal bounds go on, for ties fall to the smaller id.  The best k of each block meet in one small
group per query.  Queries meet the rows in pieces (row block x query block), so a task holds two bounded
blocks whatever the size of the table.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of
different lengths are never compared; a null id is no query and loses ties; repeated rows are candidates of
each other; extra columns are not read.  Scores are exact while they fit a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.sources.scratch import materialised

ROW_BLOCK, QUERY_BLOCK = 8192, 2048
_NO_ID = (1 << 63) - 1


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """row, id, dim, vec: floor(scale * x) of the usable vectors, written once."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return materialised(rows.where(F.coalesce(fine, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.size(vector).alias("dim"),
        F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("vec")), "vectors")


def threshold_topk(ids: np.ndarray, rows: np.ndarray, values: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int) -> list[int]:
    """Positions of the k best rows of one block for one query, by score, id and row; ``own`` is left out."""
    n, dims = values.shape
    used = np.flatnonzero(query)
    if not len(used):
        used = np.arange(min(1, dims))
    rising, falling = used[query[used] <= 0], used[query[used] > 0]
    met, scores, other = np.zeros(n, bool), np.zeros(n, values.dtype), rows != own
    depth, step = 0, max(2 * k, 16)
    while depth < n:
        upto, before = min(n, depth + step), met.copy()
        met[lists[depth:upto, rising]] = True
        met[lists[n - upto:n - depth, falling]] = True
        new = np.flatnonzero(met & ~before)
        # a large share of the block is scored in one product, without a copy of its rows
        scores[new] = (values @ query)[new] if 4 * len(new) > n else values[new] @ query
        depth, step = upto, step * 2
        if met.all():
            break
        real = scores[met & other]
        if len(real) >= k:
            kth = np.partition(real, -k)[-k]
            if (values[lists[depth - 1, rising], rising] @ query[rising]) + (values[lists[n - depth, falling], falling] @ query[falling]) < kth:
                break
    seen = np.flatnonzero(met)
    scores = scores[seen]
    real = np.flatnonzero(rows[seen] != own)
    if len(real) > k:
        kth = np.partition(scores[real], -k)[-k]
        real = real[scores[real] >= kth]
    order = np.lexsort((rows[seen[real]], ids[seen[real]], -scores[real]))[:k]
    return [(int(seen[i]), int(scores[i])) for i in real[order]]


def top_k(rows: DataFrame, is_query: F.Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score.  ``is_query`` is a condition on ``id`` (the key)."""
    vectors = integer_vectors(rows, key, vector, scale)
    n_rows, n_queries = vectors.agg(F.count("*"), F.count(F.when(is_query & F.col("id").isNotNull(), 1))).first()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    def grid(frame: DataFrame, mine: str, n_mine: int, other: str, n_other: int) -> DataFrame:
        return frame.withColumn(mine, F.pmod(F.xxhash64("row"), F.lit(n_mine))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))

    left = grid(vectors.withColumn("id", F.coalesce("id", F.lit(_NO_ID))), "rb", row_blocks, "qb", query_blocks)
    right = grid(vectors.where(is_query & F.col("id").isNotNull()), "qb", query_blocks, "rb", row_blocks)

    def search(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(have) and len(ask):
            values, wants = np.stack(have["vec"].to_numpy()).astype(np.int64), np.stack(ask["vec"].to_numpy()).astype(np.int64)
            peak = float(np.abs(values.astype(float)).max()) * float(np.abs(wants.astype(float)).max()) * values.shape[1]
            if peak < 2**53:  # sums of such products are whole numbers that a double holds
                values, wants = values.astype(np.float64), wants.astype(np.float64)
            ids, own, lists = have["id"].to_numpy(np.int64), have["row"].to_numpy(np.int64), np.argsort(values, axis=0, kind="stable").astype(np.int32)
            for q_row, q_id, q in zip(ask["row"], ask["id"], wants, strict=True):
                for at, score in threshold_topk(ids, own, values, lists, q, q_row, k):
                    out.append((q_row, int(q_id), own[at], int(ids[at]), score))
        return pd.DataFrame(out, columns=["q_row", "query_id", "row", "vec_id", "score"], dtype=np.int64)

    found = left.groupBy("dim", "rb", "qb").cogroup(right.groupBy("dim", "rb", "qb")).applyInPandas(search, "q_row long, query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("q_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")).alias("vec_id"), "score")


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid AS qrid, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score, c.rid AS rid
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qrid ORDER BY score DESC, vec_id NULLS LAST, rid) AS rank FROM s) WHERE rank <= 5
"""


@query("op3_threshold_topk", SQL)
def op3(spark, folder):
    return top_k(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
