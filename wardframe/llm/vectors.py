"""Near-duplicate vectors by an exact metric range join.

On unit vectors a cosine of at least c is a Euclidean distance of at most eps = sqrt(2 - 2c).  Equal vectors are
one class before anything else.  Pivots partition the classes: each belongs to the cell of its nearest pivot.  A
link can leave cell i for cell j only if d(x, p_j)^2 - d(x, p_i)^2 <= 2 eps |p_i - p_j|, which follows from
the triangle inequality and is sharper than d(x, p_j) <= d(x, p_i) + 2 eps; such x are replicated to cell j, to the
later cell of each pair only, so every pair meets once.  Inside a cell classes lie in rings of width eps / 2 about
the pivot: rings more than three apart cannot hold a link, and members of the innermost ring are linked with each
other without a look, so a dense group about a pivot costs no comparisons.  Rings are cut into blocks of
``BLOCK`` classes, and pairs of blocks are joined independently.

Pivots come from ``SAMPLE`` classes (a bounded sample, the least by hash): first the middles of dense groups, then
points far from all pivots.  They decide the cost only; no link depends on them.  Where vectors spread evenly in
many dimensions, balls of this size touch nearly all cells and the join compares nearly all pairs, block by block.

A pair of blocks returns the number of links of each class and one edge from each class to the least of its local
component, never the pairs.  Single precision decides only outside a margin around c, double precision within.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
vectors of different lengths; repeated rows link with each other; rows with a null id link others but never
name a component while another id is there; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.neardup import components
from wardframe.llm.registry import query, table
from wardframe.sources.scratch import materialised

COSINE = 0.9
#: classes in a block; classes that the pivots are chosen from; pivots at most
BLOCK, SAMPLE, MOST_PIVOTS = 8192, 4096, 512
#: sampled neighbours within eps / 2 that make the middle of a dense group
DENSE = 4
#: rows of a block that are compared at a time
STRIP = 1024
#: cosines nearer to the bound than this are taken again in double precision
MARGIN = 1e-4
_SLACK = 1e-9


def unit(vectors) -> np.ndarray:
    """Unit vectors in double precision, scaled first so that no square over- or underflows."""
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, eps: float, spread: int) -> np.ndarray:
    """Middles of dense groups, then ``spread`` points far from all pivots at least while there are any."""
    if not len(sample):
        return sample
    near = sample @ sample.T >= 1 - (eps / 2) ** 2 / 2
    free, chosen = np.ones(len(sample), bool), []
    while len(chosen) < MOST_PIVOTS - spread:
        weight = np.where(free, (near & free).sum(axis=1), 0)
        best = int(weight.argmax())
        if weight[best] <= DENSE:
            break
        chosen.append(best)
        free &= ~near[best]
    reach = (sample @ sample[chosen].T).max(axis=1) if chosen else np.full(len(sample), -1.0)
    for _ in range(min(spread, len(sample))):
        best = int(reach.argmin())
        chosen.append(best)
        reach = np.maximum(reach, sample @ sample[best])
    return sample[chosen]


def _placer(pivots: dict[int, np.ndarray], eps: float):
    """cell, home, ring of every class in its own cell and in the later cells that a link of it may reach."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apart = {dim: np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) for dim, p in pivots.items()}
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                p, x = pivots[dim], unit(rows["vec"])
                dots = x @ p.T
                own = dots.argmax(axis=1)
                # d_j^2 - d_i^2 = 2 (x.p_i - x.p_j)
                reached = (dots[np.arange(len(x)), own][:, None] - dots <= eps * apart[dim][own] + _SLACK) & (np.arange(len(p)) > own[:, None])
                reached[np.arange(len(x)), own] = True
                at, cell = np.nonzero(reached)
                distance = np.sqrt(np.maximum(0, 2 - 2 * dots[at, cell]))
                ring = np.floor(distance / (eps / 2 * (1 - _SLACK))).astype(np.int64)
                yield pd.DataFrame({"cell": cell, "home": own[at] == cell, "ring": ring, "dim": dim, "cid": rows["cid"].to_numpy()[at],
                                    "m": rows["m"].to_numpy()[at], "vec": rows["vec"].to_numpy()[at]})
    return run


def _joined(cosine: float):
    """One pair of blocks: links of each class (a class of m equal vectors counts m) and edges to the least of its local component."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame["first"].to_numpy(bool)
        ids, m, x = frame["cid"].to_numpy(), frame["m"].to_numpy(), unit(frame["vec"])
        left = np.flatnonzero(first)
        same = bool(frame["same"].iloc[0])
        right = left if same else np.flatnonzero(~first)
        single, label, n = x.astype(np.float32), np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for at in range(0, len(left), STRIP):
            mine = left[at:at + STRIP]
            other = right[at:] if same else right
            dots = single[mine] @ single[other].T
            linked = dots >= cosine - MARGIN
            if same:  # each pair once
                linked[np.tril_indices(len(mine))] = False
            i, j = np.nonzero(linked)
            close = dots[i, j] < cosine + MARGIN
            i, j = mine[i], other[j]
            for k in np.flatnonzero(close):
                close[k] = float((x[i[k]] * x[j[k]]).sum()) < cosine
            i, j = i[~close], j[~close]
            n += np.bincount(i, m[j], len(n)).astype(np.int64) + np.bincount(j, m[i], len(n)).astype(np.int64)
            while len(i):  # pointers to the least label, followed to their ends
                low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
                open_ = low < high
                i, j = i[open_], j[open_]
                np.minimum.at(label, high[open_], low[open_])
                while (label[label] != label).any():
                    label = label[label]
        met = np.flatnonzero(n)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, ids)
        return pd.DataFrame({"cid": ids[met], "n": n[met], "root": least[label[met]]})
    return run


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """key, n_links, component_id, kept: one row per vector; ``cosine`` above 0 is the least of a link."""
    if not 0 < cosine < 1:
        raise ValueError("cosine between 0 and 1")
    eps = float(np.sqrt(2 - 2 * cosine))
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    held = rows.select(F.col(key).cast("long").alias("key"), v.alias("vec"), F.coalesce(fine, F.lit(False)).alias("fine")).select(
        "key", F.when(F.col("fine"), F.xxhash64(F.lit(1), "vec")).alias("h1"), F.when(F.col("fine"), F.xxhash64(F.lit(2), "vec")).alias("h2"), "fine", "vec")
    classes = materialised(held.where("fine").groupBy("h1", "h2").agg(
        F.count("*").alias("m"), F.min("key").alias("least"), F.first("vec").alias("vec")).select(
        "*", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("cid")), "vector-classes")

    counts = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row per vector length
    pivots = {}
    for dim, n in counts.items():
        sample = classes.where(F.col("dim") == dim).orderBy("h1", "h2").limit(SAMPLE).select("vec").toPandas()
        pivots[dim] = choose_pivots(unit(sample["vec"]), eps, min(MOST_PIVOTS // 2, -(-n // block)))
    placed = materialised(classes.select("cid", "dim", "m", "vec").mapInPandas(
        _placer(pivots, eps), "cell long, home boolean, ring long, dim int, cid long, m long, vec array<double>"), "cells")

    # all pairs in the innermost ring of a cell are links
    inner = placed.where("home AND ring = 0").select("dim", "cell", "cid", "m")
    cores = inner.groupBy("dim", "cell").agg(F.sum("m").alias("all"), F.min("cid").alias("root"))  # one row per pivot at most
    sure = inner.join(F.broadcast(cores), ["dim", "cell"]).select("cid", (F.col("all") - F.col("m")).alias("n"), "root")

    group = ["dim", "cell", "home", "ring"]
    sizes = placed.groupBy(*group).agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / block).cast("long"))  # some 30 rows per pivot at most
    other = sizes.select("dim", "cell", F.col("home").alias("home2"), F.col("ring").alias("ring2"), F.col("blocks").alias("blocks2"))
    meets = sizes.join(other, ["dim", "cell"]).where((F.abs(F.col("ring") - F.col("ring2")) <= 3) & (F.col("home") | F.col("home2")) & ~(
        F.col("home") & F.col("home2") & (F.col("ring") == 0) & (F.col("ring2") == 0)))
    meets = meets.groupBy(*group).agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct("home2", "ring2", "blocks2")).alias("with"))
    dealt = placed.join(F.broadcast(meets), group).withColumn("sub", F.pmod(F.xxhash64("cid"), F.col("blocks"))).select("*", F.explode("with").alias("w")).select(
        "dim", "cell", "cid", "m", "vec", F.struct("home", "ring", "sub").alias("here"), "w",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("w.blocks2") - 1)).alias("sub2"))
    there = F.struct(F.col("w.home2").alias("home"), F.col("w.ring2").alias("ring"), F.col("sub2").alias("sub"))
    dealt = dealt.withColumn("there", there).select(
        "dim", "cell", F.least("here", "there").alias("a"), F.greatest("here", "there").alias("b"), (F.col("here") <= F.col("there")).alias("first"),
        (F.col("here") == F.col("there")).alias("same"), "cid", "m", "vec")
    found = dealt.groupBy("dim", "cell", "a", "b").applyInPandas(_joined(cosine), "cid long, n long, root long")
    found = materialised(found.unionByName(sure), "vector-links")

    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("cid").agg(F.sum("n").alias("n"))
    named = classes.join(linked, "cid", "left").join(roots, F.col("cid") == F.col("node"), "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "least", F.coalesce("root", "cid").alias("root"))
    named = materialised(named, "vector-classes")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = named.join(least, "root").select("h1", "h2", "n_links", "component_id")
    out = held.select("key", "h1", "h2").join(answer, ["h1", "h2"], "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec FROM embeddings),
good AS (
  SELECT rid, vec_id, vec, sqrt(list_sum(list_transform(vec, lambda x: x * x))) AS norm FROM v
  WHERE vec IS NOT NULL AND len(vec) > 0 AND len(list_filter(vec, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vec, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b, b.vec_id AS other FROM good a JOIN good b ON a.rid <> b.rid AND len(a.vec) = len(b.vec)
  WHERE list_inner_product(a.vec, b.vec) >= 0.9 * a.norm * b.norm),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT r.a, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.rid = r.b GROUP BY r.a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(least(v.vec_id, least.component_id), v.vec_id) AS component_id,
       v.vec_id IS NOT DISTINCT FROM coalesce(least(v.vec_id, least.component_id), v.vec_id) AS kept
FROM v LEFT JOIN n ON n.a = v.rid LEFT JOIN least ON least.a = v.rid
"""


@query("op13_metric_range_join", SQL)
def op13(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))
