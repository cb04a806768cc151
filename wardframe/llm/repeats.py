"""Repeats of a fixed width inside a corpus, found from sparse anchors: shared by the two substring operators.

A text is an array of symbols (bytes or word hashes).  The anchor of a window is its gram with the least
hash (the leftmost among equals); equal windows have equal anchors at equal places, and the windows of a
text fall into runs with one anchor, so only about one record in half a window is needed.  Records are
range-partitioned by sampled splitters on the 64-bit hash of their core, sorted by hashes inside the ranges, and compared with
their neighbours; groups that reach over a boundary are settled from one row per boundary.  The row's own
place ends the sort key, so a gram that millions of texts share is spread over many ranges.

Three rounds of shrinking stride: whole runs, then 16 starts, then single starts.  A record holds the hash
of its core (what all its windows share) and of its whole.  An equal whole settles all its windows; an
unequal whole whose core is met elsewhere goes on to the next round with one record of each settled group.
Hashes have 128 bits for wholes, 64 for cores, where a collision costs work and no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.text import mixed
from wardframe.sources.scratch import erased, materialised, written

RANGE_ROWS = 200_000
#: rows of records that a task hands over at a time
FRAME_ROWS = 50_000
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_SALT = 0x51ED2701
_BYTES = [mixed(np.arange(256, dtype=np.uint64) + np.uint64(salt * _SALT)) for salt in range(len(_BASES))]
_FIELDS = ["core", "f1", "f2", "lo", "hi"]
_RECORD = "core long, f1 long, f2 long, lo int, hi int, doc long, uid binary"


class Prints:
    """Hashes of any span of a symbol array in constant time each."""

    _powers: list[tuple[np.ndarray, np.ndarray]] = []

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        if not Prints._powers or len(Prints._powers[0][0]) <= n:
            with np.errstate(over="ignore"):
                Prints._powers = [
                    tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n + 1024, b, dtype=np.uint64))]) for b in (base, np.uint64(pow(int(base), -1, 1 << 64))))
                    for base in _BASES]
        self._sums = []
        with np.errstate(over="ignore"):
            for salt, (up, _) in enumerate(Prints._powers):
                coded = _BYTES[salt][symbols] if symbols.dtype == np.uint8 else mixed(symbols + np.uint64(salt * _SALT))
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(coded * up[:n], out=sums[1:])
                self._sums.append(sums)

    def spans(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self._sums[which][end] - self._sums[which][start]) * Prints._powers[which][1][start] + (end - start).astype(np.uint64))


    def grams(self, gram: int) -> np.ndarray:
        """A hash of every span of ``gram`` symbols, in order; its high bits are the good ones."""
        sums = self._sums[0]
        with np.errstate(over="ignore"):
            return (sums[gram:] - sums[:-gram]) * Prints._powers[0][1][:len(sums) - gram]


def anchors(prints: Prints, n: int, width: int, gram: int) -> np.ndarray:
    """The anchor's place for every window start: argmin of the gram hashes, leftmost among equals.

    The low bits of a hash make room for the place, so that one sliding minimum finds both.
    """
    places, bits = n - gram + 1, np.uint64(n.bit_length())
    best = (prints.grams(gram) >> bits << bits) | np.arange(places, dtype=np.uint64)
    span, length, starts = width - gram + 1, 1, n - width + 1
    while 2 * length <= span:
        best = np.minimum(best[:-length], best[length:])
        length *= 2
    best = np.minimum(best[:starts], best[span - length:span - length + starts])
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def records(symbols: np.ndarray, width: int, gram: int, stride: int, runs: list[tuple[int, int]] | None) -> np.ndarray:
    """Rows (core, f1, f2, lo, hi) of one text; lo..hi are window starts.  ``runs`` limits later rounds."""
    n = len(symbols)
    if n < width:
        return np.empty((0, 5), np.int64)
    prints = Prints(symbols)
    if stride == 0:
        at = anchors(prints, n, width, gram)
        edge = np.flatnonzero(np.diff(at)) + 1
        lo, hi = np.concatenate([[0], edge]), np.concatenate([edge - 1, [len(at) - 1]])
        core = prints.spans(at[lo], at[lo] + gram)
        rel = at[lo] - lo  # a run is equal only when it also lies alike around its anchor
        f1, f2 = (mixed(prints.spans(lo, hi + width, w) + rel.astype(np.uint64)) for w in (0, 1))
        return np.stack([_signed(core), _signed(f1), _signed(f2), lo, hi], axis=1)
    if not runs:
        return np.empty((0, 5), np.int64)
    wanted = np.zeros(n - width + 1, bool)
    for a, b in runs:
        wanted[a:b + 1] = True
    starts = np.flatnonzero(wanted)
    if stride == 1:
        f1, f2 = prints.spans(starts, starts + width), prints.spans(starts, starts + width, 1)
        return np.stack([_signed(f1), _signed(f1), _signed(f2), starts, starts], axis=1)
    at = anchors(prints, n, width, gram)
    place, back = at[starts], (at[starts] - starts) // stride  # chunks are counted from the anchor
    keys = np.unique(np.stack([place, back], axis=1), axis=0)
    place, back = keys[:, 0], keys[:, 1]
    high, low = place - stride * back, place - stride * back - stride + 1  # last and first start of the chunk
    # what all its windows share: from the last start to the end of the first window
    core = mixed(prints.spans(high, low + width) + back.astype(np.uint64))
    full = (low >= 0) & (high + width <= n)
    safe_lo, safe_hi = np.where(full, low, high), np.where(full, high + width, high)
    f1, f2 = prints.spans(safe_lo, safe_hi), prints.spans(safe_lo, safe_hi, 1)
    alone = mixed(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n))
    f2 = np.where(full, f2, alone)
    f1 = np.where(full, f1, alone ^ prints.spans(np.zeros(1, np.int64), np.array([n])))
    return np.stack([_signed(core), _signed(f1), _signed(f2), np.maximum(low, 0), np.minimum(high, n - width)], axis=1)


def _edges(keys: list[np.ndarray]) -> np.ndarray:
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frames = [b for b in batches if len(b)]
    if not frames:
        return
    frame = pd.concat(frames, ignore_index=True)
    for name, keys in (("core", ["core"]), ("full", ["core", "f1", "f2"])):
        new = _edges([frame[k].to_numpy() for k in keys])
        group = np.cumsum(new) - 1
        frame[f"{name}_n"], frame[f"{name}_edge"] = np.bincount(group)[group].astype(np.int64), (group == 0) | (group == group[-1])
    frame["full_min"], frame["rep"] = frame["doc"].to_numpy()[new][group], new
    yield frame[(frame["core_n"] > 1) | frame["core_edge"]]


def compared(rows: DataFrame) -> DataFrame:
    """Records that share their core, with how many share it and their whole, and the least doc among equal wholes."""
    spark = rows.sparkSession
    rows, folder = written(rows, "records")
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    order = ["core", "f1", "f2", "doc", "uid", "lo"]
    schema = _RECORD + ", core_n long, core_edge boolean, full_n long, full_edge boolean, full_min long, rep boolean"
    # a core that no other record has, with neighbours on both sides, ends here: most records do
    local = materialised(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInPandas(_local, schema), "compared")
    erased(spark, folder)
    # groups at a boundary: at most two of each kind per range
    cores = local.where("core_edge").groupBy("core").agg(F.count("*").alias("c_n"))
    fulls = local.where("full_edge").groupBy("core", "f1", "f2").agg(F.count("*").alias("g_n"), F.min("doc").alias("g_min"))
    out = local.join(F.broadcast(cores), "core", "left").join(F.broadcast(fulls), ["core", "f1", "f2"], "left")
    return out.select("doc", "uid", "lo", "hi", "rep", F.coalesce("c_n", "core_n").alias("core_n"),
                      F.coalesce("g_n", "full_n").alias("full_n"), F.coalesce("g_min", "full_min").alias("full_min"))


def repeated_starts(texts: DataFrame, symbols: Callable[[str], np.ndarray], width: int, gram: int, first_stays: bool) -> DataFrame:
    """uid, spans: runs [lo, hi] of window starts to remove.

    ``texts`` holds uid (unique, binary), doc (long, not null) and text, best in buckets of uid.  Without
    ``first_stays`` a window is removed when it is met anywhere else; with it, when a smaller doc holds it.
    """
    found: list[DataFrame] = []
    todo: DataFrame | None = None
    for stride in (0, 16, 1):
        def make(batches: Iterator[pd.DataFrame], stride: int = stride) -> Iterator[pd.DataFrame]:
            def frame(parts: list[np.ndarray], docs: list[int], uids: list[bytes]) -> pd.DataFrame:
                counts, whole = [len(p) for p in parts], np.concatenate(parts)
                out = pd.DataFrame({name: whole[:, i] for i, name in enumerate(_FIELDS)})
                out["doc"], out["uid"] = np.repeat(np.array(docs, np.int64), counts), np.repeat(np.array(uids, object), counts)
                return out

            for batch in batches:
                spans = batch["spans"] if "spans" in batch else [None] * len(batch)
                parts, docs, uids, rows = [], [], [], 0
                for uid, doc, text, runs in zip(batch["uid"], batch["doc"], batch["text"], spans, strict=True):
                    got = records(symbols(text), width, gram, stride, None if runs is None else [(r["lo"], r["hi"]) for r in runs])
                    if len(got):
                        parts.append(got)
                        docs.append(doc)
                        uids.append(uid)
                        rows += len(got)
                    if rows >= FRAME_ROWS:
                        yield frame(parts, docs, uids)
                        parts, docs, uids, rows = [], [], [], 0
                if rows:
                    yield frame(parts, docs, uids)

        source = texts.select("uid", "doc", "text")
        if todo is not None:
            source = source.join(todo.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")).hint("shuffle_hash"), "uid")
        judged = compared(source.mapInPandas(make, _RECORD))
        remove = (F.col("doc") > F.col("full_min")) if first_stays else (F.col("full_n") >= 2)
        found.append(judged.where(remove).select("uid", "lo", "hi"))
        # where all that share a core are equal, smaller pieces of it would say the same
        todo = judged.where((F.col("core_n") > F.col("full_n")) & (F.col("rep") | ~remove))
    every = found[0].unionByName(found[1]).unionByName(found[2])
    return every.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def covered(n: int, width: int, spans) -> np.ndarray:
    """Which of n symbols lie in a removed window."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans if spans is not None else ():
        edge[s["lo"]] += 1
        edge[min(n, s["hi"] + width)] -= 1
    return np.cumsum(edge)[:-1] > 0
