"""Alignment of two tokenizations of the same text by pointer jumping.

Both tokenizers cut the bytes of " " + text into a row of tokens.  Every token points to the overlapping token
that ends farthest to the right (to itself if none ends later); doubling the successors of all tokens at once,
``s = s[s]``, ends in the terminal token of each chain.  Tokens with one terminal are one group, and groups end
exactly where a token of either side ends at the same byte.

A text is encoded in pieces that start at a space after a character that is no white space.  Neither tokenizer
joins bytes across such a place (the byte-level pattern takes at most one leading space; pieces of the other
hold spaces only in front, which is checked when it is loaded), so the pieces' tokens are the text's tokens, and each
distinct piece is encoded and aligned once per task.  Texts with characters outside ``PLAIN`` are one piece, for
there the patterns' tables of letters could differ.

Link counts of id pairs are summed over the corpus.  Pairs with at least 1 / ``HOT_SHARE`` of all links (there are
at most ``HOT_SHARE`` of them) are broadcast, all other pairs meet their counts in a shuffled join.

Defined cases: null and empty texts, and texts that either tokenizer changes, have no tokens (zeros and an empty
``groups_sha256``); repeated rows are counted each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.sources.scratch import materialised

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: characters whose class is the same in every Unicode version that a tokenizer's pattern may follow
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏΑ-ΡΣ-ώА-я‐-‧€ぁ-ゖァ-ヺ一-龥가-힣]*")
_NOT_ONE_SPACE = re.compile(r"\s[\x20]|^[\x20]|[\x20]$")
_CUT = re.compile(r"(?<=\S)[\x20]")
HOT_SHARE = 1 << 17
#: characters of text that a task aligns at a time, and distinct pieces that it keeps
CHARS, KEPT_PIECES = 1_500_000, 200_000
_LOW = np.int64(0xFFFFFFFF)


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else the next free code from 256."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, folder: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(os.path.join(folder, BYTE_LEVEL))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, at in self.a.get_vocab().items():
            self.a_bytes[at] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.in_pieces = not any("▁" in p.lstrip("▁") for p in names)
        # bytes and printed forms of all tokens, to be taken by arrays of ids
        self.a_raw, self.b_raw = np.array(self.a_bytes, object), np.array(self.b_bytes, object)
        self.a_print, self.b_print = (np.array([[b"%d%s" % (i, mark) for mark in (b",", end)] for i in range(n)], object)
                                      for n, end in ((len(self.a_bytes), b"|"), (len(self.b_bytes), b";")))
        self.a_len, self.b_len = (np.array([len(b) for b in raw], np.int64) for raw in (self.a_bytes, self.b_bytes))

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of " " + piece on both sides."""
        return [e.ids for e in self.a.encode_batch([" " + p for p in pieces], add_special_tokens=False)], self.b.encode(pieces, num_threads=1)


@lru_cache(maxsize=2)
def tokenizers_in(folder: str) -> Tokenizers:
    return Tokenizers(folder)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The terminal token of each token (first side first) of two rows of tokens that end at these bytes."""
    n_a = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends - 1, side="right")  # the token of B that holds A's last byte, and the reverse
    over_b = np.searchsorted(a_ends, b_ends - 1, side="right")
    own = n_a + np.arange(len(b_ends))
    successor = np.concatenate([n_a + over_a, np.where(a_ends[over_b] > b_ends, over_b, own)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all overlapping tokens."""
    starts = np.concatenate([[0], a_ends[:-1]])
    first, last = np.searchsorted(b_ends, starts, side="right"), np.searchsorted(b_ends, a_ends - 1, side="right")
    each = last - first + 1
    of_a = np.repeat(np.arange(len(a_ends)), each)
    return of_a, first[of_a] + np.arange(len(of_a)) - np.repeat(np.cumsum(each) - each, each)


def pieces_of(text: str, in_pieces: bool = True) -> list[str]:
    """The pieces of " " + text, each without its leading space."""
    if not in_pieces or not PLAIN.fullmatch(text):
        return [text]
    if not _NOT_ONE_SPACE.search(text):
        return text.split(" ")
    found = _CUT.split(text)
    return found if all(found) else [text]


class Aligned:
    """Distinct pieces with their tokens, groups and links, as they come up in a task."""

    def __init__(self, tools: Tokenizers):
        self.tools, self.known, self.pair_ids, self.pairs = tools, {}, {}, []
        self.groups: list[bytes] = []
        self.sizes = np.empty((0, 5), np.int64)  # right (1 or 0), tokens of A, tokens of B, groups, links
        self.flat, self.first = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, pieces: list[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if p not in self.known]
        if not new:
            return
        tools = self.tools
        a_ids, b_ids = tools.encode(new)
        used = self._unchanged(new, a_ids, b_ids)
        sizes = np.zeros((len(new), 5), np.int64)
        names, flat = [b""] * len(new), np.empty(0, np.int64)
        if len(used):
            if len(used) < len(new):
                a_ids, b_ids = ([ids[i] for i in used] for ids in (a_ids, b_ids))
            flat_a, n_a = _flat(a_ids)
            flat_b, n_b = _flat(b_ids)
            a_ends, b_ends = np.cumsum(tools.a_len[flat_a]), np.cumsum(tools.b_len[flat_b])
            _, group = np.unique(terminals(a_ends, b_ends), return_inverse=True)
            group_a, group_b = group[:len(flat_a)], group[len(flat_a):]
            of_a, of_b = np.repeat(np.arange(len(used)), n_a), np.repeat(np.arange(len(used)), n_b)
            left, right = links(a_ends, b_ends)
            sizes[used, 0], sizes[used, 1], sizes[used, 2] = 1, n_a, n_b
            sizes[used, 3] = np.bincount(of_b[np.flatnonzero(np.diff(group_b, append=-1))], minlength=len(used))
            sizes[used, 4] = np.bincount(of_a[left], minlength=len(used))
            for name, at in zip(_named(tools, group_a, group_b, flat_a, flat_b, n_a, n_b), used.tolist(), strict=True):
                names[at] = name
            codes, inverse = np.unique(flat_a[left] << 32 | flat_b[right], return_inverse=True)
            for code in codes.tolist():
                if code not in self.pair_ids:
                    self.pair_ids[code] = len(self.pairs)
                    self.pairs.append(code)
            flat = np.array([self.pair_ids[c] for c in codes.tolist()], np.int64)[inverse]
        for piece in new:
            self.known[piece] = len(self.known)
        self.groups += names
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(sizes[:, 4]) - sizes[:, 4]])
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])


    def _unchanged(self, pieces: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> np.ndarray:
        """Positions of the pieces whose bytes both sides keep."""
        tools, raw = self.tools, [(" " + p).encode() for p in pieces]
        right, lengths, whole = np.ones(len(pieces), bool), np.array([len(r) for r in raw]), b"".join(raw)
        for ids, of, length in ((a_ids, tools.a_raw, tools.a_len), (b_ids, tools.b_raw, tools.b_len)):
            flat, n = _flat(ids)
            total = np.concatenate([[0], np.cumsum(length[flat])])
            last = np.cumsum(n)
            if not np.array_equal(total[last] - total[last - n], lengths) or b"".join(of[flat].tolist()) != whole:
                right &= [b"".join(of[i].tolist()) == r for i, r in zip(ids, raw, strict=True)]
        return np.flatnonzero(right)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each piece has."""
    n = np.array([len(i) for i in ids], np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


def _named(tools: Tokenizers, group_a, group_b, flat_a, flat_b, n_a, n_b) -> Iterator[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each piece."""
    last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
    # a group's tokens of A stand before its tokens of B
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    parts = np.concatenate([tools.a_print[flat_a, last_a.astype(int)], tools.b_print[flat_b, last_b.astype(int)]])[order].tolist()
    begin = 0
    for end in np.cumsum(n_a + n_b).tolist():
        yield b"".join(parts[begin:end])[:-1]
        begin = end


_PAIR = pa.struct([("code", pa.int64()), ("n", pa.int64())])
_OUT = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(_PAIR))])


def _aligner(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers_in(folder)
        state = Aligned(tools)
        for batch in batches:
            texts, done = batch.column("text").to_pylist(), 0
            while done < len(texts):
                upto, chars = done, 0
                while upto < len(texts) and chars < CHARS:
                    chars += len(texts[upto] or "")
                    upto += 1
                if len(state.known) > KEPT_PIECES:
                    state = Aligned(tools)
                part = texts[done:upto]
                cut = [pieces_of(t, tools.in_pieces) if t else [] for t in part]
                state.add([p for c in cut for p in c])
                found = [[state.known[p] for p in c] for c in cut]
                right = [bool(f) and bool(state.sizes[f, 0].all()) for f in found]
                found = [f if ok else [] for f, ok in zip(found, right, strict=True)]
                which = np.array([i for f in found for i in f], np.int64)
                doc = np.repeat(np.arange(len(part)), [len(f) for f in found])
                totals = np.zeros((len(part), 4), np.int64)
                np.add.at(totals, doc, state.sizes[which, 1:])
                each = state.sizes[which, 4]
                at = np.repeat(state.first[which] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
                width = max(1, len(state.pairs))
                met, times = np.unique(np.repeat(doc, each) * width + state.flat[at], return_counts=True)
                ends = np.searchsorted(met, np.arange(len(part) + 1) * width)
                codes = np.array(state.pairs, np.int64)[met % width] if len(met) else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(codes), pa.array(times.astype(np.int64))], fields=list(_PAIR)))
                digests = [hashlib.sha256(b";".join([state.groups[i] for i in f])).hexdigest() if f else "" for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row")[done:upto], batch.column("key")[done:upto], *(pa.array(totals[:, i]) for i in range(4)), pa.array(digests), lists], schema=_OUT)
                done = upto
    return run


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "row long, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<code:long,n:long>>"
    aligned = materialised(rows.mapInArrow(_aligner(folder), schema), "aligned")

    each = aligned.select("row", F.inline("pairs"))
    counts = materialised(each.groupBy("code").agg(F.sum("n").alias("total")).withColumn("b", F.col("code").bitwiseAND(int(_LOW))), "pair-counts")
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    counts = materialised(counts.join(most, "b").select("code", "total", (F.col("total") == F.col("most")).cast("long").alias("best")), "pair-counts")
    all_links = counts.agg(F.sum("total")).first()[0] or 0
    often = F.broadcast(counts.where(F.col("total") * HOT_SHARE >= F.lit(all_links)))  # HOT_SHARE rows at most
    per_row = [F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")]
    seldom = each.join(often.select("code"), "code", "left_anti").join(counts, "code")
    sums = each.join(often, "code").groupBy("row").agg(*per_row).unionByName(seldom.groupBy("row").agg(*per_row))
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs").join(sums, "row", "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


@query("op11_pointer_alignment")
def op11(spark, folder):
    return align(table(spark, folder, "documents"))
