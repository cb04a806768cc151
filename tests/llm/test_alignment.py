"""Token alignment against whole-text encodings, all pairs of tokens and a search for common ends."""

import hashlib
import os
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest

from wardframe.llm import alignment

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.FOLDER), reason="tokenizer files are not here")
TABLES = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_a string, row string, pairs int"
HARD = [None, "", " ", "\n", "  two  spaces ", "a\n  b\t c", "ends in space ", "it's don't we'll", "<|endoftext|> is <s> text </s>", "▁ low line", "<0x41>",
        "日本語の テキスト 中文", "naïve façade — ‘quoted’", "😀 smile 👩‍👩‍👧", "zero​width", "non breaking", "x" * 3000, "word " * 4000, "tab\ttab\r\nline", "ünï çödé ünï çödé"]


def brute(texts):
    """Per text the contract's columns, by comparing byte ranges."""
    tools = alignment.tokenizers_in(alignment.FOLDER)
    tokens, counts = [], Counter()
    for text in texts:
        got = None
        if text:
            (a,), (b,) = tools.encode([text])
            raw = (" " + text).encode()
            if b"".join(tools.a_bytes[i] for i in a) == raw == b"".join(tools.b_bytes[i] for i in b):
                spans, got = [], []
                for ids, of in ((a, tools.a_bytes), (b, tools.b_bytes)):
                    ends = np.cumsum([len(of[i]) for i in ids]).tolist()
                    spans.append(list(zip([0, *ends[:-1]], ends, ids, strict=True)))
                at = 0
                for s, e, i in spans[0]:
                    while spans[1][at][1] <= s:
                        at += 1
                    j = at
                    while j < len(spans[1]) and spans[1][j][0] < e:
                        got.append((i, spans[1][j][2]))
                        j += 1
                counts.update(got)
                got = (spans, got)
        tokens.append(got)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    for got in tokens:
        if got is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        (a, b), met = got
        both = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, begin = [], 0
        by_end = [{}, {}]
        for side, spans in enumerate((a, b)):
            for _, e, i in spans:
                by_end[side].setdefault(both[bisect_left(both, e)], []).append(str(i))
        groups = [",".join(by_end[0][e]) + "|" + ",".join(by_end[1][e]) for e in both]
        yield (len(a), len(b), len(both), len(met), sum(counts[p] == best[p[1]] for p in met), sum(counts[p] for p in met), hashlib.sha256(";".join(groups).encode()).hexdigest())


def rows_of(frame):
    return sorted((tuple(r) for r in alignment.align(frame).collect()), key=repr)


def test_against_brute_force(spark, monkeypatch):
    made = [(i if i else None, t, "clash", "clash", 1) for i, t in enumerate([*HARD, *HARD[7:12]])]
    frames = [spark.createDataFrame(made, DOCS).repartition(3)]
    if os.path.isdir(TABLES):
        frames.append(spark.read.parquet(f"{TABLES}/documents.parquet"))
    for frame in frames:
        got_in = [(r["doc_id"], r["text"]) for r in frame.collect()]
        want = sorted(((k, *w) for (k, _), w in zip(got_in, brute([t for _, t in got_in]), strict=True)), key=repr)
        assert rows_of(frame) == want
        assert sum(w[4] for w in want) and sum(w[1] + w[2] - w[3] - w[4] for w in want) == 0
    monkeypatch.setattr(alignment, "HOT_SHARE", 3)  # nearly all pairs by the shuffled join
    assert rows_of(frames[0]) == sorted(((k, *w) for (k, _), w in zip([(r["doc_id"], r["text"]) for r in frames[0].collect()], brute([r["text"] for r in frames[0].collect()]), strict=True)), key=repr)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], DOCS)).collect() == []


def test_pieces_give_the_tokens_of_the_text():
    tools = alignment.tokenizers_in(alignment.FOLDER)
    for text in filter(None, HARD):
        whole, parts = tools.encode([text]), tools.encode(alignment.pieces_of(text, tools.in_pieces))
        assert [[i for p in side for i in p] for side in parts] == [side[0] for side in whole]


def test_terminals_are_components():
    rng = np.random.default_rng(5)
    for _ in range(200):
        total = int(rng.integers(1, 40))
        a, b = (np.unique(np.append(rng.integers(1, total + 1, rng.integers(0, total)), total)) for _ in range(2))
        found = alignment.terminals(a, b)
        common = np.intersect1d(a, b)
        assert len(np.unique(found)) == len(common)
        groups = np.concatenate([np.searchsorted(common, a), np.searchsorted(common, b)])
        assert len(set(zip(found.tolist(), groups.tolist(), strict=True))) == len(common)
        x, y = alignment.links(a, b)
        starts = [np.concatenate([[0], e[:-1]]) for e in (a, b)]
        assert list(zip(x.tolist(), y.tolist(), strict=True)) == [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
