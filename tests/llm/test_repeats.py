"""The passage search keeps and moves no more than the answer needs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.llm import repeats
from wardframe.llm.repeats import Prints, anchors, compared, repeated_starts
from wardframe.sources.scratch import bucketed

RECORD = "core long, f1 long, f2 long, lo int, hi int, doc long, uid binary"


def test_lone_cores_are_not_kept(spark):
    rows = [(core, core, 0, 0, 5, core, bytes([core % 7])) for core in range(1000)] + [(500, 1, 1, 9, 12, 7, b"x")]
    got = [(r.core_n, r.full_n) for r in compared(spark.createDataFrame(rows, RECORD)).where("core_n > 1").collect()]
    assert got == [(2, 1)] * 2
    assert compared(spark.createDataFrame(rows, RECORD)).count() <= 4  # besides these only the ends of the one range


def test_equal_passages_are_judged_once(spark, monkeypatch):
    """Where all that share a core are equal, no round follows for them."""
    text = " ".join(f"w{i}" for i in np.random.default_rng(5).integers(0, 10**6, 400))
    asked = []
    monkeypatch.setattr(repeats, "compared", lambda rows: asked.append(compared(rows).count()) or compared(rows))
    texts = spark.createDataFrame([(bytes([i]), i, text) for i in range(3)], "uid binary, doc long, text string")
    repeated_starts(texts, lambda t: np.frombuffer(t.encode(), np.uint8), 100, 16, first_stays=False)
    assert asked[0] > 0 and asked[1:] == [0, 0]


def test_bucketed_texts_stay_where_they_are(spark):
    texts = bucketed(spark.range(1000).select(F.col("id").cast("string").cast("binary").alias("uid"), F.lit("t").alias("text")), "texts", "uid")
    spans = spark.range(50).select(F.col("id").cast("string").cast("binary").alias("uid")).hint("shuffle_hash")
    joined = texts.join(spans, "uid")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert joined.count() == 50


@pytest.mark.parametrize("symbols", [np.arange(400) % 7, np.random.default_rng(1).integers(0, 3, 400), np.zeros(300)])
def test_anchors_are_the_first_least_grams(symbols):
    width, gram, symbols = 60, 8, symbols.astype(np.uint8)
    n = len(symbols)
    grams, bits = Prints(symbols).grams(gram), n.bit_length()
    plain = [min(range(s, s + width - gram + 1), key=lambda i: (int(grams[i]) >> bits, i)) for s in range(n - width + 1)]
    assert anchors(Prints(symbols), n, width, gram).tolist() == plain
