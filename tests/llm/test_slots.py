"""Shared values counted in slots, word hashes of whole batches, and shuffle files of written tables."""

import os
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wardframe.llm import neardup
from wardframe.llm.text import hashes_of_words, word_hashes
from wardframe.sources.scratch import written


def test_a_written_table_leaves_no_shuffle_files(spark):
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in dirs for _, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_")}
    before = files()
    out, _ = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    assert not files() - before and out.count() == 7


def test_words_of_a_batch_are_those_of_its_texts():
    texts = ["", "a b", "b", " c", "d ", "", "x" * 300 + " É", "A b\tÉ"]
    parts = [t.encode() for t in texts]
    got, at = hashes_of_words(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]), lower=True)
    for i, t in enumerate(texts):
        assert got[at[i]:at[i + 1]].tolist() == word_hashes(t, lower=True).tolist()


def test_values_are_held_by_one_or_more(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PART_VALUES", 5)
    lists = {1: [3, -9, 7], 2: [7, 8], 3: [], 4: [7, -9, 100, 2**62], 5: [1, 2, 3, 4, 5, 6, 11]}
    rows = neardup.holders(spark.createDataFrame(list(lists.items()), "cid long, full array<long>"), "full", 16).collect()
    often = Counter(v for held in lists.values() for v in held)
    assert sorted((r.value, r.often) for r in rows if r.value is not None) == sorted((v, n) for v, n in often.items() if n > 1)
    lone = Counter()
    for r in rows:
        if r.value is None:
            lone[r.cid] += r.lone
    assert lone == Counter({c: n for c, held in lists.items() if (n := sum(often[v] == 1 for v in held))})


def test_rows_that_are_wanted_pass_the_filter(spark):
    rows = spark.range(5000).selectExpr("id", "md5(string(id)) AS t")
    wanted = rows.where("id % 50 = 0")
    passed = {r.id for r in neardup.likely(rows, wanted, "t").collect()}
    assert passed >= set(range(0, 5000, 50)) and len(passed) < 150
