"""One pass over the texts gives what packing needs of them, and the large sets do not stay on disk."""

import os
import re

from wardframe.llm.neardup import judged
from wardframe.sources.scratch import scratch_root


def test_words_and_likeness_come_with_the_sketches(spark):
    texts = [None, "", " \n", "Été   x a\tB", "été  X A b ", "ete x a b", "one two", "ONE\vTWO", "Kelvin one", "kelvin  one", "onetwo"]
    base = " ".join(f"w{i}" for i in range(200))
    texts += [base, base.replace("w7 ", "v7 "), base.upper()]
    sets = lambda: [f for f in os.listdir(scratch_root(spark).removeprefix("file:")) if "-sets-" in f]
    before = sets()
    got = {r.key: r for r in judged(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), "k", "t", 80).collect()}
    assert sets() == before
    plain = [" ".join(re.findall(r"[^\x20\x09-\x0D]+", t or "")).lower() for t in texts]
    assert [got[i].words for i in range(len(texts))] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            assert (got[i].alike == got[j].alike) == (a == b), (texts[i], texts[j])
    assert got[11].component_id == got[12].component_id == got[13].component_id == 11
