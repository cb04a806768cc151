"""The threshold walk reads its lists no further than it can meet new rows."""

import numpy as np

from wardframe.llm.topk import threshold_topk


class Counted(np.ndarray):
    read = 0

    def __getitem__(self, at):
        out = np.asarray(self)[at]
        Counted.read += len(out) if out.ndim == 2 else 0
        return out


def test_walk_ends_when_every_row_is_met():
    numbers = np.random.default_rng(3)
    values = np.floor(256 * numbers.normal(size=(1024, 64)))
    lists, ids, query = np.argsort(values, axis=0, kind="stable").view(Counted), np.arange(1024), values[7]
    Counted.read = 0
    got = threshold_topk(ids, ids, values, lists, query, 7, 5)
    scores = values @ query
    best = sorted((i for i in range(1024) if i != 7), key=lambda i: (-scores[i], i))[:5]
    assert got == [(i, int(scores[i])) for i in best]
    assert Counted.read <= 512  # a quarter of all places; the walk to the bound read 992
