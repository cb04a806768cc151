"""The metric range join against all pairs."""

import math

import numpy as np
import pytest

from wardframe.llm import vectors

ROWS = "vec_id long, embedding array<float>, label int, cid string, cell int, m int"


def brute(rows, cosine=0.9):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, float) / np.linalg.norm(np.array(v, float))

    units = [unit(v) for _, v in rows]
    linked = [[j for j in range(len(rows)) if j != i and a is not None and units[j] is not None and len(a) == len(units[j]) and float(a @ units[j]) >= cosine]
              for i, a in enumerate(units)]
    name = [math.inf if k is None else k for k, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(linked):
            low = min([name[i], *(name[j] for j in js)])
            changed |= low < name[i]
            name[i] = low
    name = [None if c == math.inf else c for c in name]
    return sorted(((k, len(js), c, k == c) for (k, _), js, c in zip(rows, linked, name, strict=True)), key=repr)


def made(dims=16):
    rng = np.random.default_rng(3)
    out = [rng.normal(size=dims) for _ in range(150)]
    for middle in out[:3]:  # dense groups, one of them wide enough for chains of links
        out += [middle + rng.normal(size=dims) * s for s in (0.02, 0.02, 0.15, 0.3, 0.4) for _ in range(25)]
    out += [out[5]] * 40 + [out[5] * 3] * 2 + [out[6] * 1e-30, out[6] * 1e30]  # copies and other lengths
    flat = np.zeros(dims)
    flat[0] = 1.0
    for c in (0.9 - 1e-5, 0.9 + 1e-5, 0.9 - 2e-3, 0.9 + 2e-3):  # near the bound on both sides
        edge = flat * c
        edge[1] = math.sqrt(1 - c * c)
        out.append(edge)
    vecs = [[float(np.float32(x)) for x in v] for v in [*out, flat]]
    vecs += [None, [], [0.0] * dims, [None, *vecs[0][1:]], [math.nan, *vecs[0][1:]], [math.inf, *vecs[0][1:]], vecs[0][:5], vecs[0][:5], [-0.0, *vecs[0][1:]]]
    rows = [(i if i != 7 else None, v) for i, v in enumerate(vecs)]
    return rows + [(None, vecs[5]), rows[9], rows[9], (None, [-x for x in vecs[3]])]


def got_of(frame, **how):
    return sorted((tuple(r) for r in vectors.near_vectors(frame, **how).collect()), key=repr)


@pytest.mark.parametrize("block", [8192, 20])
def test_against_all_pairs(spark, block):
    rows = made()
    frame = spark.createDataFrame([(*r, 1, "c", 2, 3) for r in rows], ROWS).repartition(4)
    want = brute(rows)
    assert got_of(frame, block=block) == want
    assert max(w[1] for w in want) > 100 and sum(not w[3] for w in want) > 300


def test_nothing_to_link(spark):
    assert vectors.near_vectors(spark.createDataFrame([], ROWS)).collect() == []
    rows = [(1, None), (2, [0.0, 0.0]), (None, [])]
    assert got_of(spark.createDataFrame([(*r, 1, "c", 2, 3) for r in rows], ROWS)) == brute(rows)


def test_a_dense_group_gets_its_own_pivot():
    rng = np.random.default_rng(1)
    spread = rng.normal(size=(500, 32))
    group = spread[0] + rng.normal(size=(200, 32)) * 0.01
    sample = vectors.unit(list(np.concatenate([spread, group])))
    pivots = vectors.choose_pivots(sample, float(np.sqrt(0.2)), 4)
    assert len(pivots) == 5 and (sample[500:] @ pivots[0] > 0.99).all()
