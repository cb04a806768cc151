"""Seeded synthetic admissions frames (only shapes and injected faults matter)."""

import numpy as np

COLUMNS = ["gre_score", "toefl_score", "university_rating", "sop", "lor", "cgpa", "research"]


def predictors(n, seed=0):
    rng = np.random.default_rng(seed)
    return {
        "gre_score": rng.integers(290, 341, n).astype(float), "toefl_score": rng.integers(95, 121, n).astype(float),
        "university_rating": rng.integers(1, 6, n).astype(float), "sop": rng.integers(2, 11, n) / 2.0, "lor": rng.integers(2, 11, n) / 2.0,
        "cgpa": rng.uniform(6.8, 9.9, n).round(3), "research": rng.integers(0, 2, n).astype(float),
    }


def frame(spark, n=120, seed=0, nulls=0.0):
    rng = np.random.default_rng(seed + 1)
    p = predictors(n, seed)
    y = np.clip(0.3 + 0.6 * (p["cgpa"] - 6.8) / 3.1 + 0.2 * (p["gre_score"] - 290) / 50 * 0.5 + 0.05 * p["research"] + rng.normal(0, 0.01, n), 0.05, 0.99)
    rows = []
    for i in range(n):
        cells = [None if rng.random() < nulls else float(p[c][i]) for c in COLUMNS]
        rows.append((i, *cells, float(y[i])))
    return spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{c} double" for c in COLUMNS) + ", chance_of_admit double")
