"""Means and covariances of several columns in one aggregation (stable running updates)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def covariances(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, population covariance matrix); the columns may not hold NULL."""
    k = len(columns)
    xs = [F.col(c).cast("double") for c in columns]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = df.agg(F.count("*"), *[F.avg(x) for x in xs], *[F.covar_pop(xs[i], xs[j]) for i, j in pairs]).first()
    if not row[0]:
        raise ValueError("no complete rows")
    matrix = np.zeros((k, k))
    for (i, j), value in zip(pairs, row[1 + k:], strict=True):
        matrix[i, j] = matrix[j, i] = value
    return row[0], np.array(row[1: 1 + k], dtype=float), matrix
