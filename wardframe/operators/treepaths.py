"""Exact contributions of tree ensembles by walking their paths.

The Shapley value of a feature against one baseline row asks what each feature adds when the row's
values replace the baseline's one by one, in every order.  In a tree this can be read off each leaf: its path
asks every feature for an interval.  A feature that only the row satisfies must come in before the leaf is
reached, one that only the baseline satisfies must not, and the others do not matter; so a leaf gives
each of its features a weight that depends on two counts only.  The work is leaves times depth per row,
for any number of features, in Arrow batches without an exchange.

Leaves only compare a value with the limits of its feature, so rows between the same limits have the same contributions:
those of a chunk are walked once per such cell.  Cells are bounded by the trees and not by the rows; ``side_by_side``
brings like rows together first.  Where the cells are few enough for a table (``CellGrid``), a prediction is one lookup.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import comb, prod

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows whose cells are walked together, and rows of one output frame.
CHUNK_ROWS = 100_000
FRAME_ROWS = 10_000

# Cells that a table of predictions may have (8 bytes each).
GRID_CELLS = 1 << 23

_LINE = re.compile(r"^(?P<pad> *)(?:(?P<branch>If|Else) \(feature (?P<feature>\d+) (?P<rule><=|>|in|not in) (?P<limit>[^)]*)\)|Predict: (?P<value>\S+)|Tree \d+ \(weight (?P<weight>\S+)\):)")


@dataclass(frozen=True)
class Leaf:
    """A path: the features it asks, the interval (low, high] of each, and what it adds to the prediction."""

    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    value: float


def leaves_of(model: Model) -> list[Leaf]:
    """The leaves of a fitted MLlib forest, boosted ensemble or single tree."""
    lines = [m for m in map(_LINE.match, model.toDebugString.split("\n")) if m]
    count = sum(m["weight"] is not None for m in lines)
    averaged = "RandomForest" in type(model).__name__
    weight, path, found = 1.0, [], []
    for m in lines:
        if m["weight"] is not None:
            weight, path = float(m["weight"]) / (count if averaged else 1), []
            continue
        depth = len(m["pad"])
        path = [step for step in path if step[0] < depth]
        if m["branch"]:
            if m["rule"] in ("in", "not in"):
                raise ValueError("categorical splits have no interval")
            path.append((depth, int(m["feature"]), m["rule"], float(m["limit"])))
            continue
        asked: dict[int, list[float]] = {}
        for _, feature, rule, limit in path:
            interval = asked.setdefault(feature, [-np.inf, np.inf])
            if rule == "<=":
                interval[1] = min(interval[1], limit)
            else:
                interval[0] = max(interval[0], limit)
        found.append(Leaf(tuple(asked), tuple(v[0] for v in asked.values()), tuple(v[1] for v in asked.values()), weight * float(m["value"])))
    return found


def path_contributions(leaves: Sequence[Leaf], x: np.ndarray, baseline: np.ndarray) -> tuple[np.ndarray, float]:
    """(rows x features contributions, prediction of the baseline)."""
    out, base = np.zeros(x.shape), 0.0
    longest = max((len(leaf.features) for leaf in leaves), default=0)
    # share of the orders in which one of a features comes last and none of b has come: 1 / (a C(a + b, a))
    orders = np.array([[1.0 / (a * comb(a + b, a)) if a else 0.0 for b in range(longest + 1)] for a in range(longest + 1)])
    for leaf in leaves:
        if not leaf.features:
            base += leaf.value
            continue
        at = list(leaf.features)
        values = x[:, at]
        mine = (values > leaf.low) & (values <= leaf.high)
        theirs = (baseline[at] > leaf.low) & (baseline[at] <= leaf.high)
        if theirs.all():
            base += leaf.value
        rows = np.flatnonzero((mine | theirs).all(axis=1))
        if not len(rows):
            continue
        needs, bars = mine[rows] & ~theirs, ~mine[rows] & theirs
        a, b = needs.sum(axis=1), bars.sum(axis=1)
        gain, loss = leaf.value * orders[a, b], leaf.value * orders[b, a]
        out[np.ix_(rows, at)] += np.where(needs, gain[:, None], 0.0) - np.where(bars, loss[:, None], 0.0)
    return out, base


def limits_of(leaves: Sequence[Leaf], features: int) -> list[np.ndarray]:
    """The values of each feature at which some leaf ends, ascending."""
    limits: list[set[float]] = [set() for _ in range(features)]
    for leaf in leaves:
        for feature, *ends in zip(leaf.features, leaf.low, leaf.high, strict=True):
            limits[feature].update(v for v in ends if np.isfinite(v))
    return [np.array(sorted(ends), dtype=float) for ends in limits]


def cells_of(leaves: Sequence[Leaf], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each cell, cell of each row): rows of a cell lie between the same limits of every feature."""
    # a limit belongs to the interval below it; NaN lies in no interval
    places = np.column_stack([np.where(np.isnan(x[:, j]), -1, np.searchsorted(ends, x[:, j])) for j, ends in enumerate(limits_of(leaves, x.shape[1]))])
    _, first, cell = np.unique(places, axis=0, return_index=True, return_inverse=True)
    return first, cell.ravel()


class CellGrid:
    """Every cell between the limits of the trees with its prediction; a cell is one number, a digit per feature."""

    def __init__(self, leaves: Sequence[Leaf], features: int):
        self.limits = limits_of(leaves, features)
        self.sizes = [len(ends) + 1 for ends in self.limits]
        # the feature with most intervals lies innermost, so that boxes are made of long runs
        self.order = sorted(range(features), key=lambda j: self.sizes[j])
        self.strides = [prod(self.sizes[i] for i in self.order[self.order.index(j) + 1:]) for j in range(features)]
        self.leaves = leaves

    @property
    def cells(self) -> int:
        return prod(self.sizes)

    def table(self) -> np.ndarray:
        """The prediction of every cell: each leaf adds its value to the box that its path asks for."""
        grid = np.zeros([self.sizes[j] for j in self.order])
        for leaf in self.leaves:
            box = [slice(None)] * len(self.sizes)
            for feature, low, high in zip(leaf.features, leaf.low, leaf.high, strict=True):
                ends = self.limits[feature]
                box[feature] = slice(int(np.searchsorted(ends, low)) + 1 if np.isfinite(low) else 0, int(np.searchsorted(ends, high)) + 1 if np.isfinite(high) else None)
            grid[tuple(box[j] for j in self.order)] += leaf.value
        return grid.ravel()

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row."""
        if np.isnan(x).any():
            raise ValueError("a feature is unknown after the preparation")
        code = np.zeros(len(x), np.int64)
        for j, ends in enumerate(self.limits):
            code += np.searchsorted(ends, x[:, j]) * self.strides[j]
        return code

    def part(self, code: np.ndarray, features: Sequence[int]) -> np.ndarray:
        """What the digits of some features add to a cell's number."""
        return sum(((code // self.strides[j]) % self.sizes[j] * self.strides[j] for j in features), np.zeros(len(code), np.int64))


def side_by_side(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """The same rows with like features beside each other; the key cuts a value that many rows share."""
    return df.repartitionByRange(*[F.col(f"`{c}`") for c in features], F.col(f"`{key}`")).sortWithinPartitions(*[F.col(f"`{c}`") for c in features])


def _chunks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def tree_contributions(df: DataFrame, model: Model, features: Sequence[str], baseline: Mapping[str, float], key: str) -> DataFrame:
    """(key, base, prediction, atributo, aporte): base + the sum over a row's features is its prediction.

    ``features`` are the columns of the model's vector, in order.  The paths travel once, with the task.
    """
    leaves, reference = leaves_of(model), np.array([float(baseline[c]) for c in features])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches, CHUNK_ROWS):
            x = chunk[list(features)].to_numpy(float)
            first, cell = cells_of(leaves, x)
            parts, base = path_contributions(leaves, x[first], reference)
            total = base + parts.sum(axis=1)
            for start in range(0, len(chunk), FRAME_ROWS):
                at = cell[start: start + FRAME_ROWS]
                yield pd.DataFrame({
                    key: chunk[key].iloc[start: start + FRAME_ROWS].repeat(len(features)).to_numpy(), "base": base, "prediction": total[at].repeat(len(features)),
                    "atributo": list(features) * len(at), "aporte": parts[at].ravel()})

    kind = dict(df.dtypes)[key]
    return df.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in features]).mapInPandas(
        walk, f"`{key}` {kind}, base double, prediction double, atributo string, aporte double")
