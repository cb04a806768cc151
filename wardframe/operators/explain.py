"""Why a model predicts what it predicts, and where it cannot do better."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.operators.evaluate import fold_moments
from wardframe.operators.models import Line, LinearFit
from wardframe.operators.prep import PREFIX, ColumnPrepModel, PrepPlan
from wardframe.operators.profile import seeded_sample
from wardframe.operators.ranks import hash_indexed, long_numbers, quantiles_of
from wardframe.operators.treepaths import GRID_CELLS, CellGrid, leaves_of
from wardframe.sources.scratch import materialised

# Repeats of the permutation, ICE sample size, points and trimmed range of a grid, neighbours of the local dispersion.
PERMUTATIONS = 30
ICE_ROWS = 40
GRID_POINTS, GRID_TRIM = 100, (0.05, 0.95)
NEIGHBOURS = 5

# Multipliers of the index permutation: primes below 2^20, so that i * p stays inside 64 bits.
_PRIMES = (1048573, 1048571, 1048559, 1048549, 1048517, 1048507, 1048447, 1048433)


# --- permutation importance ---------------------------------------------------------------


def permuted_scores(
    df: DataFrame, model: Model, features: Sequence[str], target: str, key: str, repeats: int = PERMUTATIONS, salt: str = "permute"
) -> DataFrame:
    """(atributo, repeticion, error_base, error): mean absolute errors with one column shuffled.

    Rows are numbered in random order of the key; repeat r sends the values of row i to row
    (p i + q) mod n, which is a bijection because p does not divide n.  One shuffle join serves all
    columns and repeats, and no row order is gathered anywhere.  The join is held to a shuffle: the donors are
    ``repeats`` times the rows, but their size is estimated as that of the rows, small enough to broadcast.
    A tree ensemble is asked once per cell between its limits, where these fit a table: rows and donors are cells then.
    """
    rows = hash_indexed(df.where(F.col(target).isNotNull()).select(key, *features, target), key, salt)
    if tree := _grid_of(model, features):
        return _permuted_cells(rows, *tree, features, target, repeats)
    rows = materialised(rows, "indexed")
    donors = rows.select(F.inline(_moves(rows.count(), repeats)).alias("repeticion", "_to"), *[F.col(c).alias(f"_d_{c}") for c in features])
    joined = rows.hint("shuffle_hash").join(donors, rows["_index"] == donors["_to"])
    variants = F.array(*[
        F.struct(F.lit(f).alias("atributo"), *[(F.col(f"_d_{c}") if c == f else F.col(c)).alias(f"_v_{c}") for c in features])
        for f in features
    ])
    wide = joined.select("repeticion", F.col(target).alias("_y"), F.inline(variants))
    ready = wide.select("repeticion", "atributo", "_y", *[F.col(f"_v_{c}").alias(c) for c in features])
    errors = model.transform(ready).groupBy("atributo", "repeticion").agg(F.avg(F.abs(F.col("_y") - F.col("prediction"))).alias("error"))
    base = model.transform(rows.select(*features, target)).agg(F.avg(F.abs(F.col(target) - F.col("prediction")))).scalar()
    return errors.select("atributo", "repeticion", base.alias("error_base"), "error")


def _moves(n: int, repeats: int) -> Column:
    """(repeticion, _index): where every repeat sends a row of ``n``."""
    moves = []
    for r in range(1, repeats + 1):
        usable = [p for p in _PRIMES if n % p != 0]
        p = usable[r % len(usable)]
        q = int(n * ((r * 0.6180339887498949) % 1.0))
        moves.append(F.struct(F.lit(r).alias("repeticion"), F.pmod(F.col("_index") * F.lit(p) + F.lit(q), F.lit(n)).alias("_index")))
    return F.array(*moves)


def _grid_of(model: Model, features: Sequence[str]) -> tuple[ColumnPrepModel, CellGrid, dict[str, list[int]]] | None:
    """The preparation, the cells and the vector's places that hang on each feature, if the model is made of prepared trees,
    every place hangs on one feature and the cells fit a table."""
    kinds = (RandomForestRegressionModel, GBTRegressionModel, DecisionTreeRegressionModel)
    stages = model.stages if isinstance(model, PipelineModel) else []
    if len(stages) != 3 or not isinstance(stages[0], ColumnPrepModel) or not isinstance(stages[1], VectorAssembler) or not isinstance(stages[2], kinds):
        return None
    names, sources = stages[0].feature_names(), stages[0].feature_sources()
    if stages[1].getInputCols() != [PREFIX + c for c in names] or any(sources.get(c) not in features for c in names):
        return None
    grid = CellGrid(leaves_of(stages[2]), len(names))
    return (stages[0], grid, {c: [j for j, name in enumerate(names) if sources[name] == c] for c in features}) if grid.cells <= GRID_CELLS else None


def _permuted_cells(
    indexed: DataFrame, prep: ColumnPrepModel, grid: CellGrid, places: Mapping[str, Sequence[int]], features: Sequence[str], target: str, repeats: int,
) -> DataFrame:
    """``permuted_scores`` of trees: a donor is one number, and a prediction one lookup in a table that is made once."""
    names = [PREFIX + c for c in prep.feature_names()]
    looked_up = indexed.sparkSession.sparkContext.broadcast(grid.table())
    grid.leaves = ()  # the table holds all that they say

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_index": batch["_index"], "_y": batch["_y"], "_cell": grid.codes(batch[names].to_numpy(float))})

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums of the task's rows: one per feature and repeat, and without donors one in all."""
        table, sums, sizes = looked_up.value, np.zeros((repeats + 1, len(features))), np.zeros(repeats + 1, np.int64)
        for batch in batches:
            y, own, number = batch["_y"].to_numpy(float), batch["_cell"].to_numpy(), batch["repeticion"].to_numpy()
            donor = batch["_donor"].to_numpy()
            sizes += np.bincount(number, minlength=repeats + 1)
            for j, c in enumerate(features):
                cell = own if not places[c] else own - grid.part(own, places[c]) + grid.part(donor, places[c])
                sums[:, j] += np.bincount(number, np.abs(y - table[cell]), repeats + 1)
        at = np.flatnonzero(sizes)
        yield pd.DataFrame({
            "repeticion": at.repeat(len(features)).astype(np.int32), "atributo": list(features) * len(at), "s": sums[at].ravel(), "n": sizes[at].repeat(len(features))})

    prepared = prep.transform(indexed).select("_index", F.col(target).cast("double").alias("_y"), *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    rows = materialised(prepared.mapInPandas(coded, "_index long, _y double, _cell long"), "indexed")
    donors = rows.select(F.inline(_moves(rows.count(), repeats)).alias("repeticion", "_to"), F.col("_cell").alias("_donor"))
    joined = rows.hint("shuffle_hash").join(donors, rows["_index"] == donors["_to"])
    columns, schema = ["repeticion", "_y", "_cell", "_donor"], "repeticion int, atributo string, s double, n long"
    summed = lambda pairs: pairs.select(*columns).mapInPandas(errors, schema).groupBy("atributo", "repeticion").agg((F.sum("s") / F.sum("n")).alias("error"))
    base = summed(rows.withColumns({"repeticion": F.lit(0), "_donor": F.col("_cell")})).agg(F.first("error")).first()[0]  # every feature says the same
    return summed(joined).select("atributo", "repeticion", F.lit(base).cast("double").alias("error_base"), "error")


def permutation_importance(
    df: DataFrame, model: Model, features: Sequence[str], target: str, key: str, repeats: int = PERMUTATIONS
) -> DataFrame:
    """(atributo, importancia, desviacion): rise in MAE, mean and population deviation over repeats."""
    rise = F.col("error") - F.col("error_base")
    return permuted_scores(df, model, features, target, key, repeats).groupBy("atributo").agg(
        F.avg(rise).alias("importancia"), F.stddev_pop(rise).alias("desviacion")
    ).orderBy(F.desc("importancia"))


# --- contributions ------------------------------------------------------------------------


def impurity_importance(model: PipelineModel, names: Sequence[str], spark) -> DataFrame:
    """(atributo, porcentaje) from a fitted tree ensemble, a driver-side vector of k numbers."""
    weights = model.stages[-1].featureImportances.toArray()
    total = float(weights.sum()) or 1.0
    lines = sorted(((n, 100.0 * float(w) / total) for n, w in zip(names, weights, strict=True)), key=lambda t: -t[1])
    return spark.createDataFrame(lines, "atributo string, porcentaje double")


def linear_contributions(df: DataFrame, line: Line, keep: Sequence[str]) -> DataFrame:
    """(keep..., atributo, aporte, base): weight * (x - training mean); base + sum = prediction."""
    base = line.intercept + sum(w * m for w, m in zip(line.weights, line.means, strict=True))
    cells = F.array(*[
        F.struct(F.lit(c).alias("atributo"), (F.lit(w) * (F.col(f"`{c}`") - F.lit(m))).alias("aporte"))
        for c, w, m in zip(line.features, line.weights, line.means, strict=True)
    ])
    return df.select(*keep, F.lit(base).alias("base"), F.inline(cells))


def ordered_contributions(contributions: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Add ``orden``: 1 for the largest magnitude of each row (a window over k rows)."""
    order = Window.partitionBy(*keep).orderBy(F.desc(F.abs("aporte")), "atributo")
    return contributions.withColumn("orden", F.row_number().over(order))


def compare_importances(impurity: DataFrame, permutation: DataFrame, contributions: DataFrame) -> DataFrame:
    """(atributo, impureza_pct, permutacion_pct, contribucion_pct); negative permutation counts as 0.

    The row per feature of either side is written first: its total and its shares both read it.
    """
    positive = materialised(permutation.select("atributo", F.greatest(F.col("importancia"), F.lit(0.0)).alias("v")), "permutation")
    strength = materialised(contributions.groupBy("atributo").agg(F.avg(F.abs("aporte")).alias("v")), "strength")

    def share(table: DataFrame, name: str) -> DataFrame:
        total = table.agg(F.sum("v")).scalar()
        return table.select("atributo", F.try_divide(100 * F.col("v"), total).alias(name))

    return impurity.select("atributo", F.col("porcentaje").alias("impureza_pct")).join(
        share(positive, "permutacion_pct"), "atributo"
    ).join(share(strength, "contribucion_pct"), "atributo").orderBy(F.desc("contribucion_pct"))


# --- partial dependence -------------------------------------------------------------------


def dependence_grid(
    df: DataFrame, columns: Sequence[str], points: int = GRID_POINTS, trim: tuple[float, float] = GRID_TRIM
) -> dict[str, list[float]]:
    """The values at which each column is moved, ascending; nulls and NaN take no part, a column without values has none.

    Fewer than ``points`` different values are the grid themselves; otherwise ``points`` equal steps between
    the two trimming quantiles, at the rank n p + 0.4 + 0.2 p (cut to 1 and n).
    """
    if points < 2 or not 0 <= trim[0] < trim[1] <= 1:
        raise ValueError("a grid needs two points and a rising pair of shares")
    long = long_numbers(df, columns).where(~F.isnan("value"))
    sizes = {r["column"]: r for r in long.groupBy("column").agg(
        F.count("*").alias("n"), F.approx_count_distinct("value", 0.05).alias("different")).collect()}  # one row per column
    # far more estimated values than points are more for certain; only the other columns exchange their (few) values
    few = [c for c, r in sizes.items() if r["different"] < 2 * points]
    exact: dict[str, list[float]] = {}
    if few:
        exact = {r["column"]: sorted(r["v"]) for r in long.where(F.col("column").isin(few)).groupBy("column").agg(
            F.collect_set("value").alias("v")).collect()}
    exact = {c: v for c, v in exact.items() if len(v) < points}
    steep = [c for c in columns if c in sizes and c not in exact]
    shares = sorted({_grid_share(sizes[c]["n"], p) for c in steep for p in trim})
    ends = quantiles_of(long.where(F.col("column").isin(steep)), steep, shares) if steep else {}

    def steps(c: str) -> list[float]:
        low, high = (ends[c][shares.index(_grid_share(sizes[c]["n"], p))] for p in trim)
        return sorted(set(np.linspace(low, high, points).tolist()))

    return {c: exact[c] if c in exact else steps(c) if c in sizes else [] for c in columns}


def _grid_share(n: int, p: float) -> float:
    """The rank n p + 0.4 + 0.2 p as a share of the way from the first value to the last."""
    return min(1.0, max(0.0, (n * p + 0.4 + 0.2 * p - 1) / (n - 1))) if n > 1 else 0.0


def dependence(
    df: DataFrame, model: Model, features: Sequence[str], key: str, columns: Sequence[str] | None = None,
    grids: Mapping[str, Sequence[float]] | None = None, rows: int = ICE_ROWS,
) -> DataFrame:
    """(tipo, key, atributo, valor, prediccion): averages of all rows and curves of a sample, scored in one pass.

    Rows of equal features are predicted alike, so they are counted before they are copied for every point.
    ``promedio`` rows have no key; ``individual`` rows belong to ``rows`` keys in seeded order (rows that
    repeat such a key are averaged).  Grids come from the data unless given.
    """
    grids = grids or dependence_grid(df, columns or features)
    grids = {f: grid for f, grid in grids.items() if len(grid)}
    chosen = [r[0] for r in seeded_sample(df.select(key), key, rows, "ice").collect()]
    points = F.array(*[F.struct(F.lit(f).alias("atributo"), F.lit(float(v)).alias("valor")) for f, grid in grids.items() for v in grid])
    own = F.when(F.col(key).isin([c for c in chosen if c is not None]), F.col(key))
    counted = df.select(own.alias("_own"), *features).groupBy("_own", *features).agg(F.count("*").alias("_w"))
    moved = counted.select("*", F.inline(points)).withColumns({
        f: F.when(F.col("atributo") == f, F.col("valor")).otherwise(F.col(f).cast("double")) for f in grids
    })
    scored = model.transform(moved).groupBy("atributo", "valor", "_own").agg(
        F.sum(F.col("_w") * F.col("prediction")).alias("s"), F.coalesce(F.sum(F.when(F.col("prediction").isNotNull(), F.col("_w"))), F.lit(0)).alias("n"))
    sums = materialised(scored, "dependence")  # points x (sampled keys + 1) rows
    mean = (F.sum("s") / F.sum("n")).alias("prediccion")
    average = sums.groupBy("atributo", "valor").agg(mean).select(F.lit("promedio").alias("tipo"), F.lit(None).cast(df.schema[key].dataType).alias(key), "atributo", "valor", "prediccion")
    return average.unionByName(sums.where("_own IS NOT NULL").select(
        F.lit("individual").alias("tipo"), F.col("_own").alias(key), "atributo", "valor", (F.col("s") / F.col("n")).alias("prediccion")))


def partial_dependence(df: DataFrame, model: Model, grids: Mapping[str, Sequence[float]], features: Sequence[str]) -> DataFrame:
    """(atributo, valor, prediccion_media): every row scored at every grid point, averaged in place."""
    points = F.array(*[
        F.struct(F.lit(f).alias("atributo"), F.lit(float(v)).alias("valor")) for f, grid in grids.items() for v in grid
    ])
    moved = df.select(*features, F.inline(points)).withColumns({
        f: F.when(F.col("atributo") == f, F.col("valor")).otherwise(F.col(f).cast("double")) for f in grids
    })
    return model.transform(moved).groupBy("atributo", "valor").agg(F.avg("prediction").alias("prediccion_media"))


def individual_curves(
    df: DataFrame, model: Model, grids: Mapping[str, Sequence[float]], features: Sequence[str], key: str, rows: int = ICE_ROWS
) -> DataFrame:
    """(key, atributo, valor, prediccion) for a seeded sample of rows."""
    points = F.array(*[
        F.struct(F.lit(f).alias("atributo"), F.lit(float(v)).alias("valor")) for f, grid in grids.items() for v in grid
    ])
    chosen = seeded_sample(df.select(key, *features), key, rows, "ice")
    moved = chosen.select(key, *features, F.inline(points)).withColumns({
        f: F.when(F.col("atributo") == f, F.col("valor")).otherwise(F.col(f).cast("double")) for f in grids
    })
    return model.transform(moved).select(key, "atributo", "valor", F.col("prediction").alias("prediccion"))


# --- nearest neighbours -------------------------------------------------------------------

MAX_PIVOTS = 1024
ROWS_PER_PIVOT = 500
BLOCK_ROWS = 20_000
ROUTED_ROWS = 10_000

# Queries and pairs that are compared at once, and columns that give a first limit of the k-th distance.
QUERY_ROWS, PAIR_ROWS, FIRST_ROWS = 256, 32_768, 1024


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one product of matrices, and how far those of each row of ``a`` may be off by rounding."""
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    off = 4 * (a.shape[1] + 8) * np.finfo(a.dtype).eps * (aa + (np.nanmax(bb) if len(bb) and not np.isnan(bb).all() else 0.0))
    out = (-2 * a) @ b.T
    out += aa[:, None]
    out += bb
    return out, off


def _short(x: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both moved to the middle of ``base`` and in half the bytes where their size allows it; their distances stay, up to rounding."""
    middle = np.nan_to_num(base.mean(axis=0))
    x, base = x - middle, base - middle
    large = max(np.nanmax(np.abs(m), initial=0.0) for m in (x, base))
    return (x.astype(np.float32), base.astype(np.float32)) if 1e-12 < large < 1e12 else (x, base)


def _pair_distances(a: np.ndarray, b: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances of pairs of rows, in slices, so that memory stays small."""
    cuts = [slice(i, i + PAIR_ROWS) for i in range(0, len(at), PAIR_ROWS)]
    return np.concatenate([np.empty(0), *[np.sqrt(((a[at[c]] - b[to[c]]) ** 2).sum(axis=1)) for c in cuts]])


def _needed(x: np.ndarray, reach: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row of a cell may lie within ``reach`` of a query, and the nearest cell."""
    squares, off = _squares(x, centres)
    least = np.sqrt(np.maximum(0.0, squares - off[:, None]))
    return ~(least - radius > reach[:, None] * (1 + 1e-12) + 1e-9), squares.argmin(axis=1)


def _reach(x: np.ndarray, centres: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """A distance that the k-th neighbour of each query does not exceed."""
    squares, off = _squares(x, centres)
    return (np.sqrt(np.maximum(0.0, squares + off[:, None])) + bound).min(axis=1)


def _seen(pdf: pd.DataFrame, centres: np.ndarray, radius: np.ndarray, bound: np.ndarray, groups: np.ndarray) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Some queries, the groups of cells (ascending along ``centres``) that each must see, and its reach."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    for start in range(0, len(pdf), QUERY_ROWS):
        part = pdf.iloc[start: start + QUERY_ROWS]
        x = _matrix(part["v"])
        reach = _reach(x, centres, bound)
        yield part, np.logical_or.reduceat(_needed(x, reach, centres, radius)[0], starts, axis=1), reach


def _routed(
    pdf: pd.DataFrame, centres: np.ndarray, radius: np.ndarray, bound: np.ndarray, ids: np.ndarray, blocks: np.ndarray, groups: np.ndarray | None = None,
) -> Iterator[pd.DataFrame]:
    """(query, v, reach, cell, block) for every block that a query must see, in frames of at most ``ROUTED_ROWS`` rows:
    a query may visit every cell, and each visit copies its vector.  With ``groups`` a visit is one to a whole group of cells,
    and ``ids`` and ``blocks`` are those of the groups."""
    of = np.repeat(np.arange(len(ids)), blocks)
    number = np.concatenate([np.arange(b) for b in blocks])
    for part, seen, reach in _seen(pdf, centres, radius, bound, np.arange(len(centres)) if groups is None else groups):
        query, visit = np.nonzero(seen[:, of])
        names, vectors = part["query"].to_numpy(), part["v"].to_numpy()
        for i in range(0, len(query), ROUTED_ROWS):
            q, b = query[i: i + ROUTED_ROWS], visit[i: i + ROUTED_ROWS]
            yield pd.DataFrame({"query": names[q], "v": vectors[q], "reach": reach[q], "cell": ids[of[b]], "block": number[b]})


def _packed(centres: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the cells, group of each in that order): like cells side by side, at most ``most`` rows together or one cell."""
    spread = np.nan_to_num(centres - np.nan_to_num(centres).mean(axis=0))
    order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable") if len(centres) > 1 else np.arange(len(centres))
    groups, group, held = [], -1, most
    for n in sizes[order]:
        if held + n > most:
            group, held = group + 1, 0
        held += n
        groups.append(group)
    return order, np.array(groups)


def _block_neighbours(
    x: np.ndarray, reach: np.ndarray, base: np.ndarray, keys: np.ndarray, cells: np.ndarray, centres: np.ndarray, radius: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, distance): the k nearest rows of a block to each query, among those within its reach at least.

    Rows are in the order of their ``cells``.  A product of matrices tells which rows may be among the k nearest, rounding
    included; only their distances are taken one by one, and these decide.
    """
    present, starts = np.unique(cells, return_index=True)
    ends = np.r_[starts[1:], len(cells)]
    need, nearest = _needed(x, reach, centres[present], radius[present])
    order = np.argsort(nearest, kind="stable")  # queries of one place need the same cells
    short, low = _short(x, base)
    for start in range(0, len(order), QUERY_ROWS):
        at = order[start: start + QUERY_ROWS]
        wanted = need[at].any(axis=0)
        rows = np.arange(len(base)) if wanted.all() else np.concatenate([np.empty(0, np.int64), *[np.arange(a, b) for a, b in zip(starts[wanted], ends[wanted], strict=True)]])
        if not len(rows):
            continue
        squares, off = _squares(short[at], low if len(rows) == len(base) else low[rows])
        some, first = min(k, len(rows)), max(1, len(rows) // FIRST_ROWS)
        sample = squares[:, ::first] if len(rows) // first > some else squares
        limit = np.minimum(np.partition(sample, some - 1, axis=1)[:, some - 1], reach[at] ** 2 * (1 + 1e-12) + 1e-9)
        limit = (limit + 2 * off).astype(squares.dtype) * (1 + 4 * np.finfo(squares.dtype).eps)
        q, r = np.divmod(np.flatnonzero(~(squares > limit[:, None])), len(rows))
        q, r = at[q], rows[r]
        distance = _pair_distances(x, base, q, r)
        best = np.lexsort((keys[r], distance, q))
        q, r, distance = q[best], r[best], distance[best]
        heads = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
        place = np.arange(len(q)) - np.repeat(heads, np.diff(np.r_[heads, len(q)]))
        yield q[place < k], r[place < k], distance[place < k]


def nearest_neighbours(
    train: DataFrame, queries: DataFrame, key: str, vector: str, value: str, k: int = NEIGHBOURS,
    pivots: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query, key, distance, value, orden): the exact k nearest training rows of every query.

    Training rows are grouped around a bounded set of pivots, and like cells into groups of at most ``block_rows`` rows.
    A query visits a group only if the triangle inequality allows a neighbour in one of its cells, and there compares
    itself with these cells only, so the result is exact without looking at all pairs.  Cells larger than ``block_rows`` are
    cut into blocks, and queries into batches, so no task ever holds a whole group.  A query's vector is copied once for each
    group it visits, not for each cell.  Ties are broken by key.
    """
    spark = train.sparkSession
    if pivots is None:
        pivots = min(MAX_PIVOTS, max(1, train.count() // ROWS_PER_PIVOT))
    centres = np.array([r[0] for r in seeded_sample(train.select(key, vector), key, pivots, "pivot").select(vector).collect()], dtype=float)
    if not len(centres):
        return spark.createDataFrame([], "query bigint, key bigint, distance double, value double, orden int")

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf["v"])
                cell = np.concatenate([_squares(x[i: i + QUERY_ROWS], centres)[0].argmin(axis=1) for i in range(0, len(x), QUERY_ROWS)])
                # a row without a distance is in no one's way, and its cell is always seen
                yield pdf.assign(cell=cell.astype(np.int32), gap=np.nan_to_num(_pair_distances(x, centres, np.arange(len(x)), cell), nan=np.inf))

    tr = train.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("v"), F.col(value).cast("double").alias("value"))
    placed = materialised(tr.mapInPandas(assign, "key bigint, v array<double>, value double, cell int, gap double"), "cells")
    near = Window.partitionBy("cell").orderBy("gap", "key")
    # the k-th smallest gap of a cell bounds the k-th neighbour distance of any query
    kth = placed.select("cell", "gap", "key").withColumn("_r", F.row_number().over(near)).where(F.col("_r") <= k).groupBy("cell").agg(
        F.when(F.count("*") >= k, F.max("gap")).alias("kth")
    )
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).join(kth, "cell").orderBy("cell").collect()  # one row per pivot
    order, groups = _packed(centres[[c["cell"] for c in cells]], np.array([c["n"] for c in cells]), block_rows)
    cells = [cells[i] for i in order]
    used, radius = centres[[c["cell"] for c in cells]], np.array([c["radius"] for c in cells])
    bound = np.array([c["kth"] if c["kth"] is not None else np.inf for c in cells])
    ids = np.arange(groups[-1] + 1)
    blocks = np.array([-(-n // block_rows) for n in np.bincount(groups, [c["n"] for c in cells]).astype(np.int64)])

    def visit(batches):
        counted = np.zeros(len(ids), np.int64)
        for pdf in batches:
            for _, seen, _ in _seen(pdf, used, radius, bound, groups):
                counted += seen.sum(axis=0)
        yield pd.DataFrame({"cell": ids, "n": counted})

    def route(batches):
        for pdf in batches:
            yield from _routed(pdf, used, radius, bound, ids, blocks, groups)

    qs = queries.select(F.col(key).cast("bigint").alias("query"), F.col(vector).cast("array<double>").alias("v"))
    # where queries go is told twice, which costs less than keeping a copy of each for every visit
    visits = {r[0]: r[1] for r in qs.mapInPandas(visit, "cell int, n long").groupBy("cell").agg(F.sum("n")).where("sum(n) > 0").collect()}  # one row per group
    if not visits:
        return spark.createDataFrame([], "query bigint, key bigint, distance double, value double, orden int")

    def per_group(numbers: Mapping[int, int]):
        return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for c, n in numbers.items() for x in (int(c), int(n))]), F.col("cell")), F.lit(1))

    # a group takes as many batches of queries as its visits need, and nothing is copied elsewhere
    batches = per_group({c: -(-n // block_rows) for c, n in visits.items()})
    cut = per_group({int(c): int(b) for c, b in zip(ids, blocks, strict=True)})
    places = spark.createDataFrame([(c["cell"], i, int(g)) for i, (c, g) in enumerate(zip(cells, groups, strict=True))], "_cell int, at int, cell int")
    left_side = qs.mapInPandas(route, "query bigint, v array<double>, reach double, cell int, block int").withColumn("batch", F.pmod(F.xxhash64("query"), batches).cast("int"))
    right_side = placed.withColumnRenamed("cell", "_cell").join(F.broadcast(places.where(F.col("cell").isin([int(c) for c in visits]))), "_cell").select(
        "key", "v", "value", "at", "cell", F.pmod(F.xxhash64("key"), cut).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), batches - 1)).alias("batch")
    )

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query", "key", "distance", "value"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names)
        right = right.sort_values("at", kind="stable")
        keys, values, queries = right["key"].to_numpy(), right["value"].to_numpy(), left["query"].to_numpy()
        found = _block_neighbours(_matrix(left["v"]), left["reach"].to_numpy(), _matrix(right["v"]), keys, right["at"].to_numpy(), used, radius, k)
        parts = [pd.DataFrame(dict(zip(names, (queries[q], keys[r], d, values[r]), strict=True))) for q, r, d in found]
        return pd.concat(parts) if parts else pd.DataFrame(columns=names)

    grouping = ["cell", "block", "batch"]
    partial = left_side.groupBy(*grouping).cogroup(right_side.groupBy(*grouping)).applyInPandas(match, "query bigint, key bigint, distance double, value double")
    best = Window.partitionBy("query").orderBy("distance", "key")
    return partial.withColumn("orden", F.row_number().over(best)).where(F.col("orden") <= k)


def local_dispersion(
    train: DataFrame, queries: DataFrame, key: str, vector: str, target: str, k: int = NEIGHBOURS, **options
) -> DataFrame:
    """(query, dispersion): mean |y - mean y| over the k nearest training rows."""
    found = nearest_neighbours(train, queries, key, vector, target, k, **options)
    ys = found.groupBy("query").agg(F.collect_list("value").alias("ys"))  # k values per query
    mean = F.aggregate("ys", F.lit(0.0), lambda a, b: a + b) / F.size("ys")
    return ys.withColumn("_m", mean).select(
        "query", (F.aggregate(F.transform("ys", lambda y: F.abs(y - F.col("_m"))), F.lit(0.0), lambda a, b: a + b) / F.size("ys")).alias("dispersion")
    )


def dispersion_against_error(dispersion: DataFrame, errors: DataFrame, median: float) -> DataFrame:
    """(dispersion_media, error_medio, correlacion, error_inconsistente, error_consistente)."""
    both = dispersion.join(errors, "query")
    return both.agg(
        F.avg("dispersion").alias("dispersion_media"), F.avg("error").alias("error_medio"),
        F.corr("error", "dispersion").alias("correlacion"),
        F.avg(F.when(F.col("dispersion") > median, F.col("error"))).alias("error_inconsistente"),
        F.avg(F.when(F.col("dispersion") <= median, F.col("error"))).alias("error_consistente"),
    )


# --- single rows and single predictors ----------------------------------------------------


def best_and_worst(df: DataFrame, target: str, key: str, prediction: str = "prediction", show: Sequence[str] = ()) -> DataFrame:
    """(caso, key, real, prediccion, error, show...): arg-min and arg-max of the absolute error."""
    error = F.abs(F.col(target) - F.col(prediction))
    row = F.struct(F.col(key), F.col(target).alias("real"), F.col(prediction).alias("prediccion"), error.alias("error"), *show)
    known = df.where(error.isNotNull())
    line = known.agg(
        F.min_by(row, F.struct(error, F.col(key))).alias("mejor"), F.max_by(row, F.struct(error, -F.col(key))).alias("peor")
    )
    return line.select(F.inline(F.array(
        F.struct(F.lit("mejor").alias("caso"), F.col("mejor").alias("r")), F.struct(F.lit("peor").alias("caso"), F.col("peor").alias("r"))
    ))).select("caso", "r.*")


def single_predictor_ranking(
    df: DataFrame, numeric: Sequence[str], discrete: Sequence[str], target: str, key: str, folds: int = 5, repeats: int = 3, seed: int = 42
) -> DataFrame:
    """(columna, MAE, desviacion): a one-variable line per column under repeated folds.

    Missing cells take the median (numeric) or mode (discrete) of their training set.  All lines of all
    training sets come from the moments of one pass, the errors from one scoring pass.
    """
    fits = {c: LinearFit(target, PrepPlan(numeric=(c,), scale=False)) for c in numeric}
    fits |= {c: LinearFit(target, PrepPlan(boolean=(c,))) for c in discrete}
    known = df.where(F.col(target).isNotNull())
    scored = fold_moments(known, fits, "repetido", key, target, folds, repeats, seed).counts(validation_only=True)
    error = F.when(F.col("prediction").isNotNull(), F.col("n") * F.abs(F.col("y") - F.col("prediction")))
    maes = scored.groupBy("variante", "repeticion", "fold").agg((F.sum(error) / F.sum(F.when(error.isNotNull(), F.col("n")))).alias("mae"))
    return maes.groupBy(F.col("variante").alias("columna")).agg(
        F.avg("mae").alias("MAE"), F.stddev_pop("mae").alias("desviacion")).orderBy("MAE")
