"""Regression models.

Constant, heuristic and linear models are SQL expressions over the input columns, so they score
inside codegen, run on any DataFrame and are saved with ``pyspark.ml`` persistence.  Trees come
from MLlib.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.functions.cleaning import NUMBER_PATTERN
from wardframe.operators.moments import covariances
from wardframe.operators.prep import PREFIX, ColumnPrep, ColumnPrepModel, PrepPlan, medians

Fit = Callable[[DataFrame], Model]


class ExpressionModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction`` = a SQL expression."""

    expression = Param(Params._dummy(), "expression", "prediction as SQL", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, expression: str | None = None):
        super().__init__()
        if expression is not None:
            self._set(expression=expression)

    def sql(self) -> str:
        return self.getOrDefault(self.expression)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", F.expr(self.sql()))


def number(value: float) -> str:
    """A double literal."""
    return f"({float(value)!r}D)"


def fit_constant(df: DataFrame, target: str, strategy: str = "mean", value: float | None = None) -> ExpressionModel:
    if strategy == "constant":
        centre = value
    elif strategy == "median":
        centre = medians(df, [target])[target]
    elif strategy == "mean":
        centre = df.agg(F.avg(target)).first()[0]
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return ExpressionModel(expression=number(centre))


def number_sql(column: str, data_type: str) -> str:
    """The number in a column; NULL for NaN and for text that is no number."""
    value = f"try_cast(`{column}` as double)"
    if data_type == "string":
        return f"(case when `{column}` rlike r'{NUMBER_PATTERN}' then {value} end)"
    return f"nanvl({value}, cast(null as double))" if data_type in ("double", "float") else value


def heuristic_sql(domains: Mapping[str, tuple[float, float]], types: Mapping[str, str] | Sequence[str]) -> str:
    """Mean of the known domain-scaled columns; NULL when none is known.  Inputs are not clipped."""
    types = types if isinstance(types, Mapping) else dict.fromkeys(types, "")
    columns = {c: number_sql(c, types[c]) for c in domains if c in types}
    if not columns:
        raise ValueError("no known column is present")
    parts = [f"(({v} - {number(domains[c][0])}) / {number(domains[c][1] - domains[c][0])})" for c, v in columns.items()]
    total = " + ".join(f"coalesce({p}, 0D)" for p in parts)
    known = " + ".join(f"cast({v} is not null as int)" for v in columns.values())
    return f"(({total}) / nullif({known}, 0))"


def fit_heuristic(
    df: DataFrame, target: str, domains: Mapping[str, tuple[float, float]], recalibrate: bool = True
) -> ExpressionModel:
    """clip(a + b * score, 0, 1), with a and b by least squares on the training rows."""
    score = heuristic_sql(domains, dict(df.dtypes))
    a, b = 0.0, 1.0
    if recalibrate:
        row = df.select(F.expr(score).alias("s"), F.col(target).alias("y")).agg(
            F.regr_intercept("y", "s"), F.regr_slope("y", "s")
        ).first()
        a, b = row[0] or 0.0, row[1] if row[1] is not None else 0.0
    line = f"({number(a)} + {number(b)} * {score})"
    # greatest and least skip NULL, so an unknown score is kept apart
    return ExpressionModel(expression=f"case when {score} is not null then greatest(0D, least(1D, {line})) end")


@dataclass(frozen=True)
class Line:
    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    means: tuple[float, ...]

    def sql(self) -> str:
        terms = "".join(f" + {number(w)} * `{c}`" for c, w in zip(self.features, self.weights, strict=True))
        return f"({number(self.intercept)}{terms})"


def linear_weights(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.0) -> Line:
    """Least squares with an unpenalised intercept; alpha is the ridge penalty on the weights.

    Spark reduces the rows to k x k covariances in one pass.
    """
    n, means, cov = covariances(df.where(F.col(target).isNotNull()), [*features, target])
    k = len(features)
    normal = n * cov[:k, :k] + alpha * np.eye(k)
    weights, *_ = np.linalg.lstsq(normal, n * cov[:k, k], rcond=None)
    return Line(tuple(features), float(means[k] - weights @ means[:k]), tuple(map(float, weights)), tuple(map(float, means[:k])))


def fit_linear(df: DataFrame, target: str, plan: PrepPlan, alpha: float = 0.0) -> PipelineModel:
    prep = ColumnPrep.of(plan).fit(df)
    ready = prep.transform(df)
    features = [PREFIX + f for f in prep.feature_names()]
    line = linear_weights(ready, features, target, alpha)
    return PipelineModel([prep, ExpressionModel(expression=line.sql())])


@dataclass(frozen=True)
class LinearFit:
    """``fit_linear`` as a value: validation knows its plan and works from moments instead of refitting."""

    target: str
    plan: PrepPlan
    alpha: float = 0.0

    def __call__(self, df: DataFrame) -> PipelineModel:
        return fit_linear(df, self.target, self.plan, self.alpha)


def fit_trees(df: DataFrame, target: str, plan: PrepPlan, learner, prep: ColumnPrepModel | None = None) -> PipelineModel:
    """The preparation and the trees, both learned from ``df``.

    Every level of every tree looks up the node of each row.  Rows of like features lie beside each other
    (few-valued ones first), so neighbours walk the same paths and add to the same bins, and both stay in the processor's cache.
    Boosted trees that draw no rows see equal rows as one with their number as its weight, which is the same sum; a forest
    draws every copy by itself and is given all rows.  ``prep`` is the preparation if it was learned from ``df`` before.
    """
    prep = prep or ColumnPrep.of(plan).fit(df)
    names = prep.feature_names()
    assembler = VectorAssembler(inputCols=[PREFIX + f for f in names], outputCol="features")
    few = [*plan.boolean, *plan.ordinal]
    order = [PREFIX + f for f in sorted(names, key=lambda f: f not in few)]
    ready, columns, settings = prep.transform(df.where(F.col(target).isNotNull())), ["features", target], {learner.labelCol: target, learner.featuresCol: "features"}
    if isinstance(learner, GBTRegressor) and learner.getSubsamplingRate() == 1.0 and not learner.isDefined("weightCol") and not learner.isDefined("validationIndicatorCol"):
        ready, columns = ready.groupBy(*order, target).agg(F.count("*").cast("double").alias("_rows")), [*columns, "_rows"]
        settings[learner.weightCol] = "_rows"
    fitted = learner.copy(settings).fit(assembler.transform(ready.sortWithinPartitions(*order)).select(*columns))
    return PipelineModel([prep, assembler, fitted])


@dataclass(frozen=True)
class TreeFit:
    """``fit_trees`` as a value: validation prepares a training set once for all settings of one plan."""

    target: str
    plan: PrepPlan
    learner: object

    def __call__(self, df: DataFrame, prep: ColumnPrepModel | None = None) -> PipelineModel:
        return fit_trees(df, self.target, self.plan, self.learner, prep)


def forest(trees: int = 100, seed: int = 42, depth: int = 10) -> RandomForestRegressor:
    """Bootstrapped trees on random feature subsets.

    MLlib has no random-threshold trees, so single predictions differ from an extremely randomised
    ensemble; judge it by its metrics.
    """
    return RandomForestRegressor(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", bootstrap=True, maxBins=64
    )


# Models by name.
MODELS = ("dummy", "heuristica", "ridge", "extra_trees", "automl")


def model_fit(
    name: str, target: str, plan: PrepPlan, domains: Mapping[str, tuple[float, float]], seed: int = 42,
    trees: int = 100, budget: float = 180.0,
) -> Fit:
    """A function that trains the named model on the rows it is given."""
    if name == "dummy":
        return lambda df: PipelineModel([fit_constant(df, target)])
    if name == "heuristica":
        return lambda df: PipelineModel([fit_heuristic(df, target, domains)])
    if name == "ridge":
        return LinearFit(target, plan, 1.0)
    if name == "extra_trees":
        return lambda df: fit_trees(df, target, plan, forest(trees, seed))
    if name == "automl":
        return lambda df: search(df, target, plan, seed=seed, budget=budget)[0]
    raise ValueError(f"unknown model {name}; available: {sorted(MODELS)}")


def candidates(target: str, plan: PrepPlan, seed: int = 42) -> dict[str, list[tuple[str, Fit]]]:
    """Candidate settings by family, cheapest first."""
    return {
        "ridge": [(f"alpha={a}", LinearFit(target, plan, a)) for a in (0.1, 1.0, 10.0)],
        "random_forest": [
            (f"trees={n},depth={d}", TreeFit(target, plan, forest(n, seed, d)))
            for n, d in ((20, 5), (50, 8))
        ],
        "gradient_boosting": [
            (f"iterations={n},depth={d}", TreeFit(target, plan, GBTRegressor(maxIter=n, maxDepth=d, seed=seed)))
            for n, d in ((10, 3), (20, 5))
        ],
    }


def search(
    df: DataFrame, target: str, plan: PrepPlan, key: str | None = None, folds: int = 5, seed: int = 42,
    budget: float | None = None, grid: Mapping[str, Sequence[tuple[str, Fit]]] | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Best model by cross-validated MAE, and (familia, configuracion, MAE): the best setting of every family,
    and with a time ``budget`` in seconds each setting that it left untried, without a MAE.  At least
    one candidate is always tried.  Without a budget all candidates share their folds and what is learned of them."""
    from wardframe.operators.evaluate import cross_validated_mae, cross_validated_maes

    grid = grid or candidates(target, plan, seed)
    started, tried, best = time.monotonic(), [], None
    queue = sorted(((i, family, setting, fit) for family, options in grid.items() for i, (setting, fit) in enumerate(options)), key=lambda q: q[0])
    untried = []
    known = cross_validated_maes(df, [fit for *_, fit in queue], target, key, folds, seed) if budget is None else [None] * len(queue)
    for (_, family, setting, fit), mae in zip(queue, known, strict=True):
        if tried and budget is not None and time.monotonic() - started > budget:
            untried.append((family, setting, None))
            continue
        mae = cross_validated_mae(df, fit, target, key, folds, seed) if budget is not None else mae
        tried.append((family, setting, mae))
        if best is None or mae < best[0]:
            best = (mae, fit)
    winners = {}
    for family, setting, mae in tried:
        if family not in winners or mae < winners[family][2]:
            winners[family] = (family, setting, mae)
    table = df.sparkSession.createDataFrame([*sorted(winners.values(), key=lambda w: w[2]), *untried], "familia string, configuracion string, MAE double")
    return best[1](df), table
