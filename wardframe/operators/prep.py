"""Learned preprocessing.  ``fit`` returns a model whose transform is plain Column expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.functions.cleaning import clipped, to_double
from wardframe.operators.ranks import exact_quantiles, long_numbers, values_at


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians (the built-in imputer is approximate)."""
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value of each column, the smallest on ties."""
    if not columns:
        return {}
    types = dict(df.dtypes)
    text = {c for c in columns if types[c] == "string"}
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            (F.lit(None).cast("double") if c in text else F.col(c).cast("double")).alias("number"),
            (F.col(c) if c in text else F.lit(None).cast("string")).alias("text"),
        )
        for c in columns
    ])
    counts = df.select(F.inline(cells)).where("number is not null or text is not null").groupBy(
        "column", "number", "text"
    ).agg(F.count("*").alias("cnt"))
    top = counts.groupBy("column").agg(F.min_by(F.struct("number", "text"), F.struct(-F.col("cnt"), F.col("number"), F.col("text"))).alias("m"))
    return {r["column"]: (r["m"]["text"] if r["column"] in text else r["m"]["number"]) for r in top.collect()}


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def missing_indicators(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add <c>_ausente (0/1) for the columns that have nulls in ``train``."""
    row = train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    with_nulls = [c for c in columns if row[c] > 0]
    return df.withColumns({f"{c}_ausente": F.col(c).isNull().cast("double") for c in with_nulls})


def ordinal_code(column: Column, order: Sequence[object]) -> Column:
    """0..k-1 by declared order; an undeclared value raises, NULL stays NULL."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), column)
    failed = F.raise_error(F.concat(F.lit("undeclared category: "), column.cast("string")))
    return F.when(column.isNull(), F.lit(None).cast("double")).when(place > 0, (place - 1).cast("double")).otherwise(failed.cast("double"))


def level_name(column: str, value: object) -> str:
    """<column>_<level> without characters that would need quoting; 1.0 and 1 read the same."""
    text = f"{value:g}" if isinstance(value, float) else str(value)
    return f"{column}_{text.replace('.', '_').replace('`', '_')}"


def one_hot(df: DataFrame, column: str, categories: Sequence[object]) -> DataFrame:
    """One 0/1 column per category seen in train; an unknown value gives zeros everywhere."""
    return df.withColumns({
        level_name(column, v): F.coalesce((F.col(column) == F.lit(v)).cast("double"), F.lit(0.0)) for v in categories
    })


def seen_categories(train: DataFrame, column: str) -> list[object]:
    """The levels of a categorical column (levels, not rows)."""
    return [r[0] for r in train.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).collect()]


def standard_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column; a constant column divides by 1."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def min_max_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(min, max - min) per column; a constant column divides by 1."""
    row = df.agg(*[F.min(c).alias(f"a_{c}") for c in columns], *[F.max(c).alias(f"b_{c}") for c in columns]).first()
    return {c: (row[f"a_{c}"], (row[f"b_{c}"] - row[f"a_{c}"]) or 1.0) for c in columns}


def rescale(df: DataFrame, scales: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(float(a))) / F.lit(float(b)) for c, (a, b) in scales.items()})


def quantile_edges(train: DataFrame, column: str, bins: int = 4) -> list[float]:
    """Bin edges by the averaged inverted distribution function of the median-filled column."""
    filled = impute(train.select(F.col(column).cast("double").alias(column)), medians(train, [column]))

    def around(j: int, n: int) -> tuple[int, int]:
        # the averaged inverse takes two neighbours exactly where n*j/bins is whole
        low = max(1, -(-n * j // bins))
        return low, min(n, max(1, n * j // bins + 1))

    sizes, at = values_at(long_numbers(filled, [column]), "column", "value", lambda c, n: sorted({r for j in range(bins + 1) for r in around(j, n)}))
    n = sizes[column]
    return [(at[column, around(j, n)[0]][0] + at[column, around(j, n)[1]][0]) / 2 for j in range(bins + 1)]


def bin_number(column: Column, edges: Sequence[float]) -> Column:
    """0-based bin, left-closed, values outside the edges go to the first or last bin."""
    number = F.lit(0.0)
    for edge in edges[1:-1]:
        number = number + (column >= F.lit(float(edge))).cast("double")
    return F.when(column.isNotNull(), number)


# --- the per-type pipeline as an Estimator ------------------------------------------------


@dataclass(frozen=True)
class PrepPlan:
    """Which treatment each column gets.

    numeric: to double, clip, (median), (standardise).  ordinal: (mode), declared order, (standardise)
    or one-hot.  boolean: (mode), 0/1.  Output columns keep their names; other columns are dropped
    from the features but stay in the frame.
    """

    numeric: tuple[str, ...] = ()
    ordinal: Mapping[str, tuple] = field(default_factory=dict)
    boolean: tuple[str, ...] = ()
    domains: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    scale: bool = True
    min_max: bool = False
    onehot: bool = False
    indicator: bool = False
    log: tuple[str, ...] = ()
    root: tuple[str, ...] = ()
    square: tuple[str, ...] = ()
    derived: Mapping[str, str] = field(default_factory=dict)  # name -> SQL expression over input columns

    def inputs(self) -> list[str]:
        return [*self.numeric, *self.ordinal, *self.boolean]


PREFIX = "prep_"


def input_columns(plan: PrepPlan, types: Mapping[str, str]) -> dict[str, Column]:
    """Coerced, clipped and derived inputs, keyed by output name."""
    def base(c: str) -> Column:
        number = to_double(F.col(c), types[c])
        return clipped(number, *plan.domains[c]) if c in plan.domains else number

    columns = {c: base(c) for c in plan.numeric}
    columns |= {c: (to_double(F.col(c), types[c]) if _numeric_levels(levels) else F.col(c)) for c, levels in plan.ordinal.items()}
    columns |= {c: base(c) for c in plan.boolean}
    columns |= {name: F.expr(sql).cast("double") for name, sql in plan.derived.items()}
    columns |= {f"log_{c}": F.log1p(base(c)) for c in plan.log}
    columns |= {f"sqrt_{c}": F.sqrt(base(c)) for c in plan.root}
    columns |= {f"{c}_cuadrado": base(c) * base(c) for c in plan.square}
    return columns


def _numeric_levels(levels: Sequence[object]) -> bool:
    return all(isinstance(v, (int, float)) for v in levels)


def fit_prep(df: DataFrame, plan: PrepPlan) -> dict:
    """Everything the plan learns, as a small dictionary (bounded by the number of columns)."""
    columns = input_columns(plan, dict(df.dtypes))
    frame = df.select(*[v.alias(k) for k, v in columns.items()])
    numeric = [c for c in columns if c not in plan.ordinal and c not in plan.boolean]
    fill: dict[str, object] = dict(medians(frame, numeric)) if numeric else {}
    fill |= modes(frame, [*plan.ordinal, *plan.boolean])
    fill = {c: v for c, v in fill.items() if v is not None}
    with_nulls: list[str] = []
    if plan.indicator:
        row = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
        with_nulls = [c for c in columns if row[c] > 0]
    filled = impute(frame, fill)
    coded = filled.withColumns({c: ordinal_code(F.col(c), levels) for c, levels in plan.ordinal.items()})
    scaled = [*numeric, *([] if plan.onehot else plan.ordinal)]
    scales: dict[str, tuple[float, float]] = {}
    if scaled and plan.min_max:
        scales = min_max_scales(coded, scaled)
    elif scaled and plan.scale:
        scales = standard_scales(coded, scaled)
    seen = {c: seen_categories(filled, c) for c in plan.ordinal} if plan.onehot else {}
    return {"fill": fill, "with_nulls": with_nulls, "scales": scales, "seen": seen}


def prep_columns(plan: PrepPlan, learned: Mapping, types: Mapping[str, str]) -> dict[str, Column]:
    """Output feature name -> expression over the raw columns."""
    columns, out = input_columns(plan, types), {}
    for c, raw in columns.items():
        value = F.coalesce(raw, F.lit(learned["fill"][c])) if c in learned["fill"] else raw
        if c in plan.ordinal:
            if plan.onehot:
                for v in learned["seen"][c]:
                    out[level_name(c, v)] = F.coalesce((value == F.lit(v)).cast("double"), F.lit(0.0))
                continue
            value = ordinal_code(value, plan.ordinal[c])
        if c in learned["scales"]:
            a, b = learned["scales"][c]
            value = (value - F.lit(float(a))) / F.lit(float(b))
        out[c] = value
    for c in learned["with_nulls"]:
        out[f"{c}_ausente"] = columns[c].isNull().cast("double")
    return out


class _PrepParams(Params):
    plan = Param(Params._dummy(), "plan", "preprocessing plan as JSON", typeConverter=TypeConverters.toString)

    def the_plan(self) -> PrepPlan:
        raw = json.loads(self.getOrDefault(self.plan))
        tuples = {k: tuple(v) for k, v in raw.items() if isinstance(v, list)}
        raw |= tuples
        raw["ordinal"] = {k: tuple(v) for k, v in raw["ordinal"].items()}
        raw["domains"] = {k: tuple(v) for k, v in raw["domains"].items()}
        return PrepPlan(**raw)


class ColumnPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a PrepPlan from the training rows; usable in ``pyspark.ml.Pipeline``."""

    @keyword_only
    def __init__(self, *, plan: str | None = None):
        super().__init__()
        if plan is not None:
            self._set(plan=plan)

    @classmethod
    def of(cls, plan: PrepPlan) -> ColumnPrep:
        return cls(plan=json.dumps(asdict(plan)))

    def _fit(self, dataset: DataFrame) -> ColumnPrepModel:
        learned = fit_prep(dataset, self.the_plan())
        return ColumnPrepModel(plan=self.getOrDefault(self.plan), learned=json.dumps(learned))


class ColumnPrepModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds prep_<name> feature columns; nothing but Column expressions."""

    learned = Param(Params._dummy(), "learned", "learned values as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, plan: str | None = None, learned: str | None = None):
        super().__init__()
        if plan is not None and learned is not None:
            self._set(plan=plan, learned=learned)

    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.learned))

    def features(self, types: Mapping[str, str]) -> dict[str, Column]:
        return prep_columns(self.the_plan(), self.values(), types)

    def feature_names(self) -> list[str]:
        plan, learned = self.the_plan(), self.values()
        types = {c: "double" for c in [*plan.numeric, *plan.boolean]} | {
            c: "double" if _numeric_levels(v) else "string" for c, v in plan.ordinal.items()
        }
        return list(prep_columns(plan, learned, types))

    def feature_sources(self) -> dict[str, str]:
        """The one input column that each feature is made of; derived features are left out."""
        plan, learned = self.the_plan(), self.values()
        sources = {c: c for c in plan.inputs()} | {f"log_{c}": c for c in plan.log} | {f"sqrt_{c}": c for c in plan.root} | {f"{c}_cuadrado": c for c in plan.square}
        sources = {name: c for name, c in sources.items() if name not in plan.derived}
        if plan.onehot:
            sources |= {level_name(c, v): c for c in plan.ordinal for v in learned["seen"][c]}
        return sources | {f"{name}_ausente": sources[name] for name in learned["with_nulls"] if name in sources}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({PREFIX + k: v for k, v in self.features(dict(dataset.dtypes)).items()})
