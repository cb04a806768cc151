"""Naming, cleaning, typing and feature building."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe import vocabulary as words
from wardframe.functions import cleaning as fx
from wardframe.operators.contracts import violations_error

EXAMPLES = 5


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[fx.clean_name(c) for c in df.columns])


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Only the expected columns, in order; a missing one is an error that lists them all."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*expected)


def context_columns(df: DataFrame, predictors: Sequence[str]) -> list[str]:
    """The columns that are carried to the output untouched; predictors must all be there."""
    missing = [c for c in predictors if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return [c for c in df.columns if c not in predictors]


def unify_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, sentinels: Sequence[str] = fx.NULL_SENTINELS
) -> DataFrame:
    chosen = list(columns) if columns is not None else df.columns
    return df.withColumns({c: fx.unified_null(F.col(c).cast("string"), sentinels) for c in chosen})


def sentinel_audit(
    df: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = fx.NULL_SENTINELS
) -> DataFrame:
    """(column, value, n, total): every sentinel spelling found, worst column first."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value"))
        for c in columns
    ])
    counts = (
        df.select(F.inline(cells))
        .where(F.lower(fx.stripped(F.col("value"))).isin(list(sentinels)))
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(totals, "column").orderBy(F.desc("total"), "column", F.desc("n"), "value")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Identical rows collapse to one; NULL equals NULL.  Run it on text, before typing."""
    return df.dropDuplicates()


def duplicates_removed(df: DataFrame) -> DataFrame:
    """(filas, distintas, duplicadas) in one aggregation."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("filas"),
        F.count("*").alias("distintas"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicadas"),
    )


@dataclass(frozen=True)
class Typing:
    """Which columns become what.  Columns that are not present are skipped."""

    integers: Sequence[str] = ()
    decimals: Sequence[str] = ()
    booleans: Sequence[str] = ()
    ordinals: Mapping[str, Sequence[str]] = field(default_factory=dict)
    boolean_words: Mapping[str, bool] = field(default_factory=lambda: {"0": False, "1": True})

    def present(self, df: DataFrame) -> list[str]:
        names = [*self.integers, *self.decimals, *self.booleans, *self.ordinals]
        return [c for c in names if c in df.columns]

    def typed(self, name: str) -> Column:
        text = F.col(name)
        if name in self.integers:
            return fx.text_to_long(text)
        if name in self.decimals:
            return fx.text_to_double(text)
        if name in self.booleans:
            return fx.text_to_boolean(text, self.boolean_words)
        return F.when(text.isin(list(self.ordinals[name])), text)

    def rule(self, name: str) -> str:
        if name in self.booleans:
            return words.NOT_BOOLEAN
        return words.INVALID_CATEGORY if name in self.ordinals else words.NOT_CONVERTIBLE


def typed_columns(df: DataFrame, typing: Typing) -> DataFrame:
    """The typed frame; a value that cannot be typed is NULL (see ``lost_in_typing``)."""
    return df.withColumns({c: typing.typed(c) for c in typing.present(df)})


def lost_values(df: DataFrame, typing: Typing) -> DataFrame:
    """(column, rule, value, n): text that typing would turn into NULL.  One scan."""
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(typing.rule(c)).alias("rule"),
            F.when(F.col(c).isNotNull() & typing.typed(c).isNull(), F.col(c)).alias("value"),
        )
        for c in typing.present(df)
    ])
    return (
        df.select(F.inline(cells)).where("value is not null")
        .groupBy("column", "rule", "value").agg(F.count("*").alias("n"))
    )


def lost_in_typing(df: DataFrame, typing: Typing) -> DataFrame:
    """Violations of the typing step, with up to five distinct examples each."""
    lost = lost_values(df, typing)
    order = Window.partitionBy("column").orderBy("value")
    examples = (
        lost.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= EXAMPLES)
        # n and rule ride along so that both branches read the same shuffle
        .groupBy("column").agg(F.array_sort(F.collect_list(F.struct("value", "n", "rule"))).alias("_s"))
        .select("column", F.array_join(F.transform("_s", lambda s: s["value"]), ", ").alias("_e"))
    )
    totals = lost.groupBy("column", "rule").agg(F.sum("n").alias("n"), F.count("value").alias("_d"))
    return totals.join(examples, "column").select(
        F.col("rule").alias("regla"), F.col("column").alias("columna"),
        F.col("_e").alias("detalle"), F.col("n").alias("filas_afectadas"),
    )


def most_lost(df: DataFrame, typing: Typing, top: int = 10) -> DataFrame:
    """The most frequent lost values per column."""
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (
        lost_values(df, typing).withColumn("posicion", F.row_number().over(order))
        .where(F.col("posicion") <= top).select("column", "posicion", "value", "n")
    )


def typed_or_error(df: DataFrame, typing: Typing, context: str = "") -> DataFrame:
    """Typed frame, or one error that lists every column with unconvertible text."""
    names = typing.present(df)
    lost = df.agg(*[F.count_if(F.col(c).isNotNull() & typing.typed(c).isNull()).alias(c) for c in names]).first() if names else ()
    if any(lost):
        raise violations_error(lost_in_typing(df, typing).collect(), context)
    return typed_columns(df, typing)


def typing_summary(df: DataFrame, typing: Typing) -> DataFrame:
    """(columna, nulos_antes, nulos_despues) per typed column, one scan."""
    names = typing.present(df)
    sums = []
    for c in names:
        sums += [F.count_if(F.col(c).isNull()).alias(f"{c}|a"), F.count_if(typing.typed(c).isNull()).alias(f"{c}|b")]
    line = df.agg(*sums)
    return line.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(f"`{c}|a`").alias("nulos_antes"), F.col(f"`{c}|b`").alias("nulos_despues"))
        for c in names
    ])))


def to_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: fx.to_double(F.col(c), types[c]) for c in columns})


def clip_to_domain(df: DataFrame, domains: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Columns without a declared domain are left alone; NULL stays NULL."""
    present = {c: d for c, d in domains.items() if c in df.columns}
    return df.withColumns({c: fx.clipped(F.col(c), *d) for c, d in present.items()})


def clipped_cells(df: DataFrame, domains: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(columna, celdas): how many known cells clipping changes."""
    present = {c: d for c, d in domains.items() if c in df.columns}
    line = df.agg(*[F.count_if((F.col(c) < d[0]) | (F.col(c) > d[1])).alias(c) for c, d in present.items()])
    return line.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).alias("celdas")) for c in present
    ])))


def mean_of_scaled(parts: Mapping[str, tuple[float, float]]) -> Column:
    """Mean of domain-scaled columns; NULL when any part is NULL."""
    total = None
    for c, (low, high) in parts.items():
        scaled = fx.domain_scaled(F.col(c), low, high)
        total = scaled if total is None else total + scaled
    return total / len(parts)


def mean_of_two(a: str, b: str) -> Column:
    return (F.col(a) + F.col(b)) / 2


def product(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def add_nonlinear(
    df: DataFrame, log: Sequence[str] = (), root: Sequence[str] = (), square: Sequence[str] = ()
) -> DataFrame:
    """Extra columns log_<c> = log(1+c), sqrt_<c> and <c>_cuadrado."""
    added = {f"log_{c}": F.log1p(c) for c in log}
    added |= {f"sqrt_{c}": F.sqrt(c) for c in root}
    added |= {f"{c}_cuadrado": F.col(c) * F.col(c) for c in square}
    return df.withColumns(added)


def domain_scale(df: DataFrame, domains: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - min) / (max - min) by the documented domain, not by the observed range."""
    return df.withColumns({c: fx.domain_scaled(F.col(c), *d) for c, d in domains.items() if c in df.columns})


def feature_matrix(
    df: DataFrame, target: str, domains: Mapping[str, tuple[float, float]],
    derived: Mapping[str, Column] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Predictors as clipped doubles, then derived columns, then the target.  Nothing is learned."""
    predictors = [c for c in df.columns if c != target and c not in keep]
    out = clip_to_domain(to_doubles(df, predictors), domains)
    if derived:
        out = out.withColumns(dict(derived))
    return out.select(*keep, *predictors, *(derived or {}), F.col(target).cast("double").alias(target))


