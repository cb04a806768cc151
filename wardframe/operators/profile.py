"""Column profiles.  Distinct counts and quantiles come from one pass of value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.functions.hashing import hash60
from wardframe.operators.contracts import repeated_rows
from wardframe.operators.ranks import exact_quantiles, grouped_quantiles, long_numbers

# Outlier fence in interquartile ranges, and the normality test level.
OUTLIER_FENCE = 1.5
NORMALITY_ALPHA = 0.05


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, valor) with every value as text."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in columns
    ])))


def _typed(df: DataFrame, columns: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    result = F.lit(None).cast("string")
    for c in columns:
        result = F.when(F.col("columna") == c, F.lit(types[c])).otherwise(result)
    return result


def column_inventory(df: DataFrame, columns: Sequence[str] | None = None, examples: int = 4) -> DataFrame:
    """(columna, tipo, distintos, vacios, pct_vacios, ejemplos); a blank is NULL or only whitespace.

    Equal values collapse before the shuffle; examples are the smallest values in text order.
    """
    names = list(columns or df.columns)
    counts = _cells(df, names).groupBy("columna", "valor").agg(F.count("*").alias("cnt"))
    blank = F.col("valor").isNull() | (F.trim("valor") == "")
    order = Window.partitionBy("columna").orderBy(F.asc_nulls_last("valor"))
    # cnt rides along and NULL is left out late, so that both branches read the same shuffle
    shown = (
        counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= examples)
        .groupBy("columna").agg(F.array_sort(F.collect_list(F.struct("valor", "cnt"))).alias("_s"))
        .select("columna", F.array_join(F.transform("_s", lambda s: s["valor"]), ", ").alias("ejemplos"))
    )
    summary = counts.groupBy("columna").agg(
        F.count("valor").alias("distintos"),
        F.coalesce(F.sum(F.when(blank, F.col("cnt"))), F.lit(0)).alias("vacios"),
        F.sum("cnt").alias("_n"),
    )
    return summary.join(F.broadcast(shown), "columna", "left").select(
        "columna", _typed(df, names).alias("tipo"), "distintos", "vacios",
        F.round(100 * F.col("vacios") / F.col("_n"), 2).alias("pct_vacios"), "ejemplos",
    )


def data_sheet(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(columna, tipo, nulos, pct_nulos, distintos)."""
    names = list(columns or df.columns)
    counts = _cells(df, names).groupBy("columna", "valor").agg(F.count("*").alias("cnt"))
    return counts.groupBy("columna").agg(
        F.coalesce(F.sum(F.when(F.col("valor").isNull(), F.col("cnt"))), F.lit(0)).alias("nulos"),
        F.count("valor").alias("distintos"), F.sum("cnt").alias("_n"),
    ).select(
        "columna", _typed(df, names).alias("tipo"), "nulos",
        F.round(100 * F.col("nulos") / F.col("_n"), 2).alias("pct_nulos"), "distintos",
    )


def _corrected_skewness(n: Column, g1: Column) -> Column:
    return g1 * F.sqrt(n * (n - 1)) / (n - 2)


def _corrected_kurtosis(n: Column, g2: Column) -> Column:
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)


def fences(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Outlier fences per column from exact quartiles."""
    found = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is not None:
            found[c] = (q1 - OUTLIER_FENCE * (q3 - q1), q3 + OUTLIER_FENCE * (q3 - q1))
    return found


def numeric_profile(df: DataFrame, columns: Sequence[str], decimals: int = 3) -> DataFrame:
    """One row per column: size, centre, spread, shape and outliers."""
    centre = grouped_quantiles(long_numbers(df, columns), "column", "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, mode="m").collect()
    found = {r["column"]: (r["q1"], r["q2"], r["q3"], r["m"]) for r in centre}  # one row per column
    names = [c for c in columns if c in found]
    aggregates = []
    for i, c in enumerate(names):
        x = F.col(c).cast("double")
        q1, _, q3, _ = found[c]
        low, high = q1 - OUTLIER_FENCE * (q3 - q1), q3 + OUTLIER_FENCE * (q3 - q1)
        aggregates += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
            F.var_samp(x).alias(f"v{i}"), F.skewness(x).alias(f"g{i}"), F.kurtosis(x).alias(f"k{i}"),
            F.count_if((x < low) | (x > high)).alias(f"o{i}"),
        ]
    line = df.agg(*aggregates)

    def rounded(value: Column, name: str) -> Column:
        return F.round(value, decimals).alias(name)

    def entry(i: int, c: str) -> Column:
        q1, q2, q3, mode = (F.lit(float(q)) for q in found[c])
        n, m, lo, hi, v, g, k = (F.col(f"{p}{i}") for p in ("n", "m", "lo", "hi", "v", "g", "k"))
        return F.struct(
            F.lit(c).alias("columna"), n.alias("n"), rounded(m, "media"), rounded(q2, "mediana"), rounded(mode, "moda"),
            rounded(lo, "minimo"), rounded(hi, "maximo"), rounded(hi - lo, "rango"),
            rounded(q1, "q1"), rounded(q3, "q3"), rounded(q3 - q1, "iqr"), rounded(v, "varianza"),
            rounded(F.sqrt(v), "desv_estandar"), rounded(F.try_divide(100 * F.sqrt(v), m), "coef_variacion_pct"),
            rounded(F.when(n > 2, _corrected_skewness(n, g)), "skewness"),
            rounded(F.when(n > 3, _corrected_kurtosis(n, k)), "kurtosis_exceso"),
            F.col(f"o{i}").alias("n_atipicos_iqr"),
        )

    return line.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(names)])))


def flag_outliers(df: DataFrame, columns: Sequence[str], name: str = "atipico") -> DataFrame:
    """Add a boolean column that is TRUE when any of the columns lies outside its fences."""
    flag = F.lit(False)
    for c, (low, high) in fences(df, columns).items():
        flag = flag | F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))
    return df.withColumn(name, flag)


def _k2(n: Column, g1: Column, g2: Column) -> Column:
    """D'Agostino-Pearson statistic from population skewness and excess kurtosis."""
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    b2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    delta, alpha = 1 / F.sqrt(0.5 * F.log(w2)), F.sqrt(2.0 / (w2 - 1))
    z1 = delta * F.log(y / alpha + F.sqrt((y / alpha) * (y / alpha) + 1))
    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - mean) / F.sqrt(var)
    b1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / b1 * (2.0 / b1 + F.sqrt(1 + 4.0 / (b1 * b1)))
    ratio = (1 - 2.0 / a) / (1 + x * F.sqrt(2.0 / (a - 4.0)))
    z2 = ((1 - 2.0 / (9.0 * a)) - F.signum(ratio) * F.pow(F.abs(ratio), 1.0 / 3.0)) / F.sqrt(2.0 / (9.0 * a))
    return z1 * z1 + z2 * z2


def normality_test(df: DataFrame, columns: Sequence[str], alpha: float = NORMALITY_ALPHA) -> DataFrame:
    """(columna, n, k2, p_valor, rechaza): p = exp(-K2 / 2), two degrees of freedom."""
    aggregates = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [F.count(x).cast("double").alias(f"n{i}"), F.skewness(x).alias(f"g{i}"), F.kurtosis(x).alias(f"k{i}")]
    table = df.agg(*aggregates).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("_n"), F.col(f"g{i}").alias("_g"), F.col(f"k{i}").alias("_k"))
        for i, c in enumerate(columns)
    ]))).withColumn("k2", F.when(F.col("_n") >= 8, _k2(F.col("_n"), F.col("_g"), F.col("_k"))))
    p = F.exp(-F.col("k2") / 2)
    return table.select("columna", F.col("_n").cast("bigint").alias("n"), "k2", p.alias("p_valor"), (p <= alpha).alias("rechaza"))


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """(nivel, n, pct): the NULL level is counted in n; shares are over the known values."""
    counts = df.groupBy(F.col(column).cast("string").alias("nivel")).agg(F.count("*").alias("n"))
    total = df.agg(F.count(column).alias("t")).scalar()
    return counts.select(
        "nivel", "n", F.when(F.col("nivel").isNotNull(), 100 * F.col("n") / total).alias("pct")
    ).orderBy("nivel")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, n, media, desv_estandar, minimo, maximo) in one aggregation."""
    aggregates = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                       F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    return df.agg(*aggregates).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("media"),
                 F.col(f"s{i}").alias("desv_estandar"), F.col(f"lo{i}").alias("minimo"), F.col(f"hi{i}").alias("maximo"))
        for i, c in enumerate(columns)
    ])))


def null_overview(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(filas, celdas_nulas, filas_con_nulos, filas_todo_nulo)."""
    names = list(columns or df.columns)
    missing = F.lit(0)
    for c in names:
        missing = missing + F.col(c).isNull().cast("int")
    return df.select(missing.alias("_m")).agg(
        F.count("*").alias("filas"), F.coalesce(F.sum("_m"), F.lit(0)).alias("celdas_nulas"),
        F.count_if(F.col("_m") > 0).alias("filas_con_nulos"),
        F.count_if(F.col("_m") == len(names)).alias("filas_todo_nulo"),
    )


def nulls_before_after(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, nulos_antes, nulos_despues) of two versions of a table."""
    def side(df: DataFrame, name: str) -> DataFrame:
        line = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return line.select(F.inline(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias(name)) for c in columns])))
    return side(before, "nulos_antes").join(side(after, "nulos_despues"), "columna")


def duplicates_by_projection(df: DataFrame, subsets: Mapping[str, Sequence[str]]) -> DataFrame:
    """(atributos, repetidas): duplicate rows of each attribute subset."""
    result = None
    for name, columns in subsets.items():
        part = repeated_rows(df.select(*columns)).select(F.lit(name).alias("atributos"), "repetidas")
        result = part if result is None else result.unionByName(part)
    return result


def missingness_diagnosis(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Does the target differ where a column is missing?  Welch's t and its degrees of freedom;
    columns without nulls are left out."""
    y = F.col(target).cast("double")
    aggregates = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        for tag, cond in (("a", F.col(c).isNull()), ("b", F.col(c).isNotNull())):
            v = F.when(cond, y)
            aggregates += [F.count(v).alias(f"n{tag}{i}"), F.avg(v).alias(f"m{tag}{i}"), F.var_samp(v).alias(f"v{tag}{i}")]
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"z{i}"))
    cells = []
    for i, c in enumerate(columns):
        na, nb, ma, mb, va, vb = (F.col(f"{p}{t}{i}") for p in "nmv" for t in "ab")
        sa, sb = va / na, vb / nb
        cells.append(F.struct(
            F.lit(c).alias("columna"), F.col(f"z{i}").alias("n_nulos"), (100 * F.col(f"z{i}") / F.col("_n")).alias("pct_nulos"),
            ma.alias("target_medio_con_nulo"), mb.alias("target_medio_sin_nulo"),
            F.try_divide(ma - mb, F.sqrt(sa + sb)).alias("t"),
            F.try_divide((sa + sb) * (sa + sb), sa * sa / (na - 1) + sb * sb / (nb - 1)).alias("gl"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*cells))).where("n_nulos > 0").orderBy(F.desc("pct_nulos"), "columna")


def seeded_sample(df: DataFrame, key: str, n: int, salt: str = "sample") -> DataFrame:
    """The same n rows on every run, whatever the partitioning (a distributed top-n, not a sort)."""
    return df.withColumn("_h", hash60(F.col(key), salt)).orderBy("_h", key).limit(n).drop("_h")


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


