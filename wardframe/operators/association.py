"""Association between columns, and two-sample tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.functions.cleaning import to_double
from wardframe.functions.pvalues import chi_square_p, student_p
from wardframe.operators.moments import covariances
from wardframe.operators.ranks import grouped_quantiles, spearman
from wardframe.sources.scratch import materialised

# Fixed values: |r| from which two predictors count as redundant.
REDUNDANT = 0.8


def _unpivot(line: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return line.select(F.inline(F.array(*entries)))


def pearson_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(columna, n, pearson, t, pendiente, intercepto) over pairwise complete rows, one scan."""
    y, aggregates = F.col(target).cast("double"), []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [F.regr_count(y, x).alias(f"n{i}"), F.corr(x, y).alias(f"r{i}"),
                       F.regr_slope(y, x).alias(f"s{i}"), F.regr_intercept(y, x).alias(f"a{i}")]
    def entry(i: int, c: str) -> Column:
        n, r = F.col(f"n{i}"), F.col(f"r{i}")
        return F.struct(
            F.lit(c).alias("columna"), n.alias("n"), r.alias("pearson"),
            F.try_divide(r * F.sqrt(n - 2), F.sqrt(1 - r * r)).alias("t"),
            F.col(f"s{i}").alias("pendiente"), F.col(f"a{i}").alias("intercepto"),
        )
    return _unpivot(df.agg(*aggregates), [entry(i, c) for i, c in enumerate(columns)])


def pearson_test(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    return pearson_with_target(df, columns, target).withColumn("p_valor", student_p("t", (F.col("n") - 2).cast("double")))


def spearman_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(columna, n, spearman) for all columns together."""
    types = dict(df.dtypes)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), to_double(F.col(c), types[c]).alias("x"), to_double(F.col(target), types[target]).alias("y"))
        for c in columns
    ])))
    return spearman(long, "x", "y", by=["columna"])


def target_by_level(df: DataFrame, level: str, target: str) -> DataFrame:
    """(nivel, n, media, mediana, desv_estandar); exact medians from value counts."""
    known = df.where(F.col(level).isNotNull())
    y = F.col(target).cast("double")
    table = known.groupBy(F.col(level).cast("string").alias("nivel")).agg(
        F.count(y).alias("n"), F.avg(y).alias("media"), F.stddev_samp(y).alias("desv_estandar")
    )
    long = known.select(F.col(level).cast("string").alias("nivel"), y.alias("y"))
    median = grouped_quantiles(long, "nivel", "y", {"mediana": 0.5})
    return table.join(median, "nivel", "left").select("nivel", "n", "media", "mediana", "desv_estandar")


def welch_and_cohen(df: DataFrame, boolean: str, target: str) -> DataFrame:
    """(n1, n0, diferencia, t, gl, d): unequal variances; d uses the mean of the two variances."""
    y, flag = F.col(target).cast("double"), F.col(boolean).cast("boolean")
    yes, no = F.when(flag, y), F.when(~flag, y)
    line = df.agg(
        F.count(yes).alias("n1"), F.count(no).alias("n0"), F.avg(yes).alias("m1"), F.avg(no).alias("m0"),
        F.var_samp(yes).alias("v1"), F.var_samp(no).alias("v0"),
    )
    s1, s0, gap = F.col("v1") / F.col("n1"), F.col("v0") / F.col("n0"), F.col("m1") - F.col("m0")
    return line.select(
        "n1", "n0", gap.alias("diferencia"), F.try_divide(gap, F.sqrt(s1 + s0)).alias("t"),
        F.try_divide((s1 + s0) * (s1 + s0), s1 * s1 / (F.col("n1") - 1) + s0 * s0 / (F.col("n0") - 1)).alias("gl"),
        F.try_divide(gap, F.sqrt((F.col("v1") + F.col("v0")) / 2)).alias("d"),
    )


def welch_test(df: DataFrame, boolean: str, target: str) -> DataFrame:
    return welch_and_cohen(df, boolean, target).withColumn("p_valor", student_p("t", "gl"))


def point_biserial(df: DataFrame, booleans: Sequence[str], target: str) -> DataFrame:
    """(columna, n, biserial): Pearson of 0/1 with the target."""
    y, aggregates = F.col(target).cast("double"), []
    for i, c in enumerate(booleans):
        x = F.col(c).cast("boolean").cast("double")
        aggregates += [F.regr_count(y, x).alias(f"n{i}"), F.corr(x, y).alias(f"r{i}")]
    return _unpivot(df.agg(*aggregates), [
        F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("biserial"))
        for i, c in enumerate(booleans)
    ])


def association_ranking(df: DataFrame, ordered: Sequence[str], booleans: Sequence[str], target: str) -> DataFrame:
    """(columna, asociacion): |Spearman| for numeric and ordinal, |biserial| for boolean, descending."""
    a = spearman_with_target(df, ordered, target).select("columna", F.abs("spearman").alias("asociacion"))
    b = point_biserial(df, booleans, target).select("columna", F.abs("biserial").alias("asociacion"))
    return a.unionByName(b).orderBy(F.desc("asociacion"), "columna")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna_a, columna_b, pearson): the upper triangle over pairwise complete rows, one scan."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    line = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return _unpivot(line, [
        F.struct(F.lit(a).alias("columna_a"), F.lit(b).alias("columna_b"), F.col(f"r{i}").alias("pearson"))
        for i, (a, b) in enumerate(pairs)
    ])


def redundant_pairs(df: DataFrame, columns: Sequence[str], limit: float = REDUNDANT) -> DataFrame:
    return correlation_matrix(df, columns).where(F.abs("pearson") > limit).withColumn("pearson", F.round("pearson", 3))


def cell_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n): the cells that hold rows, over rows where both are known."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
        F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")
    ).agg(F.count("*").alias("n"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n, pct_fila): long form over rows where both are known, empty cells included.

    The table is a report of a x b lines.  Levels meet through joins, so none of them is gathered.
    """
    counts = materialised(cell_counts(df, a, b), "cells")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counts.groupBy("a").agg(F.sum("n").alias("fila")).withColumn("_part", F.pmod(F.xxhash64("a"), F.lit(parts).cast("long")))
    columns = counts.select("b").distinct().select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("_part"))
    grid = rows.join(columns, "_part").drop("_part")
    return grid.join(counts, ["a", "b"], "left").select(
        "a", "b", F.coalesce("n", F.lit(0)).alias("n"), (100 * F.coalesce("n", F.lit(0)) / F.col("fila")).alias("pct_fila")
    )


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n, filas, columnas, chi2, gl, v_cramer); Yates' correction only with one degree of freedom.

    Only cells that hold rows are looked at: with o rows in a cell of margins r and c, the statistic is
    n (sum o^2 / (r c) - 1), taken as a sum of deviations.  Margins come by join, so levels may be many.
    """
    counts = materialised(cell_counts(df, a, b), "cells")
    of_a, of_b = counts.groupBy("a").agg(F.sum("n").alias("r")), counts.groupBy("b").agg(F.sum("n").alias("c"))
    total = counts.agg(F.sum("n")).scalar()
    cells = counts.join(of_a, "a").join(of_b, "b").select("n", (F.col("r") * F.col("c") / total).alias("e"))
    # cells without rows deviate by their expectation: n less what the others expect
    gap = F.col("n") - F.col("e")
    sums = cells.agg(
        F.sum("n").alias("n"), (F.sum(gap * gap / F.col("e")) + F.sum("n") - F.sum("e")).alias("_plain"),
        # of four cells with the same deviation, one that holds rows gives it, and all expectations follow from margins
        F.first(F.abs(gap)).alias("_gap"))
    # one number each; a join of single rows has no key and would be a nested loop
    shape = sums.withColumns({
        "filas": of_a.agg(F.count("*")).scalar(), "_ir": of_a.agg(F.sum(1 / F.col("r"))).scalar(),
        "columnas": of_b.agg(F.count("*")).scalar(), "_ic": of_b.agg(F.sum(1 / F.col("c"))).scalar()})
    yates = F.pow(F.col("_gap") - F.least("_gap", F.lit(0.5)), 2) * F.col("n") * F.col("_ir") * F.col("_ic")
    return shape.withColumn("gl", (F.col("filas") - 1) * (F.col("columnas") - 1)).withColumn(
        "chi2", F.when(F.col("gl") == 1, yates).otherwise(F.greatest(F.lit(0.0), F.col("_plain")))).select(
        "n", "filas", "columnas", "chi2", "gl",
        F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.least("filas", "columnas") - 1))).alias("v_cramer"),
    )


def chi_square_test(df: DataFrame, a: str, b: str) -> DataFrame:
    return chi_square(df, a, b).withColumn("p_valor", chi_square_p("chi2", F.col("gl").cast("double")))


def means_by_level(df: DataFrame, level: str, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    return df.where(F.col(level).isNotNull()).groupBy(level).agg(
        *[F.round(F.avg(F.col(c).cast("double")), decimals).alias(c) for c in columns]
    )


def variance_inflation(df: DataFrame, columns: Sequence[str], decimals: int = 3) -> DataFrame:
    """(variable, r2_contra_las_demas, vif) over the complete rows, largest first.

    Spark produces the k x k covariances in one pass; only those reach the driver.  A column that
    the others determine has an infinite factor.
    """
    complete = df.where(reduce(lambda u, v: u & v, [F.col(c).isNotNull() for c in columns]))
    _, _, cov = covariances(complete, columns)
    scale = np.sqrt(np.diag(cov))
    scale[scale == 0] = 1.0
    corr = cov / np.outer(scale, scale)
    lines = []
    for i, c in enumerate(columns):
        others = [j for j in range(len(columns)) if j != i]
        weights, *_ = np.linalg.lstsq(corr[np.ix_(others, others)], corr[others, i], rcond=1e-12)
        r2 = float(min(1.0, corr[i, others] @ weights))
        vif = float("inf") if 1 - r2 < 1e-12 else 1 / (1 - r2)
        lines.append((c, round(r2, decimals), round(vif, decimals)))
    lines.sort(key=lambda line: -line[2])
    return df.sparkSession.createDataFrame(lines, "variable string, r2_contra_las_demas double, vif double")


def two_key_effect(df: DataFrame, level: str, boolean: str, target: str) -> DataFrame:
    """(nivel, media_false, n_false, media_true, n_true, brecha) by level and boolean."""
    flag, y = F.col(boolean).cast("boolean"), F.col(target).cast("double")
    table = df.where(F.col(level).isNotNull()).groupBy(F.col(level).cast("string").alias("nivel")).agg(
        F.avg(F.when(~flag, y)).alias("media_false"), F.count(F.when(~flag, y)).alias("n_false"),
        F.avg(F.when(flag, y)).alias("media_true"), F.count(F.when(flag, y)).alias("n_true"),
    )
    return table.withColumn("brecha", F.col("media_true") - F.col("media_false"))


def paired_comparison(a: DataFrame, b: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """(n, diferencia_media, desviacion, t): a minus b on shared folds; population deviation."""
    joined = a.select(*keys, F.col(score).alias("_a")).join(b.select(*keys, F.col(score).alias("_b")), list(keys))
    d = F.col("_a") - F.col("_b")
    return joined.agg(
        F.count(d).alias("n"), F.avg(d).alias("diferencia_media"), F.stddev_pop(d).alias("desviacion"),
        F.stddev_samp(d).alias("_s"),
    ).select("n", "diferencia_media", "desviacion", F.try_divide("diferencia_media", F.col("_s") / F.sqrt("n")).alias("t"))


def paired_test(a: DataFrame, b: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    return paired_comparison(a, b, keys, score).withColumn("p_valor", student_p("t", (F.col("n") - 1).cast("double")))
