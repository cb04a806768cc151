"""Reproducible splits and folds, and the checks that a split leaks nothing and does not drift."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe import vocabulary as words
from wardframe.functions.hashing import hash60, hash_below, hash_fold
from wardframe.operators.contracts import ContractError
from wardframe.operators.ranks import (
    exact_quantiles,
    group_number,
    hash_cuts,
    kolmogorov_smirnov,
    quantile_group_ranks,
    rank_cuts,
    running_counts,
)
from wardframe.session import run_together
from wardframe.sources.scratch import materialised

CHECK_SCHEMA = "chequeo string, columna string, severidad string, estadistico double, umbral double, detalle string"
CHECK_COLUMNS = ("chequeo", "columna", "severidad", "estadistico", "umbral", "detalle")

# Shares, seeds and limits of the split and its checks.
TEST_SHARE = 0.25
SEED = 42
MAX_OVERLAP = 0.05
MAX_KS = 0.2
MAX_DOMAIN_AUC = 0.65
PENALTY = 1.0
SHARE_TOLERANCE = 0.05
MIN_RATIO = 0.01
MIN_TEST_ROWS = 30
MAX_NULL_GAP = 0.10

TRAIN, TEST = "train", "test"


# --- splits and folds ---------------------------------------------------------------------


def seeded_split(
    df: DataFrame, key: str, share: float = TEST_SHARE, seed: int = SEED, exact: bool = False, name: str = "split"
) -> DataFrame:
    """Add ``split`` = train / test from a hash of the key.

    By share (a narrow projection) or, with ``exact``, with exactly ceil(share * n) test rows; the
    threshold is then found with two light scans, and the assignment is still narrow.
    """
    salt = f"split{seed}"
    if not exact:
        return df.withColumn(name, F.when(hash_below(F.col(key), share, salt), F.lit(TEST)).otherwise(F.lit(TRAIN)))
    hashed = df.select(F.lit(0).alias("g"), hash60(F.col(key), salt).alias("h"))
    cuts = hash_cuts(hashed, "g", "h", lambda n: [math.ceil(share * n)]).get(0, [])
    limit = F.lit(cuts[0]) if cuts else F.lit(-1)
    return df.withColumn(name, F.when(hash60(F.col(key), salt) <= limit, F.lit(TEST)).otherwise(F.lit(TRAIN)))


def kfold(df: DataFrame, key: str, folds: int = 5, seed: int = SEED, name: str = "fold") -> DataFrame:
    return df.withColumn(name, hash_fold(F.col(key), folds, f"fold{seed}"))


def repeated_kfold(df: DataFrame, key: str, folds: int = 5, repeats: int = 5, seed: int = SEED) -> DataFrame:
    """One row per (row, repeat) with its validation fold; each repeat shuffles anew."""
    cells = F.array(*[
        F.struct(F.lit(r).alias("repeticion"), hash_fold(F.col(key), folds, f"fold{seed}r{r}").alias("fold"))
        for r in range(1, repeats + 1)
    ])
    return df.select("*", F.inline(cells))


def stratified_kfold(
    df: DataFrame, key: str, target: str, folds: int = 5, groups: int = 4, seed: int = SEED
) -> DataFrame:
    """Add ``grupo`` (quantile group of the target by first-come rank) and ``fold``; every group is
    dealt evenly over the folds.  Only the cut points travel; rows are assigned in place."""
    rows = df.select(F.lit(0).alias("g"), F.col(target).alias("value"), F.col(key).alias("tie"))
    cuts = rank_cuts(rows, "g", "value", "tie", quantile_group_ranks(groups)).get(0, [])
    grouped = df.withColumn("grupo", group_number(cuts, F.col(target), F.col(key)))
    salt = f"strata{seed}"
    hashed = grouped.select("grupo", hash60(F.col(key), salt).alias("h"))
    limits = hash_cuts(hashed, "grupo", "h", lambda n: [math.ceil(n * j / folds) for j in range(1, folds)])
    fold, h = F.lit(None).cast("int"), hash60(F.col(key), salt)
    for g, values in limits.items():
        place = reduce(lambda u, v: u + (h > F.lit(v)).cast("int"), values, F.lit(0))
        fold = F.when(F.col("grupo").eqNullSafe(F.lit(g)), place).otherwise(fold)  # rows without a target are a group of their own
    return grouped.withColumn("fold", fold)


def time_series_folds(df: DataFrame, time: str, key: str, folds: int = 5) -> DataFrame:
    """Add ``bloque``: 0 for the opening training block, i for the i-th test block.

    Fold i tests block i and trains on every earlier block; each test block has n // (folds+1) rows.
    """
    rows = df.select(F.lit(0).alias("g"), F.col(time).alias("value"), F.col(key).alias("tie"))

    def ranks(n: int) -> list[int]:
        size = n // (folds + 1)
        return [n - size * j for j in range(folds, 0, -1)]

    cuts = rank_cuts(rows, "g", "value", "tie", ranks).get(0, [])
    return df.withColumn("bloque", group_number(cuts, F.col(time), F.col(key)))


# --- checks -------------------------------------------------------------------------------


def is_test(split: str = "split") -> Column:
    return F.col(split) == TEST


def _check(code, column, severity, statistic, limit, detail) -> list[Column]:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return [
        F.lit(code).alias("chequeo"), as_col(column).alias("columna"), as_col(severity).alias("severidad"),
        as_col(statistic).cast("double").alias("estadistico"), as_col(limit).cast("double").alias("umbral"),
        as_col(detail).cast("string").alias("detalle"),
    ]


def _warn(above: Column) -> Column:
    return F.when(above, F.lit(words.WARNING)).otherwise(F.lit(words.OK))


def check_keys(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """A key on both sides is a leak.  One grouping, no join."""
    sides = df.groupBy(key).agg(F.bool_or(is_test(split)).alias("te"), F.bool_or(~is_test(split)).alias("tr"))
    n = F.col("n")
    return sides.agg(F.count_if(F.col("te") & F.col("tr")).alias("n")).select(*_check(
        words.CHECK_KEYS, "", F.when(n > 0, F.lit(words.ERROR)).otherwise(F.lit(words.OK)), n, 0.0,
        F.concat(n.cast("string"), F.lit(" keys are on both sides")),
    ))


def shared_rows(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """(compartidas, prueba): test rows whose predictor tuple is also in train.

    A tuple with a NULL never matches.  Equal tuples collapse before the shuffle, so a profile
    that repeats a billion times costs one row.
    """
    complete = reduce(lambda u, v: u & v, [F.col(c).isNotNull() for c in columns])
    tuples = df.groupBy(*columns).agg(F.count_if(is_test(split)).alias("te"), F.count_if(~is_test(split)).alias("tr"))
    return tuples.agg(
        F.coalesce(F.sum(F.when(complete & (F.col("tr") > 0), F.col("te"))), F.lit(0)).alias("compartidas"),
        F.coalesce(F.sum("te"), F.lit(0)).alias("prueba"),
    )


def check_shared_rows(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    share = F.coalesce(F.try_divide(F.col("compartidas"), F.col("prueba")), F.lit(0.0))
    severity = F.when(F.col("compartidas") == 0, F.lit(words.OK)).when(share > MAX_OVERLAP, F.lit(words.ERROR)).otherwise(F.lit(words.WARNING))
    return shared_rows(df, columns, split).select(*_check(
        words.CHECK_SHARED, "", severity, share, MAX_OVERLAP,
        F.concat(F.col("compartidas").cast("string"), F.lit(" of "), F.col("prueba").cast("string"), F.lit(" test rows are also in train")),
    ))


def check_sizes(df: DataFrame, share: float = TEST_SHARE, split: str = "split") -> DataFrame:
    counts = df.agg(F.count("*").alias("n"), F.count_if(is_test(split)).alias("te"))
    got = F.coalesce(F.try_divide(F.col("te"), F.col("n")), F.lit(0.0))
    ratio = F.coalesce(F.try_divide(F.col("te"), F.col("n") - F.col("te")), F.lit(0.0))
    gap = F.abs(got - share)
    sizes = F.concat(F.col("te").cast("string"), F.lit(" test rows, "), (F.col("n") - F.col("te")).cast("string"), F.lit(" train rows"))
    lines = [
        F.struct(*_check(words.CHECK_SHARE, "", _warn(gap > SHARE_TOLERANCE), gap, SHARE_TOLERANCE, sizes)),
        F.struct(*_check(words.CHECK_SIZE, "", _warn((ratio < MIN_RATIO) | (F.col("te") < MIN_TEST_ROWS)), F.col("te"), float(MIN_TEST_ROWS), sizes)),
    ]
    return counts.select(F.inline(F.array(*lines)))


def check_column_drift(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    return _column_drift(kolmogorov_smirnov(df, columns, is_test(split)))


def _column_drift(table: DataFrame) -> DataFrame:
    return table.select(*_check(
        words.CHECK_COLUMN_DRIFT, F.col("column"), _warn(F.col("statistic") > MAX_KS), F.col("statistic"), MAX_KS,
        "largest gap between the train and test distributions",
    ))


def check_target_drift(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """A null target cannot be compared: with any, the statistic is NULL, the verdict a warning, and the
    detail gives their number."""
    return _target_drift(df, kolmogorov_smirnov(df, [target], is_test(split)), target, split)


def _target_drift(df: DataFrame, ks: DataFrame, target: str, split: str) -> DataFrame:
    means = df.agg(
        F.avg(F.when(~is_test(split), F.col(target))).alias("tr"), F.avg(F.when(is_test(split), F.col(target))).alias("te"),
        F.count_if(F.col(target).isNull()).alias("nulls"),
    )
    # two one-row frames, brought together without a join
    together = means.withColumn("statistic", F.lit(None).cast("double")).unionByName(
        ks.select("statistic"), allowMissingColumns=True
    ).groupBy().agg(*[F.max(c).alias(c) for c in ("tr", "te", "nulls", "statistic")])
    together = together.withColumn("statistic", F.when(F.col("nulls") == 0, F.col("statistic")))
    return together.select(*_check(
        words.CHECK_TARGET_DRIFT, target,
        _warn(F.coalesce(F.col("statistic") > MAX_KS, F.lit(True))), F.col("statistic"), MAX_KS,
        F.concat(F.lit("means "), F.format_number("tr", 3), F.lit(" and "), F.format_number("te", 3),
                 F.lit(", null targets "), F.col("nulls").cast("string")),
    ))


def check_new_categories(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """One row per column, passes included; (column, value) pairs collapse before the shuffle."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), is_test(split).alias("te")) for c in columns
    ])
    pairs = df.select(F.inline(cells)).where("value is not null").groupBy("column", "value").agg(F.bool_and("te").alias("new"))
    order = Window.partitionBy("column").orderBy("value")
    shown = (
        pairs.where("new").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= 5)
        .groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("_e"))
    )
    counts = pairs.groupBy("column").agg(F.count_if("new").alias("n"))
    everyone = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    table = everyone.join(counts, "column", "left").join(shown, "column", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return table.select(*_check(
        words.CHECK_NEW_CATEGORY, F.col("column"), _warn(F.col("n") > 0), F.col("n"), 0.0,
        F.coalesce(F.concat(F.lit("only in test: "), "_e"), F.lit("no new categories")),
    ))


def null_share_gaps(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """(column, gap) for every column, one scan."""
    def share(c: str, side: Column) -> Column:
        return F.avg(F.when(side, F.col(c).isNull().cast("double")))
    line = df.agg(*[F.abs(share(c, ~is_test(split)) - share(c, is_test(split))).alias(f"g{i}") for i, c in enumerate(columns)])
    return line.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"g{i}").alias("gap")) for i, c in enumerate(columns)
    ])))


def check_null_drift(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Only the columns that fail."""
    return null_share_gaps(df, columns, split).where(F.col("gap") > MAX_NULL_GAP).select(*_check(
        words.CHECK_NULL_DRIFT, F.col("column"), words.WARNING, F.col("gap"), MAX_NULL_GAP, "null shares differ between train and test",
    ))


def domain_auc(df: DataFrame, columns: Sequence[str], key: str, split: str = "split", folds: int = 3, seed: int = SEED) -> float | None:
    """Cross-validated exact AUC of a penalised logistic model that tells test rows from train rows.

    NULLs take the pooled exact median.  None when a side has too few rows.
    """
    sizes = df.agg(F.count_if(is_test(split)), F.count_if(~is_test(split))).first()
    if not columns or min(sizes) < MIN_TEST_ROWS:
        return None
    medians = {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}
    usable = [c for c in columns if medians[c] is not None]
    salt = f"domain{seed}"
    filled = df.select(
        is_test(split).cast("double").alias("label"), F.col(key).alias("_k"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) for c in usable],
    )
    labelled = filled.withColumn("_h", hash60(F.col("_k"), salt))
    limits = hash_cuts(labelled, "label", "_h", lambda n: [math.ceil(n * j / folds) for j in range(1, folds)])
    fold = F.lit(None).cast("int")
    for label, values in limits.items():
        place = reduce(lambda u, v: u + (F.col("_h") > F.lit(v)).cast("int"), values, F.lit(0))
        fold = F.when(F.col("label") == label, place).otherwise(fold)
    ready = materialised(labelled.select("label", fold.alias("fold"), *usable), "domain")
    counts = {r["fold"]: r["n"] for r in ready.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    total, assembler = sum(counts.values()), VectorAssembler(inputCols=usable, outputCol="features")
    vectors = assembler.transform(ready)

    def scored(f: int) -> DataFrame:
        # a penalty of half the squared weights against the summed loss
        learner = LogisticRegression(maxIter=1000, regParam=PENALTY / (total - counts[f]), elasticNetParam=0.0, standardization=False)
        model = learner.fit(vectors.where(F.col("fold") != f))
        weights = zip(usable, model.coefficients.toArray().tolist(), strict=True)
        margin = reduce(lambda u, v: u + v, [F.lit(w) * F.col(c) for c, w in weights])
        return ready.where(F.col("fold") == f).select("fold", "label", margin.alias("score"))

    parts = run_together(df.sparkSession, [lambda f=f: scored(f) for f in sorted(counts)])
    return rank_auc(reduce(DataFrame.unionAll, parts), "label", "score", "fold").agg(F.avg("auc")).first()[0]


def rank_auc(df: DataFrame, label: str, score: str, group: str) -> DataFrame:
    """(group, auc): the exact area under the ROC curve from rank sums; equal scores count half.

    Labels are 0 and 1.  Scores meet as counts, so it is exact for any number of them.
    """
    counts = df.groupBy(group, score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    ranked = running_counts(counts, [group], score, ["pos", "neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2))
    return ranked.groupBy(group).agg((won / F.first("all_pos") / F.first("all_neg")).alias("auc"))


def check_domain(df: DataFrame, columns: Sequence[str], key: str, split: str = "split", seed: int = SEED) -> DataFrame:
    auc = domain_auc(df, columns, key, split, seed=seed)
    if auc is None:
        line = (words.CHECK_DOMAIN, "", words.OK, None, None, "too few rows for the domain classifier")
    else:
        severity = words.OK if auc <= MAX_DOMAIN_AUC else words.WARNING
        line = (words.CHECK_DOMAIN, "", severity, float(auc), MAX_DOMAIN_AUC, "AUC of a classifier that tells test from train")
    return df.sparkSession.createDataFrame([line], CHECK_SCHEMA)


def split_report(
    df: DataFrame, key: str, target: str, predictors: Sequence[str], categorical: Sequence[str] = (),
    share: float = TEST_SHARE, split: str = "split", seed: int = SEED, domain: bool = True,
) -> DataFrame:
    """Every check in a fixed order, passes included."""
    numeric_types = ("double", "float", "int", "bigint", "smallint", "tinyint", "boolean")
    types = dict(df.dtypes)
    numeric = [c for c in predictors if types[c] in numeric_types or types[c].startswith("decimal")]
    shareable = [c for c in predictors if types[c] not in ("map", "variant")]
    # one table of value counts serves the target and every predictor
    drift = materialised(kolmogorov_smirnov(df, [target, *[c for c in numeric if c != target]], is_test(split)), "drift")
    checks = [
        check_keys(df, key, split), check_shared_rows(df, shareable, split), check_sizes(df, share, split),
        _target_drift(df, drift.where(F.col("column") == target), target, split),
        _column_drift(drift.where(F.col("column") != target).orderBy("column")),
    ]
    if categorical:
        checks.append(check_new_categories(df, categorical, split))
    checks.append(check_null_drift(df, predictors, split))
    if domain:
        checks.append(check_domain(df, numeric, key, split, seed))
    return reduce(DataFrame.unionByName, [c.select(*CHECK_COLUMNS) for c in checks])


def split_gate(report: DataFrame, strict: bool = False) -> DataFrame:
    """The report, or an error: leaks always stop a run, warnings only when strict.

    The caller writes the report first, so that a stopped run leaves its evidence.
    """
    bad = [words.ERROR, words.WARNING] if strict else [words.ERROR]
    rows = report.where(F.col("severidad").isin(bad)).select(
        F.col("chequeo").alias("regla"), "columna", "detalle", F.lit(0).cast("bigint").alias("filas_afectadas")
    ).collect()
    if rows:
        raise ContractError(rows, "the train/test split")
    return report
