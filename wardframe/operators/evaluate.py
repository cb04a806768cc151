"""Metrics, cross-validation, learning curves, verdicts and error breakdowns."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe import vocabulary as words
from wardframe.functions.cleaning import to_double
from wardframe.functions.hashing import HASH_RANGE, hash60, hash_fold
from wardframe.operators.foldmoments import FoldMoments
from wardframe.operators.foldranks import FoldRanks, line_fits
from wardframe.operators.models import Fit, LinearFit, TreeFit
from wardframe.operators.prep import ColumnPrep
from wardframe.operators.ranks import (
    exact_quantiles,
    group_number,
    quantile_group_ranks,
    rank_correlation,
    rank_cuts,
    rank_pairs,
)
from wardframe.operators.split import repeated_kfold, stratified_kfold, time_series_folds
from wardframe.session import run_together
from wardframe.sources.scratch import materialised

METRICS = ("MAE", "RMSE", "R2", "MAPE", "spearman")

# Limits of the generalisation verdicts, the learning curve and the weak segments.
OVERFIT = 0.50
OVERFIT_MILD = 0.20
UNDERFIT_R2 = 0.50
UNSTABLE = 0.25
DEGRADED = 0.10
WEAK_FACTOR = 1.5
CURVE_SHARES = (0.1, 0.25, 0.4, 0.55, 0.7, 0.85, 1.0)
EPSILON = 2.220446049250313e-16

# Names of the cross-validation schemes and of the reference model in reports.
SCHEMES = ("kfold", "repetido", "estratificado", "series_temporales")
REFERENCE_MODEL = "dummy"


# --- metrics ------------------------------------------------------------------------------


def regression_metrics(
    df: DataFrame, target: str, prediction: str = "prediction", by: Sequence[str] = (), ranks: bool = True, weight: str | None = None,
) -> DataFrame:
    """(by..., n, MAE, RMSE, R2, MAPE, spearman) over rows where both values are known.

    Spearman is NULL for a constant prediction.  With ranks, every metric comes from the one
    written table of (target, prediction) pairs, so the model scores each row once; ``weight`` names the
    rows that a pair stands for.
    """
    if not ranks:
        y, p = F.col(target), F.col(prediction)
        return df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
            F.count("*").alias("n"), F.avg(F.abs(y - p)).alias("MAE"), F.sqrt(F.avg((y - p) * (y - p))).alias("RMSE"),
            (1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("R2"),
            F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON))).alias("MAPE"),
        )
    ranked = rank_pairs(df, F.col(target), F.col(prediction), by, weight=weight)
    keys = list(by) or ["_all"]
    error, w = F.col("_x") - F.col("_y"), F.col("cnt")
    sums = ranked.groupBy(*keys).agg(
        F.sum("cnt").alias("n"), F.sum(w * F.abs(error)).alias("_abs"), F.sum(w * error * error).alias("_sq"),
        F.sum(w * F.abs(error) / F.greatest(F.abs(F.col("_x")), F.lit(EPSILON))).alias("_rel"),
        F.sum(w * (F.col("_x") - F.col("_mx")) * (F.col("_x") - F.col("_mx"))).alias("_spread"),
        rank_correlation().alias("spearman"),
    )
    n = F.col("n")
    return sums.select(
        *by, "n", (F.col("_abs") / n).alias("MAE"), F.sqrt(F.col("_sq") / n).alias("RMSE"),
        (1 - F.try_divide(F.col("_sq"), F.col("_spread"))).alias("R2"), (F.col("_rel") / n).alias("MAPE"), "spearman",
    )


def metric_report(metrics: DataFrame, reference: str = REFERENCE_MODEL) -> DataFrame:
    """Add the improvement over the reference row in percent and sort by MAE.

    The few rows of metrics are written first: the reference and the report both read them.
    """
    metrics = materialised(metrics, "metrics")
    base = metrics.where(F.col("modelo") == reference).agg(F.first("MAE")).scalar()
    return metrics.withColumn("mejora_vs_dummy_pct", 100 * (base - F.col("MAE")) / base).orderBy("MAE")


# --- folds --------------------------------------------------------------------------------


def fold_rows(
    df: DataFrame, scheme: str, key: str, target: str, folds: int = 5, repeats: int = 5, seed: int = 42,
    time: str | None = None,
) -> DataFrame:
    """Rows with (repeticion, fold): the fold in which the row is validated.

    ``series_temporales`` numbers the opening block -1; a fold trains on smaller numbers only.
    """
    if scheme == "kfold":
        return repeated_kfold(df, key, folds, 1, seed)
    if scheme == "repetido":
        return repeated_kfold(df, key, folds, repeats, seed)
    if scheme == "estratificado":
        return stratified_kfold(df, key, target, folds, seed=seed).drop("grupo").withColumn("repeticion", F.lit(1))
    if scheme == "series_temporales":
        return time_series_folds(df, time, key, folds).withColumn("fold", F.col("bloque") - 1).drop("bloque").withColumn("repeticion", F.lit(1))
    raise ValueError(f"unknown scheme {scheme}; available: {list(SCHEMES)}")


def fold_moments(
    df: DataFrame, fits: Mapping[str, LinearFit], scheme: str, key: str, target: str, folds: int = 5, repeats: int = 5, seed: int = 42,
    time: str | None = None, shares: Sequence[float] = (1.0,),
) -> FoldMoments:
    """The moments of linear fits over the folds of a scheme."""
    if scheme == "series_temporales" and time is None:
        raise ValueError("series_temporales needs the column that orders the rows")
    return FoldMoments(
        df, fits, lambda base: fold_rows(base, scheme, "_key", "_y", folds, repeats, seed, "_time"), repeats if scheme == "repetido" else 1, folds,
        target, key, scheme == "series_temporales", time, shares, seed, scheme in ("kfold", "repetido"))


def fit_each(fit: Fit, trains: Sequence[DataFrame]) -> list[Model]:
    """Fit on every training set; the fits are independent jobs, so a few run at a time."""
    return run_together(trains[0].sparkSession, [lambda train=train: fit(train) for train in trains]) if trains else []


def fold_predictions(
    df: DataFrame, fit: Fit, scheme: str, key: str, target: str, folds: int = 5, repeats: int = 5, seed: int = 42,
    time: str | None = None,
) -> DataFrame:
    """(repeticion, fold, rol, y, prediction) with the whole pipeline refitted for every fold.

    A linear fit is not refitted: all its training sets are solved from one pass of moments.
    """
    if isinstance(fit, LinearFit):
        return fold_moments(df, {"": fit}, scheme, key, target, folds, repeats, seed, time).predictions().drop("variante", "talla")
    rows = fold_rows(df, scheme, key, target, folds, repeats, seed, time)
    past_only = scheme == "series_temporales"
    labels = [(r, f) for r in range(1, (repeats if scheme == "repetido" else 1) + 1) for f in range(folds)]
    number, same = F.col("fold"), F.col("repeticion")
    trains = [rows.where((same == r) & ((number < f) if past_only else (number != f))).drop("fold", "repeticion") for r, f in labels]
    frames = []
    for (r, f), model in zip(labels, fit_each(fit, trains), strict=True):
        seen = rows.where((same == r) & ((number <= f) if past_only else F.lit(True)))
        frames.append(model.transform(seen).select(
            F.lit(r).alias("repeticion"), F.lit(f).alias("fold"),
            F.when(number == f, F.lit("validacion")).otherwise(F.lit("entrenamiento")).alias("rol"),
            F.col(target).cast("double").alias("y"), F.col("prediction").cast("double").alias("prediction"),
        ))
    return reduce(DataFrame.unionAll, frames)


def cross_validated_mae(df: DataFrame, fit: Fit, target: str, key: str | None, folds: int = 5, seed: int = 42) -> float:
    if key is None:
        df, key = df.withColumn("_rowkey", F.xxhash64(*df.columns)), "_rowkey"
    scored = fold_predictions(df, fit, "kfold", key, target, folds, 1, seed).where("rol = 'validacion'")
    by_fold = regression_metrics(scored, "y", by=["fold"], ranks=False)
    return by_fold.agg(F.avg("MAE")).first()[0]


def cross_validated_maes(df: DataFrame, fits: Sequence[Fit], target: str, key: str | None, folds: int = 5, seed: int = 42) -> list[float]:
    """``cross_validated_mae`` of several fits on the same folds.

    All linear fits share one pass of moments, and all tree fits of one plan the preparation of each training set.
    """
    if key is None:
        df, key = df.withColumn("_rowkey", F.xxhash64(*df.columns)), "_rowkey"
    found: dict[int, float] = {}
    linear = {str(i): fit for i, fit in enumerate(fits) if isinstance(fit, LinearFit)}
    if linear:
        errors = fold_moments(df, linear, "kfold", key, target, folds, 1, seed).errors()
        found = {int(r[0]): r[1] for r in errors.groupBy("variante").agg(F.avg(F.col("s") / F.col("n"))).collect()}  # one row per fit
    trees = [i for i, fit in enumerate(fits) if isinstance(fit, TreeFit)]
    if trees:
        rows = materialised(fold_rows(df, "kfold", key, target, folds, 1, seed).drop("repeticion"), "folds")
        trains = [rows.where(F.col("fold") != f).drop("fold") for f in range(folds)]
        preps: dict[str, list[Model]] = {}
        for i in trees:
            plan = ColumnPrep.of(fits[i].plan)
            name = plan.getOrDefault(plan.plan)
            if name not in preps:
                preps[name] = fit_each(plan.fit, trains)
            models = run_together(df.sparkSession, [lambda t=t, p=p, i=i: fits[i](t, p) for t, p in zip(trains, preps[name], strict=True)])
            scored = reduce(DataFrame.unionAll, [
                model.transform(rows.where(F.col("fold") == f)).select("fold", F.col(target).cast("double").alias("y"), "prediction") for f, model in enumerate(models)])
            found[i] = regression_metrics(scored, "y", by=["fold"], ranks=False).agg(F.avg("MAE")).first()[0]
    return [found[i] if i in found else cross_validated_mae(df, fit, target, key, folds, seed) for i, fit in enumerate(fits)]


def fold_scores(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """(repeticion, fold, rol, n, MAE, RMSE, R2, MAPE, spearman)."""
    return regression_metrics(predictions, "y", by=["repeticion", "fold", "rol"], weight=weight)


def summarise_folds(
    scores: DataFrame, scheme: str = "repetido", folds: int = 5, repeats: int = 5, seed: int = 42
) -> DataFrame:
    """One row per metric: train and validation mean, population deviation over folds, gap."""
    long = scores.select("rol", F.inline(F.array(*[
        F.struct(F.lit(i).alias("_o"), F.lit(m).alias("metrica"), F.nanvl(F.col(m), F.lit(None)).alias("valor")) for i, m in enumerate(METRICS)
    ])))
    train = F.when(F.col("rol") == "entrenamiento", F.col("valor"))
    valid = F.when(F.col("rol") == "validacion", F.col("valor"))
    return long.groupBy("_o", "metrica").agg(
        F.avg(train).alias("entrenamiento"), F.avg(valid).alias("validacion_cruzada"), F.stddev_pop(valid).alias("desviacion_cv"),
    ).orderBy("_o").select(
        "metrica", "entrenamiento", "validacion_cruzada", "desviacion_cv",
        (F.col("validacion_cruzada") - F.col("entrenamiento")).alias("brecha_train_cv"),
        F.lit(scheme).alias("validador"), F.lit(folds).alias("pliegues"),
        F.lit(repeats if scheme == "repetido" else 1).alias("repeticiones"), F.lit(seed).alias("semilla"),
    )


def cross_validate(
    df: DataFrame, fit: Fit, target: str, key: str, scheme: str = "repetido", folds: int = 5, repeats: int = 5,
    seed: int = 42, time: str | None = None,
) -> DataFrame:
    if isinstance(fit, LinearFit):
        moments = fold_moments(df, {"": fit}, scheme, key, target, folds, repeats, seed, time)
        scores = moments.scores() if scheme in ("kfold", "repetido") else fold_scores(moments.counts(), "n")
        return summarise_folds(scores, scheme, folds, repeats, seed)
    predictions = fold_predictions(df, fit, scheme, key, target, folds, repeats, seed, time)
    return summarise_folds(fold_scores(predictions), scheme, folds, repeats, seed)


# --- one-pass cross-validation of straight lines ------------------------------------------


def line_fold_predictions(
    df: DataFrame, key: str, target: str, score: Column | None, folds: int = 5, repeats: int = 5, seed: int = 42,
    clip: bool = False,
) -> DataFrame:
    """``fold_predictions`` for y = a + b * score (or y = mean when ``score`` is None).

    All repeats and folds are fitted from one aggregation: the sums of a training set are the
    totals minus the sums of its validation fold.
    """
    x = F.lit(0.0) if score is None else score
    base = df.select(F.col(key).alias("_k"), F.col(target).cast("double").alias("y"), x.alias("x")).where(
        "y is not null and x is not null"
    )
    centre = base.agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    cx, cy = centre.select("cx").scalar(), centre.select("cy").scalar()
    shifted = base.select("_k", "y", "x", (F.col("x") - cx).alias("u"), (F.col("y") - cy).alias("v"))
    rows = repeated_kfold(shifted, "_k", folds, repeats, seed)
    sums = rows.groupBy("repeticion", "fold").agg(
        F.count("*").alias("n"), F.sum("u").alias("su"), F.sum("v").alias("sv"),
        F.sum(F.col("u") * F.col("u")).alias("suu"), F.sum(F.col("u") * F.col("v")).alias("suv"),
    )
    everything = Window.partitionBy("repeticion")
    rest = sums.select("repeticion", "fold", *[(F.sum(c).over(everything) - F.col(c)).alias(c) for c in ("n", "su", "sv", "suu", "suv")])
    spread = F.col("suu") - F.col("su") * F.col("su") / F.col("n")
    slope = F.lit(0.0) if score is None else F.coalesce(F.try_divide(F.col("suv") - F.col("su") * F.col("sv") / F.col("n"), spread), F.lit(0.0))
    lines = rest.select(
        "repeticion", F.col("fold").alias("modelo_fold"), slope.alias("b"),
        ((F.col("sv") - slope * F.col("su")) / F.col("n")).alias("a"),
    )  # folds x repeats rows
    scored = rows.join(F.broadcast(lines), "repeticion")
    value = cy + F.col("a") + F.col("b") * F.col("u")
    return scored.select(
        "repeticion", F.col("modelo_fold").alias("fold"),
        F.when(F.col("fold") == F.col("modelo_fold"), F.lit("validacion")).otherwise(F.lit("entrenamiento")).alias("rol"),
        "y", (F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)) if clip else value).alias("prediction"),
    )


def line_fold_counts(
    df: DataFrame, key: str, target: str, score: Column | None, folds: int = 5, repeats: int = 5, seed: int = 42,
    clip: bool = False,
) -> DataFrame:
    """``line_fold_predictions`` with ``n``, the rows that a line stands for.

    Rows of one target and score are predicted alike by every line, so they are counted per repeat and fold before
    they meet the lines, and no row is copied for a line that may see it.
    """
    x = F.lit(0.0) if score is None else score
    base = df.select(F.col(key).alias("_k"), F.col(target).cast("double").alias("y"), x.alias("x")).where(
        "y is not null and x is not null"
    )
    # rows of each fold, and last of those without one (their key is unknown), for every repeat
    places = [hash_fold(F.col("_k"), folds, f"fold{seed}r{r}").alias(f"_f{r}") for r in range(1, repeats + 1)]
    counts = [F.array(*[F.count_if(F.col(f"_f{r}").eqNullSafe(F.lit(f))) for f in (*range(folds), None)]) for r in range(1, repeats + 1)]
    pairs = materialised(base.select("y", "x", *places).groupBy("y", "x").agg(F.array(*counts).alias("counts")), "folds")
    size = F.aggregate(F.flatten("counts"), F.lit(0).cast("long"), lambda u, v: u + v) / repeats
    centre = pairs.select("y", "x", size.alias("n")).agg(
        (F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("cx"), (F.sum(F.col("n") * F.col("y")) / F.sum("n")).alias("cy")).first()
    cx, cy = F.lit(centre["cx"]).cast("double"), F.lit(centre["cy"]).cast("double")
    shifted = pairs.select("y", (F.col("x") - cx).alias("u"), (F.col("y") - cy).alias("v"), "counts")
    rows = shifted.select("y", "u", "v", F.posexplode("counts").alias("_r", "held")).withColumn("repeticion", F.col("_r") + 1).drop("_r")
    blocks = rows.select("repeticion", "u", "v", F.posexplode("held").alias("at", "n")).where("n > 0")
    sums = blocks.groupBy("repeticion", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("u")).alias("su"), F.sum(F.col("n") * F.col("v")).alias("sv"),
        F.sum(F.col("n") * F.col("u") * F.col("u")).alias("suu"), F.sum(F.col("n") * F.col("u") * F.col("v")).alias("suv"),
    )
    everything = Window.partitionBy("repeticion")
    rest = sums.select("repeticion", "at", *[(F.sum(c).over(everything) - F.col(c)).alias(c) for c in ("n", "su", "sv", "suu", "suv")])
    spread = F.col("suu") - F.col("su") * F.col("su") / F.col("n")
    slope = F.lit(0.0) if score is None else F.coalesce(F.try_divide(F.col("suv") - F.col("su") * F.col("sv") / F.col("n"), spread), F.lit(0.0))
    lines = rest.select("repeticion", "at", slope.alias("b"), ((F.col("sv") - slope * F.col("su")) / F.col("n")).alias("a"))  # folds x repeats rows
    value = cy + F.col("a") + F.col("b") * F.col("u")
    own = F.when(F.col("at") < folds, F.element_at("held", F.col("at") + 1)).otherwise(F.lit(0).cast("long"))
    rest_of = F.aggregate("held", F.lit(0).cast("long"), lambda u, v: u + v) - own
    return rows.join(F.broadcast(lines), "repeticion").select(
        "repeticion", F.when(F.col("at") < folds, F.col("at")).alias("fold"), "y",
        (F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)) if clip else value).alias("prediction"),
        F.inline(F.array(F.struct(F.lit("validacion").alias("rol"), own.alias("n")), F.struct(F.lit("entrenamiento").alias("rol"), rest_of.alias("n")))),
    ).where("n > 0").select("repeticion", "fold", "rol", "y", "prediction", "n")


def line_fold_scores(
    df: DataFrame, key: str, target: str, score: Column | None, folds: int = 5, repeats: int = 5, seed: int = 42,
    clip: bool = False, digits: int | None = None,
) -> DataFrame:
    """``fold_scores`` of ``line_fold_predictions``, rounded to ``digits``: the same rows under the same lines and metrics,
    ranked without a written row per line."""
    x = F.lit(0.0) if score is None else score
    base = df.select(F.col(key).alias("_k"), F.col(target).cast("double").alias("y"), x.cast("double").alias("x")).where("y is not null and x is not null")
    ranks = FoldRanks(base, "y", ["x"], "_k", folds, repeats, seed)
    lines = line_fits(ranks, score is not None)

    def predict(columns: np.ndarray, repeat: int, fold: int) -> np.ndarray:
        cx, cy, a, b = lines[repeat, fold]
        value = cy + a + b * (columns[0] - cx)
        value = np.clip(value, 0.0, 1.0) if clip else value
        return value if digits is None else np.round(value, digits)

    return ranks.scores(predict)


def line_learning_curve(
    df: DataFrame, key: str, target: str, score: Column | None, folds: int = 5, seed: int = 42,
    shares: Sequence[float] = CURVE_SHARES, clip: bool = False,
) -> DataFrame:
    """Learning curve of a straight line (or of the mean) in one aggregation and one scoring pass.

    Training sets are nested: a row joins a training set when its hash falls below the share.
    """
    x = F.lit(0.0) if score is None else score
    fine = F.lit(len(shares))
    draw = hash60(F.col(key), f"curve{seed}")
    for i in reversed(range(len(shares))):
        fine = F.when(draw < F.lit(int(shares[i] * HASH_RANGE)), F.lit(i)).otherwise(fine)
    base = df.select(F.col(key).alias("_k"), F.col(target).cast("double").alias("y"), x.alias("x")).where("y is not null and x is not null")
    centre = base.agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    cx, cy = centre.select("cx").scalar(), centre.select("cy").scalar()
    rows = df.select(
        hash_fold(F.col(key), folds, f"fold{seed}r1").alias("fold"), fine.alias("paso"),
        (F.col(target).cast("double") - cy).alias("y"), (x - cx).alias("x"),
    ).where("y is not null and x is not null")
    sums = rows.groupBy("fold", "paso").agg(
        F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"),
    )
    combos = sums.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("modelo_fold")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))).alias("talla"))
    train = combos.where((F.col("fold") != F.col("modelo_fold")) & (F.col("paso") <= F.col("talla"))).groupBy(
        "modelo_fold", "talla"
    ).agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.lit(0.0) if score is None else F.coalesce(
        F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), spread), F.lit(0.0)
    )
    lines = train.select("modelo_fold", "talla", slope.alias("b"), ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("a"))
    packed = lines.agg(F.collect_list(F.struct("modelo_fold", "talla", "a", "b")))  # folds x shares entries
    value = F.col("a") + F.col("b") * F.col("x")
    scored = rows.select("*", F.inline(packed.scalar())).withColumn(
        "error", F.abs(F.col("y") - (F.greatest(F.lit(0.0), F.least(F.lit(1.0), cy + value)) - cy if clip else value))
    )
    in_train = (F.col("fold") != F.col("modelo_fold")) & (F.col("paso") <= F.col("talla"))
    in_valid = F.col("fold") == F.col("modelo_fold")
    per_fold = scored.groupBy("modelo_fold", "talla").agg(
        F.count_if(in_train).alias("n"), F.avg(F.when(in_train, F.col("error"))).alias("tr"), F.avg(F.when(in_valid, F.col("error"))).alias("va"),
    )
    return _curve(per_fold, shares)


def _curve(per_fold: DataFrame, shares: Sequence[float]) -> DataFrame:
    share = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), F.col("talla") + 1)
    return per_fold.groupBy("talla").agg(
        F.avg("n").cast("bigint").alias("muestras_entrenamiento"), F.avg("tr").alias("MAE_entrenamiento"),
        F.avg("va").alias("MAE_validacion"), F.stddev_pop("va").alias("desviacion_validacion"),
    ).orderBy("talla").select(share.alias("proporcion"), "muestras_entrenamiento", "MAE_entrenamiento", "MAE_validacion", "desviacion_validacion")


def learning_curve(
    df: DataFrame, fit: Fit, target: str, key: str, folds: int = 5, seed: int = 42, shares: Sequence[float] = CURVE_SHARES,
    scheme: str = "kfold", time: str | None = None,
) -> DataFrame:
    """Learning curve of any model, with the folds of the scheme (not repeated) and nested training sets.

    Under ``series_temporales`` every training set lies before its validation block.
    """
    scheme = "kfold" if scheme == "repetido" else scheme
    if isinstance(fit, LinearFit):
        scored = fold_moments(df, {"": fit}, scheme, key, target, folds, 1, seed, time, shares).counts().where("y is not null")
        error, valid = F.col("n") * F.abs(F.col("y") - F.col("prediction")), F.col("rol") == "validacion"
        size = lambda part: F.sum(F.when(part, F.col("n")).otherwise(0))
        return _curve(scored.groupBy(F.col("fold").alias("modelo_fold"), "talla").agg(
            size(~valid).alias("n"), F.try_divide(F.sum(F.when(~valid, error)), size(~valid)).alias("tr"),
            F.try_divide(F.sum(F.when(valid, error)), size(valid)).alias("va")), shares)
    if scheme == "series_temporales" and time is None:
        raise ValueError("series_temporales needs the column that orders the rows")
    rows = fold_rows(df, scheme, key, target, folds, 1, seed, time).drop("repeticion").withColumn("_draw", hash60(F.col(key), f"curve{seed}"))
    labels = [(f, i) for f in range(folds) for i in range(len(shares))]
    seen = (lambda f: F.col("fold") < f) if scheme == "series_temporales" else (lambda f: F.col("fold") != f)
    chosen = {(f, i): seen(f) & (F.col("_draw") < int(shares[i] * HASH_RANGE)) for f, i in labels}
    fitted = fit_each(fit, [rows.where(chosen[label]).drop("fold", "_draw") for label in labels])
    error, frames = F.abs(F.col(target) - F.col("prediction")), []
    for (f, i), model in zip(labels, fitted, strict=True):
        train = chosen[f, i]
        frames.append(model.transform(rows.where(train | (F.col("fold") == f))).agg(
            F.count_if(train).alias("n"), F.avg(F.when(train, error)).alias("tr"), F.avg(F.when(F.col("fold") == f, error)).alias("va"),
        ).select(F.lit(f).alias("modelo_fold"), F.lit(i).alias("talla"), "n", "tr", "va"))
    return _curve(reduce(DataFrame.unionAll, frames), shares)


# --- generalisation -----------------------------------------------------------------------


def long_metrics(metrics: DataFrame) -> DataFrame:
    """(metrica, valor) from a one-row metric table."""
    return metrics.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metrica"), F.col(m).alias("valor")) for m in METRICS if m in metrics.columns])))


def compare_scenarios(validation: DataFrame, test_metrics: DataFrame) -> DataFrame:
    """Train, cross-validation and test side by side; ``test_metrics`` is (metrica, valor)."""
    held_out = F.broadcast(test_metrics.select("metrica", F.col("valor").alias("prueba")))  # one row per metric
    return validation.join(held_out, "metrica", "left").withColumn("diferencia_cv_prueba", F.col("prueba") - F.col("validacion_cruzada"))


def validation_summary(comparison: DataFrame) -> DataFrame:
    """The MAE figures that travel with a model."""
    return comparison.where("metrica = 'MAE'").select(
        F.col("validacion_cruzada").alias("MAE_cv"), F.col("desviacion_cv").alias("MAE_cv_desv"),
        F.col("entrenamiento").alias("MAE_entrenamiento"), "brecha_train_cv",
    )


@dataclass(frozen=True)
class Aspect:
    """One question about a model: a figure and what it means from each limit on, worst first."""

    name: str
    figure: Callable[[Mapping[str, Column]], Column]
    limits: tuple[tuple[float, str, str], ...]  # at least, verdict, advice
    otherwise: str
    shown: tuple[str, ...]


def _above(limit: float) -> float:
    """The least figure over a limit that is itself allowed."""
    return math.nextafter(limit, math.inf)


# Aspects and verdicts.
ASPECTS = (
    Aspect("sobreajuste", lambda f: F.try_divide(f["cv"] - f["train"], f["cv"]), (
        (OVERFIT, "sobreajuste", "training error says little here: simplify the model before using it"),
        (OVERFIT_MILD, "sobreajuste leve", "usable if validation still beats the reference by far; look again after each change")),
        "ajuste adecuado", ("train", "cv")),
    Aspect("subajuste", lambda f: UNDERFIT_R2 - f["r2"], ((_above(0.0), "subajuste", "most of the target is unexplained: add information or let the model bend"),), "capacidad suficiente", ("r2",)),
    Aspect("estabilidad", lambda f: F.try_divide(f["spread"], f["cv"]), ((_above(UNSTABLE), "inestable", "the folds disagree: a single figure is no basis for a choice"),), "estable", ("spread", "cv")),
    Aspect("degradacion_cv_prueba", lambda f: F.try_divide(F.abs(f["test"] - f["cv"]), f["cv"]), (
        (_above(DEGRADED), "la prueba no confirma la validacion", "trust the validation figure and redraw the split to see whether it lasts"),), "coherente", ("cv", "test")),
)
_FIGURES = {"train": ("MAE", "entrenamiento"), "cv": ("MAE", "validacion_cruzada"), "test": ("MAE", "prueba"), "spread": ("MAE", "desviacion_cv"), "r2": ("R2", "validacion_cruzada")}


def diagnose(comparison: DataFrame) -> DataFrame:
    """(aspecto, veredicto, evidencia, accion_recomendada): does it memorise, learn, hold steady and
    does the test confirm it?  Missing or zero figures never produce an alarm."""
    line = comparison.agg(*[F.nanvl(F.max(F.when(F.col("metrica") == metric, F.col(c))), F.lit(None)).alias(name) for name, (metric, c) in _FIGURES.items()])
    figures = {name: F.col(name) for name in _FIGURES}

    def entry(aspect: Aspect) -> Column:
        value, verdict, advice = aspect.figure(figures), F.lit(aspect.otherwise), F.lit("none")
        for limit, name, text in reversed(aspect.limits):
            verdict, advice = F.when(value >= limit, F.lit(name)).otherwise(verdict), F.when(value >= limit, F.lit(text)).otherwise(advice)
        evidence = F.concat_ws(", ", *[F.concat(F.lit(f"{n} "), F.coalesce(F.format_number(figures[n], 4), F.lit("unknown"))) for n in aspect.shown])
        return F.struct(F.lit(aspect.name).alias("aspecto"), verdict.alias("veredicto"), evidence.alias("evidencia"), advice.alias("accion_recomendada"))

    return line.select(F.inline(F.array(*map(entry, ASPECTS))))


# --- error breakdowns ---------------------------------------------------------------------


def weak_segments(
    df: DataFrame, columns: Sequence[str], target: str, key: str, prediction: str = "prediction", groups: int = 3
) -> DataFrame:
    """MAE per tercile of first-come rank of each attribute, against the global MAE."""
    error, types = F.abs(F.col(target) - F.col(prediction)), dict(df.dtypes)
    values = {c: to_double(F.col(c), types[c]) for c in columns}
    cells = F.array(*[
        F.struct(F.lit(c).alias("atributo"), values[c].alias("value"), F.col(key).alias("tie")) for c in columns
    ])
    long = df.select(F.inline(cells)).where("value is not null")
    cuts = rank_cuts(long, "atributo", "value", "tie", quantile_group_ranks(groups))
    ranges = df.agg(*[(F.min(values[c]) < F.max(values[c])).alias(c) for c in columns]).first()
    usable = [c for c in columns if ranges[c]]
    schema = "atributo string, segmento string, n bigint, MAE double, MAE_global double, razon_vs_global double, debil boolean"
    if not usable:
        return df.sparkSession.createDataFrame([], schema)
    entries = F.array(*[
        F.struct(F.lit(c).alias("atributo"), F.when(
            values[c].isNotNull(), group_number(cuts[c], values[c], F.col(key)) + 1
        ).alias("g")) for c in usable
    ])
    overall = df.agg(F.avg(error)).scalar()
    table = df.select(error.alias("e"), F.inline(entries)).where("g is not null").groupBy("atributo", "g").agg(
        F.count("*").alias("n"), F.avg("e").alias("MAE")
    )
    return table.select(
        "atributo", F.concat(F.lit("tercio "), F.col("g").cast("string")).alias("segmento"), "n", "MAE",
        overall.alias("MAE_global"), F.try_divide(F.col("MAE"), overall).alias("razon_vs_global"),
        (F.col("MAE") > WEAK_FACTOR * overall).alias("debil"),
    ).orderBy(F.desc("MAE"), "atributo", "segmento")


def tercile_edges(train: DataFrame, target: str) -> tuple[float, float]:
    low, high = exact_quantiles(train, [target], [1 / 3, 2 / 3])[target]
    return low, high


def notebook_basket(value: Column, edges: tuple[float, float]) -> Column:
    """Right-closed cuts (lo, hi]; batch scoring uses left-closed cuts instead."""
    low, high, top = words.BASKETS
    return F.when(value <= edges[0], F.lit(low)).when(value <= edges[1], F.lit(high)).when(value.isNotNull(), F.lit(top))


def basket_confusion(df: DataFrame, edges: tuple[float, float], target: str, prediction: str = "prediction") -> DataFrame:
    """(real, ambiciosa, probable, segura): counts by real and predicted basket."""
    labelled = df.select(notebook_basket(F.col(target), edges).alias("real"), notebook_basket(F.col(prediction), edges).alias("p"))
    return labelled.where("real is not null").groupBy("real").agg(*[F.count_if(F.col("p") == b).alias(b) for b in words.BASKETS])


def basket_accuracy(df: DataFrame, edges: tuple[float, float], target: str, prediction: str = "prediction") -> DataFrame:
    """(n, acierto, graves_optimistas, graves_pesimistas)."""
    real, guess = notebook_basket(F.col(target), edges), notebook_basket(F.col(prediction), edges)
    low, _, top = words.BASKETS
    return df.agg(
        F.count("*").alias("n"), F.avg(F.coalesce(real == guess, F.lit(False)).cast("double")).alias("acierto"),
        F.count_if((real == low) & (guess == top)).alias("graves_optimistas"),
        F.count_if((real == top) & (guess == low)).alias("graves_pesimistas"),
    )


def bias_by_tercile(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """(tercil, n, MAE, sesgo_medio) by value terciles of the target; positive bias = too low."""
    edges = tercile_edges(df, target)
    y, p = F.col(target), F.col(prediction)
    # Names of the target terciles.
    name = F.when(y <= edges[0], F.lit("target bajo")).when(y <= edges[1], F.lit("target medio")).when(y.isNotNull(), F.lit("target alto"))
    return df.where(y.isNotNull()).groupBy(name.alias("tercil")).agg(
        F.count("*").alias("n"), F.avg(F.abs(y - p)).alias("MAE"), F.avg(y - p).alias("sesgo_medio")
    )


def error_by_segment(
    df: DataFrame, predictors: Sequence[str], levels: Sequence[str], target: str, prediction: str = "prediction"
) -> DataFrame:
    """(segmento, grupo, n, MAE): rows with a missing predictor, and every level of every column.

    One scan and one grouping for all segmentations.
    """
    error = F.abs(F.col(target) - F.col(prediction))
    missing = reduce(lambda u, v: u | v, [F.col(c).isNull() for c in predictors])
    # Names of the missing-data groups.
    entries = [F.struct(
        F.lit("datos faltantes").alias("segmento"),
        F.when(missing, F.lit("con algún dato imputado")).otherwise(F.lit("sin datos faltantes")).alias("grupo"),
    )]
    entries += [
        F.struct(F.lit(c).alias("segmento"), F.coalesce(F.col(c).cast("string"), F.lit(words.MISSING_LEVEL)).alias("grupo")) for c in levels
    ]
    return df.select(error.alias("e"), F.inline(F.array(*entries))).groupBy("segmento", "grupo").agg(
        F.count("*").alias("n"), F.avg("e").alias("MAE")
    )


def direction_of_error(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """Share of optimistic predictions, mean error on each side and both ranges."""
    y, p = F.col(target), F.col(prediction)
    return df.agg(
        F.avg((p > y).cast("double")).alias("proporcion_optimista"), F.avg(F.when(p > y, p - y)).alias("error_sobrestima"),
        F.avg(F.when(p <= y, y - p)).alias("error_subestima"), F.min(y).alias("real_min"), F.max(y).alias("real_max"),
        F.min(p).alias("pred_min"), F.max(p).alias("pred_max"),
    )


# Edges of the target histogram and its low tail.
HISTOGRAM_EDGES = (0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LOW_TAIL = 0.5


def target_histogram(df: DataFrame, target: str, edges: Sequence[float] = HISTOGRAM_EDGES) -> DataFrame:
    """(bin, desde, hasta, n) for bins (a, b], empty bins included; one aggregation."""
    y = F.col(target)
    bins = list(zip(edges[:-1], edges[1:], strict=True))
    line = df.agg(*[F.count_if((y > a) & (y <= b)).alias(f"b{i}") for i, (a, b) in enumerate(bins)])
    return line.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("bin"), F.lit(float(a)).alias("desde"), F.lit(float(b)).alias("hasta"), F.col(f"b{i}").alias("n"))
        for i, (a, b) in enumerate(bins)
    ])))


def low_tail_share(df: DataFrame, target: str, limit: float = LOW_TAIL) -> DataFrame:
    return df.agg(F.count_if(F.col(target) < limit).alias("n"), F.avg((F.col(target) < limit).cast("double")).alias("proporcion"))


def indicator_summary(indicators: Mapping[str, DataFrame]) -> DataFrame:
    """(indicador, valor) from one-cell frames."""
    parts = [d.select(F.lit(name).alias("indicador"), F.col(d.columns[0]).cast("double").alias("valor")) for name, d in indicators.items()]
    return reduce(DataFrame.unionAll, parts)


def compare_variants(
    fits: Mapping[str, Fit], df: DataFrame, target: str, key: str, folds: int = 5, repeats: int = 5, seed: int = 42
) -> DataFrame:
    """(variante, MAE, desviacion): validation MAE of each variant on the same repeated folds, ascending.

    All linear variants share one pass of moments and one scoring pass.
    """
    linear = {name: fit for name, fit in fits.items() if isinstance(fit, LinearFit)}
    cells = ["variante", "repeticion", "fold"]
    parts = [
        fold_predictions(df, fit, "repetido", key, target, folds, repeats, seed).where("rol = 'validacion' and y is not null and prediction is not null")
        .withColumn("variante", F.lit(name)).groupBy(*cells).agg(F.sum(F.abs(F.col("y") - F.col("prediction"))).alias("s"), F.count("*").alias("n"))
        for name, fit in fits.items() if name not in linear
    ]
    if linear:
        parts.append(fold_moments(df, linear, "repetido", key, target, folds, repeats, seed).errors().drop("talla"))
    scores = reduce(DataFrame.unionByName, parts).withColumn("MAE", F.col("s") / F.col("n"))
    return scores.groupBy("variante").agg(F.avg("MAE").alias("MAE"), F.stddev_pop("MAE").alias("desviacion")).orderBy("MAE")
