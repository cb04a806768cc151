"""Batch scoring: baskets, reference ranges, warnings and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardframe import vocabulary as words
from wardframe.functions.cleaning import NULL_SENTINELS, text_to_double
from wardframe.operators.clean import Typing, context_columns, normalise_names, typed_or_error, unify_nulls
from wardframe.operators.contracts import Contract, gate
from wardframe.sources.tabular import path_exists, read_parquet

# Basket cuts, warning limit and the fall-back figures of the served model.
BASKET_CUTS = (0.67, 0.79)
LOW_RANGE = 0.55
FALLBACK_MAE = 0.0467
FALLBACK_MIN_PREDICTION = 0.4066

# Columns added to every scored row.
OUTPUT_COLUMNS = ("prediccion", "cesta", "limite_inferior", "limite_superior", "advertencia")


def basket(prediction: Column, cuts: tuple[float, float] = BASKET_CUTS) -> Column:
    """Left-closed cuts: below the first, below the second, the rest."""
    low, middle, top = words.BASKETS
    return F.when(prediction < cuts[0], F.lit(low)).when(prediction < cuts[1], F.lit(middle)).when(prediction.isNotNull(), F.lit(top))


def unit_clip(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def interpret(
    df: DataFrame, prediction: str = "prediction", mae: float = FALLBACK_MAE,
    cuts: tuple[float, float] = BASKET_CUTS, low_range: float = LOW_RANGE,
) -> DataFrame:
    """Replace the raw prediction by the five output columns.  Narrow: no shuffle, no join."""
    p = F.col("prediccion")
    return (
        df.withColumn("prediccion", unit_clip(F.col(prediction)))
        .withColumns({
            "cesta": basket(p, cuts), "limite_inferior": unit_clip(p - F.lit(mae)),
            "limite_superior": unit_clip(p + F.lit(mae)), "advertencia": p < low_range,
        })
        .drop(prediction)
    )


def prepare_batch(
    df: DataFrame, predictors: Sequence[str], typing: Typing, contract: Contract,
    sentinels: Sequence[str] = NULL_SENTINELS,
) -> DataFrame:
    """Names, sentinels, types and the entry contract.  One broken rule rejects the whole batch."""
    named = normalise_names(df)
    context_columns(named, predictors)
    typed = typed_or_error(unify_nulls(named, predictors, sentinels), typing, "the batch")
    gate(typed.select(*predictors), contract, "the batch")
    return typed


def score_batch(df: DataFrame, model: Model, predictors: Sequence[str], mae: float = FALLBACK_MAE) -> DataFrame:
    """Context, predictors and the five output columns, one row per input row."""
    context = context_columns(df, predictors)
    scored = interpret(model.transform(df), mae=mae)
    return scored.select(*context, *predictors, *OUTPUT_COLUMNS)


def batch_summary(predictions: DataFrame) -> DataFrame:
    """(cesta, n, porcentaje, prediccion_media) from lowest to highest mean; empty for an empty batch."""
    table = predictions.groupBy("cesta").agg(F.count("*").alias("n"), F.avg("prediccion").alias("prediccion_media"))
    everything = Window.partitionBy(F.lit(1))  # one row per basket, so the total needs no second scan
    return table.select(
        "cesta", "n", (100 * F.col("n") / F.sum("n").over(everything)).alias("porcentaje"), "prediccion_media"
    ).orderBy("prediccion_media")


def batch_error(predictions: DataFrame, target: str, prediction: str = "prediccion") -> DataFrame:
    """(n, MAE) over rows whose target, kept as its original text, parses as a number."""
    y = text_to_double(F.trim(F.col(target).cast("string")))
    return predictions.agg(F.count(F.abs(F.col(prediction) - y)).alias("n"), F.avg(F.abs(F.col(prediction) - y)).alias("MAE"))


def preview(predictions: DataFrame, key: str, rows: int, decimals: int = 4) -> DataFrame:
    """The first rows by key with rounded numbers; nothing when ``rows`` is not positive."""
    shown = predictions.select(key, *[
        F.round(c, decimals).alias(c) if t == "double" else F.col(c) for c, t in predictions.dtypes if c in OUTPUT_COLUMNS
    ])
    return shown.orderBy(key).limit(max(rows, 0))


def metric_from_report(report: DataFrame, model: str, column: str, fallback: float) -> float:
    """A figure of the served model; the fall-back when the row, column or value is missing."""
    if column not in report.columns:
        return float(fallback)
    value = report.where(F.col("modelo") == model).agg(F.coalesce(F.first(F.col(column).cast("double")), F.lit(float(fallback)))).first()
    return float(value[0])


def served_metric(spark: SparkSession, path: str, model: str, column: str, fallback: float) -> float:
    if not path_exists(spark, path):
        return float(fallback)
    return metric_from_report(read_parquet(spark, path), model, column, fallback)
