"""The three jobs: raw file to features, features to model, model and file to predictions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.operators import clean, evaluate, score, split
from wardframe.operators.contracts import compare_gate, gate
from wardframe.operators.models import model_fit
from wardframe.plans import admissions as adm
from wardframe.sources import tabular
from wardframe.sources.scratch import materialised

# Names of the report tables.
REPORTS = {
    "metrics": "metricas_training_pipeline", "checks": "chequeos_particion", "validation": "validacion_modelo",
    "diagnosis": "diagnostico_generalizacion", "curve": "curva_aprendizaje", "segments": "segmentos_debiles",
}

ROW_KEY = "_fila"


def build_features(spark: SparkSession, raw_path: str, derived: bool = False) -> tuple[DataFrame, DataFrame]:
    """(typed frame, feature frame) of a raw file."""
    raw = clean.require_columns(clean.normalise_names(tabular.read_text_table(spark, raw_path)), adm.COLUMNS)
    distinct = clean.drop_duplicate_rows(clean.unify_nulls(raw))
    typed = clean.typed_or_error(distinct, adm.TYPING, "typing the source")
    features = clean.feature_matrix(typed, adm.TARGET, adm.DOMAINS, adm.derived_columns() if derived else None)
    return typed, features


def feature_job(spark: SparkSession, raw_path: str, out_path: str, derived: bool = False) -> DataFrame:
    """Three gates, then one write.  A broken rule leaves the previous table as it was."""
    typed, features = build_features(spark, raw_path, derived)
    typed = typed.persist()
    try:
        gate(typed, adm.SOURCE_CONTRACT, "the typed source")
        tabular.write_gated(features, out_path, [
            lambda df: gate(df, adm.FEATURE_CONTRACT, "the features"),
            lambda df: compare_gate(typed, df, adm.COLUMNS, "source to features"),
        ])
    finally:
        typed.unpersist()
    return tabular.read_parquet(spark, out_path)


def with_row_key(df: DataFrame) -> DataFrame:
    """A key of 128 bits from the content of a row; rows are unique under the feature contract."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])
    return df.withColumn(ROW_KEY, F.md5(text.cast("binary")))


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    metrics: DataFrame
    checks: DataFrame
    validation: DataFrame
    diagnosis: DataFrame
    curve: DataFrame | None
    segments: DataFrame


def training_job(
    spark: SparkSession, feature_path: str, model_path: str, report_folder: str, model: str = "extra_trees",
    seed: int = split.SEED, share: float = split.TEST_SHARE, strict: bool = False, scheme: str = "repetido",
    folds: int = 5, repeats: int = 5, references: bool = True, curve: bool = True, trees: int = 100, budget: float = 180.0,
    time: str | None = None,
) -> TrainingResult:
    """Split, check, fit, validate, report, save.

    Under ``series_temporales`` the column ``time`` orders the rows: validation and learning curve train
    on what lies before the validated block only, and the column is no predictor.
    """
    if scheme == "series_temporales" and time is None:
        raise ValueError("series_temporales needs the column that orders the rows")
    contract = adm.FEATURE_CONTRACT.opened() if time else adm.FEATURE_CONTRACT
    features = with_row_key(tabular.read_contracted(spark, feature_path, contract))
    parted = materialised(split.seeded_split(features, ROW_KEY, share, seed, exact=True), "split")
    predictors = [c for c in features.columns if c not in (adm.TARGET, ROW_KEY, time)]
    checks = materialised(split.split_report(
        parted, ROW_KEY, adm.TARGET, predictors, ["university_rating", "research"], share, seed=seed
    ), "checks")
    tabular.write_reports({REPORTS["checks"]: checks}, report_folder)
    split.split_gate(checks, strict)

    train, test = parted.where("split = 'train'").drop("split"), parted.where("split = 'test'").drop("split")

    def fit_of(name: str):
        return model_fit(name, adm.TARGET, adm.PREP, adm.HEURISTIC_DOMAINS, seed, trees, budget)

    fitted = fit_of(model)(train)
    names = [model, *([r for r in ("dummy", "heuristica") if r != model] if references else [])]
    scored = [(fitted if n == model else fit_of(n)(train)).transform(test).select(
        F.lit(n).alias("modelo"), F.col(adm.TARGET).alias("y"), "prediction", ROW_KEY) for n in names]
    metrics = evaluate.regression_metrics(reduce(DataFrame.unionAll, scored), "y", by=["modelo"])
    own = metrics.where(F.col("modelo") == model)
    cv = materialised(evaluate.cross_validate(train, fit_of(model), adm.TARGET, ROW_KEY, scheme, folds, repeats, seed, time), "cv")
    comparison = materialised(evaluate.compare_scenarios(cv, evaluate.long_metrics(own)), "comparison")
    diagnosis = evaluate.diagnose(comparison)
    summary = evaluate.validation_summary(comparison).withColumn("modelo", F.lit(model))
    report = evaluate.metric_report(metrics.join(F.broadcast(summary), "modelo", "left"))
    lines = evaluate.learning_curve(train, fit_of(model), adm.TARGET, ROW_KEY, folds, seed, scheme=scheme, time=time) if curve else None
    segments = evaluate.weak_segments(fitted.transform(test), predictors, adm.TARGET, ROW_KEY)

    tabular.save_model(fitted, model_path, test)
    tabular.write_reports({
        REPORTS["metrics"]: report, REPORTS["validation"]: comparison, REPORTS["diagnosis"]: diagnosis,
        REPORTS["curve"]: lines, REPORTS["segments"]: segments,
    }, report_folder)
    return TrainingResult(fitted, report, checks, comparison, diagnosis, lines, segments)


@dataclass(frozen=True)
class ScoringResult:
    predictions: DataFrame
    summary: DataFrame
    batch_error: DataFrame | None
    path: str | None


def scoring_job(
    spark: SparkSession, model_path: str, data_path: str, out_path: str | None = None, metrics_path: str | None = None,
    model_name: str = "extra_trees",
) -> ScoringResult:
    """Scan, gate, score, write.  A rejected file writes nothing."""
    model = tabular.load_model(spark, model_path)
    mae = score.FALLBACK_MAE
    if metrics_path:
        mae = score.served_metric(spark, metrics_path, model_name, "MAE", score.FALLBACK_MAE)
    ready = score.prepare_batch(tabular.read_table(spark, data_path), adm.PREDICTORS, adm.TYPING_WITHOUT_TARGET, adm.ENTRY_CONTRACT)
    predictions = score.score_batch(ready, model, adm.PREDICTORS, mae)
    error = score.batch_error(predictions, adm.TARGET) if adm.TARGET in predictions.columns else None
    path = tabular.write_predictions(predictions, out_path) if out_path else None
    return ScoringResult(predictions, score.batch_summary(predictions), error, path)
