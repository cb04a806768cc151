"""Reading and writing tables, reports and fitted models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.operators.contracts import Contract, gate
from wardframe.sources.versions import current, publish

# Suffixes of readable and writable tables.
TABLE_SUFFIXES = (".csv", ".parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def _published(spark: SparkSession, path: str) -> str:
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(path)
    return folder


def _suffix(path: str) -> str:
    for suffix in TABLE_SUFFIXES:
        if path.rstrip("/").endswith(suffix):
            return suffix
    raise ValueError(f"unsupported format: {path}; use one of {list(TABLE_SUFFIXES)}")


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text: no type or null inference."""
    folder = _published(spark, path)
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", False).option(
        "escape", '"'
    ).csv(folder)


def read_contracted(spark: SparkSession, path: str, contract: Contract, context: str = "") -> DataFrame:
    """Parquet of any age, so the contract is checked again on the way in."""
    return gate(read_parquet(spark, path), contract, context or path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a parquet output, or a plain parquet table."""
    return spark.read.parquet(_published(spark, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    suffix = _suffix(path)
    if suffix == ".csv":
        return read_text_table(spark, path)
    return read_parquet(spark, path)


def write_gated(df: DataFrame, path: str, gates: Sequence[Callable[[DataFrame], object]] = ()) -> str:
    """Publish only after every gate has passed; until then, and if the write fails, the last output stays current."""
    for check in gates:
        check(df)
    publish(df.sparkSession, path, lambda folder: _write(df, folder, ".parquet"))
    return path


def _write(df: DataFrame, folder: str, suffix: str) -> None:
    if suffix == ".csv":
        df.write.option("header", True).csv(folder)
    else:
        df.write.option("compression", "snappy").parquet(folder)


def write_predictions(df: DataFrame, path: str) -> str:
    suffix = _suffix(path)
    publish(df.sparkSession, path, lambda folder: _write(df, folder, suffix))
    return path


def write_reports(reports: Mapping[str, DataFrame | None], folder: str) -> dict[str, str]:
    """One parquet table per report; a report that is absent or empty is skipped."""
    written = {}
    for name, report in reports.items():
        if report is None or report.isEmpty():
            continue
        written[name] = write_gated(report, f"{folder.rstrip('/')}/{name}.parquet")
    return written


def save_model(model: PipelineModel, path: str, sample: DataFrame, tolerance: float = 1e-8) -> str:
    """Save, load again and require the same predictions; only then is the model published.

    Both models score the same rows of one plan, so no join between the two score sets is needed.
    """
    def write(folder: str) -> None:
        model.write().save(folder)
        first = model.transform(sample).withColumnRenamed("prediction", "_first").select(*sample.columns, "_first")
        both = PipelineModel.load(folder).transform(first)
        gap = both.agg(F.max(F.abs(F.col("prediction") - F.col("_first"))), F.count_if(
            F.col("prediction").isNull() != F.col("_first").isNull())).first()
        if (gap[0] or 0.0) > tolerance or gap[1]:
            raise ValueError(f"the model saved in {path} does not reproduce its predictions")

    publish(sample.sparkSession, path, write)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(_published(spark, path))


def round_trip_check(df: DataFrame, path: str) -> DataFrame:
    """(filas_iguales, columnas_iguales, tipos_iguales) between a frame and the table written from it."""
    again = read_parquet(df.sparkSession, path)
    same_names, same_types = df.columns == again.columns, df.dtypes == again.dtypes
    counts = df.agg(F.count("*").alias("a")).unionAll(again.agg(F.count("*").alias("a")))
    return counts.agg((F.min("a") == F.max("a")).alias("filas_iguales")).select(
        "filas_iguales", F.lit(same_names).alias("columnas_iguales"), F.lit(same_types).alias("tipos_iguales")
    )
