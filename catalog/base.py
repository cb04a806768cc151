"""Shared inputs of the registered queries, once for Spark and once as SQL.

The driver's tables hold no nulls or dirt, so the queries inject them by rule, in the same way on
both sides.  Amounts are summed as whole cents, so both engines see the same bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        (F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes
    ])


def rsql(sql: str, *columns: str, digits: int = 6) -> str:
    """Round the named columns of a query."""
    inner = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({inner}) FROM ({sql}) AS rounded_source"


def as_double(sql: str, *columns: str) -> str:
    """SQL literals such as 0.05 are decimals; the Spark columns are doubles."""
    inner = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({inner}) FROM ({sql}) AS decimal_source"


def sql_hash(key: str, salt: str = "") -> str:
    text = f"'{salt}|' || CAST({key} AS VARCHAR)" if salt else f"CAST({key} AS VARCHAR)"
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


# --- one row per order, built from the line items ------------------------------------------

TARGET = "target"
NUMERIC = ["quantity", "discount", "tax"]
PREDICTORS = ["quantity", "discount", "tax", "level", "open"]
LEVELS = ("1", "2", "3", "4", "5")
DOMAINS = {"quantity": (0.0, 200.0), "discount": (0.0, 0.1), "tax": (0.0, 0.08)}
SCORE_DOMAINS = {"quantity": (0.0, 400.0), "discount": (0.0, 0.1), "tax": (0.0, 0.08), "level": (1.0, 5.0), "open": (0.0, 1.0)}


def order_frame(spark: SparkSession, folder: str) -> DataFrame:
    """key, quantity, discount, tax, level, open, target; some cells are NULL by rule."""
    lines = F.count("*")
    grouped = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(
        lines.alias("lines"), F.sum("l_quantity").alias("q"),
        F.sum(F.floor(F.col("l_discount") * 100 + 0.5)).alias("d"),
        F.sum(F.floor(F.col("l_tax") * 100 + 0.5)).alias("t"),
        F.bool_or(F.col("l_linestatus") == "O").alias("o"),
        F.sum(F.floor(F.col("l_extendedprice") * 100 + 0.5)).alias("p"),
    )
    return grouped.select(
        "key",
        F.when(F.col("key") % 11 != 0, F.col("q")).alias("quantity"),
        (F.col("d").cast("double") / (F.col("lines") * 100).cast("double")).alias("discount"),
        (F.col("t").cast("double") / (F.col("lines") * 100).cast("double")).alias("tax"),
        F.when(F.col("key") % 13 != 0, F.least(F.col("lines"), F.lit(5)).cast("string")).alias("level"),
        F.when(F.col("key") % 17 != 0, F.col("o")).alias("open"),
        (F.col("p").cast("double") / F.lit(3.7e7)).alias("target"),
    )


FRAME = """(
  SELECT l_orderkey AS key,
         CASE WHEN l_orderkey % 11 <> 0 THEN sum(l_quantity) END AS quantity,
         CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS BIGINT)) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS discount,
         CAST(sum(CAST(floor(l_tax * 100 + 0.5) AS BIGINT)) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS tax,
         CASE WHEN l_orderkey % 13 <> 0 THEN CAST(least(count(*), 5) AS VARCHAR) END AS level,
         CASE WHEN l_orderkey % 17 <> 0 THEN bool_or(l_linestatus = 'O') END AS open,
         CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / CAST(37000000 AS DOUBLE) AS target
  FROM lineitem GROUP BY l_orderkey
)"""

# domain-scaled mean of the known predictors
SCORE = """((coalesce(quantity / 400.0, 0.0) + coalesce(discount / 0.1, 0.0) + coalesce(tax / 0.08, 0.0)
  + coalesce((CAST(level AS DOUBLE) - 1.0) / 4.0, 0.0) + coalesce(CAST(CAST(open AS INTEGER) AS DOUBLE), 0.0))
  / ((quantity IS NOT NULL)::INTEGER + (discount IS NOT NULL)::INTEGER + (tax IS NOT NULL)::INTEGER
     + (level IS NOT NULL)::INTEGER + (open IS NOT NULL)::INTEGER))"""

SPLIT_HASH = sql_hash("key", "split42")
SPLIT_LIMIT = int(0.25 * (1 << 60))
SPLIT = f"CASE WHEN {SPLIT_HASH} < {SPLIT_LIMIT} THEN 'test' ELSE 'train' END"


def scored_cte(train_filter: str = "split = 'train'") -> str:
    """WITH f, line, s: the frame split, the recalibrated line of the heuristic, and test scores."""
    return f"""WITH f AS (SELECT *, {SPLIT} AS split, {SCORE} AS score FROM {FRAME} AS frame),
line AS (SELECT regr_intercept(target, score) AS a, regr_slope(target, score) AS b FROM f WHERE {train_filter}),
s AS (SELECT f.*, round(greatest(0.0, least(1.0, a + b * score)), 9) AS prediction FROM f, line WHERE split = 'test')
"""


def split_frame(spark: SparkSession, folder: str) -> DataFrame:
    from wardframe.operators.split import seeded_split

    return seeded_split(order_frame(spark, folder), "key")


def heuristic_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows with the prediction of the recalibrated heuristic fitted on train rows."""
    from wardframe.operators.models import fit_heuristic

    parted = written(split_frame(spark, folder))
    model = fit_heuristic(parted.where("split = 'train'"), TARGET, SCORE_DOMAINS)
    # the last bits of a sum depend on its order, and ranks look at every bit
    return model.transform(parted.where("split = 'test'")).withColumn("prediction", F.round("prediction", 9))


def written(df: DataFrame) -> DataFrame:
    """For queries that read a derived frame several times."""
    from wardframe.sources.scratch import materialised

    return materialised(df, "frame")
