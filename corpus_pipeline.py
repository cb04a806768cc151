"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wardframe.llm import alignment, chat, mixing, neardup, packing, pages, private, quality, substrings, suffixes, topk, trie, vectors  # noqa: F401 - they register their queries
from wardframe.llm.registry import QUERIES, SQL, query, table
from wardframe.sources.scratch import erased, materialised, noted

#: least similarity of near copies, of which the corpus keeps one
NEAR_PERCENT = 80
#: application: what its last stage has written on the way to its result
_behind: dict[str, list[str]] = {}


def in_turn(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, which first erases what the stage before needed on the way.

    Stages are written and read again, so a stage that begins finds the result before it on disk; where its input still reads
    one of these folders, the folder stays.
    """
    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application, files = spark.sparkContext.applicationId, docs.inputFiles()
        for folder in _behind.pop(application, []):
            name = folder.rsplit("/", 1)[-1]
            if not any(f"/{name}/" in f for f in files):
                erased(spark, folder)
        with noted() as folders:
            out = stage(spark, docs, sf_dir)
        _behind[application] = folders
        return out
    return begun


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _behind.pop(spark.sparkContext.applicationId, None)  # a run begins; what the last one returned may still be read
    return quality.keep_good(docs)


@in_turn
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, percent=NEAR_PERCENT)


@in_turn
def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private.pseudonymise(docs)


@in_turn
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


@in_turn
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pseudonyms", pseudonyms),
    ("source_mix", source_mix),
    ("packed", packed),
]
#: shingle links, keyed permutations and seeded draws have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


query("pipeline", ORACLE_SQL)(run)

__all__ = ["ORACLE_SQL", "QUERIES", "SQL", "STAGES", "run"]
