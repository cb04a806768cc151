"""A stage clears away what the stage before wrote on its way, once that is written itself."""

import os

from corpus_pipeline import in_turn
from wardframe.sources.scratch import materialised, noted


def test_a_stage_clears_what_lies_behind(spark, tmp_path):
    first = in_turn(lambda spark, docs, folder: materialised(docs, "way").where("id > 2"))
    second = in_turn(lambda spark, docs, folder: docs.selectExpr("id + 1 AS id"))
    with noted() as folders:
        way = first(spark, spark.range(6).toDF("id"), "")
    assert len(folders) == 1
    here = folders[0].removeprefix("file:")
    chained = second(spark, way, "")  # not written: the folder stays
    assert os.path.isdir(here) and sorted(r.id for r in chained.collect()) == [4, 5, 6]

    with noted() as folders:
        first(spark, spark.range(6).toDF("id"), "").write.parquet(f"{tmp_path}/out")
    here = folders[0].removeprefix("file:")
    assert os.path.isdir(here)
    after = second(spark, spark.read.parquet(f"{tmp_path}/out"), "")
    assert not os.path.isdir(here) and sorted(r.id for r in after.collect()) == [4, 5, 6]
