"""Outputs by version: what readers see when a writer fails or dies at each step."""

import os

import pytest

from wardframe.operators.contracts import Contract, ContractError, column, gate
from wardframe.sources import tabular, versions


class Died(BaseException):
    """The end of a process, which no handler of ordinary errors sees."""


def values(spark, path):
    return sorted(r[0] for r in tabular.read_table(spark, path).collect())


def rows(spark, *numbers):
    return spark.createDataFrame([(float(n),) for n in numbers], "x double")


def test_last_publication_is_read_and_older_ones_expire(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    for n in range(4):
        tabular.write_gated(rows(spark, n), path)
        assert values(spark, path) == [n]
    assert len(versions.versions(spark, path)) == versions.KEEP == len(os.listdir(f"{path}/_versions"))


def test_readers_of_the_version_before_can_finish(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    tabular.write_gated(rows(spark, 1), path)
    before = tabular.read_table(spark, path)
    tabular.write_gated(before.unionByName(rows(spark, 2)), path)  # also a table derived from itself
    assert before.count() == 1 and values(spark, path) == [1, 2]


@pytest.mark.parametrize("suffix", [".parquet", ".csv"])
@pytest.mark.parametrize("step", ["data", "partial", "mark", "expire"])
def test_a_crash_at_any_step_leaves_a_readable_version(spark, tmp_path, monkeypatch, suffix, step):
    path = f"{tmp_path}/t{suffix}"
    tabular.write_predictions(rows(spark, 1), path)

    def die(*_):
        raise Died

    with monkeypatch.context() as fault:
        if step == "data":  # nothing written yet
            fault.setattr(tabular, "_write", die)
        elif step == "partial":  # killed between files: no clean-up either
            def half(df, folder, kind):
                os.makedirs(folder)
                with open(f"{folder}/part-00000{kind}", "w") as out:
                    out.write("x\n1")
                raise Died
            fault.setattr(tabular, "_write", half)
        elif step == "mark":  # all data written, no mark
            write = tabular._write
            fault.setattr(tabular, "_write", lambda *a: (write(*a), die()))
        else:
            fault.setattr(versions, "_expire", die)
        with pytest.raises(Died):
            tabular.write_predictions(rows(spark, 2), path)
    assert [float(v) for v in values(spark, path)] == ([2.0] if step == "expire" else [1.0])
    tabular.write_predictions(rows(spark, 3), path)
    assert [float(v) for v in values(spark, path)] == [3.0]


def test_leftovers_of_a_killed_writer_are_invisible_and_removed(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    tabular.write_gated(rows(spark, 1), path)
    orphan = f"{path}/_versions/{2:012d}-killed"
    os.makedirs(orphan)
    assert values(spark, path) == [1]
    tabular.write_gated(rows(spark, 2), path)
    assert values(spark, path) == [2] and not os.path.exists(orphan)


def test_only_unpublished_data_is_no_table(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    os.makedirs(f"{path}/_versions/{1:012d}-killed")
    assert versions.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        tabular.read_table(spark, path)


def test_a_rejected_table_leaves_the_last_one(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    tabular.write_gated(rows(spark, 1), path)
    with pytest.raises(ContractError):
        tabular.write_gated(rows(spark, 7), path, [lambda df: gate(df, Contract(column("x", within=(0, 1))))])
    assert values(spark, path) == [1]


def test_plain_tables_are_read_and_superseded(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    rows(spark, 1).write.parquet(path)
    assert values(spark, path) == [1]
    tabular.write_gated(rows(spark, 2), path)
    assert values(spark, path) == [2] and sorted(os.listdir(path)) == ["_current", "_versions"]


def test_an_unfaithful_model_is_never_current(spark, tmp_path, monkeypatch):
    from pyspark.ml import PipelineModel

    from wardframe.operators.models import fit_constant

    path = f"{tmp_path}/m"
    tabular.save_model(PipelineModel([fit_constant(rows(spark, 1, 3), "x")]), path, rows(spark, 1))
    with monkeypatch.context() as fault:
        first = tabular.load_model(spark, path)
        fault.setattr(tabular.PipelineModel, "load", staticmethod(lambda _: first))
        with pytest.raises(ValueError, match="reproduce"):
            tabular.save_model(PipelineModel([fit_constant(rows(spark, 10), "x")]), path, rows(spark, 1))
    assert tabular.load_model(spark, path).transform(rows(spark, 0)).first().prediction == 2.0
