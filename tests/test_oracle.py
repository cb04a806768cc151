"""Every registered query runs; those with SQL give the same rows in DuckDB."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare(duck, frame, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_queries_without_sql_give_rows(spark, name):
    assert queries()[name](spark, FOLDER).limit(1).collect()


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["regla"] for r in rows} >= {"exceso_de_nulos", "fuera_de_rango", "categoria_invalida", "relacion_incumplida"}
