"""Path contributions against scores of all mixtures of a row and the baseline."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from catalog import explaining
from tests.frames import frame
from wardframe.operators import association, explain, treepaths
from wardframe.operators.models import fit_trees
from wardframe.operators.prep import PREFIX, PrepPlan

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (200, 4)) / 2.0
    y = x[:, 0] * x[:, 1] - 2 * x[:, 2] + rng.normal(0, 0.1, 200)
    made = spark.createDataFrame([(f"k{i}", *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "key string, a double, b double, c double, d double, y double")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(made).cache()


@pytest.mark.parametrize("learner", [
    lambda: RandomForestRegressor(numTrees=5, maxDepth=5, labelCol="y", seed=1), lambda: GBTRegressor(maxIter=4, maxDepth=3, labelCol="y", seed=1),
    lambda: DecisionTreeRegressor(maxDepth=6, labelCol="y")])
def test_contributions_are_shapley_values(spark, rows, learner):
    model, baseline = learner().fit(rows), dict(zip(NAMES, (1.0, 1.5, 2.0, 0.5), strict=True))
    few = rows.limit(6)
    got = {}
    for r in treepaths.tree_contributions(few, model, NAMES, baseline, "key").collect():
        got.setdefault(r.key, {"base": r.base, "prediction": r.prediction})[r.atributo] = r.aporte
    for r in few.collect():
        def score(chosen, r=r):
            return model.predict(Vectors.dense([r[n] if n in chosen else baseline[n] for n in NAMES]))
        line = got[r.key]
        assert line["base"] == pytest.approx(score(())) and line["prediction"] == pytest.approx(score(NAMES))
        for n in NAMES:
            rest = [m for m in NAMES if m != n]
            want = sum(factorial(k) * factorial(3 - k) / factorial(4) * (score((*s, n)) - score(s)) for k in range(4) for s in combinations(rest, k))
            assert line[n] == pytest.approx(want, abs=1e-9)


def test_contributions_need_no_exchange(rows):
    model = DecisionTreeRegressor(maxDepth=3, labelCol="y").fit(rows)
    plan = treepaths.tree_contributions(rows, model, NAMES, dict.fromkeys(NAMES, 1.0), "key")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_chi_square_of_many_sparse_levels(spark):
    n = 100_000
    df = spark.range(2 * n).select((F.col("id") % n).alias("a"), (F.col("id") * 7 % n).alias("b"))
    r = association.chi_square(df, "a", "b").first()  # one cell of 2 in each row and column: chi2 = n_rows (levels - 1)
    assert (r.n, r.filas, r.columnas, r.gl) == (2 * n, n, n, (n - 1) ** 2)
    assert r.chi2 == pytest.approx(2 * n * (n - 1)) and r.v_cramer == pytest.approx(1.0)


def test_yates_only_for_two_by_two(spark):
    cells = {("x", "u"): 12, ("x", "v"): 5, ("y", "u"): 3, ("y", "v"): 9}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "a string, b string")
    e = {("x", "u"): 17 * 15 / 29, ("x", "v"): 17 * 14 / 29, ("y", "u"): 12 * 15 / 29, ("y", "v"): 12 * 14 / 29}
    want = sum((abs(cells[k] - e[k]) - 0.5) ** 2 / e[k] for k in cells)
    assert association.chi_square(df, "a", "b").first().chi2 == pytest.approx(want)


def test_rows_between_the_same_limits_are_walked_once(rows):
    model = RandomForestRegressor(numTrees=3, maxDepth=2, labelCol="y", seed=1).fit(rows)
    leaves, x = treepaths.leaves_of(model), np.array([[r[n] for n in NAMES] for r in rows.collect()])
    x[0, 2] = np.nan
    first, cell = treepaths.cells_of(leaves, x)
    own, _ = treepaths.path_contributions(leaves, x, np.ones(4))
    shared, _ = treepaths.path_contributions(leaves, x[first], np.ones(4))
    assert len(first) < len(x) and np.array_equal(shared[cell], own)


def test_rows_side_by_side_keep_every_row_and_value(spark, rows):
    """Rows that repeat, also over the chunks of a task, keep their own contributions."""
    model, baseline = RandomForestRegressor(numTrees=3, maxDepth=3, labelCol="y", seed=1).fit(rows), dict.fromkeys(NAMES, 1.0)
    twice = rows.unionAll(rows.withColumn("key", F.concat(F.lit("again"), "key"))).drop("features", "y")
    near = treepaths.side_by_side(twice, NAMES, "key")
    plain = {(r.key, r.atributo): (r.base, r.prediction, r.aporte) for r in treepaths.tree_contributions(rows, model, NAMES, baseline, "key").collect()}
    got = {(r.key, r.atributo): (r.base, r.prediction, r.aporte) for r in treepaths.tree_contributions(near, model, NAMES, baseline, "key").collect()}
    assert len(got) == 2 * len(plain) == 2 * 200 * 4
    assert all(got[k] == plain[k[0].removeprefix("again"), k[1]] for k in got)


def test_chi_square_joins_no_rows_without_a_key(spark):
    df = spark.createDataFrame([("x", "u"), ("x", "v"), ("y", "u"), ("z", "v")], "a string, b string")
    table = association.chi_square(df, "a", "b")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    r = table.first()
    assert (r.n, r.filas, r.columnas, r.gl) == (4, 3, 2, 2) and r.chi2 == pytest.approx(2.0)


def prepared(spark):
    df = frame(spark, 200, seed=5, nulls=0.1)
    plan = PrepPlan(numeric=("cgpa", "gre_score"), boolean=("research",), square=("cgpa",), indicator=True)
    return df, fit_trees(df, "chance_of_admit", plan, RandomForestRegressor(numTrees=6, maxDepth=6, seed=3))


def test_every_cell_has_the_prediction_of_its_rows(spark):
    df, model = prepared(spark)
    names = [PREFIX + c for c in model.stages[0].feature_names()]
    grid = treepaths.CellGrid(treepaths.leaves_of(model.stages[2]), len(names))
    scored = model.transform(df).toPandas()
    assert np.allclose(grid.table()[grid.codes(scored[names].to_numpy(float))], scored["prediction"], atol=1e-12)
    with pytest.raises(ValueError, match="unknown"):
        grid.codes(np.full((1, len(names)), np.nan))


def test_permuted_trees_are_looked_up_and_not_scored(spark, monkeypatch, capsys):
    """The same errors as scoring every moved row, and no row of the join meets the trees."""
    df, model = prepared(spark)
    features = ["cgpa", "gre_score", "research", "sop"]
    permuted = explain.permuted_scores(df, model, features, "chance_of_admit", "id", 4)
    permuted.explain()
    plan = capsys.readouterr().out
    assert "ShuffledHashJoin" in plan and "UDF(features" not in plan and "predict" not in plan.lower()
    got = {(r.atributo, r.repeticion): (r.error_base, r.error) for r in permuted.collect()}
    monkeypatch.setattr(explain, "_grid_of", lambda model, features: None)
    want = {(r.atributo, r.repeticion): (r.error_base, r.error) for r in explain.permuted_scores(df, model, features, "chance_of_admit", "id", 4).collect()}
    assert got.keys() == want.keys() and len(got) == 16
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in got)


def test_importances_are_compared_for_one_forest(spark, monkeypatch):
    """j4 fits once, and neither permutation nor contributions are computed again for their shares."""
    fits = []
    small = lambda train: fits.append(1) or fit_trees(train, "target", explaining_plan, RandomForestRegressor(numTrees=2, maxDepth=3, seed=1))
    explaining_plan = PrepPlan(numeric=("quantity",), boolean=("open",))
    rows = spark.createDataFrame([(i, float(i % 9), 0.1, 0.1, "1", i % 2 == 0, (i % 9) / 9 + i % 2) for i in range(80)],
                                 "key bigint, quantity double, discount double, tax double, level string, open boolean, target double")
    monkeypatch.setattr(explaining, "fitted_forest", small)
    monkeypatch.setattr(explaining, "sides", lambda spark, sf: (rows.where("key < 60"), rows.where("key >= 60")))
    table = explaining.j4(spark, "")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert len(fits) == 1 and "InPandas" not in plan
    assert sum(r.contribucion_pct for r in table.collect()) == pytest.approx(100)
