"""Grids learned from the data, and both kinds of dependence from one pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.operators import explain
from wardframe.operators.models import fit_heuristic


def numbers(spark, values):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "key long, x double")


def test_few_values_are_the_grid(spark):
    assert explain.dependence_grid(numbers(spark, [3, 1, None, 1, float("nan"), 2]), ["x"]) == {"x": [1.0, 2.0, 3.0]}


@pytest.mark.parametrize("n", [100, 137, 5000])
def test_many_values_give_equal_steps_between_trimmed_ranks(spark, n):
    values = np.random.default_rng(n).permutation(np.arange(n) ** 1.5)
    order = np.sort(values)
    ends = []
    for p in (0.05, 0.95):
        at = n * p + 0.4 + 0.2 * p
        low = int(at)
        ends.append(order[low - 1] + (at - low) * (order[low] - order[low - 1]))
    found = explain.dependence_grid(numbers(spark, values), ["x"])["x"]
    assert np.allclose(found, np.linspace(*ends, 100))


def test_around_the_limit_of_points(spark):
    assert len(explain.dependence_grid(numbers(spark, range(99)), ["x"])["x"]) == 99
    assert len(explain.dependence_grid(numbers(spark, range(150)), ["x"], points=20)["x"]) == 20


def test_constants_and_empty_columns(spark):
    df = numbers(spark, [5] * 300).withColumn("y", F.lit(None).cast("double"))
    assert explain.dependence_grid(df, ["x", "y"]) == {"x": [5.0], "y": []}
    heavy = numbers(spark, [7] * 5000 + list(range(200)))  # both trimming ranks fall on one value
    assert set(explain.dependence_grid(heavy, ["x"])["x"]) == {7.0} or len(explain.dependence_grid(heavy, ["x"])["x"]) > 1


def test_both_kinds_agree_with_moving_every_row(spark):
    df = numbers(spark, range(30)).withColumn("z", (F.col("x") * 7) % 11).withColumn("y", F.col("x") / 30)
    model = fit_heuristic(df, "y", {"x": (0.0, 30.0), "z": (0.0, 11.0)})
    found = explain.dependence(df, model, ["x", "z"], "key", ["z"], rows=4)
    curves = found.where("tipo = 'individual'").toPandas()
    assert curves["key"].nunique() == 4 and len(curves) == 4 * 11
    mean = found.where("tipo = 'promedio'").toPandas().set_index("valor")["prediccion"]
    for value in (0.0, 5.0, 10.0):
        moved = model.transform(df.withColumn("z", F.lit(value))).select("key", "prediction").toPandas().set_index("key")["prediction"]
        assert mean[value] == pytest.approx(moved.mean())
        for row in curves[curves["valor"] == value].itertuples():
            assert row.prediccion == pytest.approx(moved[row.key])


def test_equal_rows_are_scored_once_for_a_point(spark):
    df = numbers(spark, [i % 3 for i in range(60)] + [None] * 6).withColumn("y", F.coalesce("x", F.lit(1.0)) / 4)
    model = fit_heuristic(df, "y", {"x": (0.0, 2.0)})

    class Spy:
        def transform(self, frame):
            self.rows = frame.count()
            return model.transform(frame)

    spy = Spy()
    found = explain.dependence(df.withColumn("z", F.col("x")), spy, ["x", "z"], "key", ["z"], {"z": [0.0, 1.0]}, rows=2).toPandas()
    assert spy.rows <= 2 * (4 + 2)
    mean = model.transform(df).agg(F.avg("prediction")).first()[0]
    assert found[found["tipo"] == "promedio"]["prediccion"].tolist() == pytest.approx([mean, mean])
