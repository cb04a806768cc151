"""Fits from moments equal refitting every fold."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.frames import frame
from wardframe.operators import evaluate
from wardframe.operators.models import LinearFit, fit_linear
from wardframe.operators.prep import PrepPlan
from wardframe.plans import admissions as adm

TARGET = "chance_of_admit"
BASE = adm.PREP
PLANS = adm.VARIANTS | {
    "minmax": replace(BASE, min_max=True), "raw": replace(BASE, scale=False), "log": replace(BASE, log=("cgpa",), square=("lor",)),
    "nothing": PrepPlan(), "free": replace(BASE, onehot=True, indicator=True),
}


@pytest.fixture(scope="module")
def rows(spark):
    made = frame(spark, n=150, seed=3, nulls=0.12).withColumn("chance_of_admit", F.when(F.col("id") % 19 != 0, F.col(TARGET)))
    return made.withColumn("moment", (F.col("id") * 7) % 150).repartition(3).cache()


def metrics(predictions, by):
    got = evaluate.regression_metrics(predictions, "y", by=by, ranks=False)
    return {tuple(r[b] for b in by): (r["n"], r["MAE"], r["RMSE"], r["R2"]) for r in got.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k, figures in want.items():
        assert got[k] == pytest.approx(figures, rel=1e-7, abs=1e-9), k


@pytest.mark.parametrize("scheme", ["repetido", "estratificado", "series_temporales"])
def test_every_plan_equals_refitting(spark, rows, scheme):
    names = list(PLANS) if scheme == "repetido" else ["1_base", "free"]
    fits = {n: LinearFit(TARGET, PLANS[n], 0.0 if n == "raw" else 1.0) for n in names if n in PLANS}
    moments = evaluate.fold_moments(rows, fits, scheme, "id", TARGET, 2, 2, 42, "moment").predictions()
    by = ["repeticion", "fold", "rol"]
    got = metrics(moments, ["variante", *by])
    some = {n: fits[n] for n in list(fits)[1::3 if scheme == "repetido" else 1]}
    for name, fit in some.items():
        refit = evaluate.fold_predictions(rows, lambda df, f=fit: fit_linear(df, f.target, f.plan, f.alpha), scheme, "id", TARGET, 2, 2, 42, "moment")
        same({k[1:]: v for k, v in got.items() if k[0] == name}, metrics(refit, by))


@pytest.mark.parametrize("scheme", ["kfold", "series_temporales"])
def test_learning_curve_equals_refitting(spark, rows, scheme):
    known = rows.where(F.col(TARGET).isNotNull())
    fit = LinearFit(TARGET, BASE, 1.0)
    got = evaluate.learning_curve(known, fit, TARGET, "id", 2, shares=(0.4, 1.0), scheme=scheme, time="moment").collect()
    want = evaluate.learning_curve(known, lambda df: fit(df), TARGET, "id", 2, shares=(0.4, 1.0), scheme=scheme, time="moment").collect()
    assert [tuple(r) for r in got] == [pytest.approx(tuple(r), rel=1e-7) for r in want]


def test_time_needs_an_order(rows):
    with pytest.raises(ValueError, match="orders the rows"):
        evaluate.fold_predictions(rows, LinearFit(TARGET, BASE, 1.0), "series_temporales", "id", TARGET)


def test_seven_variants_take_few_jobs(spark, rows):
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("variants", "all variants")
    got = evaluate.compare_variants({n: LinearFit(TARGET, p, 1.0) for n, p in adm.VARIANTS.items()}, rows, TARGET, "id").collect()
    jobs = len(tracker.getJobIdsForGroup("variants"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == len(adm.VARIANTS) == 7
    assert jobs < 60, jobs  # adaptive execution submits each exchange as a job of its own


def test_folds_in_time_are_met_by_equality(spark, rows):
    scored = evaluate.fold_predictions(rows, LinearFit(TARGET, BASE, 1.0), "series_temporales", "id", TARGET, 2, 1, 42, "moment")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # 50 opening rows, then two blocks of 50: the second fold sees all
    counts = {(r["fold"], r["rol"]): r["count"] for r in scored.groupBy("fold", "rol").count().collect()}
    assert counts == {(0, "entrenamiento"): 50, (0, "validacion"): 50, (1, "entrenamiento"): 100, (1, "validacion"): 50}


@pytest.mark.parametrize("scheme", ["repetido", "series_temporales"])
def test_counts_stand_for_the_predictions(spark, rows, scheme):
    """Copies of a row under other keys are one row of the design, with the weight of all."""
    copies = rows.select("id", "moment", TARGET, *BASE.inputs()).unionAll(rows.select(F.col("id") + 1000, F.col("moment") + 500, TARGET, *BASE.inputs()))
    moments = evaluate.fold_moments(copies, {"a": LinearFit(TARGET, BASE, 1.0)}, scheme, "id", TARGET, 2, 2, 42, "moment")
    assert moments.counted.count() <= 150 * (2 if scheme == "repetido" else 1)
    names = ["repeticion", "fold", "rol", "y", "prediction"]
    plain = {tuple(r[:5]): r[5] for r in moments.predictions().groupBy(*names).count().collect()}
    summed = {tuple(r[:5]): r[5] for r in moments.counts().groupBy(*names).agg(F.sum("n")).collect()}
    at = lambda lines: sorted(((r, f, o, -1.0 if y is None else y, round(p, 9)), n) for (r, f, o, y, p), n in lines.items())
    assert at(plain) == at(summed)


def test_scores_and_errors_are_those_of_the_predictions(spark, rows):
    """Unknown targets and cells: no row per fit is made, neither for the errors nor for the ranks."""
    fits = {n: LinearFit(TARGET, PLANS[n], 1.0) for n in ("1_base", "free")}
    moments = evaluate.fold_moments(rows, fits, "repetido", "id", TARGET, 3, 2)
    by = ["variante", "repeticion", "fold"]
    plan = moments.errors()._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    got = {tuple(r[b] for b in by): (r["n"], r["s"] / r["n"]) for r in moments.errors().collect()}
    same(got, {k[:3]: v[:2] for k, v in metrics(moments.predictions().where("rol = 'validacion'"), by).items()})
    single = evaluate.fold_moments(rows, {"": fits["free"]}, "repetido", "id", TARGET, 3, 2)
    names = ["repeticion", "fold", "rol"]
    want = {tuple(r[b] for b in names): tuple(r)[3:] for r in evaluate.fold_scores(single.predictions()).collect()}
    same({tuple(r[b] for b in names): tuple(r)[3:] for r in single.scores().collect()}, want)
    assert len(want) == 12
