import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.frames import COLUMNS, frame
from wardframe.functions import pvalues
from wardframe.operators import association, evaluate, explain, foldranks, models, profile
from wardframe.plans import admissions as adm

Y = adm.TARGET


def table(spark, **change):
    mae = {"entrenamiento": 0.040, "validacion_cruzada": 0.045, "desviacion_cv": 0.004, "prueba": 0.046} | {k: v for k, v in change.items() if k != "r2"}
    rows = [("MAE", *[None if mae[c] is None else float(mae[c]) for c in ("entrenamiento", "validacion_cruzada", "desviacion_cv", "prueba")]), ("R2", 0.8, float(change.get("r2", 0.79)), 0.02, 0.78)]
    return spark.createDataFrame(rows, "metrica string, entrenamiento double, validacion_cruzada double, desviacion_cv double, prueba double")


@pytest.mark.parametrize("change,aspect,verdict", [
    ({}, "sobreajuste", "ajuste adecuado"), ({"entrenamiento": 0.0}, "sobreajuste", "sobreajuste"), ({"entrenamiento": 0.034}, "sobreajuste", "sobreajuste leve"),
    ({"r2": 0.3}, "subajuste", "subajuste"), ({}, "subajuste", "capacidad suficiente"), ({"desviacion_cv": 0.02}, "estabilidad", "inestable"),
    ({}, "estabilidad", "estable"), ({"prueba": 0.06}, "degradacion_cv_prueba", "la prueba no confirma la validacion"), ({}, "degradacion_cv_prueba", "coherente"),
    ({"prueba": float("nan")}, "degradacion_cv_prueba", "coherente"), ({"prueba": None}, "degradacion_cv_prueba", "coherente"), ({"validacion_cruzada": 0.0}, "sobreajuste", "ajuste adecuado"),
])
def test_verdicts(spark, change, aspect, verdict):
    assert {r.aspecto: r.veredicto for r in evaluate.diagnose(table(spark, **change)).collect()}[aspect] == verdict


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.5), (4.0, 3.0), (0.0, 0.0)], "y double, prediction double")
    r = evaluate.regression_metrics(df, "y").first()
    assert (r.MAE, r.RMSE) == (pytest.approx(2.5 / 4), pytest.approx(math.sqrt(2.25 / 4)))
    assert r.R2 == pytest.approx(1 - 2.25 / 8.75) and r.spearman == pytest.approx(1.0) and r.MAPE == pytest.approx((1 + 0.25 + 0.25) / 4)


def test_report_is_sorted_and_relative(spark):
    df = spark.createDataFrame([("dummy", 0.10), ("ridge", 0.05)], "modelo string, MAE double")
    assert [(r.modelo, r.mejora_vs_dummy_pct) for r in evaluate.metric_report(df).collect()] == [("ridge", pytest.approx(50.0)), ("dummy", 0.0)]


def test_one_pass_folds_equal_refitted_folds(spark):
    df = frame(spark, 90)
    score = F.expr(models.heuristic_sql(adm.HEURISTIC_DOMAINS, COLUMNS))
    fast = evaluate.fold_scores(evaluate.line_fold_predictions(df, "id", Y, score, 3, 2))
    slow = evaluate.fold_scores(evaluate.fold_predictions(df, lambda d: models.fit_heuristic(d, Y, adm.HEURISTIC_DOMAINS), "repetido", "id", Y, 3, 2))
    keys = ["repeticion", "fold", "rol"]
    a, b = ({tuple(r[k] for k in keys): (r.n, r.MAE, r.R2) for r in d.collect()} for d in (fast, slow))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_schemes(spark):
    df = frame(spark, 80)
    fit = lambda d: models.fit_constant(d, Y)
    for scheme, rounds in (("kfold", 1), ("estratificado", 1), ("repetido", 2)):
        rows = evaluate.fold_predictions(df, fit, scheme, "id", Y, 4, 2).where("rol = 'validacion'")
        assert rows.count() == 80 * rounds
    past = evaluate.fold_predictions(df, fit, "series_temporales", "id", Y, 4, time="id")
    sizes = {(r.fold, r.rol): r["count"] for r in past.groupBy("fold", "rol").count().collect()}
    assert sizes[0, "entrenamiento"] == 16 and sizes[3, "entrenamiento"] == 64 and sizes[3, "validacion"] == 16
    with pytest.raises(ValueError):
        evaluate.fold_predictions(df, fit, "nada", "id", Y)


def test_cross_validation_summary(spark):
    summary = evaluate.cross_validate(frame(spark, 80), lambda d: models.fit_linear(d, Y, adm.PREP, 1.0), Y, "id", "kfold", 3).collect()
    assert [r.metrica for r in summary] == list(evaluate.METRICS)
    mae = summary[0]
    assert mae.validacion_cruzada >= mae.entrenamiento > 0 and mae.brecha_train_cv == pytest.approx(mae.validacion_cruzada - mae.entrenamiento)


def test_learning_curves_grow(spark):
    df = frame(spark, 200)
    general = evaluate.learning_curve(df, lambda d: models.fit_constant(d, Y), Y, "id", 3, shares=(0.5, 1.0)).collect()
    quick = evaluate.line_learning_curve(df, "id", Y, None, 3, shares=(0.5, 1.0), clip=False).collect()
    for a, b in zip(general, quick, strict=True):
        assert a.muestras_entrenamiento == b.muestras_entrenamiento and a.MAE_validacion == pytest.approx(b.MAE_validacion)
    assert general[0].muestras_entrenamiento < general[1].muestras_entrenamiento


def test_weak_segment_is_found(spark):
    df = frame(spark, 120).withColumns({"y": F.lit(0.70), "prediction": F.when(F.col("cgpa") < 7.8, 0.99).otherwise(0.70), "fija": F.lit(1.0)})
    rows = evaluate.weak_segments(df, ["cgpa", "gre_score", "fija"], "y", "id").collect()
    assert (rows[0].atributo, rows[0].segmento, rows[0].debil) == ("cgpa", "tercio 1", True)
    assert {r.atributo for r in rows} == {"cgpa", "gre_score"}


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.5,), (0.95,), (0.0,)], "y double")
    assert [r.n for r in evaluate.target_histogram(df, "y").collect()] == [1, 0, 0, 0, 0, 1]


def test_p_values():
    assert pvalues.student_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert pvalues.student_two_sided(0.0, 5) == pytest.approx(1.0)
    assert pvalues.chi_square_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi_square_tail(15.507313, 8) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi_square_tail(7.814728, 3) == pytest.approx(0.05, abs=1e-6)


def test_yates_only_for_two_by_two(spark):
    df = spark.createDataFrame([("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 25 + [("b", "y")] * 15, "r string, c string")
    got = association.chi_square_test(df, "r", "c").first()
    assert got.gl == 1 and got.chi2 == pytest.approx(4.5**2 * (2 / 15 + 2 / 20))
    assert got.p_valor == pytest.approx(math.erfc(math.sqrt(got.chi2 / 2)))


def test_vif_flags_collinearity(spark):
    df = frame(spark, 150).withColumn("doble", F.col("cgpa") * 2 + F.col("sop") * 0.01)
    got = {r.variable: r.vif for r in association.variance_inflation(df, ["cgpa", "doble", "lor"]).collect()}
    assert got["cgpa"] > 10 and got["doble"] > 10 and got["lor"] < 2
    exact = association.variance_inflation(df.withColumn("copia", F.col("cgpa")), ["cgpa", "copia"]).collect()
    assert all(math.isinf(r.vif) for r in exact)


def test_profile_uses_corrected_moments(spark):
    v = np.array([1.0, 2.0, 2.0, 3.0, 9.0])
    r = profile.numeric_profile(spark.createDataFrame([(float(x),) for x in v], "x double"), ["x"], 6).first()
    n, d = len(v), v - v.mean()
    g1, g2 = (d**3).mean() / (d**2).mean() ** 1.5, (d**4).mean() / (d**2).mean() ** 2 - 3
    assert r.skewness == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2), abs=1e-6)
    assert r.kurtosis_exceso == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6), abs=1e-6)
    assert (r.moda, r.mediana, r.n_atipicos_iqr) == (2.0, 2.0, 1)


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (150, 4)), rng.normal(6, 0.1, (100, 4)), np.zeros((40, 4))])
    q = rng.normal(1, 3, (60, 4))
    train = spark.createDataFrame([(i, [float(a) for a in v], float(i % 7)) for i, v in enumerate(x)], "id bigint, v array<double>, y double")
    test = spark.createDataFrame([(1000 + i, [float(a) for a in v], 0.0) for i, v in enumerate(q)], "id bigint, v array<double>, y double")
    rows = explain.nearest_neighbours(train, test, "id", "v", "y", 5, pivots=8, block_rows=30).collect()
    got = {}
    for r in rows:
        got.setdefault(r["query"], []).append((round(r.distance, 9), r.key))
    for i, v in enumerate(q):
        d = np.sqrt(((x - v) ** 2).sum(1))
        want = sorted((round(float(d[j]), 9), j) for j in range(len(x)))[:5]
        assert sorted(got[1000 + i]) == want


def test_routed_visits_come_in_bounded_frames():
    """A batch whose queries visit every block is not held as one frame."""
    rng = np.random.default_rng(3)
    batch = pd.DataFrame({"query": np.arange(300), "v": list(rng.normal(size=(300, 4)))})
    blocks = np.array([3] + [1] * 99)
    frames = list(explain._routed(batch, rng.normal(size=(100, 4)), np.full(100, 1e6), np.full(100, np.inf), np.arange(100), blocks))
    assert max(map(len, frames)) <= explain.ROUTED_ROWS
    seen = pd.concat(frames)
    assert len(seen) == 300 * 102 and not seen.duplicated(["query", "cell", "block"]).any()


def test_groups_of_cells_are_visited_once():
    """A query is copied for each group of like cells, not for each cell of it."""
    rng = np.random.default_rng(3)
    batch = pd.DataFrame({"query": np.arange(300), "v": list(rng.normal(size=(300, 4)))})
    order, groups = explain._packed(centres := rng.normal(size=(100, 4)), np.full(100, 10), 250)
    assert sorted(order) == list(range(100)) and np.bincount(groups).tolist() == [25, 25, 25, 25]
    frames = list(explain._routed(batch, centres[order], np.full(100, 1e6), np.full(100, np.inf), np.arange(4), np.array([1, 1, 2, 1]), groups))
    seen = pd.concat(frames)
    assert len(seen) == 300 * 5 and not seen.duplicated(["query", "cell", "block"]).any()


@pytest.mark.parametrize("far", [0.0, 1e7, 1e13])
def test_block_neighbours_measure_few_pairs(monkeypatch, far):
    """Vectors that spread evenly leave no cell out; still only rows that may be among the nearest are measured one by one."""
    rng = np.random.default_rng(5)
    x, base = rng.normal(size=(300, 16)) + far, rng.normal(size=(6000, 16)) + far
    base[5990:] = base[7]
    measured = []
    pairs = explain._pair_distances
    monkeypatch.setattr(explain, "_pair_distances", lambda a, b, at, to: measured.append(len(at)) or pairs(a, b, at, to))
    keys = rng.permutation(6000)
    found = list(explain._block_neighbours(x, np.full(300, np.inf), base, keys, np.zeros(6000, int), np.full((1, 16), far), np.array([1e3]), 5))
    q, r, d = (np.concatenate(c) for c in zip(*found, strict=True))
    for i in range(300):
        exact = np.sqrt(((base - x[i]) ** 2).sum(axis=1))
        want = np.lexsort((keys, exact))[:5]
        assert r[q == i].tolist() == want.tolist() and d[q == i].tolist() == exact[want].tolist()
    assert sum(measured) < 300 * 6000 / (1 if far else 20)


def test_permuted_rows_are_never_broadcast(spark, capsys):
    """The donors are the rows times the repeats, but their estimated size is that of the rows."""
    df = spark.range(40).select("id", F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("y"))
    model = models.ExpressionModel(expression="a")
    explain.permuted_scores(df, model, ["a"], "y", "id", 3).explain()
    plan = capsys.readouterr().out
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan


def test_counted_line_predictions_score_like_the_rows(spark):
    """Copies, unknown targets and unknown keys: the counted pairs are far fewer and give the same scores."""
    one = frame(spark, 60, nulls=0.1).withColumn(Y, F.when(F.col("id") % 9 != 0, F.col(Y)))
    df = one.crossJoin(spark.range(40).withColumnRenamed("id", "copy")).withColumn("id", F.when(F.col("id") != 7, F.col("id") * 40 + F.col("copy")))
    score = F.expr(models.heuristic_sql(adm.HEURISTIC_DOMAINS, dict(df.dtypes)))
    for x, clip in ((score, True), (None, False)):
        rows = evaluate.line_fold_predictions(df, "id", Y, x, 3, 2, clip=clip).withColumn("prediction", F.round("prediction", 9))
        counted = evaluate.line_fold_counts(df, "id", Y, x, 3, 2, clip=clip).withColumn("prediction", F.round("prediction", 9))
        assert counted.count() * 10 < rows.count()
        by = lambda r: (r.repeticion, -1 if r.fold is None else r.fold, r.rol)
        slow, fast = sorted(evaluate.fold_scores(rows).collect(), key=by), sorted(evaluate.fold_scores(counted, "n").collect(), key=by)
        assert [by(r) + (r.n,) for r in fast] == [by(r) + (r.n,) for r in slow]
        for a, b in zip(slow, fast, strict=True):
            assert [v is None for v in a] == [v is None for v in b]
            assert [v for v in b[4:] if v is not None] == pytest.approx([v for v in a[4:] if v is not None], abs=1e-8)


@pytest.mark.parametrize("chunk,piece", [(50_000, 200_000), (40, 60)])
def test_fold_scores_without_a_row_per_line(spark, monkeypatch, chunk, piece):
    """Copies, a target that many rows share, unknown targets and keys: the scores of the rows, from chunks and pieces of any size."""
    monkeypatch.setattr(foldranks, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(foldranks, "PIECE_ROWS", piece)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(chunk, 10_000))
    try:
        one = frame(spark, 60, nulls=0.1).withColumn(Y, F.when(F.col("id") % 9 != 0, F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.col(Y))))
        df = one.crossJoin(spark.range(12).withColumnRenamed("id", "copy")).withColumn("id", F.when(F.col("id") != 7, F.col("id") * 40 + F.col("copy")))
        score = F.expr(models.heuristic_sql(adm.HEURISTIC_DOMAINS, dict(df.dtypes)))
        for x, clip in ((score, True), (score * -1.0, False), (None, False)):
            rows = evaluate.line_fold_predictions(df, "id", Y, x, 3, 2, clip=clip).withColumn("prediction", F.round("prediction", 9))
            by = lambda r: (r.repeticion, -1 if r.fold is None else r.fold, r.rol)
            slow = sorted(evaluate.fold_scores(rows).collect(), key=by)
            fast = sorted(evaluate.line_fold_scores(df, "id", Y, x, 3, 2, clip=clip, digits=9).collect(), key=by)
            assert [by(r) + (r.n,) for r in fast] == [by(r) + (r.n,) for r in slow]
            for a, b in zip(slow, fast, strict=True):
                assert [v is None for v in a] == [v is None for v in b]
                assert [v for v in b[4:] if v is not None] == pytest.approx([v for v in a[4:] if v is not None], abs=1e-8)
        assert evaluate.line_fold_scores(df.where("id < 0"), "id", Y, score, 3, 2).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_report_computes_its_metrics_once(spark, capsys):
    rows = spark.range(60).select(F.when(F.col("id") % 2 == 0, "dummy").otherwise("other").alias("modelo"), (F.col("id") * 1.0).alias("y"), (F.col("id") % 7 * 1.0).alias("prediction"))
    report = evaluate.metric_report(evaluate.regression_metrics(rows, "y", by=["modelo"]))
    report.explain()
    assert "Join" not in capsys.readouterr().out
    mae = {r.modelo: r.MAE for r in report.collect()}
    assert mae["dummy"] == pytest.approx(np.mean([abs(i - i % 7) for i in range(0, 60, 2)]))
