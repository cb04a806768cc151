import os

import pytest
from pyspark.sql import functions as F

from tests.frames import COLUMNS, frame, predictors
from wardframe.operators import score
from wardframe.operators.contracts import ContractError
from wardframe.plans import admissions as adm
from wardframe.plans import jobs
from wardframe.sources import tabular

HEADER = "GRE Score,TOEFL Score,University Rating,SOP,LOR ,CGPA,Research,Chance of Admit "
ORDER = ["gre_score", "toefl_score", "university_rating", "sop", "lor", "cgpa", "research"]


def line(i, labelled=True, **faults):
    """Row i of the seeded predictors as text, some cells replaced."""
    p = predictors(9, 11)
    whole = ("gre_score", "toefl_score", "university_rating", "research")
    cells = {c: str(int(p[c][i])) if c in whole else str(p[c][i]) for c in ORDER} | {"target": f"0.{50 + i}"}
    cells |= faults
    return ",".join(cells[c] for c in [*ORDER, *(["target"] if labelled else [])])


GOOD = [line(0), line(1, lor="n/a", research="-"), line(0)]


def raw(tmp_path, lines, name="raw.csv", header=HEADER):
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("train")
    features = frame(spark, 120).drop("id")
    tabular.write_gated(features, f"{folder}/features.parquet")
    result = jobs.training_job(spark, f"{folder}/features.parquet", f"{folder}/model", f"{folder}/reports", model="ridge", scheme="kfold", folds=3, curve=False)
    return folder, result


def test_feature_job(spark, tmp_path):
    out = jobs.feature_job(spark, raw(tmp_path, GOOD), f"{tmp_path}/f.parquet", derived=True)
    assert out.count() == 2 and {"indice_academico", "sop_lor_media", "rating_x_research"} < set(out.columns)
    assert out.where("lor is null and sop_lor_media is null").count() == 1


@pytest.mark.parametrize("faults,rule", [
    ({"gre_score": "341"}, "fuera_de_rango"), ({"university_rating": "6"}, "categoria_invalida"), ({"target": ""}, "exceso_de_nulos"),
    (dict.fromkeys(ORDER[:4] + ["research"], "?"), "relacion_incumplida"), ({"toefl_score": "many"}, "valor_no_convertible"), ({"research": "7"}, "valor_no_booleano"),
])
def test_bad_files_leave_the_previous_output(spark, tmp_path, faults, rule):
    out = f"{tmp_path}/f.parquet"
    jobs.feature_job(spark, raw(tmp_path, GOOD), out)
    before = sorted(os.listdir(out))
    with pytest.raises(ContractError) as error:
        jobs.feature_job(spark, raw(tmp_path, [*GOOD, line(2, **faults)], "bad.csv"), out)
    assert rule in {v.regla for v in error.value.violations}
    assert sorted(os.listdir(out)) == before and not os.path.exists(out + ".staging")


def test_wrong_derived_value_is_caught(spark):
    df = frame(spark, 5).drop("id").withColumn("sop_lor_media", F.lit(4.99))
    from wardframe.operators.contracts import review

    found = review(df, adm.FEATURE_CONTRACT).collect()
    assert any(v.detalle.startswith("sop_lor_media_coherente") for v in found)


def test_missing_files_and_formats(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tabular.read_text_table(spark, f"{tmp_path}/no.csv")
    with pytest.raises(ValueError):
        tabular.read_table(spark, f"{tmp_path}/no.xlsx")
    with pytest.raises(ValueError):
        tabular.write_predictions(frame(spark, 3), f"{tmp_path}/no.json")


def test_training_job_writes_everything(spark, trained):
    folder, result = trained
    assert {f"{jobs.REPORTS[k]}.parquet" for k in ("metrics", "checks", "validation", "diagnosis", "segments")} <= set(os.listdir(f"{folder}/reports"))
    rows = {r.modelo: r for r in result.metrics.collect()}
    assert rows["ridge"].MAE < min(rows["heuristica"].MAE, rows["dummy"].MAE) and rows["ridge"].MAE_cv > 0
    assert result.diagnosis.count() == 4


def test_training_in_time_never_sees_the_future(spark, tmp_path):
    """The target follows a rule up to row 100 and its opposite after it: folds that saw the future would know."""
    made = frame(spark, 120).withColumnRenamed("id", "momento")
    turned = made.withColumn("chance_of_admit", F.when(F.col("momento") < 100, F.col("chance_of_admit")).otherwise(1 - F.col("chance_of_admit")))
    tabular.write_gated(turned, f"{tmp_path}/f.parquet")
    with pytest.raises(ValueError, match="orders the rows"):
        jobs.training_job(spark, f"{tmp_path}/f.parquet", f"{tmp_path}/m", f"{tmp_path}/r", model="ridge", scheme="series_temporales")
    result = jobs.training_job(
        spark, f"{tmp_path}/f.parquet", f"{tmp_path}/m", f"{tmp_path}/r", model="ridge", scheme="series_temporales", folds=4, time="momento")
    mae = {r.metrica: r for r in result.validation.collect()}["MAE"]
    assert mae.validador == "series_temporales" and mae.validacion_cruzada > 3 * mae.entrenamiento
    assert result.curve.count() == 7 and "momento" not in {r.columna for r in result.checks.collect()}


def test_training_refuses_a_leaking_table(spark, tmp_path):
    df = frame(spark, 60).drop("id")
    tabular.write_gated(df.unionByName(df), f"{tmp_path}/f.parquet")
    with pytest.raises(ContractError):
        jobs.training_job(spark, f"{tmp_path}/f.parquet", f"{tmp_path}/m", f"{tmp_path}/r", model="dummy", curve=False)
    assert not os.path.exists(f"{tmp_path}/m")


def test_scoring_job_keeps_context_and_rows(spark, trained, tmp_path):
    folder, _ = trained
    lines = ["x," + line(3, lor="n/a"), "y," + line(4, target="?"), "y," + line(4)]
    path = raw(tmp_path, lines, "new.csv", "id,GRE Score,TOEFL Score,University Rating,SOP,LOR ,CGPA,Research,Chance of Admit")
    result = jobs.scoring_job(spark, f"{folder}/model", path, f"{tmp_path}/out.csv")
    assert result.predictions.columns == ["id", adm.TARGET, *COLUMNS, *score.OUTPUT_COLUMNS]
    assert result.predictions.count() == 3 and result.summary.agg(F.sum("n")).first()[0] == 3
    assert result.batch_error.first().n == 2
    assert tabular.read_table(spark, f"{tmp_path}/out.csv").count() == 3


def test_one_bad_row_rejects_the_batch(spark, trained, tmp_path):
    folder, _ = trained
    path = raw(tmp_path, ["x," + line(3, labelled=False), "y," + line(4, labelled=False, gre_score="999")], "new.csv", "id,GRE Score,TOEFL Score,University Rating,SOP,LOR ,CGPA,Research")
    with pytest.raises(ContractError):
        jobs.scoring_job(spark, f"{folder}/model", path, f"{tmp_path}/out.parquet")
    assert not os.path.exists(f"{tmp_path}/out.parquet")
    with pytest.raises(ValueError, match="cgpa"):
        score.prepare_batch(spark.read.csv(path, header=True).drop("CGPA"), adm.PREDICTORS, adm.TYPING_WITHOUT_TARGET, adm.ENTRY_CONTRACT)


@pytest.mark.parametrize("p,label,warned", [(0.669, "ambiciosa", False), (0.67, "probable", False), (0.79, "segura", False), (0.5, "ambiciosa", True), (1.3, "segura", False), (-0.2, "ambiciosa", True)])
def test_baskets_and_ranges(spark, p, label, warned):
    r = score.interpret(spark.createDataFrame([(p,)], "prediction double")).first()
    assert (r.cesta, r.advertencia) == (label, warned)
    assert 0 <= r.limite_inferior <= r.prediccion <= r.limite_superior <= 1


def test_scoring_has_no_shuffle(spark, trained, tmp_path):
    folder, _ = trained
    plan = score.score_batch(tabular.read_parquet(spark, f"{folder}/features.parquet"), tabular.load_model(spark, f"{folder}/model"), adm.PREDICTORS)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_served_metric_falls_back(spark, trained, tmp_path):
    folder, _ = trained
    path = f"{folder}/reports/{jobs.REPORTS['metrics']}.parquet"
    assert 0 < score.served_metric(spark, path, "ridge", "MAE", 9.0) < 1
    assert score.served_metric(spark, path, "nadie", "MAE", 9.0) == 9.0
    assert score.served_metric(spark, f"{tmp_path}/no.parquet", "ridge", "MAE", 9.0) == 9.0


def test_empty_batch_has_an_empty_summary(spark):
    empty = score.interpret(spark.createDataFrame([], "prediction double"))
    assert score.batch_summary(empty).count() == 0 and score.preview(empty.withColumn("k", F.lit(1)), "k", 0).count() == 0
