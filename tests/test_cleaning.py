import math

import pytest
from pyspark.sql import functions as F

from wardframe.functions import cleaning as fx
from wardframe.operators import clean
from wardframe.operators.contracts import ContractError
from wardframe.plans import admissions as adm


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("text,number", [("337", 337), ("337.0", 337), ("316.5", None), ("1d", None), ("x", None), ("-4", -4), ("NaN", None), ("", None)])
def test_integral_text(spark, text, number):
    assert one(spark, fx.text_to_long(F.col("x")), text) == number


@pytest.mark.parametrize("text,number", [("4.5", 4.5), (".5", 0.5), ("1e2", 100.0), ("0x1f", None), ("Infinity", None), ("1,5", None)])
def test_decimal_text(spark, text, number):
    assert one(spark, fx.text_to_double(F.col("x")), text) == number


@pytest.mark.parametrize("text,result", [(" n/a ", None), ("-", None), ("\t", None), ("Sin Dato", None), (" ok ", "ok"), ("0", "0"), (None, None)])
def test_sentinels(spark, text, result):
    assert one(spark, fx.unified_null(F.col("x")), text) == result


@pytest.mark.parametrize("value,result", [(900.0, 340.0), (-1.0, 0.0), (None, None), (320.0, 320.0)])
def test_clip_never_imputes(spark, value, result):
    assert one(spark, fx.clipped(F.col("x"), 0, 340), value, "double") == result


def test_nan_becomes_null(spark):
    assert one(spark, fx.to_double(F.col("x"), "double"), math.nan, "double") is None


def test_mean_of_known(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (0.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(fx.mean_of_known([F.col("a"), F.col("b")])).collect()] == [1.0, None, 0.5]
    with pytest.raises(ValueError):
        fx.mean_of_known([])


def test_names_and_required_columns(spark):
    df = clean.normalise_names(spark.createDataFrame([("1", "2")], ["LOR ", "Chance of Admit "]))
    assert df.columns == ["lor", "chance_of_admit"]
    with pytest.raises(ValueError, match="cgpa"):
        clean.require_columns(df, ["lor", "cgpa"])
    assert clean.require_columns(df, ["chance_of_admit"]).columns == ["chance_of_admit"]


def test_dedup_happens_on_text(spark):
    df = spark.createDataFrame([("4.5", None), ("4.50", None), ("4.5", None)], "a string, b string")
    assert clean.drop_duplicate_rows(df).count() == 2
    assert clean.duplicates_removed(df).first()["duplicadas"] == 1


def test_typing_reports_every_column_at_once(spark):
    df = spark.createDataFrame([("trescientos", "9", "2"), ("310", "4", "1"), (None, None, None)], "gre_score string, university_rating string, research string")
    with pytest.raises(ContractError) as error:
        clean.typed_or_error(df, adm.TYPING)
    assert {v.regla for v in error.value.violations} == {"valor_no_convertible", "categoria_invalida", "valor_no_booleano"}
    assert all(v.filas_afectadas == 1 for v in error.value.violations)


def test_category_text_is_exact(spark):
    df = spark.createDataFrame([("4.0",)], "university_rating string")
    with pytest.raises(ContractError):
        clean.typed_or_error(df, adm.TYPING)


def test_derived_and_nonlinear_values(spark):
    row = dict(gre_score=340.0, toefl_score=120.0, university_rating=5.0, sop=4.0, lor=5.0, cgpa=9.5, research=1.0)
    df = spark.createDataFrame([row]).withColumns(adm.derived_columns())
    got = clean.add_nonlinear(df, ["cgpa"], ["sop"], ["gre_score"]).first()
    assert got.indice_academico == pytest.approx((0.95 + 1 + 1) / 3)
    assert (got.sop_lor_media, got.rating_x_research) == (4.5, 5.0)
    assert (got.log_cgpa, got.sqrt_sop, got.gre_score_cuadrado) == (pytest.approx(math.log1p(9.5)), 2.0, 340.0**2)


def test_derived_null_propagates(spark):
    df = spark.createDataFrame([(None, 120.0, 9.0)], "gre_score double, toefl_score double, cgpa double")
    assert df.select(adm.derived_columns()["indice_academico"]).first()[0] is None


def test_feature_matrix_puts_target_last(spark):
    df = spark.createDataFrame([(True, "4", 900, 0.5)], "research boolean, university_rating string, gre_score int, chance_of_admit double")
    out = clean.feature_matrix(df, adm.TARGET, adm.DOMAINS)
    assert out.columns[-1] == adm.TARGET and set(dict(out.dtypes).values()) == {"double"}
    assert out.first().gre_score == 340.0
