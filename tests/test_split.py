import pytest
from pyspark.sql import functions as F

from tests.frames import COLUMNS, frame
from wardframe.operators import split
from wardframe.operators.contracts import ContractError

Y = "chance_of_admit"


@pytest.fixture(scope="module")
def parted(spark):
    return split.seeded_split(frame(spark, 200), "id", exact=True).persist()


def severity(check):
    return [r.severidad for r in check.collect()]


def test_exact_sizes_and_repeatable(spark):
    df = frame(spark, 471)
    one = split.seeded_split(df, "id", exact=True)
    assert one.where("split = 'test'").count() == 118
    again = split.seeded_split(df.repartition(5), "id", exact=True)
    assert one.where("split = 'test'").select("id").exceptAll(again.where("split = 'test'").select("id")).count() == 0
    other = split.seeded_split(df, "id", seed=7, exact=True)
    assert one.where("split = 'test'").select("id").exceptAll(other.where("split = 'test'").select("id")).count() > 0


def test_clean_split_passes(parted):
    assert severity(split.check_keys(parted, "id")) == ["ok"]
    assert severity(split.check_shared_rows(parted, COLUMNS)) == ["ok"]
    assert severity(split.check_sizes(parted)) == ["ok", "ok"]
    assert split.check_null_drift(parted, COLUMNS).count() == 0


def test_leaks(parted):
    test_as_train = parted.where("split = 'test'").withColumn("split", F.lit("train"))
    leaked = parted.unionByName(test_as_train)
    assert severity(split.check_keys(leaked, "id")) == ["error"]
    rekeyed = parted.unionByName(test_as_train.withColumn("id", F.col("id") + 1000))
    assert severity(split.check_keys(rekeyed, "id")) == ["ok"]
    assert severity(split.check_shared_rows(rekeyed, COLUMNS)) == ["error"]
    few = parted.unionByName(test_as_train.orderBy("id").limit(2).withColumn("id", F.col("id") + 1000))
    assert severity(split.check_shared_rows(few, COLUMNS)) == ["advertencia"]
    report = split.split_report(leaked, "id", Y, COLUMNS, domain=False)
    with pytest.raises(ContractError):
        split.split_gate(report)


def test_rows_with_a_null_never_match(spark):
    df = spark.createDataFrame([(1, None, "train"), (1, None, "test"), (2, 3, "train"), (2, 3, "test")], "a int, b int, split string")
    assert split.shared_rows(df, ["a", "b"]).first().compartidas == 1


def test_wrong_share_and_tiny_test(parted):
    assert severity(split.check_sizes(parted, 0.6))[0] == "advertencia"
    tiny = parted.where("split = 'train'").unionByName(parted.where("split = 'test'").limit(3))
    assert severity(split.check_sizes(tiny))[1] == "advertencia"


def test_drift_and_categories(parted):
    test = F.col("split") == "test"
    moved = parted.withColumn("cgpa", F.when(test, F.col("cgpa") + 2).otherwise(F.col("cgpa"))).withColumn(Y, F.when(test, F.col(Y) / 2).otherwise(F.col(Y)))
    found = {r.columna: r.severidad for r in split.check_column_drift(moved, COLUMNS).collect()}
    assert found["cgpa"] == "advertencia" and found["sop"] == "ok"
    assert severity(split.check_target_drift(moved, Y)) == ["advertencia"]
    new = parted.withColumn("university_rating", F.when(test & (F.col("id") % 2 == 0), 9.0).otherwise(F.col("university_rating")))
    assert severity(split.check_new_categories(new, ["university_rating", "research"])) == ["advertencia", "ok"]
    holes = parted.withColumn("lor", F.when(~test, F.col("lor")))
    assert [r.columna for r in split.check_null_drift(holes, COLUMNS).collect()] == ["lor"]


def test_domain_classifier(parted):
    assert split.domain_auc(parted, ["cgpa", "gre_score"], "id") < 0.65
    apart = parted.withColumn("cgpa", F.when(F.col("split") == "test", F.col("cgpa") + 5).otherwise(F.col("cgpa")))
    assert split.domain_auc(apart, ["cgpa", "gre_score"], "id") > 0.9
    assert split.domain_auc(parted.limit(20), ["cgpa"], "id") is None


def test_strict_gate_stops_on_warnings(parted):
    report = split.check_sizes(parted, 0.6)
    assert split.split_gate(report) is report
    with pytest.raises(ContractError):
        split.split_gate(report, strict=True)


def test_report_order(parted):
    names = [r.chequeo for r in split.split_report(parted, "id", Y, ["cgpa", "sop"], ["research"], domain=False).collect()]
    assert names == ["indices_solapados", "filas_compartidas", "proporcion_de_la_particion", "tamano_del_conjunto_de_prueba", "deriva_del_objetivo",
                     "deriva_de_la_variable", "deriva_de_la_variable", "categorias_nuevas_en_prueba"]


def test_folds_are_disjoint_and_cover(spark):
    df = frame(spark, 150)
    rows = split.repeated_kfold(df, "id", 5, 3).groupBy("repeticion").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"), F.count_distinct("fold").alias("f")).collect()
    assert [(r.n, r.d, r.f) for r in rows] == [(150, 150, 5)] * 3


def test_stratified_folds_are_even_within_groups(spark):
    got = split.stratified_kfold(frame(spark, 200), "id", Y).groupBy("grupo", "fold").count().collect()
    assert len(got) == 20 and {r["count"] for r in got} == {10}


def test_time_series_blocks(spark):
    df = spark.range(23).withColumnRenamed("id", "k").withColumn("t", F.col("k") % 4)
    blocks = split.time_series_folds(df, "t", "k", 5)
    sizes = {r.bloque: r["count"] for r in blocks.groupBy("bloque").count().collect()}
    assert sizes == {0: 8, 1: 3, 2: 3, 3: 3, 4: 3, 5: 3}
    order = [r.bloque for r in blocks.orderBy("t", "k").collect()]
    assert order == sorted(order)
