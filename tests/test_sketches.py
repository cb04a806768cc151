"""Sketched profiles: exact parts, measured errors, and batches against the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.operators import sketches as sk

SHARES = {"p05": 0.05, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    x = F.when(F.col("id") % 10 < 3, F.lit(7.0)).otherwise((F.xxhash64("id") % 100_003).cast("double"))
    word = F.when(F.col("id") % 4 > 0, F.concat(F.lit("w"), F.col("id") % 9000))
    return spark.range(60_000).select("id", x.alias("x"), word.alias("word"))


def batches(rows):
    cuts = [F.col("id") < 1000, (F.col("id") >= 1000) & (F.col("id") < 25_000), F.col("id") >= 25_000]
    return sk.merged(*[sk.column_sketches(rows.where(c)) for c in cuts])


@pytest.mark.parametrize("parted", [False, True])
def test_errors_stay_in_their_bounds(rows, parted):
    found = batches(rows) if parted else sk.column_sketches(rows)
    sheet = {r.columna: r for r in sk.sketched_sheet(found).collect()}
    frame = rows.toPandas()
    assert (sheet["word"].n, sheet["word"].nulos) == (45_000, 15_000) and sheet["word"].media is None
    assert sheet["x"].media == pytest.approx(frame["x"].mean()) and (sheet["x"].minimo, sheet["x"].maximo) == (frame["x"].min(), frame["x"].max())
    for c in frame:
        assert abs(sheet[c].distintos / frame[c].nunique() - 1) < 4 * sk.distinct_error()
    for row in sk.sketched_quantiles(found, SHARES).collect():
        if row.columna == "word":
            assert all(row[name] is None for name in SHARES)
            continue
        values = np.sort(frame[row.columna].to_numpy(float))
        for name, p in SHARES.items():
            low, high = (np.searchsorted(values, row[name], side) / len(values) for side in ("left", "right"))
            assert low - 2 * sk.rank_error() <= p <= high + 2 * sk.rank_error()


def test_batches_give_the_whole(rows):
    exact = ["columna", "n", "nulos", "minimo", "maximo"]
    whole, parts = sk.column_sketches(rows), batches(rows)
    assert sorted(map(tuple, whole.select(exact).collect())) == sorted(map(tuple, parts.select(exact).collect()))
    again = sk.merged(whole, whole)  # the same values once more: twice the rows, no new values
    once, twice = ({r.columna: r for r in sk.sketched_sheet(s).collect()} for s in (sk.merged(whole, whole.limit(0)), again))
    for c in once:
        assert twice[c].n == 2 * once[c].n and abs(twice[c].distintos / once[c].distintos - 1) < 2 * sk.distinct_error()


def test_stored_sketches_are_read_back(spark, rows, tmp_path):
    path = f"{tmp_path}/s"
    sk.column_sketches(rows.where("id < 30000")).write.parquet(path)
    found = sk.merged(spark.read.parquet(path), sk.column_sketches(rows.where("id >= 30000")))
    assert {r.columna: r.n for r in found.collect()} == {"id": 60_000, "x": 60_000, "word": 45_000}


def test_empty_tables_nulls_and_few_rows(spark):
    few = spark.createDataFrame([(1.0, "a", True), (float("nan"), None, False), (3.0, "a", None)], "x double, t string, b boolean")
    for found in (sk.column_sketches(few), sk.merged(sk.column_sketches(few.limit(0)), sk.column_sketches(few))):
        sheet = {r.columna: (r.n, r.nulos, r.distintos) for r in sk.sketched_sheet(found).collect()}
        assert sheet == {"x": (2, 1, 2), "t": (2, 1, 1), "b": (2, 1, 2)}
        assert {r.columna: r.q for r in sk.sketched_quantiles(found, {"q": 1.0}).collect()} == {"x": 3.0, "t": None, "b": 1.0}
    nothing = sk.column_sketches(few.limit(0))
    assert all(r.n == 0 and r.distintos == 0 for r in sk.sketched_sheet(nothing).collect())
    assert all(r.q is None for r in sk.sketched_quantiles(nothing, {"q": 0.5}).collect())
