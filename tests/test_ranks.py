"""Refined histograms (``leaf`` 0: down to single values) and running counts agree with plain numpy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardframe.operators import ranks


def long_frame(spark, values):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "k int, x double")


@pytest.mark.parametrize("leaf", [0, 10, 10**6])
@pytest.mark.parametrize("values", [[1, 2, 3, 4], [5], [2] * 30 + [1, 9, 9, None], list(range(101)) + [50] * 60])
def test_quantiles(spark, values, leaf):
    got = ranks.exact_quantiles(long_frame(spark, values), ["x"], [0, 0.25, 1 / 3, 0.5, 0.9, 1], leaf)["x"]
    want = np.quantile([v for v in values if v is not None], [0, 0.25, 1 / 3, 0.5, 0.9, 1])
    assert got == pytest.approx(list(want))


@pytest.mark.parametrize("leaf", [0, 50])
def test_quantiles_of_uneven_values(spark, leaf):
    """Outliers, both signs, subnormal numbers, a hot value and millions apart by one bit."""
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(0, 40, 400), -rng.lognormal(0, 40, 300), np.full(250, 1e16), 1e16 + 2.0 * np.arange(60), [0.0, -0.0, 5e-324, 1e300, -1e300]])
    got = ranks.exact_quantiles(long_frame(spark, values), ["x"], [0, 0.01, 0.3, 0.5, 0.77, 0.99, 1], leaf)["x"]
    assert got == pytest.approx(list(np.quantile(values, [0, 0.01, 0.3, 0.5, 0.77, 0.99, 1])), rel=1e-12)


def test_a_histogram_exchanges_bins_not_rows(spark):
    rows = spark.range(200_000).select(F.lit("x").alias("g"), (F.rand(3) * 1000 - 300).alias("v"))
    assert ranks.first_histogram(rows, ["g"], "v").count() < 1000


@pytest.mark.parametrize("leaf", [0, 4])
@pytest.mark.parametrize("kind", ["bigint", "string", "date", "timestamp", "decimal(30,2)"])
def test_values_at_ranks_of_any_type(spark, leaf, kind):
    base = spark.range(60).withColumn("g", F.when(F.col("id") % 3 > 0, F.col("id") % 3))  # a null group too
    made = {"bigint": "9007199254740992 + id * id % 50", "string": "concat('common prefix ', repeat('x', int(id % 4)), char(int(97 + id % 5)), id div 20)",
            "date": "date_add(date'2020-01-01', int(id * 7 % 90))", "timestamp": "timestamp'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 60 / 1000)",
            "decimal(30,2)": "cast(12345678901234567890123456 + id % 7 as decimal(30,2))"}[kind]
    rows = base.select("g", F.expr(made).alias("v")).cache()
    _, got = ranks.values_at(rows, "g", "v", lambda g, n: range(1, n + 1), leaf)
    for g in (None, 1, 2):
        values = sorted(r.v for r in rows.where(F.col("g").eqNullSafe(F.lit(g))).collect())
        for rank, v in enumerate(values, 1):
            assert got[g, rank] == (v, values.index(v), values.count(v))


def test_quantiles_of_an_empty_column(spark):
    assert ranks.exact_quantiles(long_frame(spark, [None, None]), ["x"], [0.5])["x"] == [None]


def average_ranks(v):
    v = np.asarray(v)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


@pytest.mark.parametrize("small_rows", [0, 10**6])
def test_spearman_with_ties_and_a_hot_value(spark, small_rows):
    rng = np.random.default_rng(1)
    x = np.where(rng.random(300) < 0.4, 7.0, rng.integers(0, 20, 300))
    y = x + rng.integers(0, 6, 300)
    df = spark.createDataFrame(list(zip(map(float, x), map(float, y), strict=True)), "x double, y double")
    want = np.corrcoef(average_ranks(x), average_ranks(y))[0, 1]
    assert ranks.spearman(df, "x", "y", small_rows=small_rows).first().spearman == pytest.approx(want)


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "x double, y double")
    assert ranks.spearman(df, "x", "y").first().spearman is None


def test_two_sample_statistic(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, 150).round(1), rng.normal(0.4, 1, 90).round(1)
    df = spark.createDataFrame([(float(v), False) for v in a] + [(float(v), True) for v in b], "x double, t boolean")
    grid = np.unique(np.r_[a, b])
    want = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    got = ranks.kolmogorov_smirnov(df, ["x"], F.col("t")).first().statistic
    assert got == pytest.approx(want)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4), min_size=3, max_size=40), st.integers(2, 4))
def test_quantile_groups_follow_the_rank_rule(spark, values, groups):
    df = spark.createDataFrame([(0, float(v), i) for i, v in enumerate(values)], "g int, value double, tie int")
    cuts = ranks.rank_cuts(df, "g", "value", "tie", ranks.quantile_group_ranks(groups))[0]
    got = {r.tie: r.n for r in df.select("tie", ranks.group_number(cuts, F.col("value"), F.col("tie")).alias("n")).collect()}
    n = len(values)
    order = sorted(range(n), key=lambda i: (values[i], i))
    want = {i: max(0, -(-(r * groups) // (n - 1)) - 1) for r, i in enumerate(order)}
    assert got == want


def test_index_is_gap_free_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    first = {r.k: r._index for r in ranks.hash_indexed(df, "k").collect()}
    again = {r.k: r._index for r in ranks.hash_indexed(df.repartition(7), "k").collect()}
    assert sorted(first.values()) == list(range(1000)) and first == again


def test_skew_safe_lookup_splits_hot_keys(spark):
    big = spark.createDataFrame([(1, i) for i in range(500)] + [(2 + i % 100, i) for i in range(500)], "k int, v int")
    lookup = big.groupBy("k").agg(F.count("*").alias("w")).withColumn("name", F.col("k") * 10)
    got = ranks.skew_safe_lookup(big, lookup, ["k"], "w", 1000, small_rows=0)
    assert got.count() == 1000 and got.where("name = k * 10").count() == 1000
