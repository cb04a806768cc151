"""Profiles and association (E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FRAME, NUMERIC, TARGET, order_frame, query, rounded, rsql, sql_hash, table, written
from catalog.cleaning import DIRTY, NAMES, UNIFIED, dirty, unified
from wardframe.operators import association as asso
from wardframe.operators import clean, evaluate, prep, profile, sketches
from wardframe.operators.models import fit_constant

_COLS = ["quantity", "flag", "open"]


def _each(template: str, names) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in names)


@query("e1_column_inventory", _each(f"""SELECT '{{c}}' AS columna, 'string' AS tipo, count(DISTINCT {{c}}) AS distintos,
count(*) FILTER ({{c}} IS NULL OR trim({{c}}) = '') AS vacios, round(100.0 * count(*) FILTER ({{c}} IS NULL OR trim({{c}}) = '') / count(*), 2) AS pct_vacios,
(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT {{c}} AS v FROM {UNIFIED} AS u WHERE {{c}} IS NOT NULL ORDER BY v LIMIT 4) AS d) AS ejemplos FROM {UNIFIED} AS u""", _COLS))
def e1(spark, sf):
    return profile.column_inventory(unified(spark, sf), _COLS)


@query("e2_data_sheet", _each(f"SELECT '{{c}}' AS columna, {{t}} AS tipo, count(*) FILTER ({{c}} IS NULL) AS nulos, round(100.0 * count(*) FILTER ({{c}} IS NULL) / count(*), 2) AS pct_nulos, count(DISTINCT {{c}}) AS distintos FROM {FRAME} AS f", ["quantity", "level", "open"])
       .replace("'quantity' AS columna, {t}", "'quantity' AS columna, 'double'").replace("'level' AS columna, {t}", "'level' AS columna, 'string'").replace("'open' AS columna, {t}", "'open' AS columna, 'boolean'"))
def e2(spark, sf):
    return profile.data_sheet(order_frame(spark, sf), ["quantity", "level", "open"])


_PROFILE = """SELECT '{c}' AS columna, count({c}) AS n, avg({c}) AS media, median({c}) AS mediana,
(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS moda, min({c}) AS minimo, max({c}) AS maximo, max({c}) - min({c}) AS rango,
quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr, var_samp({c}) AS varianza, stddev_samp({c}) AS desv_estandar,
100 * stddev_samp({c}) / avg({c}) AS coef_variacion_pct, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis_exceso,
(SELECT count(*) FROM {src} WHERE {c} < (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {src})
 OR {c} > (SELECT quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {src})) AS n_atipicos_iqr FROM {src}"""


@query("e3_numeric_profile", rsql(_each(_PROFILE.replace("{src}", f"{FRAME} AS f"), ["quantity", "target", "discount"]), "media", "mediana", "moda", "minimo", "maximo", "rango", "q1", "q3", "iqr", "varianza", "desv_estandar", "coef_variacion_pct", "skewness", "kurtosis_exceso", digits=3))
def e3(spark, sf):
    return profile.numeric_profile(written(order_frame(spark, sf)), ["quantity", "target", "discount"])


_SKETCHED = ("l_quantity", "l_extendedprice", "l_orderkey", "l_returnflag")


@query("e3_sketched_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count({c}) AS n, count(*) - count({c}) AS nulos, {f'CAST(min({c}) AS DOUBLE)' if c != 'l_returnflag' else 'CAST(NULL AS DOUBLE)'} AS minimo, "
    f"{f'CAST(max({c}) AS DOUBLE)' if c != 'l_returnflag' else 'CAST(NULL AS DOUBLE)'} AS maximo, true AS distintos_en_cota, true AS rangos_en_cota FROM lineitem" for c in _SKETCHED))
def e3s(spark, sf):
    """Sketches of batches, merged; the estimates are held against exact counts of the same rows."""
    rows, shares = table(spark, sf, "lineitem"), {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    batches = [F.coalesce(F.col("l_returnflag") == "A", F.lit(False)), ~F.coalesce(F.col("l_returnflag") == "A", F.lit(False))]
    both = written(sketches.merged(*[sketches.column_sketches(rows.where(b), _SKETCHED) for b in batches]))
    found = {r["columna"]: r for r in sketches.sketched_quantiles(both, shares).collect()}  # one row per column
    near, limit = 4 * sketches.distinct_error(), 2 * sketches.rank_error()
    exact = []
    for c in _SKETCHED:
        inside = [F.lit(True)]
        for name, p in shares.items():
            q = found[c][name]
            if q is not None:
                inside.append((F.count_if(F.col(c) < q) <= (p + limit) * F.count(c)) & (F.count_if(F.col(c) <= q) >= (p - limit) * F.count(c)))
        ranks = inside[0]
        for test in inside[1:]:
            ranks = ranks & test
        exact.append(F.struct(F.lit(c).alias("columna"), F.count_distinct(c).alias("d"), ranks.alias("rangos_en_cota")))
    truth = rows.agg(F.array(*exact).alias("t")).select(F.inline("t"))
    sheet = sketches.sketched_sheet(both)
    return sheet.join(truth, "columna").select(
        "columna", "n", "nulos", "minimo", "maximo", (F.abs(F.col("distintos") - F.col("d")) <= near * F.col("d")).alias("distintos_en_cota"), "rangos_en_cota")


@query("e4_outlier_flag", f"""WITH f AS (SELECT * FROM {FRAME} AS x), q AS (SELECT quantile_cont(quantity, 0.25) AS a, quantile_cont(quantity, 0.75) AS b, quantile_cont(target, 0.25) AS c, quantile_cont(target, 0.75) AS d FROM f)
SELECT coalesce(quantity < a - 1.5 * (b - a) OR quantity > b + 1.5 * (b - a), false) OR target < c - 1.5 * (d - c) OR target > d + 1.5 * (d - c) AS atipico, count(*) AS n FROM f, q GROUP BY 1""")
def e4(spark, sf):
    return profile.flag_outliers(order_frame(spark, sf), ["quantity", "target"]).groupBy("atipico").agg(F.count("*").alias("n"))


_POWERS = " UNION ALL ".join(f"""SELECT '{c}' AS columna, count({c})::DOUBLE AS n, avg(({c} - m) ** 2) AS m2, avg(({c} - m) ** 3) AS m3, avg(({c} - m) ** 4) AS m4
FROM (SELECT {c}, avg({c}) OVER () AS m FROM {FRAME} AS f) AS s""" for c in ("quantity", "discount", "target"))
_K2 = f"""WITH p AS ({_POWERS}), g AS (SELECT columna, n, m3 / m2 ** 1.5 AS g, m4 / m2 ** 2 AS b FROM p),
a AS (SELECT *, g * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, -1 + sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) AS w,
(b - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x,
6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS s FROM g),
z AS (SELECT columna, n, y / sqrt(2 / (w - 1)) AS t, 1 / sqrt(0.5 * ln(w)) AS d, x, 6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) AS h FROM a),
k AS (SELECT columna, n, (d * ln(t + sqrt(t * t + 1))) ** 2 + (((1 - 2 / (9 * h)) - cbrt((1 - 2 / h) / (1 + x * sqrt(2 / (h - 4))))) / sqrt(2 / (9 * h))) ** 2 AS k2 FROM z)
SELECT columna, CAST(n AS BIGINT) AS n, k2, exp(-k2 / 2) AS p_valor, exp(-k2 / 2) <= 0.05 AS rechaza FROM k"""


@query("e5_normality", rsql(_K2, "k2", "p_valor", digits=5))
def e5(spark, sf):
    return rounded(profile.normality_test(order_frame(spark, sf), ["quantity", "discount", "target"]), 5)


@query("e6_frequency_table", rsql(f"SELECT level AS nivel, count(*) AS n, CASE WHEN level IS NOT NULL THEN 100.0 * count(*) / (SELECT count(level) FROM {FRAME} AS g) END AS pct FROM {FRAME} AS f GROUP BY level", "pct"))
def e6(spark, sf):
    return rounded(profile.frequency_table(order_frame(spark, sf), "level"))


_DESCRIBE = _each("SELECT '{c}' AS columna, '{v}' AS version, count({c}) AS n, avg({c}) AS media, stddev_samp({c}) AS desv_estandar, min({c}) AS minimo, max({c}) AS maximo FROM {src}", ["discount", "tax"])


@query("e7_describe", rsql(f"""WITH f AS (SELECT discount, tax FROM {FRAME} AS x),
st AS (SELECT (discount - (SELECT avg(discount) FROM f)) / (SELECT stddev_pop(discount) FROM f) AS discount, (tax - (SELECT avg(tax) FROM f)) / (SELECT stddev_pop(tax) FROM f) AS tax FROM f),
mm AS (SELECT (discount - (SELECT min(discount) FROM f)) / (SELECT max(discount) - min(discount) FROM f) AS discount, (tax - (SELECT min(tax) FROM f)) / (SELECT max(tax) - min(tax) FROM f) AS tax FROM f)
{_DESCRIBE.replace('{v}', 'original').replace('{src}', 'f')} UNION ALL {_DESCRIBE.replace('{v}', 'estandar').replace('{src}', 'st')} UNION ALL {_DESCRIBE.replace('{v}', 'minmax').replace('{src}', 'mm')}""", "media", "desv_estandar", "minimo", "maximo"))
def e7(spark, sf):
    frame, cols = order_frame(spark, sf), ["discount", "tax"]
    versions = {"original": frame, "estandar": prep.rescale(frame, prep.standard_scales(frame, cols)), "minmax": prep.rescale(frame, prep.min_max_scales(frame, cols))}
    parts = [profile.describe(v, cols).withColumn("version", F.lit(name)) for name, v in versions.items()]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("e8_null_overview", f"""SELECT count(*) AS filas, CAST(sum(m) AS BIGINT) AS celdas_nulas, count(*) FILTER (m > 0) AS filas_con_nulos, count(*) FILTER (m = 3) AS filas_todo_nulo
FROM (SELECT (quantity IS NULL)::INTEGER + (level IS NULL)::INTEGER + (open IS NULL)::INTEGER AS m FROM {FRAME} AS f) AS t""")
def e8(spark, sf):
    return profile.null_overview(order_frame(spark, sf), ["quantity", "level", "open"])


@query("e8_nulls_before_after", _each(f"SELECT '{{c}}' AS columna, (SELECT count(*) FILTER ({{c}} IS NULL) FROM {DIRTY} AS d) AS nulos_antes, (SELECT count(*) FILTER ({{c}} IS NULL) FROM {UNIFIED} AS u) AS nulos_despues", NAMES))
def e8b(spark, sf):
    return profile.nulls_before_after(clean.normalise_names(dirty(spark, sf)), unified(spark, sf), NAMES)


@query("e9_duplicates_by_projection", f"SELECT 'tres' AS atributos, count(*) - count(DISTINCT (quantity, level, open)) AS repetidas FROM {FRAME} AS f UNION ALL SELECT 'dos', count(*) - count(DISTINCT (level, open)) FROM {FRAME} AS f")
def e9(spark, sf):
    return profile.duplicates_by_projection(order_frame(spark, sf), {"tres": ["quantity", "level", "open"], "dos": ["level", "open"]})


_MISS = """SELECT '{c}' AS columna, count(*) FILTER ({c} IS NULL) AS n_nulos, 100.0 * count(*) FILTER ({c} IS NULL) / count(*) AS pct_nulos,
avg(target) FILTER ({c} IS NULL) AS target_medio_con_nulo, avg(target) FILTER ({c} IS NOT NULL) AS target_medio_sin_nulo,
(avg(target) FILTER ({c} IS NULL) - avg(target) FILTER ({c} IS NOT NULL)) / sqrt(var_samp(target) FILTER ({c} IS NULL) / count(*) FILTER ({c} IS NULL) + var_samp(target) FILTER ({c} IS NOT NULL) / count(*) FILTER ({c} IS NOT NULL)) AS t
FROM """ + FRAME + " AS f"


@query("e10_missingness", rsql(_each(_MISS, ["quantity", "level", "open"]), "pct_nulos", "target_medio_con_nulo", "target_medio_sin_nulo", "t"))
def e10(spark, sf):
    return rounded(profile.missingness_diagnosis(order_frame(spark, sf), ["quantity", "level", "open", "tax"], TARGET).drop("gl"))


@query("e11_seeded_sample", f"SELECT o_orderkey FROM orders ORDER BY {sql_hash('o_orderkey', 'sample')}, o_orderkey LIMIT 20")
def e11(spark, sf):
    return profile.seeded_sample(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 20)


@query("e11_head", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10")
def e11h(spark, sf):
    return profile.head(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 10)


# --- F ------------------------------------------------------------------------------------


@query("f1_pearson", rsql(_each(f"""SELECT '{{c}}' AS columna, regr_count(target, {{c}})::BIGINT AS n, corr({{c}}, target) AS pearson, regr_slope(target, {{c}}) AS pendiente,
regr_intercept(target, {{c}}) AS intercepto FROM {FRAME} AS f""", NUMERIC), "pearson", "pendiente", "intercepto"))
def f1(spark, sf):
    return rounded(asso.pearson_with_target(order_frame(spark, sf), NUMERIC, TARGET).drop("t"))


def _ranked(c: str, src: str, y: str = "target") -> str:
    return f"""SELECT '{c}' AS columna, count(*) AS n, corr(rx, ry) AS spearman FROM (
SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
FROM (SELECT CAST({c} AS DOUBLE) AS x, {y} AS y FROM {src} AS f WHERE {c} IS NOT NULL) AS p) AS r"""


_SPEARMAN = " UNION ALL ".join(_ranked(c, FRAME) for c in [*NUMERIC, "level"])


@query("f2_spearman", rsql(_SPEARMAN, "spearman"))
def f2(spark, sf):
    return rounded(asso.spearman_with_target(order_frame(spark, sf), [*NUMERIC, "level"], TARGET))


@query("f3_target_by_level", rsql(f"SELECT level AS nivel, count(*) AS n, avg(target) AS media, median(target) AS mediana, stddev_samp(target) AS desv_estandar FROM {FRAME} AS f WHERE level IS NOT NULL GROUP BY level", "media", "mediana", "desv_estandar"))
def f3(spark, sf):
    return rounded(asso.target_by_level(order_frame(spark, sf), "level", TARGET))


_YES, _NO = "FILTER (open)", "FILTER (NOT open)"


@query("f4_welch_cohen", rsql(f"""SELECT count(target) {_YES} AS n1, count(target) {_NO} AS n0, avg(target) {_YES} - avg(target) {_NO} AS diferencia,
(avg(target) {_YES} - avg(target) {_NO}) / sqrt(var_samp(target) {_YES} / count(*) {_YES} + var_samp(target) {_NO} / count(*) {_NO}) AS t,
(avg(target) {_YES} - avg(target) {_NO}) / sqrt((var_samp(target) {_YES} + var_samp(target) {_NO}) / 2) AS d FROM {FRAME} AS f""", "diferencia", "t", "d"))
def f4(spark, sf):
    return rounded(asso.welch_and_cohen(order_frame(spark, sf), "open", TARGET).drop("gl"))


@query("f5_point_biserial", rsql(f"SELECT 'open' AS columna, count(open) AS n, corr(open::INTEGER, target) AS biserial FROM {FRAME} AS f", "biserial"))
def f5(spark, sf):
    return rounded(asso.point_biserial(order_frame(spark, sf), ["open"], TARGET))


@query("f6_association_ranking", rsql(f"SELECT columna, abs(spearman) AS asociacion FROM ({_SPEARMAN}) AS s UNION ALL SELECT 'open', abs(corr(open::INTEGER, target)) FROM {FRAME} AS f", "asociacion"))
def f6(spark, sf):
    return rounded(asso.association_ranking(order_frame(spark, sf), [*NUMERIC, "level"], ["open"], TARGET))


_PAIRS = [("quantity", "discount"), ("quantity", "tax"), ("quantity", "target"), ("discount", "tax"), ("discount", "target"), ("tax", "target")]
_MATRIX = " UNION ALL ".join(f"SELECT '{a}' AS columna_a, '{b}' AS columna_b, corr({a}, {b}) AS pearson FROM {FRAME} AS f" for a, b in _PAIRS)


@query("f7_correlation_matrix", rsql(_MATRIX, "pearson"))
def f7(spark, sf):
    return rounded(asso.correlation_matrix(order_frame(spark, sf), [*NUMERIC, TARGET]))


@query("f7_redundant_pairs", rsql(f"SELECT * FROM ({_MATRIX}) AS m WHERE abs(pearson) > 0.8", "pearson", digits=3))
def f7r(spark, sf):
    return asso.redundant_pairs(order_frame(spark, sf), [*NUMERIC, TARGET])


_CELLS = """(SELECT a.l AS a, b.s AS b, (SELECT count(*) FROM orders WHERE o_orderpriority = a.l AND o_orderstatus = b.s) AS n
FROM (SELECT DISTINCT o_orderpriority AS l FROM orders) AS a, (SELECT DISTINCT o_orderstatus AS s FROM orders) AS b)"""


@query("f8_contingency", rsql(f"SELECT a, b, n, 100.0 * n / sum(n) OVER (PARTITION BY a) AS pct_fila FROM {_CELLS} AS c", "pct_fila"))
def f8(spark, sf):
    return rounded(asso.contingency(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"))


@query("f9_chi_square", rsql(f"""SELECT n, 5::BIGINT AS filas, 3::BIGINT AS columnas, chi2, 8::BIGINT AS gl, sqrt(chi2 / (n * 2)) AS v_cramer FROM (
SELECT CAST(sum(n) AS BIGINT) AS n, sum((n - e) * (n - e) / e) AS chi2 FROM (
SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b)::DOUBLE / sum(n) OVER () AS e FROM {_CELLS} AS c) AS m) AS t""", "chi2", "v_cramer"))
def f9(spark, sf):
    return rounded(asso.chi_square(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"))


# with 8 degrees of freedom the tail is a finite sum
_CHI_P = f"""SELECT chi2, gl, exp(-chi2 / 2) * (1 + chi2 / 2 + (chi2 / 2) ** 2 / 2 + (chi2 / 2) ** 3 / 6) AS p_valor FROM (
SELECT sum((n - e) * (n - e) / e) AS chi2, 8::BIGINT AS gl FROM (
SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b)::DOUBLE / sum(n) OVER () AS e FROM {_CELLS} AS c) AS m) AS t"""


@query("f9_chi_square_p", rsql(_CHI_P, "chi2", "p_valor"))
def f9p(spark, sf):
    return rounded(asso.chi_square_test(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus").select("chi2", "gl", "p_valor"))


@query("f10_means_by_level", rsql(f"SELECT level, avg(quantity) AS quantity, avg(discount) AS discount, avg(target) AS target FROM {FRAME} AS f WHERE level IS NOT NULL GROUP BY level", "quantity", "discount", "target", digits=2))
def f10(spark, sf):
    return asso.means_by_level(order_frame(spark, sf), "level", ["quantity", "discount", "target"])


@query("f11_vif_of_two", rsql(f"""WITH r AS (SELECT corr(quantity, tax) ** 2 AS r2 FROM {FRAME} AS f WHERE quantity IS NOT NULL)
SELECT v AS variable, r2 AS r2_contra_las_demas, 1 / (1 - r2) AS vif FROM r, (VALUES ('quantity'), ('tax')) AS n(v)""", "r2_contra_las_demas", "vif", digits=4))
def f11two(spark, sf):
    return rounded(asso.variance_inflation(order_frame(spark, sf), ["quantity", "tax"], decimals=9), 4)


@query("f11_vif")
def f11(spark, sf):
    rows = order_frame(spark, sf).withColumn("mezcla", F.col("quantity") + 300 * F.col("tax") + 10 * F.col("target"))
    return asso.variance_inflation(rows, ["quantity", "discount", "tax", "mezcla"])


@query("f12_two_key_effect", rsql(f"""SELECT level AS nivel, avg(target) {_NO} AS media_false, count(target) {_NO} AS n_false, avg(target) {_YES} AS media_true, count(target) {_YES} AS n_true,
avg(target) {_YES} - avg(target) {_NO} AS brecha FROM {FRAME} AS f WHERE level IS NOT NULL GROUP BY level""", "media_false", "media_true", "brecha"))
def f12(spark, sf):
    return rounded(asso.two_key_effect(order_frame(spark, sf), "level", "open", TARGET))


_FOLD = f"{sql_hash('key', 'fold42r1')} % 5"


@query("f13_paired_comparison", rsql(f"""WITH d AS (SELECT fold, avg(abs(target - 0.5)) - avg(abs(target - 0.6)) AS d FROM (SELECT *, {_FOLD} AS fold FROM {FRAME} AS f) AS t GROUP BY fold)
SELECT count(*) AS n, avg(d) AS diferencia_media, stddev_pop(d) AS desviacion, avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t FROM d""", "diferencia_media", "desviacion", "t"))
def f13(spark, sf):
    frame = order_frame(spark, sf)
    def scores(value):
        predictions = evaluate.fold_predictions(frame, lambda df: fit_constant(df, TARGET, "constant", value), "kfold", "key", TARGET)
        return evaluate.regression_metrics(predictions.where("rol = 'validacion'"), "y", by=["fold"], ranks=False)
    return rounded(asso.paired_comparison(scores(0.5), scores(0.6), ["fold"], "MAE"))


