"""Models and evaluation (H, I)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import (
    FRAME, SCORE, SCORE_DOMAINS, TARGET, heuristic_scored, order_frame, query, rounded, rsql, scored_cte, sql_hash, table, written,
)
from catalog.splitting import PLAN, SPLIT_FRAME, sides
from wardframe.operators import evaluate, models, split
from wardframe.operators.prep import PrepPlan


def score_column():
    return F.expr(models.heuristic_sql(SCORE_DOMAINS, list(SCORE_DOMAINS)))


# --- H ------------------------------------------------------------------------------------

_T, _E = f"(SELECT * FROM {SPLIT_FRAME} AS p WHERE split = 'train')", f"(SELECT * FROM {SPLIT_FRAME} AS p WHERE split = 'test')"


@query("h1_constant_model", rsql(f"""SELECT 'mean' AS modelo, count(*) AS n, avg(abs(target - (SELECT avg(target) FROM {_T} AS a))) AS mae FROM {_E} AS b
UNION ALL SELECT 'median', count(*), avg(abs(target - (SELECT median(target) FROM {_T} AS a))) FROM {_E} AS b
UNION ALL SELECT 'constant', count(*), avg(abs(target - 0.5)) FROM {_E} AS b""", "mae"))
def h1(spark, sf):
    train, test = sides(spark, sf)
    parts = [models.fit_constant(train, TARGET, kind, 0.5).transform(test).agg(
        F.lit(kind).alias("modelo"), F.count("*").alias("n"), F.avg(F.abs(F.col(TARGET) - F.col("prediction"))).alias("mae")) for kind in ("mean", "median", "constant")]
    return rounded(reduce(DataFrame.unionByName, parts))


@query("h2_heuristic_score", rsql(f"SELECT key, {SCORE} AS score FROM {FRAME} AS f", "score", digits=8))
def h2(spark, sf):
    return rounded(order_frame(spark, sf).select("key", score_column().alias("score")), 8)


@query("h2_unreadable_text", rsql(f"""SELECT key, {SCORE.replace("(CAST(level AS DOUBLE)", "(CAST(CASE WHEN key % 7 <> 0 THEN level END AS DOUBLE)").replace("(level IS NOT NULL)", "(level IS NOT NULL AND key % 7 <> 0)")} AS score FROM {FRAME} AS f""", "score", digits=8))
def h2text(spark, sf):
    """A level that is no number counts as unknown."""
    rows = order_frame(spark, sf).withColumn("level", F.when(F.col("key") % 7 != 0, F.col("level")).otherwise(F.lit("nuevo")))
    return rounded(rows.select("key", F.expr(models.heuristic_sql(SCORE_DOMAINS, dict(rows.dtypes))).alias("score")), 8)


@query("h3_recalibrated_heuristic", rsql(scored_cte() + "SELECT key, prediction FROM s", "prediction", digits=9))
def h3(spark, sf):
    return rounded(heuristic_scored(spark, sf).select("key", "prediction"), 9)


@query("h4_ridge")
def h4(spark, sf):
    train, test = sides(spark, sf)
    scored = models.fit_linear(train, TARGET, PLAN, 1.0).transform(test)
    return evaluate.regression_metrics(scored, TARGET)


_Q = "coalesce(quantity, m)"


# scaled to unit deviation, a penalty of 1 divides the slope by 1 + 1/n
@query("h4_ridge_one_predictor", rsql(f"""WITH m AS (SELECT median(quantity) AS m FROM {_T} AS a),
l AS (SELECT regr_slope(target, {_Q}) * count(*) / (count(*) + 1.0) AS b, avg({_Q}) AS x, avg(target) AS y FROM {_T} AS t, m)
SELECT key, y + b * ({_Q} - x) AS prediction FROM {_E} AS e, m, l""", "prediction", digits=8))
def h4one(spark, sf):
    train, test = sides(spark, sf)
    return rounded(models.fit_linear(train, TARGET, PrepPlan(numeric=("quantity",)), 1.0).transform(test).select("key", "prediction"), 8)


@query("h5_linear_single", rsql(f"""WITH m AS (SELECT median(quantity) AS m FROM {_T} AS a), l AS (SELECT regr_intercept(target, {_Q}) AS a, regr_slope(target, {_Q}) AS b FROM {_T} AS t, m)
SELECT key, a + b * {_Q} AS prediction FROM {_E} AS e, m, l""", "prediction"))
def h5(spark, sf):
    train, test = sides(spark, sf)
    model = models.fit_linear(train, TARGET, PrepPlan(numeric=("quantity",)))
    return rounded(model.transform(test).select("key", "prediction"))


@query("h5_linear_many")
def h5m(spark, sf):
    train, test = sides(spark, sf)
    return evaluate.regression_metrics(models.fit_linear(train, TARGET, PLAN).transform(test), TARGET)


@query("h6_tree_ensemble")
def h6(spark, sf):
    train, test = sides(spark, sf)
    scored = models.fit_trees(train, TARGET, PLAN, models.forest()).transform(test)
    return evaluate.regression_metrics(scored, TARGET)


@query("h7_model_search")
def h7(spark, sf):
    train, _ = sides(spark, sf)
    return models.search(train, TARGET, PLAN, "key", budget=None)[1]


# --- I ------------------------------------------------------------------------------------

EPS = "2.220446049250313e-16"


def metrics_sql(source: str, by: str = "", y: str = "target", p: str = "prediction") -> str:
    """Metrics per group of a source; Spearman by average ranks within the group."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}count(*) AS n, avg(abs(y - p)) AS MAE, sqrt(avg((y - p) * (y - p))) AS RMSE, 1 - avg((y - p) * (y - p)) / var_pop(y) AS R2,
avg(abs(y - p) / greatest(abs(y), {EPS})) AS MAPE, CASE WHEN max(p) > min(p) THEN corr(ry, rp) END AS spearman FROM (
SELECT {keys}y, p, rank() OVER ({part}ORDER BY y) + (count(*) OVER (PARTITION BY {keys}y) - 1) / 2.0 AS ry, rank() OVER ({part}ORDER BY p) + (count(*) OVER (PARTITION BY {keys}p) - 1) / 2.0 AS rp
FROM (SELECT {keys}{y} AS y, {p} AS p FROM {source} AS src) AS v) AS r {group}"""


_M = ("MAE", "RMSE", "R2", "MAPE", "spearman")
_SCORED = f"({scored_cte()} SELECT * FROM s)"
_DUMMY = f"(SELECT key, target, (SELECT round(avg(target), 9) FROM {_T} AS a) AS prediction FROM {_E} AS b)"


@query("i1_regression_metrics", rsql(metrics_sql(_SCORED), *_M))
def i1(spark, sf):
    return rounded(evaluate.regression_metrics(heuristic_scored(spark, sf), TARGET))


_TWO = f"(SELECT 'heuristica' AS modelo, target, prediction FROM {_SCORED} AS a1 UNION ALL SELECT 'dummy', target, prediction FROM {_DUMMY} AS a2)"


@query("i2_metric_report", rsql(f"WITH m AS ({metrics_sql(_TWO, 'modelo')}) SELECT *, 100 * ((SELECT MAE FROM m WHERE modelo = 'dummy') - MAE) / (SELECT MAE FROM m WHERE modelo = 'dummy') AS mejora_vs_dummy_pct FROM m", *_M, "mejora_vs_dummy_pct"))
def i2(spark, sf):
    train, test = sides(spark, sf)
    fits = {"heuristica": models.fit_heuristic(train, TARGET, SCORE_DOMAINS), "dummy": models.fit_constant(train, TARGET)}
    scored = [m.transform(test).select(F.lit(n).alias("modelo"), TARGET, F.round("prediction", 9).alias("prediction")) for n, m in fits.items()]
    return rounded(evaluate.metric_report(evaluate.regression_metrics(reduce(DataFrame.unionAll, scored), TARGET, by=["modelo"])))


@query("i3_kfold", f"SELECT CAST({sql_hash('key', 'fold42')} % 5 AS INTEGER) AS fold, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys FROM {FRAME} AS f GROUP BY 1")
def i3(spark, sf):
    return split.kfold(order_frame(spark, sf), "key").groupBy("fold").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


_REPEATED = " UNION ALL ".join(f"SELECT *, {r} AS repeticion, CAST({sql_hash('key', f'fold42r{r}')} % 5 AS INTEGER) AS fold FROM base" for r in range(1, 6))


@query("i4_repeated_kfold", f"WITH base AS (SELECT key FROM {FRAME} AS f) SELECT repeticion, fold, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys FROM ({_REPEATED}) AS t GROUP BY 1, 2")
def i4(spark, sf):
    return split.repeated_kfold(order_frame(spark, sf).select("key"), "key").groupBy("repeticion", "fold").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


@query("i5_stratified_folds", f"""WITH g AS (SELECT key, greatest(0, (((row_number() OVER (ORDER BY target, key) - 1) * 4 + count(*) OVER () - 2) // (count(*) OVER () - 1)) - 1) AS grupo FROM {FRAME} AS f),
r AS (SELECT key, grupo, row_number() OVER (PARTITION BY grupo ORDER BY {sql_hash('key', 'strata42')}) AS i, count(*) OVER (PARTITION BY grupo) AS n FROM g)
SELECT CAST(grupo AS INTEGER) AS grupo, CAST((i > ceil(n * 1 / 5.0))::INTEGER + (i > ceil(n * 2 / 5.0))::INTEGER + (i > ceil(n * 3 / 5.0))::INTEGER + (i > ceil(n * 4 / 5.0))::INTEGER AS INTEGER) AS fold,
count(*) AS n, CAST(sum(key) AS BIGINT) AS keys FROM r GROUP BY 1, 2""")
def i5(spark, sf):
    folds = split.stratified_kfold(written(order_frame(spark, sf)), "key", TARGET)
    return folds.groupBy("grupo", "fold").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


@query("i6_time_series_folds", """SELECT CAST(CASE WHEN r <= n - 5 * t THEN 0 ELSE (r - (n - 5 * t) - 1) // t + 1 END AS INTEGER) AS bloque, count(*) AS n, min(ts) AS desde, max(ts) AS hasta
FROM (SELECT ts, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n, count(*) OVER () // 6 AS t FROM events) AS e GROUP BY 1""")
def i6(spark, sf):
    blocks = split.time_series_folds(table(spark, sf, "events").select("ts", "event_id"), "ts", "event_id")
    return blocks.groupBy("bloque").agg(F.count("*").alias("n"), F.min("ts").alias("desde"), F.max("ts").alias("hasta"))


def cv_sql(score: str | None, repeats: int = 5) -> str:
    """Per-fold metrics of a straight line on the train rows."""
    union = " UNION ALL ".join(f"SELECT key, target, score, {r} AS repeticion, {sql_hash('key', f'fold42r{r}')} % 5 AS fold FROM base" for r in range(1, repeats + 1))
    a = "regr_intercept(r.target, r.score)" if score else "avg(r.target)"
    b = "regr_slope(r.target, r.score)" if score else "0.0"
    return f"""WITH base AS MATERIALIZED (SELECT key, target, {score or '0.0'} AS score FROM {_T} AS t), rows_ AS MATERIALIZED ({union}),
m AS MATERIALIZED (SELECT f.repeticion, f.fold, {a} AS a, {b} AS b FROM (SELECT DISTINCT repeticion, fold FROM rows_) AS f JOIN rows_ AS r ON r.repeticion = f.repeticion AND r.fold <> f.fold GROUP BY 1, 2),
p AS MATERIALIZED (SELECT m.repeticion, m.fold, CASE WHEN r.fold = m.fold THEN 'validacion' ELSE 'entrenamiento' END AS rol, r.target, round(greatest(0.0, least(1.0, m.a + m.b * r.score)), 9) AS prediction FROM rows_ AS r JOIN m ON r.repeticion = m.repeticion)
{metrics_sql('p', 'repeticion, fold, rol')}"""


def summary_sql(scores: str, repeats: int = 5) -> str:
    parts = " UNION ALL ".join(f"""SELECT '{m}' AS metrica, avg({m}) FILTER (rol = 'entrenamiento') AS entrenamiento, avg({m}) FILTER (rol = 'validacion') AS validacion_cruzada,
stddev_pop({m}) FILTER (rol = 'validacion') AS desviacion_cv, avg({m}) FILTER (rol = 'validacion') - avg({m}) FILTER (rol = 'entrenamiento') AS brecha_train_cv,
'repetido' AS validador, 5 AS pliegues, {repeats} AS repeticiones, 42 AS semilla FROM sc""" for m in _M)
    return f"WITH sc AS MATERIALIZED ({scores}) {parts}"


_CV_COLS = ("entrenamiento", "validacion_cruzada", "desviacion_cv", "brecha_train_cv")


def heuristic_cv(spark, sf, repeats=5):
    train, _ = sides(spark, sf)
    return evaluate.summarise_folds(evaluate.line_fold_scores(train, "key", TARGET, score_column(), 5, repeats, clip=True, digits=9), "repetido", 5, repeats)


@query("i7_cross_validate_heuristic", rsql(summary_sql(cv_sql(SCORE)), *_CV_COLS))
def i7(spark, sf):
    return rounded(heuristic_cv(spark, sf))


@query("i7_cross_validate_mean", rsql(cv_sql(None), *_M))
def i7m(spark, sf):
    train, _ = sides(spark, sf)
    scores = evaluate.line_fold_scores(train, "key", TARGET, None, 5, 5, clip=True, digits=9).withColumn("fold", F.col("fold").cast("bigint"))
    return rounded(scores)


# one predictor and no penalty: a straight line over median-filled values, learned anew in every fold
_LINE_CV = f"""WITH base AS MATERIALIZED (SELECT key, target + 100 AS y, quantity, {sql_hash('key', 'fold42r1')} % 5 AS fold FROM {_T} AS t),
fills AS (SELECT f.fold, median(r.quantity) AS m FROM (SELECT DISTINCT fold FROM base) AS f JOIN base AS r ON r.fold <> f.fold GROUP BY 1),
lines AS (SELECT f.fold, m, regr_slope(y, coalesce(quantity, m)) AS b, regr_intercept(y, coalesce(quantity, m)) AS a FROM fills AS f JOIN base AS r ON r.fold <> f.fold GROUP BY 1, 2)
SELECT l.fold, CASE WHEN r.fold = l.fold THEN 'validacion' ELSE 'entrenamiento' END AS rol, count(*) AS n, avg(abs(y - a - b * coalesce(quantity, m))) AS mae,
sqrt(avg((y - a - b * coalesce(quantity, m)) ** 2)) AS rmse FROM lines AS l, base AS r GROUP BY 1, 2"""


@query("i7_cross_validate_line", rsql(_LINE_CV, "mae", "rmse", digits=7))
def i7l(spark, sf):
    """A target far from [0, 1], so nothing may be clipped."""
    train = sides(spark, sf)[0].withColumn("y100", F.col(TARGET) + 100)
    scored = evaluate.fold_predictions(train, models.LinearFit("y100", PrepPlan(numeric=("quantity",))), "kfold", "key", "y100")
    error = F.col("y") - F.col("prediction")
    return rounded(scored.groupBy(F.col("fold").cast("bigint").alias("fold"), "rol").agg(
        F.count("*").alias("n"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")), 7)


_PAST = """WITH e AS (SELECT value AS y, CAST(user_id AS DOUBLE) AS x, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n, count(*) OVER () // 6 AS t FROM events),
b AS MATERIALIZED (SELECT y, x, CASE WHEN r <= n - 5 * t THEN -1 ELSE (r - (n - 5 * t) - 1) // t END AS fold FROM e),
lines AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (SELECT DISTINCT fold FROM b WHERE fold >= 0) AS f JOIN b AS p ON p.fold < f.fold GROUP BY 1)
SELECT CAST(l.fold AS BIGINT) AS fold, CASE WHEN b.fold = l.fold THEN 'validacion' ELSE 'entrenamiento' END AS rol, count(*) AS n, avg(abs(y - a - l.b * x)) AS mae
FROM lines AS l JOIN b ON b.fold <= l.fold GROUP BY 1, 2"""


def _ordered_events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", F.col("user_id").cast("double").alias("x"), F.col("value").alias("y"))


@query("i7_cross_validate_in_time", rsql(_PAST, "mae", digits=7))
def i7t(spark, sf):
    """Expanding windows: every block is validated by a line that saw earlier events only."""
    scored = evaluate.fold_predictions(_ordered_events(spark, sf), models.LinearFit("y", PrepPlan(numeric=("x",))), "series_temporales", "event_id", "y", time="ts")
    return rounded(scored.groupBy(F.col("fold").cast("bigint").alias("fold"), "rol").agg(
        F.count("*").alias("n"), F.avg(F.abs(F.col("y") - F.col("prediction"))).alias("mae")), 7)


@query("i7_cross_validate_ridge")
def i7r(spark, sf):
    train, _ = sides(spark, sf)
    return evaluate.cross_validate(train, models.LinearFit(TARGET, PLAN, 1.0), TARGET, "key")


_TEST_LONG = " UNION ALL ".join(f"SELECT '{m}' AS metrica, {m} AS prueba FROM tm" for m in _M)
_COMPARE = f"""WITH cv AS MATERIALIZED ({summary_sql(cv_sql(SCORE))}), tm AS MATERIALIZED ({metrics_sql(_SCORED)}), te AS ({_TEST_LONG})
SELECT cv.metrica, entrenamiento, validacion_cruzada, desviacion_cv, prueba, brecha_train_cv, prueba - validacion_cruzada AS diferencia_cv_prueba, validador, pliegues, repeticiones, semilla
FROM cv JOIN te ON cv.metrica = te.metrica"""


def comparison(spark, sf):
    test = evaluate.long_metrics(evaluate.regression_metrics(heuristic_scored(spark, sf), TARGET))
    return evaluate.compare_scenarios(heuristic_cv(spark, sf), test)


@query("i8_train_cv_test", rsql(_COMPARE, *_CV_COLS, "prueba", "diferencia_cv_prueba"))
def i8(spark, sf):
    return rounded(comparison(spark, sf))


@query("i9_verdicts", f"""WITH c AS ({_COMPARE}), v AS (SELECT max(entrenamiento) FILTER (metrica = 'MAE') AS tr, max(validacion_cruzada) FILTER (metrica = 'MAE') AS cv,
max(prueba) FILTER (metrica = 'MAE') AS te, max(desviacion_cv) FILTER (metrica = 'MAE') AS sd, max(validacion_cruzada) FILTER (metrica = 'R2') AS r2 FROM c)
SELECT 'sobreajuste' AS aspecto, CASE WHEN (cv - tr) / cv >= 0.5 THEN 'sobreajuste' WHEN (cv - tr) / cv >= 0.2 THEN 'sobreajuste leve' ELSE 'ajuste adecuado' END AS veredicto FROM v
UNION ALL SELECT 'subajuste', CASE WHEN r2 < 0.5 THEN 'subajuste' ELSE 'capacidad suficiente' END FROM v
UNION ALL SELECT 'estabilidad', CASE WHEN sd / cv > 0.25 THEN 'inestable' ELSE 'estable' END FROM v
UNION ALL SELECT 'degradacion_cv_prueba', CASE WHEN abs(te - cv) / cv > 0.1 THEN 'la prueba no confirma la validacion' ELSE 'coherente' END FROM v""")
def i9(spark, sf):
    return evaluate.diagnose(comparison(spark, sf)).select("aspecto", "veredicto")


_LIMITS = [(i, s, int(s * (1 << 60))) for i, s in enumerate(evaluate.CURVE_SHARES)]
_SIZES = ", ".join(f"({i}, {s}, {limit})" for i, s, limit in _LIMITS)


def curve_sql(score: str | None) -> str:
    a = "regr_intercept(r.target, r.score)" if score else "avg(r.target)"
    b = "regr_slope(r.target, r.score)" if score else "0.0"
    return f"""WITH base AS MATERIALIZED (SELECT key, target, {score or '0.0'} AS score, {sql_hash('key', 'fold42r1')} % 5 AS fold, {sql_hash('key', 'curve42')} AS draw FROM {_T} AS t),
z AS (SELECT * FROM (VALUES {_SIZES}) AS v(talla, proporcion, limite)),
m AS MATERIALIZED (SELECT k.fold, z.talla, z.proporcion, z.limite, count(*) AS n, {a} AS a, {b} AS b FROM z, (SELECT DISTINCT fold FROM base) AS k JOIN base AS r ON r.fold <> k.fold WHERE r.draw < z.limite GROUP BY 1, 2, 3, 4),
e AS (SELECT m.fold, m.talla, m.proporcion, m.n, avg(abs(r.target - greatest(0.0, least(1.0, a + b * r.score)))) FILTER (r.fold <> m.fold AND r.draw < m.limite) AS tr,
avg(abs(r.target - greatest(0.0, least(1.0, a + b * r.score)))) FILTER (r.fold = m.fold) AS va FROM m, base AS r GROUP BY 1, 2, 3, 4)
SELECT CAST(proporcion AS DOUBLE) AS proporcion, CAST(floor(avg(n)) AS BIGINT) AS muestras_entrenamiento, avg(tr) AS MAE_entrenamiento, avg(va) AS MAE_validacion, stddev_pop(va) AS desviacion_validacion FROM e GROUP BY proporcion"""


_CURVE_COLS = ("MAE_entrenamiento", "MAE_validacion", "desviacion_validacion")


@query("i10_learning_curve", rsql(curve_sql(SCORE), *_CURVE_COLS))
def i10(spark, sf):
    train, _ = sides(spark, sf)
    return rounded(evaluate.line_learning_curve(train, "key", TARGET, score_column(), clip=True))


@query("i10_learning_curve_mean", rsql(curve_sql(None), *_CURVE_COLS))
def i10m(spark, sf):
    train, _ = sides(spark, sf)
    return rounded(evaluate.line_learning_curve(train, "key", TARGET, None, clip=True))


def _segment_sql(c: str) -> str:
    return f"""SELECT '{c}' AS atributo, 'tercio ' || CAST(g + 1 AS VARCHAR) AS segmento, count(*) AS n, avg(e) AS MAE, (SELECT avg(abs(target - prediction)) FROM s) AS MAE_global,
avg(e) / (SELECT avg(abs(target - prediction)) FROM s) AS razon_vs_global, avg(e) > 1.5 * (SELECT avg(abs(target - prediction)) FROM s) AS debil FROM (
SELECT abs(target - prediction) AS e, CASE WHEN r <= 1 + (n - 1) // 3 THEN 0 WHEN r <= 1 + 2 * (n - 1) // 3 THEN 1 ELSE 2 END AS g FROM (
SELECT *, row_number() OVER (ORDER BY CAST({c} AS DOUBLE), key) AS r, count(*) OVER () AS n FROM s WHERE {c} IS NOT NULL) AS a) AS b GROUP BY g"""


@query("i11_weak_segments", rsql(scored_cte() + " UNION ALL ".join(_segment_sql(c) for c in ("quantity", "discount", "tax", "level")), "MAE", "MAE_global", "razon_vs_global"))
def i11(spark, sf):
    return rounded(evaluate.weak_segments(heuristic_scored(spark, sf), ["quantity", "discount", "tax", "level"], TARGET, "key"))


_BASKET = "CASE WHEN {0} <= lo THEN 'ambiciosa' WHEN {0} <= hi THEN 'probable' ELSE 'segura' END"
_LABELLED = scored_cte() + f""", q AS (SELECT quantile_cont(target, 1/3) AS lo, quantile_cont(target, 2/3) AS hi FROM f WHERE split = 'train'),
b AS (SELECT {_BASKET.format('target')} AS r, {_BASKET.format('prediction')} AS p FROM s, q)"""


def edges(spark, sf):
    return evaluate.tercile_edges(sides(spark, sf)[0], TARGET)


@query("i12_basket_confusion", _LABELLED + "SELECT r AS real, count(*) FILTER (p = 'ambiciosa') AS ambiciosa, count(*) FILTER (p = 'probable') AS probable, count(*) FILTER (p = 'segura') AS segura FROM b GROUP BY r")
def i12(spark, sf):
    return evaluate.basket_confusion(heuristic_scored(spark, sf), edges(spark, sf), TARGET)


@query("i12_basket_accuracy", rsql(_LABELLED + "SELECT count(*) AS n, avg((r = p)::INTEGER) AS acierto, count(*) FILTER (r = 'ambiciosa' AND p = 'segura') AS graves_optimistas, count(*) FILTER (r = 'segura' AND p = 'ambiciosa') AS graves_pesimistas FROM b", "acierto"))
def i12a(spark, sf):
    return rounded(evaluate.basket_accuracy(heuristic_scored(spark, sf), edges(spark, sf), TARGET))


@query("i13_bias_by_tercile", rsql(scored_cte() + """, q AS (SELECT quantile_cont(target, 1/3) AS lo, quantile_cont(target, 2/3) AS hi FROM s)
SELECT CASE WHEN target <= lo THEN 'target bajo' WHEN target <= hi THEN 'target medio' ELSE 'target alto' END AS tercil, count(*) AS n, avg(abs(target - prediction)) AS MAE, avg(target - prediction) AS sesgo_medio FROM s, q GROUP BY 1""", "MAE", "sesgo_medio"))
def i13(spark, sf):
    return rounded(evaluate.bias_by_tercile(heuristic_scored(spark, sf), TARGET))


@query("i14_error_by_segment", rsql(scored_cte() + """SELECT 'datos faltantes' AS segmento, CASE WHEN quantity IS NULL OR level IS NULL OR open IS NULL THEN 'con algún dato imputado' ELSE 'sin datos faltantes' END AS grupo, count(*) AS n, avg(abs(target - prediction)) AS MAE FROM s GROUP BY 2
UNION ALL SELECT 'level', coalesce(level, 'faltante'), count(*), avg(abs(target - prediction)) FROM s GROUP BY 2
UNION ALL SELECT 'open', coalesce(CAST(open AS VARCHAR), 'faltante'), count(*), avg(abs(target - prediction)) FROM s GROUP BY 2""", "MAE"))
def i14(spark, sf):
    return rounded(evaluate.error_by_segment(heuristic_scored(spark, sf), ["quantity", "discount", "tax", "level", "open"], ["level", "open"], TARGET))


@query("i15_direction_of_error", rsql(scored_cte() + """SELECT avg((prediction > target)::INTEGER) AS proporcion_optimista, avg(prediction - target) FILTER (prediction > target) AS error_sobrestima, avg(target - prediction) FILTER (prediction <= target) AS error_subestima,
min(target) AS real_min, max(target) AS real_max, min(prediction) AS pred_min, max(prediction) AS pred_max FROM s""", "proporcion_optimista", "error_sobrestima", "error_subestima", "real_min", "real_max", "pred_min", "pred_max"))
def i15(spark, sf):
    return rounded(evaluate.direction_of_error(heuristic_scored(spark, sf), TARGET))


_BINS = " UNION ALL ".join(f"SELECT {i} AS bin, {a} AS desde, {b} AS hasta, count(*) FILTER (target > {a} AND target <= {b}) AS n FROM {_T} AS t" for i, (a, b) in enumerate(zip(evaluate.HISTOGRAM_EDGES[:-1], evaluate.HISTOGRAM_EDGES[1:], strict=True)))


@query("i16_target_histogram", f"SELECT * REPLACE (CAST(desde AS DOUBLE) AS desde, CAST(hasta AS DOUBLE) AS hasta) FROM ({_BINS}) AS b")
def i16(spark, sf):
    return evaluate.target_histogram(sides(spark, sf)[0], TARGET)


@query("i16_low_tail", rsql(f"SELECT count(*) FILTER (target < 0.5) AS n, avg((target < 0.5)::INTEGER) AS proporcion FROM {_T} AS t", "proporcion"))
def i16l(spark, sf):
    return rounded(evaluate.low_tail_share(sides(spark, sf)[0], TARGET))


@query("i17_batch_error", rsql(scored_cte() + "SELECT count(*) AS n, avg(abs(prediction - target)) AS MAE FROM s WHERE key % 7 <> 0", "MAE"))
def i17(spark, sf):
    from wardframe.operators.score import batch_error

    scored = heuristic_scored(spark, sf).withColumn("observado", F.when(F.col("key") % 7 == 0, F.lit("pendiente")).otherwise(F.col(TARGET).cast("string")))
    return rounded(batch_error(scored, "observado", "prediction"))


@query("i18_indicator_summary", rsql(_LABELLED + """SELECT 'MAE en test' AS indicador, avg(abs(target - prediction)) AS valor FROM s UNION ALL SELECT 'acierto de cesta', avg((r = p)::INTEGER) FROM b
UNION ALL SELECT 'prediccion minima posible', min(prediction) FROM s UNION ALL SELECT 'proporcion de train con target < 0.5', avg((target < 0.5)::INTEGER) FROM f WHERE split = 'train'""", "valor"))
def i18(spark, sf):
    scored, train = heuristic_scored(spark, sf), sides(spark, sf)[0]
    return rounded(evaluate.indicator_summary({
        "MAE en test": scored.agg(F.avg(F.abs(F.col(TARGET) - F.col("prediction")))),
        "acierto de cesta": evaluate.basket_accuracy(scored, edges(spark, sf), TARGET).select("acierto"),
        "prediccion minima posible": scored.agg(F.min("prediction")),
        "proporcion de train con target < 0.5": evaluate.low_tail_share(train, TARGET).select("proporcion"),
    }))


