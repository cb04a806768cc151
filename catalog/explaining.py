"""Interpretation and batch scoring (J, K)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from catalog.base import DOMAINS, LEVELS, SCORE, SCORE_DOMAINS, TARGET, heuristic_scored, query, rounded, rsql, scored_cte, sql_hash, table, written
from catalog.modelling import _E, _Q, _T
from catalog.splitting import sides
from wardframe.functions.cleaning import NULL_SENTINELS
from wardframe.operators import explain, models, prep, score
from wardframe.operators.clean import Typing
from wardframe.operators.contracts import Contract, ContractError, column, holds
from wardframe.operators.evaluate import regression_metrics
from wardframe.operators.prep import PREFIX, PrepPlan
from wardframe.operators.treepaths import side_by_side, tree_contributions

FEATURES = ["quantity", "discount", "tax", "level", "open"]
REPEATS = 3


def heuristic(spark, sf):
    train, test = sides(spark, sf)
    return models.fit_heuristic(train, TARGET, SCORE_DOMAINS), train, test


# --- J ------------------------------------------------------------------------------------

_PERMUTED = scored_cte() + f""", i AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {sql_hash('key', 'permute')}, key) - 1 AS i, count(*) OVER () AS n FROM s),
mv AS (SELECT r, p, CAST(floor(n * ((r * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE)) AS BIGINT) AS q, n FROM (SELECT max(n) AS n FROM i) AS c, (VALUES (1, 1048571), (2, 1048559), (3, 1048549)) AS v(r, p)),
d AS MATERIALIZED (SELECT mv.r, (i.i * mv.p + mv.q) % mv.n AS dest, quantity AS dq, discount AS dd, tax AS dt, level AS dl, open AS dopen FROM i, mv),
j AS MATERIALIZED (SELECT * FROM i JOIN d ON i.i = d.dest) """


def _permuted_sql(c: str, donor: str) -> str:
    swapped = SCORE.replace(c, donor)
    return f"SELECT '{c}' AS atributo, r AS repeticion, (SELECT avg(abs(target - prediction)) FROM s) AS error_base, avg(abs(target - greatest(0.0, least(1.0, a + b * {swapped})))) AS error FROM j, line GROUP BY r"


@query("j1_permutation_scores", rsql(_PERMUTED + " UNION ALL ".join(_permuted_sql(c, d) for c, d in (("quantity", "dq"), ("discount", "dd"), ("tax", "dt"), ("level", "dl"), ("open", "dopen"))), "error_base", "error"))
def j1(spark, sf):
    model, _, test = heuristic(spark, sf)
    return rounded(explain.permuted_scores(test, model, FEATURES, TARGET, "key", REPEATS))


def fitted_forest(train):
    plan = PrepPlan(numeric=("quantity", "discount", "tax"), ordinal={"level": LEVELS}, boolean=("open",), domains=DOMAINS)
    return models.fit_trees(train, TARGET, plan, models.forest())


@query("j1_permutation_importance_trees")
def j1t(spark, sf):
    train, test = sides(spark, sf)
    return explain.permutation_importance(test, fitted_forest(train), FEATURES, TARGET, "key")


@query("j2_impurity_importance")
def j2(spark, sf):
    train, _ = sides(spark, sf)
    model = fitted_forest(train)
    return explain.impurity_importance(model, model.stages[0].feature_names(), spark)


@query("j3_linear_contributions", rsql(f"""WITH m AS (SELECT median(quantity) AS m FROM {_T} AS a), l AS (SELECT regr_slope(target, {_Q}) AS b, avg({_Q}) AS mean, avg(target) AS base FROM {_T} AS t, m)
SELECT key, 'prep_quantity' AS atributo, base, b * ({_Q} - mean) AS aporte FROM {_E} AS e, m, l""", "base", "aporte"))
def j3(spark, sf):
    train, test = sides(spark, sf)
    model = prep.ColumnPrep.of(PrepPlan(numeric=("quantity",))).fit(train)
    line = models.linear_weights(model.transform(train), [PREFIX + "quantity"], TARGET)
    return rounded(explain.linear_contributions(model.transform(test), line, ["key"]))


@query("j3_tree_contributions")
def j3t(spark, sf):
    train, test = sides(spark, sf)
    return tree_contributions(*_tree_inputs(train, test))


@query("j3_tree_additivity", f"SELECT count(*) AS n, 5 * count(*) AS aportes, count(*) AS aditivas FROM {_E} AS e")
def j3a(spark, sf):
    """Base and contributions of every row sum to what the model itself predicts."""
    train, test = sides(spark, sf)
    ready, model, names, base, key = _tree_inputs(train, test)
    own = VectorAssembler(inputCols=names, outputCol="features").transform(ready)
    scored = model.transform(own).select(key, "prediction")
    parts = tree_contributions(ready, model, names, base, key).groupBy(key).agg((F.first("base") + F.sum("aporte")).alias("sum"), F.count("*").alias("k"))
    return parts.join(scored, key).agg(
        F.count("*").alias("n"), F.sum("k").alias("aportes"), F.count_if(F.abs(F.col("sum") - F.col("prediction")) < 1e-9).alias("aditivas"))


def _tree_inputs(train, test, model=None):
    model = model or fitted_forest(train)
    ready_train, ready_test = model.stages[0].transform(train), model.stages[0].transform(test)
    names = [PREFIX + f for f in model.stages[0].feature_names()]
    row = ready_train.agg(*[F.avg(c).alias(c) for c in names]).first()
    return side_by_side(ready_test.select("key", *names), names, "key"), model.stages[-1], names, row.asDict(), "key"


@query("j4_importance_comparison")
def j4(spark, sf):
    train, test = sides(spark, sf)
    model = fitted_forest(train)
    names = model.stages[0].feature_names()
    impurity = explain.impurity_importance(model, names, spark)
    permutation = explain.permutation_importance(test, model, FEATURES, TARGET, "key")
    contributions = tree_contributions(*_tree_inputs(train, test, model)).withColumn("atributo", F.regexp_replace("atributo", f"^{PREFIX}", ""))
    return explain.compare_importances(impurity, permutation, contributions)


_GRID = {"quantity": (0.0, 100.0, 200.0), "discount": (0.0, 0.05, 0.1)}


def _pdp_sql(c: str, v: float) -> str:
    return f"SELECT '{c}' AS atributo, CAST({v} AS DOUBLE) AS valor, avg(greatest(0.0, least(1.0, a + b * {SCORE.replace(c, f'CAST({v} AS DOUBLE)')}))) AS prediccion_media FROM s, line"


@query("j5_partial_dependence", rsql(scored_cte() + " UNION ALL ".join(_pdp_sql(c, v) for c, vs in _GRID.items() for v in vs), "prediccion_media"))
def j5(spark, sf):
    model, _, test = heuristic(spark, sf)
    return rounded(explain.partial_dependence(test, model, _GRID, FEATURES))


def _ice_sql(v: float) -> str:
    return f"SELECT key, 'quantity' AS atributo, CAST({v} AS DOUBLE) AS valor, greatest(0.0, least(1.0, a + b * {SCORE.replace('quantity', f'CAST({v} AS DOUBLE)')})) AS prediccion FROM (SELECT * FROM s ORDER BY {sql_hash('key', 'ice')}, key LIMIT 40) AS t, line"


@query("j5_individual_curves", rsql(scored_cte() + " UNION ALL ".join(_ice_sql(v) for v in _GRID["quantity"]), "prediccion"))
def j5i(spark, sf):
    model, _, test = heuristic(spark, sf)
    return rounded(explain.individual_curves(test, model, {"quantity": _GRID["quantity"]}, FEATURES, "key"))


_MOVED = ("quantity", "discount", "open")


def _moved_sql(kind: str, key: str, rows: str, group: str) -> str:
    """Averages or curves of every feature on the grid that the same SQL builds."""
    def score(c: str) -> str:
        return f"greatest(0.0, least(1.0, a + b * {SCORE.replace(c, 'g.valor')}))"
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS tipo, {key} AS key, '{c}' AS atributo, g.valor, avg({score(c)}) AS prediccion FROM {rows} AS r, line, grid AS g WHERE g.atributo = '{c}' GROUP BY {group}g.valor"
        for c in _MOVED)


@query("j5_data_driven_dependence", rsql(scored_cte() + ", l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS atributo, CAST({v} AS DOUBLE) AS x FROM s" for c, v in (("quantity", "quantity"), ("discount", "discount"), ("open", "CAST(open AS INTEGER)"))) + f"""),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY atributo ORDER BY x) AS r FROM l WHERE x IS NOT NULL),
m AS (SELECT atributo, count(*) AS n, count(DISTINCT x) AS d FROM o GROUP BY atributo),
h AS (SELECT atributo, p, greatest(1, least(n, n * p + 0.4 + 0.2 * p)) AS h FROM m, (SELECT CAST(0.05 AS DOUBLE) AS p UNION ALL SELECT CAST(0.95 AS DOUBLE)) AS p WHERE d >= 100),
e AS (SELECT atributo, p, max(x) FILTER (r = floor(h)) AS lo, max(x) FILTER (r = ceil(h)) AS hi, any_value(h) - floor(any_value(h)) AS f FROM h JOIN o USING (atributo) GROUP BY atributo, p),
w AS (SELECT atributo, min(lo + (hi - lo) * f) AS a0, max(lo + (hi - lo) * f) AS a1 FROM e GROUP BY atributo),
grid AS MATERIALIZED (SELECT DISTINCT atributo, x AS valor FROM o JOIN m USING (atributo) WHERE d < 100 UNION SELECT atributo, a0 + (a1 - a0) * i / 99 FROM w, range(100) AS t(i)) """
+ _moved_sql("promedio", "CAST(NULL AS BIGINT)", "s", "") + " UNION ALL " + _moved_sql("individual", "key", f"(SELECT * FROM s ORDER BY {sql_hash('key', 'ice')}, key LIMIT 40)", "key, "), "valor", "prediccion"))
def j5d(spark, sf):
    model, _, test = heuristic(spark, sf)
    return rounded(explain.dependence(test, model, FEATURES, "key", _MOVED))


def embedded(spark, sf):
    test = F.col("vec_id") % 4 == 0
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", F.col("label").cast("double").alias("y"))
    return vectors.where(~test), vectors.where(test)


_NN = """WITH tr AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS DOUBLE) AS y FROM embeddings WHERE vec_id % 4 <> 0), te AS (SELECT vec_id AS query, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 4 = 0),
nn AS (SELECT query, vec_id AS key, y, list_distance(te.v, tr.v) AS distance FROM te, tr QUALIFY row_number() OVER (PARTITION BY query ORDER BY list_distance(te.v, tr.v), vec_id) <= 5),
disp AS (SELECT query, avg(abs(y - m)) AS dispersion FROM (SELECT *, avg(y) OVER (PARTITION BY query) AS m FROM nn) AS a GROUP BY query) """


@query("j6_nearest_neighbours", rsql(_NN + "SELECT query, key, distance, y AS value FROM nn", "distance"))
def j6(spark, sf):
    return rounded(explain.nearest_neighbours(*embedded(spark, sf), "vec_id", "embedding", "y").drop("orden"))


@query("j6_local_dispersion", rsql(_NN + "SELECT query, dispersion FROM disp", "dispersion"))
def j6d(spark, sf):
    return rounded(explain.local_dispersion(*embedded(spark, sf), "vec_id", "embedding", "y"))


@query("j6_dispersion_against_error", rsql(_NN + """, e AS (SELECT vec_id AS query, abs(label - (SELECT avg(y) FROM tr)) AS error FROM embeddings WHERE vec_id % 4 = 0), b AS (SELECT *, (SELECT median(dispersion) FROM disp) AS med FROM disp JOIN e USING (query))
SELECT avg(dispersion) AS dispersion_media, avg(error) AS error_medio, corr(error, dispersion) AS correlacion, avg(error) FILTER (dispersion > med) AS error_inconsistente, avg(error) FILTER (dispersion <= med) AS error_consistente FROM b""",
       "dispersion_media", "error_medio", "correlacion", "error_inconsistente", "error_consistente", digits=5))
def j6e(spark, sf):
    from wardframe.operators.ranks import exact_quantiles
    from wardframe.sources.scratch import materialised

    train, test = embedded(spark, sf)
    dispersion = materialised(explain.local_dispersion(train, test, "vec_id", "embedding", "y").withColumn("dispersion", F.round("dispersion", 9)), "dispersion")
    mean = train.agg(F.avg("y")).first()[0]
    errors = test.select(F.col("vec_id").alias("query"), F.abs(F.col("y") - F.lit(mean)).alias("error"))
    median = exact_quantiles(dispersion, ["dispersion"], [0.5])["dispersion"][0]
    return rounded(explain.dispersion_against_error(dispersion, errors, median), 5)


@query("j7_best_and_worst", rsql(scored_cte() + """, e AS (SELECT *, abs(target - prediction) AS error FROM s)
(SELECT 'mejor' AS caso, key, target AS real, prediction AS prediccion, error, quantity FROM e ORDER BY error, key LIMIT 1) UNION ALL (SELECT 'peor', key, target, prediction, error, quantity FROM e ORDER BY error DESC, key LIMIT 1)""", "real", "prediccion", "error", digits=9))
def j7(spark, sf):
    return rounded(explain.best_and_worst(heuristic_scored(spark, sf), TARGET, "key", show=["quantity"]), 9)


def _single_sql() -> str:
    folds = " UNION ALL ".join(f"SELECT key, target, quantity, discount, tax, level, open, {r} AS r, {sql_hash('key', f'fold42r{r}')} % 5 AS f FROM base" for r in range(1, 4))
    def values(c, cast):
        return f"SELECT '{c}' AS columna, r, f, target AS y, {cast} AS x FROM t"
    cells = " UNION ALL ".join([values(c, c) for c in ("quantity", "discount", "tax")] + [values("level", "CAST(level AS DOUBLE)"), values("open", "CAST(CAST(open AS INTEGER) AS DOUBLE)")])
    return f"""WITH base AS MATERIALIZED (SELECT * FROM {_T} AS a), t AS MATERIALIZED ({folds}), c AS MATERIALIZED ({cells}), k AS (SELECT DISTINCT columna, r, f FROM c),
fill AS MATERIALIZED (SELECT k.columna, k.r, k.f, median(c.x) FILTER (k.columna NOT IN ('level', 'open')) AS med FROM k JOIN c ON c.columna = k.columna AND c.r = k.r AND c.f <> k.f GROUP BY 1, 2, 3),
freq AS (SELECT k.columna, k.r, k.f, c.x, count(*) AS n FROM k JOIN c ON c.columna = k.columna AND c.r = k.r AND c.f <> k.f WHERE c.x IS NOT NULL AND k.columna IN ('level', 'open') GROUP BY 1, 2, 3, 4),
mo AS MATERIALIZED (SELECT columna, r, f, x AS mode FROM freq QUALIFY row_number() OVER (PARTITION BY columna, r, f ORDER BY n DESC, x) = 1),
fl AS MATERIALIZED (SELECT fill.columna, fill.r, fill.f, coalesce(med, mode) AS fill FROM fill LEFT JOIN mo USING (columna, r, f)),
line AS MATERIALIZED (SELECT fl.columna, fl.r, fl.f, fl.fill, regr_intercept(c.y, coalesce(c.x, fl.fill)) AS a, regr_slope(c.y, coalesce(c.x, fl.fill)) AS b FROM fl JOIN c ON c.columna = fl.columna AND c.r = fl.r AND c.f <> fl.f GROUP BY 1, 2, 3, 4),
e AS (SELECT line.columna, line.r, line.f, avg(abs(c.y - a - b * coalesce(c.x, fill))) AS mae FROM line JOIN c ON c.columna = line.columna AND c.r = line.r AND c.f = line.f GROUP BY 1, 2, 3)
SELECT columna, avg(mae) AS MAE, stddev_pop(mae) AS desviacion FROM e GROUP BY columna"""


@query("j8_single_predictor_ranking", rsql(_single_sql(), "MAE", "desviacion"))
def j8(spark, sf):
    train, _ = sides(spark, sf)
    numbers = train.withColumn("level", F.col("level").cast("double"))
    return rounded(explain.single_predictor_ranking(numbers, ["quantity", "discount", "tax"], ["level", "open"], TARGET, "key"))


@query("j8_far_from_zero", f"SELECT 'x' AS columna, 0.0 AS MAE, 0.0 AS desviacion FROM {_T} AS t WHERE quantity IS NOT NULL HAVING count(*) > 0")
def j8far(spark, sf):
    """A predictor near 1e8 that explains the target fully leaves no error."""
    train = sides(spark, sf)[0].where("quantity is not null").select("key", (F.lit(1e8) + F.col("quantity")).alias("x"), F.col("quantity").alias("y"))
    return rounded(explain.single_predictor_ranking(train, ["x"], [], "y", "key"))


# --- K ------------------------------------------------------------------------------------

_INTERPRETED = """SELECT key, prediction AS prediccion, CASE WHEN prediction < 0.67 THEN 'ambiciosa' WHEN prediction < 0.79 THEN 'probable' ELSE 'segura' END AS cesta,
greatest(0.0, least(1.0, prediction - 0.0467)) AS limite_inferior, greatest(0.0, least(1.0, prediction + 0.0467)) AS limite_superior, prediction < 0.55 AS advertencia FROM s"""
_OUT = ("prediccion", "limite_inferior", "limite_superior")

BATCH_TYPING = Typing(integers=("quantity",), decimals=("discount", "tax"), booleans=("open",), ordinals={"level": LEVELS})
BATCH_CONTRACT = Contract(
        column("quantity", types=("bigint",), within=(0, 1000), nulls=0.5), column("discount", types=("double",), within=(0, 1)),
        column("tax", types=("double",), within=(0, 1)), column("level", types=("string",), among=(1, 2, 3, 4, 5), nulls=0.5),
        column("open", types=("boolean",), among=(0, 1), nulls=0.5),
    holds("registro_utilizable", "two fields known", ("discount", "tax"), lambda: F.col("discount").isNotNull() | F.col("tax").isNotNull()),
)


def raw_batch(test):
    """The test rows as a messy text file would deliver them."""
    return test.select(
        F.col("key").cast("string").alias(" Key"),
        F.coalesce(F.col("quantity").cast("bigint").cast("string"), F.lit(" n/a ")).alias("Quantity "),
        F.col("discount").cast("string").alias("Discount"), F.col("tax").cast("string").alias("Tax"),
        F.coalesce("level", F.lit("-")).alias("Level"),
        F.coalesce(F.when(F.col("open"), F.lit("1")).when(~F.col("open"), F.lit("0")), F.lit("Unknown")).alias("Open"),
        F.col(TARGET).cast("string").alias("Target"),
    )


@query("k1_batch_score", rsql(scored_cte() + f"SELECT CAST(t.key AS VARCHAR) AS key, CAST(s.quantity AS BIGINT) AS quantity, s.level, s.open, t.prediccion, t.cesta, t.limite_inferior, t.limite_superior, t.advertencia FROM s JOIN ({_INTERPRETED}) AS t USING (key)", *_OUT, digits=9))
def k1(spark, sf):
    model, _, test = heuristic(spark, sf)
    ready = score.prepare_batch(written(raw_batch(test)), FEATURES, BATCH_TYPING, BATCH_CONTRACT, NULL_SENTINELS)
    return rounded(score.score_batch(ready, model, FEATURES).drop("target", "discount", "tax"), 9)


def interpreted(spark, sf):
    return score.interpret(heuristic_scored(spark, sf))


@query("k2_basket", scored_cte() + f"SELECT cesta, count(*) AS n FROM ({_INTERPRETED}) AS t GROUP BY cesta")
def k2(spark, sf):
    return interpreted(spark, sf).groupBy("cesta").agg(F.count("*").alias("n"))


@query("k3_reference_interval", rsql(scored_cte() + f"SELECT key, limite_inferior, limite_superior FROM ({_INTERPRETED}) AS t", "limite_inferior", "limite_superior", digits=9))
def k3(spark, sf):
    return rounded(interpreted(spark, sf).select("key", "limite_inferior", "limite_superior"), 9)


@query("k4_low_range_warning", scored_cte() + f"SELECT advertencia, count(*) AS n FROM ({_INTERPRETED}) AS t GROUP BY advertencia")
def k4(spark, sf):
    return interpreted(spark, sf).groupBy("advertencia").agg(F.count("*").alias("n"))


@query("k5_batch_summary", rsql(scored_cte() + f"SELECT cesta, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS porcentaje, avg(prediccion) AS prediccion_media FROM ({_INTERPRETED}) AS t GROUP BY cesta", "porcentaje", "prediccion_media"))
def k5(spark, sf):
    return rounded(score.batch_summary(interpreted(spark, sf)))


@query("k6_preview", scored_cte() + f"SELECT key, round(prediccion, 4) AS prediccion, cesta, round(limite_inferior, 4) AS limite_inferior, round(limite_superior, 4) AS limite_superior, advertencia FROM ({_INTERPRETED}) AS t ORDER BY key LIMIT 10")
def k6(spark, sf):
    return score.preview(interpreted(spark, sf), "key", 10)


@query("k7_served_metric", rsql(scored_cte() + "SELECT avg(abs(target - prediction)) AS servida, CAST(0.0467 AS DOUBLE) AS sin_columna, CAST(0.4066 AS DOUBLE) AS sin_informe FROM s", "servida"))
def k7(spark, sf):
    from wardframe.sources import tabular
    from wardframe.sources.scratch import scratch_path

    scored = heuristic_scored(spark, sf)
    report = regression_metrics(scored, TARGET, ranks=False).withColumn("modelo", F.lit("heuristica"))
    folder = scratch_path(spark, "served")
    path = tabular.write_reports({"metricas": report}, folder)["metricas"]
    values = [
        score.served_metric(spark, path, "heuristica", "MAE", score.FALLBACK_MAE), score.served_metric(spark, path, "heuristica", "nada", score.FALLBACK_MAE),
        score.served_metric(spark, folder + "/falta.parquet", "heuristica", "MAE", score.FALLBACK_MIN_PREDICTION),
    ]
    return tabular.read_parquet(spark, path).select(F.round(F.lit(values[0]), 6).alias("servida"), F.lit(values[1]).alias("sin_columna"), F.lit(values[2]).alias("sin_informe"))


@query("k8_batch_rejection", f"SELECT 'fuera_de_rango' AS regla, 'quantity' AS columna, count(*) AS filas_afectadas FROM {_E} AS e WHERE key % 5 = 0")
def k8(spark, sf):
    _, _, test = heuristic(spark, sf)
    wrong = raw_batch(test.withColumn("quantity", F.when(F.col("key") % 5 == 0, F.lit(5000.0)).otherwise(F.col("quantity"))))
    try:
        return score.prepare_batch(wrong, FEATURES, BATCH_TYPING, BATCH_CONTRACT).limit(0).select(F.lit("aceptado").alias("regla"))
    except ContractError as error:
        return spark.createDataFrame([(v.regla, v.columna, v.filas_afectadas) for v in error.violations], "regla string, columna string, filas_afectadas bigint")


