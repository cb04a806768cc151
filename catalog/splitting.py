"""Splits, split checks and learned preparation (D, G)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.base import (
    DOMAINS, FRAME, LEVELS, PREDICTORS, SPLIT, TARGET, as_double, order_frame, query, rounded, rsql, split_frame, sql_hash, written,
)
from wardframe.operators import evaluate, prep, split
from wardframe.operators.contracts import ContractError
from wardframe.operators.models import LinearFit

SPLIT_FRAME = f"(SELECT *, {SPLIT} AS split FROM {FRAME} AS raw_frame)"


def drifted(spark, sf):
    """The split frame with leaks and drift injected on the test side."""
    test = F.col("split") == "test"
    return split_frame(spark, sf).withColumns({
        "quantity": F.when(test, F.col("quantity") + 40).otherwise(F.col("quantity")),
        "level": F.when(test & (F.col("key") % 10 == 0), F.lit("nuevo")).otherwise(F.col("level")),
        "discount": F.when(test & (F.col("key") % 3 == 0), F.lit(None)).otherwise(F.col("discount")),
    })


DRIFTED = f"""(SELECT * REPLACE (CASE WHEN split = 'test' THEN quantity + 40 ELSE quantity END AS quantity,
 CASE WHEN split = 'test' AND key % 10 = 0 THEN 'nuevo' ELSE level END AS level,
 CASE WHEN split = 'test' AND key % 3 = 0 THEN NULL ELSE discount END AS discount) FROM {SPLIT_FRAME} AS parted)"""


@query("d1_split_by_share", f"SELECT split, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys FROM {SPLIT_FRAME} AS t GROUP BY split")
def d1(spark, sf):
    return split_frame(spark, sf).groupBy("split").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


@query("d1_split_exact_size", f"""SELECT CASE WHEN r <= ceil(0.25 * n) THEN 'test' ELSE 'train' END AS split, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys
FROM (SELECT key, rank() OVER (ORDER BY {sql_hash('key', 'split42')}) AS r, count(*) OVER () AS n FROM {FRAME} AS f) AS t GROUP BY 1""")
def d1x(spark, sf):
    return split.seeded_split(written(order_frame(spark, sf)), "key", exact=True).groupBy("split").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


@query("d2_key_overlap", as_double(f"""SELECT 'indices_solapados' AS chequeo, '' AS columna, CASE WHEN count(*) > 0 THEN 'error' ELSE 'ok' END AS severidad, CAST(count(*) AS DOUBLE) AS estadistico, 0.0 AS umbral
FROM {SPLIT_FRAME} AS t WHERE key % 100 = 0 UNION ALL SELECT 'indices_solapados', '', 'ok', 0.0 * count(*), 0.0 FROM {SPLIT_FRAME} AS t""", "umbral"))
def d2(spark, sf):
    frame = split_frame(spark, sf).select("key", "split")
    copies = frame.where(F.col("key") % 100 == 0).withColumn("split", F.when(F.col("split") == "test", F.lit("train")).otherwise(F.lit("test")))
    return split.check_keys(frame.unionByName(copies), "key").unionByName(split.check_keys(frame, "key")).drop("detalle")


_SHARED = f"""SELECT count(*) FILTER (EXISTS (SELECT 1 FROM {SPLIT_FRAME} AS b WHERE b.split = 'train' AND b.quantity = a.quantity AND b.level = a.level AND b.discount = a.discount AND b.tax = a.tax)) AS compartidas,
count(*) AS prueba FROM {SPLIT_FRAME} AS a WHERE a.split = 'test'"""


@query("d3_shared_rows", _SHARED)
def d3(spark, sf):
    return split.shared_rows(split_frame(spark, sf), ["quantity", "level", "discount", "tax"])


@query("d4_sizes", as_double(rsql(f"""SELECT 'proporcion_de_la_particion' AS chequeo, CASE WHEN abs(te / n - 0.4) > 0.05 THEN 'advertencia' ELSE 'ok' END AS severidad, abs(te / n - 0.4) AS estadistico, 0.05 AS umbral
FROM (SELECT count(*)::DOUBLE AS n, count(*) FILTER (split = 'test')::DOUBLE AS te FROM {SPLIT_FRAME} AS t) AS c
UNION ALL SELECT 'tamano_del_conjunto_de_prueba', CASE WHEN te / (n - te) < 0.01 OR te < 30 THEN 'advertencia' ELSE 'ok' END, te, 30.0
FROM (SELECT count(*)::DOUBLE AS n, count(*) FILTER (split = 'test')::DOUBLE AS te FROM {SPLIT_FRAME} AS t) AS c""", "estadistico"), "umbral"))
def d4(spark, sf):
    return rounded(split.check_sizes(split_frame(spark, sf), 0.4).drop("detalle", "columna"))


def ks_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS columna, max(abs(ctr / ntr - cte / nte)) AS estadistico FROM (
SELECT sum(tr) OVER (ORDER BY v)::DOUBLE AS ctr, sum(te) OVER (ORDER BY v)::DOUBLE AS cte, sum(tr) OVER ()::DOUBLE AS ntr, sum(te) OVER ()::DOUBLE AS nte
FROM (SELECT CAST({column} AS DOUBLE) AS v, count(*) FILTER (split = 'train') AS tr, count(*) FILTER (split = 'test') AS te FROM {source} AS s WHERE {column} IS NOT NULL GROUP BY 1) AS c) AS w"""


_KS = " UNION ALL ".join(ks_sql(c, DRIFTED) for c in ("quantity", "discount", "tax"))
_DRIFT = f"SELECT 'deriva_de_la_variable' AS chequeo, columna, CASE WHEN estadistico > 0.2 THEN 'advertencia' ELSE 'ok' END AS severidad, estadistico, 0.2 AS umbral FROM ({_KS}) AS k"


@query("d5_column_drift", as_double(rsql(_DRIFT, "estadistico"), "umbral"))
def d5(spark, sf):
    return rounded(split.check_column_drift(drifted(spark, sf), ["quantity", "discount", "tax"]).drop("detalle"))


_TARGET_DRIFT = f"SELECT 'deriva_del_objetivo' AS chequeo, columna, CASE WHEN estadistico > 0.2 THEN 'advertencia' ELSE 'ok' END AS severidad, estadistico, 0.2 AS umbral FROM ({ks_sql('target', DRIFTED)}) AS k"


@query("d6_target_drift", as_double(rsql(_TARGET_DRIFT, "estadistico"), "umbral"))
def d6(spark, sf):
    return rounded(split.check_target_drift(drifted(spark, sf), TARGET).drop("detalle"))


_NEW = f"""SELECT 'categorias_nuevas_en_prueba' AS chequeo, 'level' AS columna, CASE WHEN count(*) > 0 THEN 'advertencia' ELSE 'ok' END AS severidad, CAST(count(*) AS DOUBLE) AS estadistico, 0.0 AS umbral
FROM (SELECT DISTINCT level FROM {DRIFTED} AS a WHERE split = 'test' AND level IS NOT NULL EXCEPT SELECT level FROM {DRIFTED} AS b WHERE split = 'train') AS d
UNION ALL SELECT 'categorias_nuevas_en_prueba', 'open', CASE WHEN count(*) > 0 THEN 'advertencia' ELSE 'ok' END, CAST(count(*) AS DOUBLE), 0.0
FROM (SELECT DISTINCT open FROM {DRIFTED} AS a WHERE split = 'test' AND open IS NOT NULL EXCEPT SELECT open FROM {DRIFTED} AS b WHERE split = 'train') AS d"""


@query("d7_new_categories", as_double(_NEW, "umbral"))
def d7(spark, sf):
    return split.check_new_categories(drifted(spark, sf), ["level", "open"]).drop("detalle")


_GAPS = " UNION ALL ".join(f"SELECT '{c}' AS columna, abs(avg(({c} IS NULL)::INTEGER) FILTER (split = 'train') - avg(({c} IS NULL)::INTEGER) FILTER (split = 'test')) AS estadistico FROM {DRIFTED} AS t" for c in PREDICTORS)
_NULLS = f"SELECT 'deriva_de_los_nulos' AS chequeo, columna, 'advertencia' AS severidad, estadistico, 0.10 AS umbral FROM ({_GAPS}) AS g WHERE estadistico > 0.10"


@query("d8_null_drift", as_double(rsql(_NULLS, "estadistico"), "umbral"))
def d8(spark, sf):
    return rounded(split.check_null_drift(drifted(spark, sf), PREDICTORS).drop("detalle"))


_AUC = f"""WITH f AS (SELECT key, CAST(split = 'test' AS INTEGER) AS label, coalesce(quantity, (SELECT median(quantity) FROM {DRIFTED} AS m)) AS x FROM {DRIFTED} AS d),
o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('key', 'domain42')}) AS i, count(*) OVER (PARTITION BY label) AS n FROM f),
k AS (SELECT label, x, (i > ceil(n / 3.0))::INTEGER + (i > ceil(n * 2 / 3.0))::INTEGER AS fold FROM o),
r AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY x) + (count(*) OVER (PARTITION BY fold, x) - 1) / 2.0 AS rk FROM k),
a AS (SELECT fold, sum(rk) FILTER (label = 1) AS s, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS q FROM r GROUP BY fold)
SELECT avg((s - p * (p + 1) / 2) / (p * q)) AS auc FROM a"""


@query("d6_null_targets", f"""SELECT 'deriva_del_objetivo' AS chequeo, 'target' AS columna, 'advertencia' AS severidad, count(*) FILTER (key % 4 = 0) AS nulos, CAST(NULL AS DOUBLE) AS estadistico FROM {SPLIT_FRAME} AS f""")
def d6nulls(spark, sf):
    """With null targets there is nothing to compare: a warning that says how many."""
    rows = written(split_frame(spark, sf).withColumn(TARGET, F.when(F.col("key") % 4 != 0, F.col(TARGET))))
    return split.check_target_drift(rows, TARGET).select(
        "chequeo", "columna", "severidad", F.regexp_extract("detalle", r"null targets (\d+)", 1).cast("bigint").alias("nulos"), "estadistico")


@query("i5_null_targets", f"""SELECT key % 4 = 0 AS sin_objetivo, count(*) AS n FROM {FRAME} AS f GROUP BY 1""")
def i5nulls(spark, sf):
    """Rows without a target are a stratum of their own: every row gets a fold, and each fold its share of them."""
    rows = written(order_frame(spark, sf).withColumn(TARGET, F.when(F.col("key") % 4 != 0, F.col(TARGET))))
    folds = split.stratified_kfold(rows, "key", TARGET).where("fold is not null").groupBy(F.col(TARGET).isNull().alias("sin_objetivo"), "fold").agg(F.count("*").alias("n"))
    even = folds.groupBy("sin_objetivo").agg(F.sum("n").alias("n"), (F.max("n") - F.min("n")).alias("gap")).where("not sin_objetivo or gap <= 1")
    return even.select("sin_objetivo", "n")


@query("d9_domain_one_predictor", rsql(_AUC, "auc", digits=9))
def d9one(spark, sf):
    """With one predictor the classifier ranks rows as the predictor does."""
    frame = written(drifted(spark, sf))
    return rounded(spark.createDataFrame([(split.domain_auc(frame, ["quantity"], "key"),)], "auc double"), 9)


@query("d9_domain_classifier")
def d9(spark, sf):
    clean_side = split.check_domain(written(split_frame(spark, sf)), ["quantity", "discount", "tax"], "key")
    return clean_side.unionByName(split.check_domain(written(drifted(spark, sf)), ["quantity", "discount", "tax"], "key"))


_REPORT = f"""SELECT 'indices_solapados' AS chequeo, '' AS columna, 'ok' AS severidad, 0.0 AS estadistico, 0.0 AS umbral FROM {DRIFTED} AS t HAVING count(*) > 0
UNION ALL SELECT 'filas_compartidas', '', CASE WHEN c = 0 THEN 'ok' WHEN c / p > 0.05 THEN 'error' ELSE 'advertencia' END, c / p, 0.05 FROM (
 SELECT count(*) FILTER (EXISTS (SELECT 1 FROM {DRIFTED} AS b WHERE b.split = 'train' AND b.quantity = a.quantity AND b.discount = a.discount AND b.tax = a.tax AND b.level = a.level AND b.open = a.open))::DOUBLE AS c, count(*)::DOUBLE AS p FROM {DRIFTED} AS a WHERE split = 'test') AS s
UNION ALL SELECT 'proporcion_de_la_particion', '', CASE WHEN abs(te / n - 0.25) > 0.05 THEN 'advertencia' ELSE 'ok' END, abs(te / n - 0.25), 0.05 FROM (SELECT count(*)::DOUBLE AS n, count(*) FILTER (split = 'test')::DOUBLE AS te FROM {DRIFTED} AS t) AS c
UNION ALL SELECT 'tamano_del_conjunto_de_prueba', '', 'ok', count(*) FILTER (split = 'test')::DOUBLE, 30.0 FROM {DRIFTED} AS t
UNION ALL {_TARGET_DRIFT}
UNION ALL SELECT 'deriva_de_la_variable', columna, CASE WHEN estadistico > 0.2 THEN 'advertencia' ELSE 'ok' END, estadistico, 0.2 FROM ({_KS} UNION ALL {ks_sql('open', DRIFTED)}) AS k
UNION ALL {_NEW} UNION ALL {_NULLS}"""


@query("d10_split_report", as_double(rsql(_REPORT, "estadistico"), "umbral"))
def d10(spark, sf):
    return rounded(split.split_report(written(drifted(spark, sf)), "key", TARGET, PREDICTORS, ["level", "open"], domain=False).drop("detalle"))


@query("d11_split_gate", f"""WITH r AS ({_REPORT}), c AS (SELECT count(*) FILTER (severidad = 'error') AS e, count(*) FILTER (severidad <> 'ok') AS w FROM r)
SELECT severidad, count(*) AS n, CASE WHEN any_value(e) = 0 THEN 'pasa' ELSE 'detenida: ' || any_value(e) END AS normal,
CASE WHEN any_value(w) = 0 THEN 'pasa' ELSE 'detenida: ' || any_value(w) END AS estricta FROM r, c GROUP BY severidad""")
def d11(spark, sf):
    report = split.split_report(written(drifted(spark, sf)), "key", TARGET, PREDICTORS, ["level", "open"], domain=False)
    outcomes = []
    for strict in (False, True):
        try:
            split.split_gate(report, strict)
            outcomes.append("pasa")
        except ContractError as error:
            outcomes.append(f"detenida: {len(error.violations)}")
    return report.groupBy("severidad").agg(F.count("*").alias("n")).withColumns({"normal": F.lit(outcomes[0]), "estricta": F.lit(outcomes[1])})


# --- G: fitted on train, applied to test --------------------------------------------------

_TRAIN, _TEST = f"(SELECT * FROM {SPLIT_FRAME} AS p WHERE split = 'train')", f"(SELECT * FROM {SPLIT_FRAME} AS p WHERE split = 'test')"


def sides(spark, sf):
    parted = written(split_frame(spark, sf))
    return parted.where("split = 'train'"), parted.where("split = 'test'")


@query("g1_median_impute", rsql(f"SELECT key, coalesce(quantity, (SELECT median(quantity) FROM {_TRAIN} AS a)) AS quantity FROM {_TEST} AS b", "quantity"))
def g1(spark, sf):
    train, test = sides(spark, sf)
    return rounded(prep.impute(test, prep.medians(train, ["quantity"])).select("key", "quantity"))


_MODE = "(SELECT {c} FROM {src} AS a WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("g2_mode_impute", f"SELECT coalesce(level, {_MODE.format(c='level', src=_TRAIN)}) AS level, CAST(coalesce(open, {_MODE.format(c='open', src=_TRAIN)}) AS INTEGER) AS open, count(*) AS n FROM {_TEST} AS b GROUP BY 1, 2")
def g2(spark, sf):
    train, test = sides(spark, sf)
    train, test = (d.withColumn("open", F.col("open").cast("int")) for d in (train, test))
    values = prep.modes(train, ["level", "open"])
    return prep.impute(test, {"level": values["level"], "open": int(values["open"])}).groupBy("level", "open").agg(F.count("*").alias("n"))


@query("g3_missing_indicator", f"SELECT CAST((quantity IS NULL)::INTEGER AS DOUBLE) AS quantity_ausente, CAST((level IS NULL)::INTEGER AS DOUBLE) AS level_ausente, count(*) AS n FROM {_TEST} AS b GROUP BY 1, 2")
def g3(spark, sf):
    train, test = sides(spark, sf)
    marked = prep.missing_indicators(test, train, ["quantity", "level", "tax"])
    return marked.groupBy(*[c for c in marked.columns if c.endswith("_ausente")]).agg(F.count("*").alias("n"))


@query("g4_ordinal_encode", f"SELECT level, CAST(level AS DOUBLE) - 1 AS codigo, count(*) AS n FROM {FRAME} AS f GROUP BY level")
def g4(spark, sf):
    return order_frame(spark, sf).groupBy("level", prep.ordinal_code(F.col("level"), LEVELS).alias("codigo")).agg(F.count("*").alias("n"))


@query("g5_one_hot", " UNION ALL ".join(f"SELECT '{v}' AS nivel, CAST(count(*) FILTER (level = '{v}') AS DOUBLE) AS marcadas FROM {_TEST} AS b" for v in "1245")
       + f" UNION ALL SELECT 'ninguna', CAST(count(*) FILTER (level IS NULL OR level = '3') AS DOUBLE) FROM {_TEST} AS b")
def g5(spark, sf):
    train, test = sides(spark, sf)
    seen = prep.seen_categories(train.where("level <> '3'"), "level")
    wide = prep.one_hot(test, "level", seen)
    names = [f"level_{v}" for v in seen]
    none = sum((F.col(c) for c in names), F.lit(0.0)) == 0
    line = wide.agg(*[F.sum(c).alias(c) for c in names], F.count_if(none).cast("double").alias("ninguna"))
    return line.select(F.inline(F.array(*[
        F.struct(F.lit(n.replace("level_", "")).alias("nivel"), F.col(n).alias("marcadas")) for n in [*names, "ninguna"]
    ])))


def _scaled_sql(centre, spread):
    return rsql(f"""SELECT key, (discount - (SELECT {centre.format('discount')} FROM {_TRAIN} AS a)) / (SELECT {spread.format('discount')} FROM {_TRAIN} AS a) AS discount,
(tax - (SELECT {centre.format('tax')} FROM {_TRAIN} AS a)) / (SELECT {spread.format('tax')} FROM {_TRAIN} AS a) AS tax FROM {_TEST} AS b""", "discount", "tax")


@query("g6_standardise", _scaled_sql("avg({0})", "stddev_pop({0})"))
def g6(spark, sf):
    train, test = sides(spark, sf)
    return rounded(prep.rescale(test, prep.standard_scales(train, ["discount", "tax"])).select("key", "discount", "tax"))


@query("g7_min_max", _scaled_sql("min({0})", "max({0}) - min({0})"))
def g7(spark, sf):
    train, test = sides(spark, sf)
    return rounded(prep.rescale(test, prep.min_max_scales(train, ["discount", "tax"])).select("key", "discount", "tax"))


@query("g8_quantile_bins", rsql(f"""WITH filled AS (SELECT coalesce(quantity, (SELECT median(quantity) FROM {_TRAIN} AS a)) AS x FROM {_TRAIN} AS t),
r AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM filled),
e AS (SELECT j, (max(x) FILTER (i = greatest(1, (n * j + 3) // 4)) + max(x) FILTER (i = least(n, n * j // 4 + 1))) / 2 AS edge FROM r, (VALUES (1), (2), (3)) AS v(j) GROUP BY j)
SELECT CAST((x >= (SELECT edge FROM e WHERE j = 1))::INTEGER + (x >= (SELECT edge FROM e WHERE j = 2))::INTEGER + (x >= (SELECT edge FROM e WHERE j = 3))::INTEGER AS DOUBLE) AS bin,
count(*) AS n, min(x) AS minimo, max(x) AS maximo FROM filled GROUP BY 1""", "minimo", "maximo"))
def g8(spark, sf):
    train, _ = sides(spark, sf)
    edges = prep.quantile_edges(train, "quantity")
    filled = prep.impute(train, prep.medians(train, ["quantity"]))
    return rounded(filled.groupBy(prep.bin_number(F.col("quantity"), edges).alias("bin")).agg(
        F.count("*").alias("n"), F.min("quantity").alias("minimo"), F.max("quantity").alias("maximo")))


PLAN = prep.PrepPlan(numeric=("quantity", "discount", "tax"), ordinal={"level": LEVELS}, boolean=("open",), domains=DOMAINS)


@query("g9_column_preparation", rsql(f"""WITH tr AS (SELECT greatest(0.0, least(200.0, quantity)) AS q0, quantity, discount, tax, level, open FROM {_TRAIN} AS a),
p AS (SELECT median(CASE WHEN quantity IS NOT NULL THEN q0 END) AS mq FROM tr),
m AS (SELECT {_MODE.format(c='level', src='tr')} AS ml, {_MODE.format(c='open', src='tr')} AS mo),
f AS (SELECT CASE WHEN quantity IS NULL THEN mq ELSE q0 END AS q, discount AS d, tax AS t, CAST(coalesce(level, ml) AS DOUBLE) - 1 AS l FROM tr, p, m)
SELECT key, (CASE WHEN quantity IS NULL THEN mq ELSE greatest(0.0, least(200.0, quantity)) END - (SELECT avg(q) FROM f)) / (SELECT stddev_pop(q) FROM f) AS prep_quantity,
(discount - (SELECT avg(d) FROM f)) / (SELECT stddev_pop(d) FROM f) AS prep_discount, (tax - (SELECT avg(t) FROM f)) / (SELECT stddev_pop(t) FROM f) AS prep_tax,
(CAST(coalesce(level, ml) AS DOUBLE) - 1 - (SELECT avg(l) FROM f)) / (SELECT stddev_pop(l) FROM f) AS prep_level, CAST(CAST(coalesce(open, mo) AS INTEGER) AS DOUBLE) AS prep_open
FROM {_TEST} AS b, p, m""", "prep_quantity", "prep_discount", "prep_tax", "prep_level"))
def g9(spark, sf):
    train, test = sides(spark, sf)
    model = prep.ColumnPrep.of(PLAN).fit(train)
    ready = model.transform(test)
    return rounded(ready.select("key", *[prep.PREFIX + f for f in model.feature_names()]))


VARIANTS = {
    "1_base": PLAN,
    "2_onehot": replace(PLAN, onehot=True),
    "3_derivados": replace(PLAN, derived={"descuento_neto": "discount - tax", "nivel_por_cantidad": "quantity * double(level)"}),
    "4_no_lineales": replace(PLAN, log=("quantity",), root=("discount",), square=("tax",)),
    "5_sin_impuesto": replace(PLAN, numeric=("quantity", "discount")),
    "6_minimo": replace(PLAN, numeric=("quantity",)),
    "7_indicador": replace(PLAN, indicator=True),
}


@query("g10_variant_comparison")
def g10(spark, sf):
    train = sides(spark, sf)[0]
    return evaluate.compare_variants({n: LinearFit(TARGET, p, 1.0) for n, p in VARIANTS.items()}, train, TARGET, "key")
