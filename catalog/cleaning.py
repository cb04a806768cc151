"""Sources, sinks, cleaning and typing (A, B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DOMAINS, FRAME, LEVELS, SCORE_DOMAINS, TARGET, heuristic_scored, order_frame, query, rounded, rsql, scored_cte, table,
)
from wardframe.functions.cleaning import NULL_SENTINELS
from wardframe.operators import clean
from wardframe.operators.contracts import Contract, ContractError, column, gate
from wardframe.operators.models import fit_linear
from wardframe.operators.prep import PrepPlan
from wardframe.sources import tabular
from wardframe.sources.scratch import scratch_path

SENTINELS_SQL = ", ".join(f"'{s}'" for s in NULL_SENTINELS)


def dirty(spark, sf):
    """Line items as text, with sentinels, padding and unconvertible values by rule."""
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias(" Order Key"),
        line.cast("string").alias("Line"),
        F.when(line == 7, F.lit(" N/A ")).when(line == 6, F.lit("-")).when(line == 5, F.lit("1d")).otherwise(
            F.col("l_quantity").cast("string")).alias("Quantity "),
        F.when(line == 4, F.lit("")).when(line == 3, F.lit("Desconocido")).otherwise(
            F.concat(F.lit("  "), F.col("l_returnflag"), F.lit("\t "))).alias("Flag"),
        F.when(F.col("l_linestatus") == "O", F.lit("1")).when(line == 2, F.lit("si")).otherwise(F.lit("0")).alias("Open"),
        F.when(line == 1, F.lit("12.5")).otherwise(F.col("l_suppkey").cast("string")).alias("Supplier"),
    )


DIRTY = """(SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line,
  CASE WHEN l_linenumber = 7 THEN ' N/A ' WHEN l_linenumber = 6 THEN '-' WHEN l_linenumber = 5 THEN '1d'
       ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
  CASE WHEN l_linenumber = 4 THEN '' WHEN l_linenumber = 3 THEN 'Desconocido'
       ELSE '  ' || l_returnflag || chr(9) || ' ' END AS flag,
  CASE WHEN l_linestatus = 'O' THEN '1' WHEN l_linenumber = 2 THEN 'si' ELSE '0' END AS open,
  CASE WHEN l_linenumber = 1 THEN '12.5' ELSE CAST(l_suppkey AS VARCHAR) END AS supplier
  FROM lineitem)"""
NAMES = ["order_key", "line", "quantity", "flag", "open", "supplier"]
STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def _strip(c):
    return STRIP.format(c)


def _unified(c):
    return f"CASE WHEN lower({_strip(c)}) NOT IN ({SENTINELS_SQL}) THEN {_strip(c)} END"


UNIFIED = f"(SELECT {', '.join(f'{_unified(c)} AS {c}' for c in NAMES)} FROM {DIRTY} AS dirty)"

TYPING = clean.Typing(
    integers=("line", "supplier"), decimals=("quantity",), booleans=("open",), ordinals={"flag": ("A", "N")},
)


def unified(spark, sf):
    return clean.unify_nulls(clean.normalise_names(dirty(spark, sf)))


# --- A ------------------------------------------------------------------------------------


@query("a1_text_scan", f"""SELECT flag, line, count(*) AS n, count(quantity) AS known, 'string' AS kind
FROM (SELECT {_strip('flag')} AS flag, line, quantity FROM {DIRTY} AS dirty) AS t GROUP BY flag, line""")
def a1(spark, sf):
    path = scratch_path(spark, "csv")
    clean.normalise_names(dirty(spark, sf)).write.option("header", True).csv(path)
    text = tabular.read_text_table(spark, path)
    kind = "/".join(sorted(set(dict(text.dtypes).values())))
    return text.withColumn("flag", F.coalesce(F.trim(F.regexp_replace("flag", r"\s", "")), F.lit(""))).groupBy("flag", "line").agg(
        F.count("*").alias("n"), F.count("quantity").alias("known"), F.lit(kind).alias("kind"))


@query("a2_contracted_scan", "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag")
def a2(spark, sf):
    contract = Contract(
        column("l_discount", types=("double",), within=(0, 1), nulls=0.0), column("l_quantity", types=("double",), within=(1, 50)), open_schema=True)
    rows = tabular.read_contracted(spark, f"{sf}/lineitem.parquet", contract)
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("a3_table_by_suffix", """SELECT o_orderstatus AS status, 'csv' AS origin, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, 'parquet', count(*) FROM orders GROUP BY 1""")
def a3(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    parts = []
    for suffix in ("csv", "parquet"):
        path = f"{scratch_path(spark, 'suffix')}.{suffix}"
        tabular.write_predictions(orders, path)
        parts.append(tabular.read_table(spark, path).groupBy("status").agg(F.lit(suffix).alias("origin"), F.count("*").alias("n")))
    return parts[0].unionByName(parts[1]).select("status", "origin", "n")


@query("a4_gated_sink", """SELECT 'aceptada' AS intento, count(*) AS filas, sum(CAST(round(o_totalprice*100) AS BIGINT))::BIGINT AS centavos FROM orders
UNION ALL SELECT 'rechazada', count(*), sum(CAST(round(o_totalprice*100) AS BIGINT))::BIGINT FROM orders""")
def a4(spark, sf):
    orders, path = table(spark, sf, "orders"), f"{scratch_path(spark, 'gated')}.parquet"
    tabular.write_gated(orders, path)
    wrong = Contract(column("o_totalprice", within=(0, 1)), open_schema=True)
    outcome = "aceptada"
    try:
        tabular.write_gated(orders.limit(0).union(orders), path, [lambda df: gate(df, wrong)])
    except ContractError:
        outcome = "rechazada"  # the table of the first write is still there
    stored = tabular.read_parquet(spark, path).agg(F.count("*").alias("filas"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("centavos"))
    return stored.select(F.explode(F.array(F.lit("aceptada"), F.lit(outcome))).alias("intento"), "filas", "centavos")


@query("a5_prediction_sink", scored_cte() + """SELECT origin, count(*) AS n, round(sum(prediction), 4) AS total
FROM s, (SELECT 'csv' AS origin UNION ALL SELECT 'parquet') AS o GROUP BY origin""")
def a5(spark, sf):
    scored, parts = heuristic_scored(spark, sf).select("key", "prediction"), []
    for suffix in ("csv", "parquet"):
        path = f"{scratch_path(spark, 'pred')}.{suffix}"
        tabular.write_predictions(scored, path)
        parts.append(tabular.read_table(spark, path).agg(F.lit(suffix).alias("origin"), F.count("*").alias("n"), F.round(F.sum(F.col("prediction").cast("double")), 4).alias("total")))
    return parts[0].unionByName(parts[1])


@query("a6_report_sink", "SELECT 'por_estado' AS informe, count(DISTINCT o_orderstatus) AS filas FROM orders UNION ALL SELECT 'por_prioridad', count(DISTINCT o_orderpriority) FROM orders")
def a6(spark, sf):
    orders = table(spark, sf, "orders")
    written = tabular.write_reports({
        "por_estado": orders.groupBy("o_orderstatus").count(), "por_prioridad": orders.groupBy("o_orderpriority").count(),
        "vacio": orders.where(F.lit(False)), "ausente": None,
    }, scratch_path(spark, "reports"))
    parts = [tabular.read_parquet(spark, p).agg(F.lit(name).alias("informe"), F.count("*").alias("filas")) for name, p in written.items()]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


@query("a7_model_reload", f"SELECT count(*) AS filas, CAST(0 AS DOUBLE) AS diferencia FROM {FRAME} AS frame")
def a7(spark, sf):
    frame = order_frame(spark, sf)
    plan = PrepPlan(numeric=("quantity", "discount"), ordinal={"level": LEVELS}, boolean=("open",), domains=DOMAINS)
    model = fit_linear(frame, TARGET, plan, 1.0)
    path = scratch_path(spark, "model")
    tabular.save_model(model, path, frame)
    first = model.transform(frame).withColumnRenamed("prediction", "first").select(*frame.columns, "first")
    both = tabular.load_model(spark, path).transform(first)
    return both.agg(F.count("*").alias("filas"), F.max(F.abs(F.col("prediction") - F.col("first"))).alias("diferencia"))


@query("a8_schema_round_trip", "SELECT count(*) AS filas, true AS filas_iguales, true AS columnas_iguales, true AS tipos_iguales FROM orders")
def a8(spark, sf):
    orders, path = table(spark, sf, "orders"), scratch_path(spark, "round")
    orders.write.parquet(path)
    n = orders.agg(F.count("*").alias("n")).scalar()
    return tabular.round_trip_check(orders, path).select(n.alias("filas"), "filas_iguales", "columnas_iguales", "tipos_iguales")


# --- B ------------------------------------------------------------------------------------


@query("b1_normalise_names", f"SELECT count(order_key) AS order_key, count(line) AS line, count(quantity) AS quantity, count(flag) AS flag, count(open) AS open, count(supplier) AS supplier FROM {DIRTY} AS dirty")
def b1(spark, sf):
    named = clean.normalise_names(dirty(spark, sf))
    return named.agg(*[F.count(c).alias(c) for c in named.columns])


@query("b2_require_columns", f"SELECT line, quantity, count(*) AS n FROM {DIRTY} AS dirty GROUP BY line, quantity")
def b2(spark, sf):
    kept = clean.require_columns(clean.normalise_names(dirty(spark, sf)), ["line", "quantity"])
    return kept.groupBy(*kept.columns).agg(F.count("*").alias("n"))


@query("b3_split_context", f"SELECT line, open, count(*) AS n FROM {DIRTY} AS dirty GROUP BY line, open")
def b3(spark, sf):
    named = clean.normalise_names(dirty(spark, sf))
    context = clean.context_columns(named, ["order_key", "quantity", "flag", "supplier"])
    return named.groupBy(*context).agg(F.count("*").alias("n"))


@query("b4_unify_nulls", f"SELECT flag, quantity, count(*) AS n FROM {UNIFIED} AS u GROUP BY flag, quantity")
def b4(spark, sf):
    return unified(spark, sf).groupBy("flag", "quantity").agg(F.count("*").alias("n"))


@query("b5_sentinel_audit", f"""WITH cells AS (SELECT 'quantity' AS "column", quantity AS value FROM {DIRTY} AS d UNION ALL SELECT 'flag', flag FROM {DIRTY} AS d
UNION ALL SELECT 'open', open FROM {DIRTY} AS d),
counts AS (SELECT "column", value, count(*) AS n FROM cells WHERE lower({_strip('value')}) IN ({SENTINELS_SQL}) GROUP BY 1, 2)
SELECT "column", value, n, CAST(sum(n) OVER (PARTITION BY "column") AS BIGINT) AS total FROM counts""")
def b5(spark, sf):
    return clean.sentinel_audit(clean.normalise_names(dirty(spark, sf)), ["quantity", "flag", "open"])


@query("b6_exact_dedup", "SELECT count(*) AS filas, count(DISTINCT (l_returnflag, l_linestatus, l_quantity, l_discount, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END)) AS distintas FROM lineitem")
def b6(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("line"))
    counts = clean.duplicates_removed(rows)
    kept = clean.drop_duplicate_rows(rows).agg(F.count("*").alias("n")).scalar()
    return counts.where(F.col("distintas") == kept).select("filas", "distintas")


_LOST = f"""(SELECT 'line' AS columna, 'valor_no_convertible' AS regla, line AS value FROM {UNIFIED} AS u WHERE false
UNION ALL SELECT 'supplier', 'valor_no_convertible', supplier FROM {UNIFIED} AS u WHERE supplier = '12.5'
UNION ALL SELECT 'quantity', 'valor_no_convertible', quantity FROM {UNIFIED} AS u WHERE quantity = '1d'
UNION ALL SELECT 'open', 'valor_no_booleano', open FROM {UNIFIED} AS u WHERE open = 'si'
UNION ALL SELECT 'flag', 'categoria_invalida', flag FROM {UNIFIED} AS u WHERE flag = 'R')"""


@query("b7_typing_violations", f"SELECT regla, columna, min(value) AS detalle, count(*) AS filas_afectadas FROM {_LOST} AS lost GROUP BY regla, columna")
def b7(spark, sf):
    return clean.lost_in_typing(unified(spark, sf), TYPING)


_LARGE = "(9007199254740993 + o_orderkey)"


@query("b7_large_integers", f"""SELECT count(*) AS n, CAST(sum({_LARGE} % 1000003) AS BIGINT) AS resto, count(*) FILTER (o_orderkey % 5 <> 4) AS validos FROM orders WHERE o_orderkey % 5 <> 4
UNION ALL SELECT count(*), NULL, 0 FROM orders WHERE o_orderkey % 5 = 4""")
def b7large(spark, sf):
    """Whole numbers beyond 2^53 keep every digit, with and without a zero fraction; halves are refused."""
    key = F.lit(9007199254740993) + F.col("o_orderkey")
    step = F.col("o_orderkey") % 5
    text = F.when(step == 4, F.concat(key.cast("string"), F.lit(".5"))).when(step == 3, F.concat(key.cast("string"), F.lit(".0"))).otherwise(key.cast("string"))
    typed = clean.typed_columns(table(spark, sf, "orders").select(step.alias("step"), text.alias("v")), clean.Typing(integers=("v",)))
    return typed.groupBy((F.col("step") == 4).alias("g")).agg(
        F.count("*").alias("n"), F.sum(F.col("v") % 1000003).alias("resto"), F.count("v").alias("validos")).drop("g")


@query("b7_typed_columns", rsql(f"""SELECT flag, CASE WHEN open = '1' THEN true WHEN open = '0' THEN false END AS open, count(*) AS n,
CAST(sum(CASE WHEN supplier <> '12.5' THEN CAST(supplier AS BIGINT) END) AS BIGINT) AS supplier, sum(CASE WHEN quantity <> '1d' THEN CAST(quantity AS DOUBLE) END) AS quantity
FROM (SELECT * REPLACE (CASE WHEN flag IN ('A','N') THEN flag END AS flag) FROM {UNIFIED} AS u) AS t GROUP BY 1, 2""", "quantity"))
def b7t(spark, sf):
    typed = clean.typed_columns(unified(spark, sf), TYPING)
    return rounded(typed.groupBy("flag", "open").agg(F.count("*").alias("n"), F.sum("supplier").alias("supplier"), F.sum("quantity").alias("quantity")))


@query("b7_nulls_before_after", f"""SELECT 'line' AS columna, count(*) FILTER (line IS NULL) AS nulos_antes, count(*) FILTER (line IS NULL) AS nulos_despues FROM {UNIFIED} AS u
UNION ALL SELECT 'supplier', count(*) FILTER (supplier IS NULL), count(*) FILTER (supplier IS NULL OR supplier = '12.5') FROM {UNIFIED} AS u
UNION ALL SELECT 'quantity', count(*) FILTER (quantity IS NULL), count(*) FILTER (quantity IS NULL OR quantity = '1d') FROM {UNIFIED} AS u
UNION ALL SELECT 'open', count(*) FILTER (open IS NULL), count(*) FILTER (open IS NULL OR open = 'si') FROM {UNIFIED} AS u
UNION ALL SELECT 'flag', count(*) FILTER (flag IS NULL), count(*) FILTER (flag IS NULL OR flag = 'R') FROM {UNIFIED} AS u""")
def b7n(spark, sf):
    return clean.typing_summary(unified(spark, sf), TYPING)


@query("b7_most_lost", f"""SELECT columna AS "column", row_number() OVER (PARTITION BY columna ORDER BY n DESC, value) AS posicion, value, n
FROM (SELECT columna, value, count(*) AS n FROM {_LOST} AS lost GROUP BY 1, 2) AS c QUALIFY posicion <= 10""")
def b7m(spark, sf):
    return clean.most_lost(unified(spark, sf), TYPING)


@query("b8_to_double", rsql(f"SELECT CAST(CAST(open AS INTEGER) AS DOUBLE) AS open, CAST(level AS DOUBLE) AS level, count(*) AS n, sum(quantity) AS quantity FROM {FRAME} AS f GROUP BY 1, 2", "quantity"))
def b8(spark, sf):
    numbers = clean.to_doubles(order_frame(spark, sf), ["quantity", "level", "open"])
    return rounded(numbers.groupBy("open", "level").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity")))


_CLIPPED = "CASE WHEN quantity IS NULL THEN NULL ELSE greatest(50.0, least(200.0, quantity)) END"


@query("b9_clip", rsql(f"SELECT {_CLIPPED} AS quantity, count(*) AS n FROM {FRAME} AS f GROUP BY 1", "quantity"))
def b9(spark, sf):
    clipped = clean.clip_to_domain(order_frame(spark, sf), {"quantity": (50, 200), "absent": (0, 1)})
    return rounded(clipped.groupBy("quantity").agg(F.count("*").alias("n")))


@query("b9_clipped_cells", f"SELECT 'quantity' AS columna, count(*) FILTER (quantity < 50 OR quantity > 200) AS celdas FROM {FRAME} AS f UNION ALL SELECT 'discount', count(*) FILTER (discount < 0.02 OR discount > 0.08) FROM {FRAME} AS f")
def b9c(spark, sf):
    return clean.clipped_cells(order_frame(spark, sf), {"quantity": (50, 200), "discount": (0.02, 0.08)})


@query("b10_derived", rsql(f"""SELECT key, (quantity / 400.0 + discount / 0.1 + (tax - 0.01) / 0.07) / 3 AS indice, (discount + tax) / 2 AS media,
CAST(level AS DOUBLE) * CAST(CAST(open AS INTEGER) AS DOUBLE) AS producto FROM {FRAME} AS f""", "indice", "media", "producto"))
def b10(spark, sf):
    numbers = clean.to_doubles(order_frame(spark, sf), ["level", "open"])
    return rounded(numbers.select(
        "key", clean.mean_of_scaled({"quantity": (0, 400), "discount": (0, 0.1), "tax": (0.01, 0.08)}).alias("indice"),
        clean.mean_of_two("discount", "tax").alias("media"), clean.product("level", "open").alias("producto")))


@query("b11_nonlinear", rsql(f"SELECT key, ln(1 + quantity) AS log_quantity, sqrt(discount) AS sqrt_discount, tax * tax AS tax_cuadrado FROM {FRAME} AS f", "log_quantity", "sqrt_discount", "tax_cuadrado"))
def b11(spark, sf):
    return rounded(clean.add_nonlinear(order_frame(spark, sf), ["quantity"], ["discount"], ["tax"]).select("key", "log_quantity", "sqrt_discount", "tax_cuadrado"))


@query("b12_feature_matrix", rsql(f"""SELECT key, CASE WHEN quantity IS NULL THEN NULL ELSE greatest(0.0, least(200.0, quantity)) END AS quantity, discount, tax, CAST(level AS DOUBLE) AS level,
CAST(CAST(open AS INTEGER) AS DOUBLE) AS open, discount * tax AS cruce, target FROM {FRAME} AS f""", "quantity", "discount", "tax", "cruce", "target", digits=12))
def b12(spark, sf):
    return rounded(clean.feature_matrix(order_frame(spark, sf), TARGET, DOMAINS, {"cruce": clean.product("discount", "tax")}, keep=["key"]), 12)


@query("b13_domain_scale", rsql(f"SELECT key, quantity / 400.0 AS quantity, discount / 0.1 AS discount, tax / 0.08 AS tax FROM {FRAME} AS f", "quantity", "discount", "tax"))
def b13(spark, sf):
    keep = {c: SCORE_DOMAINS[c] for c in ("quantity", "discount", "tax")}
    return rounded(clean.domain_scale(order_frame(spark, sf).select("key", *keep), keep))


