"""Contracts, gates and alerts (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FRAME, order_frame, query, rounded, rsql, table
from wardframe.functions.cleaning import clipped
from wardframe.operators import contracts as co


def faulty_lines(spark, sf):
    """Line items with injected faults: nulls, out-of-range values, odd levels."""
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(line != 7, F.col("l_quantity")).alias("quantity"),
        F.when(line == 6, F.col("l_discount") + 1).otherwise(F.col("l_discount")).alias("discount"),
        F.when(line == 5, F.lit(9.0)).otherwise((line % 3).cast("double")).alias("level"),
        F.when(line != 1, F.col("l_tax")).alias("tax"), F.col("l_returnflag").alias("flag"),
    )


FAULTY = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_quantity END AS quantity,
 CASE WHEN l_linenumber = 6 THEN l_discount + 1 ELSE l_discount END AS discount,
 CASE WHEN l_linenumber = 5 THEN 9.0 ELSE CAST(l_linenumber % 3 AS DOUBLE) END AS level,
 CASE WHEN l_linenumber <> 1 THEN l_tax END AS tax, l_returnflag AS flag FROM lineitem)"""

CONTRACT = co.Contract(
    co.column("quantity", types=("double",), within=(1, 45), nulls=0.10),
    co.column("discount", types=("double",), within=(0, 0.1), nulls=0.0),
    co.column("level", types=("double",), among=(0, 1, 2)),
    co.column("tax", types=("double",), nulls=0.05),
    co.enough_known(6),
    co.holds("impuesto_menor", "tax is below discount plus 0.05", ("tax", "discount"), lambda: F.col("tax") < F.col("discount") + 0.05),
    co.holds("ausente", "needs a column that is not here", ("nope",), lambda: F.col("nope") > 0),
    open_schema=True,
)

COUNTS = f"""SELECT 'exceso_de_nulos' AS regla, 'quantity' AS columna, count(*) AS filas, count(*) FILTER (quantity IS NULL) AS filas_afectadas, avg((quantity IS NULL)::INTEGER) <= 0.10 AS cumple FROM {FAULTY} AS t
UNION ALL SELECT 'exceso_de_nulos', 'discount', count(*), count(*) FILTER (discount IS NULL), count(*) FILTER (discount IS NULL) = 0 FROM {FAULTY} AS t
UNION ALL SELECT 'exceso_de_nulos', 'level', count(*), count(*) FILTER (level IS NULL), true FROM {FAULTY} AS t
UNION ALL SELECT 'exceso_de_nulos', 'tax', count(*), count(*) FILTER (tax IS NULL), avg((tax IS NULL)::INTEGER) <= 0.05 FROM {FAULTY} AS t
UNION ALL SELECT 'fuera_de_rango', 'quantity', count(*), count(*) FILTER (quantity < 1 OR quantity > 45), count(*) FILTER (quantity < 1 OR quantity > 45) = 0 FROM {FAULTY} AS t
UNION ALL SELECT 'fuera_de_rango', 'discount', count(*), count(*) FILTER (discount < 0 OR discount > 0.1), count(*) FILTER (discount < 0 OR discount > 0.1) = 0 FROM {FAULTY} AS t
UNION ALL SELECT 'categoria_invalida', 'level', count(*), count(*) FILTER (level NOT IN (0, 1, 2)), count(*) FILTER (level NOT IN (0, 1, 2)) = 0 FROM {FAULTY} AS t
UNION ALL SELECT 'fila_sin_informacion', '', count(*), count(*) FILTER ((quantity IS NULL)::INTEGER + (tax IS NULL)::INTEGER > 1), count(*) FILTER ((quantity IS NULL)::INTEGER + (tax IS NULL)::INTEGER > 1) = 0 FROM {FAULTY} AS t
UNION ALL SELECT 'relacion_incumplida', 'tax, discount', count(*), count(*) FILTER (NOT coalesce(tax < discount + 0.05, false)), count(*) FILTER (NOT coalesce(tax < discount + 0.05, false)) = 0 FROM {FAULTY} AS t"""


@query("c11_rule_counts", COUNTS)
def c11(spark, sf):
    return co.rule_counts(faulty_lines(spark, sf), CONTRACT).drop("detalle")


@query("c11_review", f"SELECT regla, columna, filas_afectadas FROM ({COUNTS}) AS c WHERE NOT cumple")
def c11r(spark, sf):
    return co.review(faulty_lines(spark, sf), CONTRACT).drop("detalle")


@query("c1_column_presence", """SELECT regla, columna, min(n) > 0 AS leido FROM (SELECT count(*) AS n FROM orders) AS o,
(VALUES ('columna_faltante', 'falta'), ('columna_inesperada', '')) AS v(regla, columna) GROUP BY regla, columna""")
def c1(spark, sf):
    orders = table(spark, sf, "orders")
    contract = co.Contract(*(co.column(c, nulls=1.0) for c in orders.columns[1:]), co.column("falta"), co.column("opcional", optional=True))
    n = orders.agg(F.count("*")).scalar()
    return co.review(orders, contract).select("regla", "columna", (n > 0).alias("leido"))


@query("c2_type_check", "SELECT 'tipo_inesperado' AS regla, 'o_orderkey' AS columna, count(*) > 0 AS leido FROM orders")
def c2(spark, sf):
    orders = table(spark, sf, "orders")
    contract = co.Contract(co.column("o_orderkey", types=("int", "string")), co.column("o_totalprice", types=("double",)), open_schema=True)
    n = orders.agg(F.count("*")).scalar()
    return co.review(orders, contract).select("regla", "columna", (n > 0).alias("leido"))


@query("c3_null_share", f"SELECT 'tax' AS columna, count(*) FILTER (tax IS NULL) AS filas_afectadas FROM {FAULTY} AS t HAVING avg((tax IS NULL)::INTEGER) > 0.1")
def c3(spark, sf):
    contract = co.Contract(co.column("tax", nulls=0.1), co.column("quantity", nulls=0.9), co.column("discount", nulls=0.0), open_schema=True)
    return co.review(faulty_lines(spark, sf), contract).select("columna", "filas_afectadas")


@query("c4_range_examples", f"""SELECT 'quantity' AS columna, string_agg(CAST(quantity AS VARCHAR), ', ' ORDER BY quantity) AS ejemplos
FROM (SELECT DISTINCT quantity FROM {FAULTY} AS t WHERE quantity > 40 ORDER BY quantity LIMIT 5) AS d""")
def c4(spark, sf):
    contract = co.Contract(co.column("quantity", within=(1, 40)), open_schema=True)
    return co.rule_examples(faulty_lines(spark, sf), contract).select("columna", "ejemplos")


@query("c5_closed_set", f"SELECT 'level' AS columna, '9.0' AS ejemplos, count(*) AS filas_afectadas FROM {FAULTY} AS t WHERE level = 9")
def c5(spark, sf):
    contract = co.Contract(co.column("level", among=(0, 1, 2), nulls=1.0), open_schema=True)
    rows = faulty_lines(spark, sf)
    return co.rule_examples(rows, contract).join(co.review(rows, contract, examples=False).select("columna", "filas_afectadas"), "columna").select("columna", "ejemplos", "filas_afectadas")


_DATES = """(SELECT CASE WHEN event_id % 10 = 0 THEN '2024-13-45' WHEN event_id % 10 = 1 THEN strftime(ts, '%d/%m/%Y')
 WHEN event_id % 10 = 2 THEN NULL WHEN event_id % 10 = 3 THEN year(ts) || '-' || month(ts) || '-' || day(ts) ELSE strftime(ts, '%Y-%m-%d') END AS fecha FROM events)"""


@query("c6_date_format", f"SELECT 'formato_de_fecha_invalido' AS regla, 'fecha' AS columna, count(*) AS filas_afectadas FROM {_DATES} AS d WHERE fecha IS NOT NULL AND try_strptime(fecha, '%Y-%m-%d') IS NULL")
def c6(spark, sf):
    step = F.col("event_id") % 10
    dates = table(spark, sf, "events").select(
        F.when(step == 0, F.lit("2024-13-45")).when(step == 1, F.date_format("ts", "dd/MM/yyyy")).when(step == 2, F.lit(None)).when(step == 3, F.date_format("ts", "yyyy-M-d")).otherwise(
            F.date_format("ts", "yyyy-MM-dd")).alias("fecha"))
    contract = co.Contract(co.column("fecha", dates="%Y-%m-%d", nulls=0.5))
    return co.review(dates, contract).drop("detalle")


@query("c7_unique_key", """SELECT 'o_orderkey' AS columna, count(o_orderkey) - count(DISTINCT o_orderkey) AS repetidas FROM orders
UNION ALL SELECT 'l_orderkey', count(l_orderkey) - count(DISTINCT l_orderkey) FROM lineitem""")
def c7(spark, sf):
    return co.repeated_keys(table(spark, sf, "orders"), "o_orderkey").unionByName(co.repeated_keys(table(spark, sf, "lineitem"), "l_orderkey"))


@query("c8_duplicate_rows", f"SELECT count(*) - count(DISTINCT (quantity, level, flag)) AS repetidas FROM {FAULTY} AS t")
def c8(spark, sf):
    return co.repeated_rows(faulty_lines(spark, sf), ["quantity", "level", "flag"])


@query("c9_min_known", f"SELECT 'fila_sin_informacion' AS regla, count(*) AS filas_afectadas FROM {FAULTY} AS t WHERE quantity IS NULL OR tax IS NULL")
def c9(spark, sf):
    return co.review(faulty_lines(spark, sf), co.Contract(co.enough_known(7), open_schema=True)).select("regla", "filas_afectadas")


_NEAR = "abs(discount + tax - total) <= 1e-9 OR discount IS NULL OR tax IS NULL"


@query("c10_relations", f"""SELECT 'relacion_incumplida' AS regla, 'discount, tax, total' AS columna, count(*) AS filas_afectadas
FROM (SELECT *, discount + tax + CASE WHEN l_linenumber = 2 THEN 0.5 ELSE 0.0 END AS total FROM {FAULTY} AS t) AS u WHERE NOT coalesce({_NEAR}, false)
UNION ALL SELECT 'relacion_incumplida', 'quantity, tax', count(*) FROM {FAULTY} AS t WHERE NOT coalesce(quantity > tax, false)""")
def c10(spark, sf):
    rows = faulty_lines(spark, sf).withColumn("total", F.col("discount") + F.col("tax") + F.when(F.col("l_linenumber") == 2, 0.5).otherwise(0.0))
    agree = lambda: (F.abs(F.col("discount") + F.col("tax") - F.col("total")) <= 1e-9) | F.col("discount").isNull() | F.col("tax").isNull()
    contract = co.Contract(
        co.holds("total", "total adds up", ("discount", "tax", "total"), agree),
        co.holds("orden", "null is a failure", ("quantity", "tax"), lambda: F.col("quantity") > F.col("tax")), open_schema=True)
    return co.review(rows, contract).drop("detalle")


@query("c12_gate", f"SELECT max(filas) AS filas, count(*) FILTER (NOT cumple) AS reglas FROM ({COUNTS}) AS c")
def c12(spark, sf):
    rows = faulty_lines(spark, sf)
    passed = co.gate(rows, co.Contract(co.column("discount", nulls=0.0), open_schema=True))
    try:
        co.gate(rows, CONTRACT)
        broken = 0
    except co.ContractError as error:
        broken = len(error.violations)
    return passed.agg(F.count("*").alias("filas")).withColumn("reglas", F.lit(broken))


@query("c13_dataset_comparison", f"""WITH a AS (SELECT *, CASE WHEN quantity IS NULL THEN NULL ELSE greatest(0.0, least(150.5, quantity)) END AS q2, CASE WHEN key % 19 <> 0 THEN tax END AS t2 FROM {FRAME} AS f)
SELECT 'valor_no_presente_en_el_origen' AS regla, 'quantity' AS columna, count(DISTINCT q2) AS filas_afectadas FROM a WHERE q2 = 150.5
UNION ALL SELECT 'nulos_introducidos', 'tax', count(*) FROM a WHERE t2 IS NULL
UNION ALL SELECT 'columna_perdida', 'level', 0""")
def c13(spark, sf):
    before = order_frame(spark, sf)
    after = before.withColumns({"quantity": clipped(F.col("quantity"), 0, 150.5), "tax": F.when(F.col("key") % 19 != 0, F.col("tax"))}).drop("level")
    return co.dataset_comparison(before, after, ["quantity", "discount", "tax", "level", "target"]).drop("detalle")


@query("c14_soft_alerts", rsql(f"""SELECT * FROM (
SELECT 'fuera_de_rango' AS regla, 'quantity' AS columna, 'advertencia' AS severidad, CAST(count(*) FILTER (quantity < 1 OR quantity > 45) AS DOUBLE) AS valor FROM {FAULTY} AS t
UNION ALL SELECT 'categoria_invalida', 'flag', 'advertencia', CAST(count(*) FILTER (flag NOT IN ('A', 'N')) AS DOUBLE) FROM {FAULTY} AS t
UNION ALL SELECT 'proporcion_verdadero', 'alto', 'advertencia', avg((quantity > 40)::INTEGER) FROM {FAULTY} AS t
UNION ALL SELECT 'exceso_de_nulos', 'quantity', 'advertencia', avg((quantity IS NULL)::INTEGER) FROM {FAULTY} AS t
UNION ALL SELECT 'exceso_de_nulos', 'alto', 'advertencia', avg((quantity IS NULL)::INTEGER) FROM {FAULTY} AS t
UNION ALL SELECT 'objetivo_nulo', 'tax', 'advertencia', CAST(count(*) FILTER (tax IS NULL) AS DOUBLE) FROM {FAULTY} AS t
UNION ALL SELECT 'fuera_de_paso', 'discount', 'advertencia', CAST(count(*) FILTER (abs(discount / 0.5 - round(discount / 0.5)) > 1e-9) AS DOUBLE) FROM {FAULTY} AS t
UNION ALL SELECT 'fila_duplicada', '', 'advertencia', CAST(count(*) - count(DISTINCT (quantity, flag)) AS DOUBLE) FROM {FAULTY} AS t) AS a
WHERE NOT (regla = 'exceso_de_nulos' AND valor <= 0.1) AND valor > 0""", "valor"))
def c14(spark, sf):
    rows = faulty_lines(spark, sf).withColumn("alto", F.col("quantity") > 40)
    return rounded(co.soft_alerts(rows, {"quantity": (1, 45)}, ["alto"], ["discount"], {"flag": ["A", "N"]}, "tax", ["quantity", "flag"]))


@query("c15_identical_columns", f"SELECT 'quantity' AS columna_a, 'copia' AS columna_b FROM {FAULTY} AS t HAVING count(*) > 0")
def c15(spark, sf):
    return co.identical_columns(faulty_lines(spark, sf).withColumn("copia", F.col("quantity") + 0.0))


@query("c16_constant_columns", f"SELECT 'fija' AS columna FROM {FAULTY} AS t HAVING count(*) > 0 UNION ALL SELECT 'vacia' FROM {FAULTY} AS t HAVING count(*) > 0")
def c16(spark, sf):
    return co.constant_columns(faulty_lines(spark, sf).withColumns({"fija": F.when(F.col("level") > 0, F.lit("x")), "vacia": F.lit(None).cast("string")}))
