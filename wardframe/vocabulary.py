"""Words that appear in result tables.

Fixed values: report consumers match on these codes, so they are stated once, as text.
"""

# --- Fixed values: rule codes of a contract review ---------------------------------------
COLUMN_MISSING = "columna_faltante"
COLUMN_UNEXPECTED = "columna_inesperada"
COLUMN_REPEATED = "columna_duplicada"
TYPE_UNEXPECTED = "tipo_inesperado"
TOO_MANY_NULLS = "exceso_de_nulos"
OUT_OF_RANGE = "fuera_de_rango"
INVALID_CATEGORY = "categoria_invalida"
INVALID_DATE = "formato_de_fecha_invalido"
REPEATED_KEY = "clave_duplicada"
REPEATED_ROW = "fila_duplicada"
POOR_ROW = "fila_sin_informacion"
BROKEN_RELATION = "relacion_incumplida"
NOT_CONVERTIBLE = "valor_no_convertible"
NOT_BOOLEAN = "valor_no_booleano"
INVENTED_ROWS = "filas_inventadas"
LOST_COLUMN = "columna_perdida"
NEW_VALUE = "valor_no_presente_en_el_origen"
NEW_NULLS = "nulos_introducidos"

# --- Fixed values: split checks and their severities -------------------------------------
OK = "ok"
WARNING = "advertencia"
ERROR = "error"
CHECK_KEYS = "indices_solapados"
CHECK_SHARED = "filas_compartidas"
CHECK_SHARE = "proporcion_de_la_particion"
CHECK_SIZE = "tamano_del_conjunto_de_prueba"
CHECK_TARGET_DRIFT = "deriva_del_objetivo"
CHECK_COLUMN_DRIFT = "deriva_de_la_variable"
CHECK_NEW_CATEGORY = "categorias_nuevas_en_prueba"
CHECK_NULL_DRIFT = "deriva_de_los_nulos"
CHECK_DOMAIN = "deriva_multivariante"

# --- Fixed values: baskets and the label of a missing level ------------------------------
BASKETS = ("ambiciosa", "probable", "segura")
MISSING_LEVEL = "faltante"
