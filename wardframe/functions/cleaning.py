"""Column expressions for text cleaning, typing and arithmetic.  All of them stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no data" (compared after trimming and lower-casing).
NULL_SENTINELS = (
    "", "?", "-", "--", ".", "na", "n/a", "#n/a", "nan", "null", "none", "missing", "unknown",
    "desconocido", "sin dato", "ninguno",
)

# A decimal literal a spreadsheet would accept; keeps '1d', '0x1f' or 'NaN' out of try_cast.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def stripped(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def unified_null(text: Column, sentinels: Sequence[str] = NULL_SENTINELS) -> Column:
    """NULL for any sentinel spelling, otherwise the stripped text."""
    clean = stripped(text)
    return F.when(~F.lower(clean).isin(list(sentinels)), clean)


def text_to_double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def text_to_long(text: Column) -> Column:
    """Integral text such as '337', '337.0' or '1e3', exact beyond 2^53; '316.5' is not convertible."""
    number, digits = text_to_double(text), text.try_cast("decimal(38,10)")
    whole = F.when((number == F.floor(number)) & (digits == F.floor(digits)), digits.try_cast("bigint"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")).otherwise(whole)


def text_to_boolean(text: Column, mapping: Mapping[str, bool]) -> Column:
    result = F.lit(None).cast("boolean")
    for word, value in mapping.items():
        result = F.when(text == word, F.lit(value)).otherwise(result)
    return result


def to_double(column: Column, data_type: str) -> Column:
    """Numeric view of a column: text through the guarded parse, NaN as NULL."""
    if data_type == "string":
        return text_to_double(column)
    number = column.cast("double")
    return F.when(~F.isnan(number), number) if data_type in ("double", "float") else number


def clipped(column: Column, low: float, high: float) -> Column:
    """greatest/least skip NULL, so an unguarded clip would impute: keep NULL as NULL."""
    return F.when(column.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), column)))


def domain_scaled(column: Column, low: float, high: float) -> Column:
    return (column - F.lit(float(low))) / F.lit(float(high - low))


def known_count(columns: Sequence[Column]) -> Column:
    total = F.lit(0)
    for column in columns:
        total = total + column.isNotNull().cast("int")
    return total


def mean_of_known(columns: Sequence[Column]) -> Column:
    """Row mean over the non-null columns; NULL when none is known."""
    if not columns:
        raise ValueError("no known column is present")
    total = F.lit(0.0)
    for column in columns:
        total = total + F.coalesce(column, F.lit(0.0))
    return F.try_divide(total, known_count(columns))
