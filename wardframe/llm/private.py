"""Format-preserving pseudonyms for personal numbers and dates, with DataFrame functions only.

Validated values are permuted by a keyed Feistel network inside their own format, so equal values stay
equal in every document and no two values of a kind meet: cards (Luhn; the check digit is made anew),
phone numbers and social security numbers (digits, the country digit after + stays), IPv4 addresses
(32 bits) and dates of the years 1800 to 2199 (400 Gregorian years are 146097 = 189 x 773 days, the two
halves of the network).  Separators stay where they are.  Mail addresses have no closed format; they become
a keyed digest at a reserved domain, which links them as well.

Defined cases: a null text stays null, an empty one empty; a value that fails its check stays as it is;
repeated rows and long texts need no care, as rows are treated alone; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table

KEY, ROUNDS = "change-me", 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
OTHER_DATE = r"(?<![\d/.])\d{2}([/.])\d{2}\1\d{4}(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
PHONE = r"\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\d.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
PATTERN = "|".join((EMAIL, IPV4, ISO_DATE, OTHER_DATE, SSN, CARD, PHONE))


def _mixer(key: str, tag: Column, turn: Column, half: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(key: str, tag: Column, left: Column, right: Column, n_left: Column, n_right: Column) -> Column:
    """A keyed permutation of pairs (left < n_left, right < n_right); the halves swap after each round."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), n_left.cast("long").alias("nl"), n_right.cast("long").alias("nr"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, i: F.struct(
        s["r"].alias("l"), F.pmod(s["l"] + F.pmod(_mixer(key, tag, i, s["r"]), s["nl"]), s["nl"]).alias("r"), s["nr"].alias("nl"), s["nl"].alias("nr")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _permuted(key: str, kind: str, digits: Column) -> Column:
    """The same number of digits, permuted."""
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    ten = F.lit(10).cast("double")
    left, right = F.substring(digits, F.lit(1), a), F.substring(digits, a + 1, n - a)
    size_left, size_right = F.pow(ten, a).cast("long"), F.pow(ten, n - a).cast("long")
    out = _feistel(key, F.concat(F.lit(kind), n.cast("string")), left.cast("long"), right.cast("long"), size_left, size_right)
    return F.concat(F.lpad(out["l"].cast("string"), a, "0"), F.lpad(out["r"].cast("string"), n - a, "0"))


def _placed(value: Column, digits: Column) -> Column:
    """The digits put where the digits of the value stand."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    seen = F.transform(chars, lambda c, i: F.struct(c.alias("c"), F.length(_digits(F.substring(value, F.lit(1), i + 1))).alias("at")))
    return F.array_join(F.transform(seen, lambda s: F.when(s["c"].rlike(r"^\d$"), F.substring(digits, s["at"], F.lit(1))).otherwise(s["c"])), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of a number without its check digit, the last digit counted double."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _check_digit(body: Column) -> Column:
    return F.pmod(F.lit(10) - _luhn_sum(body) % 10, F.lit(10)).cast("string")


def _day(days: Column, pattern: str) -> Column:
    return F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), days.cast("int")), pattern)


def _dated(key: str, value: Column, pattern: str) -> Column:
    day = F.try_to_date(value, pattern)
    at = F.datediff(day, F.lit("1800-01-01").cast("date"))
    out = _feistel(key, F.lit("date"), F.floor(at / 773), at % 773, F.lit(189), F.lit(773))
    return F.when((at >= 0) & (at < 146097), _day(out["l"] * 773 + out["r"], pattern))


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one found value; a value that fails its check comes back unchanged."""
    digits = _digits(value)
    card_body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    new_body = _permuted(key, "card", card_body)
    is_card = value.rlike(f"^(?:{CARD})$") & (_check_digit(card_body) == F.substring(digits, -1, 1))
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    ip = _feistel(key, F.lit("ip"), octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536))
    new_ip = F.concat_ws(".", *[x.cast("string") for half in ("l", "r") for x in (F.floor(ip[half] / 256), ip[half] % 256)])
    phone_digits = F.when(value.startswith("+"), F.concat(F.substring(digits, 1, 1), _permuted(key, "phone", F.substring(digits, F.lit(2), F.length(digits) - 1)))).otherwise(_permuted(key, "phone", digits))
    slash, dot = value.rlike(r"^\d{2}/\d{2}/\d{4}$"), value.rlike(r"^\d{2}\.\d{2}\.\d{4}$")
    new = (
        F.when(value.contains("@"), F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(value)), 256), 1, 12), F.lit("@example.invalid")))
        .when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(F.forall(octets, lambda o: o <= 255), new_ip))
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), _dated(key, value, "yyyy-MM-dd"))
        .when(slash, F.coalesce(_dated(key, value, "dd/MM/yyyy"), _dated(key, value, "MM/dd/yyyy")))
        .when(dot, _dated(key, value, "dd.MM.yyyy"))
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(~value.rlike(r"^(000|666)|-00-|-0000$"), _placed(value, _permuted(key, "ssn", digits))))
        .when(is_card, _placed(value, F.concat(new_body, _check_digit(new_body))))
        .when(~value.rlike(f"^(?:{CARD})$") & (F.length(digits) >= 7) & (F.length(digits) <= 16), _placed(value, phone_digits))
    )
    return F.coalesce(new, value)


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """The same rows and columns, with the personal values of the text replaced."""
    found = F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0))
    changed = F.transform(found, lambda v: pseudonym(v, key))
    parts = F.zip_with(F.split(F.col(text), PATTERN, -1), changed, lambda p, c: F.concat(p, F.coalesce(c, F.lit(""))))
    return docs.withColumn(text, F.when(F.col(text).rlike(r"\d|@"), F.array_join(parts, "")).otherwise(F.col(text)))


@query("op5_feistel_pseudonyms")
def op5(spark, folder):
    return pseudonymise(table(spark, folder, "documents")).select("doc_id", "text")
