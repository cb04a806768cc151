"""Quality rules as a short-circuit cascade.

Each rule reads features of one text; a feature is computed at most once per text and only when a
rule that runs reads it.  On a sample the cascade measures what every rule costs and rejects, then
orders the rules by rejections per second among the texts that earlier rules let pass.  A text
leaves at its first rejection.  The order changes the time and which rule is named, never the verdict.

Defined cases: a null text is an empty text (no words, so ``few_words`` rejects it); repeated rows
are judged alike; any length of text is read whole; an empty table gives an empty result and the
rules in their given order; other columns are neither read nor returned, whatever their names.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.llm.text import WORD, words_of

SYMBOLS = "#*$%&|<>"
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]+")
_LOWER = re.compile("[a-zß-öø-ÿ]+")
#: rows on which costs and selectivity are measured
SAMPLE_ROWS = 2000


class Features:
    """What the rules read, computed on first use."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return words_of(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if WORD.search(line)]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words, 5)

    @cached_property
    def n_upper(self) -> int:
        return sum(map(len, _UPPER.findall(self.text)))

    @cached_property
    def n_lower(self) -> int:
        return sum(map(len, _LOWER.findall(self.text)))


def repeated_words(words: Sequence[str], width: int) -> int:
    """Words in windows of ``width`` words that occur at least twice, the first ones included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    codes = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    if len(seen) == len(words):
        return 0
    key, base = codes[:n], len(seen)
    for i in range(1, width):  # exact numbering of windows: renumber before a key could overflow
        if base * len(seen) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            base = int(key.max()) + 1
        key = key * len(seen) + codes[i : i + n]
        base *= len(seen)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    repeated = np.zeros(n, dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += repeated
    edges[width : width + n] -= repeated
    return int((np.cumsum(edges)[:-1] > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], bool]


#: clean texts of several languages lie far inside these limits
RULES = (
    Rule("few_words", lambda f: f.n_words < 10),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > 20 * f.n_words),
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("repeated_lines", lambda f: 100 * f.n_dup_lines > 40 * f.n_lines),
    Rule("word_length", lambda f: f.word_chars < 2 * f.n_words or f.word_chars > 20 * f.n_words),
    Rule("shouting", lambda f: f.n_upper > f.n_lower),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Measured:
    """A rule with its mean cost in seconds and its share of rejections among the texts that reach it."""

    rule: Rule
    cost: float
    rejects: float


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS, seed: int = 8) -> list[Measured]:
    """The rules in the order of rejections per cost, measured on about ``rows`` sampled rows.

    The sample returns one number per row and rule; greedy choice then looks at the sampled texts
    that no chosen rule has rejected.
    """
    only = docs.select(F.col(text).alias("text"))
    total = only.count()
    if not total:
        return [Measured(r, 0.0, 0.0) for r in rules]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch["text"]:
                line = []
                for rule in rules:
                    features, started = Features(value), time.perf_counter()
                    rejected = rule.rejects(features)
                    line.append((time.perf_counter() - started) * (-1 if rejected else 1))
                out.append(line)
            yield pd.DataFrame({"signed": out})

    sample = only.sample(fraction=min(1.0, 1.2 * rows / total), seed=seed).limit(rows)
    signed = np.array([r[0] for r in sample.mapInPandas(run, "signed array<double>").collect()]).reshape(-1, len(rules))
    left, cost, reject = list(range(len(rules))), np.abs(signed).mean(axis=0) if len(signed) else np.zeros(len(rules)), signed < 0
    alive, order = np.ones(len(signed), dtype=bool), []
    while left:
        share = {i: float(reject[alive, i].mean()) if alive.any() else 0.0 for i in left}
        best = max(left, key=lambda i: (share[i] / max(cost[i], 1e-9), -cost[i], -i))
        order.append(Measured(rules[best], float(cost[best]), share[best]))
        alive &= ~reject[:, best]
        left.remove(best)
    return order


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text",
            report: Sequence[str] = (), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """key, kept, rejected_by, rules_run and the reported features, one row per document."""
    order = [m.rule for m in measure(docs, rules, text, sample_rows)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rejected, ran, reported = [], [], {name: [] for name in report}
            for value in batch["text"]:
                features, by, n = Features(value), None, 0
                for n, rule in enumerate(order, 1):
                    if rule.rejects(features):
                        by = rule.name
                        break
                rejected.append(by)
                ran.append(n)
                for name in report:
                    reported[name].append(getattr(features, name))
            yield pd.DataFrame({key: batch[key], "kept": [by is None for by in rejected], "rejected_by": pd.Series(rejected, dtype=object, index=batch.index), "rules_run": ran, **reported})

    schema = f"`{key}` {dict(docs.dtypes)[key]}, kept boolean, rejected_by string, rules_run long" + "".join(f", {name} long" for name in report)
    return docs.select(key, F.col(text).alias("text")).mapInPandas(run, schema)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    order = [m.rule for m in measure(docs, rules, text, sample_rows)]

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        features = (Features(t) for t in texts)
        return pd.Series([not any(rule.rejects(f) for rule in order) for f in features], dtype=bool)

    return docs.where(good(F.col(text)))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
u AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
g AS (
  SELECT rid, i, CASE WHEN lead(word, 4) OVER o IS NOT NULL
    THEN word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o END AS gram
  FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
h AS (SELECT rid, i, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY rid, gram) > 1 THEN 1 ELSE 0 END AS hit FROM g),
r AS (
  SELECT rid, sum(cover) AS n_repeat_words
  FROM (SELECT rid, max(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS cover FROM h)
  GROUP BY rid),
f AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '[a-zß-öø-ÿ]', '', 'g')) AS n_lower
  FROM d LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 40 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR n_upper > n_lower) AS kept
FROM b
"""


@query("op8_quality_cascade", SQL)
def op8(spark, folder):
    judged = cascade(table(spark, folder, "documents"), report=BASE)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *BASE, failed.alias("base_failed"), "kept")
