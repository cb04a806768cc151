"""Exact order statistics, ranks and rank cuts without a sort of the rows.

Single ranks (quantiles, cuts) come from *histograms that are refined*: one aggregation counts the
rows of each group in coarse, order-preserving bins, together with the least and greatest value of
each bin.  Bins add up across tasks, so an exchange carries bins and never the rows.  Only the
bins that hold a wanted rank are read again, each cut into ``BINS`` finer ones between its own
extremes, until a bin is one value or has so few rows (``LEAF``) that its values are counted one by one.

Whole distribution functions (average ranks, two-sample statistics) start from *value counts*:
equal values are one row before any shuffle.  Running totals over the ordered values are computed
per range partition and shifted by the totals of the earlier partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.functions.cleaning import to_double
from wardframe.functions.hashing import HASH_BITS, hash60
from wardframe.sources.scratch import materialised

# Bins that an interval is cut into, and the rows up to which its values are counted one by one.
BINS = 4096
LEAF = 4096

# Coarse bins per doubling of the value.
PER_OCTAVE = 16

# A lookup table up to this many rows is broadcast.
BROADCAST_ROWS = 1_000_000

# A value with at least 1/HOT_SHARE of the rows is "hot": there are at most HOT_SHARE of them.
HOT_SHARE = 1000

BUCKET_BITS = 16


def long_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """(keep..., column, value) with one row per cell, values as double; NULL for NaN and for text that is
    no number.  Names may not repeat."""
    types = dict(df.dtypes)
    cells = [F.struct(F.lit(c).alias("column"), to_double(F.col(c), types[c]).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def running_counts(counts: DataFrame, group: Sequence[str], value: str, totals: Sequence[str]) -> DataFrame:
    """Add ``cum_<total>``, the total over rows of the group whose value is not larger, and
    ``all_<total>``, the total of the group.

    ``counts`` has one row per (group, value).
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialised(
        counts.repartitionByRange(parts, *group, value).withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition and group boundary
    shifts = placed.groupBy(*group, "_part").agg(*[F.sum(t).alias(f"_t_{t}") for t in totals]).select(
        *group, "_part",
        *[F.coalesce(F.sum(f"_t_{t}").over(before), F.lit(0)).alias(f"_s_{t}") for t in totals],
        *[F.sum(f"_t_{t}").over(Window.partitionBy(*group)).alias(f"all_{t}") for t in totals],
    )
    within = Window.partitionBy("_part", *group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.select("*", *[F.sum(t).over(within).alias(f"_w_{t}") for t in totals])
        .join(shifts, [*group, "_part"])
        .select(
            *counts.columns,
            *[(F.col(f"_w_{t}") + F.col(f"_s_{t}")).alias(f"cum_{t}") for t in totals],
            *[f"all_{t}" for t in totals],
        )
    )


# --- single ranks by refined histograms ----------------------------------------------------


def _prefix_code(value: Column, skip: Column, width: int) -> Column:
    """The ``width`` bytes of a text after the first ``skip`` as a number; keeps the order of texts that agree before."""
    part = F.hex(F.substring(value.cast("binary"), skip + 1, F.lit(width)))
    return F.conv(F.rpad(part, 2 * width, "0"), 16, 10).cast("double")


def _code(value: Column, data_type: str) -> Column:
    """A number in the order of the values; neighbours may share one."""
    if data_type in ("date", "timestamp", "timestamp_ntz"):
        instant = value.cast("timestamp")
        return F.unix_micros(instant).cast("double")
    return value.cast("double")


def _coarse(value: Column, data_type: str) -> Column:
    """The first bin: two leading bytes of a text, or sign and 1/16 octave of a number (at most some 70,000 bins)."""
    if data_type in ("string", "binary"):
        return _prefix_code(value, F.lit(0), 2)
    number = _code(value, data_type)
    size = F.floor(F.log2(F.abs(number)) * PER_OCTAVE).cast("double") + 1075 * PER_OCTAVE + 1
    top = F.lit(2100.0 * PER_OCTAVE)
    placed = F.when(F.abs(number) == float("inf"), top).otherwise(size)
    return F.when(F.isnan(number), top + 1).when(number == 0, F.lit(0.0)).when(number > 0, placed).otherwise(-placed)


def _fine(value: Column, low: Column, high: Column, data_type: str) -> Column:
    """The bin of a value between two different extremes; NULL when their codes cannot tell them apart."""
    if data_type in ("string", "binary"):
        skip = F.col("_skip")
        code = lambda v: _prefix_code(v, skip, 6)
    else:
        code = lambda v: _code(v, data_type)
    share = F.try_divide(code(value) - code(low), code(high) - code(low))
    return F.when(code(low) < code(high), F.least(F.lit(BINS - 1.0), F.floor(share * BINS).cast("double")))


def _common_prefix(low: Column, high: Column) -> Column:
    """Bytes that two texts share in front; computed once per interval."""
    a, b = F.hex(low.cast("binary")), F.hex(high.cast("binary"))
    lengths = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)), F.lit(2))
    return (F.size(F.filter(lengths, lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))) - 1).cast("int")


def _size(weight: str | None) -> Column:
    return (F.sum(weight) if weight else F.count("*")).alias("cnt")


def first_histogram(rows: DataFrame, group: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """(group..., _bin, cnt, lo, hi): one scan, no row is exchanged.  NULL values are left out.

    ``weight`` names the rows that a row stands for.
    """
    kind = dict(rows.dtypes)[value]
    known = rows.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"), *([weight] if weight else []))
    counted = known.groupBy(*group, _coarse(F.col("_v"), kind).alias("_bin")).agg(_size(weight), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    return materialised(counted, "histogram")


def at_ranks(
    rows: DataFrame, histogram: DataFrame, group: Sequence[str], value: str, ranks: Callable[[Column], Column], leaf: int | None = None,
    belongs: Callable[[], Column] | None = None, weight: str | None = None,
) -> DataFrame:
    """(group..., n, rank, value, before, cnt): the value at each wanted rank (from 1), with the rows before
    it and the rows that equal it.

    ``ranks`` turns the number of rows of a group into an array of ranks.  ``histogram`` is the
    ``first_histogram`` of the same rows; every further round reads only what lies in the hit bins.
    Groups that overlap (training sets) have a histogram summed from blocks of rows, and ``belongs`` says
    when a row is part of the group in the columns ``_g_<group>``.  ``weight`` is that of the histogram.
    """
    leaf = LEAF if leaf is None else leaf
    kind = dict(rows.dtypes)[value]
    text = kind in ("string", "binary")
    keys = [F.col(g) for g in group]

    def hit(bins: DataFrame, inside: Sequence[str], order: Sequence[str]) -> DataFrame:
        """The bins that hold a wanted rank, one row per rank."""
        upto = Window.partitionBy(*group, *inside).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = bins.withColumn("_upto", F.col("_base") + F.sum("cnt").over(upto))
        held = F.filter("_ranks", lambda r: (r > F.col("_upto") - F.col("cnt")) & (r <= F.col("_upto")))
        return placed.withColumn("_ranks", held).where(F.size("_ranks") > 0).select(
            *keys, "n", "_ranks", "lo", "hi", "cnt", (F.col("_upto") - F.col("cnt")).alias("_base"))

    everything = Window.partitionBy(*group)
    start = histogram.withColumn("n", F.sum("cnt").over(everything)).withColumn("_base", F.lit(0).cast("long"))
    state = materialised(hit(start.withColumn("_ranks", F.array_distinct(ranks(F.col("n")))), [], ["_bin"]), "bins")
    found = []
    while True:
        single = F.col("lo").eqNullSafe(F.col("hi"))
        found.append(state.where(single))
        if not state.where(~single).limit(1).count():
            break
        held = state.where(~single).select(
            *[F.col(g).alias(f"_g_{g}") for g in group], "n", "_ranks", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), (F.col("cnt") <= leaf).alias("_few"), "_base",
            *([_common_prefix(F.col("lo"), F.col("hi")).alias("_skip")] if text else []))
        within = F.col("_v").between(F.col("_lo"), F.col("_hi"))
        if belongs is None:
            of_group = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
            inside = rows.select(*keys, F.col(value).alias("_v"), *([weight] if weight else [])).join(held, [*of_group, within])
        else:
            inside = rows.withColumnRenamed(value, "_v").join(held, belongs() & within)
        fine = _fine(F.col("_v"), F.col("_lo"), F.col("_hi"), kind)
        bins = inside.groupBy(*[F.col(f"_g_{g}").alias(g) for g in group], "n", "_ranks", "_lo", "_base", F.when(~F.col("_few"), fine).alias("_bin"),
                              F.when(F.col("_few") | fine.isNull(), F.col("_v")).alias("_one")).agg(
            _size(weight), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        state = materialised(hit(bins, ["_lo"], ["_bin", "_one"]), "bins")
    answer = found[0]
    for part in found[1:]:
        answer = answer.unionByName(part)
    return answer.select(*keys, "n", F.explode("_ranks").alias("rank"), F.col("lo").alias("value"), F.col("_base").alias("before"), "cnt")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], leaf: int | None = None
) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of the non-null values of each column."""
    return quantiles_of(long_numbers(df, columns), columns, probabilities, leaf)


def quantiles_of(
    long: DataFrame, columns: Sequence[str], probabilities: Sequence[float], leaf: int | None = None
) -> dict[str, list[float | None]]:
    """Quantiles of a (column, value) frame; one small row per column reaches the driver."""
    named = {f"q{i}": p for i, p in enumerate(probabilities)}
    rows = grouped_quantiles(long, "column", "value", named, leaf).collect()
    found = {r["column"]: [r[n] for n in named] for r in rows}
    return {c: found.get(c, [None] * len(probabilities)) for c in columns}


def grouped_quantiles(
    long: DataFrame, group: str, value: str, probabilities: Mapping[str, float], leaf: int | None = None, mode: str | None = None,
) -> DataFrame:
    """(group, <name>...): exact interpolated quantiles per group, for any number of groups.

    ``mode`` names an extra column with the most frequent value, the smallest on ties; it needs the
    count of every value, so it is the one figure here that exchanges distinct values.
    """
    def low(n: Column, p: float) -> Column:
        return (F.floor((n - 1) * F.lit(p)) + 1).cast("long")

    def wanted(n: Column) -> Column:
        return F.flatten(F.array(*[F.array(low(n, p), F.least(low(n, p) + 1, n)) for p in probabilities.values()]))

    found = at_ranks(long, first_histogram(long, [group], value), [group], value, wanted, leaf)
    n, at, v = F.col("n"), F.col("rank"), F.col("value")
    ends = [part for name, p in probabilities.items() for part in (
        F.min(F.when(at == low(n, p), v)).alias(f"_lo_{name}"), F.min(F.when(at == F.least(low(n, p) + 1, n), v)).alias(f"_hi_{name}"))]
    table = found.groupBy(group, "n").agg(*ends).select(group, *[
        (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * ((n - 1) * F.lit(p) - F.floor((n - 1) * F.lit(p)))).alias(name)
        for name, p in probabilities.items()
    ])
    if not mode:
        return table
    counts = long.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("cnt"))
    modes = counts.groupBy(group).agg(F.min_by(value, F.struct(-F.col("cnt"), F.col(value))).alias(mode))
    return modes.join(table, group).select(group, mode, *probabilities)


@dataclass(frozen=True)
class Cut:
    """The row at a rank in (value, tie) order; ``tie`` is None when the whole value is included."""

    value: object
    tie: object | None

    def after(self, value: Column, tie: Column) -> Column:
        """True for rows that come after the cut."""
        later = value > F.lit(self.value)
        if self.tie is None:
            return later
        return later | ((value == F.lit(self.value)) & (tie > F.lit(self.tie)))


def _by_group(group: str, wanted: Mapping[object, Sequence[int]]) -> Callable[[Column], Column]:
    """Ranks that are known for each of a few groups."""
    def ranks(n: Column) -> Column:
        chosen = F.array().cast("array<bigint>")
        for g, rs in wanted.items():
            chosen = F.when(F.col(group).eqNullSafe(F.lit(g)), F.array(*[F.lit(r).cast("long") for r in rs]).cast("array<bigint>")).otherwise(chosen)
        return chosen
    return ranks


def values_at(
    rows: DataFrame, group: str, value: str, ranks: Callable[[object, int], Sequence[int]], leaf: int | None = None
) -> tuple[dict[object, int], dict[tuple[object, int], tuple[object, int, int]]]:
    """Rows of each of a few groups, and {(group, rank): (value, rows before it, rows of it)}."""
    histogram = first_histogram(rows, [group], value)
    sizes = {r[0]: r[1] for r in histogram.groupBy(group).agg(F.sum("cnt")).collect()}
    wanted = {g: [r for r in ranks(g, n) if 0 < r <= n] for g, n in sizes.items()}
    if not any(wanted.values()):
        return sizes, {}
    found = at_ranks(rows, histogram, [group], value, _by_group(group, wanted), leaf).collect()
    return sizes, {(r[group], r["rank"]): (r["value"], r["before"], r["cnt"]) for r in found}


def rank_cuts(
    rows: DataFrame, group: str, value: str, tie: str, ranks: Callable[[int], Sequence[int]], leaf: int | None = None,
) -> dict[object, list[Cut]]:
    """Where the first-come ranks ``ranks(n)`` of each group fall; NULL values are left out.

    First-come order is (value, tie); ``tie`` must be unique.  Only the rows whose value sits
    exactly on a cut are looked at twice, and no row-level rank is ever produced.
    """
    sizes, at = values_at(rows, group, value, lambda g, n: ranks(n), leaf)
    split = {(g, v): b for (g, r), (v, b, c) in at.items() if r - b < c}
    ties: dict[tuple[object, int], tuple[object, int, int]] = {}
    if split:
        names = {pair: i for i, pair in enumerate(sorted(split, key=repr))}
        label = F.lit(None).cast("int")
        for (g, v), i in names.items():
            label = F.when(F.col(group).eqNullSafe(F.lit(g)) & (F.col(value) == F.lit(v)), F.lit(i)).otherwise(label)
        tied = rows.select(label.alias("_set"), F.col(tie).alias("_tie")).where("_set is not null")
        needed: dict[object, list[int]] = {}
        for (g, r), (v, b, c) in at.items():
            if r - b < c:
                needed.setdefault(names[g, v], []).append(r - b)
        _, ties = values_at(tied, "_set", "_tie", lambda i, n: needed[i], leaf)
    result: dict[object, list[Cut]] = {}
    for g, n in sizes.items():
        cuts = []
        for r in (r for r in ranks(n) if 0 < r <= n):
            v, b, c = at[g, r]
            cuts.append(Cut(v, ties[names[g, v], r - b][0] if r - b < c else None))
        result[g] = cuts
    return result


def quantile_group_ranks(groups: int) -> Callable[[int], list[int]]:
    """Last first-come rank of every quantile group but the last: 1 + floor(j (n-1) / groups)."""
    return lambda n: [1 + (j * (n - 1)) // groups for j in range(1, groups)]


def group_number(cuts: Sequence[Cut], value: Column, tie: Column) -> Column:
    """0-based group of a row: how many cuts lie before it."""
    number = F.lit(0)
    for cut in cuts:
        number = number + cut.after(value, tie).cast("int")
    return number


def hash_cuts(rows: DataFrame, group: str, hashed: str, ranks: Callable[[int], Sequence[int]]) -> dict[object, list[int]]:
    """Hash value at each rank of each group."""
    sizes, at = values_at(rows, group, hashed, lambda g, n: ranks(n))
    return {g: [at[g, r][0] for r in ranks(n) if 0 < r <= n] for g, n in sizes.items()}


def hash_indexed(df: DataFrame, key: str, salt: str = "", name: str = "_index") -> DataFrame:
    """Add a gap-free 0-based row number in reproducible random order of a unique key.

    Hash buckets are even by construction, so each bucket is numbered on its own and shifted by
    the size of the earlier buckets (a table of at most 65,536 rows).
    """
    tagged = df.withColumn("_h", hash60(F.col(key), salt)).withColumn(
        "_bucket", F.shiftright("_h", HASH_BITS - BUCKET_BITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = tagged.groupBy("_bucket").agg(F.count("*").alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    within = Window.partitionBy("_bucket").orderBy("_h", key)
    return (
        tagged.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(name, F.col("_shift") + F.col("_row") - 1)
        .drop("_h", "_bucket", "_row", "_shift")
    )


def skew_safe_lookup(
    big: DataFrame, lookup: DataFrame, keys: Sequence[str], weight: str, total: int, small_rows: int | None = None
) -> DataFrame:
    """Join each row of ``big`` to its single match in ``lookup``.

    ``lookup`` is a written table whose ``weight`` says how many rows of ``big`` share the key.
    A small lookup is broadcast.  Otherwise hot keys (at most HOT_SHARE of them) are broadcast and
    only the remaining keys, none of which is large, are shuffled.
    """
    plain = lookup.drop(weight)
    if lookup.count() <= (BROADCAST_ROWS if small_rows is None else small_rows):
        return big.join(F.broadcast(plain), list(keys))
    hot = F.col(weight) * HOT_SHARE >= total
    hot_side = lookup.where(hot).drop(weight)
    cold_side = lookup.where(~hot).drop(weight)
    warm = big.join(F.broadcast(hot_side), list(keys))
    rest = big.join(F.broadcast(hot_side.select(*keys)), list(keys), "left_anti").join(cold_side, list(keys))
    return warm.unionByName(rest)


def rank_pairs(
    df: DataFrame, x: Column, y: Column, by: Sequence[str] = (), small_rows: int | None = None, weight: str | None = None,
) -> DataFrame:
    """(by..., _x, _y, cnt, _n, _mx, _rx, _ry): pairs with their count, the size and mean x of
    their group and the average ranks of both values within the group.

    Rows with a ``weight`` are pairs with a count already; other rows are counted by distinct pair.
    The pairs are written once.  The ranks come from running counts of either side and are looked up
    again without a hot key ever being shuffled.
    """
    keys = list(by) or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(1))
    known = source.select(
        *keys, x.cast("double").alias("_x"), y.cast("double").alias("_y"), *([F.col(weight).alias("cnt")] if weight else [])
    ).where("_x is not null and _y is not null")
    pairs = materialised(known if weight else known.groupBy(*keys, "_x", "_y").agg(F.count("*").alias("cnt")), "pairs")
    total, ranked = pairs.count(), pairs
    for side, name in (("_x", "_rx"), ("_y", "_ry")):
        counts = pairs.groupBy(*keys, side).agg(F.sum("cnt").alias("cnt"), F.count("*").alias("_weight"))
        table = materialised(
            running_counts(counts, keys, side, ["cnt"]).select(
                *keys, side, "_weight", (F.col("cum_cnt") - (F.col("cnt") - 1) / 2).alias(name)
            ),
            "ranks",
        )
        ranked = skew_safe_lookup(ranked, table, [*keys, side], "_weight", total, small_rows)
    # groups are folds, columns or models: few
    return ranked.join(F.broadcast(pairs.groupBy(*keys).agg(
        F.sum("cnt").alias("_n"), (F.sum(F.col("cnt") * F.col("_x")) / F.sum("cnt")).alias("_mx")
    )), keys)


def rank_correlation() -> Column:
    """Spearman's coefficient of a group of ranked pairs; NULL when either side is constant."""
    dx, dy = F.col("_rx") - (F.col("_n") + 1) / 2, F.col("_ry") - (F.col("_n") + 1) / 2
    return F.try_divide(F.sum(F.col("cnt") * dx * dy), F.sqrt(F.sum(F.col("cnt") * dx * dx) * F.sum(F.col("cnt") * dy * dy)))


def spearman(
    df: DataFrame, x: str, y: str, by: Sequence[str] = (), small_rows: int | None = None
) -> DataFrame:
    """(by..., n, spearman) over pairwise complete rows, average ranks on ties.

    NULL when either side is constant.
    """
    ranked = rank_pairs(df, F.col(x), F.col(y), by, small_rows)
    return ranked.groupBy(*by).agg(F.sum("cnt").alias("n"), rank_correlation().alias("spearman"))


def kolmogorov_smirnov(
    df: DataFrame, columns: Sequence[str], is_test: Column
) -> DataFrame:
    """(column, n_train, n_test, statistic): largest gap between the two distribution functions.

    Columns with an empty side are left out.
    """
    counts = (
        long_numbers(df, columns, [is_test.alias("_test")])
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count_if(~F.col("_test")).alias("tr"), F.count_if(F.col("_test")).alias("te"))
    )
    cumulated = running_counts(counts, ["column"], "value", ["tr", "te"])
    gap = F.abs(F.col("cum_tr") / F.col("all_tr") - F.col("cum_te") / F.col("all_te"))
    return (
        cumulated.where("all_tr > 0 and all_te > 0")
        .groupBy("column", F.col("all_tr").alias("n_train"), F.col("all_te").alias("n_test"))
        .agg(F.max(gap).alias("statistic"))
    )
