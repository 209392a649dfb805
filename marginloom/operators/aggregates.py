"""Grouped summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginloom.functions.scalars import flag
from marginloom.operators.ordered import running_totals


def count_distinct_by_key(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Spark plans a single distinct in two steps, first on (keys, column), so hot keys spread out."""
    return df.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def conditional_distinct(df: DataFrame, keys: Sequence[str], code: str, conditions: Mapping[str, Column],
                         flags: Mapping[str, Column] | None = None, total: str | None = None) -> DataFrame:
    """``count(distinct case when cond then code end)`` per condition, plus 0/1 max-flags.

    Rows are first reduced to one per (keys, code) carrying one flag per condition. That is a plain
    partial aggregation, with no row copies per distinct expression, and spreads hot keys by code.
    """
    flags = flags or {}
    per_code = df.groupBy(*keys, code).agg(
        *[F.max(flag(c)).alias(f"_c_{n}") for n, c in conditions.items()],
        *[F.max(flag(c)).alias(f"_f_{n}") for n, c in flags.items()])
    # An absent code is not counted but still contributes to the flags.
    counted = F.when(F.col(code).isNotNull(), F.lit(1)).otherwise(0)
    out = [] if total is None else [F.sum(counted).cast("bigint").alias(total)]
    out += [F.sum(F.col(f"_c_{n}") * counted).cast("bigint").alias(n) for n in conditions]
    out += [F.max(f"_f_{n}").alias(n) for n in flags]
    return per_code.groupBy(*keys).agg(*out)


def trailing_sales(df: DataFrame, keys: Sequence[str], code: str, date: str, as_of: dt.date,
                   windows: Sequence[int], prefix: str = "sold") -> DataFrame:
    """Distinct codes per key in the last n days (as_of-n to as_of-1) for several n in one pass.

    Keys without a sale in the longest window are absent. Also gives ``<prefix>_<n>_flag``.
    """
    yesterday = as_of - dt.timedelta(days=1)

    def in_last(n: int) -> Column:
        return F.col(date).between(F.lit(as_of - dt.timedelta(days=n)), F.lit(yesterday))

    recent = df.where(in_last(max(windows)))
    return conditional_distinct(
        recent, keys, code,
        {f"{prefix}_{n}": in_last(n) for n in windows},
        {f"{prefix}_{n}_flag": in_last(n) for n in windows})


def global_counts(df: DataFrame, key: Column, total: str = "n_rows", distinct: str = "n_distinct") -> DataFrame:
    per_key = df.select(key.alias("_k")).groupBy("_k").agg(F.count("_k").alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(total), F.count("_k").alias(distinct))


def weighted_cover(df: DataFrame, by: Sequence[str], values: Sequence[str], weight: str,
                   suffix: str = "_new") -> DataFrame:
    """``sum(coalesce(v, 0) * w) / sum(w)`` per group for many columns in one pass."""
    return df.groupBy(*by).agg(
        F.sum(weight).alias(weight),
        *[F.try_divide(F.sum(F.coalesce(F.col(v), F.lit(0.0)) * F.coalesce(F.col(weight), F.lit(0))),
                       F.sum(weight)).alias(f"{v}{suffix}") for v in values])


def sum_by_key(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(column).alias(name))


def group_dedup(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def frequency_share(df: DataFrame, column: str) -> DataFrame:
    """Count, % share and running % share per present value in ascending order; numbers, strings and dates alike."""
    t = running_totals(df, column, {"n": F.count(F.lit(1))})
    return t.select(column, "n", (F.col("n") * 100.0 / F.col("tot_n")).alias("share_pct"),
                    (F.col("cum_n") * 100.0 / F.col("tot_n")).alias("cum_share_pct"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of present values, most frequent first."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), column))


def group_percentile(df: DataFrame, keys: Sequence[str], value: str, fraction: float, name: str) -> DataFrame:
    """Exact interpolated percentile where a group has few different values (days, ratings).

    The aggregate keeps one counter per different value and merges map-side. For values without such
    a bound use ``ordered.exact_percentiles``.
    """
    return df.groupBy(*keys).agg(F.percentile(value, fraction).alias(name))


def _unpivot(wide: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str, value: str) -> DataFrame:
    return wide.unpivot(list(ids), list(columns), key, value)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("bigint")), F.lit(0)).alias(c) for c in columns])
    return _unpivot(wide, [], columns, "column_name", "n_null")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations (upper triangle with diagonal), one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = _unpivot(wide, [], [f"{a}|{b}" for a, b in pairs], "_pair", "corr")
    parts = F.split("_pair", r"\|")
    return long.select(parts[0].alias("var_a"), parts[1].alias("var_b"), "corr")


def class_means(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    wide = df.groupBy(target).agg(*[F.avg(c).alias(c) for c in columns])
    return _unpivot(wide, [target], columns, "column_name", "mean_value")


def class_category_share(df: DataFrame, target: str, column: str) -> DataFrame:
    """Share of each category within its class, percent; missing categories are left out."""
    n = df.where(F.col(column).isNotNull()).groupBy(target, column).agg(F.count(F.lit(1)).alias("n"))
    # Class totals come from the grouped counts; there are as many as there are classes.
    totals = n.groupBy(target).agg(F.sum("n").alias("_t"))
    return n.join(totals, target).select(target, column, "n", (F.col("n") * 100.0 / F.col("_t")).alias("share_pct"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    n = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n")).scalar()
    return n.withColumn("share_pct", F.round(F.col("n") * 100.0 / total, 2))


def welch_t(df: DataFrame, target: str, column: str) -> DataFrame:
    """Welch t statistic of class 1 against class 0."""
    def of(cls: int, fn) -> Column:
        return fn(F.when(F.col(target) == cls, F.col(column)))

    s = df.agg(*[of(c, f).alias(f"{n}{c}") for c in (0, 1)
                 for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))])
    se = F.sqrt(F.col("v1") / F.col("n1") + F.col("v0") / F.col("n0"))
    return s.select(F.try_divide(F.col("m1") - F.col("m0"), se).alias("t_stat"),
                    F.col("m1").alias("mean_1"), F.col("m0").alias("mean_0"))


def running_share(df: DataFrame, order_col: str, count_col: str) -> DataFrame:
    """Share and running share over a bin list (its length is the number of bins, so one task is enough)."""
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select("*", (F.col(count_col) * 100.0 / F.sum(count_col).over(total)).alias("share_pct"),
                     (F.sum(count_col).over(w) * 100.0 / F.sum(count_col).over(total)).alias("cum_share_pct"))
