"""Purchase propensity: cohorts, labels, recency, imputation and checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.functions import scalars as S


def month_cohort(df: DataFrame, date: str, first: dt.date, last: dt.date) -> DataFrame:
    return df.where(F.col(date).between(F.lit(first), F.lit(last)))


def open_cohort(df: DataFrame, last_visit_days: str, order_date: str, cutoff: dt.date, max_days: int = 15) -> DataFrame:
    """Recently active users without an order up to the cutoff."""
    return df.where(F.col(last_visit_days) <= max_days) \
        .where((F.col(order_date) > F.lit(cutoff)) | F.col(order_date).isNull())


def label_window(next_order: str, first: dt.date, last: dt.date) -> Column:
    """1 if the next order falls in the window, else 0 (also when there is none)."""
    return S.flag(F.col(next_order).between(F.lit(first), F.lit(last)))


def label_three_way(order_date: str, first: dt.date, last: dt.date) -> Column:
    """1 in the window, 0 without an order, 2 for an order outside it."""
    d = F.col(order_date)
    return F.when(d.between(F.lit(first), F.lit(last)), 1).when(d.isNull(), 0).otherwise(2)


def drop_ambiguous(df: DataFrame, order_date: str, first: dt.date, last: dt.date) -> DataFrame:
    return df.withColumn("target", label_three_way(order_date, first, last)).where("target <> 2")


def recency(df: DataFrame, as_of: dt.date, columns: Mapping[str, str]) -> DataFrame:
    """``columns`` maps output to a date column; days from it to ``as_of``."""
    return df.withColumns({out: S.days_between(S.day(as_of), c) for out, c in columns.items()})


def impute(df: DataFrame, large: Sequence[str], small: Sequence[str], large_value: float = 10000.0,
           text: Mapping[str, str] | None = None) -> DataFrame:
    """Indicator columns first, then constants: a large value for day gaps, 0 for counts."""
    if text:
        df = df.fillna(dict(text))
    marked = df.withColumns({f"{c}_null": F.col(c).isNull().cast("int") for c in [*large, *small, *(text or {})]})
    return marked.fillna(large_value, list(large)).fillna(0.0, list(small))


def sanity_checks(df: DataFrame, install: str, order: str, target: str) -> DataFrame:
    return df.agg(
        F.sum(S.flag(F.col(install) > F.col(order))).cast("bigint").alias("order_before_install"),
        F.sum(S.flag((F.col(target) == 1) & F.col(order).isNull())).cast("bigint").alias("target_without_order"))
