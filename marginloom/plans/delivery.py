"""Delivery promise: features, P90 target, promise window and breach reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.functions import scalars as S
from marginloom.operators import aggregates as A
from marginloom.operators import evaluation as E

# Days kept in training.
DAYS_KEPT = (1, 15)


def calendar(df: DataFrame, ts: str = "order_created_time") -> DataFrame:
    return df.select("*", F.to_date(ts).alias("order_created_date"), *S.weekday_flags(ts),
                     S.day_quarter(ts).alias("day_quarter"))


def prefixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """City and state codes marked with their role, so equal codes stay apart as features."""
    return df.withColumns({c: F.concat(F.lit(f"{c}_"), F.col(c)) for c in columns})


def trim_days(df: DataFrame, days: str = "o2a", kept: tuple[int, int] = DAYS_KEPT) -> DataFrame:
    return df.where(F.col(days).between(*kept))


def p90_target(df: DataFrame, features: Sequence[str], days: str = "o2a") -> DataFrame:
    """P90 of delivery days over rows with identical features; trimmed days keep the value set small."""
    return A.group_percentile(df, features, days, 0.9, "p90")


def promised(df: DataFrame, predicted: str, days: str = "o2a", ordered: str = "order_created_date") -> DataFrame:
    out = E.promise_window(df, days, predicted)
    return out.withColumns({"promise_date": F.date_add(ordered, F.col("pdd1")),
                            "delivered_date": F.date_add(ordered, F.col(days).cast("int"))})


def breach_by_dates(df: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Breach shares and mean promise per day, for several date roles in one aggregation."""
    long = df.select("breach", "pdd1", "pdd2", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("day")) for k in kinds])).alias("_d"))
    out = E.breach_by(long.select("breach", "pdd1", "pdd2", "_d.kind", "_d.day"), ["kind", "day"])
    return out.withColumn("day_of_week", F.date_format("day", "EEEE"))
