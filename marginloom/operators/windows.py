"""Latest-row and top-N selection.

A rank filtered against a constant lets Spark drop losing rows before the shuffle
(``WindowGroupLimit``), so a key with a third of all rows ships one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pinned(order: Sequence[Column | str]) -> list[Column]:
    """Plain names mean newest first with NULLs last."""
    return [F.desc_nulls_last(o) if isinstance(o, str) else o for o in order]


def dedup_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*_pinned(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_top_ties(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """All rows of a key that share the first place in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*_pinned(order))
    return df.withColumn("_rk", F.rank().over(w)).where("_rk = 1").drop("_rk")


def latest_values(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  values: Sequence[str]) -> DataFrame:
    """Values of the newest row per key."""
    return dedup_latest(df, keys, order).select(*keys, *values)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global first ``n`` rows; ``order`` must end in a unique tie-break."""
    return df.orderBy(*order).limit(n)


def best_bid(bids: DataFrame, day_col: str, day, keys: Sequence[str], bid: str,
             ties: Sequence[Column] = ()) -> DataFrame:
    """Lowest bid per (day, keys) for one day; the day filter is applied ahead of the window."""
    return dedup_latest(bids.where(F.col(day_col) == F.lit(day)), [day_col, *keys],
                        [F.asc_nulls_last(bid), *ties])
