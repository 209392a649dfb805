"""Joins of values with intervals inside a key, whose work grows with the matches and not with rows times intervals of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many bands a key, rows meet all of their key's bands; with more, they look for theirs through cells.
FEW = 32
#: The level of intervals as wide as any double; they lie in one cell.
OPEN_LEVEL = 2000


def level_of(low: Column, high: Column) -> Column:
    """The power of two at or above the width, so that an interval touches at most two cells of that size.

    A width of zero takes the level of the spacing of doubles near the bound, at which cells still differ.
    """
    width = high - low
    size = F.greatest(F.abs(low), F.abs(high))
    least = F.ceil(F.log2(F.greatest(size, F.lit(1e-300)))) - 50
    finite = F.greatest(F.when(width > 0, F.ceil(F.log2(width))).otherwise(least), least)
    return F.when((width < F.lit(float("inf"))) & (size < F.lit(float("inf"))), finite).otherwise(F.lit(OPEN_LEVEL)).cast("int")


def cell_of(value: Column, level: Column) -> Column:
    return F.when(level == OPEN_LEVEL, F.lit(0.0)).otherwise(F.floor(value / F.pow(F.lit(2.0), level.cast("double"))).cast("double")) + F.lit(0.0)


def _named(keys: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def _sound(bands: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """(_k…, _lo, _hi, _band): bands that hold any value at all."""
    lo, hi = F.col(low).cast("double"), F.col(high).cast("double")
    sound = bands.where((lo <= hi) & ~F.isnan(lo) & ~F.isnan(hi))
    for k in keys:
        sound = sound.where(F.col(k).isNotNull())
    return sound.select(*[F.col(k).alias(n) for k, n in zip(keys, _named(keys))], lo.alias("_lo"), hi.alias("_hi"),
                        F.struct(*[c for c in bands.columns if c not in keys]).alias("_band"))


def crowded(bands: DataFrame, keys: Sequence[str], low: str, high: str) -> bool:
    """Whether a key has more than ``FEW`` bands. Counted by the keys' hash: two keys of one hash can only make it true."""
    per_key = _sound(bands, keys, low, high).groupBy(F.xxhash64(*_named(keys))).count()
    return not per_key.where(F.col("count") > FEW).isEmpty()


def _cells(bands: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """(_k…, _level, _cell, _lo, _hi, _band): a band once per cell it touches, at most two."""
    base = _sound(bands, keys, low, high).withColumn("_level", level_of(F.col("_lo"), F.col("_hi")))
    # array_distinct, since a band inside one cell must come once
    both = F.array_distinct(F.array(cell_of(F.col("_lo"), F.col("_level")), cell_of(F.col("_hi"), F.col("_level"))))
    return base.select("*", F.explode(both).alias("_cell"))


def looks(left: DataFrame, bands: DataFrame, keys: Sequence[str], value: str, low: str, high: str) -> tuple[DataFrame, DataFrame]:
    """The two sides of the equi-join: distinct (key, value) per level of the key's bands, and the bands' cells."""
    names = _named(keys)
    cells = _cells(bands, keys, low, high)
    # levels of a key: at most one per power of two
    levels = cells.groupBy(*names).agg(F.collect_set("_level").alias("_levels"))
    x = F.col(value).cast("double")
    values = left.where(x.isNotNull() & ~F.isnan(x)).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).cast("double").alias("_x")).distinct()
    looked = values.join(levels, names).select(*names, "_x", F.explode("_levels").alias("_level"))
    return looked.select("*", cell_of(F.col("_x"), F.col("_level")).alias("_cell")), cells


def interval_join(left: DataFrame, bands: DataFrame, keys: Sequence[str], value: str, low: str, high: str, how: str = "left",
                  start: str | None = None, end: str | None = None, on: str | None = None) -> DataFrame:
    """Equi-join plus closed range ``low <= value <= high``, and ``start <= on <= end`` where these are given.

    A band is found through cells of the power of two at its width, within its key: a value looks into one cell per
    width that the key's bands have, so a key with many rows and many bands doesn't multiply before the filter, and its rows
    are dealt by cell. Only distinct values of a key look, the rows join their bands afterwards by (key, value). Where no key has more
    than ``FEW`` bands, which is counted first, there is nothing to save: rows join all bands of their key.

    Equal to ``joins.band_join``: touching and nested bands all match, a value on a bound matches. A NULL or NaN
    value, key or bound matches nothing, nor does a band whose low is above its high; bounds may be infinite. Values and
    bounds are compared as doubles. With ``how`` "left" rows without a band come once with NULLs; "inner" drops them. ``on`` is a
    column of ``left``, so every row can have a day of its own; a NULL day matches nothing, a NULL ``start`` or ``end`` neither.
    Columns of ``bands`` other than the keys are added and mustn't be named like those of ``left``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    added = [c for c in bands.columns if c not in keys]
    clash = sorted(set(added) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    names = _named(keys)
    row = left.select(F.struct("*").alias("_row"), *[F.col(k).alias(f"_l{n}") for k, n in zip(keys, names)], F.col(value).cast("double").alias("_v"))
    if crowded(bands, keys, low, high):
        looked, cells = looks(left, bands, keys, value, low, high)
        found = looked.join(cells, [*names, "_level", "_cell"]).where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
        found, met = found.select(*names, "_x", "_band"), F.col("_v") == F.col("_x")
    else:
        found, met = _sound(bands, keys, low, high), F.col("_v").between(F.col("_lo"), F.col("_hi"))
    for n in names:
        met = met & (F.col(f"_l{n}") == F.col(n))
    if on is not None:
        met = met & F.col("_row")[on].between(F.col("_band")[start], F.col("_band")[end])
    joined = row.join(found, met, how)
    return joined.select(*[F.col("_row")[c].alias(c) for c in left.columns], *[F.col("_band")[c].alias(c) for c in added])
