"""Column expressions shared by the operators. Everything stays in JVM code generation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: ColumnLike, default=0.0) -> Column:
    """NULL replaced by a constant."""
    return F.coalesce(col(c), F.lit(default))


def _all_present(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def least_strict(*cols: ColumnLike) -> Column:
    """Smallest argument, NULL as soon as one argument is NULL (Spark's ``least`` skips NULLs)."""
    cs = [col(c) for c in cols]
    return F.when(_all_present(cs), F.least(*cs))


def greatest_strict(*cols: ColumnLike) -> Column:
    """Largest argument, NULL as soon as one argument is NULL."""
    cs = [col(c) for c in cols]
    return F.when(_all_present(cs), F.greatest(*cs))


def is_true(cond: Column) -> Column:
    """Two-valued truth: an unknown comparison counts as False (``np.where`` semantics)."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    return is_true(cond).cast("int")


def safe_rate(num: ColumnLike, den: ColumnLike) -> Column:
    """``num * 100 / den``; NULL where the denominator is NULL or zero."""
    return F.try_divide(col(num) * F.lit(100.0), col(den))


def zero_to_null(c: ColumnLike) -> Column:
    return F.nullif(col(c), F.lit(0))


def sentinel_to_null(c: ColumnLike, sentinel=-99999.0) -> Column:
    return F.nullif(col(c), F.lit(sentinel))


def null_where_null(c: ColumnLike, gate: ColumnLike) -> Column:
    """Keep ``c`` only where ``gate`` is present."""
    return F.when(col(gate).isNotNull(), col(c))


def as_category(c: ColumnLike) -> Column:
    """String category in which a missing value is a category of its own, ``'nan'``."""
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


def canonical_code(c: ColumnLike, prefix: str = "s", width: int = 1) -> Column:
    """Initial-capitalise codes whose first ``width`` characters equal ``prefix``.

    A ``prefix`` longer than ``width`` can never match and leaves every code unchanged.
    """
    c = col(c)
    return F.when(F.substring(c, 1, width) == prefix, F.initcap(c)).otherwise(c)


def composite_key(*parts: ColumnLike, sep: str = "-") -> Column:
    """Parts joined by ``sep``; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(col(p).cast("string"))
    return F.concat(*pieces)


def volumetric_slab(weight, length, breadth, height, divisor=5.0, step=500.0) -> Column:
    """Weight slab: billable weight is the larger of dead and volumetric weight."""
    volumetric = col(length).cast("double") * col(breadth) * col(height) / F.lit(divisor)
    return F.ceil(greatest_strict(col(weight).cast("double"), volumetric) / F.lit(step)).cast("double")


def band_label(value: ColumnLike, bounds: Sequence[tuple[float, str]], above: str, unknown: str) -> Column:
    """First band whose upper bound holds the value; ``above`` past the last, ``unknown`` for NULL."""
    value = col(value)
    ladder = F.when(value <= bounds[0][0], bounds[0][1])
    for upper, label in bounds[1:]:
        ladder = ladder.when(value <= upper, label)
    return ladder.when(value > bounds[-1][0], above).otherwise(unknown)


def scaled_round(c: ColumnLike, digits: int) -> Column:
    """Round by scaling and rounding half to even, the array-library rule for decimals."""
    scale = F.lit(10.0 ** digits)
    return F.rint(col(c) * scale) / scale


def date_from_key(c: ColumnLike) -> Column:
    """``yyyyMMdd`` integer key to a date; a key that is no date gives NULL."""
    return F.to_date(F.try_to_timestamp(col(c).cast("string"), F.lit("yyyyMMdd")))


def days_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.datediff(col(later), col(earlier))


def day_quarter(ts: ColumnLike) -> Column:
    """Six-hour block of the day, 1 to 4."""
    return (F.floor(F.hour(col(ts)) / 6) + 1).cast("int")


WEEKDAY_FLAGS = ("mon", "tue", "wed", "thurs", "fri", "sat", "sun")


def weekday_flags(ts: ColumnLike) -> list[Column]:
    day = F.weekday(col(ts))
    return [(day == i).cast("int").alias(name) for i, name in enumerate(WEEKDAY_FLAGS)]


def within(c: ColumnLike, low, high) -> Column:
    """Inclusive range with NULL counted as outside."""
    return is_true(col(c).between(F.lit(low), F.lit(high)))


def day(d: dt.date) -> Column:
    return F.lit(d)
