"""Running totals and exact percentiles over an ordered value, without a single-task window.

The ordered rows are cut into slices of about SLICE_ROWS at values of a bounded random sample, so any type
that Spark can order will do. Totals per slice give every slice its starting offset, so the windows only run
inside one slice. Equal values are summed before anything is shuffled by slice, which makes
a value holding a third of all rows one single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows (one per key and value) that a slice holds on average.
SLICE_ROWS = 100_000
#: Sampled rows and edges on the driver, at most; beyond that number of slices they grow instead.
SAMPLE, MOST_SLICES = 8192, 1024


def _slice_edges(grouped: DataFrame, keys: Sequence[str], value: str, slice_rows: int) -> list:
    """Sorted edges between slices, from the rows with the smallest hashes.

    Those are a fair sample of all rows, and how far the hashes reach tells how many rows there are.
    """
    sample = grouped.select(value, F.xxhash64(*keys, value).alias("_h")).orderBy("_h").limit(SAMPLE).collect()
    n = len(sample) if len(sample) < SAMPLE else int((SAMPLE - 1) * 2.0**64 / (sample[-1]["_h"] + 2.0**63 + 1))
    slices = min(MOST_SLICES, -(-n // slice_rows))
    values = sorted(r[0] for r in sample if r[0] == r[0])
    return sorted({values[len(values) * i // slices] for i in range(1, slices)}) if values else []


def _slice_of(value: Column, edges: Sequence[float], first: int = 0) -> Column:
    """Number of edges not above the value, as a balanced comparison tree."""
    if not edges:
        return F.lit(first)
    mid = len(edges) // 2
    return F.when(value < edges[mid], _slice_of(value, edges[:mid], first)).otherwise(
        _slice_of(value, edges[mid + 1:], first + mid + 1))


def running_totals(df: DataFrame, value: str, sums: Mapping[str, Column], keys: Sequence[str] = (),
                   descending: bool = False, slice_rows: int | None = None) -> DataFrame:
    """One row per (keys, value): each sum, its running total ``cum_*`` and group total ``tot_*``.

    ``sums`` maps names to aggregate columns that add up (counts, sums). NULL values are left out.
    """
    keys = list(keys)
    present = df.where(F.col(value).isNotNull())
    grouped = present.groupBy(*keys, value).agg(*[c.alias(n) for n, c in sums.items()])
    edges = _slice_edges(grouped, keys, value, slice_rows or SLICE_ROWS)
    sliced = grouped.withColumn("_slice", _slice_of(F.col(value), edges))

    per_slice = sliced.groupBy(*keys, "_slice").agg(*[F.sum(n).alias(n) for n in sums])
    order = F.desc if descending else F.asc
    over_slices = Window.partitionBy(*keys)
    before = over_slices.orderBy(order("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_s"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(n).over(over_slices).alias(f"tot_{n}") for n in sums])

    match = F.col("_slice") == F.col("_s")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = (Window.partitionBy(*keys, "_slice").orderBy(order(value))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return sliced.join(offsets, match).select(
        *keys, value, *sums,
        *[(F.col(f"_off_{n}") + F.sum(n).over(inside)).alias(f"cum_{n}") for n in sums],
        *[f"tot_{n}" for n in sums])


def percentile_points(df: DataFrame, value: str, fractions: Sequence[float],
                      keys: Sequence[str] = (), slice_rows: int | None = None) -> DataFrame:
    """Linearly interpolated percentiles, one row per (keys, ``point``) with ``point`` the index in ``fractions``.

    Exact for groups of any size: only the at most two rows that hold a percentile's neighbours go on
    to the last aggregation.
    """
    ranked = running_totals(df, value, {"n": F.count(F.lit(1))}, keys, slice_rows=slice_rows)
    points = F.array(*[
        F.struct(F.lit(i).alias("point"), (F.lit(float(f)) * (F.col("tot_n") - 1)).alias("pos"))
        for i, f in enumerate(fractions)])

    def held(rank: Column) -> Column:
        return (rank >= F.col("cum_n") - F.col("n")) & (rank < F.col("cum_n"))

    hits = ranked.select(*keys, F.col(value).cast("double").alias("_v"), "cum_n", "n", F.explode(F.filter(
        points, lambda p: held(F.floor(p["pos"])) | held(F.ceil(p["pos"])))).alias("_p"))
    lo = F.min(F.when(held(F.floor("_p.pos")), F.col("_v")))
    hi = F.min(F.when(held(F.ceil("_p.pos")), F.col("_v")))
    pos = F.max("_p.pos")
    return hits.groupBy(*keys, F.col("_p.point").alias("point")).agg((lo + (hi - lo) * (pos - F.floor(pos))).alias("value"))


def exact_percentiles(df: DataFrame, value: str, fractions: Mapping[str, float],
                      keys: Sequence[str] = (), slice_rows: int | None = None) -> DataFrame:
    """The same percentiles as one named column each, one row per group."""
    points = percentile_points(df, value, list(fractions.values()), keys, slice_rows)
    return points.groupBy(*keys).agg(*[
        F.max(F.when(F.col("point") == i, F.col("value"))).alias(name) for i, name in enumerate(fractions)])
