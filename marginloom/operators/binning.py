"""Right-closed binning: fixed edges, equal width, quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.functions.scalars import scaled_round
from marginloom.operators.ordered import percentile_points


def step_edges(step: float, count: int) -> list[float]:
    """Edges 0, step, 2*step, … as floating-point products (0.1 * 3 is 0.30000000000000004)."""
    return [i * step for i in range(count + 1)]


def fixed_bin(value: Column, edges: Sequence[float]) -> Column:
    """Bin number 1..n of the interval ``(edge[i-1], edge[i]]``; NULL outside, including the lowest edge."""
    position = sum(((value > e).cast("int") for e in edges[1:]), (value > edges[0]).cast("int"))
    return F.when((value > edges[0]) & (value <= edges[-1]), position)


def bin_list(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    """All bins with their edges, so empty bins are listed too."""
    rows = [(i + 1, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)]
    return df.sparkSession.createDataFrame(rows, "bin int, bin_lo double, bin_hi double")


def equal_width_edges(df: DataFrame, column: str, bins: int) -> DataFrame:
    """One row: ``lo``, ``hi``, ``step`` and the lowest edge, moved down by 0.1% of the range.

    A constant column is widened to both sides instead.
    """
    s = df.agg(F.min(column).cast("double").alias("mn"), F.max(column).cast("double").alias("mx"))
    pad = F.when(F.col("mn") == 0, F.lit(0.001)).otherwise(F.abs("mn") * 0.001)
    flat = F.col("mn") == F.col("mx")
    lo = F.when(flat, F.col("mn") - pad).otherwise(F.col("mn"))
    hi = F.when(flat, F.col("mx") + pad).otherwise(F.col("mx"))
    return s.select(lo.alias("lo"), hi.alias("hi"), ((hi - lo) / bins).alias("step"),
                    F.when(flat, lo).otherwise(lo - (hi - lo) * 0.001).alias("lowest"))


def equal_width_bin(df: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """Bin number 1..bins with its edges ``<out>_lo``, ``<out>_hi``."""
    edges = equal_width_edges(df, column, bins).select(F.struct("*").alias("e")).scalar()
    x = F.col(column).cast("double")

    def edge(i: Column) -> Column:
        return F.when(i <= 0, F.col("_e.lowest")).when(i >= bins, F.col("_e.hi")).otherwise(
            F.col("_e.lo") + i * F.col("_e.step"))

    # Arithmetic gives the bin up to rounding; comparing with the two real edges settles it.
    guess = F.greatest(F.least(F.ceil((x - F.col("_e.lo")) / F.col("_e.step")), F.lit(bins)), F.lit(1)).cast("int")
    b = F.col("_g")
    settled = (F.when((b > 1) & (x <= edge(b - 1)), b - 1).when((b < bins) & (x > edge(b)), b + 1).otherwise(b))
    return (df.withColumn("_e", edges).withColumn("_g", guess).withColumn(out, settled)
            .withColumn(f"{out}_lo", edge(F.col(out) - 1)).withColumn(f"{out}_hi", edge(F.col(out)))
            .withColumn(f"{out}_lo", F.when(F.col(out).isNotNull(), F.col(f"{out}_lo")))
            .withColumn(f"{out}_hi", F.when(F.col(out).isNotNull(), F.col(f"{out}_hi")))
            .drop("_e", "_g"))


def quantile_edges(df: DataFrame, column: str, q: int) -> DataFrame:
    """Sorted distinct quantile edges as one array row ``edges`` (at most q + 1 values)."""
    points = percentile_points(df, column, [i / q for i in range(q + 1)])
    return points.agg(F.array_sort(F.collect_set("value")).alias("edges"))


def quantile_bin(df: DataFrame, column: str, q: int, out: str = "bin") -> DataFrame:
    """Quantile bin number with edges; the first bin includes its lower edge, duplicate edges are dropped."""
    x = F.col(column).cast("double")
    e = F.col("_e")
    above = F.size(F.filter(e, lambda edge: x > edge))
    number = F.when(x.isNotNull(), F.greatest(above, F.lit(1)))
    return (df.withColumn("_e", quantile_edges(df, column, q).scalar()).withColumn(out, number)
            .withColumns({f"{out}_lo": F.get(e, F.col(out) - 1), f"{out}_hi": F.get(e, F.col(out))}).drop("_e"))


def bin_report(df: DataFrame, column: str, score: str, actual: str, method: str = "cut", q: int = 10) -> DataFrame:
    """Per bin: scored rows, mean score, mean actual, salience %. Rows without a bin form a group of their own."""
    binned = equal_width_bin(df, column, q) if method == "cut" else quantile_bin(df, column, q)
    out = binned.groupBy("bin", "bin_lo", "bin_hi").agg(
        F.count(score).alias("n"), scaled_round(F.avg(score), 2).alias("score_mean"), F.avg(actual).alias("actual_mean"))
    total = out.agg(F.sum("n")).scalar()
    return out.withColumn("salience_pct", scaled_round(F.col("n") * 100.0 / total, 2))
