"""Correlations of wide frames: the moments of all column pairs from matrix products inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose values a task turns into one matrix.
BLOCK_ROWS = 4096
#: A column whose variance is this small a part of its second moment has one value, but for rounding.
FLAT = 1e-13
MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _partial(columns: int, centre: list[float]):
    middle = np.array(centre)
    rows, at = np.triu_indices(columns)
    names = ["a", "b", *MOMENTS]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, x, xx, xy = (np.zeros((columns, columns)) for _ in range(4))
        seen = False
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns]) - middle
                known = ~np.isnan(values)
                values[~known] = 0.0
                mask = known.astype(float)
                n += mask.T @ mask
                x += values.T @ mask  # [i, j]: sum of column i where j is known too
                xx += (values * values).T @ mask
                xy += values.T @ values
                seen = True
        if seen:
            cells = [rows, at] + [m[rows, at] for m in (n, x, x.T, xx, xx.T, xy)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i < 2 else pa.float64()) for i, c in enumerate(cells)], names=names)

    return sums


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, sx, sy, sxx, syy, sxy) for every pair of column numbers a <= b, over the rows where both are known.

    Values are taken less their column's mean, so that the sums don't cancel. A task sends one row per pair, however many rows it reads.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(columns)])
    means = numbers.agg(*[F.avg(c).alias(c) for c in numbers.columns]).first()
    centre = [m if m is not None and np.isfinite(m) else 0.0 for m in means]
    partial = numbers.mapInArrow(_partial(len(columns), centre), "a int, b int, " + ", ".join(f"{m} double" for m in MOMENTS))
    return partial.groupBy("a", "b").agg(*[F.sum(m).alias(m) for m in MOMENTS])


def corr_matrix_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations (upper triangle with diagonal) of hundreds of columns in two scans.

    Rows var_a, var_b, n (rows where both are known) and corr; the plan has one average per column and no expression per
    pair. NULL and NaN are unknown. ``corr`` is NULL where fewer than two rows are known or a side has one value only there.
    An empty frame gives every pair with n 0. Column names may hold any character, and may not repeat.
    """
    if len(set(columns)) != len(columns):
        raise ValueError("repeated column")
    if not columns:
        raise ValueError("no column")
    spark = df.sparkSession
    names = F.array(*[F.lit(c) for c in columns])
    k = len(columns)
    pairs = spark.range(k).select(F.col("id").cast("int").alias("a")).select("a", F.explode(F.sequence("a", F.lit(k - 1))).alias("b"))
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    apart = (F.col("n") >= 2) & (vx > FLAT * F.col("sxx")) & (vy > FLAT * F.col("syy"))
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / (F.sqrt(vx) * F.sqrt(vy))
    return pairs.join(pair_moments(df, columns), ["a", "b"], "left").select(
        F.get(names, F.col("a")).alias("var_a"), F.get(names, F.col("b")).alias("var_b"), F.coalesce(F.col("n"), F.lit(0.0)).cast("bigint").alias("n"),
        F.when(apart, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("corr"))
