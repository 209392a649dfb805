"""Wide correlations against pandas and against the plain aggregate."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marginloom.operators import aggregates as A
from marginloom.operators import moments as MO


def got(df, columns):
    return {(r["var_a"], r["var_b"]): (r["n"], r["corr"]) for r in MO.corr_matrix_wide(df, columns).collect()}


def test_equals_pandas_with_gaps(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(5000, 12)) + rng.normal(size=(5000, 1))
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:, 3] += 1e9  # far from zero
    frame = pd.DataFrame(values, columns=[f"x|{i}" for i in range(12)])
    df = spark.createDataFrame(frame).repartition(7)
    columns = list(frame.columns)
    want, counts = frame.corr(), frame.notna().astype(int).T @ frame.notna().astype(int)
    result = got(df, columns)
    assert len(result) == 78
    for (a, b), (n, r) in result.items():
        assert n == counts.loc[a, b] and r == pytest.approx(want.loc[a, b], abs=1e-6)


def test_equals_the_plain_aggregate(spark):
    df = spark.range(3000).select(*[F.when(F.col("id") % (5 + i) != 0, F.pmod(F.xxhash64("id", F.lit(i)), 97) + F.col("id") * i).alias(f"c{i}") for i in range(5)])
    columns = df.columns
    want = {(r["var_a"], r["var_b"]): r["corr"] for r in A.corr_matrix(df, columns).collect()}
    assert {k: v[1] for k, v in got(df, columns).items()} == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}


def test_flat_missing_and_empty(spark):
    rows = [(0.1, 1.0, None, 1, 5.0 if i < 4 else None, float(i), float("nan") if i % 2 else float(-i)) for i in range(8)]
    df = spark.createDataFrame(rows, "flat double, one double, none double, id int, `a b` double, x double, odd double")
    result = got(df, df.columns)
    assert result["flat", "flat"] == (8, None) and result["one", "x"] == (8, None) and result["none", "x"] == (0, None)
    assert result["a b", "x"] == (4, None)  # one value where both are known
    assert result["x", "x"] == (8, 1.0) and result["x", "odd"][0] == 4 and result["x", "odd"][1] == pytest.approx(-1.0)
    empty = got(df.where("false"), ["flat", "x"])
    assert empty == {("flat", "flat"): (0, None), ("flat", "x"): (0, None), ("x", "x"): (0, None)}
    for bad in ([], ["x", "x"]):
        with pytest.raises(ValueError):
            MO.corr_matrix_wide(df, bad)
