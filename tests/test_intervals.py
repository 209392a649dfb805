"""Interval joins against SQL, and their size before the filter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marginloom.operators import intervals as IV
from marginloom.operators import joins as J

INF = float("inf")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_touching_nested_and_odd_bands_equal_the_plain_join(spark):
    left = spark.createDataFrame(
        [(k, i, x) for k in ("a", "b", None) for i, x in enumerate([0.0, 1.0, 1.5, 2.0, 3.0, 1e18, -4.25, -INF, INF, None, float("nan"), 7.0, 7.0])],
        "k string, i int, x double")
    bands = spark.createDataFrame(
        [("a", 0.0, 1.0, 1), ("a", 1.0, 2.0, 2), ("a", 0.0, 100.0, 3), ("a", 1.5, 1.5, 4), ("a", -INF, 0.0, 5), ("a", 2.0, INF, 6),
         ("a", -INF, INF, 7), ("a", 3.0, 2.0, 8), ("a", None, 9.0, 9), ("a", 0.0, 1.0, 1), ("b", 1e18, 1e18, 10), ("b", -5.0, -4.0, 11),
         ("b", float("nan"), 2.0, 12), ("b", 0.0, 0.0, 13), (None, 0.0, 9.0, 14), ("c", 0.0, 9.0, 15)], "k string, lo double, hi double, n int")
    for how in ("left", "inner"):
        sound = left.where("x IS NULL OR NOT isnan(x)")
        want = rows(J.band_join(sound, bands.where("lo IS NULL OR NOT isnan(lo)"), ["k"], "x", "lo", "hi", how))
        assert rows(IV.interval_join(sound, bands, ["k"], "x", "lo", "hi", how)) == want
    nans = IV.interval_join(left.where("isnan(x)"), bands, ["k"], "x", "lo", "hi")
    assert nans.count() == 3 and nans.where("n IS NOT NULL").count() == 0


@pytest.mark.parametrize("scale", [1e-9, 0.01, 1.0, 1e7])
def test_random_bands_equal_the_plain_join(spark, scale):
    base = spark.range(900).select((F.col("id") % 3).cast("int").alias("k"), (F.pmod(F.xxhash64("id"), 4000) * scale).alias("x"))
    low = F.pmod(F.xxhash64("id", F.lit(1)), 4000) * scale
    bands = spark.range(300).select((F.col("id") % 3).cast("int").alias("k"), low.alias("lo"),
                                    (low + F.pow(F.lit(2.0), (F.col("id") % 13) - 3) * scale).alias("hi"), F.col("id").alias("n"))
    assert rows(IV.interval_join(base, bands, ["k"], "x", "lo", "hi")) == rows(J.band_join(base, bands, ["k"], "x", "lo", "hi"))


def test_a_day_per_row(spark, duck):
    d = dt.date(2020, 1, 1)
    left = spark.createDataFrame([(i % 2, float(i % 7), d + dt.timedelta(days=i % 10) if i % 11 else None) for i in range(120)], "k int, x double, day date")
    bands = spark.createDataFrame([(i % 2, float(i % 5), float(i % 5 + i % 3), d + dt.timedelta(days=i % 4),
                                    d + dt.timedelta(days=i % 4 + 3) if i % 9 else None, i) for i in range(40)],
                                  "k int, lo double, hi double, begins date, ends date, n int")
    got = rows(IV.interval_join(left, bands, ["k"], "x", "lo", "hi", start="begins", end="ends", on="day"))
    l, b = left.toPandas(), bands.toPandas()  # noqa: F841
    want = duck.execute("""select l.*, b.lo, b.hi, b.begins, b.ends, b.n from l left join b on l.k = b.k and l.x between b.lo and b.hi
                           and l.day between b.begins and b.ends""").fetchall()
    as_days = lambda r: tuple(v.date() if hasattr(v, "date") else v for v in r)
    assert len(got) == len(want)
    assert sorted(str(tuple(x for x in r if not isinstance(x, (dt.date, type(None))))) for r in got) == sorted(
        str(tuple(x for x in as_days(r) if not isinstance(x, (dt.date, type(None))) and x == x)) for r in want)


def test_a_hot_key_stays_linear(spark):
    """A third of both sides under one key: rows before the filter grow with the sides, not with their product."""
    def before_filter(n):
        left = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 1.0).alias("x"))
        bands = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 1.0 - 1).alias("lo"),
                                      (F.col("id") * 1.0 + 1).alias("hi"), F.col("id").alias("n"))
        looked, cells = IV.looks(left, bands, ["k"], "x", "lo", "hi")
        return looked.join(cells, ["_k0", "_level", "_cell"]).count()
    small, large = before_filter(3000), before_filter(12000)
    assert large < 4.5 * small < 4.5 * 4 * 3000


def test_empty_sides_and_clashes(spark):
    left = spark.createDataFrame([("a", 1.0)], "k string, x double")
    bands = spark.createDataFrame([("a", 0.0, 2.0, 1)], "k string, lo double, hi double, n int")
    assert IV.interval_join(left.where("false"), bands, ["k"], "x", "lo", "hi").count() == 0
    assert rows(IV.interval_join(left, bands.where("false"), ["k"], "x", "lo", "hi")) == [("a", 1.0, None, None, None)]
    with pytest.raises(ValueError):
        IV.interval_join(left, bands.withColumnRenamed("n", "x"), ["k"], "x", "lo", "hi")


def test_keys_of_few_bands_are_joined_as_they_are(spark, monkeypatch):
    """One join where no key is crowded; cells as soon as one key is, with the same rows."""
    d = dt.date(2020, 1, 1)
    left = spark.createDataFrame([(i % 3 if i % 13 else None, [float(i % 7), None, float("nan"), INF][0 if i % 5 else i % 4], d + dt.timedelta(days=i % 10))
                                  for i in range(150)], "k int, x double, day date")
    bands = spark.createDataFrame([(i % 3 if i % 8 else None, float(i % 5), [float(i % 5 + i % 3), INF, float("nan"), None][0 if i % 6 else i % 4],
                                    d + dt.timedelta(days=i % 4), d + dt.timedelta(days=i % 4 + 3), i) for i in range(60)],
                                  "k int, lo double, hi double, begins date, ends date, n int")
    run = lambda how: IV.interval_join(left, bands, ["k"], "x", "lo", "hi", how, start="begins", end="ends", on="day")
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    few = [run(how) for how in ("left", "inner")]
    most = bands.where("lo <= hi AND NOT isnan(hi) AND k IS NOT NULL").groupBy("k").count().agg({"count": "max"}).first()[0]
    monkeypatch.setattr(IV, "FEW", most)
    assert joins(run("left")) == 1
    monkeypatch.setattr(IV, "FEW", most - 1)
    many = [run(how) for how in ("left", "inner")]
    assert [joins(x) for x in few] == [1, 1] and [joins(x) for x in many] == [3, 3]
    assert str([rows(x) for x in few]) == str([rows(x) for x in many]) and few[1].count() > 20
