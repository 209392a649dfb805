"""Boosted trees under losses of their own, held to brute force over the emitted rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marginloom.operators import boosting as B


def expectile(values, penalty):
    """The value that the asymmetric square is least at, by halving on its slope."""
    lo, hi = min(values), max(values)
    for _ in range(80):
        mid = (lo + hi) / 2
        slope = sum((penalty if v > mid else 1.0) * (v - mid) for v in values)
        lo, hi = (mid, hi) if slope > 0 else (lo, mid)
    return lo


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(i % 4), float((i // 4) % 3), float(rng.gamma(2.0, 1.0 + i % 4))) for i in range(2400)]
    return spark.createDataFrame(rows, "id int, a double, b double, y double").cache()


def test_leaves_reach_the_expectiles(spark, days):
    model = B.fit(days, ["a"], "y", B.AsymmetricSquare(20.0), rounds=12, steps=(0.5, 1.0), depth=2)
    got = dict(model.transform(days).groupBy("a").agg(F.max("score")).collect())
    for a in range(4):
        values = [r["y"] for r in days.where(F.col("a") == a).collect()]
        assert got[float(a)] == pytest.approx(expectile(values, 20.0), abs=0.02)
    losses = [h[2] for h in model.history]
    assert all(x >= y - 1e-9 for x, y in zip(losses, losses[1:]))
    assert {h[1] for h in model.history} <= {0.5, 1.0}


def test_history_equals_the_loss_of_the_emitted_rows(days):
    train, valid = days.where("id % 5 <> 0"), days.where("id % 5 = 0")
    model = B.fit(train, ["a", "b"], "y", B.AsymmetricSquare(20.0), valid=valid, rounds=6, steps=(0.5, 1.0), depth=3, patience=6)
    emitted = model.transform(valid).toPandas()
    sql = "select avg(case when y > score then 20 else 1 end * (y - score) ** 2) from emitted"
    assert duckdb.sql(sql).fetchall()[0][0] == pytest.approx(min(h[3] for h in model.history), rel=1e-9)


def test_patience_drops_the_trees_after_the_lowest_loss(spark):
    rng = np.random.default_rng(5)
    noise = spark.createDataFrame([(float(x), int(y)) for x, y in zip(rng.random(600), rng.random(600) < 0.4)], "x double, y int")
    train, valid = noise.limit(300), noise.subtract(noise.limit(300))
    model = B.fit(train, ["x"], "y", B.LogLoss(), valid=valid, rounds=40, steps=(0.5,), depth=5, patience=3)
    held = [h[3] for h in model.history]
    assert len(held) < 40 and len(model.trees) == held.index(min(held)) + 1 == len(held) - 3


def test_weights_count_as_repeated_rows(spark):
    rows = [(float(i % 3), float(i % 3 == 2 and i % 2), float(1 + i % 2 * 3)) for i in range(90)]
    weighed = spark.createDataFrame(rows, "x double, y double, w double")
    repeated = weighed.select("x", "y", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))).alias("_"))
    a = B.fit(weighed, ["x"], "y", B.LogLoss(), weight="w", rounds=3, depth=2)
    b = B.fit(repeated, ["x"], "y", B.LogLoss(), rounds=3, depth=2)
    points = spark.createDataFrame([(float(x),) for x in range(3)], "x double")
    for p, q in zip(a.probability(points).collect(), b.probability(points).collect()):
        assert p["score"] == pytest.approx(q["score"], abs=1e-9) and p["predicted_class"] == q["predicted_class"]


def test_importance_equals_sql_over_the_nodes(spark, days, tmp_path):
    path = str(tmp_path / "model")
    model = B.fit(days.withColumn("idle", F.lit(0.0)), ["a", "b", "idle"], "y", B.AsymmetricSquare(20.0), rounds=4, steps=(0.5,), depth=3)
    model.save(spark, path)
    again = B.load(spark, path)
    frame = days.withColumn("idle", F.lit(0.0))
    assert [r["score"] for r in again.transform(frame).orderBy("id").collect()] == [r["score"] for r in model.transform(frame).orderBy("id").collect()]
    assert [tuple(r) for r in again.rounds(spark).collect()] == model.history
    nodes = B.node_table(spark, path, ["a", "b", "idle"])
    tree_nodes = nodes.toPandas()
    want = dict(duckdb.sql("""select feature, sum(gain * weight) / sum(sum(gain * weight)) over () from tree_nodes
                              where feature is not null group by feature""").fetchall())
    got = {r["feature"]: r["importance"] for r in B.gain_importance(nodes, ["a", "b", "idle"]).collect()}
    assert set(got) == {"a", "b", "idle"} and got["idle"] == 0.0 and got["a"] > 0.5
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    # a node's gain is the fall of the weighted squared step from the node to its two children
    children = duckdb.sql("""select p.gain * p.weight, p.weight, l.weight + r.weight, p.n, l.n + r.n from tree_nodes p
        join tree_nodes l on l.round = p.round and l.node = p.left_node join tree_nodes r on r.round = p.round and r.node = p.right_node""").fetchall()
    assert children and all(g > 0 and a == pytest.approx(b) and m == n for g, a, b, m, n in children)
    assert sum(t.numNodes for t in again.trees) == len(tree_nodes)


def test_defined_results_without_rows(spark, days):
    with pytest.raises(ValueError):
        B.fit(days.where("false"), ["a"], "y", B.LogLoss(), rounds=1)
    model = B.fit(days.withColumn("y", F.when(F.col("id") < 1200, F.col("y"))), ["a"], "y", B.AsymmetricSquare(1.0), rounds=1, depth=1)
    assert model.transform(days.where("false")).count() == 0
    clash = model.transform(days.withColumn("score", F.lit("x")).withColumn("_f", F.lit(1)))
    assert clash.columns == ["id", "a", "b", "y", "_f", "score"] and clash.schema["score"].dataType.simpleString() == "double"


def test_equal_rows_go_through_the_rounds_as_one(spark, tmp_path, monkeypatch):
    data = spark.range(900).selectExpr("cast(id % 3 as double) a", "cast(id % 2 as double) b", "cast(id % 3 + id % 2 as double) y", "cast(1 + id % 2 as double) w")
    seen = []
    written = B._written
    monkeypatch.setattr(B, "_written", lambda df, folder, i: seen.append(written(df, folder, i)) or seen[-1])
    one = B.fit(data, ["a", "b"], "y", B.AsymmetricSquare(3.0), weight="w", rounds=2, depth=2)
    assert seen[0].count() == 6 and seen[0].agg(F.sum("_w")).first()[0] == 1350.0
    apart = B.fit(data, ["a", "b"], "y", B.AsymmetricSquare(3.0), weight="w", rounds=2, depth=2, min_rows=2)
    assert seen[-1].count() == 900 and seen[-1].agg(F.sum("_w")).first()[0] == 1350.0
    for p, q in zip(one.history, apart.history):
        assert p[2] == pytest.approx(q[2], rel=1e-9)
    points = data.distinct()
    scores = lambda m: sorted((r["a"], r["b"], round(r["score"], 9)) for r in m.transform(points).collect())
    assert scores(one) == scores(apart)


def test_delivery_days_learn_from_equal_rows_as_one_of_their_weight(spark, monkeypatch):
    from marginloom.operators import models as M
    data = spark.range(300).selectExpr("cast(id % 3 as double) a", "cast(id % 3 * 2 + id % 2 as double) p90", "cast(1 + id % 2 as double) n")
    fitted = []
    fit = M.Pipeline.fit
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, df: fitted.append(df) or fit(self, df))
    model = M.fit_delivery_days(data, ["a"], "p90", weight="n", depth=2, rounds=2)
    assert fitted[0].count() == 6 and fitted[0].agg(F.sum("_w")).first()[0] == 450.0
    got = {r["a"]: r["predicted"] for r in M.score_value(model, data.select("a").distinct()).collect()}
    for a in range(3):  # a leaf holds the weighted mean: even targets weigh 1, odd ones 2 where the target is even plus 1
        want = data.where(F.col("a") == a).agg(F.sum(F.col("p90") * F.col("n")) / F.sum("n")).first()[0]
        assert got[float(a)] == pytest.approx(want, abs=0.05)
