"""Branch and boundary behaviour on small literal frames."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginloom.functions import scalars as S
from marginloom.operators import aggregates as A
from marginloom.operators import binning as B
from marginloom.operators import encoders as EN
from marginloom.operators import evaluation as E
from marginloom.operators import joins as J
from marginloom.operators import ordered as O
from marginloom.operators import windows as W
from marginloom.plans import pricing as P
from marginloom.plans import propensity as PR
from marginloom.sources import snapshots as SN
from marginloom.sources import tables as T


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_strict_least_and_rates(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (3.0, 2.0, 0.0)], "a double, b double, d double")
    got = values(df.select(S.least_strict("a", "b").alias("l"), S.greatest_strict("a", "b").alias("g"),
                           S.safe_rate("a", "d").alias("r")), "l", "g", "r")
    assert got == [(None, None, 25.0), (2.0, 3.0, None)]


def test_canonical_code_live_and_dead_form(spark):
    df = spark.createDataFrame([("s00a",), ("S00a",), ("x1",), ("sdl1",), (None,)], "c string")
    assert [r[0] for r in df.select(S.canonical_code("c")).collect()] == ["S00a", "S00a", "x1", "Sdl1", None]
    assert [r[0] for r in df.select(S.canonical_code("c", prefix="sdl")).collect()] == ["s00a", "S00a", "x1", "sdl1", None]


def test_null_predicate_keeps_deleted_row_and_snapshot_days(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert {r[0] for r in T.delete_where(df, F.col("x") > 3).collect()} == {1, None}
    as_of = dt.date(2022, 1, 10)
    hist = spark.createDataFrame([(as_of - dt.timedelta(days=d),) for d in (0, 1, 7, 9)], "snapshot_date date")
    assert SN.retained(hist, as_of).count() == 2
    assert SN.retained(hist, as_of, exact_day=False).count() == 1


def test_csv_round_trip_and_refresh(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    T.write_csv(df, str(tmp_path / "c"))
    assert sorted(values(T.read_csv(spark, str(tmp_path / "c"), "k int, v string"), "k", "v")) == [(1, "a"), (2, None)]
    assert T.materialize(df, str(tmp_path / "p")).count() == 2
    SN.write_snapshot(df, str(tmp_path / "s"), dt.date(2022, 1, 1))
    SN.write_snapshot(df, str(tmp_path / "s"), dt.date(2022, 1, 1))
    SN.write_snapshot(df, str(tmp_path / "s"), dt.date(2022, 1, 2))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4


def test_tied_latest_rule_and_kept_ties(spark):
    d = dt.date(2022, 1, 1)
    df = spark.createDataFrame([("k", d, 0, 1), ("k", d, 1, 0), ("k", None, 1, 1)], "k string, updated date, i int, h int")
    assert values(W.dedup_latest(df, ["k"], ["updated", "i", "h"]), "i", "h") == [(1, 0)]
    assert W.keep_top_ties(df, ["k"], ["updated"]).count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 2)
    plan = W.dedup_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_band_join_touching_bands_and_range_lookup_paths(spark):
    left = spark.createDataFrame([("s", 400.0), ("s", 401.0), ("t", 1.0)], "sub string, price double")
    bands = spark.createDataFrame([("s", 0.0, 400.0), ("s", 400.0, 900.0)], "sub string, lo double, hi double")
    assert J.band_join(left, bands, ["sub"], "price", "lo", "hi").count() == 4
    grid = spark.createDataFrame([(79.0, 99.0, 1), (99.0, 149.5, 2), (160.0, 300.0, 3)], "lo double, hi double, id int")
    rnd = random.Random(5)
    xs = [79.0, 98.999, 99.0, 149.5, 155.0, 160.0, 300.0, -4.0, None] + [rnd.uniform(60, 320) for _ in range(200)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    want = {i: next((g for lo, hi, g in ((79, 99, 1), (99, 149.5, 2), (160, 300, 3)) if x is not None and lo <= x < hi), None)
            for i, x in enumerate(xs)}
    for rows in (100, 1):  # literal index, then the joined form
        out = J.range_lookup(df, grid, {"x": "g"}, "lo", "hi", max_rows=rows).select("i", F.col("g.id").alias("g"))
        assert dict(values(out, "i", "g")) == want


@pytest.mark.parametrize("segments", [
    [(79, 99, 1), (90, 120, 2), (150, 151, 3)],                                    # overlapping
    [(0, 10, 1), (10, math.inf, 2), (-math.inf, -5, 3)],                           # open ends
    [(0, 0.001, 1), (1, 1_000_000, 2), (2, 3, 4)],                                 # narrow beside wide, nested
    [(5, 5, 1), (7, 6, 2), (None, 3, 3), (3, None, 4), (math.nan, 4, 5)],          # nothing in any of them
    [(-math.inf, math.inf, 1)], [(1e300, 1e301, 1), (0, 1, 2)], []])
def test_range_lookup_gives_the_same_rows_at_every_grid_size(spark, segments):
    grid = spark.createDataFrame([(None if a is None else float(a), None if b is None else float(b), i) for a, b, i in segments], "lo double, hi double, id int")
    xs = [None, math.nan, math.inf, -math.inf, 1e300, -1e300, 1e18, 0.0, 0.0005, -5.0, 9.999, 10.0, 90.0, 98.9, 99.0, 119.9, 150.5, 2.5, 999_999.5, 1e6]
    df = spark.createDataFrame([(i, x, x) for i, x in enumerate(xs)], "i int, x double, y double")
    live = [(a, b, g) for a, b, g in segments if a is not None and b is not None and a < b]
    hits = {i: [g for a, b, g in live if x is not None and a <= x < b] or [None] for i, x in enumerate(xs)}
    want = sorted((i, a or 0, b or 0) for i in hits for a in hits[i] for b in hits[i])
    for limits in ({}, {"max_rows": 0}, {"max_units": 1}):
        out = J.range_lookup(df, grid, {"x": "g", "y": "h"}, "lo", "hi", **limits)
        assert sorted((r["i"], r["g"]["id"] if r["g"] else 0, r["h"]["id"] if r["h"] else 0) for r in out.collect()) == want


def test_update_never_adds_rows(spark):
    target = spark.createDataFrame([("A", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)], "k string, v double")
    source = spark.createDataFrame([("a", 1, 10.0), ("A", 2, 20.0), ("A", 2, 15.0), (None, 9, 99.0)], "key string, day int, w double")
    out = J.update_from(target, source, {"k": "key"}, {"v": F.col("src_w")}, casefold=True, newest_first=[F.desc("day")])
    assert sorted(values(out, "k", "v"), key=str) == sorted([("A", 20.0), ("a", 20.0), ("b", 3.0), (None, 4.0)], key=str)


def test_match_reaches_every_row_of_a_pair(spark):
    cols = "supc string, vendor_code string, product_sid int, selling_price double, seller_price double, slab double, step7_list_b double, list_b_cb double, " \
           "is_hard_exception int, is_pushed int, pog_id string, is_enabled_with_inv int, variant1_name string"
    rows = [("X", "v", 1, 900.0, 300.0, 1.0, 10.0, 5.0, 0, 0, "g", 1, "n"), ("X", "V", 2, 900.0, 300.0, 1.0, 10.0, 5.0, 1, 0, "g", 1, "n"),
            ("Y", "v", 3, 900.0, 300.0, 1.0, 10.0, 5.0, 1, 0, "g", 1, "n")]
    rivals = spark.createDataFrame([("x", "v", 870.0, 880.0), ("X", "V", 860.0, 880.0), ("y", "v", 1.0, 1.0)],
                                   "supc string, vendor_code string, rival_a_price double, rival_b_price double")
    visits = spark.createDataFrame([], "pog_id string, visit_date date")
    out = P.push_stage(spark.createDataFrame(rows, cols), rivals, visits, dt.date(2020, 1, 1), P.Policy())
    assert sorted(values(out, "product_sid", "list_b_cb", "is_pushed")) == [(1, 30.0, 1), (2, 30.0, 1), (3, 5.0, 0)]


def test_rules_join_like_successive_joins(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, n int")
    x = spark.createDataFrame([("a", 1), ("a", 2), ("d", 9)], "k string, x int")
    y = spark.createDataFrame([("a", 5), ("b", 6), ("a", 7), (None, 8), ("b", 6)], "k string, y int")
    one = left.join(J.fold_rules([x, y], ["k"]), "k", "left").select("k", "n", "x", "y")
    two = left.join(x, "k", "left").join(y.distinct(), "k", "left").select("k", "n", "x", "y")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_rules_share_one_exchange_of_the_listings(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(1000).selectExpr("cast(id % 7 as string) k", "id")
        rules = [spark.range(20).selectExpr(f"cast(id as string) k", f"id as r{i}") for i in range(4)]
        plan = base.join(J.fold_rules(rules, ["k"]), "k", "left")._jdf.queryExecution().executedPlan().toString()
        assert "FullOuter" not in plan and plan.count("Exchange hashpartitioning(k") <= 10
        assert plan.count("Range (0, 1000") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dictionary_lookup_does_not_move_rows(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("cast(id % 7 as string) c", "id % 2 as y")
        d = EN.fit_woe(df, "c", "y")
        small = EN.apply_woe(df, d, "c")
        assert "Exchange hashpartitioning" not in small._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(EN, "LOOKUP_ROWS", 2)
        assert sorted(map(str, EN.apply_woe(df, d, "c").collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pooled_variance_of_large_values_and_nulls(spark):
    a, b = [1e9 + x for x in range(10)], [1e9 + 3 * x for x in range(10)]
    norm = EN.fit_global_norm(spark.createDataFrame(list(zip(a, b)), "a double, b double"), ["a", "b"]).first()
    assert abs(norm["variance"] - np.var(a + b)) < 1e-3
    holes = EN.fit_global_norm(spark.createDataFrame([(1.0, None), (3.0, 2.0)], "a double, b double"), ["a", "b"]).first()
    assert holes["mean"] == 2.0 and abs(holes["variance"] - 2 / 3) < 1e-12


def test_dirty_date_keys_and_undersampling(spark):
    keys = spark.createDataFrame([(20240229,), (20230229,), (7,), (None,)], "k int")
    assert [r[0] for r in keys.select(S.date_from_key("k")).collect()] == [dt.date(2024, 2, 29), None, None, None]
    df = spark.range(2000).selectExpr("id", "cast(id % 10 = 0 as int) as y")
    n = {r["y"]: r["count"] for r in EN.undersample(df, "y", {0: 25}, "id").groupBy("y").count().collect()}
    assert n[1] == 200 and 350 < n[0] < 550


def test_running_totals_over_strings_and_dates(spark):
    rows = [(w, dt.date(2020, 1, 1 + len(w))) for w in ["b", "a", "ccc", "a", "é", "b", "b"]]
    df = spark.createDataFrame(rows, "w string, d date")
    for c in ("w", "d"):
        out = O.running_totals(df, c, {"n": F.count(F.lit(1))}, slice_rows=1).orderBy(c).collect()
        assert [r["cum_n"] for r in out] == list(np.cumsum([r["n"] for r in out])) and out[-1]["cum_n"] == 7


def test_stages_resume_and_log(spark, tmp_path):
    built = []

    def make(n):
        def build():
            built.append(n)
            return spark.range(n)
        return build
    path, log = str(tmp_path / "one"), str(tmp_path / "log")
    assert T.staged(make(3), spark, path, log).count() == T.staged(make(5), spark, path, log).count() == 3
    assert built == [3]
    steps = spark.read.parquet(log).collect()
    assert sorted((r.stepname, r.endtime is None) for r in steps) == [("one", False), ("one", True)]
    (tmp_path / "one" / "_SUCCESS").unlink()
    assert T.staged(make(5), spark, path).count() == 5


def test_snapshot_removes_the_expired_day(spark, tmp_path):
    path = str(tmp_path / "snap")
    for day in range(1, 10):
        SN.write_snapshot(spark.range(day), path, dt.date(2024, 1, day))
    days = [r[0] for r in spark.read.parquet(path).select("snapshot_date").distinct().orderBy("snapshot_date").collect()]
    assert days == [dt.date(2024, 1, d) for d in range(3, 10)]


def test_shared_endpoint_gives_one_row_per_different_cutoff(spark):
    df = spark.createDataFrame([("s", 400.0)], "subcategory_id string, selling_price double")
    bands = [("s", 0.0, 400.0, 1.0), ("s", 400.0, 900.0, 1.0), ("s", 300.0, 500.0, 2.0)]
    out = P.attach_bands(df, spark.createDataFrame(bands, "subcategory_id string, from_price double, to_price double, v double"))
    assert sorted(r["v"] for r in out.collect()) == [1.0, 2.0]


def test_running_totals_and_percentiles_match_numpy(spark):
    rnd = random.Random(1)
    data = [(rnd.choice("ab") if rnd.random() > .05 else None, rnd.choice([7.0, round(rnd.gauss(50, 20), 1)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, v double")
    t = {(r["k"], r["v"]): r for r in O.running_totals(df, "v", {"n": F.count(F.lit(1))}, ["k"], slice_rows=60).collect()}
    for (k, v), r in t.items():
        assert r["cum_n"] == sum(1 for a, b in data if a == k and b <= v)
    got = {r["k"]: r for r in O.exact_percentiles(df, "v", {"p10": .1, "p50": .5, "p90": .9}, ["k"], slice_rows=60).collect()}
    for k in ("a", "b", None):
        vs = [b for a, b in data if a == k]
        for n, q in (("p10", 10), ("p50", 50), ("p90", 90)):
            assert math.isclose(got[k][n], np.percentile(vs, q), rel_tol=1e-12)


def test_fixed_bins_follow_float_edges(spark):
    edges = B.step_edges(0.1, 10)
    df = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.30000000000000004,), (0.31,), (1.0,), (1.1,), (None,)], "x double")
    assert [r[0] for r in df.select(B.fixed_bin(F.col("x"), edges)).collect()] == [None, 1, 3, 3, 4, 10, None, None]


def test_equal_width_and_quantile_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = dict(values(B.equal_width_bin(df, "x", 5), "x", "bin"))
    assert got == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3, 7: 4, 8: 4, 9: 5, 10: 5}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert len(set(values(B.equal_width_bin(flat, "x", 4), "bin"))) == 1
    dup = spark.createDataFrame([(1.0,)] * 50 + [(float(i),) for i in range(2, 12)], "x double")
    out = B.quantile_bin(dup, "x", 10)
    assert min(r["bin"] for r in out.collect()) == 1 and len({r["bin"] for r in out.collect()}) < 10


def test_woe_dictionary_and_vocab_thresholds(spark):
    rows = [("a", 1)] * 3 + [("a", 0)] * 7 + [("b", 1)] * 5 + [("b", 0)] * 5 + [(None, 1)] * 2
    df = spark.createDataFrame(rows, "c string, y int")
    e, n = 10.0, 22
    ne = n - e
    w = {}
    for c, ev, tot in (("a", 3, 10), ("b", 5, 10)):
        non = tot - ev
        v = 100 * math.log(((non + .5) / ne) / ((ev + .5) / e)) * (non / ne - ev / e)
        w[c] = -v if ev / tot < e / n else v
    got = dict(values(EN.fit_woe(df, "c", "y"), "category", "woe"))
    assert got.keys() == {"a", "b"} and all(math.isclose(got[c], w[c]) for c in w)
    assert {r["woe"] for r in EN.apply_woe(spark.createDataFrame([("zz",)], "c string"),
                                           EN.fit_woe(df, "c", "y"), "c", out="woe").collect()} == {None}
    v = spark.createDataFrame([("x",)] * 100 + [("y",)] * 99, "c string")
    assert values(EN.fit_vocab(v, "c", 100), "c") == [("x",)] and EN.fit_vocab(v, "c", 100, strict=True).count() == 0


def test_scaling_constant_column_and_one_hot_limit(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    assert values(EN.apply_scaler(df, EN.fit_scaler(df, ["a", "c"]), ["a", "c"]), "a", "c") == [(-1.0, 0.0), (1.0, 0.0)]
    vocab = spark.createDataFrame([(str(i),) for i in range(5)], "v string")
    wide = spark.range(700).selectExpr("cast(id as string) v")
    assert len(EN.one_hot(vocab, "v", wide).columns) == 701
    assert EN.one_hot_vector(vocab, "v", "vec").transform(vocab).count() == 5


def test_promise_window_half_even(spark):
    df = spark.createDataFrame([(0.5, 1), (1.5, 9), (2.5, 3), (3.4, 1)], "p double, a int")
    got = values(E.promise_window(df, "a", "p").orderBy("p"), "pdd1", "pdd2", "breach")
    assert got == [(1, 3, "ontime"), (1, 3, "positive"), (1, 3, "ontime"), (2, 4, "negative")]


def test_auc_matches_pair_counting_with_ties(spark):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < .4), round(rnd.random(), 1)) for _ in range(300)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > q) + .5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = E.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["auc"]
    assert math.isclose(got, want)


def test_labels(spark):
    d = [dt.date(2022, 4, 1), dt.date(2022, 4, 5), None]
    df = spark.createDataFrame([(x,) for x in d], "d date")
    lo, hi = dt.date(2022, 4, 1), dt.date(2022, 4, 3)
    assert [r[0] for r in df.select(PR.label_window("d", lo, hi)).collect()] == [1, 0, 0]
    assert [r[0] for r in df.select(PR.label_three_way("d", lo, hi)).collect()] == [1, 2, 0]


def brute_round(cb, vip, share, floor, tax, g):
    if cb is None:
        return None
    p = vip - cb
    if p < 79 or p >= 1999 or (g and p in (g[0], g[5])):
        return cb
    if not g:
        return cb
    spans = [(g[0], g[5], p < g[5])] + [(a, b, a is not None and b is not None and a <= p <= b) for a, b in zip(g, g[1:])]
    for lo, hi, inside in spans:
        if not inside:
            continue
        up, down = hi - p, p - lo
        if up <= down and cb - up >= 0:
            return cb - up
        if up >= down and floor is not None and share - (cb + down) / tax >= floor:
            return cb + down
        if up >= down and cb - up >= 0:
            return cb - up
    return cb


def test_price_point_rounding_against_brute_force(spark):
    rnd = random.Random(11)
    grids = [None, (79.0, 99.0, 119.0, 134.0, 149.0, 175.0), (175.0, 199.0, 219.0, None, None, 271.0)]
    rows = []
    for i in range(400):
        g = grids[i % 3]
        price = rnd.uniform(g[0], g[5] - 0.01) if g else rnd.choice([78.99, 1999.0, 500.0])
        if g and i % 7 == 0:
            price = g[rnd.choice([0, 1, 2])]
        cb = None if i % 31 == 30 else float(rnd.choice([0, 1, 5, 20, 60]))
        rows.append((i, cb, price + (cb or 0), rnd.uniform(0, 80), None if i % 17 == 0 else rnd.uniform(0, 40), rnd.choice([1.0, 1.18]), g))
    seg = "struct<" + ",".join(f"{n}:double" for n in P.POINTS) + ">"
    df = spark.createDataFrame(rows, f"i int, cb double, vip double, share double, floor double, tax double, g {seg}")
    out = df.withColumn("p", F.col("vip") - F.col("cb")).select("i", P.round_to_point("cb", "p", "floor", "tax", "g").alias("r"))
    got = dict(values(out, "i", "r"))
    for i, cb, vip, share, floor, tax, g in rows:
        assert got[i] == brute_round(cb, vip, share, floor, tax, g), (i, cb, vip, g)
        assert got[i] is None or got[i] >= 0


def test_clamp_keeps_the_floor(spark):
    df = spark.createDataFrame([(100.0, -3.0, 50.0), (100.0, 60.0, 50.0), (40.0, 5.0, 50.0), (100.0, 50.0, 50.0), (100.0, None, 50.0)],
                               "vip_selling_price double, cb double, f double")
    assert [r[0] for r in df.select(P.clamp_to_floor(F.col("cb"), F.col("f"))).collect()] == [0.0, 50.0, 0.0, 50.0, None]


def test_deal_without_price_puts_list_c_on_both(spark):
    df = spark.createDataFrame([("a", "v", 100.0, 1.0, 2.0, 0), ("b", "v", 100.0, 1.0, 2.0, 0), ("c", "v", 100.0, 1.0, 2.0, 0)],
                               "supc string, vendor_code string, selling_price double, list_b_cb double, list_c_cb double, is_pushed int")
    d = dt.date(2022, 1, 1)
    deals = spark.createDataFrame([("a", "v", 70.0, d, d), ("b", "v", None, d, d)],
                                  "supc string, vendor_code string, deal_op double, start_date date, end_date date")
    got = sorted(values(P.deal_stage(df, deals, d), "supc", "list_b_cb", "list_c_cb", "is_pushed"))
    assert got == [("a", 30.0, 30.0, 1), ("b", 2.0, 2.0, 1), ("c", 1.0, 2.0, 0)]


def test_conditional_distinct_ignores_missing_codes(spark):
    df = spark.createDataFrame([("k", "c1", 1), ("k", "c1", 9), ("k", None, 9)], "k string, c string, x int")
    out = A.conditional_distinct(df, ["k"], "c", {"big": F.col("x") > 5}, {"any_big": F.col("x") > 5}, total="n")
    assert values(out, "n", "big", "any_big") == [(1, 1, 1)]


def test_an_update_chooses_and_joins_its_source_in_one_partitioning(spark):
    target = spark.createDataFrame([("A", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("a", 5, 1), ("A", 7, 2), ("x", 9, 1)], "key string, w int, day int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.update_from(target, source, {"k": "key"}, {"v": F.col("src_w")}, casefold=True, newest_first=[F.desc("day")])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # one per side
        assert sorted(tuple(r) for r in out.collect()) == [("A", 7), ("b", 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookups_that_multiply_rows_come_after_those_by_item_and_vendor(spark):
    from marginloom.bindings.frames import AS_OF, Frames
    from marginloom.bindings.pricing import POLICY
    t = Frames(spark, "/root/testdata/sf0.001")
    keys = [k for k, _ in P.build_profiles(t, AS_OF, POLICY, t.vendors).by_key]
    at = keys.index
    for wide in (("supc",), ("supc", "vendor_code"), ("brand_id", "vendor_code"), ("product_sid", "vendor_sid")):
        assert at(wide) < min(at(("brand_id",)), at(("subcategory_id",)), at(("subcategory_id", "vendor_code")))
    # the last join deals the rows for the distinct, so its key is one of many values
    assert keys[-1] == ("subcategory_id", "vendor_code")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lookups_of_a_vendor_share_one_move_of_the_listings(spark):
    rows = lambda data, schema: spark.createDataFrame(data, schema)
    base = rows([("A", "V", "b", "c", "g", 1.0), ("B", "w", "b", "d", "h", 1.0)],
                "supc string, vendor_code string, brand_id string, subcategory_id string, pog_id string, seller_price double")
    by_key = [(("vendor_code",), [rows([("V", 1)], "vendor_code string, x int")]),
              (("brand_id", "vendor_code"), [rows([("b", "V", 2), ("b", "V", 3)], "brand_id string, vendor_code string, y int")]),
              (("subcategory_id", "vendor_code"), [rows([("c", "V", 4)], "subcategory_id string, vendor_code string, z int"),
                                                   rows([("d", "w", 5)], "subcategory_id string, vendor_code string, u int")])]
    p = P.Profiles(bids=rows([("v", 6)], "vendor_code string, bid int"), active=rows([("a", "v", 7)], "supc string, seller_code string, active_bid int"),
                   terms=rows([("b", "v", "t", "r", 1.0, 1.0)], "brand_id string, seller_code string, ro_type string, rule string, amount double, ratio double"),
                   pogs=rows([("g",)], "pog_id string"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, all_ = (P.attach_profiles(base, P.Profiles(k, p.bids, p.active, p.terms, pogs=p.pogs)) for k in (by_key[:1], by_key))
        assert _exchanges(all_) - _exchanges(few) == 2  # those of the tables themselves
        assert _exchanges(all_.distinct()) == _exchanges(all_)
        got = sorted(tuple(r) for r in all_.select("supc", "x", "y", "z", "u", "bid", "active_bid", "high_cb_pog").collect())
        assert got == [("A", 1, 2, 4, None, 6, 7, 1), ("A", 1, 3, 4, None, 6, 7, 1), ("B", None, None, None, 5, None, None, 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_prices_lie_where_the_override_leaves_them(spark):
    from marginloom.bindings.frames import AS_OF, Frames
    from marginloom.bindings.pricing import POLICY
    t = Frames(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.base_from(t, AS_OF, POLICY)._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sum("Exchange hashpartitioning(lower(supc" in x for x in plan) == 2  # listings and financials, each once
        assert not any(x.split("Exchange ")[1].startswith("hashpartitioning(supc") and "vendor_code" in x for x in plan if "Exchange " in x)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_flags_multiply_rows_last_and_gather_nothing_after_it(spark):
    rows = lambda data, schema: spark.createDataFrame(data, schema)
    from marginloom.bindings.frames import AS_OF, Frames
    from marginloom.bindings.pricing import POLICY
    t = Frames(spark, "/root/testdata/sf0.001")
    base = P.base_from(t, AS_OF, POLICY).limit(20).cache()
    p = P.build_profiles(t, AS_OF, POLICY, t.vendors.select("vendor_sid"))
    # several rules of a brand, of which two differ in nothing that a row shows once a third makes it an exception
    several = [(b["brand_id"], i, h) for b in base.select("brand_id").distinct().collect() for i, h in ((0, 0), (1, 0), (None, 0), (1, 1), (1, 1))]
    always = rows([(b["subcategory_id"], 1, 0) for b in base.select("subcategory_id").distinct().collect()], "subcategory_id string, sub_is int, sub_hard int")
    swap = {("brand_id",): [rows(several, "brand_id string, br_is int, br_hard int")],
            ("subcategory_id",): [always, *dict(p.by_key)[("subcategory_id",)][1:]]}
    p.by_key = [(k, swap.get(k, f)) for k, f in p.by_key]
    one, twice = P.exceptions_stage(base, p), P.exceptions_stage(base.unionByName(base), p)
    got = sorted(map(str, one.collect()))
    assert got and len(set(got)) == len(got) and sorted(map(str, twice.collect())) == got
    assert {r["brand_exception"] for r in one.collect()} == {0, 1} and {r["is_exception"] for r in one.collect()} == {1}
    shown = one.where("bad_seller = 0").groupBy("supc", "vendor_code", *[c for c in one.columns if c.startswith("variant") and c.endswith("_name")]).count()
    assert shown.agg({"count": "min"}).first()[0] >= 2
    # above the rows' multiplication no aggregate, sort or exchange of them is left
    plan = one._jdf.queryExecution().optimizedPlan().toString().split("array_distinct")[0]
    assert "Generate" in plan and "Distinct" not in plan.split("Generate")[0]
    assert not any(x.strip(" :+-").startswith("Aggregate") and "product_name" in x for x in plan.split("Generate")[0].splitlines())
    base.unpersist()


def test_an_update_dealt_by_one_key_gives_the_same_rows(spark):
    target = spark.createDataFrame([("A", "x", 1), ("a", "Y", 2), (None, "x", 3), ("b", None, 4)], "k string, m string, v int")
    source = spark.createDataFrame([("a", "x", 5, 1), ("A", "X", 7, 2), ("a", "y", 9, 1), ("b", None, 8, 1)], "key string, n string, w int, day int")
    run = lambda **more: J.update_from(target, source, {"k": "key", "m": "n"}, {"v": F.col("src_w")}, casefold=True, newest_first=[F.desc("day")], **more)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = run(deal="k")
        assert sorted(map(str, dealt.collect())) == sorted(map(str, run().collect()))
        lookup = spark.createDataFrame([("a", 1)], "f string, z int").repartition("f")
        met = run(deal="k").withColumn("f", F.lower("k")).join(lookup, "f", "left")
        assert _exchanges(met) == 3  # one per side and the lookup's own
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_listings_meet_products_and_prices_in_one_move(spark):
    """Products are dealt by the item that prices lie by, so the listing's rows don't move by product as well."""
    from marginloom.bindings.frames import AS_OF, Frames
    from marginloom.bindings.pricing import POLICY
    t = Frames(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.base_from(t, AS_OF, POLICY)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = [below for x, below in zip(plan, plan[1:]) if "Exchange hashpartitioning(" in x and "vip_selling_price" in below]
    by = [x for x, below in zip(plan, plan[1:]) if below in moved]
    assert len(by) == 1 and "hashpartitioning(lower(supc" in by[0]


def test_items_without_a_request_go_before_their_distinct(spark):
    asked = spark.sql("SELECT * FROM VALUES ('s1', 'b', 1, 5), ('S1', 'B', 0, 4), ('s2', NULL, 1, 5) AS t(vendor_code, brand_id, enabled, updated)")
    previous = spark.createDataFrame([("A", "S1", "b"), ("A", "S1", "b"), ("a", "s1", "B"), ("C", "S2", "b"), (None, "S1", "b"), ("D", None, "b")],
                                     "supc string, vendor_code string, brand_id string").distinct()
    direct = spark.createDataFrame([("Z", "S9", 1, 1)], "supc string, vendor_code string, cashback_enabled int, updated int")
    out = P.brand_mandates(direct, asked, previous)
    got = sorted(map(str, (tuple(r) for r in out.collect())))
    assert got == sorted(map(str, [("Z", "S9", 1), ("A", "S1", 1), ("A", "S1", 0), ("a", "S1", 1), ("a", "S1", 0), (None, "S1", 1), (None, "S1", 0)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Join LeftSemi")[0] and "Aggregate" not in plan.split("Join LeftSemi")[1]


def test_numbered_choices_equal_nested_products(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, array(1, 2), array('x', 'y', 'z'), array(true)), (2, array(3), NULL, array(false, true)),
                      (3, array(), array('x'), NULL), (4, array(NULL, 5), array('u'), array(true)) AS t(i, a, b, c)""")
    got = J.choose_each(df, ["a", "b", "c"])
    want = df.select("i", F.explode(J.products([F.col(c) for c in "abc"], lambda h: F.struct(h[0].alias("a"), h[1].alias("b"), h[2].alias("c")))).alias("r"))
    assert got.columns == ["i", "a", "b", "c"] and got.count() == 6 + 2 + 1 + 2
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select("i", "r.*").collect()))
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_amounts_of_several_bids_and_terms_come_once_each(spark):
    """Two spellings of a bid and of a brand's terms: as many rows as different amounts, with and without the mark of an exception."""
    from marginloom.bindings.frames import AS_OF, Frames
    from marginloom.bindings.pricing import POLICY
    t = Frames(spark, "/root/testdata/sf0.001")
    base = P.base_from(t, AS_OF, POLICY).limit(5).cache()
    p = P.build_profiles(t, AS_OF, POLICY, t.vendors.select("vendor_sid"))
    pairs = base.select("supc", F.col("vendor_code").alias("seller_code"), "brand_id").distinct()
    p.active = pairs.select("supc", "seller_code", F.explode(F.array(*[F.lit(x) for x in (1e6, 2e6, -0.0, 0.0)])).alias("active_bid"))
    p.terms = pairs.select("brand_id", "seller_code", F.lit("GSV").alias("ro_type"), F.lit("DEL").alias("rule"),
                           F.explode(F.array(F.lit(1.0), F.lit(2.0), F.lit(None).cast("double"))).alias("amount"), F.lit(0.5).alias("ratio"))
    factors = [(b["subcategory_id"], 0.1, 0.1) for b in base.select("subcategory_id").distinct().collect()]
    clear = lambda f: f.limit(0)
    sub = dict(p.by_key)[("subcategory_id",)]
    brands = [(b["brand_id"], i, 0) for b in base.select("brand_id").distinct().collect() for i in (0, 1)]
    swap = {("subcategory_id",): [clear(sub[0]), spark.createDataFrame(factors, "subcategory_id string, rto_factor double, rpr_factor double"), clear(sub[2])],
            ("brand_id",): [spark.createDataFrame(brands, "brand_id string, br_is int, br_hard int")]}
    p.by_key = [(k, swap.get(k, [clear(x) for x in f])) for k, f in p.by_key]
    rows = P.exceptions_stage(base, P.Profiles(p.by_key, p.bids, p.active, p.terms, clear(p.bands), clear(p.bands_old), p.pogs)).collect()
    priced = base.where("seller_price > 0").distinct().count()
    assert priced and len(rows) == priced * 3 * 3 * 2  # bids of 0 are one; the mark is there with and without
    assert len({str(r) for r in rows}) == len(rows)
    base.unpersist()


def test_a_match_reads_its_rows_once_and_deals_find_them_in_place(spark):
    d = dt.date(2020, 1, 1)
    rows = spark.range(7).selectExpr("concat('X', id) as supc", "concat('v', id div 9) as vendor_code", "id as product_sid", "900D as selling_price", "300D as seller_price", "1D as slab",
                                     "10D as step7_list_b", "5D as list_b_cb", "6D as list_c_cb", "0 as is_hard_exception", "0 as is_pushed", "'g' as pog_id",
                                     "1 as is_enabled_with_inv", "'n' as variant1_name")
    rivals = spark.createDataFrame([("x1", "V0", 870.0, 880.0)], "supc string, vendor_code string, rival_a_price double, rival_b_price double")
    visits = spark.createDataFrame([], "pog_id string, visit_date date")
    deals = spark.createDataFrame([("X2", "v0", 70.0, d, d), ("x3", "v0", 70.0, d, d)], "supc string, vendor_code string, deal_op double, start_date date, end_date date")
    pushed = P.push_stage(rows, rivals, visits, d, P.Policy())
    assert pushed._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 7") == 1
    got = sorted(values(P.deal_stage(pushed, deals, d), "product_sid", "list_b_cb", "is_pushed"))
    assert got == [(0, 5.0, 0), (1, 30.0, 1), (2, 830.0, 1), *[(i, 5.0, 0) for i in range(3, 7)]]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lies = P.match_stage(rows, rivals)
        assert _exchanges(P.deal_stage(lies, deals, d)) == _exchanges(lies) + 1  # that of the deals
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
