"""Queries over encoders, bins, evaluation reports, the three score plans and their models."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.bindings.frames import AS_OF, EVENTS_AS_OF, Frames, ddb
from marginloom.bindings.registry import query
from marginloom.functions import scalars as S
from marginloom.operators import binning as B
from marginloom.operators import encoders as EN
from marginloom.operators import evaluation as E
from marginloom.operators import models as M
from marginloom.operators.aggregates import running_share
from marginloom.plans import delivery as D
from marginloom.plans import propensity as P
from marginloom.plans import return_risk as R
from marginloom.session import shared_dir

TRAIN_END = dt.date(1998, 6, 30)
VALID_END = dt.date(1999, 6, 30)


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


# ---- encoders ---------------------------------------------------------------------------------------


def woe_sql(frame: str, cat: str, signed: bool) -> str:
    w = "100 * ln(((n - e + 0.5) / (tn - te)) / ((e + 0.5) / te)) * ((n - e) / (tn - te) - e / te)"
    w = f"case when e / n < te / tn then -({w}) else {w} end" if signed else w
    return f"""select {cat} as category, round({w}, 6) + 0.0 as woe
        from (select {cat}, cast(sum(rto) as double) as e, cast(count(*) as double) as n from {frame} group by {cat}) g,
             (select cast(sum(rto) as double) as te, cast(count(*) as double) as tn from {frame}) t
        where {cat} is not null"""


@query(ddb(woe_sql("returns", "courier_group", True)))
def woe_signed(f: Frames):
    return rounded(EN.fit_woe(f.returns, "courier_group", "rto"), "woe")


@query(ddb(woe_sql("returns", "subcategory_id", False)))
def woe_unsigned(f: Frames):
    return rounded(EN.fit_woe(f.returns, "subcategory_id", "rto", signed=False), "woe")


@query(ddb("""select r.code, r.l_partkey, d.woe as pincode_woe from returns r
   left join dict d on d.category = r.dest_pincode where r.order_date > date '1998-06-30'""",
           train="select * from returns where order_date <= date '1998-06-30'",
           dict=woe_sql("train", "dest_pincode", True)))
def woe_apply(f: Frames):
    train = f.returns.where(F.col("order_date") <= F.lit(TRAIN_END))
    d = rounded(EN.fit_woe(train, "dest_pincode", "rto"), "woe")
    test = f.returns.where(F.col("order_date") > F.lit(TRAIN_END)).select("code", "l_partkey", "dest_pincode")
    return EN.apply_woe(test, d, "dest_pincode", out="pincode_woe").select("code", "l_partkey", "pincode_woe")


@query(ddb("""select r.code, r.l_partkey, case when v.k is not null then r.pin else 'other' end as pin
   from (select code, l_partkey, order_date, coalesce(dest_pincode, 'nan') as pin from returns) r
   left join (select coalesce(dest_pincode, 'nan') as k from returns where order_date <= date '1998-06-30'
              group by 1 having count(*) >= 16) v on v.k = r.pin"""))
def club_rare(f: Frames):
    data = f.returns.select("code", "l_partkey", "order_date", S.as_category("dest_pincode").alias("pin"))
    vocab = EN.fit_vocab(data.where(F.col("order_date") <= F.lit(TRAIN_END)), "pin", 16)
    return EN.apply_vocab(data, vocab, "pin").select("code", "l_partkey", "pin")


@query(ddb("""select l_orderkey, l_linenumber, case when v.k is not null then d.dc else 'dc_others' end as dc
   from (select l_orderkey, l_linenumber, 'dc_' || dc as dc from deliveries) d
   left join (select 'dc_' || dc as k from deliveries group by 1 having count(*) > 1200) v on v.k = d.dc"""))
def vocab_threshold(f: Frames):
    d = D.prefixed(f.deliveries.select("l_orderkey", "l_linenumber", "dc"), ["dc"])
    return EN.apply_vocab(d, EN.fit_vocab(d, "dc", 1200, strict=True), "dc", other="dc_others") \
        .select("l_orderkey", "l_linenumber", "dc")


OHE = ["air", "local", "rail", "road", "sea"]


@query(ddb(f"""select code, l_partkey, {', '.join(f"cast(coalesce(cg = '{v}', false) as int) as cg_{v}" for v in OHE)}
   from (select code, l_partkey, case when l_partkey % 29 = 0 then 'unseen' else courier_group end as cg from returns) r"""))
def one_hot_fixed(f: Frames):
    vocab = EN.fit_vocab(f.returns, "courier_group", 1)
    test = f.returns.select("code", "l_partkey", F.when(F.col("l_partkey") % 29 == 0, "unseen")
                            .otherwise(F.col("courier_group")).alias("courier_group"))
    return EN.one_hot(test, "courier_group", vocab, prefix="cg_").drop("courier_group")


@query(ddb("""select code, l_partkey, round((user_del - m1) / s1, 6) + 0.0 as user_del,
    round((pin_att_14 - m2) / s2, 6) + 0.0 as pin_att_14, const - m3 as const from (select *, 7e0 as const from returns) r,
   (select avg(user_del) as m1, stddev_pop(user_del) as s1, avg(pin_att_14) as m2, stddev_pop(pin_att_14) as s2,
     avg(7e0) as m3 from returns where order_date <= date '1998-06-30') s"""))
def standard_scale(f: Frames):
    data = f.returns.select("code", "l_partkey", "order_date", "user_del", "pin_att_14", F.lit(7.0).alias("const"))
    cols = ["user_del", "pin_att_14", "const"]
    scaler = EN.fit_scaler(data.where(F.col("order_date") <= F.lit(TRAIN_END)), cols)
    return rounded(EN.apply_scaler(data, scaler, cols), *cols).drop("order_date")


@query(ddb("""select l_orderkey, l_linenumber, round((a - m) / sqrt(v), 5) + 0.0 as a, round((b - m) / sqrt(v), 5) + 0.0 as b
   from (select l_orderkey, l_linenumber, oc_o2a_7 as a, raw_prediction as b from deliveries) d,
   (select avg(x) as m, var_pop(x) as v from (select oc_o2a_7 as x from deliveries union all
                                              select raw_prediction from deliveries) u) s"""))
def global_normalize(f: Frames):
    d = f.deliveries.select("l_orderkey", "l_linenumber", F.col("oc_o2a_7").alias("a"), F.col("raw_prediction").alias("b"))
    return rounded(EN.apply_global_norm(d, EN.fit_global_norm(d, ["a", "b"]), ["a", "b"]), "a", "b", digits=5)


@query(ddb("""select split, count(*) as n, cast(sum(l_partkey) as bigint) as key_sum from (select l_partkey, case when b < 80 then 'train' when b < 90
     then 'valid' else 'test' end as split from (select l_partkey,
       cast('0x' || substr(md5(cast(l_orderkey as varchar) || ':42'), 1, 8) as bigint) % 100 as b from lineitem) x) y
   group by split"""))
def hash_split(f: Frames):
    out = EN.hash_split(f.lineitem.select("l_orderkey", "l_partkey"), "l_orderkey", {"train": 80, "valid": 10, "test": 10})
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("key_sum"))


@query(ddb("""select split, count(*) as n, cast(sum(rto) as bigint) as rto from (select rto, case
   when order_date between date '1997-01-01' and date '1998-06-30' then 'train'
   when order_date between date '1998-07-01' and date '1999-06-30' then 'valid'
   when order_date > date '1999-06-30' then 'test' end as split from returns) s group by split"""))
def time_split(f: Frames):
    out = EN.time_split(f.returns, "order_date", (dt.date(1997, 1, 1), TRAIN_END), (dt.date(1998, 7, 1), VALID_END))
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("rto").alias("rto"))


@query(ddb("""select rto, n, round(sum(n) over () / (2.0 * n), 6) as weight
              from (select rto, count(*) as n from returns group by rto) g"""))
def class_weights(f: Frames):
    return rounded(EN.class_weights(f.returns, "rto"), "weight")


# ---- return risk ------------------------------------------------------------------------------------

RATES = {"pin_fasr_14": ("pin_del_14", "pin_att_14"), "city_fasr_14": ("city_del_14", "city_att_14")}
DUPLICATES = {"same_supc": "same_supc_dup", "same_subcat": "same_subcat_dup"}
RISK_SQL = """select code, l_partkey, rto, order_date, score, courier_group, dest_pincode,
   nullif(user_del_ship, 0) as user_del_ship, case when nullif(user_del_ship, 0) is not null then user_del end as user_del,
   user_del * 100 / nullif(user_del_ship, 0) as del_per, pin_del_14 * 100 / nullif(pin_att_14, 0) as pin_fasr_14,
   city_del_14 * 100 / nullif(city_att_14, 0) as city_fasr_14,
   cast(coalesce(same_supc_dup, 0) > 0 as int) as same_supc, cast(coalesce(same_subcat_dup, 0) > 0 as int) as same_subcat
   from returns where subcategory_id is not null"""


def risk_features(f: Frames):
    return R.features(f.returns, RATES, DUPLICATES, required=["subcategory_id"])


@query(ddb("""select code, l_partkey, round(del_per, 6) as del_per, round(pin_fasr_14, 6) as pin_fasr_14,
   round(city_fasr_14, 6) as city_fasr_14, user_del from risk""", risk=RISK_SQL))
def delivery_rate_features(f: Frames):
    return rounded(risk_features(f), "del_per", "pin_fasr_14", "city_fasr_14") \
        .select("code", "l_partkey", "del_per", "pin_fasr_14", "city_fasr_14", "user_del")


@query(ddb("""select code, l_partkey, case when user_del_ship is not null then
     case when user_del_ship > 3 and del_per < 20 then 1 else 0 end end as three_80,
   case when user_del_ship is not null then case when user_del_ship > 5 and del_per < 30 then 1 else 0 end end as five_70
   from risk""", risk=RISK_SQL))
def risk_flags(f: Frames):
    return risk_features(f).select("code", "l_partkey", "three_80", "five_70")


@query(ddb("select code, l_partkey, same_supc, same_subcat from risk", risk=RISK_SQL))
def duplicate_flags(f: Frames):
    return risk_features(f).select("code", "l_partkey", "same_supc", "same_subcat")


@query(ddb("""select suborder_code, date_diff('day', created, verified) as promise from suborders"""))
def promise_days(f: Frames):
    return f.suborders.select("suborder_code", R.promise_days("verified", "created").cast("bigint").alias("promise"))


@query(ddb("""select t.code, t.l_partkey, coalesce(d.woe, -99999) as courier_group, coalesce(t.del_per, -99999) as del_per
   from (select code, l_partkey, case when coalesce(courier_group, 'nan') in (select cg from clubbed where cg <> 'other')
         then coalesce(courier_group, 'nan') else 'other' end as cg, round(del_per, 6) as del_per from risk
         where order_date > date '1998-06-30') t left join dict d on d.category = t.cg""",
           risk=RISK_SQL,
           train="select *, coalesce(courier_group, 'nan') as c from risk where order_date <= date '1998-06-30'",
           clubbed="""select rto, case when c in (select c from train group by c having count(*) >= 100) then c
                      else 'other' end as cg from train""",
           dict=woe_sql("clubbed", "cg", True)))
def risk_encoded(f: Frames):
    data = rounded(risk_features(f), "del_per")
    train = data.where(F.col("order_date") <= F.lit(TRAIN_END))
    test = data.where(F.col("order_date") > F.lit(TRAIN_END))
    out = R.encode(train, [test], ["courier_group"], "rto")[1]
    return out.select("code", "l_partkey", (F.round("courier_group", 6) + F.lit(0.0)).alias("courier_group"), "del_per")


# ---- propensity --------------------------------------------------------------------------------------

WINDOW = (EVENTS_AS_OF, EVENTS_AS_OF + dt.timedelta(days=2))
WIN_SQL = "between date '2024-01-20' and date '2024-01-22'"


@query(ddb("""select device_id, date_diff('day', install_date, date '2024-01-20') as days_since_install,
   date_diff('day', visit_date, date '2024-01-20') as days_since_last_visit,
   date_diff('day', last_order_date, date '2024-01-20') as days_since_last_order from devices"""))
def recency_features(f: Frames):
    out = P.recency(f.devices, EVENTS_AS_OF, {"days_since_install": "install_date", "days_since_last_visit": "visit_date",
                                              "days_since_last_order": "last_order_date"})
    return out.select("device_id", *[F.col(c).cast("bigint").alias(c) for c in
                                     ("days_since_install", "days_since_last_visit", "days_since_last_order")])


@query(ddb(f"""select device_id, cast(coalesce(next_order_date {WIN_SQL}, false) as int) as target from devices"""))
def label_binary_window(f: Frames):
    return f.devices.select("device_id", P.label_window("next_order_date", *WINDOW).alias("target"))


@query(ddb(f"""select device_id, target from (select device_id, case when next_order_date {WIN_SQL} then 1
   when next_order_date is null then 0 else 2 end as target from devices) d where target <> 2"""))
def label_drop_ambiguous(f: Frames):
    return P.drop_ambiguous(f.devices, "next_order_date", *WINDOW).select("device_id", "target")


@query(ddb("""select device_id, last_order_date from devices where date_diff('day', visit_date, date '2024-01-20') <= 15
   and (last_order_date > date '2024-01-10' or last_order_date is null)
   and install_date between date '2023-11-01' and date '2023-12-31'"""))
def cohort_filter(f: Frames):
    d = P.recency(f.devices, EVENTS_AS_OF, {"visit_days": "visit_date"})
    d = P.open_cohort(d, "visit_days", "last_order_date", dt.date(2024, 1, 10))
    return P.month_cohort(d, "install_date", dt.date(2023, 11, 1), dt.date(2023, 12, 31)).select("device_id", "last_order_date")


@query(ddb(f"""select cast(sum(cast(coalesce(install_date > last_order_date, false) as int)) as bigint) as order_before_install,
   cast(sum(cast(coalesce(next_order_date {WIN_SQL}, false) and last_order_date is null as int)) as bigint)
     as target_without_order from devices"""))
def sanity_checks(f: Frames):
    d = f.devices.withColumn("target", P.label_window("next_order_date", *WINDOW))
    return P.sanity_checks(d, "install_date", "last_order_date", "target")


@query(ddb("""select device_id, coalesce(days_since_search, 10000) as days_since_search, coalesce(search_events, 0) as search_events,
   cast(days_since_search is null as int) as days_since_search_null, cast(search_events is null as int) as search_events_null,
   coalesce(install_channel, 'Other') as install_channel, 0 as install_channel_null from devices"""))
def propensity_impute(f: Frames):
    d = f.devices.select("device_id", "days_since_search", "search_events", "install_channel")
    out = P.impute(d, ["days_since_search"], ["search_events"], text={"install_channel": "Other"})
    return out


# ---- binning -------------------------------------------------------------------------------------------

TENTHS, TWENTIETHS = B.step_edges(0.1, 10), B.step_edges(0.05, 20)


def _lit(x: float) -> str:
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def bin_sql(x: str, edges) -> str:
    ladder = " ".join(f"when {x} <= {_lit(e)} then {i}" for i, e in enumerate(edges) if i)
    return f"case when {x} <= {_lit(edges[0])} then null {ladder} end"


@query(ddb(f"select code, l_partkey, score, {bin_sql('score', TENTHS)} as bin from returns"))
def fixed_bins(f: Frames):
    return f.returns.select("code", "l_partkey", "score", B.fixed_bin(F.col("score"), TENTHS).alias("bin"))


@query(ddb("""select o2a_bin, n, round(n * 100.0 / sum(n) over (), 6) as share_pct,
   round(sum(n) over (order by o2a_bin) * 100.0 / sum(n) over (), 6) as cum_share_pct from (
   select cast(case when raw <= mn then 1 else ceil((raw - mn) / ((mx - mn) / 20)) end as int) as o2a_bin, count(*) as n
   from (select raw_prediction as raw from deliveries) d,
        (select min(raw_prediction) as mn, max(raw_prediction) as mx from deliveries) e group by 1) b"""))
def equal_width_bins(f: Frames):
    binned = B.equal_width_bin(f.deliveries.select("raw_prediction"), "raw_prediction", 20, out="o2a_bin")
    n = binned.groupBy("o2a_bin").agg(F.count(F.lit(1)).alias("n"))
    return rounded(running_share(n, "o2a_bin", "n"), "share_pct", "cum_share_pct")


def quantile_cte(frame: str, col: str, q: int) -> dict:
    return {"edge_list": f"select unnest(quantile_cont({col}, [{', '.join(str(i / q) for i in range(q + 1))}])) as e from {frame}",
            "edges": "select e, row_number() over (order by e) - 1 as i from (select distinct e from edge_list) d",
            "bins": "select a.i as bin, b.e as lo, a.e as hi from edges a join edges b on b.i = a.i - 1"}


@query(ddb("""select b.bin, round(b.lo, 6) as bin_lo, round(b.hi, 6) as bin_hi, count(*) as n from bins b
   join (select user_id, paid_amount as x from devices) d on (d.x > b.lo or (b.bin = 1 and d.x >= b.lo)) and d.x <= b.hi
   group by 1, 2, 3""", **quantile_cte("devices", "paid_amount", 10)))
def quantile_bins(f: Frames):
    out = B.quantile_bin(f.devices.select("user_id", "paid_amount"), "paid_amount", 10)
    return rounded(out, "bin_lo", "bin_hi").groupBy("bin", "bin_lo", "bin_hi").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("bin", F.col("bin").cast("bigint"))


@query(ddb("""select b.bin, round(b.lo, 6) as bin_lo, round(b.hi, 6) as bin_hi, count(score) as n,
   round_even(avg(score) * 100, 0) / 100 as score_mean, round(avg(rto), 6) as actual_mean,
   round_even(cast(count(score) * 100 as double) / sum(count(score)) over () * 100, 0) / 100 as salience_pct
   from (select code, score, rto, nullif(l_orderkey % 90, 0) as x from returns) d left join bins b on
     (d.x > b.lo or (b.bin = 1 and d.x >= b.lo)) and d.x <= b.hi group by 1, 2, 3""",
           src="select nullif(l_orderkey % 90, 0) as x from returns", **quantile_cte("src", "x", 50)))
def bin_report(f: Frames):
    d = f.returns.select("code", "score", "rto", F.nullif(F.col("l_orderkey") % 90, F.lit(0)).alias("x"))
    out = B.bin_report(d, "x", "score", "rto", method="qcut", q=50)
    return rounded(out, "bin_lo", "bin_hi", "actual_mean").withColumn("bin", F.col("bin").cast("bigint"))


@query(ddb("""select bin, round(case when bin = 1 then lo - (hi - lo) * 0.001e0 else lo + (bin - 1) * (hi - lo) / 10 end, 6) as bin_lo,
   round(lo + bin * (hi - lo) / 10, 6) as bin_hi, count(score) as n, round_even(avg(score) * 100, 0) / 100 as score_mean, round(avg(rto), 6) as actual_mean,
   round_even(cast(count(score) * 100 as double) / sum(count(score)) over () * 100, 0) / 100 as salience_pct
   from (select r.*, e.*, case when x = lo then 1 else cast(ceil((x - lo) * 10 / (hi - lo)) as bigint) end as bin
         from (select score, rto, cast(l_orderkey % 93 as double) as x from returns) r,
              (select min(l_orderkey % 93)::double as lo, max(l_orderkey % 93)::double as hi from returns) e) b group by 1, 2, 3"""))
def bin_report_cut(f: Frames):
    d = f.returns.select("score", "rto", (F.col("l_orderkey") % 93).alias("x"))
    out = B.bin_report(d, "x", "score", "rto", method="cut", q=10)
    return rounded(out, "bin_lo", "bin_hi", "actual_mean").withColumn("bin", F.col("bin").cast("bigint"))


@query(ddb("""select code, l_partkey, rto from returns where rto is distinct from 0
   or cast('0x' || substr(md5(cast(code as varchar) || ':42'), 1, 8) as bigint) % 100 < 30"""))
def undersample(f: Frames):
    return EN.undersample(f.returns.select("code", "l_partkey", "rto"), "rto", {0: 30}, "code")


# ---- evaluation ----------------------------------------------------------------------------------------


def decile_sql(edges, scale: int) -> str:
    values = ", ".join(f"({i}, {_lit(edges[i - 1])}, {_lit(edges[i])})" for i in range(1, len(edges)))
    return f"""select b.bin, b.bin_lo, b.bin_hi, coalesce(g.n, 0) as n, coalesce(g.p, 0) as positives,
       round(g.p * {scale} / g.n, 6) as rate, round(coalesce(g.n, 0) * {scale} / (select count(*) from returns), 6) as salience
       from (values {values}) b(bin, bin_lo, bin_hi) left join (select {bin_sql('score', edges)} as bin, count(*) as n,
         cast(sum(hit) as bigint) as p from (select score, cast(l_orderkey % 7 < score * 8 as int) as hit from returns) r
         group by 1) g on g.bin = b.bin"""


def scored(f: Frames):
    hit = (F.col("l_orderkey") % 7 < F.col("score") * 8).cast("int")
    return f.returns.select("code", "score", hit.alias("hit"))


@query(ddb(decile_sql(TENTHS, 1)))
def decile_report(f: Frames):
    return rounded(E.decile_report(scored(f), "score", "hit", TENTHS), "rate", "salience")


@query(ddb(decile_sql(TWENTIETHS, 100)))
def decile_report_pct(f: Frames):
    return rounded(E.decile_report(scored(f), "score", "hit", TWENTIETHS, scale=100.0), "rate", "salience")


@query(ddb("""select cast(t as double) as threshold, round(coalesce(sum(salience) filter (rate > t), 0) * 100, 4) as salience_pct,
   round(sum(positives) filter (rate > t) * 100 / sum(n) filter (rate > t), 4) as event_pct
   from dec, (values (0.6), (0.7)) x(t) group by t""", dec=decile_sql(TENTHS, 1)))
def high_risk_salience(f: Frames):
    dec = rounded(E.decile_report(scored(f), "score", "hit", TENTHS), "rate", "salience")
    return rounded(E.high_risk_salience(dec, [0.6, 0.7]), "salience_pct", "event_pct", digits=4)


HITS = "select score, cast(l_orderkey % 7 < score * 8 as int) as hit from returns"


@query(ddb("select hit as actual, cast(score > 0.7e0 as int) as predicted, count(*) as n from hits group by 1, 2", hits=HITS))
def confusion_matrix(f: Frames):
    return E.confusion_matrix(scored(f), "hit", "score", 0.7)


@query(ddb("""select label, round(p, 6) as precision, round(r, 6) as recall, round(f1, 6) as f1, s as support from (
   select '0' as label, p0 as p, r0 as r, 2 * p0 * r0 / (p0 + r0) as f1, n0 as s from c
   union all select '1', p1, r1, 2 * p1 * r1 / (p1 + r1), n1 from c
   union all select 'accuracy', acc, acc, acc, n0 + n1 from c
   union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (2 * p0 * r0 / (p0 + r0) + 2 * p1 * r1 / (p1 + r1)) / 2, n0 + n1 from c
   union all select 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1),
     (2 * p0 * r0 / (p0 + r0) * n0 + 2 * p1 * r1 / (p1 + r1) * n1) / (n0 + n1), n0 + n1 from c) u""", hits=HITS,
           c="""select tn / (tn + fn) as p0, tn / (tn + fp) as r0, tp / (tp + fp) as p1, tp / (tp + fn) as r1,
                (tn + tp) / (tn + tp + fn + fp) as acc, tn + fp as n0, tp + fn as n1 from (
                select count(*) filter (hit = 0 and score <= 0.5) as tn, count(*) filter (hit = 0 and score > 0.5) as fp,
                count(*) filter (hit = 1 and score <= 0.5) as fn, count(*) filter (hit = 1 and score > 0.5) as tp from hits) m"""))
def classification_report(f: Frames):
    return rounded(E.classification_report(scored(f), "hit", "score", 0.5), "precision", "recall", "f1")


ROC_CTE = {"hits": HITS, "by_score": "select score, sum(hit) as p, count(*) as n from hits group by score",
           "roc": """select score, p, n, sum(p) over w as cp, sum(n) over w as cn, sum(p) over () as tp, sum(n) over () as tn
                     from by_score window w as (order by score desc)"""}


@query(ddb("""select score as threshold, round(cp / tp, 6) as tpr, round((cn - cp) / (tn - tp), 6) as fpr from roc""", **ROC_CTE))
def roc_curve(f: Frames):
    return rounded(E.roc_curve(scored(f), "hit", "score"), "tpr", "fpr")


@query(ddb("""select round(sum((n - p) * (cp - p / 2)) / max(tp * (tn - tp)), 6) as auc from roc""", **ROC_CTE))
def roc_auc(f: Frames):
    return rounded(E.roc_auc(scored(f), "hit", "score"), "auc")


@query(ddb("""select round(avg(cast((score > 0.5) = (hit = 1) as int)), 6) as accuracy,
   round(avg(-ln(case when hit = 1 then greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16)
        else 1 - greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16) end)), 5) as log_loss from hits""", hits=HITS))
def log_loss(f: Frames):
    return rounded(rounded(E.log_loss_accuracy(scored(f), "hit", "score"), "log_loss", digits=5), "accuracy")


@query(ddb("select round(avg(abs(o2a - raw_prediction) / greatest(abs(o2a), 2.220446049250313e-16)), 6) as mape from deliveries"))
def mape(f: Frames):
    return rounded(E.mape(f.deliveries, "o2a", "raw_prediction"), "mape")


@query(ddb("""select round(avg((o2a - raw_prediction) * (o2a - raw_prediction))
              * avg(case when o2a > raw_prediction then 20 else 1 end), 4) as loss from deliveries"""))
def asymmetric_loss(f: Frames):
    return rounded(E.asymmetric_loss(f.deliveries, "o2a", "raw_prediction"), "loss", digits=4)


PROMISED = {
    "windowed": """select *, case when u >= 4 then u - 2 else 1 end as pdd1, greatest(u, 3) as pdd2 from (
        select *, cast(order_created_time as date) as order_created_date, cast(extract(hour from order_created_time) // 6 + 1 as int)
               as day_quarter, cast(round_even(raw_prediction, 0) as int) + 1 as u from deliveries) d""",
    "promised": """select *, order_created_date + cast(pdd1 as int) as promise_date, order_created_date + o2a as delivered_date,
        case when o2a < pdd1 then 'negative' when o2a > pdd2 then 'positive' else 'ontime' end as breach from windowed"""}
SHARES_SQL = """round(count(*) filter (breach = 'ontime') * 100.0 / count(*), 6) as ontime,
   round(count(*) filter (breach = 'positive') * 100.0 / count(*), 6) as positive_breach,
   round(count(*) filter (breach = 'negative') * 100.0 / count(*), 6) as negative_breach"""
SHARES = ("ontime", "positive_breach", "negative_breach")


def promised(f: Frames):
    return D.promised(D.calendar(f.deliveries), "raw_prediction")


@query(ddb("""select l_orderkey, l_linenumber, cast(pdd1 as int) as pdd1, cast(pdd2 as int) as pdd2, breach, promise_date, delivered_date
              from promised""", **PROMISED))
def promise_window(f: Frames):
    return promised(f).select("l_orderkey", "l_linenumber", "pdd1", "pdd2", "breach", "promise_date", "delivered_date")


DATE_KINDS = ("order_created_date", "promise_date", "delivered_date")


@query(ddb(" union all ".join(f"""select '{k}' as kind, {k} as day, {SHARES_SQL}, round(avg(pdd1), 6) as avg_pdd1,
   round(avg(pdd2), 6) as avg_pdd2, dayname({k}) as day_of_week from promised group by {k}""" for k in DATE_KINDS), **PROMISED))
def breach_by_date(f: Frames):
    return rounded(D.breach_by_dates(promised(f), DATE_KINDS), *SHARES, "avg_pdd1", "avg_pdd2")


DIMS = ("os", "ds", "oc", "dc", "courier_group", "day_quarter")
BY_DIM_SQL = " union all ".join(f"""select '{d}' as dimension, cast({d} as varchar) as value, {SHARES_SQL} from promised
   where {d} is not null group by {d}""" for d in DIMS)


@query(ddb(BY_DIM_SQL, **PROMISED))
def breach_by_dimension(f: Frames):
    return rounded(E.breach_by_dimensions(promised(f), DIMS), *SHARES)


@query(ddb(f"""select dimension, value, positive_breach from ({BY_DIM_SQL}) b where positive_breach > 10
   order by positive_breach desc""", **PROMISED))
def breach_hotspots(f: Frames):
    report = rounded(E.breach_by_dimensions(promised(f), DIMS), *SHARES)
    return E.breach_hotspots(report).select("dimension", "value", "positive_breach")


@query(ddb(f"select oc, dc, courier_group, {SHARES_SQL} from promised group by oc, dc, courier_group", **PROMISED))
def breach_by_lane(f: Frames):
    return rounded(E.breach_by(promised(f), ["oc", "dc", "courier_group"], promise_means=False), *SHARES)


@query(ddb("""select os, ds, order_created_date, day_quarter, round(quantile_cont(o2a, 0.9), 6) as p90 from promised
   where o2a between 1 and 15 group by os, ds, order_created_date, day_quarter""", **PROMISED))
def pdd_target(f: Frames):
    d = D.trim_days(D.calendar(f.deliveries))
    return rounded(D.p90_target(d, ["os", "ds", "order_created_date", "day_quarter"]), "p90")


# ---- models: SQL checks the scored rows, the range of the scores and the class made from them -----------------------------------------------------------------------------

RISK_VARS = ["del_per", "pin_fasr_14", "city_fasr_14", "user_del", "user_del_ship", "same_supc", "same_subcat",
             "three_80", "five_70", "courier_group"]


def _risk_model(f: Frames):
    data = risk_features(f).select("code", "rto", "order_date", *RISK_VARS)
    parts = [data.where(F.col("order_date") <= F.lit(TRAIN_END)),
             data.where((F.col("order_date") > F.lit(TRAIN_END)) & (F.col("order_date") <= F.lit(VALID_END))),
             data.where(F.col("order_date") > F.lit(VALID_END))]
    train, valid, test = R.encode(parts[0], parts[1:], ["courier_group"], "rto")
    return M.fit_risk_trees(train, RISK_VARS, "rto", valid), test


def _checked(scored: DataFrame, *keys: str) -> DataFrame:
    sound = F.col("score").between(0.0, 1.0) & (F.col("predicted_class") == (F.col("score") > 0.5).cast("int"))
    return scored.select(*keys, sound.alias("sound"))


@query(ddb(f"select code, rto, true as sound from returns where order_date > date '{VALID_END}' and subcategory_id is not null"))
def rto_score(f: Frames):
    """The saved model scores the later rows."""
    model, test = _risk_model(f)
    path = f"{shared_dir(f.spark).rstrip('/')}/risk-model-{uuid.uuid4().hex}"
    M.save_model(model, path)
    return _checked(M.score_probability(M.load_model(path), test), "code", "rto")


@query(f"select unnest({RISK_VARS}) as feature, true as in_range, 1.0::double as total")
def rto_importance(f: Frames):
    model, _ = _risk_model(f)
    table = M.importance_table(f.spark, model, RISK_VARS)
    total = table.agg(F.round(F.sum("importance"), 6)).scalar()
    return table.select("feature", F.col("importance").between(0.0, 1.0).alias("in_range"), total.alias("total"))


PROP_VARS = ["search_events", "visits", "days_since_search", "paid_amount", "days_since_install", "days_since_last_visit"]


@query(ddb("""select device_id, cast(next_order_date is not null as int) as has_order, true as sound from devices"""))
def propensity_score(f: Frames):
    d = f.devices.withColumn("target", P.label_window("next_order_date", *WINDOW))
    d = P.recency(d, EVENTS_AS_OF, {"days_since_install": "install_date", "days_since_last_visit": "visit_date"})
    d = P.impute(d, ["days_since_search", "days_since_last_visit"], ["search_events"])
    d = EN.hash_split(d, "device_id", {"train": 80, "valid": 10, "test": 10})
    train = d.where("split = 'train'")
    scaler = EN.fit_scaler(train, PROP_VARS)
    woe = EN.fit_woe(train, "install_channel", "target")
    ready = EN.apply_woe(EN.apply_scaler(d, scaler, PROP_VARS), woe, "install_channel", default=0.0)
    model = M.fit_propensity(ready.where("split = 'train'"), [*PROP_VARS, "install_channel"], "target")
    scored = M.score_probability(model, ready).withColumn("has_order", F.col("next_order_date").isNotNull().cast("int"))
    return _checked(scored, "device_id", "has_order")


@query(ddb(f"select l_orderkey, l_linenumber, true as window_sound from deliveries where cast(order_created_time as date) >= date '{AS_OF}'"))
def pdd_score(f: Frames):
    """Calendar, vocabulary and one-hot features on one scale; rows weigh as many deliveries as they stand for."""
    numbers = ["dc_o2a_7", "oc_o2a_7", "day_quarter"]
    d = D.calendar(f.deliveries).fillna(0.0, ["dc_o2a_7", "oc_o2a_7"]).withColumn("courier_group", F.coalesce("courier_group", F.lit("none")))
    past = d.where(F.col("order_created_date") < F.lit(AS_OF))
    vocab = EN.fit_vocab(past, "courier_group", 1)
    d = EN.one_hot(d, "courier_group", vocab, prefix="cg_")
    flags = [c for c in d.columns if c.startswith("cg_")] + [c for c in d.columns if c in S.WEEKDAY_FLAGS]
    feats = [*numbers, *flags]
    trimmed = D.trim_days(d).where(F.col("order_created_date") < F.lit(AS_OF))
    keys = [*feats, "order_created_date"]
    train = D.p90_target(trimmed, keys).join(trimmed.groupBy(*keys).agg(F.count("*").cast("double").alias("weight")), keys)
    norm = EN.fit_global_norm(train, numbers)
    model = M.fit_delivery_days(EN.apply_global_norm(train, norm, numbers), feats, "p90", weight="weight")
    test = EN.apply_global_norm(d.where(F.col("order_created_date") >= F.lit(AS_OF)), norm, numbers)
    out = D.promised(M.score_value(model, test), "predicted")
    return out.select("l_orderkey", "l_linenumber", (F.col("pdd1") <= F.col("pdd2")).alias("window_sound"))
