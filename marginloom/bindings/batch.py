"""Queries over what a daily batch repeats: state carried from day to day, versions, folded updates, stacked encoders."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import functions as F

from marginloom.bindings.frames import AS_OF, Frames, ddb
from marginloom.bindings.modelling import TRAIN_END
from marginloom.bindings.registry import query
from marginloom.operators import joins as J
from marginloom.operators.daily import TrailingState
from marginloom.operators.updates import Update, update_sequence as run_updates
from marginloom.plans import return_risk as R
from marginloom.session import shared_dir
from marginloom.sources import snapshots as SN
from marginloom.sources.versions import Versions

DAYS = [AS_OF - dt.timedelta(days=n) for n in range(9, -1, -1)]


def fresh_folder(f: Frames, name: str) -> str:
    return f"{shared_dir(f.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _report(day: dt.date) -> str:
    within = lambda n: f"verified between date '{day}' - {n} and date '{day}' - 1"
    counts = ", ".join(f"count(distinct case when {within(n)} then code end) as sold_{n}" for n in (7, 15, 30))
    flags = ", ".join(f"max(case when {within(n)} then 1 else 0 end) as sold_{n}_flag" for n in (7, 15, 30))
    return f"select date '{day}' as as_of, vendor_sid, {counts}, {flags} from sales where {within(30)} group by vendor_sid"


@query(ddb(" union all ".join(map(_report, DAYS)),
           sales="select vendor_sid, verified, case when closing_fee is not null then product_sid end as code from suborders"))
def trailing_sales_incremental(f: Frames):
    """Ten days' reports: the state is loaded once, then a day at a time is added and read for the next report."""
    sales = f.suborders.select("vendor_sid", "verified", F.when(F.col("closing_fee").isNotNull(), F.col("product_sid")).alias("code"))
    state = TrailingState(f.spark, fresh_folder(f, "trailing"), sales.schema, ["vendor_sid"], "code", "verified")
    reports = []
    for as_of in DAYS:
        yesterday = as_of - dt.timedelta(days=1)
        state.append(sales, yesterday) if reports else state.load(sales, yesterday)
        reports.append(state.trailing(as_of, [7, 15, 30]).select(F.lit(as_of).alias("as_of"), "*"))
    return reduce(lambda a, b: a.unionByName(b), reports)


@query(ddb("""select snapshot_date, count(*) as n, cast(sum(is_pushed) as bigint) as pushed, round(sum(list_b_cb), 2) as total from (
    select snapshot_date, product_sid, vendor_sid, is_pushed, list_b_cb from snapshots
    where snapshot_date not in (date '1998-06-30', date '1998-06-29', date '1998-06-23', date '1998-06-22')
    union all select date '1998-06-29', product_sid, vendor_sid, is_pushed, list_b_cb from final_today where product_sid % 2 = 0
    union all select date '1998-06-30', product_sid, vendor_sid, is_pushed, list_b_cb from final_today) u group by snapshot_date"""))
def snapshot_versions(f: Frames):
    """Two days are committed to a versioned table, the second one twice; the newest version is read."""
    path, hist = fresh_folder(f, "snapshots"), f.snapshots.select("snapshot_date", "product_sid", "vendor_sid", "is_pushed", "list_b_cb")
    recent = [AS_OF - dt.timedelta(days=n) for n in range(9)]
    parts = [({"day": d.isoformat()}, hist.where(F.col("snapshot_date") == F.lit(d))) for d in recent]
    Versions(f.spark, path).commit([*parts, ({"day": "others"}, hist.where(~F.col("snapshot_date").isin(recent)))])
    SN.commit_snapshot(f.final_today.where("product_sid % 2 = 0"), path, AS_OF - dt.timedelta(days=1))
    for _ in range(2):
        SN.commit_snapshot(f.final_today, path, AS_OF)
    Versions(f.spark, path).vacuum(keep=1)
    return SN.read_snapshots(f.spark, path, hist.schema).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_pushed").alias("pushed"), F.round(F.sum("list_b_cb"), 2).alias("total"))


@query(ddb("select supc, seller_code, selling_price, seller_price, closing_fee, matched from step4",
           change="""select lower(supc) as s, lower(vendor_code) as v, selling_price as sp, seller_price as cost, closing_fee as fee from price_changes
     qualify row_number() over (partition by lower(supc), lower(vendor_code) order by aud_date desc nulls last, supc desc, vendor_code desc,
       selling_price desc nulls last, seller_price desc nulls last, fixed_margin_amount desc nulls last, closing_fee desc nulls last) = 1""",
           step1="""select supc, seller_code, case when c.s is not null and selling_price <> c.sp then c.sp else selling_price end as selling_price,
     case when c.s is not null and selling_price <> c.sp then c.cost else seller_price end as seller_price,
     case when c.s is not null and selling_price <> c.sp then c.fee else closing_fee end as closing_fee, 0 as matched
     from financials left join change c on c.s = lower(supc) and c.v = lower(seller_code)""",
           rival="""select lower(supc) as s, lower(vendor_code) as v, rival_a_price as a from price_match_list
     qualify row_number() over (partition by lower(supc), lower(vendor_code) order by rival_a_price desc nulls last, rival_b_price desc nulls last,
       supc desc, vendor_code desc) = 1""",
           step2="""select supc, seller_code, case when coalesce(a < selling_price, false) then a else selling_price end as selling_price, seller_price,
     closing_fee, cast(coalesce(a < selling_price, false) as int) as matched
     from step1 left join rival on s = lower(supc) and v = lower(seller_code)""",
           step3="""select * replace (case when selling_price < seller_price then null else closing_fee end as closing_fee) from step2""",
           deal="""select supc as s, vendor_code as v, deal_op from deals where date '1998-06-30' between start_date and end_date
     qualify row_number() over (partition by supc, vendor_code order by deal_op desc nulls last) = 1""",
           step4="""select supc, seller_code, case when d.s is null then selling_price when deal_op is null then seller_price else deal_op end as selling_price,
     seller_price, closing_fee, case when d.s is null then matched else 2 end as matched
     from step3 left join deal d on d.s = supc and d.v = seller_code"""))
def update_sequence(f: Frames):
    """Newer prices, a match of lower rivals, a rule without a source, then deals spelt exactly: one join of the wide table."""
    target = f.financials.select("supc", "seller_code", "selling_price", "seller_price", "closing_fee", F.lit(0).alias("matched"))
    changes = f.price_changes.select("supc", "vendor_code", "aud_date", "selling_price", "seller_price", "fixed_margin_amount", "closing_fee")
    rivals = f.price_match_list.select("rival_a_price", "rival_b_price", "supc", "vendor_code")
    live = J.valid_on(f.deals, AS_OF, "start_date", "end_date").select("supc", "vendor_code", "deal_op")
    pair = ("supc", "vendor_code")
    price, rival = F.col("selling_price"), F.col("src_rival_a_price")
    steps = [
        Update({c: F.col(f"src_{c}") for c in ("selling_price", "seller_price", "closing_fee")}, changes, pair,
               when=price != F.col("src_selling_price"), newest_first=["aud_date"]),
        Update({"selling_price": rival, "matched": F.lit(1)}, rivals, pair, when=rival < price, newest_first=["rival_a_price", "rival_b_price"]),
        Update({"closing_fee": F.lit(None).cast("double")}, when=price < F.col("seller_price")),
        Update({"selling_price": F.coalesce("src_deal_op", "seller_price"), "matched": F.lit(2)}, live, pair, exact=True)]
    return run_updates(target, ["supc", "seller_code"], steps, casefold=True)


ENCODED = {"courier_group": "courier_group", "subcategory_id": "subcategory_id", "dest_pincode": "dest_pincode",
           "vendor": "cast(l_suppkey as string)", "weekday": "cast((l_orderkey * 7 + l_linenumber) % 9 as string)"}
MANY_MIN = 16


def _single_fit(c: str) -> dict[str, str]:
    """The fit of one column: values rarer than the limit are 'other', then the signed weight."""
    w = "100 * ln(((n - e + 0.5) / (tn - te)) / ((e + 0.5) / te)) * ((n - e) / (tn - te) - e / te)"
    return {f"club_{c}": f"""select rto, case when {c} in (select {c} from train group by {c} having count(*) >= {MANY_MIN}) then {c} else 'other' end as v from train""",
            f"fit_{c}": f"""select v, case when e / n < te / tn then -({w}) else {w} end as w from
   (select v, cast(sum(rto) as double) as e, cast(count(*) as double) as n from club_{c} group by v) g,
   (select cast(sum(rto) as double) as te, cast(count(*) as double) as tn from train) t"""}


@query(ddb("select code, l_partkey, " + ", ".join(
    f"round(coalesce((select w from fit_{c} where v = t.{c}), (select w from fit_{c} where v = 'other'), -99999e0), 6) + 0.0 as {c}" for c in ENCODED)
    + " from test t",
    many="select code, l_partkey, order_date, rto, " + ", ".join(f"coalesce({e}, 'nan') as {c}" for c, e in ENCODED.items()) + " from returns",
    train=f"select * from many where order_date <= date '{TRAIN_END}'", test=f"select * from many where order_date > date '{TRAIN_END}'",
    **{k: v for c in ENCODED for k, v in _single_fit(c).items()}))
def encode_many(f: Frames):
    """Five category columns fitted in one scan and looked up together."""
    data = f.returns.select("code", "l_partkey", "order_date", "rto", *[F.expr(e).alias(c) for c, e in ENCODED.items()])
    train, test = data.where(F.col("order_date") <= F.lit(TRAIN_END)), data.where(F.col("order_date") > F.lit(TRAIN_END))
    out = R.encode_many(train, [test], list(ENCODED), "rto", MANY_MIN)[1]
    return out.select("code", "l_partkey", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ENCODED])
