"""Queries over the relational operators: scans, scalars, joins, aggregates, windows, sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.bindings.frames import AS_OF, EVENTS_AS_OF, Frames, ddb
from marginloom.bindings.registry import query
from marginloom.functions import scalars as S
from marginloom.operators import aggregates as A
from marginloom.operators import evaluation as E
from marginloom.operators import joins as J
from marginloom.operators import windows as W
from marginloom.sources import snapshots as SN
from marginloom.sources import tables as T

# ---- scans, deletes, snapshots ---------------------------------------------------------------


@query("""select l_orderkey, l_partkey, l_quantity from lineitem
          where l_shipdate >= timestamp '1998-01-01' and l_quantity < 20""")
def scan_project_filter(f: Frames):
    return T.read_table(f.spark, f"{f.sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"],
                        (F.col("l_shipdate") >= F.lit(dt.datetime(1998, 1, 1))) & (F.col("l_quantity") < 20))


@query(ddb("""select snapshot_date, count(*) as n, cast(sum(is_pushed) as bigint) as pushed,
                     round(sum(list_b_cb), 2) as total from (
    select snapshot_date, product_sid, vendor_sid, is_pushed, list_b_cb from snapshots
    where snapshot_date <> date '1998-06-30' and snapshot_date <> date '1998-06-23'
    union all select date '1998-06-30', product_sid, vendor_sid, is_pushed, list_b_cb from final_today) u
    group by snapshot_date"""))
def snapshot_retention(f: Frames):
    out = SN.snapshot_append(f.snapshots, f.final_today, AS_OF)
    return out.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_pushed").alias("pushed"), F.round(F.sum("list_b_cb"), 2).alias("total"))


@query(ddb("""select product_sid, vendor_sid, closing_fee from suborders
              where not coalesce(closing_fee > 5 and verified = date '1998-06-29', false)
                and not coalesce(closing_fee < 3, false)"""))
def delete_where(f: Frames):
    kept = T.delete_where(f.suborders, (F.col("closing_fee") > 5) & (F.col("verified") == F.lit(dt.date(1998, 6, 29))))
    return T.delete_where(kept, F.col("closing_fee") < 3).select("product_sid", "vendor_sid", "closing_fee")


@query(ddb("""select stepname, starttime, endtime,
       cast(floor(date_diff('second', starttime, endtime) / 60) % 60 as int) as minutes_taken,
       cast(floor(date_diff('second', starttime, timestamp '2002-01-01 05:00:00') / 3600) % 24 as int)
         as hours_since_start
       from (select distinct stepname, starttime, endtime from step_log) l
       order by starttime desc nulls last, stepname, endtime limit 200"""))
def step_elapsed(f: Frames):
    return SN.step_log_report(f.step_log, dt.datetime(2002, 1, 1, 5))


# ---- scalars -----------------------------------------------------------------------------------


@query("""select o_orderkey, o_totalprice from orders
          where cast(o_orderdate as date) between date '1998-06-01' and date '1998-06-30'
            and o_totalprice between 10000 and 250000""")
def filter_between(f: Frames):
    return f.orders.where(F.to_date("o_orderdate").between(F.lit(dt.date(1998, 6, 1)), F.lit(AS_OF))
                          & F.col("o_totalprice").between(10000, 250000)).select("o_orderkey", "o_totalprice")


@query("""select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
          and o_orderstatus not in ('P')""")
def filter_in_list(f: Frames):
    return f.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")) \
        .select("o_orderkey", "o_orderpriority")


# Selling-price bands of the listing base.
PRICE_BANDS = [(200, "a_0 to 200"), (400, "b_200 to 400"), (600, "c_400 to 600"), (800, "d_600 to 800"),
               (1000, "e_800 to 1000")]
PRICE_BAND_SQL = """case when {p} <= 200 then 'a_0 to 200' when {p} <= 400 then 'b_200 to 400'
    when {p} <= 600 then 'c_400 to 600' when {p} <= 800 then 'd_600 to 800' when {p} <= 1000 then 'e_800 to 1000'
    when {p} > 1000 then 'f_1000+' else 'unknown' end"""


@query(ddb(f"""select product_sid, vendor_sid, {PRICE_BAND_SQL.format(p="nullif(selling_price, 61)")} as price_band
               from listings"""))
def price_band(f: Frames):
    price = F.nullif(F.col("selling_price"), F.lit(61.0))
    return f.listings.select("product_sid", "vendor_sid",
                             S.band_label(price, PRICE_BANDS, "f_1000+", "unknown").alias("price_band"))


@query(ddb("""select suborder_code, coalesce(closing_fee, 0) as closing_fee,
              coalesce(fulfillment_charges, 0) as fulfillment_charges from suborders"""))
def coalesce_defaults(f: Frames):
    return f.suborders.select("suborder_code", S.nz("closing_fee").alias("closing_fee"),
                              S.nz("fulfillment_charges").alias("fulfillment_charges"))


@query(ddb("""select coalesce(closing_fee, -99999) as closing_fee, coalesce(fulfillment_charges, 10000)
              as fulfillment_charges, nullif(coalesce(closing_fee, -99999), -99999) as restored, quantity
              from suborders"""))
def impute_constants(f: Frames):
    filled = f.suborders.fillna({"closing_fee": -99999.0, "fulfillment_charges": 10000.0})
    return filled.select("closing_fee", "fulfillment_charges", S.sentinel_to_null("closing_fee").alias("restored"),
                         "quantity")


@query(ddb("""select code, nullif(pin_att_14, 0) as pin_att_14, nullif(user_del_ship, 0) as user_del_ship,
              case when nullif(user_del_ship, 0) is not null then user_del end as user_del from returns"""))
def zero_to_null(f: Frames):
    z = f.returns.withColumns({c: S.zero_to_null(c) for c in ("pin_att_14", "user_del_ship")})
    return z.select("code", "pin_att_14", "user_del_ship", S.null_where_null("user_del", "user_del_ship").alias("user_del"))


@query(ddb("""select device_id, cast(search_events is null as int) as search_events_null,
              cast(days_since_search is null as int) as days_since_search_null,
              cast(visit_date is null as int) as visit_date_null from devices"""))
def null_indicators(f: Frames):
    return f.devices.select("device_id", *[F.col(c).isNull().cast("int").alias(f"{c}_null")
                                           for c in ("search_events", "days_since_search", "visit_date")])


@query(ddb("""select product_sid,
   case when rival_a_price is not null and rival_b_price is not null then least(rival_a_price, rival_b_price) end as lo,
   case when rival_a_price is not null and rival_b_price is not null then greatest(rival_a_price, rival_b_price) end as hi
   from (select supc as product_sid, rival_a_price, rival_b_price from price_match_list) p"""))
def least_greatest_strict(f: Frames):
    return f.price_match_list.select(F.col("supc").alias("product_sid"), S.least_strict("rival_a_price", "rival_b_price").alias("lo"),
                                     S.greatest_strict("rival_a_price", "rival_b_price").alias("hi"))


@query(ddb("""select suborder_code, date_diff('day', created, verified) as lag_days,
              date_diff('day', verified, date '1998-06-30') as age_days, verified + 7 as promise_date from suborders"""))
def date_diff_features(f: Frames):
    return f.suborders.select("suborder_code", S.days_between("verified", "created").cast("bigint").alias("lag_days"),
                              S.days_between(S.day(AS_OF), "verified").cast("bigint").alias("age_days"),
                              F.date_add("verified", 7).alias("promise_date"))


@query(ddb("""select l_orderkey, l_linenumber, cast(order_created_time as date) as order_created_date,
   cast(isodow = 1 as int) as mon, cast(isodow = 2 as int) as tue, cast(isodow = 3 as int) as wed,
   cast(isodow = 4 as int) as thurs, cast(isodow = 5 as int) as fri, cast(isodow = 6 as int) as sat,
   cast(isodow = 7 as int) as sun, cast(hr // 6 + 1 as int) as day_quarter, dayname(order_created_time) as day_name
   from (select *, extract(isodow from order_created_time) as isodow, extract(hour from order_created_time) as hr
         from deliveries) d"""))
def calendar_features(f: Frames):
    ts = "order_created_time"
    return f.deliveries.select("l_orderkey", "l_linenumber", F.to_date(ts).alias("order_created_date"),
                               *S.weekday_flags(ts), S.day_quarter(ts).alias("day_quarter"),
                               F.date_format(ts, "EEEE").alias("day_name"))


@query(ddb("""select suborder_code, verified_key, cast(try_strptime(cast(verified_key as varchar), '%Y%m%d') as date) as parsed from (
   select suborder_code, case when product_sid % 17 = 0 then 19981345 when product_sid % 19 = 0 then null
     else cast(strftime(verified, '%Y%m%d') as int) end as verified_key from suborders) k"""))
def date_key_parse(f: Frames):
    key = (F.when(F.col("product_sid") % 17 == 0, 19981345).when(F.col("product_sid") % 19 == 0, F.lit(None))
           .otherwise(F.date_format("verified", "yyyyMMdd").cast("int")))
    return f.suborders.select("suborder_code", key.alias("verified_key"), S.date_from_key(key).alias("parsed"))


@query(ddb("""select seller_code as vendor_code, case when substring(seller_code, 1, 1) = 's'
   then upper(seller_code[1]) || lower(seller_code[2:]) else seller_code end as canonical,
   supc, supc as supc_canonical from disablement"""))
def canonical_code(f: Frames):
    return f.disablement.select(F.col("seller_code").alias("vendor_code"), S.canonical_code("seller_code").alias("canonical"),
                                "supc", S.canonical_code("supc", prefix="sku", width=1).alias("supc_canonical"))


@query(ddb("""select 'CAT_OFFER_' || nullif(category_id, '3') || '_0' as coupon,
   subcategory_id || '-' || product_sid as pair from products"""))
def composite_key(f: Frames):
    coupon = F.concat(S.composite_key(F.lit("CAT"), F.lit("OFFER"), F.nullif(F.col("category_id"), F.lit("3")), sep="_"), F.lit("_0"))
    return f.products.select(coupon.alias("coupon"), S.composite_key("subcategory_id", "product_sid").alias("pair"))


@query(ddb("""select code, round(user_del * 100 / nullif(user_del_ship, 0), 6) as del_per,
              round(pin_del_14 * 100 / nullif(pin_att_14, 0), 6) as pin_rate from returns"""))
def safe_rate(f: Frames):
    return f.returns.select("code", F.round(S.safe_rate("user_del", "user_del_ship"), 6).alias("del_per"),
                            F.round(S.safe_rate("pin_del_14", "pin_att_14"), 6).alias("pin_rate"))


@query(ddb("""select product_sid, ceil(greatest(pa_weight, pa_length * pa_breadth * pa_height / 5) / 500) as slab
              from products"""))
def volumetric_slab(f: Frames):
    return f.products.select("product_sid", S.volumetric_slab("pa_weight", "pa_length", "pa_breadth", "pa_height").alias("slab"))


@query("""select c_custkey, case c_mktsegment when 'MACHINERY' then 'FURNITURE' else c_mktsegment end as segment,
          cast(c_mktsegment in ('BUILDING', 'AUTOMOBILE') as int) as is_core from customer""")
def recode_values(f: Frames):
    return f.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"),
                             F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE").cast("int").alias("is_core")) \
        .na.replace({"MACHINERY": "FURNITURE"}, subset=["segment"])


# ---- joins ---------------------------------------------------------------------------------------


@query(ddb("""select l.supc, l.vendor_code, l.selling_price as vip_selling_price, r.seller_price
              from listings l join financials r on r.supc = l.supc and r.seller_code = l.vendor_code"""))
def join_inner_composite(f: Frames):
    fin = f.financials.select("supc", F.col("seller_code").alias("vendor_code"), "seller_price")
    return f.listings.withColumnRenamed("selling_price", "vip_selling_price").join(fin, ["supc", "vendor_code"]) \
        .select("supc", "vendor_code", "vip_selling_price", "seller_price")


@query(ddb("""select l.product_sid, l.vendor_sid, cast(coalesce(s.n, 0) as bigint) as n, coalesce(s.q, 0) as q
   from listings l left join (select product_sid, vendor_sid, count(*) as n, sum(quantity) as q from suborders
        where verified >= date '1998-06-30' group by 1, 2) s on l.product_sid = s.product_sid and l.vendor_sid = s.vendor_sid"""))
def join_left_default(f: Frames):
    sales = f.suborders.where(F.col("verified") >= F.lit(AS_OF)).groupBy("product_sid", "vendor_sid") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q"))
    return J.left_default(f.listings.select("product_sid", "vendor_sid"), sales, ["product_sid", "vendor_sid"],
                          {"n": 0, "q": 0.0})


@query(ddb("""select s.suborder_code, s.product_sid, coalesce(a.value, 0) as rto_charge, coalesce(b.value, 0) as rpr_charge
   from suborders s left join suborder_params a on a.suborder_code = s.suborder_code and a.key = 'RTO_FORWARD'
   left join suborder_params b on b.suborder_code = s.suborder_code and b.key = 'RPR_FORWARD'"""))
def kv_left_join(f: Frames):
    out = J.kv_left_join(f.suborders.select("suborder_code", "product_sid"), f.suborder_params, "suborder_code",
                         {"RTO_FORWARD": "rto_charge", "RPR_FORWARD": "rpr_charge"})
    return out.fillna(0.0, ["rto_charge", "rpr_charge"])


@query(ddb("""select l.supc, l.vendor_code, p.rival_a_price from listings l join price_match_list p
              on lower(p.supc) = lower(l.supc) and lower(p.vendor_code) = lower(l.vendor_code)"""))
def join_casefold(f: Frames):
    return J.casefold_join(f.listings.select("supc", "vendor_code"), f.price_match_list.select("supc", "vendor_code", "rival_a_price"),
                           [("supc", "supc"), ("vendor_code", "vendor_code")])


@query(ddb("""select l.product_sid, l.vendor_sid, b.from_price, b.variant2_gm_floor
   from (select l.*, p.subcategory_id from listings l join products p on p.product_sid = l.product_sid) l
   left join cutoff_bands b on b.subcategory_id = l.subcategory_id and l.selling_price between b.from_price and b.to_price"""))
def band_join(f: Frames):
    priced = f.listings.join(f.products.select("product_sid", "subcategory_id"), "product_sid")
    bands = f.cutoff_bands.select("subcategory_id", "from_price", "to_price", "variant2_gm_floor")
    return J.band_join(priced, bands, ["subcategory_id"], "selling_price", "from_price", "to_price") \
        .select("product_sid", "vendor_sid", "from_price", "variant2_gm_floor")


@query(ddb("""select l.product_sid, l.vendor_sid, a.rounding as seg_price, b.rounding as seg_half from listings l
   left join price_points a on l.selling_price >= a.rounding and l.selling_price < a.rounding_next
   left join price_points b on l.selling_price / 2 >= b.rounding and l.selling_price / 2 < b.rounding_next"""))
def range_lookup(f: Frames):
    priced = f.listings.select("product_sid", "vendor_sid", "selling_price", (F.col("selling_price") / 2).alias("half"))
    out = J.range_lookup(priced, f.price_points, {"selling_price": "a", "half": "b"}, "rounding", "rounding_next")
    return out.select("product_sid", "vendor_sid", F.col("a.rounding").alias("seg_price"), F.col("b.rounding").alias("seg_half"))


@query(ddb("""select l.supc, l.vendor_code, d.deal_op from listings l join deals d on d.supc = l.supc
   and d.vendor_code = l.vendor_code and date '1998-06-30' between d.start_date and d.end_date"""))
def valid_as_of_join(f: Frames):
    live = J.valid_on(f.deals, AS_OF, "start_date", "end_date").select("supc", "vendor_code", "deal_op")
    return f.listings.select("supc", "vendor_code").join(live, ["supc", "vendor_code"])


FLAGS_CTE = """select l.product_sid, l.vendor_sid, enabled as is_enabled, gst_enabled as is_enabled_with_inv,
    cast(l.product_sid % 2 as int) as sold_30, cast(l.product_sid % 3 = 0 as int) as sold_7,
    cast(l.vendor_sid % 2 as int) as top_vendor, cast(l.vendor_sid % 3 = 0 as int) as category_request_cb from listings l"""


@query(ddb("""select f.*, p.is_pushed from flags f left join pushed_status p on p.is_enabled = f.is_enabled
   and p.is_enabled_with_inv = f.is_enabled_with_inv and p.sold_30_flag = f.sold_30 and p.sold_7_flag = f.sold_7
   and p.top_vendor = f.top_vendor and p.category_cb_push = f.category_request_cb""", flags=FLAGS_CTE))
def decision_table(f: Frames):
    flags = f.spark.sql(FLAGS_CTE.replace("from listings", "from {listings}"), listings=f.listings)
    return J.decision_table(flags, f.pushed_status, {
        "is_enabled": "is_enabled", "is_enabled_with_inv": "is_enabled_with_inv", "sold_30": "sold_30_flag",
        "sold_7": "sold_7_flag", "top_vendor": "top_vendor", "category_request_cb": "category_cb_push"}, ["is_pushed"])


@query(ddb("""select product_sid, pog_id from products where pog_id in
   (select pog_id from pog_visits where visit_date >= date '1998-06-28' and pog_id is not null)"""))
def semi_join_recent(f: Frames):
    visited = f.pog_visits.where(F.col("visit_date") >= F.lit(AS_OF - dt.timedelta(days=2))).where("pog_id is not null")
    return f.products.select("product_sid", "pog_id").join(visited.select("pog_id"), "pog_id", "left_semi")


@query(ddb("""select vendor_code, end_date, bid from seller_bids where end_date in (select max(end_date) from seller_bids)"""))
def latest_batch_filter(f: Frames):
    return J.latest_batch(f.seller_bids, "end_date").select("vendor_code", "end_date", "bid")


@query(ddb("""select product_sid, pog_id, case when h.k is not null then 1 else 0 end as high_cb_pog from products p
   left join (select distinct pog_id as k from high_cb_pogs) h on h.k = p.pog_id"""))
def membership_flag(f: Frames):
    return J.membership_flag(f.products.select("product_sid", "pog_id"), f.high_cb_pogs, ["pog_id"], "high_cb_pog")


@query(ddb("""select d.device_id, a.sale_day as last_order_on_sale_day, cast(coalesce(b.sale_day, 0) as int) as install_on_sale_day
   from devices d left join sale_calendar a on a.cal_date = d.last_order_date
   left join sale_calendar b on b.cal_date = d.install_date"""))
def calendar_enrich(f: Frames):
    out = J.calendar_enrich(f.devices.select("device_id", "last_order_date", "install_date"), f.sale_calendar, "sale_day",
                            {"last_order_date": ("last_order_on_sale_day", None), "install_date": ("install_on_sale_day", 0)},
                            date="cal_date")
    return out.select("device_id", "last_order_on_sale_day", "install_on_sale_day")


@query(ddb("""select f.supc, f.seller_code, case when c.supc is not null and f.selling_price <> c.selling_price
     then c.closing_fee else f.closing_fee end as closing_fee from financials f left join (select * from price_changes
     qualify row_number() over (partition by lower(supc), lower(vendor_code) order by aud_date desc nulls last, supc desc, vendor_code desc,
       selling_price desc nulls last, seller_price desc nulls last, fixed_margin_amount desc nulls last, closing_fee desc nulls last) = 1) c
   on lower(c.supc) = lower(f.supc) and lower(c.vendor_code) = lower(f.seller_code)"""))
def update_from(f: Frames):
    out = J.update_from(f.financials, f.price_changes, {"supc": "supc", "seller_code": "vendor_code"},
                        {"closing_fee": F.col("src_closing_fee")},
                        when=F.col("selling_price") != F.col("src_selling_price"), casefold=True,
                        newest_first=[F.desc_nulls_last("aud_date")])
    return out.select("supc", "seller_code", "closing_fee")


@query(ddb("""select distinct l.product_sid, l.vendor_sid, r.is_exception, r.hard_exception
   from listings l join products p on p.product_sid = l.product_sid
   left join brand_rules r on r.brand_id = p.brand_id"""))
def distinct_after_join(f: Frames):
    # Rules are reduced to different rows first, which keeps the fan-out and the final distinct small.
    rules = f.brand_rules.select("brand_id", "is_exception", "hard_exception").distinct()
    listed = f.listings.select("product_sid", "vendor_sid").join(f.products.select("product_sid", "brand_id"), "product_sid")
    return listed.join(rules, "brand_id", "left").select("product_sid", "vendor_sid", "is_exception", "hard_exception").distinct()


# ---- aggregates -----------------------------------------------------------------------------------


@query(ddb("select vendor_sid, count(distinct suborder_code) as subos from suborders group by vendor_sid"))
def count_distinct_by_key(f: Frames):
    return A.count_distinct_by_key(f.suborders, ["vendor_sid"], "suborder_code", "subos")


@query(ddb("""select product_sid, count(distinct suborder_code) as n_codes,
   count(distinct case when verified >= date '1998-01-01' then suborder_code end) as n_recent,
   count(distinct case when closing_fee > 4 then suborder_code end) as n_fee,
   max(case when verified >= date '2001-01-01' then 1 else 0 end) as any_late from suborders group by product_sid"""))
def conditional_aggregates(f: Frames):
    return A.conditional_distinct(
        f.suborders, ["product_sid"], "suborder_code",
        {"n_recent": F.col("verified") >= F.lit(dt.date(1998, 1, 1)), "n_fee": F.col("closing_fee") > 4},
        {"any_late": F.col("verified") >= F.lit(dt.date(2001, 1, 1))}, total="n_codes")


def _trailing(n: int) -> str:
    return f"verified between date '1998-06-30' - {n} and date '1998-06-29'"


TRAILING_SQL = ddb(f"""select product_sid, vendor_sid,
   {', '.join(f"count(distinct case when {_trailing(n)} then suborder_code end) as sold_{n}" for n in (7, 15, 30))},
   {', '.join(f"max(case when {_trailing(n)} then 1 else 0 end) as sold_{n}_flag" for n in (7, 15, 30))}
   from suborders where {_trailing(30)} group by product_sid, vendor_sid""")


@query(TRAILING_SQL)
def trailing_sales(f: Frames):
    return A.trailing_sales(f.suborders, ["product_sid", "vendor_sid"], "suborder_code", "verified", AS_OF, [7, 15, 30])


@query(ddb("""select count(supc || vendor_code) as n_rows, count(distinct supc || vendor_code) as n_distinct
   from supc_vendor_rules"""))
def global_counts(f: Frames):
    return A.global_counts(f.supc_vendor_rules, F.concat("supc", "vendor_code"))


@query(ddb("""select case when t.vendor_sid is not null then 1 else 0 end as cover_flag,
   cast(sum(s.subos) as bigint) as subos, round(sum(coalesce(t.cb_a, 0) * s.subos) / sum(s.subos), 4) as cb_a_new,
   round(sum(coalesce(t.cb_b, 0) * s.subos) / sum(s.subos), 4) as cb_b_new,
   cast(count(distinct s.vendor_sid || '-' || s.product_sid) as bigint) as pairs
   from (select product_sid, vendor_sid, count(distinct suborder_code) as subos from suborders
         where verified between date '1998-06-01' and date '1998-06-30' group by 1, 2) s
   left join (select product_sid, vendor_sid, selling_price * 0.1e0 as cb_a, internal_cashback as cb_b from listings
         where enabled = 1) t on t.product_sid = s.product_sid and t.vendor_sid = s.vendor_sid group by 1"""))
def weighted_avg_cover(f: Frames):
    recent = f.suborders.where(F.col("verified").between(F.lit(dt.date(1998, 6, 1)), F.lit(AS_OF)))
    sold = A.count_distinct_by_key(recent, ["product_sid", "vendor_sid"], "suborder_code", "subos")
    priced = f.listings.where("enabled = 1").select(
        "product_sid", "vendor_sid", (F.col("selling_price") * 0.1).alias("cb_a"),
        F.col("internal_cashback").alias("cb_b"), F.lit(1).alias("cover"))
    joined = sold.join(priced, ["product_sid", "vendor_sid"], "left").withColumn("cover_flag", F.coalesce("cover", F.lit(0)))
    # `sold` has one row per pair, so pairs are counted without a distinct.
    out = A.weighted_cover(joined.withColumn("pairs", F.lit(1)), ["cover_flag"], ["cb_a", "cb_b"], "subos")
    pairs = A.sum_by_key(joined.withColumn("one", F.lit(1)), ["cover_flag"], "one", "pairs")
    return out.join(pairs, "cover_flag").select("cover_flag", "subos", F.round("cb_a_new", 4).alias("cb_a_new"),
                                                F.round("cb_b_new", 4).alias("cb_b_new"), "pairs")


@query(ddb("select distinct supc, product_sid, vendor_sid, new_logic_status, seller_zone from disablement"))
def group_dedup(f: Frames):
    return A.group_dedup(f.disablement, ["supc", "product_sid", "vendor_sid", "new_logic_status", "seller_zone"])


@query(ddb("""select pog_id, cast(sum(visits) as bigint) as visits from pog_visits
              where visit_date >= date '1998-06-28' group by pog_id"""))
def sum_by_key(f: Frames):
    return A.sum_by_key(f.pog_visits.where(F.col("visit_date") >= F.lit(dt.date(1998, 6, 28))), ["pog_id"], "visits", "visits")


@query(ddb("""select o2a, n, round(n * 100.0 / sum(n) over (), 6) as share_pct,
   round(sum(n) over (order by o2a) * 100.0 / sum(n) over (), 6) as cum_share_pct
   from (select o2a, count(*) as n from deliveries group by o2a) g"""))
def frequency_share(f: Frames):
    return A.frequency_share(f.deliveries, "o2a").select(
        "o2a", "n", F.round("share_pct", 6).alias("share_pct"), F.round("cum_share_pct", 6).alias("cum_share_pct"))


def _share_sql(frame: str, column: str) -> str:
    return ddb(f"""select {column}, n, round(n * 100.0 / sum(n) over (), 6) as share_pct,
       round(sum(n) over (order by {column}) * 100.0 / sum(n) over (), 6) as cum_share_pct
       from (select {column}, count(*) as n from {frame} where {column} is not null group by {column}) g""")


def _shares(df: DataFrame, column: str) -> DataFrame:
    return A.frequency_share(df, column).select(column, "n", F.round("share_pct", 6).alias("share_pct"), F.round("cum_share_pct", 6).alias("cum_share_pct"))


@query(_share_sql("devices", "install_channel"))
def frequency_share_category(f: Frames):
    return _shares(f.devices, "install_channel")


@query(_share_sql("devices", "install_date"))
def frequency_share_date(f: Frames):
    return _shares(f.devices, "install_date")


@query(ddb("""select courier_group, count(*) as n from returns where courier_group is not null group by courier_group
              order by n desc, courier_group"""))
def value_counts(f: Frames):
    return A.value_counts(f.returns, "courier_group")


@query(ddb("""select os, dc, cast(order_created_time as date) as order_date, round(quantile_cont(o2a, 0.9), 6) as p90
              from deliveries where o2a between 1 and 15 group by 1, 2, 3"""))
def group_percentile(f: Frames):
    trimmed = f.deliveries.where(F.col("o2a").between(1, 15)).withColumn("order_date", F.to_date("order_created_time"))
    return A.group_percentile(trimmed, ["os", "dc", "order_date"], "o2a", 0.9, "p90") \
        .withColumn("p90", F.round("p90", 6))


@query(ddb("""select l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) as p50,
              round(quantile_cont(l_extendedprice, 0.9), 4) as p90 from lineitem group by l_returnflag"""))
def group_percentile_wide(f: Frames):
    from marginloom.operators.ordered import exact_percentiles
    out = exact_percentiles(f.lineitem, "l_extendedprice", {"p50": 0.5, "p90": 0.9}, ["l_returnflag"])
    return out.select("l_returnflag", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"))


NULLABLE = ["subcategory_id", "dest_pincode", "courier_group", "same_supc_dup", "same_subcat_dup", "score"]


@query(ddb(" union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as n_null from returns" for c in NULLABLE)))
def null_profile(f: Frames):
    return A.null_profile(f.returns, NULLABLE)


CORR = ["dc_o2a_7", "oc_o2a_7", "o2a", "raw_prediction"]


@query(ddb(" union all ".join(f"select '{a}' as var_a, '{b}' as var_b, round(corr({a}, {b}), 6) + 0.0 as corr from deliveries"
                              for i, a in enumerate(CORR) for b in CORR[i:])))
def corr_matrix(f: Frames):
    return A.corr_matrix(f.deliveries, CORR).withColumn("corr", F.round("corr", 6) + F.lit(0.0))


@query(ddb(" union all ".join(f"select rto, '{c}' as column_name, round(avg({c}), 6) as mean_value from returns group by rto"
                              for c in ("user_del", "pin_att_14", "same_supc_dup"))))
def class_means(f: Frames):
    return A.class_means(f.returns, "rto", ["user_del", "pin_att_14", "same_supc_dup"]) \
        .withColumn("mean_value", F.round("mean_value", 6))


@query(ddb("""select rto, courier_group, n, round(n * 100.0 / sum(n) over (partition by rto), 6) as share_pct
   from (select rto, courier_group, count(*) as n from returns where courier_group is not null group by 1, 2) g"""))
def class_category_share(f: Frames):
    return A.class_category_share(f.returns, "rto", "courier_group").withColumn("share_pct", F.round("share_pct", 6))


@query(ddb("""select rto, n, round(n * 100.0 / sum(n) over (), 2) as share_pct
              from (select rto, count(*) as n from returns group by rto) g"""))
def class_balance(f: Frames):
    return A.class_balance(f.returns, "rto")


@query(ddb("""select round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) as t_stat, round(m1, 6) as mean_1, round(m0, 6) as mean_0
   from (select avg(user_del) filter (rto = 1) as m1, avg(user_del) filter (rto = 0) as m0,
     var_samp(user_del) filter (rto = 1) as v1, var_samp(user_del) filter (rto = 0) as v0,
     count(user_del) filter (rto = 1) as n1, count(user_del) filter (rto = 0) as n0 from returns) s"""))
def welch_t(f: Frames):
    return A.welch_t(f.returns, "rto", "user_del").select(*[F.round(c, 6).alias(c) for c in ("t_stat", "mean_1", "mean_0")])


# ---- windows ---------------------------------------------------------------------------------------


@query(ddb("""select product_sid, vendor_sid, closing_fee, fulfillment_charges from (
   select *, row_number() over (partition by product_sid, vendor_sid order by verified desc, created desc, suborder_code desc,
     closing_fee desc nulls last, fulfillment_charges desc nulls last) as rn from suborders
   where verified >= date '1998-05-31') s where rn = 1"""))
def latest_value_by_key(f: Frames):
    recent = f.suborders.where(F.col("verified") >= F.lit(AS_OF - dt.timedelta(days=30)))
    return W.latest_values(recent, ["product_sid", "vendor_sid"],
                           ["verified", "created", "suborder_code", "closing_fee", "fulfillment_charges"],
                           ["closing_fee", "fulfillment_charges"])


@query(ddb("""select subcategory_id, vendor_code, is_exception, hard_exception, updated from (
   select *, row_number() over (partition by subcategory_id, vendor_code order by updated desc nulls last,
     is_exception desc nulls last, hard_exception desc nulls last) as rn from subcat_vendor_rules) s where rn = 1"""))
def dedup_latest_rule(f: Frames):
    return W.dedup_latest(f.subcat_vendor_rules, ["subcategory_id", "vendor_code"],
                          ["updated", "is_exception", "hard_exception"])


@query(ddb("""select distinct supc, vendor_code, ro_number, cash_back, start_date from (
   select *, rank() over (partition by lower(supc), lower(vendor_code) order by start_date desc nulls last) as rk
   from (select distinct * from monetisation where flag = 'Non-SLI') d) r where rk = 1"""))
def rank_keep_ties(f: Frames):
    offers = f.monetisation.where("flag = 'Non-SLI'").distinct()
    return W.keep_top_ties(offers, [F.lower("supc"), F.lower("vendor_code")], ["start_date"]) \
        .select("supc", "vendor_code", "ro_number", "cash_back", "start_date")


@query(ddb("""select vendor_sid, count(distinct suborder_code) as subos from suborders where verified >= date '1998-06-15'
              group by vendor_sid order by subos desc, vendor_sid limit 60"""))
def top_n_vendors(f: Frames):
    sold = A.count_distinct_by_key(f.suborders.where(F.col("verified") >= F.lit(AS_OF - dt.timedelta(days=15))),
                                   ["vendor_sid"], "suborder_code", "subos")
    return W.top_n(sold, [F.desc("subos"), F.asc("vendor_sid")], 60)


@query(ddb("""select active_day, seller_code, supc, bid from (select *, row_number() over (
   partition by active_day, seller_code, supc order by bid) as rn from active_bids where active_day = date '1998-06-29') b
   where rn = 1"""))
def best_bid_per_day(f: Frames):
    return W.best_bid(f.active_bids, "active_day", AS_OF - dt.timedelta(days=1), ["seller_code", "supc"], "bid")


@query(ddb("""select user_id, install_day, event_id from (select user_id, cast(ts as date) as install_day, event_id,
   row_number() over (partition by user_id, cast(ts as date) order by event_id) as rn from events) e where rn = 1"""))
def drop_duplicates_first(f: Frames):
    e = f.events.select("user_id", F.to_date("ts").alias("install_day"), "event_id")
    return W.dedup_latest(e, ["user_id", "install_day"], [F.asc("event_id")])


# ---- sort, limit, sets ------------------------------------------------------------------------------


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 200")
def sort_limit(f: Frames):
    return W.top_n(f.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 200)


@query(ddb("""select product_sid, vendor_sid from suborders where verified >= date '2001-06-01'
   union select product_sid, vendor_sid from snapshots where is_pushed = 1 and snapshot_date < date '1996-01-01'
   union select product_sid, vendor_sid from final_today where is_pushed = 0"""))
def union_distinct(f: Frames):
    pair = ["product_sid", "vendor_sid"]
    return (f.suborders.where(F.col("verified") >= F.lit(dt.date(2001, 6, 1))).select(*pair)
            .unionByName(f.snapshots.where((F.col("is_pushed") == 1) & (F.col("snapshot_date") < F.lit(dt.date(1996, 1, 1)))).select(*pair))
            .unionByName(f.final_today.where("is_pushed = 0").select(*pair)).distinct())


@query(ddb("""select 'event' as src, user_id as id, value as amount from events
   union all select 'order', o_custkey, o_totalprice from orders"""))
def row_concat(f: Frames):
    e = f.events.select(F.lit("event").alias("src"), F.col("user_id").alias("id"), F.col("value").alias("amount"))
    o = f.orders.select(F.lit("order").alias("src"), F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return e.unionByName(o)
