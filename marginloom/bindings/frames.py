"""Domain frames derived from the benchmark tables.

Each frame is one SELECT that reads the same in Spark SQL and in DuckDB, so a query and its check
start from identical inputs. The operators under test never appear here.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(1998, 6, 30)
EVENTS_AS_OF = dt.date(2024, 1, 20)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Code builders used in several frames.
_VENDOR = "concat('S', lpad(cast({k} as string), 6, '0'))"
_MIXED = "concat(case when {k} % 2 = 0 then 's' else 'S' end, lpad(cast({k} as string), 6, '0'))"
_SUPC = "concat('SKU', lpad(cast({k} as string), 9, '0'))"
_BRAND = "concat('B', cast({k} % 25 as string))"
_SUB = "cast({k} % 40 as string)"
_POG = "concat('G', cast({k} - {k} % 4 as string))"


def _v(k): return _VENDOR.format(k=k)
def _m(k): return _MIXED.format(k=k)
def _s(k): return _SUPC.format(k=k)
def _b(k): return _BRAND.format(k=k)
def _c(k): return _SUB.format(k=k)
def _g(k): return _POG.format(k=k)


def _variant(i: int, name: str | None = None, key: str = "sub") -> str:
    """Cut-off columns of price variant ``i``: shares grow with the variant, some entries are missing."""
    label = name or f"concat('VAR_', cast({i} as string))"
    gm = f"cast({key} % 7 as double) / 323e0 + {i + 2}e0 / 94e0"
    gm = f"case when {key} % 11 = {i} then null else {gm} end"
    return (f"{label} as variant{i}_name, {gm} as variant{i}_min_gm_percent, "
            f"cast({key} % 4 + {3 * i} as double) as variant{i}_gm_floor, "
            f"cast({key} % 5 as double) / 587e0 + {i}e0 / 241e0 as variant{i}_nm_percent, "
            f"cast(({key} + {i}) % 2 as int) as variant{i}_adjusted")


FRAME_SQL: dict[str, str] = {
    # ---- sales -------------------------------------------------------------------------------
    "suborders": f"""
        select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as suborder_code,
               l_partkey as product_sid, l_suppkey as vendor_sid,
               cast(l_shipdate as date) as verified,
               cast(l_shipdate as date) - cast(l_orderkey % 5 as int) as created,
               cast(nullif((l_orderkey + l_linenumber) % 11, 0) as double) as closing_fee,
               cast(nullif(l_orderkey % 7, 0) as double) * 10 as fulfillment_charges,
               l_quantity as quantity
        from {{lineitem}}""",
    "suborder_params": """
        select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as suborder_code,
               case l_linenumber % 3 when 0 then 'RTO_FORWARD' when 1 then 'RPR_FORWARD' else 'OTHER' end as key,
               cast(nullif(max(l_partkey) % 60, 0) as double) as value
        from {lineitem} group by l_orderkey, l_linenumber""",
    "listings": f"""
        select l_partkey as product_sid, l_suppkey as vendor_sid,
               {_s('l_partkey')} as supc, {_v('l_suppkey')} as vendor_code,
               cast(60 + (l_partkey * 7 + l_suppkey * 13) % 2300 as double) as selling_price,
               cast(sum(l_quantity) as bigint) as inventory, count(*) * 20 as inventory_sold,
               cast((l_partkey + l_suppkey) % 9 <> 0 as int) as enabled,
               cast((l_partkey * 3 + l_suppkey) % 10 <> 0 as int) as enabled_by_seller,
               cast(l_suppkey % 13 <> 0 as int) as signature_present,
               cast(l_suppkey % 11 <> 0 as int) as gst_enabled,
               cast(l_partkey % 12 <> 0 as int) as block_inventory_enabled,
               cast(nullif(l_partkey % 5, 0) * 3 as double) as internal_cashback,
               max(cast(l_shipdate as date)) as updated
        from {{lineitem}} group by l_partkey, l_suppkey""",
    "products": f"""
        select p_partkey as product_sid, {_g('p_partkey')} as pog_id, {_c('p_partkey')} as subcategory_id,
               concat('sub ', cast(p_partkey % 40 as string)) as subcategory_name, concat('cat ', cast(p_partkey % 8 as string)) as category_name,
               cast(p_partkey % 8 as string) as category_id, p_type as new_supercategory, p_name as product_name,
               {_b('p_partkey')} as brand_id, lower(p_brand) as brand_name,
               cast(p_partkey % 5 as string) as bucket_id,
               cast(p_size * 37 as double) as pa_weight, cast(p_size as double) as pa_length,
               cast(p_partkey % 13 + 1 as double) as pa_breadth, cast(p_partkey % 17 + 1 as double) as pa_height
        from {{part}}""",
    "financials": """
        select supc, vendor_code as seller_code, selling_price - (product_sid % 4) * 5 as selling_price,
               case when product_sid % 97 = 0 then 0e0
                    else cast(floor(selling_price * (60 + (product_sid * 3 + vendor_sid) % 35) / 100) as double) end
                 as seller_price,
               cast((product_sid % 6) * 4 as double) as oneship_charges,
               cast((vendor_sid % 5) * 3 as double) as fixed_margin_amount,
               cast(20 + (product_sid % 8) * 5 as double) as fulfillment_charges,
               cast(30 + (vendor_sid % 7) * 5 as double) as logistics_cost,
               cast((product_sid % 5) * 2 as double) as closing_fee,
               cast((vendor_sid % 4) * 3 as double) as payment_collection_charges,
               cast(case when product_sid % 10 = 0 then 30 + (vendor_sid % 7) * 5
                         else 25 + (product_sid % 9) * 5 end as double) as rto_forward,
               cast(35 + (vendor_sid % 9) * 4 as double) as rpr_forward
        from {listings}""",
    "price_changes": """
        select case when (product_sid + n) % 2 = 0 then lower(supc) else supc end as supc, vendor_code,
               cast(updated - 3 * n as date) as aud_date,
               selling_price - (product_sid % 4) * 5 + ((product_sid + vendor_sid) % 3) * 10 + n as selling_price,
               cast(floor(selling_price * (55 + (product_sid + vendor_sid) % 30) / 100) as double) as seller_price,
               cast(vendor_sid % 6 as double) as fixed_margin_amount,
               cast(22 + product_sid % 9 as double) as fulfillment_charges,
               cast(31 + vendor_sid % 8 as double) as logistics_cost,
               cast(product_sid % 3 as double) as closing_fee,
               cast(vendor_sid % 3 as double) as payment_collection_charges,
               cast(27 + product_sid % 11 as double) as rto_forward,
               cast(36 + vendor_sid % 10 as double) as rpr_forward
        from (select *, 0 as n from {listings} union all select *, 1 as n from {listings} where product_sid % 10 = 0) l""",
    "snapshots": """
        select cast(l_shipdate as date) as snapshot_date, l_partkey as product_sid, l_suppkey as vendor_sid,
               cast(l_orderkey % 2 as int) as is_pushed, l_extendedprice as list_b_cb
        from {lineitem}""",
    "final_today": """
        select l_partkey as product_sid, l_suppkey as vendor_sid, cast(l_linenumber % 2 as int) as is_pushed,
               l_extendedprice as list_b_cb
        from {lineitem}""",
    "listed_pogs": f"""
        select distinct {_g('p_partkey')} as pog_id from {{part}} where p_size >= 49""",
    "vendors": f"""
        select {_m('s_suppkey')} as code, s_suppkey as vendor_sid,
               date '1998-06-30' - cast(s_suppkey * 7 % 400 as int) as created, s_nationkey
        from {{supplier}}""",
    "pog_visits": f"""
        select {_g('(user_id * 4)')} as pog_id,
               date '1998-06-01' + cast(extract(day from ts) as int) - 1 as visit_date, cast(1 as bigint) as visits
        from {{events}}""",
    # ---- exception rules, with history --------------------------------------------------------
    "subcat_rules": f"""
        select {_c('o_custkey')} as subcategory_id, cast(o_orderkey % 6 = 0 as int) as is_exception,
               cast(o_orderkey % 29 = 0 as int) as hard_exception, cast(o_orderdate as date) as updated
        from {{orders}}""",
    "subcat_vendor_rules": f"""
        select {_c('l_partkey')} as subcategory_id,
               concat(case when l_orderkey % 3 = 0 then 's' else 'S' end, lpad(cast(l_suppkey as string), 6, '0'))
                 as vendor_code,
               cast(l_orderkey % 6 = 0 as int) as is_exception, cast(l_orderkey % 29 = 0 as int) as hard_exception,
               cast(l_shipdate as date) as updated
        from {{lineitem}}""",
    "brand_rules": f"""
        select {_b('p_partkey')} as brand_id, concat('n', cast(p_partkey % 50 as string)) as brand_name,
               cast(p_partkey % 6 = 0 as int) as is_exception, cast(p_partkey % 29 = 0 as int) as hard_exception,
               date '1998-01-01' + cast(p_partkey % 365 as int) as updated
        from {{part}}""",
    "supc_vendor_rules": f"""
        select {_s('l_partkey')} as supc, {_m('l_suppkey')} as vendor_code,
               cast(l_orderkey % 6 = 0 as int) as is_exception, cast(l_orderkey % 29 = 0 as int) as hard_exception,
               cast(l_shipdate as date) as updated
        from {{lineitem}}""",
    "supc_rules": f"""
        select {_s('l_partkey')} as supc, cast(l_orderkey % 6 = 0 as int) as is_exception,
               cast(l_orderkey % 29 = 0 as int) as hard_exception, cast(l_shipdate as date) as updated
        from {{lineitem}}""",
    "vendor_rules": f"""
        select {_m('l_suppkey')} as vendor_code, cast(l_orderkey % 6 = 0 as int) as is_exception,
               case when l_orderkey % 29 = 0 then 1 when l_orderkey % 31 = 0 then 2 else 0 end as hard_exception,
               cast(l_shipdate as date) as updated
        from {{lineitem}}""",
    "brand_vendor_rules": f"""
        select {_b('l_partkey')} as brand_id, {_m('l_suppkey')} as vendor_code,
               cast(l_orderkey % 6 = 0 as int) as is_exception, cast(l_orderkey % 29 = 0 as int) as hard_exception,
               cast(l_shipdate as date) as updated
        from {{lineitem}}""",
    "brand_mandate_products": f"""
        select {_s('l_partkey')} as supc, {_m('l_suppkey')} as vendor_code,
               cast(l_orderkey % 4 = 0 as int) as cashback_enabled, cast(l_shipdate as date) as updated
        from {{lineitem}}""",
    "brand_mandate_vendors": f"""
        select {_m('s_suppkey')} as vendor_code, {_b('s_suppkey')} as brand_id,
               cast(s_suppkey % 2 as int) as enabled, date '1998-03-01' + cast(s_suppkey % 60 as int) as updated
        from {{supplier}}""",
    "previous_final": f"""
        select distinct {_s('l_partkey')} as supc, {_v('l_suppkey')} as vendor_code, {_b('l_partkey')} as brand_id
        from {{lineitem}}""",
    "bad_vendors": f"""
        select {_m('s_suppkey')} as vendor_code, cast(s_suppkey % 7 = 0 as int) as is_exception,
               cast(0 as int) as hard_exception, date '1998-02-01' as updated
        from {{supplier}}""",
    "category_requests": f"""
        select {_m('s_suppkey')} as vendor_code, cast(s_suppkey % 5 = 0 as int) as cashback_enabled,
               date '1998-04-01' as updated
        from {{supplier}}""",
    "price_drop_vendors": f"""
        select {_m('s_suppkey')} as vendor_code, cast(s_suppkey % 6 = 0 as int) as cashback_enabled,
               date '1998-04-01' as updated
        from {{supplier}}""",
    "seller_bids": f"""
        select {_m('s_suppkey')} as vendor_code, date '1998-05-01' as start_date,
               case when s_suppkey % 3 = 0 then date '1998-05-31' else date '1998-07-15' end as end_date,
               cast((s_suppkey % 8) * 1000000 as double) as bid
        from {{supplier}}""",
    "high_cb_pogs": f"""
        select distinct {_g('p_partkey')} as pog_id from {{part}} where p_size >= 40""",
    # ---- cut-offs, factors and terms ------------------------------------------------------------
    "cutoff_bands": f"""
        select cast(sub as string) as subcategory_id, lo as from_price, hi as to_price,
               {_variant(1, "case when sub % 13 = 0 then null else 'VAR_1' end")}, {_variant(2)},
               {_variant(3, "case when sub % 3 = 0 then 'TAGGED' else 'VAR_3' end")}, {_variant(4)},
               {_variant(5, "case when sub % 4 = 0 then 'TAGGED' else 'VAR_5' end")}, {_variant(6)}
        from (select distinct p_partkey % 40 as sub, 0e0 as lo, 400e0 as hi from {{part}}
              union all select distinct p_partkey % 40, 400e0, 1000e0 from {{part}}
              union all select distinct p_partkey % 40, 1000e0, 99999e0 from {{part}}) s""",
    "cutoff_bands_old": f"""
        select cast(sub as string) as subcategory_id, lo as from_price, hi as to_price,
               {_variant(7)}, {_variant(8)}
        from (select distinct p_partkey % 40 as sub, 0e0 as lo, 700e0 as hi from {{part}}
              union all select distinct p_partkey % 40, 701e0, 99999e0 from {{part}}) s""",
    "reduce_sp": f"""
        select {_v('s_suppkey')} as vendor_code, nullif(cast(s_suppkey % 4 as double) / 233e0, 0e0) as reduce_sp_pct
        from {{supplier}}""",
    "gm_movement": f"""
        select distinct {_c('l_partkey')} as subcategory_id, {_v('l_suppkey')} as vendor_code,
               cast((l_partkey % 40 + l_suppkey) % 3 as double) * 0.01e0 as cm_gm_movement_pct
        from {{lineitem}}""",
    "return_factors": f"""
        select distinct {_c('p_partkey')} as subcategory_id,
               case when p_partkey % 40 = 17 then null else cast(p_partkey % 10 as double) * 0.01e0 + 0.0513e0 end
                 as rto_factor,
               cast(p_partkey % 40 % 6 as double) * 0.01e0 + 0.0207e0 as rpr_factor
        from {{part}}""",
    "active_bids": f"""
        select cast(l_shipdate as date) as active_day, {_m('l_suppkey')} as seller_code, {_s('l_partkey')} as supc,
               cast((l_orderkey % 9 + 1) * 100000 as double) as bid
        from {{lineitem}}""",
    "ro_terms": f"""
        select {_b('s_suppkey')} as brand_id, {_m('s_suppkey')} as seller_code,
               case when s_suppkey % 3 = 0 then 'GSV' when s_suppkey % 3 = 1 then 'LSM' else 'NONE' end as ro_type,
               case when s_suppkey % 2 = 0 then 'DEL' else 'Ship' end as rule,
               cast(s_suppkey % 6 + 1 as double) as amount, 0.0213e0 as ratio,
               date '1998-01-01' as ro_start_date,
               case when s_suppkey % 10 = 9 then date '1998-03-31' else date '1998-12-31' end as ro_end_date
        from {{supplier}}""",
    "monetisation": f"""
        select {_s('l_partkey')} as supc, {_m('l_suppkey')} as vendor_code,
               cast(l_linenumber as string) as ro_number, cast(l_partkey % 30 as double) as cash_back,
               cast(l_shipdate as date) - 3 as start_date, cast(l_shipdate as date) + 40 as end_date,
               case when l_suppkey % 3 = 0 then 'no' else 'Yes' end as include_algo_cb,
               case when l_linenumber % 2 = 1 then 'Non-SLI' else 'SLI' end as flag
        from {{lineitem}}""",
    "private_label": f"""
        select distinct {_s('l_partkey')} as supc, {_m('l_suppkey')} as vendor_code,
               case when l_linenumber % 2 = 1 then 'BAU' else 'Sale' end as period,
               cast(case when l_partkey % 5 = 0 then 50 + l_partkey % 200 else 0 end as double) as desired_op,
               cast(10 + l_partkey % 25 as double) as new_cbpu
        from {{lineitem}}""",
    "category_groups": f"""
        select distinct {_c('p_partkey')} as subcategory_id, cast(p_partkey % 40 % 4 as string) as category_group,
               case when p_partkey % 40 % 3 = 0 then 'Yes' else 'No' end as is_core,
               case when p_partkey % 40 % 5 = 0 then null when p_partkey % 40 % 2 = 0 then 'elastic' else 'inelastic' end as elasticity_tag,
               cast(p_partkey % 40 % 7 as double) / 10e0 as elasticity_pct
        from {{part}}""",
    "op_cutoffs": f"""
        select distinct {_c('p_partkey')} as subcategory_id, cast(p_partkey % 5 as string) as bucket_id,
               cast(nullif(p_partkey % 40 % 5, 4) * 10 + 99 as double) as bau_price,
               cast(nullif(p_partkey % 40, 33) + 49 as double) as sale_price
        from {{part}}""",
    "disablement": f"""
        select l_partkey as product_sid, l_suppkey as vendor_sid, {_m('l_suppkey')} as seller_code,
               lower({_s('l_partkey')}) as supc,
               case when l_suppkey % 4 = 0 then 'disable' else 'keep' end as new_logic_status,
               case when l_suppkey % 4 = 0 then 'returns' when l_partkey % 3 = 0 then 'stock' end as new_logic_reason,
               case l_suppkey % 5 when 0 then 'Red' when 1 then 'Yellow-Bad' when 2 then 'Yellow-Good'
                    when 3 then 'Green' end as seller_zone
        from {{lineitem}}""",
    "price_match_list": """
        select case when n = 0 then lower(supc) else supc end as supc, case when n = 0 then vendor_code else lower(vendor_code) end as vendor_code,
               case when product_sid % 6 = 0 then null else selling_price - product_sid % 90 - 3 * n end as rival_a_price,
               case when vendor_sid % 7 = 0 then null else selling_price - vendor_sid % 60 + n end as rival_b_price
        from (select *, 0 as n from {listings} where product_sid % 3 < 2 union all select *, 1 as n from {listings} where product_sid % 9 = 0) l""",
    "deals": f"""
        select {_s('l_partkey')} as supc, {_v('l_suppkey')} as vendor_code,
               min(cast(nullif(l_partkey % 5, 0) as double)) * 40 + 99 as deal_op,
               min(cast(l_shipdate as date)) as start_date, max(cast(l_shipdate as date)) + 10 as end_date
        from {{lineitem}} group by l_partkey, l_suppkey, l_linenumber % 2""",
    # ---- small policy tables, one row per combination of flags ----------------------------------
    "pushed_status": """
        select distinct cast(v % 2 as int) as is_enabled, cast(floor(v / 2) as int) % 2 as is_enabled_with_inv,
               cast(floor(v / 4) as int) % 2 as sold_30_flag, cast(floor(v / 8) as int) % 2 as sold_7_flag,
               cast(floor(v / 16) as int) % 2 as top_vendor, cast(floor(v / 32) as int) % 2 as category_cb_push,
               cast(v % 3 <> 0 as int) as is_pushed
        from (select p_partkey % 64 as v from {part}) c""",
    "exception_mapping": """
        select distinct cast(v % 2 as int) as is_exception, cast(floor(v / 2) as int) % 2 as brand_mandate_exception,
               cast(floor(v / 4) as int) % 2 as is_hard_exception, cast(floor(v / 8) as int) % 2 as bad_seller,
               case cast(floor(v / 16) as int) % 3 when 0 then 'Yes' when 1 then 'No' else 'Other' end
                 as sale_participation,
               cast(floor(v / 48) as int) % 2 as price_drop_vendor, cast(floor(v / 96) as int) % 2 as high_cb_pog,
               case when v % 7 in (0, 3) then 'No_CB' when v % 7 = 5 then 'OTHER' else 'SALE_CB' end as sale_variant,
               case when v % 5 = 0 then 'No_CB' when v % 5 = 4 and v % 3 = 0 then 'OTHER' else 'BAU_CB' end
                 as non_sale_variant
        from (select p_partkey % 192 as v from {part}) c""",
    "price_points": """
        select distinct lo as rounding, lo + 20 as rounding_1, lo + 40 as rounding_2,
               case when i % 5 = 0 then null else lo + 55 end as rounding_3,
               case when i % 5 = 0 then null else lo + 70 end as rounding_4, lo + 96 as rounding_next
        from (select p_partkey % 20 as i, cast(79 + (p_partkey % 20) * 96 as double) as lo from {part}) g""",
    "competitor_prices": f"""
        select {_g('p_partkey')} as pog, case p_partkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'OWN' else 'C' end
                 as store,
               cast(60 + (p_partkey * 7) % 2300 as double) as selling_price
        from {{part}}""",
    "step_log": """
        select concat('Step', cast(o_custkey % 10 + 1 as string)) as stepname, o_orderdate as starttime,
               o_orderdate + make_interval(0, 0, 0, 0, 0, cast(o_orderkey % 180 as int)) as endtime
        from {orders}""",
    # ---- returns, delivery and propensity ---------------------------------------------------------
    "returns": """
        select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity,
               concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as code,
               cast(l_shipdate as date) as order_date,
               case when l_partkey % 23 = 0 then null else cast(l_partkey % 40 as string) end as subcategory_id,
               case when l_partkey % 19 = 0 then null else cast(l_partkey as string) end as dest_pincode,
               case l_suppkey % 6 when 0 then 'air' when 1 then 'road' when 2 then 'rail' when 3 then 'sea'
                    when 4 then 'local' end as courier_group,
               cast(l_returnflag = 'R' as int) as rto,
               cast(l_orderkey % 9 as double) as user_del_ship, cast(l_orderkey % 4 as double) as user_del,
               cast(l_partkey % 12 as double) as pin_att_14, cast(l_partkey % 12 * 3 % 7 as double) as pin_del_14,
               cast(l_suppkey % 8 as double) as city_att_14, cast(l_suppkey % 5 as double) as city_del_14,
               cast(nullif(l_linenumber % 3, 0) - 1 as double) as same_supc_dup,
               cast(nullif(l_linenumber % 5, 0) - 1 as double) as same_subcat_dup,
               cast(l_orderkey % 4 <> 3 as int) as is_cod,
               cast((l_orderkey * 37 + l_linenumber * 11 + l_partkey * 13) % 1001 as double) / 1000 as score
        from {lineitem}""",
    "deliveries": """
        select l_orderkey, l_linenumber,
               l_shipdate + make_interval(0, 0, 0, 0, cast((l_orderkey * 5 + l_linenumber) % 24 as int), 0)
                 as order_created_time,
               cast((l_orderkey + l_linenumber * 3 + l_partkey) % 18 + 1 as int) as o2a,
               cast((l_orderkey * 13 + l_partkey) % 140 as double) / 10 + 0.25e0 as raw_prediction,
               concat('c', cast(l_suppkey % 30 as string)) as oc, concat('c', cast(l_partkey % 50 as string)) as dc,
               concat('s', cast(l_suppkey % 6 as string)) as os,
               case when l_partkey % 50 % 9 = 8 then null else concat('s', cast(l_partkey % 50 % 9 as string)) end as ds,
               concat('g', cast(l_suppkey % 4 as string)) as courier_group,
               cast(nullif(l_partkey % 50, 7) as double) as dc_o2a_7, cast(l_suppkey % 30 as double) as oc_o2a_7
        from {lineitem}""",
    "devices": """
        select user_id, concat('dev-', cast(user_id as string)) as device_id,
               cast(min(ts) as date) - cast(user_id % 90 as int) as install_date,
               max(case when ts < timestamp '2024-01-20 00:00:00' then cast(ts as date) end) as visit_date,
               max(case when ts < timestamp '2024-01-20 00:00:00' and event_type = 'purchase'
                        then cast(ts as date) end) as last_order_date,
               min(case when ts >= timestamp '2024-01-20 00:00:00' and event_type = 'purchase'
                        then cast(ts as date) end) as next_order_date,
               nullif(count(case when event_type = 'click' then 1 end) % 4, 0) as search_events,
               count(case when event_type = 'view' then 1 end) as visits,
               nullif(count(case when event_type = 'error' then 1 end) % 5, 0) as days_since_search,
               round(sum(value), 2) as paid_amount,
               case cast(user_id % 5 as int) when 0 then 'organic' when 1 then 'push' when 2 then 'sem'
                    when 3 then 'affiliate' end as install_channel
        from {events} group by user_id""",
    "sale_calendar": """
        select distinct cast(ts as date) as cal_date, cast(extract(day from ts) % 7 = 0 as int) as sale_day
        from {events} where extract(day from ts) <> 13""",
}


def _deps(text: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", text)


class Frames:
    """Benchmark tables and domain frames of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in self._built:
            return self._built[name]
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in FRAME_SQL:
            text = FRAME_SQL[name]
            df = self.spark.sql(text, **{d: getattr(self, d) for d in set(_deps(text))})
        else:
            raise AttributeError(name)
        self._built[name] = df
        return df


def ddb(body: str, **ctes: str) -> str:
    """DuckDB text with every domain frame the body names put in front as a CTE.

    ``ctes`` are extra named steps, in order; they may use the frames and each other.
    """
    order: list[str] = []

    def need(name: str) -> None:
        for dep in _deps(FRAME_SQL[name]):
            if dep in FRAME_SQL:
                need(dep)
        if name not in order:
            order.append(name)

    for step in [*ctes.values(), body]:
        for name in FRAME_SQL:
            if re.search(rf"\b(from|join|in)\s+\(?{name}\b", step):
                need(name)
    parts = [f"{n} as ({_duck(FRAME_SQL[n])})" for n in order]
    # Steps of a long chain are kept as tables, or the database copies their formulas into every filter above.
    parts += [f"{n} as {'materialized ' if len(ctes) > 5 else ''}({text})" for n, text in ctes.items()]
    return (f"with {', '.join(parts)} " if parts else "") + body


def _duck(text: str) -> str:
    text = re.sub(r"\{(\w+)\}", r"\1", text)
    return re.sub(r"make_interval\(0, 0, 0, 0, (.+?), (.+?)\)(?=\s+as |\n)", _interval, text)


def _interval(m: re.Match) -> str:
    hours, minutes = m.group(1), m.group(2)
    return f"to_hours({hours}) + to_minutes({minutes})"
