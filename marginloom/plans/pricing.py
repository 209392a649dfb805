"""Staged cashback pricing: from sub-orders and listings to ten price lists with push flags.

Every stage is a function of DataFrames; ``run`` chains them and writes them. Rule tables of one key are stacked and
aggregated once per key, so that the listings take one join per key set.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginloom.functions import scalars as S
from marginloom.operators import aggregates as A
from marginloom.operators import joins as J
from marginloom.operators import updates as U
from marginloom.operators import windows as W
from marginloom.session import shared_dir
from marginloom.sources.snapshots import commit_snapshot
from marginloom.sources.tables import delete_where, staged

PAIR = ["product_sid", "vendor_sid"]
LISTS = tuple("abcdefghij")

# Fixed values of the pricing rules.
TAX = 1.18                      # goods and services tax factor
BID_SCALE = 1e8                 # bids are stored as millionths of a percent
ACTIVE_BID_SHARE = 0.82         # part of an active bid that counts as income
SLAB_STEP, SLAB_CAP = 30, 9     # shipping allowance per weight slab, and slabs that add to it
ROUND_FROM, ROUND_TO = 79, 1999  # prices outside are not moved to price points
MATCH_BASE = 60                 # fulfilment cost of the first slab in price matching
LOW_BID, MID_PRICE = 0.03, (200, 600)  # low bidders in this price range get the general sale cashback
DEFAULT_OP = {"bau_op": 99.0, "sale_op": 1.0}
PRICE_BANDS = [(200, "a_0 to 200"), (400, "b_200 to 400"), (600, "c_400 to 600"), (800, "d_600 to 800"),
               (1000, "e_800 to 1000")]
# Cashback column -> price variant; columns with the same variant and formula are computed once.
BASE_VARIANTS = {"base_cb": 1, "base_cb1": 2, "base_cb2": 7, "base_cb3": 8, "base_cb4": 2, "base_cb5": 2}
SALE_VARIANTS = {"sale1_cb": 3, "sale2_cb": 4, "sale3_cb": 5, "sale4_cb": 6}
SAME_AS = {"base_cb4": "base_cb1", "base_cb5": "base_cb1"}


@dataclass(frozen=True)
class Policy:
    """Business lists and switches that are data, not code."""

    listed_vendors: Sequence[str] = ()       # vendors on the fixed list policy
    addon_vendors: Sequence[str] = ()        # vendors with the extra sale percentage
    addon_rate: float = 0.11
    bid_tag: str = "TAGGED"                  # variant name that passes the bid on to the buyer
    hidden_supercategories: Sequence[str] = ()
    hidden_subcategories: Sequence[str] = ()
    top_vendors: int = 3000
    vendor_limit: int = 25000
    fee_days: int = 30
    live_days: int = 360
    new_vendor_days: int = 60
    visit_days: int = 2
    live_since: dt.date | None = None        # candidate sub-orders from this day on


# ---- step 1: universe, fees, vendors, financials ------------------------------------------------------


def candidate_universe(suborders: DataFrame, history: DataFrame, current: DataFrame, listings: DataFrame,
                       products: DataFrame, listed_pogs: DataFrame, since: dt.date) -> DataFrame:
    """Pairs sold since a day, pushed before or now, or of a listed product group."""
    sold = suborders.where(F.col("verified") >= F.lit(since)).select(*PAIR)
    pushed = [d.where("is_pushed = 1").select(*PAIR) for d in (history, current)]
    group = products.join(listed_pogs.select("pog_id"), "pog_id", "left_semi").select("product_sid")
    listed = listings.join(group, "product_sid", "left_semi").select(*PAIR)
    out = sold
    for part in (*pushed, listed):
        out = out.unionByName(part)
    return out.distinct()


def latest_fees(suborders: DataFrame, params: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Fees of the newest sub-order per pair. The newest row is chosen first, then its parameters are looked up."""
    recent = suborders.where(F.col("verified") >= F.lit(as_of - dt.timedelta(days=days)))
    newest = W.latest_values(recent, PAIR, ["verified", "created", "suborder_code", "closing_fee", "fulfillment_charges"],
                             ["suborder_code", "closing_fee", "fulfillment_charges"])
    charged = J.kv_left_join(newest, params, "suborder_code", {"RTO_FORWARD": "rto_charge", "RPR_FORWARD": "rpr_charge"})
    return charged.fillna(0.0, ["rto_charge", "rpr_charge"]).drop("suborder_code")


def eligible_vendors(listings: DataFrame, suborders: DataFrame, as_of: dt.date, top: int = 3000,
                     limit: int = 25000) -> DataFrame:
    """Best sellers of the last 15 days among vendors below the enabled-listing limit."""
    live = ((F.col("enabled") == 1) & (F.col("enabled_by_seller") == 1) & (F.col("signature_present") == 1)
            & (F.col("gst_enabled") == 1) & (F.col("inventory") - F.col("inventory_sold") > 0))
    sized = listings.groupBy("vendor_sid").agg(F.count(F.when(live, 1)).alias("enabled_listings")) \
        .where(F.col("enabled_listings") < limit).select("vendor_sid")
    recent = suborders.where(F.col("verified") >= F.lit(as_of - dt.timedelta(days=15)))
    sold = A.count_distinct_by_key(recent, ["vendor_sid"], "suborder_code", "subos")
    ranked = W.top_n(sold.join(sized, "vendor_sid", "left_semi"), [F.desc("subos"), F.asc("vendor_sid")], top)
    return ranked.select("vendor_sid", "subos")


PRICE_COLUMNS = ("selling_price", "seller_price", "fixed_margin_amount", "fulfillment_charges", "logistics_cost",
                 "closing_fee", "payment_collection_charges", "rto_forward", "rpr_forward")


def financial_override(financials: DataFrame, changes: DataFrame, as_of: dt.date) -> DataFrame:
    """Recalculated prices where the selling price changed; yesterday's change rows are dropped first."""
    kept = delete_where(changes, F.col("aud_date") == F.lit(as_of - dt.timedelta(days=1)))
    return J.update_from(financials, kept, {"supc": "supc", "seller_code": "vendor_code"},
                         {c: F.col(f"src_{c}") for c in PRICE_COLUMNS},
                         when=F.col("selling_price") != F.col("src_selling_price"), casefold=True, newest_first=[F.desc_nulls_last("aud_date")],
                         deal="supc")


# ---- step 2: listing base ---------------------------------------------------------------------------------


def pog_sales(suborders: DataFrame, products: DataFrame, as_of: dt.date) -> DataFrame:
    sold = suborders.where(F.col("verified").between(F.lit(as_of - dt.timedelta(days=30)), F.lit(as_of - dt.timedelta(days=1))))
    grouped = sold.select("product_sid", "suborder_code", "verified").join(
        products.select("product_sid", "pog_id"), "product_sid", "left")
    return A.trailing_sales(grouped, ["pog_id"], "suborder_code", "verified", as_of, [7, 30], prefix="pog")


def listing_base(listings: DataFrame, financials: DataFrame, products: DataFrame, fees: DataFrame, pair_sales: DataFrame,
                 group_sales: DataFrame, universe: DataFrame, beside: DataFrame | None = None) -> DataFrame:
    """Listings of the universe with prices, fees, weight slab, margin share, stock flags and recent sales.

    The universe, fees and pair sales share the listing's own key, so they meet in one partitioning and
    cut the rows down before the wider joins; so does ``beside``, if given, whose columns are carried along. Products and prices come last
    and are also joined by the folded item: ``financial_override`` leaves the prices by it, the products, which are fewer than the listings, are
    dealt by it, so the rows move once for both and for lookups by item. Group sales meet the products.
    """
    # Only the five switches and the stock comparison are needed from the inventory columns.
    switches = sum((F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)) for c in (
        "enabled_by_seller", "signature_present", "gst_enabled", "block_inventory_enabled")),
        F.coalesce((F.col("enabled") == 1).cast("int"), F.lit(0)))
    vip = listings.select(
        "supc", "vendor_code", *PAIR, F.col("selling_price").alias("vip_selling_price"),
        (switches == 5).cast("int").alias("is_enabled"),
        ((switches == 5) & S.is_true(F.col("inventory") > F.col("inventory_sold"))).cast("int").alias("is_enabled_with_inv"),
        S.nz("internal_cashback").alias("vip_cashback"), F.col("updated").alias("vip_updated"))
    priced = financials.select(
        F.col("supc").alias("_s"), F.col("seller_code").alias("_v"), "selling_price", "seller_price", "oneship_charges",
        "fixed_margin_amount", F.col("fulfillment_charges").alias("_fulfillment"), "logistics_cost",
        F.col("closing_fee").alias("_closing"), "payment_collection_charges", "rto_forward", "rpr_forward")
    same = [F.col("supc") == F.col("_s"), F.col("vendor_code") == F.col("_v"),
            F.lower("supc") == F.lower("_s"), F.lower("vendor_code") == F.lower("_v")]
    joined = vip.join(universe, PAIR).join(fees, PAIR, "left").join(pair_sales, PAIR, "left")
    carried = [c for c in beside.columns if c not in PAIR] if beside is not None else []
    if carried:
        joined = joined.join(beside, PAIR, "left")
    items = listings.select(F.lower("supc").alias("_i"), F.col("product_sid").alias("_p")).distinct()
    described = items.join(products.join(group_sales, "pog_id", "left"), F.col("_p") == F.col("product_sid")).drop("product_sid")
    # the projection keeps the planner from dealing them by more columns than the prices
    described = described.repartition("_i").select(
        *[c for c in described.columns if not c.startswith(("pa_", "pog_7", "pog_30"))],
        S.volumetric_slab("pa_weight", "pa_length", "pa_breadth", "pa_height").alias("slab"),
        S.nz("pog_7_flag", 0).alias("sold_7_flag"), S.nz("pog_30_flag", 0).alias("sold_30_flag"),
        S.nz("pog_7", 0).alias("last_7_day_pog_sale"), S.nz("pog_30", 0).alias("last_30_day_pog_sale"))
    joined = joined.join(described, [F.lower("supc") == F.col("_i"), F.col("product_sid") == F.col("_p")]).join(priced, same).drop("_s", "_v", "_i", "_p")
    rto_default = F.when(F.col("rto_forward") == F.col("logistics_cost"), 0.0).otherwise(F.col("rto_forward"))
    return joined.select(
        "supc", "vendor_code", *PAIR, "pog_id", "bucket_id", "subcategory_id", "subcategory_name", "category_id", "category_name", "new_supercategory",
        "product_name", "brand_id", "brand_name", "vip_selling_price", "selling_price", "seller_price", "oneship_charges",
        "fixed_margin_amount", F.coalesce("fulfillment_charges", "_fulfillment").alias("fulfillment_charges"),
        "logistics_cost", F.coalesce("closing_fee", "_closing").alias("closing_fee"), "payment_collection_charges",
        F.coalesce("rto_charge", rto_default).alias("rto_charge"), F.coalesce("rpr_charge", "rpr_forward").alias("rpr_charge"),
        "slab", ((F.col("selling_price") - F.col("seller_price")) / TAX).alias("share"),
        "is_enabled", "is_enabled_with_inv", "vip_cashback", "vip_updated",
        "sold_7_flag", "sold_30_flag", "last_7_day_pog_sale", "last_30_day_pog_sale",
        S.nz("pair_7", 0).alias("last_d7_sale"), S.nz("pair_15", 0).alias("last_d15_sale"),
        S.band_label("selling_price", PRICE_BANDS, "f_1000+", "unknown").alias("price_bucket"), *carried)


# ---- steps 3 and 4: rules and exception flags ------------------------------------------------------------


def latest_rules(rules: DataFrame, keys: Sequence[str], prefix: str, vendor: str | None = None) -> DataFrame:
    """Newest rule per raw key with its two flags as ``<prefix>_is`` and ``<prefix>_hard``.

    Codes are canonicalised after the choice, so spellings of one vendor may leave several rules for it.
    """
    newest = W.dedup_latest(rules, keys, ["updated", "is_exception", "hard_exception"])
    out = [S.canonical_code(k).alias(k) if k == vendor else F.col(k) for k in keys]
    return newest.select(*out, F.col("is_exception").alias(f"{prefix}_is"), F.col("hard_exception").alias(f"{prefix}_hard"))


def latest_requests(requests: DataFrame, keys: Sequence[str], flag: str, name: str, vendor: str = "vendor_code") -> DataFrame:
    newest = W.dedup_latest(requests, keys, ["updated", flag])
    return newest.select(*[S.canonical_code(k).alias(k) if k == vendor else F.col(k) for k in keys], F.col(flag).alias(name))


def brand_mandates(products: DataFrame, vendor_brands: DataFrame, previous: DataFrame) -> DataFrame:
    """Requests per item and vendor, plus vendor-brand requests spread over yesterday's items.

    Items that no request concerns go first, which a broadcast does ahead of yesterday's own distinct.
    """
    asked = vendor_brands.select(F.lower("vendor_code").alias("_fv"), F.lower("brand_id").alias("_fb"))
    previous = previous.join(asked, (F.lower("vendor_code") == F.col("_fv")) & (F.lower("brand_id") == F.col("_fb")), "left_semi")
    spread = J.casefold_join(vendor_brands.select("vendor_code", "brand_id", "enabled", "updated"),
                             previous.select("supc", F.col("vendor_code").alias("_v"), F.col("brand_id").alias("_b")),
                             [("vendor_code", "_v"), ("brand_id", "_b")])
    keys = ["supc", "vendor_code"]
    direct = latest_requests(products, keys, "cashback_enabled", "brand_mandate")
    return direct.unionByName(latest_requests(spread, keys, "enabled", "brand_mandate"))


def category_request_profile(requests: DataFrame, vendors: DataFrame, as_of: dt.date, new_days: int = 60) -> DataFrame:
    asked = latest_requests(requests, ["vendor_code"], "cashback_enabled", "category_request")
    fresh = vendors.where(F.col("created") >= F.lit(as_of - dt.timedelta(days=new_days))).select(
        S.canonical_code("code").alias("vendor_code"), F.lit(1).alias("category_request"))
    return asked.unionByName(fresh).distinct()


def sale_participants(bids: DataFrame) -> DataFrame:
    return J.latest_batch(bids, "end_date").select(S.canonical_code("vendor_code").alias("vendor_code"),
                                                   F.lit("Yes").alias("participation")).distinct()


def live_offers(offers: DataFrame, as_of: dt.date, flag: str = "Non-SLI") -> DataFrame:
    """Latest running monetisation offers per item and vendor; offers with the same start are all kept."""
    running = J.valid_on(offers.where(F.col("flag") == flag), as_of, "start_date", "end_date")
    add = F.col("include_algo_cb")
    clean = running.select("supc", S.canonical_code("vendor_code").alias("vendor_code"), "ro_number", "cash_back",
                           "start_date", "end_date",
                           F.when(F.substring(add, 1, 1) == "n", F.initcap(add)).otherwise(add).alias("motz_add")).distinct()
    return W.keep_top_ties(clean, [F.lower("supc"), F.lower("vendor_code")], ["start_date"]) \
        .select("supc", "vendor_code", "cash_back", "motz_add").distinct()


def private_targets(targets: DataFrame, period: str, prefix: str) -> DataFrame:
    return targets.where(F.col("period") == period).select(
        "supc", S.canonical_code("vendor_code").alias("vendor_code"), F.col("desired_op").alias(f"{prefix}_op"),
        F.col("new_cbpu").alias(f"{prefix}_cb"))


SCOPES = ("sub", "sv", "br", "el", "sel", "vel", "bvl")
SCOPE_NAMES = {"sub": "subcategory_exception", "sv": "subcat_vendor_exception", "br": "brand_exception",
               "el": "supc_vendor_exception", "sel": "supc_exception", "vel": "vendor_exception",
               "bvl": "brand_vendor_exception"}


#: Lookups and the column by which their rows are dealt, which their neighbours have too; ``_sf`` is the folded item.
DEAL = {("supc",): ["_sf"], ("supc", "vendor_code"): ["_sf"],
        ("brand_id", "vendor_code"): ["vendor_code"], ("subcategory_id", "vendor_code"): ["vendor_code"]}
#: Lookups whose rows per item or vendor are few: hashed, so that the wide rows aren't sorted for them.
HASHED = (("supc",), ("vendor_code",), ("brand_id", "vendor_code"), ("subcategory_id", "vendor_code"))


@dataclass
class Profiles:
    """Lookup frames by join key of the listing base."""

    by_key: list[tuple[tuple[str, ...], list[DataFrame]]] = field(default_factory=list)
    bids: DataFrame | None = None
    active: DataFrame | None = None
    terms: DataFrame | None = None
    bands: DataFrame | None = None
    bands_old: DataFrame | None = None
    pogs: DataFrame | None = None


def build_profiles(t, as_of: dt.date, policy: Policy, top_vendors: DataFrame) -> Profiles:
    """All rule tables of ``t`` (attribute access by table name), grouped by key."""
    # In the order of the joins. Neighbours share a key column (``DEAL``), so the wide rows lie by item as the prices left them
    # and move once, for vendors. Equal rows of a table are left to ``fold_rules``.
    exact = {
        ("product_sid", "vendor_sid"): [t.disablement.select(*PAIR, "new_logic_status", "new_logic_reason", "seller_zone")],
        ("supc",): [latest_rules(t.supc_rules, ["supc"], "sel")],
        ("supc", "vendor_code"): [
            latest_rules(t.supc_vendor_rules, ["supc", "vendor_code"], "el", "vendor_code"),
            brand_mandates(t.brand_mandate_products, t.brand_mandate_vendors, t.previous_final),
            live_offers(t.monetisation, as_of),
            private_targets(t.private_label, "BAU", "bau"), private_targets(t.private_label, "Sale", "sale")],
        ("vendor_code",): [
            latest_rules(t.vendor_rules, ["vendor_code"], "vel", "vendor_code"),
            t.bad_vendors.select(S.canonical_code("vendor_code").alias("vendor_code"), F.col("is_exception").alias("bad_seller")),
            sale_participants(t.seller_bids),
            category_request_profile(t.category_requests, t.vendors, as_of, policy.new_vendor_days),
            latest_requests(t.price_drop_vendors, ["vendor_code"], "cashback_enabled", "price_drop"), t.reduce_sp],
        ("brand_id", "vendor_code"): [latest_rules(t.brand_vendor_rules, ["brand_id", "vendor_code"], "bvl", "vendor_code")],
        ("vendor_sid",): [top_vendors.select("vendor_sid", F.lit(1).alias("top_vendor"))],
        ("subcategory_id",): [latest_rules(t.subcat_rules, ["subcategory_id"], "sub"), t.return_factors, t.category_groups],
        ("subcategory_id", "bucket_id"): [t.op_cutoffs],
        # Rules are kept per brand id and name but looked up by id alone.
        ("brand_id",): [latest_rules(t.brand_rules, ["brand_id", "brand_name"], "br").drop("brand_name")],
        ("subcategory_id", "vendor_code"): [
            latest_rules(t.subcat_vendor_rules, ["subcategory_id", "vendor_code"], "sv", "vendor_code"), t.gm_movement],
    }
    yesterday = as_of - dt.timedelta(days=1)
    return Profiles(
        by_key=list(exact.items()),
        bids=J.latest_batch(t.seller_bids, "end_date").select("vendor_code", "bid").distinct(),
        active=W.best_bid(t.active_bids, "active_day", yesterday, ["seller_code", "supc"], "bid")
        .select("supc", "seller_code", F.col("bid").alias("active_bid")),
        terms=J.valid_on(t.ro_terms, yesterday, "ro_start_date", "ro_end_date")
        .select("brand_id", "seller_code", "ro_type", "rule", "amount", "ratio").distinct(),
        bands=t.cutoff_bands, bands_old=t.cutoff_bands_old, pogs=t.high_cb_pogs)


def _held(keys: Sequence[str]) -> str:
    return "_r_" + "_".join(keys)


def _lookups(p: Profiles) -> list[tuple[tuple[str, ...], list[DataFrame]]]:
    """All lookups by their keys, in the order of the joins; ``_sf`` and ``_vf`` are the folded item and vendor.

    Those by the folded pair follow those by the pair, whose order of the rows serves both.
    """
    seller = F.lower("seller_code").alias("_vf")
    active = (("_sf", "_vf"), [p.active.select(F.lower("supc").alias("_sf"), seller, "active_bid")])
    after = [k for k, _ in p.by_key].index(("supc", "vendor_code")) + 1 if ("supc", "vendor_code") in dict(p.by_key) else 0
    return [(("_vf",), [p.bids.select(F.lower("vendor_code").alias("_vf"), "bid")]),
            (("brand_id", "_vf"), [p.terms.select("brand_id", seller, "ro_type", "rule", "amount", "ratio")]),
            *p.by_key[:after], active, *p.by_key[after:]]


#: What a looked-up column counts as where there is no rule or the rule holds a NULL.
MISSING = {**{f"{s}_hard": 0 for s in SCOPES}, "brand_mandate": 0, "bad_seller": 0, "participation": "Other", "top_vendor": 0,
           "category_request": 0, "price_drop": 0, "cash_back": 0.0, "motz_add": "No", "bau_op": 0.0, "bau_cb": 0.0, "sale_op": 0.0,
           "sale_cb": 0.0, "bau_price": DEFAULT_OP["bau_op"], "sale_price": DEFAULT_OP["sale_op"]}
#: Lookups of which a row shows an amount that also depends on its prices and factors.
AMOUNTS = (("_sf", "_vf"), ("brand_id", "_vf"))


def _folded(keys: tuple[str, ...], frames: Sequence[DataFrame], shown: bool = False) -> tuple[list[str], DataFrame]:
    """(join columns, one row per key with its rules as an array); with ``shown`` only what a flagged row shows of them."""
    deal, on = DEAL.get(keys, ["_sf"] if "_sf" in keys else []), list(keys)
    if "_sf" in deal and "_sf" not in keys:
        folded = {"_sf": F.lower("supc"), **({"_vf": F.lower("vendor_code")} if "vendor_code" in keys else {})}
        frames, on = [f.withColumns(folded) for f in frames], [*folded, *keys]
    out = J.fold_rules(frames, on, deal, nested=_held(keys))
    if shown and keys not in AMOUNTS:
        out = _shown(out, _held(keys))
    return on, out.hint("shuffle_hash") if keys in HASHED else out


def _shown(folded: DataFrame, held: str) -> DataFrame:
    """A key's rules reduced to those that a row can tell apart: NULLs are what they count as, and a negative zero is a zero.

    Rules that differ in nothing but the mark of an exception become one, which says whether a rule with the mark (``_any``) and one
    without it (``_none``) is among them. As no two are alike, the choices among several keys' rules aren't either.
    """
    fields, rules = folded.schema[held].dataType.elementType.fields, F.col(held)
    marks = [f.name for f in fields if f.name in {f"{s}_is" for s in SCOPES}]
    doubles = [f.name for f in fields if f.dataType.typeName() == "double"]
    names = [f.name for f in fields if f.name not in marks]
    if not marks and not doubles and not any(n in MISSING for n in names):
        return folded

    def plain(x: Column) -> list[Column]:
        values = {n: x[n] + F.lit(0.0) if n in doubles else x[n] for n in names}
        return [(F.coalesce(c, F.lit(MISSING[n])) if n in MISSING else c).alias(n) for n, c in values.items()]

    def marked(x: Column) -> Column:
        return S.nz(x[marks[0]], 0) == 1

    one = F.get(rules, F.lit(0))
    single, several = plain(one), F.array_distinct(F.transform(rules, lambda x: F.struct(*plain(x))))
    if marks:
        single += [marked(one).alias("_any"), (~marked(one)).alias("_none")]
        alike = lambda x, r: F.struct(*plain(x)).eqNullSafe(r)
        several = F.transform(several, lambda r: F.struct(
            *[r[n].alias(n) for n in names], F.exists(rules, lambda x: alike(x, r) & marked(x)).alias("_any"),
            F.exists(rules, lambda x: alike(x, r) & ~marked(x)).alias("_none")))
    return folded.withColumn(held, F.when(F.size(rules) == 1, F.array(F.struct(*single))).otherwise(several))


def _with_lookups(base: DataFrame, p: Profiles, shown: bool = False) -> DataFrame:
    """Base rows with one array of looked-up rows per key, so that no join multiplies the wide rows."""
    out = J.membership_flag(base, p.pogs, ["pog_id"], "high_cb_pog")
    for keys, frames in _lookups(p):
        if _held(keys) not in base.columns:
            on, folded = _folded(keys, frames, shown)
            out = out.join(folded, on, "left")
    return out


def _choices(p: Profiles) -> tuple[list[Column], list[list[str]]]:
    """The arrays of the lookups, and the columns that their elements have."""
    every = _lookups(p)
    return [F.col(_held(k)) for k, _ in every], [[c for f in frames for c in f.columns if c not in k] for k, frames in every]


def _priced(base: DataFrame) -> DataFrame:
    return base.where("seller_price > 0").withColumns({"_vf": F.lower("vendor_code"), "_sf": F.lower("supc")})


def attach_profiles(base: DataFrame, p: Profiles) -> DataFrame:
    """Listing base with the looked-up columns except the cut-off bands; rows of a zero seller price are dropped.

    The rows move for items, if they don't lie by them, and for vendors; what is larger by brand or category and vendor then finds
    them in place. They multiply when all lookups are there.
    """
    arrays, columns = _choices(p)
    kept = [*base.columns, "high_cb_pog"]
    return _with_lookups(_priced(base), p).select(*kept, F.explode(J.products(arrays, J.merged(columns))).alias("_row")).select(*kept, "_row.*")


def exception_flags(at: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Hard flag per scope, the two OR-combinations and the vendor and product markers; ``at`` gives a looked-up column."""
    def any_of(suffix: str, extra: Column | None = None) -> Column:
        hit = extra
        for s in SCOPES:
            one = S.nz(at(f"{s}_{suffix}"), 0) == 1
            hit = one if hit is None else hit | one
        return hit.cast("int")

    out = {name: S.nz(at(f"{s}_hard"), 0) for s, name in SCOPE_NAMES.items()}
    out |= {
        "brand_mandate_exception": S.nz(at("brand_mandate"), 0),
        "is_exception": any_of("is"),
        # For a vendor, level 2 counts as hard as well.
        "is_hard_exception": any_of("hard", S.nz(at("vel_hard"), 0) == 2),
        "bad_seller": S.nz(at("bad_seller"), 0),
        "sale_participation": F.coalesce(at("participation"), F.lit("Other")),
        "top_vendor": S.nz(at("top_vendor"), 0),
        "category_request_cb": S.nz(at("category_request"), 0),
        "price_drop_vendor": S.nz(at("price_drop"), 0),
    }
    return out


def remaining_share(at: Callable[[str], Column] = F.col) -> Column:
    return F.lit(1.0) - S.nz(at("rto_factor")) - S.nz(at("rpr_factor"))


def return_recoveries(at: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Income from bids and what returns cost per delivered item."""
    left = remaining_share(at)
    bid_income = at("selling_price") * S.nz(at("active_bid")) / BID_SCALE * ACTIVE_BID_SHARE
    reverse = S.nz(at("rpr_charge")) + S.nz(at("payment_collection_charges")) + S.nz(at("oneship_charges"))
    return {
        "bid_active": S.nz(F.try_divide(bid_income * S.nz(F.lit(1.0) - at("rto_factor")), left)),
        "bid_income": S.nz(at("selling_price") * S.nz(at("bid")) / BID_SCALE),
        "rto_recovery": S.nz(F.try_divide(S.nz(at("rto_charge")) * S.nz(at("rto_factor")), left) / TAX),
        "rpr_recovery": S.nz(F.try_divide(reverse * S.nz(at("rpr_factor")), left) / TAX),
    }


def monetisation_rule(at: Callable[[str], Column] = F.col) -> Column:
    """Brand terms: a percentage or a ratio of the price, on delivered or shipped value."""
    sp = S.nz(at("selling_price"))
    basis = F.when(at("rule") == "DEL", sp).when(at("rule") == "Ship", F.try_divide(sp, remaining_share(at))).otherwise(0.0)
    return S.nz(F.when(at("ro_type") == "GSV", S.nz(at("amount")) * 0.01 * basis)
                .when(at("ro_type") == "LSM", S.nz(at("ratio")) * basis).otherwise(0.0))


def attach_bands(df: DataFrame, bands: DataFrame, value: str = "selling_price") -> DataFrame:
    """Cut-off columns of the price band. A price on a shared endpoint gets one row per different cut-off set.

    Bands of a subcategory with equal cut-offs are folded into one row with several ranges, so a distinct
    input stays distinct and the many cut-off columns need not take part in a deduplication.
    """
    cutoffs = [c for c in bands.columns if c not in ("subcategory_id", "from_price", "to_price")]
    folded = bands.groupBy(F.col("subcategory_id").alias("_sub"), *cutoffs).agg(
        F.collect_set(F.struct("from_price", "to_price")).alias("_ranges"))
    hit = F.exists("_ranges", lambda r: F.col(value).between(r["from_price"], r["to_price"]))
    return df.join(folded, (F.col("subcategory_id") == F.col("_sub")) & hit, "left").drop("_sub", "_ranges")


def exceptions_stage(base: DataFrame, profiles: Profiles) -> DataFrame:
    """Base rows with flags, recoveries and cut-offs, each combination once.

    The base's rows are made distinct and meet their lookups as arrays of rules that differ in what a row shows of them, so every choice among
    these is a different outcome: the rows multiply last, and nothing after it sorts, moves or gathers them. What depends on several
    rules at once is chosen at the end: the mark of an exception, and the amounts from the row's bids and terms.
    """
    found = {c: F.col(_held(k))[c] for k, frames in _lookups(profiles) for f in frames for c in f.columns if c not in k}
    held = [_held(k) for k, _ in _lookups(profiles) if k not in AMOUNTS]
    bids, terms = (F.col(_held(k)) for k in AMOUNTS)
    kept = [*[c for c in base.columns if not c.startswith("_r_")], "high_cb_pog"]
    looked_up = J.choose_each(_with_lookups(_priced(base).distinct(), profiles, shown=True), held)
    marks = [F.col(c) for c in held if "_any" in looked_up.schema[c].dataType.names]
    with_mark = reduce(lambda a, b: a | b, [S.nz(m["_any"], False) for m in marks])
    without = reduce(lambda a, b: a & b, [S.nz(m["_none"], True) for m in marks])

    def outcome(mark: Column, bid: Column, term: Column) -> Column:
        at = lambda c: {"active_bid": bid["active_bid"], **{n: term[n] for n in ("ro_type", "rule", "amount", "ratio")}}.get(c, found.get(c, F.col(c)))
        return F.struct(mark.cast("int").alias("is_exception"), return_recoveries(at)["bid_active"].alias("bid_active"),
                        monetisation_rule(at).alias("ro_monetisation"))

    either = with_mark & without
    first = [F.get(bids, F.lit(0)), F.get(terms, F.lit(0))]
    single = F.when(either, F.array(outcome(F.lit(True), *first), outcome(F.lit(False), *first))).otherwise(F.array(outcome(with_mark, *first)))
    several = F.array_distinct(J.products([F.when(either, F.array(F.lit(True), F.lit(False))).otherwise(F.array(with_mark)), bids, terms],
                                          lambda one: outcome(*one)))
    # projected first: a lambda would keep the whole of the generator from being compiled
    listed = looked_up.withColumn("_rows", F.when(J.at_most_one([bids, terms]), single).otherwise(several))
    chosen = listed.select("*", F.explode("_rows").alias("_row"))
    at = lambda c: found.get(c, F.col(c))
    carried = ["reduce_sp_pct", "cm_gm_movement_pct", "bid", "rto_factor", "rpr_factor", "category_group", "is_core",
               "elasticity_tag", "elasticity_pct", "new_logic_status", "new_logic_reason", "seller_zone"]
    derived = {**{c: at(c) for c in carried}, **exception_flags(at), **return_recoveries(at), "ro_monetisation": None,
               "motz_cb": S.nz(at("cash_back")), "motz_add": F.coalesce(at("motz_add"), F.lit("No")),
               "pl_bau_op": S.nz(at("bau_op")), "pl_bau_cb": S.nz(at("bau_cb")), "pl_sale_op": S.nz(at("sale_op")),
               "pl_sale_cb": S.nz(at("sale_cb")),
               "bau_op": S.nz(at("bau_price"), DEFAULT_OP["bau_op"]), "sale_op": S.nz(at("sale_price"), DEFAULT_OP["sale_op"]),
               **{c: F.col("_row")[c] for c in ("is_exception", "bid_active", "ro_monetisation")}}
    narrow = chosen.select(*kept, *[c.alias(n) for n, c in derived.items()])
    # as a distinct leaves them: a negative zero is a zero
    narrow = narrow.select(*[(F.col(c) + F.lit(0.0)).alias(c) if d == "double" else F.col(c) for c, d in narrow.dtypes])
    banded = attach_bands(attach_bands(narrow, profiles.bands_old), profiles.bands)
    # the cut of vendors who drop prices is the first old cut-off
    return banded.withColumn("price_drop_pct", F.col("variant7_min_gm_percent"))


# ---- step 5: decisions and cashback ------------------------------------------------------------------------

PUSH_KEYS = {"is_enabled": "is_enabled", "is_enabled_with_inv": "is_enabled_with_inv", "sold_30_flag": "sold_30_flag",
             "sold_7_flag": "sold_7_flag", "top_vendor": "top_vendor", "category_request_cb": "category_cb_push"}
EXCEPTION_KEYS = {k: k for k in ("is_exception", "brand_mandate_exception", "is_hard_exception", "bad_seller",
                                 "sale_participation", "price_drop_vendor", "high_cb_pog")}


def live_flag(as_of: dt.date, policy: Policy) -> Column:
    fresh = (~F.col("new_supercategory").isin(list(policy.hidden_supercategories))
             if policy.hidden_supercategories else F.col("new_supercategory").isNotNull())
    sub = (~F.col("subcategory_id").isin(list(policy.hidden_subcategories))
           if policy.hidden_subcategories else F.col("subcategory_id").isNotNull())
    recent = F.col("vip_updated") >= F.lit(as_of - dt.timedelta(days=policy.live_days))
    return S.flag((F.col("is_enabled_with_inv") == 1) | (fresh & sub & recent))


# The formulas below repeat per variant, so they are written as SQL text and parsed in one call each.


def tax_factor(variant: int) -> str:
    return f"if(variant{variant}_adjusted = 0, 1D, {TAX}D)"


def margin_floor(variant: int) -> str:
    """Floor on the margin amount: grows with the weight slab up to the cap; NULL if slab or floor is missing."""
    floor = f"variant{variant}_gm_floor"
    return f"if(slab is null, null, least({floor} + (slab - 1) * {SLAB_STEP}, {floor} + {SLAB_CAP * SLAB_STEP}))"


def cashback_cap(variant: int, reduced: bool) -> str:
    """Cashback that still leaves the minimum margin percentage and the margin floor; never negative."""
    gm = f"variant{variant}_min_gm_percent"
    if reduced:
        gm += " + coalesce(reduce_sp_pct, 0D)"
    by_pct = f"(share - coalesce({gm}, try_divide(share, selling_price)) * selling_price)"
    by_floor = f"(share - {margin_floor(variant)} - variant{variant}_nm_percent * selling_price)"
    amount = f"if({by_pct} is null or {by_floor} is null, null, least({by_pct}, {by_floor}) * {tax_factor(variant)})"
    return f"if({amount} <= 0, 0D, {amount})"


def sale_addons(variant: int, policy: Policy) -> str:
    out = f"if(variant{variant}_name = '{policy.bid_tag}', selling_price * coalesce(bid, 0D) / {BID_SCALE:.0f}D, 0D)"
    if policy.addon_vendors:
        codes = ", ".join(f"'{c}'" for c in policy.addon_vendors)
        out = f"({out} + if(vendor_code in ({codes}), selling_price * {policy.addon_rate}D, 0D))"
    return out


def base_cashbacks() -> dict[str, Column]:
    return {n: F.expr(cashback_cap(v, reduced=True)) for n, v in BASE_VARIANTS.items() if n not in SAME_AS}


def sale_cashbacks(policy: Policy) -> dict[str, Column]:
    return {n: F.expr(f"{cashback_cap(v, reduced=False)} + {sale_addons(v, policy)}") for n, v in SALE_VARIANTS.items()}


def decisions(df: DataFrame, pushed: DataFrame, mapping: DataFrame, as_of: dt.date, policy: Policy) -> DataFrame:
    out = df.withColumn("live_flag", live_flag(as_of, policy))
    out = J.decision_table(out, pushed, PUSH_KEYS, ["is_pushed"])
    return J.decision_table(out, mapping, EXCEPTION_KEYS, ["sale_variant", "non_sale_variant"])


def cashback_stage(df: DataFrame, pushed: DataFrame, mapping: DataFrame, as_of: dt.date, policy: Policy) -> DataFrame:
    """Policies and the cashback amounts. Both decision tables hold one row per key, so rows stay distinct."""
    return decisions(df, pushed, mapping, as_of, policy).withColumns({**base_cashbacks(), **sale_cashbacks(policy)})


# ---- step 6: price points ------------------------------------------------------------------------------------

POINTS = ("rounding", "rounding_1", "rounding_2", "rounding_3", "rounding_4", "rounding_next")


def round_to_point(cb: str, price: str, floor: str, tax: str, seg: str) -> Column:
    """Move a price ``vip - cb`` to a neighbouring price point of its segment; all arguments are column names.

    Spans are tried in order: the whole segment, then between consecutive points. In a span the nearer
    end wins; a lower price is taken only if the margin floor survives, a higher one only if the
    cashback stays non-negative. A span with a missing end is skipped.
    """
    points = [f"{seg}.{n}" for n in POINTS]
    spans = [(points[0], points[-1], f"{price} < {points[-1]}")]
    spans += [(lo, hi, f"{price} between {lo} and {hi}") for lo, hi in zip(points, points[1:])]
    tried = []
    for lo, hi, inside in spans:
        up, down = f"({hi} - {price})", f"({price} - {lo})"
        affordable = f"share - ({cb} + {down}) / {tax} >= {floor}"
        tried.append(f"when {inside} and {up} <= {down} and {cb} - {up} >= 0 then {cb} - {up} "
                     f"when {inside} and {up} >= {down} and {affordable} then {cb} + {down} "
                     f"when {inside} and {up} >= {down} and {cb} - {up} >= 0 then {cb} - {up}")
    stays = f"{price} < {ROUND_FROM} or {price} >= {ROUND_TO} or {price} = {points[0]} or {price} = {points[-1]}"
    return F.expr(f"case when {stays} then {cb} {' '.join(tried)} else {cb} end")


def rounding_stage(df: DataFrame, price_points: DataFrame) -> DataFrame:
    """``<cashback>_rounded`` for every cashback; all prices share one grid lookup.

    Prices, floors and tax factors are projected once ahead of the long conditions that use them.
    """
    variants = {n: v for n, v in {**BASE_VARIANTS, **SALE_VARIANTS}.items() if n not in SAME_AS}
    inputs = {f"_p_{n}": F.expr(f"vip_selling_price - {n}") for n in variants}
    for v in set(variants.values()):
        inputs |= {f"_f_{v}": F.expr(margin_floor(v)), f"_t_{v}": F.expr(tax_factor(v))}
    found = J.range_lookup(df.withColumns(inputs), price_points, {f"_p_{n}": f"_g_{n}" for n in variants},
                           "rounding", "rounding_next")
    rounded = {f"{n}_rounded": round_to_point(n, f"_p_{n}", f"_f_{v}", f"_t_{v}", f"_g_{n}") for n, v in variants.items()}
    out = found.withColumns(rounded).drop(*inputs, *[f"_g_{n}" for n in variants])
    return out.withColumns({f"{n}{s}": F.col(f"{o}{s}") for n, o in SAME_AS.items() for s in ("", "_rounded")})


# ---- step 7: list policies -------------------------------------------------------------------------------------


def update_priority() -> Column:
    return (F.when((F.col("last_d15_sale") > 0) | (F.col("sold_7_flag") == 1), 1).when(F.col("sold_30_flag") == 1, 2)
            .when(F.col("top_vendor") == 1, 3).when(F.col("category_request_cb") == 1, 4).otherwise(5))


def bau_policy(cb: str) -> Column:
    return F.when(F.col("non_sale_variant") == "BAU_CB", F.col(cb)).otherwise(0.0)


def zone_policy() -> Column:
    """Everyday list by seller zone."""
    zone = F.col("seller_zone")
    by_zone = (F.when(zone.isin("Yellow-Bad", "Red"), F.col("base_cb2_rounded"))
               .when(zone == "Green", F.col("base_cb_rounded")).otherwise(F.col("base_cb3_rounded")))
    return F.when(F.col("non_sale_variant") == "BAU_CB", by_zone).otherwise(0.0)


def participation_policy(general: str, bidder: str, listed: str, policy: Policy) -> Column:
    """Sale list: bidders in the sale get ``bidder``, low bidders in the middle price range and all others ``general``."""
    part = F.col("sale_participation")
    low = (S.nz("bid") / BID_SCALE < LOW_BID) & F.col("selling_price").between(*MID_PRICE)
    vendors = list(policy.listed_vendors)
    on_list = F.col("vendor_code").isin(vendors) if vendors else F.lit(False)
    return (F.when((F.col("is_hard_exception") == 1) & (F.col("sale_variant") == "No_CB"), 0.0)
            .when(on_list, F.col(listed)).when(F.col("bad_seller") == 1, F.col(general))
            .when((part == "Yes") & low, F.col(general)).when(part == "Yes", F.col(bidder))
            .when(part.isin("No", "Other"), F.col(general)).otherwise(F.col("base_cb_rounded")))


def zone_sale_policy() -> Column:
    """Sale list by zone, from lists C and D: red sellers stay on the everyday rule, green ones get the stronger sale."""
    zone, list_c, list_d = F.col("seller_zone"), F.col("list_c_cb"), F.col("list_d_cb")
    return (F.when((F.col("is_hard_exception") == 1) & (F.col("sale_variant") == "No_CB"), 0.0)
            .when(zone == "Red", bau_policy("base_cb3_rounded")).when(zone == "Green", list_d).otherwise(list_c))


def list_policies(policy: Policy) -> dict[str, Column]:
    everyday = bau_policy("base_cb_rounded")
    return {"list_a_cb": everyday, "list_b_cb": everyday,
            "list_c_cb": participation_policy("sale4_cb_rounded", "sale3_cb_rounded", "base_cb3_rounded", policy),
            "list_d_cb": participation_policy("sale2_cb_rounded", "sale1_cb_rounded", "base_cb3_rounded", policy),
            "list_e_cb": zone_policy(), "list_g_cb": everyday, "list_h_cb": bau_policy("base_cb2_rounded"), "list_i_cb": everyday,
            "list_j_cb": participation_policy("sale4_cb_rounded", "sale3_cb_rounded", "base_cb_rounded", policy)}


def list_stage(df: DataFrame, policy: Policy) -> DataFrame:
    return df.withColumns({**list_policies(policy), "cb_update_flag": update_priority()}) \
        .withColumn("list_f_cb", zone_sale_policy())


# ---- step 8: competitor ladder (not part of the daily chain) -----------------------------------------------------

# Price gap to the rival (over) and the largest cut tried there, percent; cuts go in steps of 5.
LADDER = ((150, 40), (100, 30), (75, 20), (50, 15), (20, 10))
LADDER_STEP, LADDER_MARGIN = 5, 20


def competitor_floor(prices: DataFrame, own: str, rivals: Sequence[str]) -> DataFrame:
    """Lowest rival price of each product group that we sell ourselves."""
    low = prices.where(F.col("store").isin(list(rivals))).groupBy("pog").agg(F.min("selling_price").alias("rival_price"))
    return low.join(prices.where(F.col("store") == own).select("pog"), "pog", "left_semi")


def competitor_ladder(lists: DataFrame, floor: DataFrame, cb: str = "list_b_cb") -> DataFrame:
    """Cashback cut by the largest step that keeps the price clear of the rival's; only rows priced below it."""
    rows = lists.join(floor.withColumnRenamed("pog", "pog_id"), "pog_id")
    op = F.col("selling_price") - F.col(cb)
    gap = F.col("rival_price") - op
    limit = F.lit(0)
    for over, pct in reversed(LADDER):
        limit = F.when(gap > over, pct).otherwise(limit)
    cuts = []
    for pct in range(LADDER[0][1], 0, -LADDER_STEP):
        reduced = F.col(cb) - F.lit(pct / 100) * F.col(cb)
        cuts.append(F.when((limit >= pct) & (F.col("rival_price") - (F.col("selling_price") - reduced) > LADDER_MARGIN), reduced))
    # Wrapped so that no not-null test on the long list formula is inferred and pushed below the stages.
    return rows.where(S.is_true(op < F.col("rival_price"))).withColumn("ladder_cb", F.coalesce(*cuts, F.col(cb)))


# ---- step 9: overlays ---------------------------------------------------------------------------------------------


def overlay(name: str) -> Column:
    """Monetisation cashback replaces the list value when it must not be added, else comes on top."""
    replace = (F.lower("motz_add") == "no") & (F.col("motz_cb") > 0)
    return F.when(replace, F.col("motz_cb")).otherwise(F.col(name) + F.col("motz_cb"))


def target_cap(name: str, period: str) -> Column:
    """Private-label cashback that reaches the target price, within the agreed amount."""
    target, agreed, sp = F.col(f"pl_{period}_op"), F.col(f"pl_{period}_cb"), F.col("selling_price")
    gap = F.when(target >= sp, 0.0).when(target <= sp, sp - target).otherwise(agreed)
    return F.when(target > 0, S.least_strict(gap, agreed)).otherwise(F.col(name))


CAP_PERIOD = {"b": "bau", "e": "bau", "i": "bau", "c": "sale", "d": "sale", "f": "sale", "j": "sale"}


def overlay_stage(df: DataFrame) -> DataFrame:
    added = df.withColumn("step7_list_b", F.col("list_b_cb")).withColumns({f"list_{x}_cb": overlay(f"list_{x}_cb") for x in LISTS})
    return added.withColumns({f"list_{x}_cb": target_cap(f"list_{x}_cb", p) for x, p in CAP_PERIOD.items()})


# ---- step 10: floors, matching, pushes, deals ------------------------------------------------------------------------


def clamp_to_floor(cb: Column, floor: Column) -> Column:
    """Cashback cut so that the offered price does not fall below the floor, rounded to cents."""
    vip = F.col("vip_selling_price")
    cut = F.when(vip <= floor, 0.0).otherwise(vip - floor)
    return F.round(F.when(cb < 0, 0.0).when(vip - cb < floor, cut).otherwise(cb), 2)


# Floor used by each list; list A takes its amount from list B.
FLOOR_OF = {"a": "bau_op", "b": "bau_op", "c": "sale_op", "d": "sale_op", "e": "bau_op", "f": "sale_op", "g": "bau_op",
            "h": "bau_op", "i": "bau_op", "j": "sale_op"}


def clamp_stage(df: DataFrame) -> DataFrame:
    return df.withColumns({f"list_{x}_cb": clamp_to_floor(F.col("list_b_cb" if x == "a" else f"list_{x}_cb"), F.col(floor))
                           for x, floor in FLOOR_OF.items()})


def delta_columns(df: DataFrame, coupon: str = "CATEGORY_OFFER") -> DataFrame:
    """What the sale lists add to the list below, and the coupon code of the category."""
    return df.withColumns({"delta_i": S.greatest_strict(F.col("list_c_cb") - F.col("list_b_cb"), F.lit(0.0)),
                           "delta_j": S.greatest_strict(F.col("list_d_cb") - F.col("list_c_cb"), F.lit(0.0)),
                           "coupon_code": F.concat(F.lit(f"{coupon}_"), F.col("category_id"))})


def price_file_columns(df: DataFrame, as_of: dt.date) -> DataFrame:
    """The columns of the price file that repeat others or are fixed; added last, so that no join moves them."""
    return df.withColumns({
        "price_date": F.lit(as_of), "is_revenue_recognised": F.lit(0),
        **{f"vip_cashback_{x}": F.col(f"delta_{x}") if x in "ij" else F.lit(0.0) for x in LISTS},
        **{f"coupon_{x}": F.col("coupon_code") for x in LISTS}, **{f"additional_cashback_{x}": F.lit(0.0) for x in LISTS}})


def list_deltas(df: DataFrame, as_of: dt.date, coupon: str = "CATEGORY_OFFER") -> DataFrame:
    """What the sale lists add to the list below, the coupon code of the category, and the fixed columns of the price file."""
    return price_file_columns(delta_columns(df, coupon), as_of)


RIVALS = ("rival_a_price", "rival_b_price")


def match_cashback(list_b: Column, rivals: Sequence[str] = RIVALS) -> dict[str, Column]:
    """Cashback that meets the lowest rival price (NULL if one is missing), given back as far as the net margin turns negative.

    The share is the selling price less the seller's, without tax; ``zero_margin_share`` is what it would have to be
    for a net margin of zero, ``share_after`` what the matched price leaves of it.
    """
    op = F.col("selling_price") - list_b
    rival = S.least_strict(*rivals)
    new_cb = F.when(rival < op, op - rival).otherwise(0.0) + list_b
    share = (F.col("selling_price") - F.col("seller_price")) / TAX
    cost = S.greatest_strict(F.lit(float(MATCH_BASE)) + S.least_strict(F.col("slab") - 1, F.lit(float(SLAB_CAP))) * SLAB_STEP, F.lit(0.0))
    margin = (share - new_cb / TAX) - cost
    final = F.when(margin < 0, new_cb + margin * TAX).otherwise(new_cb)
    return {"rival_price": rival, "new_cb": new_cb, "fulfilment_cost": cost, "share_before": share - list_b / TAX,
            "share_after": share - new_cb / TAX, "net_margin": margin, "zero_margin_share": cost,
            "new_cb_final": final, "new_margin": (share - final / TAX) - cost}


def _one_rival(rivals: DataFrame, names: Sequence[str]) -> DataFrame:
    """The match list by folded item and vendor (``_s``, ``_v``): a pair's newest row is the largest."""
    folded = rivals.select(F.lower("supc").alias("_s"), F.lower("vendor_code").alias("_v"), *names)
    return J.one_per_key(folded, [F.col("_s"), F.col("_v")], [F.desc_nulls_last(n) for n in names])


def _matched(names: Sequence[str]) -> Column:
    """The matched cashback of a row, not below zero; NULL where it can't be told."""
    final = match_cashback(F.col("step7_list_b"), names)["new_cb_final"]
    return F.when(final.isNotNull(), F.greatest(final, F.lit(0.0)))


def matched_pairs(lists: DataFrame, rivals: DataFrame, names: Sequence[str] = RIVALS) -> DataFrame:
    """One matched cashback per pair of the match list: of its rows without a hard exception, the largest value counts.

    The match list holds one row per spelling-folded pair after the newest, then the largest, is taken.
    """
    rows = lists.where("is_hard_exception = 0").select("supc", "vendor_code", "selling_price", "seller_price", "slab", "step7_list_b")
    met = rows.join(_one_rival(rivals, names), (F.lower("supc") == F.col("_s")) & (F.lower("vendor_code") == F.col("_v")))
    return met.groupBy(F.col("_s").alias("supc"), F.col("_v").alias("vendor_code")).agg(F.max(_matched(names)).alias("matched_cb"))


def match_stage(df: DataFrame, rivals: DataFrame, names: Sequence[str] = RIVALS) -> DataFrame:
    """``matched_pairs`` set on every row of its pair, from one pass over the rows.

    The rows meet the match list by their pair, and a window over the pair, which finds them in place and in order, takes its largest value.
    So the stages before aren't computed a second time for the pairs.
    """
    pair = Window.partitionBy(F.lower("supc"), F.lower("vendor_code"))
    met = df.join(_one_rival(rivals, names), (F.lower("supc") == F.col("_s")) & (F.lower("vendor_code") == F.col("_v")), "left")
    counts = (F.col("is_hard_exception") == 0) & F.col("_s").isNotNull()
    found = met.withColumns({"_counts": F.when(counts, 1), "_matched": F.when(counts, _matched(names))}).withColumns(
        {"_counts": F.max("_counts").over(pair), "_matched": F.max("_matched").over(pair)})
    hit = F.col("_counts").isNotNull()
    assign = {"list_b_cb": F.col("_matched"), "is_pushed": F.lit(1)}
    return found.select(*[F.when(hit, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in df.columns])


def push_stage(df: DataFrame, rivals: DataFrame, visits: DataFrame, as_of: dt.date, policy: Policy) -> DataFrame:
    """Price-matched pairs, visited rows in stock, then rows without a cut-off are taken out again.

    Each update sees the row as the previous one left it. The match is made from the list values of step 7 of
    the rows without a hard exception and set on every row of the pair.
    """
    out = match_stage(df, rivals)
    seen = visits.where(F.col("visit_date") >= F.lit(as_of - dt.timedelta(days=policy.visit_days))).where("pog_id is not null")
    out = J.membership_flag(out, seen, ["pog_id"], "_seen")
    push = S.is_true((F.col("is_pushed") == 0) & (F.col("list_b_cb") > 0) & (F.col("is_enabled_with_inv") == 1)
                     & (F.col("is_hard_exception") == 0) & (F.col("_seen") == 1))
    out = out.withColumn("is_pushed", F.when(push, 1).otherwise(F.col("is_pushed"))).drop("_seen")
    return out.withColumn("is_pushed", F.when(F.col("variant1_name").isNull(), 0).otherwise(F.col("is_pushed")))


def deal_stage(df: DataFrame, deals: DataFrame, as_of: dt.date) -> DataFrame:
    """Deal-of-the-day price on lists B and C; a deal without a price puts list C on both.

    The deals are dealt by the folded pair, by which ``push_stage`` leaves the rows, so these don't move again.
    """
    folded = {"_fs": F.lower("supc"), "_fv": F.lower("vendor_code")}
    live = J.valid_on(deals, as_of, "start_date", "end_date").select("supc", "vendor_code", "deal_op").withColumns(folded).repartition(*folded)
    price = F.when(F.col("src_deal_op").isNull(), F.col("list_c_cb")).otherwise(F.col("selling_price") - F.col("src_deal_op"))
    keys = {c: c for c in (*folded, "supc", "vendor_code")}
    return J.update_from(df.withColumns(folded), live, keys, {"list_b_cb": price, "list_c_cb": price, "is_pushed": F.lit(1)}).drop(*folded)


def update_stage(df: DataFrame, rivals: DataFrame, visits: DataFrame, deals: DataFrame, as_of: dt.date, policy: Policy) -> DataFrame:
    """``push_stage`` and ``deal_stage`` as one update log: matches, pushes and deals meet the wide rows in one join."""
    seen = visits.where(F.col("visit_date") >= F.lit(as_of - dt.timedelta(days=policy.visit_days))).where("pog_id is not null")
    live = J.valid_on(deals, as_of, "start_date", "end_date").select("supc", "vendor_code", "deal_op")
    deal = F.when(F.col("src_deal_op").isNull(), F.col("list_c_cb")).otherwise(F.col("selling_price") - F.col("src_deal_op"))
    push = ((F.col("is_pushed") == 0) & (F.col("list_b_cb") > 0) & (F.col("is_enabled_with_inv") == 1)
            & (F.col("is_hard_exception") == 0) & (F.col("_seen") == 1))
    pair = ("supc", "vendor_code")
    steps = [U.Update({"list_b_cb": F.col("src_matched_cb"), "is_pushed": F.lit(1)}, matched_pairs(df, rivals), pair),
             U.Update({"is_pushed": F.lit(1)}, when=push),
             U.Update({"is_pushed": F.lit(0)}, when=F.col("variant1_name").isNull()),
             U.Update({"list_b_cb": deal, "list_c_cb": deal, "is_pushed": F.lit(1)}, live, pair, exact=True)]
    return U.update_sequence(J.membership_flag(df, seen, ["pog_id"], "_seen"), pair, steps, casefold=True).drop("_seen")


# ---- the whole batch ----------------------------------------------------------------------------------------------------


def base_from(t, as_of: dt.date, policy: Policy, beside: DataFrame | None = None) -> DataFrame:
    since = policy.live_since or as_of - dt.timedelta(days=policy.fee_days)
    return listing_base(
        t.listings, financial_override(t.financials, t.price_changes, as_of), t.products,
        latest_fees(t.suborders, t.suborder_params, as_of, policy.fee_days),
        A.trailing_sales(t.suborders, PAIR, "suborder_code", "verified", as_of, [7, 15], prefix="pair").select(*PAIR, "pair_7", "pair_15"),
        pog_sales(t.suborders, t.products, as_of),
        candidate_universe(t.suborders, t.snapshots, t.final_today, t.listings, t.products, t.listed_pogs, since), beside)


def exceptions_from(t, as_of: dt.date, policy: Policy, base: DataFrame | None = None) -> DataFrame:
    top = eligible_vendors(t.listings, t.suborders, as_of, policy.top_vendors, policy.vendor_limit)
    profiles = build_profiles(t, as_of, policy, top)
    # lookups by pair meet the rows while these lie by pair; afterwards they lie by item
    on, pairs = _folded(tuple(PAIR), dict(profiles.by_key)[tuple(PAIR)], shown=True)
    base = base_from(t, as_of, policy, pairs) if base is None else base.join(pairs, on, "left").repartition(F.lower("supc"))
    return exceptions_stage(base, profiles)


def run(t, as_of: dt.date, policy: Policy = Policy(), stage_dir: str | None = None, snapshot_dir: str | None = None) -> dict[str, DataFrame]:
    """All stages, each written to shared storage and read back, so that no stage is computed twice.

    With ``stage_dir`` a rerun with the same day and policy resumes after the last stage that was completed, and
    every step leaves a start and an end row in ``step_log`` there; a run with other inputs needs another folder. Without
    it the stages go to a fresh folder in the cluster's shared one. With ``snapshot_dir`` the final rows replace the day's
    snapshot and the one of seven days ago goes, as one version of the table there (``snapshots.read_snapshots``).
    """
    spark = t.spark
    run_key = hashlib.sha256(repr((as_of, policy)).encode()).hexdigest()[:16]
    folder = f"{stage_dir}/{run_key}" if stage_dir else f"{shared_dir(spark).rstrip('/')}/pricing-{uuid.uuid4().hex}"
    log = f"{stage_dir}/step_log" if stage_dir else None

    def stage(name: str, build) -> DataFrame:
        return staged(build, spark, f"{folder}/{name}", log)

    base = stage("base", lambda: base_from(t, as_of, policy))
    flagged = stage("exceptions", lambda: exceptions_from(t, as_of, policy, base))
    priced = lambda: rounding_stage(cashback_stage(flagged, t.pushed_status, t.exception_mapping, as_of, policy), t.price_points)
    lists = stage("lists", lambda: list_stage(priced(), policy))
    # the match reads few columns of the lists, so this narrow step is cheaper twice than written
    offers = delta_columns(clamp_stage(overlay_stage(lists)))
    final = stage("final", lambda: price_file_columns(
        update_stage(offers, t.price_match_list, t.pog_visits, t.deals, as_of, policy), as_of))
    if snapshot_dir:
        commit_snapshot(final, snapshot_dir, as_of)
    return {"base": base, "exceptions": flagged, "lists": lists, "final": final}
