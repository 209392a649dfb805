"""Queries over boosted trees, interval joins, wide correlations and CSV part files of unknown types."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marginloom.bindings.frames import AS_OF, Frames, ddb
from marginloom.bindings.modelling import TRAIN_END, VALID_END
from marginloom.bindings.registry import query
from marginloom.operators import boosting as BO
from marginloom.operators import evaluation as E
from marginloom.operators import intervals as IV
from marginloom.operators import models as M
from marginloom.operators import moments as MO
from marginloom.plans import delivery as D
from marginloom.session import shared_dir
from marginloom.sources import csvfiles as CS

# ---- boosted trees ------------------------------------------------------------------------------

#: A target that the columns explain but for every tenth row, so that a score can be wrong: the tables' own return flag is drawn at random.
EXPLAINED = "((user_del_ship >= 5 and user_del <= 1) or (pin_att_14 > 8 and city_del_14 < 2))"
RETURNED = f"case when (l_orderkey * 31 + l_linenumber * 7) % 10 = 0 then cast(not {EXPLAINED} as int) else cast({EXPLAINED} as int) end"
BOOSTED_VARS = ["user_del_ship", "user_del", "pin_att_14", "pin_del_14", "city_att_14", "city_del_14", "l_quantity"]
EXPLAINING = ["user_del_ship", "user_del", "pin_att_14", "city_del_14"]
MIN_AUC = 0.85


def _boosted_risk(f: Frames):
    """(saved model's folder, test rows): class weights, validation rows and patience as in the surveyed training."""
    data = f.returns.select("code", "order_date", *[F.col(c).cast("double").alias(c) for c in BOOSTED_VARS], F.expr(RETURNED).alias("returned"))
    day = F.col("order_date")
    train = M.with_class_weight(data.where(day <= F.lit(TRAIN_END)), "returned")
    valid = M.with_class_weight(data.where((day > F.lit(TRAIN_END)) & (day <= F.lit(VALID_END))), "returned")
    model = BO.fit(train, BOOSTED_VARS, "returned", BO.LogLoss(), weight="class_weight", valid=valid, rounds=12, steps=(0.3,), depth=4, patience=4)
    path = f"{shared_dir(f.spark).rstrip('/')}/boosted-{uuid.uuid4().hex}"
    model.save(f.spark, path)
    return path, data.where(day > F.lit(VALID_END))


@query(ddb(f"""select code, {RETURNED} as returned, true as sound, true as ranks_well from returns where order_date > date '{VALID_END}'"""))
def rto_boosted(f: Frames):
    """The saved model scores the later rows; ``ranks_well``: their area under the curve is above the bound."""
    path, test = _boosted_risk(f)
    scored = BO.load(f.spark, path).probability(test)
    auc = E.roc_auc(scored, "returned", "score").scalar()
    sound = F.col("score").between(0.0, 1.0) & (F.col("predicted_class") == (F.col("score") > 0.5).cast("int"))
    return scored.select("code", "returned", sound.alias("sound"), (auc >= MIN_AUC).alias("ranks_well"))


@query(f"select unnest({BOOSTED_VARS}) as feature, unnest({[c in EXPLAINING for c in BOOSTED_VARS]}) as explains, true as apart, 1.0::double as total")
def rto_gain_importance(f: Frames):
    """Total gain per feature from the saved trees' nodes; ``apart``: the features that the target depends on hold more of it than any other."""
    path, _ = _boosted_risk(f)
    table = BO.gain_importance(BO.node_table(f.spark, path, BOOSTED_VARS), BOOSTED_VARS).withColumn("explains", F.col("feature").isin(EXPLAINING))
    share = F.col("importance")
    total = table.agg(F.round(F.sum(share), 6)).scalar()
    least, most = table.where("explains").agg(F.min(share)).scalar(), table.where("NOT explains").agg(F.max(share)).scalar()
    return table.select("feature", "explains", F.when(F.col("explains"), share > most).otherwise(share < least).alias("apart"), total.alias("total"))


PROMISE_VARS = ["dc_o2a_7", "oc_o2a_7", "day_quarter"]


@query(ddb(f"""select l_orderkey, l_linenumber, true as window_sound, true as cheaper_here, true as cheaper_squared
               from deliveries where cast(order_created_time as date) >= date '{AS_OF}'"""))
def pdd_asymmetric(f: Frames):
    """Delivery days under the asymmetric loss and under the squared one; on later rows each must be the cheaper by its own measure."""
    d = D.calendar(f.deliveries).fillna(0.0, PROMISE_VARS[:2]).withColumn("day_quarter", F.col("day_quarter").cast("double"))
    past = D.trim_days(d).where(F.col("order_created_date") < F.lit(AS_OF))
    later = d.where(F.col("order_created_date") >= F.lit(AS_OF))
    fits = {name: BO.fit(past, PROMISE_VARS, "o2a", loss, rounds=5, steps=(0.25, 0.5, 1.0), depth=3)
            for name, loss in (("asymmetric", BO.AsymmetricSquare(20.0)), ("squared", BO.AsymmetricSquare(1.0)))}
    scored = fits["squared"].transform(fits["asymmetric"].transform(later, "asymmetric"), "squared")
    dear = {k: E.asymmetric_loss(scored, "o2a", k).scalar() for k in fits}
    error = {k: E.asymmetric_loss(scored, "o2a", k, penalty=1.0).scalar() for k in fits}
    out = D.promised(scored, "asymmetric")
    return out.select("l_orderkey", "l_linenumber", (F.col("pdd1") <= F.col("pdd2")).alias("window_sound"),
                      (dear["asymmetric"] < dear["squared"]).alias("cheaper_here"), (error["squared"] < error["asymmetric"]).alias("cheaper_squared"))


# ---- intervals inside a key ---------------------------------------------------------------------


@query(ddb("""select l.product_sid, l.vendor_sid, b.from_price, b.to_price, b.variant2_gm_floor
   from (select l.*, p.subcategory_id from listings l join products p on p.product_sid = l.product_sid) l
   left join bands b on b.subcategory_id = l.subcategory_id and l.selling_price between b.from_price and b.to_price""",
           bands="""select subcategory_id, from_price, to_price, variant2_gm_floor from cutoff_bands
   union all select subcategory_id, from_price, from_price + 250, variant2_gm_floor from cutoff_bands
   union all select subcategory_id, 0, 'infinity'::double, null from cutoff_bands"""))
def interval_join(f: Frames):
    """Price bands that touch, overlap and nest inside their subcategory."""
    priced = f.listings.join(f.products.select("product_sid", "subcategory_id"), "product_sid").select(
        "product_sid", "vendor_sid", "subcategory_id", "selling_price")
    bands = f.cutoff_bands.select("subcategory_id", "from_price", "to_price", "variant2_gm_floor")
    nested = bands.unionByName(bands.withColumn("to_price", F.col("from_price") + 250)).unionByName(
        bands.withColumns({"from_price": F.lit(0.0), "to_price": F.lit(float("inf")), "variant2_gm_floor": F.lit(None).cast("double")}))
    out = IV.interval_join(priced, nested, ["subcategory_id"], "selling_price", "from_price", "to_price")
    return out.select("product_sid", "vendor_sid", "from_price", "to_price", "variant2_gm_floor")


REACH = 15


@query(ddb(f"""select c.supc, c.vendor_code, c.aud_date, c.selling_price, d.low, d.high, d.begins
   from (select lower(supc) as supc, vendor_code, aud_date, selling_price from price_changes) c
   left join (select lower(supc) as supc, vendor_code as v, deal_op * 0.5e0 as low, deal_op * 1.5e0 as high, start_date - {REACH} as begins, end_date + {REACH} as ends
              from deals) d on d.supc = c.supc and d.v = c.vendor_code and c.selling_price between d.low and d.high and c.aud_date between d.begins and d.ends"""))
def interval_join_dated(f: Frames):
    """Price changes near a deal of the product and the vendor, valid on the day of the change."""
    changes = f.price_changes.select(F.lower("supc").alias("supc"), "vendor_code", "aud_date", "selling_price")
    deals = f.deals.select(F.lower("supc").alias("supc"), "vendor_code", (F.col("deal_op") * 0.5).alias("low"), (F.col("deal_op") * 1.5).alias("high"),
                           F.date_sub("start_date", REACH).alias("begins"), F.date_add("end_date", REACH).alias("ends"))
    out = IV.interval_join(changes, deals, ["supc", "vendor_code"], "selling_price", "low", "high", start="begins", end="ends", on="aud_date")
    return out.select("supc", "vendor_code", "aud_date", "selling_price", "low", "high", "begins")


# ---- wide correlations --------------------------------------------------------------------------

WIDE = {f"v{i:03d}": f"case when (l_orderkey * 7 + l_linenumber + {i}) % {11 + i % 5} <> 0 then raw_prediction * {i % 4} + "
                     f"cast((l_orderkey * {i + 3} + o2a * {i % 6}) % {17 + i} as double) end" for i in range(120)}
_NAMES = list(WIDE)


@query(ddb("""unpivot (select {} from wide) on columns(*) into name pair value corr""".format(
    ", ".join(f"coalesce(round(corr({a}, {b}), 6) + 0.0, 9) as {a}_{b}" for i, a in enumerate(_NAMES) for b in _NAMES[i:])),
           wide="select " + ", ".join(f"{e} as {c}" for c, e in WIDE.items()) + " from deliveries"))
def corr_matrix_wide(f: Frames):
    """All pairs of 120 columns with gaps of their own."""
    wide = f.deliveries.select(*[F.expr(e).alias(c) for c, e in WIDE.items()])
    out = MO.corr_matrix_wide(wide, _NAMES)
    return out.select(F.concat_ws("_", "var_a", "var_b").alias("pair"), F.coalesce(F.round("corr", 6) + F.lit(0.0), F.lit(9.0)).alias("corr"))


# ---- CSV part files -----------------------------------------------------------------------------

#: What is planted into a line, by the number of the order: the first that fits.
PLANTED = (("columns", "o_orderkey % 89 = 0"), ("o_totalprice", "o_orderkey % 97 = 0"), ("o_orderdate", "o_orderkey % 101 = 0"))
PLANT = "case " + " ".join(f"when {c} then '{r}'" for r, c in PLANTED) + " end"


@query(f"""select {PLANT} as reason, count(*) as n, case when {PLANT} is null then round(sum(o_totalprice), 2) end as total,
   case when {PLANT} is null then min(cast(o_orderdate as date)) end as first_day, case when {PLANT} is null then cast(sum(o_custkey) as bigint) end as customers,
   case when {PLANT} is null then cast(count(*) filter (o_orderkey % 3 = 0) as bigint) end as noted from orders group by 1""")
def csv_scan(f: Frames):
    """Orders as CSV part files with two headers and planted bad lines; types found, good rows read, bad lines counted by reason."""
    folder = f"{shared_dir(f.spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    orders = f.spark.read.parquet(f"{f.sf_dir}/orders.parquet").withColumn("plant", F.expr(PLANT))
    text = {"o_orderkey": F.col("o_orderkey").cast("string"), "o_custkey": F.col("o_custkey").cast("string"),
            "o_totalprice": F.when(F.col("plant") == "o_totalprice", "n/a").otherwise(F.col("o_totalprice").cast("string")),
            "o_orderdate": F.when(F.col("plant") == "o_orderdate", "soon").otherwise(F.to_date("o_orderdate").cast("string")),
            "note": F.lit('"a, b"')}
    for header, rows in ((["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], "o_orderkey % 3 <> 0"),
                         (["note", "o_orderdate", "o_totalprice", "o_custkey", "o_orderkey"], "o_orderkey % 3 = 0")):
        line = F.concat(F.concat_ws(",", *[text[c] for c in header]), F.when(F.col("plant") == "columns", ",one,more").otherwise(""))
        # a file of its own per partition, its header first
        bodies = orders.where(rows).select(line.alias("value")).repartition(3)
        CS.write_lines(bodies, f"{folder}/{len(header)}", ",".join(header))
    scan = CS.scan_csv(f.spark, [f"{folder}/4", f"{folder}/5"], max_bad=0.05)
    good = scan.good.agg(F.lit(None).cast("string").alias("reason"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                         F.min("o_orderdate").alias("first_day"), F.sum("o_custkey").cast("bigint").alias("customers"), F.count("note").alias("noted"))
    bad = scan.bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad, allowMissingColumns=True)
