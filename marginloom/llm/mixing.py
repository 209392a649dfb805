"""Mixing sources to target weights by weighted sampling without replacement.

Targets are shares of all words, held under a number of epochs of their source. A source first gives its
complete epochs; the fraction left is taken in the order of the Efraimidis-Spirakis keys ``-ln(u) / weight``,
smallest first, until its words fill the budget. The order is never built whole: words are summed per slice of
the key, the slice in which the budget ends is found from the sums, and only its rows are sorted. What comes out is one row
per source, the largest key that is still taken, so the decision joins the documents without moving texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginloom.llm.common import WORD, cut

#: Rows of one source that a slice of the key holds on average.
SLICE_ROWS = 2_000
#: Sources (one row each) that are sent to every executor at most; more are joined by source.
BROADCAST_SOURCES = 500_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 to 2: how near the mean word length comes to that of prose (4 to 8 characters); 1 for no text."""
    words = F.greatest(word_count(text), F.lit(1))
    mean = F.char_length(F.coalesce(text, F.lit(""))) / words
    return F.lit(1.0) + F.exp(-F.abs(mean - 6.0) / 4.0)


def sampling_key(id_: Column, weight: Column, seed: int = 7) -> Column:
    """``-ln(u) / weight`` with u drawn from the id, the same on every run; a NULL id draws like any other."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / F.when(weight > 0, weight).otherwise(F.lit(1e-9))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, key): all that the plan needs, without texts."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       sampling_key(F.col(id_col), quality_weight(F.col(text_col))).alias("key"))


def source_targets(totals: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = 3) -> DataFrame:
    """Adds ``target`` to (source, source_size): shares by weight, none above ``max_epochs`` of its source.

    Sources in order of code points, NULL last, get the weights in turn. Handing the excess to the others
    again and again ends where every source has the smaller of its cap and a common level times its
    weight; sorted by cap over weight, that level follows from running sums. One row per source is sorted.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(ranked) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    all_rows, by_ratio = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("ratio", "turn")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rows = (totals.withColumn("turn", turn).withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("ratio", F.col("cap") / F.col("weight")))
    rows = (rows.withColumn("all_words", F.sum("source_size").over(all_rows).cast("double"))
            .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("open_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("level", (F.col("all_words") - F.col("capped")) / F.col("open_weight")))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(all_rows)
    return (rows.withColumn("final", F.coalesce(level, F.max("ratio").over(all_rows)))
            .withColumn("target", F.least("cap", F.col("weight") * F.col("final"))).drop("capped", "open_weight", "level", "all_words", "final", "ratio", "turn"))


def _per_source(rows: DataFrame, sources: int) -> DataFrame:
    """A table of at most ``sources`` rows, sent out if that is few, so that a source with most rows needs no shuffle."""
    return F.broadcast(rows) if sources <= BROADCAST_SOURCES else rows


def mixing_plan(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = 3) -> DataFrame:
    """One row per source: source_size, target, epochs, last_key (the largest key of the fraction; NULL: none).

    Rows of one key stay together; a key is taken if the middle of its words lies within the budget, so
    the words taken miss the target by half a document at most.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = (source_targets(totals, weights, max_epochs)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
            .withColumn("slices", F.ceil(F.col("n") / SLICE_ROWS)))
    plan = cut(plan.select("source", "source_size", "target", "epochs", "budget", "slices"))

    sources = plan.count()
    of = plan.select(F.col("source").alias("s"), "budget", "slices")
    keyed = (sizes.join(_per_source(of, sources), F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("slice", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("slices"))))
    sums = keyed.groupBy("source", "slice", "budget").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("slice")
    last = (sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
            .where((F.col("before") < F.col("budget")) & (F.col("budget") > 0))
            .withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("slice")))).where("n = 1")
            .select(F.col("source").alias("s"), F.col("slice").alias("end_slice"), "before"))
    edge = keyed.join(_per_source(last, sources), F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("end_slice")))
    per_key = edge.groupBy("source", "key", "before", "budget", "slice").agg(F.sum("size").alias("words"))
    running = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key")) - F.col("words") / 2
    in_slice = per_key.withColumn("middle", running)
    # a budget that ends in the first key of a slice takes all earlier slices and nothing of this one
    cut_at = in_slice.groupBy("source").agg(
        F.max(F.when(F.col("middle") <= F.col("budget"), F.col("key"))).alias("last_in"), F.min("key").alias("first"))
    ends = cut_at.select(F.col("source").alias("e"), "last_in", "first")
    return (plan.join(ends, F.col("source").eqNullSafe(F.col("e")), "left")
            .select("source", "source_size", "target", "epochs", F.col("last_in").alias("last_key"),
                    F.col("first").alias("below_key")))


def copies(key: Column) -> Column:
    """How often a document is taken, given its key and the columns of its source's plan."""
    chosen = F.when(F.col("last_key").isNotNull(), key <= F.col("last_key")).otherwise(
        F.coalesce(key < F.col("below_key"), F.lit(False)))
    return F.col("epochs") + chosen.cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = 3) -> DataFrame:
    """(id, size, source_size, target, taken, copies) for every row of ``docs``.

    ``size`` counts words (NULL text: 0), ``target`` is the share of the row's source, ``taken`` the words
    the mix takes of the row, repeats included: a whole number of copies, at most ``max_epochs``. A NULL
    source is a source, the last one. Rows of one id have one key and are taken together. An empty
    table gives no rows; a source without words has target 0.
    """
    sizes = cut(measured(docs, id_col, text_col, source_col))
    plan = cut(mixing_plan(sizes, weights, max_epochs).withColumnRenamed("source", "s"))
    rows = sizes.join(_per_source(plan, plan.count()), F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", copies(F.col("key")))
    return rows.select(F.col("id").alias(id_col), "size", "source_size", F.col("target").cast("double").alias("target"),
                       (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = 3) -> DataFrame:
    """The documents of the mix: rows as they are, each repeated as often as the mix takes it.

    A document without words follows the copies of its key like any other.
    """
    plan = cut(mixing_plan(cut(measured(docs, id_col, text_col, source_col)), weights, max_epochs)).withColumnRenamed("source", "s")
    key = sampling_key(F.col(f"row.{id_col}"), quality_weight(F.col(f"row.{text_col}")))
    rows = docs.select(F.col(source_col).alias("of"), F.struct("*").alias("row"))
    taken = rows.join(_per_source(plan, plan.count()), F.col("of").eqNullSafe(F.col("s"))).withColumn("copies", copies(key).cast("int"))
    return taken.where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
