"""Homomorphic multiset fingerprints of documents (native).

A document is the multiset of its paragraphs (lines). A paragraph is hashed to a wide vector of numbers modulo 2**60,
and a document's fingerprint is the sum of its paragraphs' vectors: the order of paragraphs doesn't matter,
and a paragraph is put in or taken out by one addition or subtraction, without the rest of the text.

The vector has three parts. Four lanes hold hashes of the whole paragraph; they make fingerprints of different
multisets differ. One lane counts the paragraph's pieces (runs of PIECE_WORDS words, the last may be shorter).
Twenty lanes count, three fields of 20 bits to a lane, how many pieces have each of 60 hash bits set. From
counts c of n pieces, ``2 * c - n`` is a sum of random signs per piece, whose mean square estimates how many
pieces a document has, or how many two documents don't share. That is the likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE_WORDS = 4
EXACT_LANES, COUNT_LANES, FIELDS, FIELD_BITS = 4, 20, 3, 20
MODULUS_MASK = (1 << 60) - 1
_ONES = sum(1 << (FIELD_BITS * f) for f in range(FIELDS))
#: A run of words on one line; the possessive quantifiers keep the match linear.
_PIECE = rf"(?:[^\x20\x09-\x0D]++[\x20\x09\x0B-\x0D]*+){{1,{PIECE_WORDS}}}"
#: Rows that a slice of the order holds on average, and quantiles the slices start from at most.
SLICE_ROWS, QUANTILES = 4_096, 256
#: Slices (two numbers each) that are sent to every executor at most.
BROADCAST_SLICES = 1_000_000


def fingerprint(text: Column) -> Column:
    """The fingerprint, an array of 25 numbers below 2**60; NULL counts as an empty text."""
    text = F.coalesce(text, F.lit(""))

    def masked(c):
        return c.bitwiseAND(F.lit(MODULUS_MASK))

    names = [f"e{i}" for i in range(EXACT_LANES)]
    exact = F.aggregate(
        F.split(text, "\n", -1), F.struct(*[F.lit(0).cast("long").alias(n) for n in names]),
        lambda acc, p: F.struct(*[masked(acc[n] + masked(F.xxhash64(F.lit(i), p))).alias(n) for i, n in enumerate(names)]),
        lambda acc: F.array(*[acc[n] for n in names]))
    lanes = [f"c{i}" for i in range(COUNT_LANES)]
    counts = F.aggregate(
        F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), lambda p: F.xxhash64(p)),
        F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0).cast("long").alias(n) for n in lanes]),
        lambda acc, h: F.struct(masked(acc["n"] + 1).alias("n"), *[
            masked(acc[n] + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_ONES))).alias(n) for i, n in enumerate(lanes)]),
        lambda acc: F.array(acc["n"], *[acc[n] for n in lanes]))
    return F.concat(exact, counts)


def with_paragraphs(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MODULUS_MASK)))


def without_paragraphs(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of ``a`` less those of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MODULUS_MASK)))


def as_text(print_: Column) -> Column:
    """All lanes as hex digits."""
    return F.lower(F.array_join(F.transform(print_, lambda x: F.lpad(F.hex(x), 15, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """About the share of pieces that two documents have in common (Dice), 0 to 1; equal fingerprints give 1."""
    field = (1 << FIELD_BITS) - 1

    def signed(p: Column, i: Column) -> Column:
        lane = F.element_at(p, (EXACT_LANES + 2 + F.floor(i / FIELDS)).cast("int"))
        count = F.call_function("shiftright", lane, (i % FIELDS * FIELD_BITS).cast("int"))
        return (2 * count.bitwiseAND(F.lit(field)) - F.element_at(p, EXACT_LANES + 1)).cast("double")

    sums = F.aggregate(
        F.sequence(F.lit(0), F.lit(COUNT_LANES * FIELDS - 1)), F.struct(F.lit(0.0).alias("apart"), F.lit(0.0).alias("all")),
        lambda acc, i: F.struct((acc["apart"] + F.pow(signed(a, i) - signed(b, i), F.lit(2.0))).alias("apart"),
                                (acc["all"] + F.pow(signed(a, i), F.lit(2.0)) + F.pow(signed(b, i), F.lit(2.0))).alias("all")))
    part = F.when(sums["all"] > 0, F.greatest(F.lit(0.0), 1 - sums["apart"] / sums["all"])).otherwise(0.0)
    return F.when(a == b, F.lit(1.0)).otherwise(part)


def _slices(ids: DataFrame) -> tuple[Column, int]:
    """A number that grows as ``id`` falls, about SLICE_ROWS rows each, NULL ids last; and how many there are at most.

    Quantiles (a bounded list) cut the ids into parts and each part into equal ranges.
    """
    n = ids.count()
    steps = min(QUANTILES, n // SLICE_ROWS + 1)
    row = ids.agg(F.percentile_approx("id", [i / steps for i in range(steps + 1)], F.lit(10_000)).alias("q")).first()
    edges = sorted(set(row["q"] or [0]))
    fine = max(1, -(-n // (len(edges) * SLICE_ROWS)))
    tops = F.array(*[F.lit(e).cast("long") for e in edges])
    part = F.aggregate(tops, F.lit(0), lambda acc, e: acc + F.when(e <= F.col("id"), 1).otherwise(0))
    inside = F.lit(0)
    if fine > 1:
        low, high = F.get(tops, part - 1), F.coalesce(F.get(tops, part), F.lit(edges[-1]).cast("long") + 1)
        share = (F.col("id") - low).cast("double") / F.greatest((high - low).cast("double"), F.lit(1.0))
        inside = F.least(F.lit(fine - 1), F.coalesce(F.floor(share * fine).cast("int"), F.lit(0)))
    number = F.when(F.col("id").isNull(), F.lit(1)).otherwise(-(part * fine + inside)).cast("long")
    return number, (len(edges) + 1) * fine + 1


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, fp, next_text, next_fp): every row with the row after it, in descending order of id, in a circle.

    Rows of one id are in order of their text's hash, NULL ids come last. The window runs per slice of the
    order; the first row of a slice is also put at the end of the slice before, so that no slice needs another.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slice_no, most = _slices(rows)
    rows = rows.withColumn("slice", slice_no).withColumn("h", F.xxhash64("text"))
    tops = rows.groupBy("slice").agg(F.max("id").alias("top"))
    known = tops.withColumnRenamed("slice", "s")
    # the number of slices is known, so the texts need not move to find the first of each
    heads = rows.join(F.broadcast(known) if most <= BROADCAST_SLICES else known, (F.col("slice") == F.col("s")) & F.col("id").eqNullSafe(F.col("top")))
    first = heads.groupBy("slice").agg(F.min(F.struct("h", "text")).alias("m")).select("slice", "m.h", "m.text")
    circle = Window.orderBy("slice")
    order = tops.select("slice", F.coalesce(F.lag("slice").over(circle), F.max("slice").over(Window.partitionBy(F.lit(0)))).alias("goes_to"))
    guests = first.join(order, "slice").select(F.lit(None).cast("long").alias("id"), "text", F.col("goes_to").alias("slice"), "h", F.lit(1).alias("guest"))
    seats = rows.withColumn("guest", F.lit(0)).unionByName(guests).withColumn("fp", fingerprint(F.col("text")))
    line = Window.partitionBy("slice").orderBy("guest", F.col("id").desc_nulls_last(), "h", "text")
    return (seats.withColumn("next_text", F.lead("text").over(line)).withColumn("next_fp", F.lead("fp").over(line))
            .where("guest = 0").select("id", "text", "fp", "next_text", "next_fp"))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fp, edited_fp, near_edited, near_next) for every row.

    The edited text has the last third (floor) of its code points replaced by as many (or all) of the first
    of the next document, in descending order of id, the first one following the last. NULL text is
    empty. A table of one row follows itself; an empty table gives no rows; repeated rows count one by one.
    """
    rows = with_next_text(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third))
    rows = rows.select("id", "n_chars", edited.alias("edited"), "fp", "next_fp")
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited", "fp", "edited_fp",
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
