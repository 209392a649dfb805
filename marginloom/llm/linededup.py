"""Lines that repeat across documents (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.llm.common import ascii_lower, strip_spaces


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    """128 bits, so that a chance collision can't make a line look frequent."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def _key(line: Column) -> Column:
    return ascii_lower(strip_spaces(line))


def _text_mark(text: Column) -> list[Column]:
    """Tells different texts of one id apart."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("mark"), F.char_length(whole).alias("chars")]


def _without(lines: Column, lost: Column) -> Column:
    """The lines but those at the sorted positions ``lost``: the slices between them, one after the other.

    The lines are bound to a variable, so that the text is split once and the work is linear in the lines.
    """
    def slices(whole: Column) -> Column:
        def gap(k: Column) -> Column:
            before = F.coalesce(F.get(lost, k - 1), F.lit(-1))
            after = F.coalesce(F.get(lost, k), F.size(whole))
            return F.slice(whole, before + 2, after - before - 1)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(lost)), gap))
    return F.element_at(F.transform(F.array(lines), slices), 1)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Input rows with ``text`` free of repeated lines, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Keys of at least
    ``min_chars`` code points found in at least ``min_docs`` different ids lose their lines everywhere but
    in the largest id that holds them. Lines are exploded as hashes with their positions; the texts move
    once, to meet the positions that they lose, and are put together again from the slices between these.

    NULL or empty text is one empty line and stays as it is. A row with a NULL id counts as no document
    and keeps all its lines. Rows that repeat an id are one document. Columns named ``n_lines`` or
    ``n_dropped`` are replaced; all others pass through.
    """
    text = F.col(f"row.{text_col}")
    rows = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row"))
    rows = rows.select("id", "row", *_text_mark(text))
    exploded = rows.where(F.col("id").isNotNull()).select("id", "mark", "chars", F.posexplode(_lines(text)).alias("pos", "line"))
    held = (exploded.select("id", "mark", "chars", "pos", strip_spaces(F.col("line")).alias("line")).where(F.char_length("line") >= min_chars)
            .select("id", "mark", "chars", "pos", _hash(ascii_lower(F.col("line"))).alias("h")))
    frequent = (held.select("id", "h").distinct().groupBy("h").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
                .where(F.col("n") >= min_docs).select("h", "keeper"))
    # one text of one id: its lost positions; equal rows of an id lose the same ones
    losses = (held.join(frequent, "h").where(F.col("id") < F.col("keeper"))
              .groupBy(F.col("id").alias("loser"), F.col("mark").alias("of_mark"), F.col("chars").alias("of_chars"))
              .agg(F.array_sort(F.collect_set("pos")).alias("lost")))

    same = (rows["id"] == losses["loser"]) & (rows["mark"] == losses["of_mark"]) & (rows["chars"] == losses["of_chars"])
    judged = rows.join(losses, same, "left").select(
        "row", F.size(_lines(text)).cast("long").alias("n_lines"), F.when(F.col("lost").isNotNull(), _without(_lines(text), F.col("lost"))).alias("kept"))
    new = {text_col: F.when(F.col("kept").isNull(), F.col(f"row.{text_col}")).otherwise(F.array_join("kept", "\n")),
           "n_lines": F.col("n_lines"),
           "n_dropped": F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long")}
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return judged.select(*[new[c].alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names],
                         new["n_lines"].alias("n_lines"), new["n_dropped"].alias("n_dropped"))
