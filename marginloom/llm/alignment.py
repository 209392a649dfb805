"""Alignment of two tokenizations of the same bytes by merge-path partitioning.

The ends of A's and of B's tokens are two sorted lists. Merging them is a path through a grid; its crossing with a
diagonal, found by binary search, says how many ends of either list are among the first so many of the merged ones.
Equidistant diagonals therefore cut the work of a batch into equal pieces, whatever the lengths of its texts and
however unlike their tokens are. Each piece is worked off on its own: it finds the ends both lists share, the spans
of tokens between them, and the pairs of tokens that overlap; the group open at a piece's edge is stitched to the
next piece by the running totals both carry.

The texts of a batch lie one after another on one axis, each starting where the one before ends, so both lists share
every text's end and no group or overlap crosses it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.llm import bpe
from marginloom.llm.common import arrow_rows, checkpoint_dir

#: Ends of both lists that a piece merges, and bytes of text that are aligned together.
PIECE, PORTION = 1 << 15, 1 << 20
#: Words whose ids a worker keeps; two generations of them beside the other model's tables.
WORDS = 150_000
#: A pair that holds this share of all links or more is sent to every task; so at most this many are.
SENT_PAIRS = 100_000
#: An id pair is one number: A's id times this and B's id.
B_IDS = 1 << 20
SPACE = "▁"


def crossing(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many of a and of b are among the first ``diagonal`` of both merged; equal ones of a come first."""
    low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
    while low < high:
        mid = (low + high) // 2
        if a[mid] <= b[diagonal - mid - 1]:
            low = mid + 1
        else:
            high = mid
    return low, diagonal - low


def pieces(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> list[tuple[int, int, int, int]]:
    """Equal work: (a from, a to, b from, b to) between consecutive diagonals; a shared end is kept in one piece."""
    edges = [(0, 0)]
    for diagonal in range(size, len(a) + len(b), size):
        i, j = crossing(a, b, diagonal)
        if i and j < len(b) and a[i - 1] == b[j]:
            j += 1
        edges.append((i, j))
    edges.append((len(a), len(b)))
    return [(*x, *y) for x, y in zip(edges, edges[1:]) if x != y]


def merged_piece(a: np.ndarray, b: np.ndarray, at: tuple[int, int, int, int], overlaps: bool = True) -> tuple[np.ndarray, ...]:
    """Of one piece, all as indexes into the whole lists: (A tokens, B tokens) that end together and, unless left out, (A tokens,
    B tokens) that overlap.

    Each interval between neighbouring ends of the merged list lies in one A and one B token, those whose ends come
    next; an interval without bytes, which follows a shared end, counts once.
    """
    i, j, i_to, j_to = at
    x, y = a[i:i_to], b[j:j_to]
    where = np.searchsorted(y, x)
    common = np.flatnonzero((where < len(y)) & (y[np.minimum(where, max(len(y) - 1, 0))] == x)) if len(x) and len(y) else np.zeros(0, np.int64)
    if not overlaps:
        return common + i, where[common] + j
    in_b = np.r_[where + j, np.arange(j, j_to)]  # the token of B over the interval that an end of A closes, and B's own
    in_a = np.r_[np.arange(i, i_to), np.searchsorted(x, y) + i]
    ends = np.r_[x, y]
    order = np.argsort(ends, kind="stable")
    once = order[np.r_[True, np.diff(ends[order]) > 0]] if len(order) else order
    return common + i, where[common] + j, in_a[once], in_b[once]


def aligned(a: np.ndarray, b: np.ndarray, size: int = PIECE, overlaps: bool = True) -> tuple[np.ndarray, ...]:
    """The pieces' results in order; a group's tokens run from the shared end before it to its own."""
    found = [merged_piece(a, b, p, overlaps) for p in pieces(a, b, size)]
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * (4 if overlaps else 2)))


class PieceTable:
    """The library's model with the bytes of each of its ids."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        if n > B_IDS:
            raise ValueError(f"more than {B_IDS} ids")
        piece = self.model.id_to_piece
        self.bytes_of = [bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace(SPACE, " ").encode() for i in range(n)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    @classmethod
    def of_process(cls, path: str) -> PieceTable:
        """The table that this worker process keeps from task to task."""
        kept = vars(sys).setdefault("_marginloom_piece_tables", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]


class ShortPieces:
    """Ids of short pieces by tiktoken, which joins the two neighbours that spell the earliest merged token.

    A merge list joins them only if they are the two its merge names. Neighbours that spell a token but aren't named
    come up just if the token's own bytes don't become that token. So where all tokens do, both give the same ids.
    """

    def __init__(self, merges: bpe.MergeList):
        spelt = merges.bytes_of
        self.ids = [*merges.single, *merges.made]
        ranks = {spelt[i]: n for n, i in enumerate(self.ids)}
        if len(ranks) < len(self.ids) or any(merges.encode(spelt[i]) != [i] for i in merges.made):
            raise ValueError("a token that its own bytes don't become")
        self.encode = tiktoken.Encoding("merges", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, piece: str) -> list[int]:
        return list(map(self.ids.__getitem__, self.encode(piece)))


def short_pieces(merges: bpe.MergeList) -> ShortPieces | None:
    """None where the vocabulary doesn't allow it: the merge list is used then."""
    try:
        return ShortPieces(merges)
    except ValueError:
        return None


def word_encoder(json_path: str, pattern: str) -> bpe.Encoder:
    """The encoder that this worker process keeps from task to task."""
    kept = vars(sys).setdefault("_marginloom_word_encoders", {})
    if (key := (json_path, pattern)) not in kept:
        merges = bpe.of_process(json_path).merges
        kept[key] = bpe.Encoder(merges, pattern, None, WORDS, short_pieces(merges))
    return kept[key]


class Spelling:
    """Bytes and lengths of both vocabularies' ids, and how an id is written before each separator."""

    def __init__(self, a_bytes: dict[int, bytes], b_bytes: list[bytes]):
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_size = np.array([len(a_bytes.get(i, b"")) for i in range(max(a_bytes) + 1)])
        self.b_size = np.array([len(x) for x in b_bytes])
        self.written = [f"{i}{mark}" for n, end in ((len(self.a_size), "|"), (len(self.b_size), ";")) for mark in (",", end) for i in range(n)]

    @classmethod
    def of_process(cls, json_path: str, model_path: str, merges: bpe.MergeList, table: PieceTable) -> Spelling:
        """The one that this worker process keeps from task to task."""
        kept = vars(sys).setdefault("_marginloom_spellings", {})
        if (key := (json_path, model_path)) not in kept:
            kept[key] = cls(merges.bytes_of, table.bytes_of)
        return kept[key]


class Portion:
    """Some texts' tokens on one axis of bytes, aligned together."""

    def __init__(self, spelling: Spelling):
        self.spelling = spelling
        self.a_ids: list[list[int]] = []
        self.b_ids: list[list[int]] = []

    def add(self, text: str, a: list[int], b: list[int]) -> None:
        """A text whose tokens don't spell it out has none."""
        whole, s = b" " + text.encode("utf-8", "replace"), self.spelling
        spelt = text and b"".join(map(s.a_bytes.__getitem__, a)) == whole and b"".join(map(s.b_bytes.__getitem__, b)) == whole
        self.a_ids.append(a if spelt else [])
        self.b_ids.append(b if spelt else [])

    def columns(self, size: int, overlaps: bool = True) -> list[pa.Array]:
        """n_a, n_b, groups, links of every text, and its overlaps."""
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (self.a_ids, self.b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=n.sum()) for ids, n in ((self.a_ids, n_a), (self.b_ids, n_b)))
        found = aligned(np.cumsum(self.spelling.a_size[a]), np.cumsum(self.spelling.b_size[b]), size, overlaps)
        end_a, end_b = found[:2]
        of = np.repeat(np.arange(len(n_a)), n_a)  # the text of a token of A
        lists = []
        for x, y in zip(found[::2], found[1::2]):
            offsets = np.r_[0, np.cumsum(np.bincount(of[x], minlength=len(n_a)))].astype(np.int32)
            lists.append(pa.ListArray.from_arrays(offsets, pa.array(a[x] * B_IDS + b[y])))
        return [pa.array(n_a), pa.array(n_b), pa.array(self._groups(a, b, end_a, end_b, n_a + n_b), pa.string()), *lists]

    def _groups(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, n: np.ndarray) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3``: the written ids of each group's A tokens, then of its B tokens."""
        stop_a, stop_b = (np.zeros(len(x), dtype=bool) for x in (a, b))
        stop_a[end_a] = stop_b[end_b] = True
        group_a, group_b = (np.cumsum(x) - x for x in (stop_a, stop_b))  # groups that end before a token
        ids = np.empty(len(a) + len(b), dtype=np.int64)
        ids[np.arange(len(a)) + np.r_[0, end_b + 1][group_a]] = a + len(self.spelling.a_size) * stop_a
        ids[np.arange(len(b)) + np.r_[end_a + 1, 0][group_b]] = b + len(self.spelling.b_size) * stop_b + 2 * len(self.spelling.a_size)
        upto = np.cumsum(n).tolist()
        written, ids = self.spelling.written.__getitem__, ids.tolist()
        return ("".join(map(written, ids[i:j]))[:-1] for i, j in zip([0, *upto], upto))


def align_documents(docs: DataFrame, json_path: str, pattern: str, model_path: str, id_col: str = "doc_id",
                    text_col: str = "text", piece: int = PIECE, overlaps: bool = True) -> DataFrame:
    """(id, row, n_a, n_b, groups, links and, unless left out, overlaps) of every row.

    A's tokens are those of a blank and the text, B's those of the text, to which its model adds the blank. ``groups``
    spells out the ids between shared ends, ``links`` are the pairs whose ends meet, one per group, ``overlaps`` those
    whose byte ranges meet in a byte or more; a pair is one number, A's id times ``B_IDS`` and B's id. ``row`` tells rows apart.

    NULL and empty texts, and texts that either tokenizer's bytes don't spell out, have no tokens: zeros, an empty
    string, empty lists. Invalid UTF-8 is read as U+FFFD. Rows stay as they are, also those repeating an id and those
    without one; other columns are not read; an empty table gives no rows. Nothing is shuffled.
    """
    arrow_rows(docs.sparkSession, 500)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, row long, n_a long, n_b long, groups string, links array<long>" + ", overlaps array<long>" * overlaps
    names = [id_col, "row", "n_a", "n_b", "groups", "links", "overlaps"][:7 if overlaps else 6]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = word_encoder(json_path, pattern), PieceTable.of_process(model_path)
        spelling = Spelling.of_process(json_path, model_path, encoder.merges, table)
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [bpe.text_of(x) for x in batch.column(1)]
            begin = 0
            while begin < len(texts):
                upto, size = begin, 0
                while upto < len(texts) and (upto == begin or size + len(texts[upto]) <= PORTION):
                    size += len(texts[upto])
                    upto += 1
                portion = Portion(spelling)
                own = texts[begin:upto]
                for text, b in zip(own, table.encode(own)):
                    portion.add(text, encoder.encode(" " + text) if text else [], b)
                rows = pa.array(np.arange(made, made + len(own)))
                made += len(own)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(own)), rows, *portion.columns(piece, overlaps)], names=names)
                begin = upto

    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(align, schema)


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: columns compress there, which a checkpoint's don't."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/aligned-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def weigh_links(rows: DataFrame, links_col: str = "links", keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, n_links, n_best, count_sum) of rows that hold lists of id pairs.

    A pair's count is how often all rows together hold it; ``n_best`` are a row's links whose count is the highest of
    their B id, ties included, ``count_sum`` adds the counts up over the links. Pairs that hold a ``SENT_PAIRS``-th of
    all links or more are sent out: there are no more than that many of them, however large the table is. The links
    of the others, none of which is frequent, are counted per row and joined by pair. A NULL or empty list gives zeros. An
    empty table gives no rows.
    """
    kept = [*keep]
    table = _written(rows.select(F.struct(*kept).alias("kept"), F.col(links_col).alias("links")).withColumn("row", F.uuid())) \
        if "row" not in rows.columns else _written(rows.select(F.struct(*kept).alias("kept"), F.col(links_col).alias("links"), "row"))
    single = table.select("row", F.explode("links").alias("pair"))
    counts = single.groupBy("pair").agg(F.count("*").alias("n"))
    counts = _written(counts)
    b_id = F.expr(f"pmod(pair, {B_IDS})")
    best = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))  # a row per B id at most
    judged = _written(counts.withColumn("b", b_id).join(best, "b").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()["t"]
    frequent = judged.where(F.col("n") * SENT_PAIRS >= total)
    rest = judged.where(F.col("n") * SENT_PAIRS < total)
    sums = [F.sum(F.col("c") * F.col("best")).alias("n_best"), F.sum(F.col("c") * F.col("n")).alias("count_sum")]
    sent = single.join(F.broadcast(frequent), "pair").withColumn("c", F.lit(1)).groupBy("row").agg(*sums)
    joined = (single.join(F.broadcast(frequent.select("pair")), "pair", "left_anti").groupBy("row", "pair").agg(F.count("*").alias("c"))
              .join(rest, "pair").groupBy("row").agg(*sums))
    per_row = sent.union(joined).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (table.select("kept", "row", F.size(F.coalesce("links", F.array().cast("array<long>"))).cast("long").alias("n_links"))
            .join(per_row, "row", "left").select("kept.*", "n_links", none("n_best"), none("count_sum")))
