"""Spelling variants by Bloom-guided neighbourhoods.

Every word of the vocabulary generates its edits as hashes only: a polynomial hash changes by one term for a replaced
character, and is put together from a prefix and a suffix for a deleted one. The hashes are probed in blocked Bloom
filters, one per word length, that are sent to every task; a block is one 64-bit word, so a probe reads one place.
Only edits that a filter knows become strings and are joined to the vocabulary, which removes the false positives.
Two words a deletion apart are found from the longer one, two a replacement apart from the one with the smaller
character, so each pair is found once.

The filters have ``BITS_PER_WORD`` bits a word up to ``MOST_BLOCKS`` blocks in all. A larger vocabulary fills them
more and lets more edits through to the join; the pairs found are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.llm.common import arrow_rows, ascii_lower, cut

RUN = r"[A-Za-zÀ-ÿ]+"
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.uint64)
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
#: Of (id, run) pairs whose crc32 this divides, the run loses a character.
SLIP = 31
BITS_PER_WORD = 24
#: Blocks of 8 bytes in all filters together: 32 MB at most are sent out.
MOST_BLOCKS = 1 << 22
_BASE, _BLOCK, _BITS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mask(h: np.ndarray) -> np.ndarray:
    """Four bits of a block, by six bits of the scattered hash each."""
    x = (h ^ (h >> np.uint64(31))) * _BITS
    out = np.zeros_like(h)
    for shift in (40, 46, 52, 58):
        out |= np.uint64(1) << ((x >> np.uint64(shift)) & np.uint64(63))
    return out


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    """The place among ``blocks``, from the upper half of another scattering."""
    x = ((h ^ (h >> np.uint64(29))) * _BLOCK) >> np.uint64(32)
    return ((x * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, dtype=np.uint64)
    out[1:] = np.cumprod(np.full(n, _BASE), dtype=np.uint64)
    return out


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1).astype(np.uint64)


def _hashed(codes: np.ndarray) -> np.ndarray:
    return (codes * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


def edits(codes: np.ndarray, known) -> Iterator[tuple[np.ndarray, str, int, int]]:
    """(rows, kind, place, character) of the edits of words of one length that ``known(length, hashes)`` lets pass.

    Of a character repeated in a row only the last is deleted; a replacement is a larger character.
    """
    n = codes.shape[1]
    power = _powers(n)
    terms = codes * power[:-1]
    whole = terms.sum(axis=1, dtype=np.uint64)
    # a suffix moved one place down: its hash with powers less by one
    suffix = np.zeros((len(codes), n + 1), dtype=np.uint64)
    suffix[:, 1:n] = np.cumsum((codes[:, 1:] * power[:n - 1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    prefix = np.zeros(len(codes), dtype=np.uint64)
    for i in range(n):
        last = np.ones(len(codes), dtype=bool) if i + 1 == n else codes[:, i] != codes[:, i + 1]
        rows = np.flatnonzero(last)
        hit = rows[known(n - 1, (prefix + suffix[:, i + 1])[rows])]
        if len(hit):
            yield hit, "delete", i, 0
        prefix = prefix + terms[:, i]
        rest = whole - terms[:, i]
        for c in LETTERS:
            rows = np.flatnonzero(codes[:, i] < c)
            if len(rows):
                hit = rows[known(n, rest[rows] + c * power[i:i + 1])]
                if len(hit):
                    yield hit, "replace", i, int(c)


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: str = RUN, slip: int = SLIP) -> DataFrame:
    """(word) for every run of letters, lower-cased A-Z only, some without one of their characters.

    With h the crc32 of ``<id>:<run>``, where ``slip`` divides h the character h modulo the length is left out. A
    row without an id has no h and keeps its runs; NULL texts have none.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(run), F.lit(0))).alias("run"))
    low = runs.select("id", ascii_lower(F.col("run")).alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return low.select(F.when(F.col("h") % slip == 0, short).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def bloom_filters(vocab: DataFrame) -> dict[int, np.ndarray]:
    """By word length the blocks of its filter; together they stay within ``MOST_BLOCKS``, whatever the vocabulary.

    The blocks are made on the executors, a bit-wise or per block, so the driver gets one row per block at most.
    """
    counts = {r["length"]: r["n"] for r in vocab.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    # a length of few words has a block, so lengths share the blocks that are left after one each
    lengths = sorted(counts, key=lambda k: (-counts[k], k))[:MOST_BLOCKS // 2]
    want = {k: max(1, math.ceil(counts[k] * BITS_PER_WORD / 64)) for k in lengths}
    share = min(1.0, MOST_BLOCKS / 2 / max(1, sum(want.values())))
    blocks = {k: max(1, int(n * share)) for k, n in want.items()}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for n, rows in _by_length(words):
                if n in blocks:
                    h = _hashed(_codes([words[i] for i in rows]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), n)), pa.array(_block(h, blocks[n])),
                                                      pa.array(_mask(h).view(np.int64))], names=["length", "block", "bits"])

    made = vocab.select("word").mapInArrow(fill, "length long, block long, bits long").groupBy("length", "block").agg(F.bit_or("bits").alias("bits"))
    out = {k: np.zeros(n, dtype=np.uint64) for k, n in blocks.items()}
    rows = made.toArrow()
    length, block, bits = (rows.column(i).to_numpy() for i in range(3))
    for k, filled in out.items():
        own = length == k
        filled[block[own]] = bits[own].view(np.uint64)
    return out


def candidates(vocab: DataFrame, filters: dict[int, np.ndarray]) -> DataFrame:
    """(word, n, other): the edits of each word that a filter knows; a filter of a length outside all is empty."""
    shared = vocab.sparkSession.sparkContext.broadcast(filters)
    out = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def known(length: int, h: np.ndarray) -> np.ndarray:
            if (blocks := shared.value.get(length)) is None:
                return np.zeros(len(h), dtype=bool)
            mask = _mask(h)
            return (blocks[_block(h, len(blocks))] & mask) == mask

        for batch in batches:
            words, count = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for _, own in _by_length(words):
                named = [words[i] for i in own]
                for hit, kind, i, c in edits(_codes(named), known):
                    new = "" if kind == "delete" else chr(c)
                    yield pa.RecordBatch.from_arrays([pa.array([named[j] for j in hit]), pa.array(count[own[hit]]),
                                                      pa.array([named[j][:i] + new + named[j][i + 1:] for j in hit])], schema=out)

    return vocab.select("word", "n").mapInArrow(probe, "word string, n long, other string")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n): all words one character apart, both ways."""
    found = candidates(vocab, bloom_filters(vocab)).join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    both = F.array(F.struct("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")),
                   F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return found.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of (word, form) by doubling: after k turns 2^k forms are followed, ``steps`` in all at least."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        up = at.select(F.col("word").alias("root"), F.col("root").alias("top"))
        at = cut(at.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root")))
    return at


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                   min_count: int = MIN_COUNT, times: int = TIMES, slip: int = SLIP, run: str = RUN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    A word's form is its near word (one character inserted, deleted or replaced) of largest n, ties by the smallest
    in code-point order, if that n is at least ``times`` its own; root follows forms to the last and is the word
    itself where there is no form. As n grows with every form, a chain is at most log(largest n) long.

    NULL and empty texts have no words, repeated rows count each time, a row without an id keeps its runs whole. An
    empty table gives no rows. Only the id and the text are read. Replacements and insertions are searched among the
    letters that ``RUN`` allows. Words are counted before they are shuffled, and near words are too few to crowd.
    """
    arrow_rows(docs.sparkSession, 20_000)
    vocab = cut(vocabulary(words_of(docs, id_col, text_col, run, slip), min_length, min_count))
    largest: Column = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), largest.alias("m"))
    far = (-F.col("m.n")) >= times * F.col("n")
    judged = cut(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(far, F.col("m.word")).alias("form"), F.when(far, -F.col("m.n")).alias("form_n")))
    top = judged.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(top, max(2, times)))) + 1 if times > 1 else top
    chains = roots(judged.where("form is not null").select("word", "form"), steps)
    return judged.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
