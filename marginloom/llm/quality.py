"""Repetition coverage and base rules for document quality.

The words of a batch of documents stand in one numpy array of hashes. Windows of n words get rolling
hashes, salted by document; a window of n words can only repeat where its first n - 1 words repeat, so each
length looks at the survivors of the one before. Coverage is measured in characters of words that lie
inside a repeat of an earlier window, which keeps a short clean text with one repeated phrase low.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from marginloom.llm.common import arrow_rows

#: Largest share of a document's word characters that one n-gram may add by coming again.
TOP_NGRAM = {2: 0.20, 3: 0.18, 4: 0.16}
#: Largest share of word characters inside repeats of n-grams.
REPEATED_NGRAM = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of lines (one alone never counts), and of word characters in lines, that repeat an earlier line.
REPEATED_LINES, REPEATED_LINE_CHARS = 0.30, 0.20
MIN_WORDS, MAX_REPEAT_PERCENT, BASE_WINDOW = 20, 30, 8
SYMBOLS, SPACE_BYTES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
#: Words that are hashed together; a batch of texts is worked off in such portions.
PORTION = 1 << 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SHARES = [f"top_{n}" for n in TOP_NGRAM] + [f"repeated_{n}" for n in REPEATED_NGRAM] + ["repeated_line_chars"]
MEASURES = StructType([StructField(c, LongType()) for c in COUNTS] + [StructField(c, DoubleType()) for c in SHARES])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers (a finaliser of the splitmix kind)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeats(keys: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose key occurs twice or more, whether each is the first of its key, and the count of its key."""
    if len(keys) < 2:
        return where[:0], np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
    order = np.argsort(keys)
    ranked = keys[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[starts, len(ranked)])
    firsts = np.minimum.reduceat(where[order], starts)
    many = np.repeat(sizes > 1, sizes)
    at = where[order][many]
    return at, at == np.repeat(firsts, sizes)[many], np.repeat(sizes, sizes)[many]


def _covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    edge = np.zeros(total + 1, dtype=np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _portion(words: list[bytes], lengths: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Repeat measures of documents whose words stand one after the other; ``counts``: words of each document."""
    docs, total = len(counts), len(words)
    doc = np.repeat(np.arange(docs), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    chars = np.maximum(np.bincount(doc, lengths, docs), 1)
    hashed = _mixed(np.fromiter(map(hash, words), dtype=np.int64, count=total).view(np.uint64))
    salt = _mixed(doc.astype(np.uint64) + np.uint64(1))
    before = np.r_[0, np.cumsum(lengths)]
    out = {"n_repeat_words": np.zeros(docs, dtype=np.int64)}
    rolling, at = hashed.copy(), np.arange(total)
    for n in range(2, max(max(REPEATED_NGRAM), BASE_WINDOW) + 1):
        whole = max(total - n + 1, 0)
        rolling[:whole] = rolling[:whole] * np.uint64(0x9E3779B97F4A7C15) + hashed[n - 1:]
        at = at[at + n <= ends[at]]
        at, first, count = _repeats(_mixed(rolling[at] ^ salt[at]), at)
        if n in TOP_NGRAM:
            share = np.zeros(docs)
            np.maximum.at(share, doc[at], (count - 1) * (before[at + n] - before[at]) / chars[doc[at]])
            out[f"top_{n}"] = share
        if n in REPEATED_NGRAM:
            out[f"repeated_{n}"] = np.bincount(doc, lengths * _covered(at[~first], n, total), docs) / chars
        if n == BASE_WINDOW:
            out["n_repeat_words"] = np.bincount(doc, _covered(at, n, total), docs).astype(np.int64)
    return out


def measure(texts: list[str | None]) -> pd.DataFrame:
    """One row of MEASURES per text; NULL counts as empty."""
    rows = {c: np.zeros(len(texts), dtype=np.int64) for c in COUNTS} | {c: np.zeros(len(texts)) for c in SHARES}
    words: list[bytes] = []
    lengths: list[np.ndarray] = []
    counts: list[int] = []
    begin = 0

    def flush(end: int) -> None:
        nonlocal begin
        if words:
            for name, values in _portion(words, np.concatenate(lengths), np.array(counts)).items():
                rows[name][begin:end] = values
        words.clear(), lengths.clear(), counts.clear()
        begin = end

    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        own = raw.split()
        bare = raw.translate(None, SPACE_BYTES)
        ascii_only = len(raw) == len(text or "")
        size = np.fromiter(map(len, own if ascii_only else b" ".join(own).decode("utf-8", "surrogatepass").split(" ")),
                           dtype=np.int64, count=len(own)) if own else np.zeros(0, dtype=np.int64)
        seen, again, again_chars, lines = set(), 0, 0, 0
        for line in raw.split(b"\n"):
            lines += 1
            if line in seen:
                again += 1
                again_chars += len(line.translate(None, SPACE_BYTES))
            elif line and not line.isspace():
                seen.add(line)
        rows["n_words"][i], rows["n_lines"][i], rows["n_dup_lines"][i] = len(own), lines, again
        rows["word_chars"][i], rows["n_symbols"][i] = size.sum(), len(raw) - len(raw.translate(None, SYMBOLS))
        rows["repeated_line_chars"][i] = again_chars / max(len(bare), 1)
        words += own
        lengths.append(size)
        counts.append(len(own))
        if len(words) >= PORTION:
            flush(i + 1)
    flush(len(texts))
    return pd.DataFrame(rows)


@F.pandas_udf(MEASURES)
def _measures(texts: pd.Series) -> pd.DataFrame:
    return measure([t if isinstance(t, str) else None for t in texts])


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def passes(m: Column) -> Column:
    """The repetition rules."""
    rules = [m[f"top_{n}"] <= share for n, share in TOP_NGRAM.items()]
    rules += [m[f"repeated_{n}"] <= share for n, share in REPEATED_NGRAM.items()]
    rules += [(m["n_dup_lines"] < 2) | (m["n_dup_lines"] <= REPEATED_LINES * m["n_lines"]), m["repeated_line_chars"] <= REPEATED_LINE_CHARS]
    out = rules[0]
    for rule in rules[1:]:
        out = out & rule
    return out


def judge_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Input rows plus the struct ``measures`` and the booleans ``base_failed`` and ``kept``.

    A document is kept unless the base rules fail (fewer than MIN_WORDS words, or over MAX_REPEAT_PERCENT
    per cent of them in windows of BASE_WINDOW words found twice or more) or a repetition rule does. NULL
    text counts as empty: no words, base rules fail. Whole texts are measured, of any length; rows are
    judged one by one, so order, ties and repeated rows don't matter. Columns of the three names are replaced.
    """
    arrow_rows(docs.sparkSession, 500)
    rows = docs.drop("measures", "base_failed", "kept").withColumn("measures", _measures(F.col(text_col)))
    m = F.col("measures")
    return rows.withColumn("base_failed", base_failed(m)).withColumn("kept", ~F.col("base_failed") & passes(m))
