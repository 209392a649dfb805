"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

Labels teach three things, all from a bounded sample of labelled rows: a lexicon (words and word
beginnings that toxic documents hold and others don't), the trees (from one part of the sample) and the
calibration (from the other part). The features are rates over the whole text, so no identifier, source or
language enters a score. Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from marginloom.llm.common import arrow_rows, cut

#: Labelled rows that a model is fitted on, at most, of either class.
SAMPLE_TOXIC, SAMPLE_OTHER = 6_000, 12_000
#: Entries of the lexicon, documents that an entry must occur in, and its least log odds.
LEXICON, SUPPORT, LOG_ODDS = 2_000, 6, 2.0
PREFIXES = (4, 5)
#: Words that address a reader, in the languages at hand; fixed values, ASCII letters lower-cased.
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer",
                 "tu", "toi", "te", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros")
NEAR = 3
_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_INNER = bytes(x for x in _PUNCTUATION if x not in b"@$!*")
_KEEP_INNER = bytes.maketrans(_INNER, b" " * len(_INNER))
#: Signs that stand in for letters; fixed values.
_LEET = bytes.maketrans(b"0134578@$!", b"oieastbasi")
FEATURES = ["hit_rate", "hit_weight_rate", "distinct_hits", "max_weight", "address_rate", "hits_near_address", "capital_rate",
            "capital_words", "punctuation_rate", "shout_rate", "obfuscated_rate", "obfuscated_hits", "log_words"]


def _words(text: str | None) -> tuple[bytes, list[bytes]]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw, raw.lower().translate(_TO_SPACE).split()


def _terms(word: bytes) -> list[bytes]:
    """The word and, for longer ones, its beginnings (marked, so that they don't meet words)."""
    return [word] + [word[:n] + b"*" for n in PREFIXES if len(word) > n]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[label].update({t for w in set(_words(text)[1]) if len(w) < 64 for t in _terms(w)})
        for label, terms in counts.items():
            if terms:
                yield pa.RecordBatch.from_arrays([pa.array([*terms], pa.binary()), pa.array([label] * len(terms), pa.int32()),
                                                  pa.array([*terms.values()], pa.int64())], names=["term", "label", "n"])


def learn_lexicon(sample: DataFrame) -> dict[bytes, float]:
    """Log odds of the terms that mark toxic documents, at most LEXICON of them, from (text, label)."""
    totals = dict(sample.groupBy("label").count().collect())
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        return {}
    counted = sample.select("text", "label").mapInArrow(_count_terms, "term binary, label int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("o"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("o") + 0.5) / (other + 1.0))
    best = (counted.where(F.col("t") >= SUPPORT).select("term", odds.alias("odds"), "t").where(F.col("odds") >= LOG_ODDS)
            .orderBy(F.desc(F.col("odds") * F.sqrt("t")), "term").limit(LEXICON))
    return {bytes(r["term"]): float(r["odds"]) for r in best.collect()}


def text_features(text: str | None, lexicon: dict[bytes, float], address: frozenset[bytes]) -> list[float]:
    raw, words = _words(text)
    n = max(len(words), 1)
    size = max(len(raw), 1)
    distinct = set(words)
    weights = {}
    for w in distinct:
        found = [lexicon[t] for t in _terms(w) if t in lexicon]
        if found:
            weights[w] = max(found)
    hits = [i for i, w in enumerate(words) if w in weights] if weights else []
    spoken = [i for i, w in enumerate(words) if w in address] if not distinct.isdisjoint(address) else []
    near = 0
    if hits and spoken:
        place = np.array(spoken)
        at = np.searchsorted(place, hits)
        left = np.abs(np.array(hits) - place[np.maximum(at - 1, 0)])
        right = np.abs(place[np.minimum(at, len(place) - 1)] - np.array(hits))
        near = int((np.minimum(left, right) <= NEAR).sum())
    # letters written as signs or digits inside a word
    odd = [w for w in raw.lower().translate(_KEEP_INNER).split() if not w.isalpha() and w[:1].isalpha() and w.isascii()
           and not w[1:].isdigit() and w.rstrip(b"!@$*")[1:].translate(None, b"abcdefghijklmnopqrstuvwxyz")]
    plain = [w.rstrip(b"!*").translate(_LEET) for w in odd]
    hidden = sum(any(t in lexicon for t in _terms(w)) for w in plain if w)
    capitals = size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    shouted = sum(len(w) > 2 and w.isupper() for w in raw.split())
    marks = size - len(raw.translate(None, _PUNCTUATION))
    return [len(hits) / n, sum(weights[words[i]] for i in hits) / n, float(len(weights)), max(weights.values(), default=0.0),
            len(spoken) / n, float(near), capitals / size, shouted / n, marks / size, raw.count(b"!") / size, len(odd) / n,
            float(hidden), float(np.log1p(len(words)))]


def _features(lexicon: dict[bytes, float]):
    address = frozenset(w.encode() for w in SECOND_PERSON)

    @F.pandas_udf(ArrayType(DoubleType()))
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t, lexicon, address) for t in texts])

    return features


def held_out(id_: Column, folds: int = 5) -> Column:
    """True for the rows whose labels are never learned from; a NULL id counts as an empty one."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, label, weight, part): the labelled rows to learn from, smallest hash first; part 0 fits, part 1 calibrates.

    An id gives one row, that of the smallest text hash, however often it is repeated, so the caps bound rows.
    A row's weight is the number of labelled ids that it stands for, so that the classes keep their shares at any size.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("labelled")).agg(F.max(label_col).cast("int").alias("label"))
             .withColumn("h", F.xxhash64("labelled")))
    totals = dict(known.groupBy("label").count().collect())
    picked = [known.where(F.col("label") == v).orderBy("h", "labelled").limit(n).withColumn("weight", F.lit(max(totals.get(v, 0) / n, 1.0)))
              for v, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_OTHER))]
    # at most SAMPLE_TOXIC + SAMPLE_OTHER rows of 32 bytes
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, F.col("id") == F.col("labelled"))
    rows = rows.groupBy("labelled", "label", "weight", "h").agg(
        F.min(F.struct(F.xxhash64("text").alias("of"), F.col("text").alias("text"))).alias("m")).select("m.text", "label", "weight", "h")
    return cut(rows.select("text", "label", "weight", F.pmod(F.col("h"), 4).eqNullSafe(0).cast("int").alias("part")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """(lexicon, trees, calibration), or None where the labels hold fewer than two classes."""
    arrow_rows(docs.sparkSession, 500)
    sample = _sample(docs, labels, id_col, text_col, label_col)
    parts = {(r["part"], r["label"]): r["count"] for r in sample.groupBy("part", "label").count().collect()}
    if not all(parts.get((0, v)) for v in (0, 1)):
        return None
    lexicon = learn_lexicon(sample.where("part = 0"))
    rows = cut(sample.select("part", "weight", F.col("label").cast("double").alias("label"),
                             array_to_vector(_features(lexicon)(F.col("text"))).alias("features")))
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=11, maxBins=64, minInstancesPerNode=5, weightCol="weight").fit(
        rows.where("part = 0").repartition(4))
    check = rows.where("part = 1") if all(parts.get((1, v)) for v in (0, 1)) else rows
    level = IsotonicRegression(featuresCol="raw", weightCol="weight").fit(
        trees.transform(check).select("label", "weight", vector_to_array("probability")[1].alias("raw")))
    return lexicon, trees, level


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """Input rows plus ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5, else 0).

    Labels of rows that ``held_out`` marks are never used. Where an id has several labels, toxic counts;
    NULL labels and labels other than 0 and 1 teach nothing; with fewer than two classes to learn from
    every score is 0. NULL and empty texts are scored like a text without words. Rows are scored one by one,
    so repeated rows get the same score. Columns of the three names are replaced.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    arrow_rows(docs.sparkSession, 500)
    rows = docs.drop("held_out", "score", "predicted")
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        lexicon, trees, level = model
        out = rows.select(F.struct("*").alias("row"), array_to_vector(_features(lexicon)(F.col(text_col))).alias("features"))
        out = trees.transform(out).withColumn("raw", vector_to_array("probability")[1])
        out = level.transform(out.select("row", "raw"))
        # the steps of the calibration keep the order of the trees' scores inside them
        score = F.col("prediction") * 0.98 + F.col("raw") * 0.02
        scored = out.select("row.*", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))
    return scored.withColumn("held_out", held_out(F.col(id_col))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
