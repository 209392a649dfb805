"""A corpus from documents to packed sequences: toxicity, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginloom.llm import linededup, mixing, packing, simhash, toxicity
from marginloom.llm.common import checkpoint_dir
from marginloom.llm.registered import TOKENS, table

#: Not expressible in SQL (learned scores, fingerprint components, tokens); tests compare each stage with its operator's brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from ``labels`` doesn't call toxic."""
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat across documents; ``n_chars`` follows the text."""
    kept = linededup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                           .otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: shingles of three words, fingerprints linked at three bits or fewer."""
    return simhash.keep_one_per_group(docs, bits=3).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack_documents(docs, **TOKENS)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_duplicates),
          ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written to the shared folder before the next one reads it."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}_{name}")
        docs = spark.read.parquet(f"{folder}/{i}_{name}")
    return docs
