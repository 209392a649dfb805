"""Helpers shared by the training-data operators.

Words are runs of characters outside ASCII white space, and case folding touches A-Z only, so a
key never depends on a locale or on a Unicode version.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginloom.session import shared_dir

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
#: Seed that ``xxhash64`` of Spark uses; the Python side hashes with the same one.
XX_SEED = 42


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; a fresh one only for a local session without any."""
    named = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder, so that a lost executor never replays what led to them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain ``lower`` does that wherever every character is one byte."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def strip_spaces(text: Column) -> Column:
    """Both ends without ASCII white space."""
    return F.btrim(text, F.lit(SPACES))


def arrow_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds the rows of an Arrow batch, so that a batch of very long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
