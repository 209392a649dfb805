import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) tuples, with columns whose names clash with results."""
    def build(rows):
        full = [(i, t, "en", (s[0] if s else "src0"), len(t) if t is not None else None) for i, t, *s in rows]
        from pyspark.sql import functions as F
        return spark.createDataFrame(full, DOCS).withColumn("row", F.lit(1)).withColumn("key", F.lit("k")).withColumn("id", F.lit("x")) \
            .withColumn("kept", F.lit(True)).withColumn("score", F.lit(9)).withColumn("n_lines", F.lit(-1)).withColumn("s", F.lit("s"))
    return build
