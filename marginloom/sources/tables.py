"""Scans and sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | None = None) -> DataFrame:
    """Parquet scan. The filter is applied before the projection so both reach the reader."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """CSV file or folder of part files with a header line and an explicit schema."""
    return spark.read.schema(schema).options(header=True, **options).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path`` by ``df``. ``df`` must not read from ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a stage to shared storage and read it back: cuts lineage and survives executor loss."""
    refresh(df, path)
    return df.sparkSession.read.parquet(path)


def completed(spark: SparkSession, path: str) -> bool:
    """Whether a stage was written to its end: the writer's marker is there."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(marker)


def staged(build, spark: SparkSession, path: str, log_path: str | None = None) -> DataFrame:
    """The stage at ``path``: read if a former run completed it, else built, written and logged.

    The log gets a row at the start (no end time) and one at the end of the step.
    """
    if not completed(spark, path):
        name, start = path.rstrip("/").rsplit("/", 1)[-1], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        if log_path:
            log_step(spark, log_path, name, start, None)
        refresh(build(), path)
        if log_path:
            log_step(spark, log_path, name, start, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return spark.read.parquet(path)


def log_step(spark: SparkSession, path: str, name: str, start: dt.datetime, end: dt.datetime | None) -> None:
    row = spark.createDataFrame([(name, start, end)], "stepname string, starttime timestamp_ntz, endtime timestamp_ntz")
    row.coalesce(1).write.mode("append").parquet(path)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left by a conditional delete: an unknown condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))
