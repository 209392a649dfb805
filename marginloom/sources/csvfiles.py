"""CSV part files whose types aren't known: types found from all lines, bad lines kept with their reason."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marginloom.sources.tables import materialize

#: Types tried, narrowest first; what fits none is a string.
TYPES = ("bigint", "double", "date", "timestamp", "boolean")
#: Different headers that a folder may have; more of them are no table.
MAX_HEADERS = 64
_BAD = "_bad_line"


@dataclass(frozen=True)
class Scan:
    """``good``: typed rows. ``bad``: (file, line, reason), reason being "columns" or the first column that doesn't fit. ``types`` by column."""

    good: DataFrame
    bad: DataFrame
    types: dict[str, str]

    def quarantine(self, path: str) -> DataFrame:
        """The bad lines, written to ``path`` and read back."""
        return materialize(self.bad, path)


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """One text file per partition of ``lines`` (column ``value``), each with the header as its first line."""
    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema[0].type)], schema=batch.schema)
                first = False
            yield batch
    lines.select("value").mapInArrow(headed, "value string").write.mode("overwrite").text(path)


def _cast(value: Column, to: str) -> Column:
    """NULL where the text isn't of the type; numbers in the plain form only, days as yyyy-mm-dd."""
    text = F.trim(value)
    forms = {"bigint": r"^[+-]?[0-9]{1,19}$", "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
             "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}", "boolean": r"^(?i)(true|false)$"}
    return value if to == "string" else F.when(text.rlike(forms[to]), text.try_cast(to))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, line, header): the lines that aren't empty, each with the first line of its file."""
    raw = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    # the block at 0 is read by one task in the order of its lines
    first = raw.where("at = 0").select("file", "value", F.monotonically_increasing_id().alias("no")).groupBy("file").agg(F.min_by("value", "no").alias("header"))
    return raw.join(first, "file").where(F.length(F.trim("value")) > 0).select("file", F.col("value").alias("line"), "header")


def _columns(header: str, spark: SparkSession, options: dict) -> list[str]:
    one = spark.createDataFrame([(header,)], "value string")
    ddl = StructType([StructField(f"c{i}", StringType()) for i in range(header.count(options.get("sep", ",")) + 1)])
    row = one.select(F.from_csv("value", ddl.simpleString()[7:-1].replace(":", " "), options)).first()[0]
    names = [n.strip() for n in row if n is not None]
    if len(set(names)) != len(names) or not all(names):
        raise ValueError(f"header with empty or repeated names: {header}")
    return names


def scan_csv(spark: SparkSession, paths: Sequence[str], max_bad: float = 0.01, options: dict | None = None) -> Scan:
    """CSV files or folders with a header line per file.

    Columns are matched by name, so part files may order them differently or lack some, which are NULL then. A
    column's type is the narrowest that all its values have but for the share ``max_bad`` of those that aren't empty, counted over all
    lines of all files; empty values are NULL, and a column without any value is a string. A line goes to ``bad`` if its
    number of columns isn't that of its file's header, or for its first column (by name) whose value isn't of the type.
    Lines equal to their file's header are headers wherever they stand. Values may be quoted, but not hold a line
    break. Files without a line give nothing; no line at all, or over ``MAX_HEADERS`` headers, is an error.
    """
    given = options or {}
    lines = _lines(spark, paths)
    headers = [r[0] for r in lines.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if not headers or len(headers) > MAX_HEADERS:
        raise ValueError(f"{len(headers) or 'no'} headers in {list(paths)}")
    by_header = {h: _columns(h, spark, given) for h in sorted(headers)}
    names = sorted({c for cols in by_header.values() for c in cols})
    parsed = []
    for header, cols in by_header.items():
        wanted = ", ".join(f"`{c}` string" for c in [*cols, _BAD])
        got = lines.where((F.col("header") == header) & (F.col("line") != F.col("header"))).select(
            "file", "line", F.from_csv("line", wanted, {**given, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}).alias("v"))
        value = {c: F.when(F.length(F.trim(F.col("v")[c])) > 0, F.col("v")[c]) for c in cols}
        parsed.append(got.select("file", "line", F.col("v")[_BAD].isNotNull().alias(_BAD),
                                 F.struct(*[value.get(c, F.lit(None).cast("string")).alias(c) for c in names]).alias("v")))
    rows = reduce(DataFrame.unionByName, parsed)
    counts = rows.where(~F.col(_BAD)).agg(*[a for i, c in enumerate(names) for a in (
        F.count(F.col("v")[c]).alias(f"n{i}"), *[F.count(_cast(F.col("v")[c], t)).alias(f"n{i}_{t}") for t in TYPES])]).first()
    types = {c: next((t for t in TYPES if counts[f"n{i}"] and counts[f"n{i}_{t}"] >= (1 - max_bad) * counts[f"n{i}"]), "string") for i, c in enumerate(names)}
    misfit = F.coalesce(*[F.when(F.col("v")[c].isNotNull() & _cast(F.col("v")[c], types[c]).isNull(), F.lit(c)) for c in names])
    judged = rows.withColumn("reason", F.when(F.col(_BAD), "columns").otherwise(misfit))
    good = judged.where("reason IS NULL").select(*[_cast(F.col("v")[c], types[c]).alias(c) for c in names])
    return Scan(good, judged.where("reason IS NOT NULL").select("file", "line", "reason"), types)
