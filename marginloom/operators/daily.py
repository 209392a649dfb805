"""Trailing sales from daily state: a day is read once, and no run reads sales of another day.

Windows of all lengths end yesterday, so a code counts in the last n days if its latest sale does. The state is a
ledger that is only added to: per key and sale day how many codes had their latest sale then. Appending a day adds
its codes to that day and, for codes that were sold before, takes one from the day that was their latest; those days are found
by joining the day's codes to the narrow code rows of the days before. The last n days are then a sum over the
ledger, which holds a row per key and day, not per sale.

Both parts of the state live in one versioned table, a day's rows in folders of their own: a day is committed whole,
committing it again replaces it, and days beyond the longest window are dropped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from marginloom.sources.versions import Versions


@dataclass(frozen=True)
class TrailingState:
    """The state of ``aggregates.trailing_sales`` over sales with these columns, at a path of shared storage.

    ``longest`` is the longest window asked for, in days. Sales without a date never count; sales without a code count
    for the flags alone; a missing key is a key of its own.
    """

    spark: SparkSession
    path: str
    sales_schema: StructType
    keys: Sequence[str]
    code: str
    date: str
    longest: int = 30

    def _field(self, name: str) -> StructField:
        return StructField(name, self.sales_schema[name].dataType)

    @property
    def _codes(self) -> StructType:
        return StructType([*map(self._field, self.keys), self._field(self.code), StructField("day", DateType())])

    @property
    def _ledger(self) -> StructType:
        return StructType([*map(self._field, self.keys), StructField("day", DateType()), StructField("codes", LongType())])

    def _read(self, table: Versions, part: str, first: dt.date, last: dt.date) -> DataFrame:
        """The rows committed for the days from first to last."""
        schema = self._codes if part == "codes" else self._ledger
        return table.read(schema, lambda label: label["part"] == part and first.isoformat() <= label["day"] <= last.isoformat())

    def _latest(self, sold: DataFrame) -> DataFrame:
        """Per key and code, also a missing one, the latest day."""
        return sold.groupBy(*self.keys, self.code).agg(F.max("day").alias("day"))

    def _counted(self, latest: DataFrame) -> DataFrame:
        """Per key and day the codes whose latest day it is; a day with sales of no code is a row, too."""
        return latest.groupBy(*self.keys, "day").agg(F.count(self.code).alias("codes"))

    def _days(self, sales: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        d = F.col(self.date).cast("date")
        return sales.where(d.between(F.lit(first), F.lit(last))).select(*self.keys, self.code, d.alias("day"))

    def _commit(self, table: Versions, day: dt.date, latest: DataFrame, before: DataFrame | None) -> int:
        """Code rows first, then the ledger from the written rows, then both as one version."""
        codes = table.write(latest)
        written = self.spark.read.schema(self._codes).parquet(f"{table.path}/data/{codes}")
        counted = self._counted(written)
        if before is not None:  # only code rows that are sold again are shuffled by key and code
            prior = before.where(F.col(self.code).isNotNull())
            again = self._latest(prior.join(written.drop("day"), self._same(prior, written), "left_semi"))
            counted = counted.unionByName(self._counted(again).withColumn("codes", -F.col("codes")))
        ledger = table.write(counted)
        oldest, label = (day - dt.timedelta(days=self.longest - 1)).isoformat(), day.isoformat()
        how = "load" if before is None else "append"
        return table.publish([({"part": part, "day": label, "how": how}, f) for part, f in (("codes", codes), ("ledger", ledger))],
                             lambda x: how == "load" or x["day"] == label or x["day"] < oldest)

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in (*self.keys, self.code)])

    def load(self, sales: DataFrame, day: dt.date) -> int:
        """State from scratch: one pass over the sales of the longest window up to ``day``."""
        sold = self._days(sales, day - dt.timedelta(days=self.longest - 1), day)
        return self._commit(Versions(self.spark, self.path), day, self._latest(sold), None)

    def append(self, sales: DataFrame, day: dt.date) -> int:
        """Adds a day: reads that day's sales and the code rows of the days before in the longest window.

        Days come in order; the newest may come again with other sales, unless it was loaded with the days before it,
        and days between may be left out.
        """
        table = Versions(self.spark, self.path)
        newest = max(((e["label"]["day"], e["label"]["how"]) for e in table.entries()), default=("", ""))
        if newest[0] > day.isoformat() or newest == (day.isoformat(), "load"):
            raise ValueError(f"{day} isn't after {newest[0]}, up to which the state goes")
        before = self._read(table, "codes", day - dt.timedelta(days=self.longest), day - dt.timedelta(days=1))
        return self._commit(table, day, self._latest(self._days(sales, day, day)), before)

    def trailing(self, as_of: dt.date, windows: Sequence[int], prefix: str = "sold") -> DataFrame:
        """The rows of ``aggregates.trailing_sales`` for ``as_of``, from the ledger up to the day before."""
        if max(windows) > self.longest:
            raise ValueError(f"the state reaches back {self.longest} days")
        back = lambda n: as_of - dt.timedelta(days=n)
        table = Versions(self.spark, self.path)
        ledger = self._read(table, "ledger", back(self.longest), back(1)).where(F.col("day") >= F.lit(back(max(windows))))
        since = lambda n: F.col("day") >= F.lit(back(n))
        return ledger.groupBy(*self.keys).agg(
            *[F.coalesce(F.sum(F.when(since(n), F.col("codes"))), F.lit(0)).cast("bigint").alias(f"{prefix}_{n}") for n in windows],
            *[F.max(since(n).cast("int")).alias(f"{prefix}_{n}_flag") for n in windows])
