"""Fit / transform feature operators. Fitted state is a small DataFrame that can be written and read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.functions.scalars import as_category

#: Fitted rows that are sent to every executor at most; a larger dictionary is joined by its key.
LOOKUP_ROWS = 20_000


def lookup(df: DataFrame, fitted: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Left join of a fitted dictionary; rows of ``df`` don't move while the dictionary is small.

    The dictionary is fetched up to the limit, which also spares fitting it again. Beyond the limit its rows join
    by key and AQE splits a crowded one. The rows are the same either way.
    """
    limit = LOOKUP_ROWS if limit is None else limit
    rows = fitted.limit(limit + 1).collect()
    side = F.broadcast(df.sparkSession.createDataFrame(rows, fitted.schema)) if len(rows) <= limit else fitted
    return df.join(side, key, "left")


def fit_woe(df: DataFrame, category: str, target: str, signed: bool = True) -> DataFrame:
    """Per category: 100 * ln(((ne+.5)/NE) / ((e+.5)/E)) * (ne/NE - e/E).

    Totals E and NE include rows with a missing category, which itself gets no entry. With ``signed``
    the value is negated where the category's event rate is below the base rate.
    """
    grouped = df.groupBy(category).agg(F.sum(target).cast("double").alias("_e"), F.count(F.lit(1)).alias("_n"))
    totals = grouped.agg(F.struct(F.sum("_e").alias("e"), F.sum("_n").alias("n")).alias("t")).scalar()
    g = grouped.where(F.col(category).isNotNull()).withColumn("_t", totals)
    e, ne = F.col("_e"), F.col("_n") - F.col("_e")
    te, tne = F.col("_t.e"), F.col("_t.n") - F.col("_t.e")
    value = 100 * F.log(((ne + 0.5) / tne) / ((e + 0.5) / te)) * (ne / tne - e / te)
    if signed:
        value = F.when(e / F.col("_n") < te / F.col("_t.n"), -value).otherwise(value)
    return g.select(F.col(category).alias("category"), value.alias("woe"))


def apply_woe(df: DataFrame, dictionary: DataFrame, category: str, out: str | None = None,
              default: float | None = None) -> DataFrame:
    """Replace a category by its encoding; a category unseen in fitting becomes NULL or ``default``."""
    d = dictionary.select(F.col("category").alias(category), F.col("woe").alias("_w"))
    joined = lookup(df, d, category)
    value = F.col("_w") if default is None else F.coalesce(F.col("_w"), F.lit(default))
    return joined.withColumn(out or category, value).drop("_w")


#: Columns that a one-hot frame gets at most.
ONE_HOT_COLUMNS = 5_000
#: Entries of a dictionary that are packed into one value at most; more are joined.
PACKED_ENTRIES = 20_000
#: Stands between a variable and its category in a packed key.
_BETWEEN = "\x1f"


def count_many(df: DataFrame, categories: Sequence[str], target: str) -> DataFrame:
    """(variable, category, n, e): rows and events of every value of all columns, from one scan; missing is ``'nan'``.

    Each row becomes one cell per column, which are summed before they are shuffled, so a value that most rows have
    moves once per task. The row without a variable holds the totals. Counts of several days add up.
    """
    cell = lambda v, c: F.struct(v.cast("string").alias("variable"), c.alias("category"))
    cells = [cell(F.lit(c), as_category(c)) for c in categories] + [cell(F.lit(None), F.lit(None).cast("string"))]
    long = df.select(F.col(target).cast("double").alias("_t"), F.explode(F.array(*cells)).alias("cell"))
    return long.groupBy("cell.variable", "cell.category").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("_t").alias("e"))


def weigh_many(counts: DataFrame, min_count: int = 1, other: str = "other", signed: bool = True) -> DataFrame:
    """(variable, category, woe) from ``count_many``: values rarer than ``min_count`` are one category, ``other``.

    The weight is that of ``fit_woe`` after ``fit_vocab`` and ``apply_vocab`` column by column. ``counts`` is read
    twice, once for its totals, so it should be a written table.
    """
    label = F.when(F.col("n") >= min_count, F.col("category")).otherwise(other)
    grouped = counts.where("variable is not null").groupBy("variable", label.alias("category")).agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    total = counts.where("variable is null").select(F.struct("n", "e").alias("t")).scalar()
    g = grouped.withColumn("_t", total)
    e, ne, te = F.col("e"), F.col("n") - F.col("e"), F.col("_t.e")
    tne = F.col("_t.n") - te
    value = 100 * F.log(((ne + 0.5) / tne) / ((e + 0.5) / te)) * (ne / tne - e / te)
    if signed:
        value = F.when(e / F.col("n") < te / F.col("_t.n"), -value).otherwise(value)
    return g.select("variable", "category", value.alias("woe"))


def _packed(dictionary: DataFrame, buckets: int) -> DataFrame:
    """One row: the dictionary as an array of small maps, the map of a key at the place its hash names."""
    key = F.concat("variable", F.lit(_BETWEEN), "category")
    maps = (dictionary.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("id"))
            .agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), F.col("woe").alias("w")))).alias("m")))
    every = dictionary.sparkSession.range(buckets).join(maps, "id", "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.map_keys("m").alias("k"), F.map_values("m").alias("w")))),
                                 lambda x: F.map_from_arrays(x["k"], x["w"])).alias("maps"))


def apply_many(df: DataFrame, dictionary: DataFrame, categories: Sequence[str], other: str = "other",
               default: float | None = None, limit: int | None = None) -> DataFrame:
    """Every column replaced by its weight: that of its value, else of ``other``, else NULL or ``default``.

    A dictionary of up to ``limit`` entries becomes one value that every task holds, an array of small maps, so a
    look-up is an expression: no join, and the rows don't move. A larger one is joined, column by column. The rows are
    the same either way. ``dictionary`` is read more than once, so it should be a written table.
    """
    limit = PACKED_ENTRIES if limit is None else limit
    entries = dictionary.count()
    if entries > limit:
        for c in categories:
            own = dictionary.where(F.col("variable") == c).select(F.col("category").alias("_c"), F.col("woe").alias("_w"))
            rest = own.where(F.col("_c") == other).select("_w").scalar()
            df = df.withColumn("_v", as_category(c)).join(own, F.col("_v") == F.col("_c"), "left")
            value = F.coalesce("_w", rest) if default is None else F.coalesce("_w", rest, F.lit(default))
            df = df.withColumn(c, value).drop("_v", "_c", "_w")
        return df
    buckets = max(1, entries // 2)
    held = df.withColumn("_maps", _packed(dictionary, buckets).scalar())

    def weight(c: str, v: Column) -> Column:
        key = F.concat(F.lit(c + _BETWEEN), v)
        return F.try_element_at(F.get("_maps", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), key)

    found = {c: F.coalesce(weight(c, as_category(c)), weight(c, F.lit(other)), *([F.lit(default)] if default is not None else [])) for c in categories}
    return held.withColumns(found).drop("_maps")


def fit_vocab(df: DataFrame, category: str, min_count: int, strict: bool = False) -> DataFrame:
    """Categories with a count of at least ``min_count`` (more than, if ``strict``)."""
    n = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") > min_count if strict else F.col("n") >= min_count)


def apply_vocab(df: DataFrame, vocab: DataFrame, category: str, other: str = "other") -> DataFrame:
    """Values outside the vocabulary become ``other``."""
    known = vocab.select(category).withColumn("_known", F.lit(1))
    return (lookup(df, known, category)
            .withColumn(category, F.when(F.col("_known").isNotNull(), F.col(category)).otherwise(other))
            .drop("_known"))


def one_hot(df: DataFrame, category: str, vocab: DataFrame, prefix: str = "") -> DataFrame:
    """One 0/1 column per vocabulary entry; unseen and missing values give all zeros.

    The columns of a frame are known to the driver, so the vocabulary is too. One of more than ``ONE_HOT_COLUMNS``
    entries is refused: ``one_hot_vector`` gives one sparse column.
    """
    rows = vocab.select(category).orderBy(category).limit(ONE_HOT_COLUMNS + 1).collect()
    if len(rows) > ONE_HOT_COLUMNS:
        raise ValueError(f"more than {ONE_HOT_COLUMNS} categories; use one_hot_vector")
    hit = {f"{prefix}{r[0]}": F.coalesce((F.col(category) == r[0]).cast("int"), F.lit(0)) for r in rows}
    return df.withColumns(hit)


def one_hot_vector(df: DataFrame, category: str, out: str):
    """Sparse one-hot vector for wide vocabularies; returns the fitted model."""
    index = StringIndexer(inputCol=category, outputCol=f"{out}_ix", handleInvalid="keep")
    encode = OneHotEncoder(inputCols=[f"{out}_ix"], outputCols=[out], handleInvalid="keep", dropLast=False)
    return Pipeline(stages=[index, encode]).fit(df)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column, as one row."""
    return df.agg(*[F.avg(c).alias(f"{c}__mean") for c in columns],
                  *[F.stddev_pop(c).alias(f"{c}__std") for c in columns])


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x - mean) / std``; a constant column is only centred."""
    s = scaler.select(F.struct("*").alias("s")).scalar()
    out = df.withColumn("_s", s)

    def scaled(c: str) -> Column:
        std = F.col(f"_s.{c}__std")
        return (F.col(c) - F.col(f"_s.{c}__mean")) / F.when(std == 0, F.lit(1.0)).otherwise(std)

    return out.withColumns({c: scaled(c) for c in columns}).drop("_s")


def fit_global_norm(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One mean and one variance over all present values of all columns; parts are pooled, so large values keep their variance."""
    s = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))])
    part = lambda n: [F.coalesce(F.col(f"{n}{i}"), F.lit(0.0)) for i in range(len(columns))]
    total = sum(part("n")[1:], part("n")[0])
    mean = F.try_divide(sum((n * m for n, m in zip(part("n"), part("m"))), F.lit(0.0)), total)
    s = s.withColumn("mean", mean)
    # the columns' own variances, and how far their means lie from the common one
    spread = sum((n * (v + F.pow(m - F.col("mean"), F.lit(2.0))) for n, m, v in zip(part("n"), part("m"), part("v"))), F.lit(0.0))
    return s.select("mean", F.try_divide(spread, total).alias("variance"))


def apply_global_norm(df: DataFrame, norm: DataFrame, columns: Sequence[str], eps: float = 1e-7) -> DataFrame:
    s = norm.select(F.struct("*").alias("s")).scalar()
    out = df.withColumn("_s", s)
    std = F.greatest(F.sqrt(F.col("_s.variance")), F.lit(eps))
    return out.withColumns({c: (F.col(c) - F.col("_s.mean")) / std for c in columns}).drop("_s")


def hash_split(df: DataFrame, key: str, shares: Mapping[str, int], seed: int = 42, out: str = "split") -> DataFrame:
    """Reproducible random split on a key; ``shares`` are percentages in order, summing to 100.

    The first 32 bits of an MD5 of (key, seed) pick the percentile, so a key always lands in the same part
    however the rows are partitioned.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    pct = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    upper, ladder = 0, None
    for name, share in shares.items():
        upper += share
        ladder = F.when(pct < upper, name) if ladder is None else ladder.when(pct < upper, name)
    return df.withColumn(out, ladder)


def time_split(df: DataFrame, date: str, train: tuple, valid: tuple, out: str = "split") -> DataFrame:
    """Label rows by date range: train and valid closed ranges, later rows are the test part."""
    d = F.col(date)
    return df.withColumn(out, F.when(d.between(F.lit(train[0]), F.lit(train[1])), "train")
                         .when(d.between(F.lit(valid[0]), F.lit(valid[1])), "valid")
                         .when(d > F.lit(valid[1]), "test"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights: n / (classes * n_class), with two classes."""
    n = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n")).scalar()
    return n.withColumn("weight", total / (2.0 * F.col("n")))


def undersample(df: DataFrame, target: str, percent: Mapping[int, int], key: str, seed: int = 42) -> DataFrame:
    """Keeps the given percentage of each listed class, all rows of the others; a key always falls the same way."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    pct = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    share = F.lit(100)
    for value, p in percent.items():
        share = F.when(F.col(target) == value, p).otherwise(share)
    return df.where(pct < share)
