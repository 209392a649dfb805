"""Join operators.

No side is broadcast by hint: Catalyst broadcasts below its size threshold and AQE revises
the choice from measured sizes, with sort-merge and skew splitting beyond it. The only inlined
data are lookup grids whose row count is checked first (see ``range_lookup``).
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def left_default(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join, with a default for unmatched or NULL right columns."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def kv_left_join(left: DataFrame, kv: DataFrame, on: str, names: Mapping[str, str],
                 key: str = "key", value: str = "value") -> DataFrame:
    """Row-store parameters as columns: ``names`` maps parameter key to output column.

    One filtered aggregation and one join serve all parameters; (``on``, key) is unique in ``kv``.
    """
    wide = (kv.where(F.col(key).isin(list(names))).groupBy(on)
            .agg(*[F.max(F.when(F.col(key) == k, F.col(value))).alias(out) for k, out in names.items()]))
    return left.join(wide, on, "left")


def casefold_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Equi-join on lower-cased keys; right key columns are dropped."""
    folded = right.select(*[F.lower(r).alias(f"_f{i}") for i, (_, r) in enumerate(pairs)],
                          *[c for c in right.columns if c not in {r for _, r in pairs}])
    cond = reduce(lambda a, b: a & b, [F.lower(left[lc]) == F.col(f"_f{i}") for i, (lc, _) in enumerate(pairs)])
    return left.join(folded, cond, how).drop(*[f"_f{i}" for i in range(len(pairs))])


def band_join(left: DataFrame, bands: DataFrame, keys: Sequence[str], value: str, low: str, high: str,
              how: str = "left") -> DataFrame:
    """Equi-join plus closed range. A value on a shared endpoint matches both bands."""
    renamed = bands.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[c for c in bands.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_b_{k}") for k in keys])
    cond = cond & F.col(value).between(F.col(low), F.col(high))
    return left.join(renamed, cond, how).drop(*[f"_b_{k}" for k in keys])


GRID_ROWS = 4096
GRID_UNITS = 65536


def _bounded(grid: DataFrame, low: str, high: str) -> DataFrame:
    """Segments that hold any value at all; a NULL or NaN bound holds none."""
    return grid.where((F.col(low) < F.col(high)) & ~F.isnan(F.col(low).cast("double")) & ~F.isnan(F.col(high).cast("double")))


def _indexed(df: DataFrame, grid: DataFrame, rows: list[dict], targets: Mapping[str, str], low: str, high: str, unit: float) -> DataFrame:
    """Lookups in a constant array: cell ``u`` holds the segments that touch ``[u, u + 1)`` units; open ends get cells of their own."""
    ends = [(float(r[low]), float(r[high])) for r in rows]
    finite = [x for pair in ends for x in pair if math.isfinite(x)]
    first, last = math.floor(min(finite, default=0) / unit), math.floor(max(finite, default=0) / unit)
    cells: list[list] = [[] for _ in range(last - first + 3)]  # below the first bound, one per unit, above the last bound
    for r, (lo, hi) in zip(rows, ends):
        begin = 0 if lo == -math.inf else math.floor(lo / unit) - first + 1
        end = last - first + 2 if hi == math.inf else math.floor(hi / unit) - first + 1
        for u in range(begin, end + 1):
            cells[u].append(r)
    overlap = any(a[1] > b[0] for a, b in zip(ends, ends[1:]))
    # A constant expression: folded into one literal, so rows do not carry the grid along.
    index = F.from_json(F.lit(json.dumps(cells, default=str)), T.ArrayType(T.ArrayType(grid.schema)))
    for value, out in targets.items():
        x = F.col(value).cast("double")
        unit_no = x / F.lit(float(unit))
        at = (F.when(unit_no < first, 0).when(unit_no >= last + 1, last - first + 2)
              .when(unit_no >= first, F.floor(unit_no) - (first - 1))).cast("int")
        held = F.get(index, at)
        if overlap:  # one row per match, as a join gives
            inside = F.filter(held, lambda s: (x >= s[low]) & (x < s[high]))
            df = df.select("*", F.explode_outer(inside).alias(out))
        else:
            most = max(map(len, cells))
            tried = [F.get(held, F.lit(i)) for i in range(most)]
            df = df.withColumn(out, F.coalesce(*[F.when((x >= s[low]) & (x < s[high]), s) for s in tried]))
    return df


def _joined(df: DataFrame, grid: DataFrame, targets: Mapping[str, str], low: str, high: str) -> DataFrame:
    """Lookups by equi-joins. A segment lies in at most two cells of the power of two above its width, so neither a
    narrow nor an open one multiplies; each distinct value looks at the widths that the grid has."""
    lo, hi = F.col(low).cast("double"), F.col(high).cast("double")
    width = hi - lo
    level = F.when(width < F.lit(float("inf")), F.ceil(F.log2(width)).cast("int")).otherwise(F.lit(10_000))
    cell = lambda v, lv: F.when(lv == 10_000, F.lit(0.0)).otherwise(F.floor(v / F.pow(F.lit(2.0), lv.cast("double"))).cast("double"))
    leveled = _bounded(grid, low, high).select(F.struct(*grid.columns).alias("seg"), lo.alias("lo"), hi.alias("hi"), level.alias("level"))
    cells = leveled.select("seg", "lo", "hi", "level", F.explode(F.array_distinct(F.array(
        cell(F.col("lo"), F.col("level")), cell(F.col("hi"), F.col("level"))))).alias("cell"))
    widths = [r[0] for r in leveled.select("level").distinct().collect()]  # one number per power of two
    for value, out in targets.items():
        values = df.select(F.col(value).cast("double").alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)").distinct()
        looks = values.select("_x", F.explode(F.array(*[F.lit(w).cast("int") for w in widths])).alias("level")) if widths else values.withColumn("level", F.lit(0))
        looks = looks.withColumn("cell", cell(F.col("_x"), F.col("level")))
        found = (looks.join(cells, ["level", "cell"]).where((F.col("_x") >= F.col("lo")) & (F.col("_x") < F.col("hi")))
                 .select("_x", F.col("seg").alias(out)))
        df = df.join(found, F.col(value).cast("double") == F.col("_x"), "left").drop("_x")
    return df


def range_lookup(df: DataFrame, grid: DataFrame, targets: Mapping[str, str], low: str, high: str,
                 max_rows: int = GRID_ROWS, max_units: int = GRID_UNITS) -> DataFrame:
    """Half-open range lookup ``low <= x < high``.

    ``targets`` maps value columns to the name of the struct column holding the matched segment. As in a left
    join a row comes once per matching segment, and once with NULL where there is none; NULL, NaN and positive
    infinity match nothing. Bounds may be infinite; a segment with a NULL or NaN bound, or an empty one, is
    left out. A grid within the limits becomes a constant array, so that all values share one scan; a
    larger one is joined. The rows are the same either way.
    """
    rows = [r.asDict() for r in _bounded(grid, low, high).orderBy(low).limit(max_rows + 1).collect()]
    if not rows:
        return df.withColumns({out: F.lit(None).cast(grid.schema) for out in targets.values()})
    if len(rows) <= max_rows:
        ends = [(float(r[low]), float(r[high])) for r in rows]
        unit = min((hi - lo for lo, hi in ends if math.isfinite(hi - lo)), default=1.0)
        finite = [x for pair in ends for x in pair if math.isfinite(x)]
        span = (max(finite, default=0.0) - min(finite, default=0.0)) / unit
        # the array's entries: a segment counts once per cell that it touches
        if span <= max_units and sum(min((hi - lo) / unit, span) + 2 for lo, hi in ends) <= 2 * max_units:
            return _indexed(df, grid, rows, targets, low, high, unit)
    return _joined(df, grid, targets, low, high)


def valid_on(df: DataFrame, as_of: dt.date, start: str, end: str) -> DataFrame:
    """Rows valid on a day, both ends included."""
    return df.where((F.to_date(start) <= F.lit(as_of)) & (F.to_date(end) >= F.lit(as_of)))


def decision_table(left: DataFrame, rules: DataFrame, keys: Mapping[str, str], outputs: Sequence[str]) -> DataFrame:
    """Policy columns by a combination of left columns; ``keys`` maps left to rule columns."""
    slim = rules.select(*[F.col(r).alias(f"_r_{r}") for r in keys.values()], *outputs)
    cond = reduce(lambda a, b: a & b, [F.col(lc) == F.col(f"_r_{rc}") for lc, rc in keys.items()])
    return left.join(slim, cond, "left").drop(*[f"_r_{r}" for r in keys.values()])


def latest_batch(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest batch: ``column`` equals its overall maximum."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def membership_flag(left: DataFrame, members: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """1 where the key occurs in ``members``, else 0. Members are reduced to distinct keys first."""
    known = members.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return left.join(known, list(keys), "left").withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_hit")


def calendar_enrich(df: DataFrame, calendar: DataFrame, attribute: str,
                    columns: Mapping[str, tuple[str, int | None]], date: str = "date") -> DataFrame:
    """Calendar attribute looked up for several date columns.

    ``columns`` maps a date column to (output name, fill); a fill of None leaves unmatched dates NULL.
    """
    for date_col, (out, fill) in columns.items():
        side = calendar.select(F.col(date).alias(date_col), F.col(attribute).alias(out))
        df = df.join(side, date_col, "left")
        if fill is not None:
            df = df.withColumn(out, F.coalesce(F.col(out), F.lit(fill)))
    return df


def _first_per_key(source: DataFrame, keys: Sequence[Column], newest_first: Sequence[Column], names: Sequence[str],
                   deal: str | None = None) -> DataFrame:
    order = [*newest_first, *[F.desc_nulls_last(c) for c in source.columns]]
    named = source.withColumns(dict(zip(names, keys)))
    for n in names:
        named = named.where(F.col(n).isNotNull())
    if deal:
        named = named.repartition(deal)
    return named.withColumn("_rn", F.row_number().over(Window.partitionBy(*names).orderBy(*order))).where("_rn = 1").drop("_rn")


def one_per_key(source: DataFrame, keys: Sequence[Column], newest_first: Sequence[Column] = ()) -> DataFrame:
    """One row per key without NULLs: the first by ``newest_first``, ties by all columns, largest first."""
    names = [f"_k{i}" for i in range(len(keys))]
    return _first_per_key(source, keys, newest_first, names).drop(*names)


def update_from(target: DataFrame, source: DataFrame, keys: Mapping[str, str], assign: Mapping[str, Column],
                when: Column | None = None, casefold: bool = False, newest_first: Sequence[Column] = (), deal: str | None = None) -> DataFrame:
    """``UPDATE target SET … FROM source``: never more rows than before. Source columns are visible as ``src_<name>``.

    Of several source rows with one (folded) key the first by ``newest_first`` counts, ties by all columns,
    largest first. All assignments see the old row. The source's rows are chosen and joined in one partitioning: that of the keys, or
    with ``deal``, one of the target's keys, that of this (folded) key alone, which following joins by it find.
    """
    fold = F.lower if casefold else F.col
    names = [f"_j{i}" for i in range(len(keys))]
    by = names[list(keys).index(deal)] if deal else None
    source = _first_per_key(source, [fold(s) for s in keys.values()], newest_first, names, by)
    src = source.select(*names, *[F.col(c).alias(f"src_{c}") for c in source.columns if c not in names])
    cond = reduce(lambda a, b: a & b, [fold(t) == F.col(n) for t, n in zip(keys, names)])
    joined = (target.repartition(fold(deal)) if deal else target).join(src, cond, "left")
    hit = F.col("_j0").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    out = [F.when(hit, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in target.columns]
    return joined.select(*out)


def products(arrays: Sequence[Column], build: Callable[[list[Column]], Column]) -> Column:
    """``build`` of every choice of one element per array, as an array; an array that is empty or NULL gives a NULL element.

    Where no array holds more than one element, the one choice is built in compiled code; the nested lambdas aren't compiled.
    """
    def chosen(i: int, held: list[Column]) -> Column:
        rows = F.when(F.size(arrays[i]) > 0, arrays[i]).otherwise(F.array(F.lit(None)))
        if i == len(arrays) - 1:
            return F.transform(rows, lambda x: build([*held, x]))
        return F.flatten(F.transform(rows, lambda x: chosen(i + 1, [*held, x])))

    return F.when(at_most_one(arrays), F.array(build([F.get(a, F.lit(0)) for a in arrays]))).otherwise(chosen(0, []))


def at_most_one(arrays: Sequence[Column]) -> Column:
    """Whether none of the arrays holds two elements or more."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.size(a), F.lit(0)) <= 1 for a in arrays])


def choose_each(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """A row for every choice of one element per array column, the elements in place of the arrays; an array that is empty or NULL gives a NULL.

    The choices of a row are numbered and looked up by their number, so the rows multiply in one step of compiled code.
    """
    sizes = [f"cast(greatest(size(`{a}`), 1) as bigint)" for a in arrays]
    numbered = df.select("*", F.explode(F.expr(f"sequence(0L, {' * '.join(sizes)} - 1L)")).alias("_choice"))
    at = {a: F.expr(f"cast((_choice div ({' * '.join(['1L', *sizes[:i]])})) % {sizes[i]} as int)") for i, a in enumerate(arrays)}
    return numbered.select(*[F.get(F.col(c), at[c]).alias(c) if c in at else F.col(c) for c in df.columns])


def merged(columns: Sequence[Sequence[str]]) -> Callable[[list[Column]], Column]:
    """The fields of several structs as one struct, for ``products``."""
    return lambda held: F.struct(*[s[c].alias(c) for s, own in zip(held, columns) for c in own])


def fold_rules(frames: Sequence[DataFrame], keys: Sequence[str], deal: Sequence[str] = (), nested: str | None = None) -> DataFrame:
    """Rule tables of one key as one table: every key that occurs, with the product of its rows in the tables.

    The tables are stacked as rows with one filled struct each and aggregated once per key, so every table is read
    and moved once, and a large table then takes one join for all of them. A key holds few rules. Equal rows of
    a table count once, and rows with a NULL key, which match nothing, are left out. With ``deal``, some of the keys, the
    rows are dealt by these alone, so that they meet a table that lies by them without another move of either side.
    With ``nested`` a key comes once and its rows are an array of that name, so that the table they join doesn't multiply.
    """
    columns = [[c for c in f.columns if c not in keys] for f in frames]
    stacked = []
    for i, (f, own) in enumerate(zip(frames, columns)):
        for k in keys:
            f = f.where(F.col(k).isNotNull())
        stacked.append(f.select(*keys, F.struct(*own).alias(f"_s{i}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    if deal:
        rows = rows.repartition(*deal)
    if len(frames) == 1 and not nested:
        return rows.distinct().select(*keys, "_s0.*")
    out = rows.groupBy(*keys).agg(*[F.collect_set(f"_s{i}").alias(f"_s{i}") for i in range(len(frames))])
    if nested:
        sets = [F.col(f"_s{i}") for i in range(len(frames))]
        return out.select(*keys, (sets[0] if len(sets) == 1 else products(sets, merged(columns))).alias(nested))
    for i in range(len(frames)):
        out = out.withColumn(f"_s{i}", F.explode_outer(f"_s{i}"))
    return out.select(*keys, *[f"_s{i}.{c}" for i, own in enumerate(columns) for c in own])
