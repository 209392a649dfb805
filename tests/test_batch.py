"""Versions, daily state, folded updates and stacked encoders."""

import datetime as dt
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marginloom.operators import encoders as EN
from marginloom.operators import joins as J
from marginloom.operators.aggregates import trailing_sales
from marginloom.operators.daily import TrailingState
from marginloom.operators.updates import Update, update_log, update_sequence
from marginloom.plans import return_risk as R
from marginloom.session import shared_dir
from marginloom.sources import snapshots as SN
from marginloom.sources.versions import Conflict, Versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- versions -----------------------------------------------------------------------------------


def test_a_writer_that_dies_leaves_the_old_version_whole(spark, tmp_path):
    path, schema = str(tmp_path / "v"), spark.range(1).schema
    table = Versions(spark, path)
    assert table.version() == 0 and table.read(schema).collect() == []
    assert table.commit([({"day": "1"}, spark.range(3)), ({"day": "2"}, spark.range(3, 5))]) == 1
    table.write(spark.range(100, 200))  # killed before the manifest: a folder no version names
    assert rows(table.read(schema)) == [(i,) for i in range(5)]
    draft, files = table._at("manifest/.half")  # killed before the rename: a draft no reader resolves
    files.create(draft).close()
    assert table.version() == 1 and table.read(schema).count() == 5

    class Killed(Exception):
        pass

    class Dying(Versions):
        def publish(self, *args, **more):
            raise Killed
    with pytest.raises(Killed):
        Dying(spark, path).commit([({"day": "2"}, spark.range(9, 10))], lambda label: True)
    assert rows(table.read(schema)) == [(i,) for i in range(5)]
    assert table.commit([({"day": "2"}, table.read(schema, lambda x: x["day"] == "2").selectExpr("id * 10 as id"))], lambda x: x["day"] == "2") == 2
    assert rows(table.read(schema)) == [(0,), (1,), (2,), (30,), (40,)]
    assert rows(table.read(schema, version=1)) == [(i,) for i in range(5)]
    assert table.vacuum(keep=1) == 3 and table.read(schema).count() == 5 and table.version() == 2


def test_the_second_of_two_writers_fails(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "v"))
    table.commit([({"day": "1"}, spark.range(1))])
    first, second = table.write(spark.range(2)), table.write(spark.range(3))
    assert table.publish([({"day": "2"}, first)], after=1) == 2
    with pytest.raises(Conflict):
        table.publish([({"day": "2"}, second)], after=1)
    assert table.read(spark.range(1).schema).count() == 3


def test_snapshots_are_replaced_and_expire_in_one_version(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "snapshot_date date, id long"
    day = lambda d: dt.date(2024, 1, d)
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(schema)
    for d in [*range(1, 10), 9]:
        SN.commit_snapshot(spark.range(d), path, day(d))
    got = SN.read_snapshots(spark, path, schema).groupBy("snapshot_date").count()
    assert rows(got) == [(day(d), d) for d in range(3, 10)]
    assert SN.read_snapshots(spark, path, schema, since=day(8)).count() == 17
    SN.commit_snapshot(spark.range(0), path, day(12))
    assert SN.read_snapshots(spark, path, schema).count() == sum(d for d in range(3, 10) if d != 5)
    SN.commit_snapshot(spark.range(1), path, day(13), exact_day=False)
    assert SN.read_snapshots(spark, path, schema).select("snapshot_date").distinct().count() == 4


# ---- daily state --------------------------------------------------------------------------------

SALES = "k string, code string, sold timestamp, other int"


def sale(k, code, day, n=0):
    return k, code, dt.datetime(2024, 1, 1, 13) + dt.timedelta(days=day) if day is not None else None, n


def states(spark, sales, path, longest=5):
    return TrailingState(spark, path, sales.schema, ["k"], "code", "sold", longest)


def test_every_day_equals_the_full_report(spark, tmp_path):
    data = [sale("a", f"c{(i * 7) % 5}", i % 14) for i in range(40)] + [sale("a", "c1", d) for d in (2, 2, 6, 9, 13)]
    data += [sale(None, "x", 3), sale(None, "x", 11), sale("b", None, 4), sale("b", None, 12), sale("b", "z", 4), sale("c", "q", 0), sale("c", "q", None)]
    sales = spark.createDataFrame(data, SALES)
    state = states(spark, sales, str(tmp_path / "t"))
    start = dt.date(2024, 1, 1)
    for d in range(4, 18):
        day = start + dt.timedelta(days=d)
        if d == 4:
            state.load(sales, day)
        elif d == 8:
            continue  # a day left out is a day without sales
        else:
            state.append(sales if d != 9 else sales.limit(0), day)
            if d == 9:
                state.append(sales, day)  # the newest day again, with other sales
        as_of = day + dt.timedelta(days=1)
        known = sales.where(F.to_date("sold") != F.lit(start + dt.timedelta(days=8))) if d > 8 else sales
        want = trailing_sales(known.withColumn("sold", F.to_date("sold")), ["k"], "code", "sold", as_of, [1, 3, 5])
        assert rows(state.trailing(as_of, [1, 3, 5])) == rows(want), d
    assert len(Versions(spark, state.path).entries()) <= 2 * 5
    with pytest.raises(ValueError):
        state.append(sales, start)
    with pytest.raises(ValueError):
        state.trailing(start, [6])


def test_a_day_is_added_from_its_own_sales(spark, tmp_path):
    data = [(f"k{i % 3}", f"c{i % 11}", dt.date(2024, 1, 1 + i % 10)) for i in range(200)]
    whole = spark.createDataFrame(data, "k string, code string, sold date")
    whole.write.partitionBy("sold").parquet(str(tmp_path / "sales"))
    read = lambda: spark.read.schema(whole.schema).parquet(str(tmp_path / "sales"))
    state = TrailingState(spark, str(tmp_path / "state"), whole.schema, ["k"], "code", "sold", 6)
    state.load(read(), dt.date(2024, 1, 9))
    want = rows(trailing_sales(read(), ["k"], "code", "sold", dt.date(2024, 1, 11), [2, 6]))
    for d in range(1, 10):  # the sales of all other days are gone
        shutil.rmtree(tmp_path / "sales" / f"sold=2024-01-{d:02}")
    state.append(read(), dt.date(2024, 1, 10))
    assert rows(state.trailing(dt.date(2024, 1, 11), [2, 6])) == want
    with pytest.raises(ValueError):
        states(spark, whole, str(tmp_path / "other")).load(read(), dt.date(2024, 1, 10))
        TrailingState(spark, str(tmp_path / "other"), whole.schema, ["k"], "code", "sold", 6).append(read(), dt.date(2024, 1, 10))


# ---- folded updates -----------------------------------------------------------------------------


def update_frames(spark):
    target = spark.createDataFrame([(i, f"S{i % 7}" if i % 2 else f"s{i % 7}", float(i), 0) for i in range(40)] + [(99, None, 1.0, 0), (98, "S1", None, 0)],
                                   "id int, code string, price double, seen int")
    a = spark.createDataFrame([("s1", 5.0, 1), ("S1", 7.0, 2), ("s1", 9.0, 2), ("s3", None, 1), (None, 3.0, 1), ("S5", 2.0, None)], "c string, p double, t int")
    b = spark.createDataFrame([("S1", 100.0), ("S1", 90.0), ("s2", 50.0), ("S9", 1.0)], "k string, price double")
    return target, a, b


def test_sequence_equals_updates_one_after_the_other(spark):
    target, a, b = update_frames(spark)
    steps = [Update({"price": F.col("src_p"), "seen": F.col("seen") + 1}, a, ["c"], when=F.coalesce("src_p", F.lit(4.0)) > 3, newest_first=["t"]),
             Update({"seen": F.col("seen") + 10}, when=F.col("price") > 8),
             Update({"price": F.col("price") + F.col("src_price"), "seen": F.col("seen") + 100}, b, ["k"], exact=True),
             Update({"price": -F.col("price"), "seen": F.col("seen") + 1000}, b, ["k"], when=F.col("price") >= 90)]
    one = J.update_from(target, a, {"code": "c"}, steps[0].assign, steps[0].when, casefold=True, newest_first=[F.desc_nulls_last("t")])
    two = one.withColumn("seen", F.when(F.col("price") > 8, F.col("seen") + 10).otherwise(F.col("seen")))
    three = J.update_from(two, b, {"code": "k"}, steps[2].assign)
    want = J.update_from(three, b, {"code": "k"}, steps[3].assign, steps[3].when, casefold=True)
    got = update_sequence(target, ["code"], steps, casefold=True)
    assert rows(got) == rows(want) and got.columns == target.columns
    assert rows(update_sequence(target, ["code"], [])) == rows(target)
    assert update_log(steps, 1, casefold=True).groupBy("_k0").count().where("count > 1").count() == 0


def test_the_wide_rows_move_once(spark):
    target, a, b = update_frames(spark)
    steps = [Update({"price": F.col("src_p")}, a, ["c"]), Update({"price": F.col("src_price")}, b, ["k"]), Update({"seen": F.lit(1)}, b, ["k"])]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = update_sequence(target, ["code"], steps)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join LeftOuter") == 1


def test_one_aggregate_makes_the_log(spark):
    """The sources' rows are stacked before they are reduced, not after; NULLs count less than any value."""
    _, a, b = update_frames(spark)
    steps = [Update({"price": F.col("src_p")}, a, ["c"], newest_first=["t"]), Update({"price": F.col("src_price")}, b, ["k"])]
    log = update_log(steps, 1, casefold=True)
    assert log._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    flat = lambda s: tuple(s) if s else None
    assert sorted((r["_k0"], flat(r["_s0"]), flat(r["_s1"])) for r in log.collect()) == [
        ("s1", (2, "s1", 9.0), ("S1", 100.0)), ("s2", None, ("s2", 50.0)), ("s3", (1, "s3", None), None), ("s5", (None, "S5", 2.0), None),
        ("s9", None, ("S9", 1.0))]


# ---- stacked encoders ---------------------------------------------------------------------------


def encoder_frames(spark):
    data = [(i, ["p", "q", None, "other", f"rare{i}"][i % 5], f"g{i * i % 13}" if i % 11 else None, int(i % 3 == 0 or i % 13 == 4)) for i in range(400)]
    train = spark.createDataFrame(data, "id int, a string, b string, y int")
    test = spark.createDataFrame([(1, "p", "g1", 0), (2, "new", "new", 1), (3, None, None, 0), (4, "other", "g4", 1)], train.schema)
    return train, test


@pytest.mark.parametrize("limit", [0, 20_000])
def test_stacked_encoders_equal_single_ones(spark, monkeypatch, limit):
    monkeypatch.setattr(EN, "PACKED_ENTRIES", limit)
    train, test = encoder_frames(spark)
    rounded = lambda d: rows(d.select("id", F.round("a", 9), F.round("b", 9)))
    for signed in (True, False):
        for got, want in zip(R.encode_many(train, [test], ["a", "b"], "y", 20, signed), R.encode(train, [test], ["a", "b"], "y", 20, signed)):
            assert rounded(got) == rounded(want) and got.columns == train.columns


def test_one_scan_and_no_join_of_the_rows(spark, tmp_path):
    train, test = encoder_frames(spark)
    train.write.parquet(str(tmp_path / "train"))
    counts = EN.count_many(spark.read.parquet(str(tmp_path / "train")), ["a", "b"], "y")
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    counts.write.parquet(str(tmp_path / "counts"))
    weights = EN.weigh_many(spark.read.parquet(str(tmp_path / "counts")), 20)
    plan = EN.apply_many(test, weights, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString().splitlines()
    outer = [x for x in plan if not x.lstrip().startswith(":")]  # the packed dictionary is a subquery
    assert len(outer) < len(plan) and not any("Join" in x or "Exchange" in x for x in outer)
    assert EN.count_many(train.limit(0), ["a"], "y").count() == 0
    assert [r.a for r in EN.apply_many(test, weights.limit(0), ["a"], default=-1.0).collect()] == [-1.0] * 4


def test_a_vocabulary_too_wide_for_columns_is_refused(spark, monkeypatch):
    monkeypatch.setattr(EN, "ONE_HOT_COLUMNS", 3)
    vocab = spark.createDataFrame([(c,) for c in "abcd"], "c string")
    assert len(EN.one_hot(vocab, "c", vocab.where("c < 'd'"), prefix="is_").columns) == 4
    with pytest.raises(ValueError):
        EN.one_hot(vocab, "c", vocab)


# ---- session and registry -----------------------------------------------------------------------


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": lambda self, key, default=None: default})()
    with pytest.raises(RuntimeError):
        shared_dir(Session())
    Context.master = "local[8]"
    assert shared_dir(Session())


def test_the_other_queries_register_where_a_library_is_missing():
    code = """
import sys
sys.modules['public_tokenizers'] = None
import __spark_entry__ as e
assert 'op1_mix_sources' not in e.queries() and len(e.queries()) > 130 and set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
