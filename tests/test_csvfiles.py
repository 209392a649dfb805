"""CSV part files: types found, bad lines kept."""

import datetime as dt

import pytest

from marginloom.sources import csvfiles as CS


def folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return [str(tmp_path)]


def test_types_columns_by_name_and_reasons(spark, tmp_path):
    good = "".join(f'{i},"x, {i}",{i}.5,2024-01-{i % 28 + 1:02d},2024-01-01 10:00:0{i % 10},true\n' for i in range(60))
    paths = folder(tmp_path, a="id,name,price,day,at,ok\n" + good + "7,short\nx7,n,1,2024-01-01,,\n9,n,1,2024-13-01,,false\n\n",
                   b="price,id\n3,100\n4,101\nid?,5\nprice,id\n1,2,3\n", c="")
    scan = CS.scan_csv(spark, paths, max_bad=0.05)
    assert scan.types == {"id": "bigint", "name": "string", "price": "double", "day": "date", "at": "timestamp", "ok": "boolean"}
    assert scan.good.columns == sorted(scan.types)
    rows = {r["id"]: r for r in scan.good.collect()}
    assert len(rows) == 62 and rows[3]["name"] == "x, 3" and rows[3]["day"] == dt.date(2024, 1, 4) and rows[3]["ok"] is True
    assert rows[101]["price"] == 4.0 and rows[101]["name"] is None
    bad = sorted((r["reason"], r["line"]) for r in scan.quarantine(str(tmp_path / "bad")).collect())
    assert bad == [("columns", "1,2,3"), ("columns", "7,short"), ("day", "9,n,1,2024-13-01,,false"), ("id", "x7,n,1,2024-01-01,,"), ("price", "id?,5")]


def test_a_mixed_column_is_a_string_and_a_wider_type_holds_both(spark, tmp_path):
    scan = CS.scan_csv(spark, folder(tmp_path, a="a,b,c,d\n1,1,,x\n2,2.5,,y\n", b="a,b,c,d\nz,3,,\n"))
    assert scan.types == {"a": "string", "b": "double", "c": "string", "d": "string"}
    assert scan.bad.count() == 0 and sorted(r["b"] for r in scan.good.collect()) == [1.0, 2.5, 3.0]


def test_long_lines_headers_only_and_errors(spark, tmp_path):
    scan = CS.scan_csv(spark, folder(tmp_path, a="a,b\n" + "v" * 2_000_000 + ",1\n"))
    assert scan.good.count() == 1 and scan.bad.count() == 0
    (tmp_path / "h").mkdir()
    assert CS.scan_csv(spark, folder(tmp_path / "h", a="a,b\n")).good.collect() == []
    (tmp_path / "e").mkdir()
    for text in ("", "a,a\n1,2\n"):
        with pytest.raises(ValueError):
            CS.scan_csv(spark, folder(tmp_path / "e", a=text))
