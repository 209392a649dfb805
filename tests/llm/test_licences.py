"""Licence scans: the query against SQL, cosine and inheritance on small trees."""

import textwrap

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare
from marginloom.llm import licences

SF = "/root/testdata/sf0.001"
MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def test_query_equals_sql(spark, duck):
    name = "op2_scan_licences"
    status, rows, _, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert status == "ok" and rows, note


def scan(spark, rows):
    files = spark.createDataFrame(rows, "path string, text string")
    files = files.withColumn("unit", F.lit("u")).withColumn("licence", F.lit("clash")).withColumn("dir", F.lit(1)).withColumn("row", F.lit("r"))
    return licences.scan_licences(files).collect()


def test_inheritance(spark):
    rows = [("LICENSE", f"{MIT}\n"), ("a/b/COPYING", GPL), ("a/b/LICENCE.md", "nothing here"), ("a/b/c/d.py", "x = 1"), ("a/e.py", None),
            ("a/b/own.py", f"# code\n# {MIT}\ny = 2"), ("abc/f.py", ""), ("a/b/licensed.txt", "All are licensed to speak under the law of the land, the king said"),
            ("top.py", "z"), (None, MIT), ("a/b/c/d.py", "x = 1"), ("x/licenses/y.txt", "word " * 200_000)]
    got = scan(spark, rows)
    assert len(got) == len(rows)
    by = {r.path: (r.licence, r.how, r.from_dir) for r in got}
    assert by["LICENSE"] == ("MIT", "own", None) and by["a/b/COPYING"] == ("GPL-3.0", "own", None)
    assert by["a/b/c/d.py"] == ("GPL-3.0", "inherited", "a/b") and by["a/b/LICENCE.md"] == ("GPL-3.0", "inherited", "a/b")
    assert by["a/e.py"] == ("MIT", "inherited", "") and by["abc/f.py"] == ("MIT", "inherited", "") and by["top.py"] == ("MIT", "inherited", "")
    assert by["a/b/own.py"][:2] == ("MIT", "own") and by["a/b/licensed.txt"][:2] == ("GPL-3.0", "inherited")
    assert by[None] == (None, "none", None) and by["x/licenses/y.txt"][1] == "inherited"
    assert "unit" in got[0].asDict() and got[0]["dir"] == 1


def test_ties_empty_and_no_licence(spark):
    assert scan(spark, []) == []
    both = {r.path: r.licence for r in scan(spark, [("d/LICENSE", GPL), ("d/LICENSE.b", MIT), ("d/f", "")])}
    assert both["d/f"] == "GPL-3.0"  # equal scores: the first name
    assert {r.how for r in scan(spark, [("d/f", "plain"), ("g", None)])} == {"none"}
    long_form = licences.LICENCES["Apache-2.0"].texts[1].replace(". You", ".\n# You")
    assert scan(spark, [("f.py", f"# {long_form}\n")])[0].licence == "Apache-2.0"


def wrapped(text, mark="", width=70):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_named_licences(spark):
    """A wrong name is worse than none: versions, clauses and restrictions decide."""
    said = {"GNU General Public License, version 2": "GPL-2.0", "Licensed under the GNU Affero General Public License v3": "AGPL-3.0",
            "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "BSD 2-Clause License": "BSD-2-Clause", "Licensed under CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
            "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY 3.0": "CC-BY-3.0", "ISC License": "ISC", "CC0 1.0 Universal": "CC0-1.0",
            "SPDX-License-Identifier: LGPL-2.1": "LGPL-2.1", "SPDX-License-Identifier: MIT": "MIT", "SPDX-License-Identifier: GPL-2.0": "GPL-2.0",
            "Released under the MIT License.": "MIT", "Licensed under the BSD 3-Clause License.": "BSD-3-Clause", "Released under GPLv3": "GPL-3.0",
            "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
            "This is free and unencumbered software released into the public domain.": "Unlicense", "Mozilla Public License 1.1": "MPL-1.1",
            "Eclipse Public License 2.0": "EPL-2.0", "MIT No Attribution License": "MIT-0", "GNU General Public License": None, "The licence is yours": None,
            "Licensed under the MIT License or the Apache License, Version 2.0": None, "GNU General Public License, version 2 or version 3": None}
    rows = [(f"{i}/x.txt", text) for i, text in enumerate(said)]
    got = {r.text: r.licence for r in scan(spark, rows)}
    assert got == said


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_whole_texts_and_notices_anywhere(spark, mark):
    known = licences.LICENCES
    whole = {"MIT": ["MIT License", "Copyright (c) 2021 Some Body", licences._MIT_GRANT, licences._MIT_REST],
             "ISC": ["Copyright (c) 2020, Some Body", licences._ISC_GRANT + licences._ISC_NOTICE, licences._ISC_REST],
             "BSD-2-Clause": ["Copyright 2019 The Writers", licences._BSD_USE, licences._BSD_DISCLAIMER],
             "BSD-3-Clause": ["Copyright 2019 The Writers. All rights reserved.", licences._BSD_USE, licences._BSD_NAME, licences._BSD_DISCLAIMER],
             "Zlib": ["Copyright (c) 2001 A. Writer", known["Zlib"].texts[0]]}
    rows = [(f"{name}/LICENSE", f"\n{mark.rstrip()}\n".join(wrapped(p, mark) for p in parts) + "\n") for name, parts in whole.items()]
    rows += [(f"{name}/deep/er.c", "int x;") for name in whole]
    notices = {"GPL-3.0": known["GPL-3.0"].texts[1], "GPL-2.0": known["GPL-2.0"].texts[1], "LGPL-2.1": known["LGPL-2.1"].texts[1], "Apache-2.0": known["Apache-2.0"].texts[2]}
    # on line 15, wrapped over comment lines
    rows += [(f"{name}/late.py", "x = 1\n" * 14 + wrapped(text, mark or "// ") + "\ny = 2\n") for name, text in notices.items()]
    got = {r.path: (r.licence, r.how) for r in scan(spark, rows)}
    assert got == {p: (p.split("/")[0], "inherited" if p.endswith("er.c") else "own") for p, _ in rows}
