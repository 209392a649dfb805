"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory (native).

A file's units are its lines, its sentences and paragraphs over consecutive lines of one kind without their comment
marks, its runs of comment lines (wherever in the file they are) and, for a licence file, its whole text. A unit counts if its
deciding words (names, versions, clauses, restrictions) fit exactly one licence; equal units are scored once, against that
licence's templates: statements by rule, notices and whole texts. A unit is a sparse vector over the templates'
vocabulary, whose document frequencies are counted over all files; words outside it only lengthen the vector. A file takes
the licence of its best unit. Licence files speak for their directory, and a file without a licence of its own takes that
of its nearest ancestor: directories, not files, are joined with their ancestors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.llm.common import ascii_lower, cut, strip_spaces


@dataclass(frozen=True)
class Licence:
    """What names a licence: all of ``must`` and none of ``never`` (patterns over words with single blanks between and around them).

    ``names`` are put into STATEMENTS; ``texts`` are notices and whole texts.
    """

    must: Sequence[str]
    never: Sequence[str] = ()
    names: Sequence[str] = ()
    texts: Sequence[str] = ()


STATEMENTS = ("{}.", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.",
              "This file is distributed under the terms of the {}.")


def _version(n: str) -> str:
    """The version ``n`` (its parts with blanks between) after the name of a licence of the GNU kind."""
    return rf" (?:version|licen[sc]e|gpl|lgpl|agpl) v? ?{n} |gplv{n} | v{n} "


_LESSER, _AFFERO, _GENERAL = " lesser |lgpl| library general ", " affero |agpl", " l?gpl|general public licen[sc]e| gnu public "


def _gnu_notice(name: str, version: str, free: str = "software") -> str:
    """How such a licence says that it is to be applied; fixed values."""
    return (f"This {'library' if 'Lesser' in name else 'program'} is free {free}: you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


def _gnu(name: str, short: str, version: str, dated: str, must: Sequence[str], never: Sequence[str]) -> Licence:
    return Licence([*must, _version(version.replace(".", " "))], never,
                   [f"GNU {name}, version {version}", f"GNU {name} v{version}", f"{short}-{version}", f"{short}v{version}", f"{short} {version}", f"GNU {short} v{version}"],
                   [f"GNU {name} Version {version}, {dated}", _gnu_notice(name, version)])


def _creative_commons(version: str) -> dict[str, Licence]:
    """Attribution licences of a version with every set of restrictions, by name."""
    marks = {"NC": (" nc |noncommercial|non commercial", "NonCommercial"), "ND": (" nd |no ?deriv", "NoDerivatives"), "SA": (" sa |share ?alike", "ShareAlike")}
    out = {}
    for held in ((), ("SA",), ("ND",), ("NC",), ("NC", "SA"), ("NC", "ND")):
        code, long = "-".join(("BY", *held)), "-".join(("Attribution", *[marks[m][1] for m in held]))
        must = ["creative ?commons| cc by ", " attribution | by ", f" {version.replace('.', ' ')} ", *[marks[m][0] for m in held]]
        never = [*[p for m, (p, _) in marks.items() if m not in held], *[f" {v} " for v in ("1 0", "2 0", "2 5", "3 0", "4 0") if v != version.replace(".", " ")]]
        out[f"CC-{code}-{version}"] = Licence(must, never, [f"CC {code} {version}", f"CC-{code}-{version}", f"Creative Commons {long} {version} {'International' if version == '4.0' else 'Unported'} License",
                                                            f"Creative Commons {long} {version}"],
                                              [f"This work is licensed under a Creative Commons {long} {version} International License."])
    return out


_BSD_USE = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
            "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution. ")
_BSD_NAME = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
             "without specific prior written permission. ")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
                   "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
                   "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
                   "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
                   "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
              "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
              "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: ")
_MIT_REST = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
             "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
             "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
             "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies. "
_ISC_REST = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
             "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
             "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
             "PERFORMANCE OF THIS SOFTWARE.")
_BSD = " bsd |redistribution and use in source"
_TWO, _THREE, _FOUR = " (?:2|two) clause |simplified bsd", " (?:3|three) clause | (?:new|revised|modified) bsd |neither the name", " (?:4|four) clause |original bsd|all advertising materials"

#: Names, deciding words, notices and whole texts by SPDX name; fixed values.
LICENCES: Mapping[str, Licence] = {
    "0BSD": Licence([" 0bsd |zero clause|with or without fee is hereby granted "], ["provided that the above", " isc "],
                    ["0BSD", "Zero-Clause BSD License", "BSD Zero Clause License"], [f"{_ISC_GRANT}.", f"{_ISC_GRANT}. {_ISC_REST}"]),
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3", "19 November 2007", [_AFFERO], [_LESSER, _version("2")]),
    "Apache-1.1": Licence([" apache ", " 1 1 "], [" 2 0 ", " version 2 "], ["Apache License, Version 1.1", "Apache Software License 1.1"]),
    "Apache-2.0": Licence([" apache ", " 2 0 | version 2 | apache 2 |licen[sc]e 2 | v2 "], [" 1 1 "], ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
                          ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                           'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                           "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                           'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                           "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                           'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
                           "See the License for the specific language governing permissions and limitations under the License."]),
    "Artistic-2.0": Licence([" artistic licen[sc]e | artistic 2", " 2 0 "], [" 1 0 "], ["Artistic License 2.0", "Artistic-2.0"]),
    "BSD-2-Clause": Licence([_BSD, f"{_TWO}|redistributions in binary form"], [_THREE, _FOUR, "zero clause"], ["BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"], [_BSD_USE + _BSD_DISCLAIMER]),
    "BSD-3-Clause": Licence([_BSD + "| bsd style ", f"{_THREE}|bsd style licen[sc]e"], [_TWO, _FOUR, "zero clause"], ["BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "Modified BSD License"],
                            ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", _BSD_USE + _BSD_NAME + _BSD_DISCLAIMER]),
    "BSD-4-Clause": Licence([_BSD, _FOUR], [_TWO, " (?:3|three) clause "], ["BSD 4-Clause License", "BSD-4-Clause", "Original BSD License"]),
    "BSL-1.0": Licence([" boost software | boost 1 0 | bsl 1 0 |person or organization obtaining a copy"], (), ["Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"],
                       ["Boost Software License - Version 1.0 - August 17th, 2003", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)"]),
    **_creative_commons("3.0"),
    **_creative_commons("4.0"),
    "CC0-1.0": Licence([" cc0 |creative commons zero"], [" cc by "], ["CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero v1.0 Universal", "CC0 1.0 Universal Public Domain Dedication"],
                       ["Creative Commons Legal Code CC0 1.0 Universal"]),
    "EPL-1.0": Licence([" eclipse public | epl ", " 1 0 | v1 "], [" 2 0 ", " v2 "], ["Eclipse Public License, Version 1.0", "Eclipse Public License - v 1.0", "EPL-1.0"]),
    "EPL-2.0": Licence([" eclipse public | epl ", " 2 0 | v2 "], [" 1 0 ", " v1 "], ["Eclipse Public License, Version 2.0", "Eclipse Public License - v 2.0", "EPL-2.0"],
                       ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"]),
    "EUPL-1.2": Licence([" european union public | eupl ", " 1 2 "], [" 1 1 "], ["European Union Public Licence v. 1.2", "EUPL-1.2", "EUPL, Version 1.2"]),
    "GPL-2.0": _gnu("General Public License", "GPL", "2", "June 1991", [_GENERAL], [_LESSER, _AFFERO, _version("3"), _version("2 1")]),
    "GPL-3.0": _gnu("General Public License", "GPL", "3", "29 June 2007", [_GENERAL], [_LESSER, _AFFERO, _version("2")]),
    "ISC": Licence([" isc |hereby granted provided that the above copyright notice"], [" 0bsd |zero clause"], ["ISC License", "ISC Licence"],
                   [_ISC_GRANT + _ISC_NOTICE, _ISC_GRANT + _ISC_NOTICE + _ISC_REST, "ISC License " + _ISC_GRANT + _ISC_NOTICE + _ISC_REST]),
    "LGPL-2.1": _gnu("Lesser General Public License", "LGPL", "2.1", "February 1999", [_LESSER], [_AFFERO, _version("3")]),
    "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", "3", "29 June 2007", [_LESSER], [_AFFERO, _version("2")]),
    "MIT": Licence([" mit | expat licen[sc]e |granted free of charge to any person obtaining a copy of this software"],
                   [" mit 0 |mit no attribution"], ["MIT License", "MIT"],
                   ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
                    "to deal in the Software without restriction", _MIT_GRANT, _MIT_GRANT + _MIT_REST, "MIT License " + _MIT_GRANT + _MIT_REST]),
    "MIT-0": Licence([" mit 0 |mit no attribution"], (), ["MIT No Attribution License", "MIT-0", "MIT No Attribution"]),
    "MPL-1.1": Licence([" mozilla public | mpl ", " 1 1 "], [" 2 0 "], ["Mozilla Public License Version 1.1", "MPL-1.1", "MPL 1.1"]),
    "MPL-2.0": Licence([" mozilla public | mpl ", " 2 0 "], [" 1 1 ", _GENERAL], ["Mozilla Public License Version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
                       ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                        "You can obtain one at https://mozilla.org/MPL/2.0/."]),
    "OFL-1.1": Licence([" sil open font | ofl ", " 1 1 "], (), ["SIL Open Font License, Version 1.1", "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007", "OFL-1.1"],
                       ["This Font Software is licensed under the SIL Open Font License, Version 1.1."]),
    "Unlicense": Licence([" unlicense |unencumbered software released into the public domain"], (), ["Unlicense"],
                         ["This is free and unencumbered software released into the public domain."]),
    "Zlib": Licence([" zlib |warranty in no event will the authors be held liable"], [" libpng "], ["zlib License", "Zlib"],
                    ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use "
                     "of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
                     "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
                     "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
                     "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
                     "3. This notice may not be removed or altered from any source distribution."]),
}
#: What a unit holds at least, to be looked at.
CUE = r"licen[sc]e|copyright|permission is (?:hereby )?granted|public domain|redistribution and use|gplv[23]|cc[ -]by|cc0"
LICENCE_FILE = r"^(licen[sc]e|copying|unlicense)([.-].*)?$"
#: Marks at the start of a comment line.
MARK = r"^[ \t]*(?://+!?|#+|/[*]+|[*]+/?|;+|--+|%+|<!--)[ \t]*"
MIN_COSINE = 0.75
#: Between parts of a text, where no text has it.
_CUT = "\x01"
TOKEN = r"[a-z0-9]+"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _template_rows(licences: Mapping[str, Licence]) -> list[tuple[str, int, str, int]]:
    """(licence, number, term, count) of every template."""
    texts = {name: [*l.texts, *[st.format(n) for n in l.names for st in STATEMENTS], f"SPDX-License-Identifier: {name}"] for name, l in licences.items()}
    return [(name, i, term, n) for name in texts for i, t in enumerate(texts[name]) for term, n in sorted(Counter(re.findall(TOKEN, t.lower())).items())]


def _fitting(words: Column, licences: Mapping[str, Licence]) -> Column:
    """The licences whose deciding words are among ``words`` (joined by blanks, one around)."""
    fit = []
    for name, l in licences.items():
        ok = F.lit(True)
        for p in l.must:
            ok = ok & words.rlike(p)
        for p in l.never:
            ok = ok & ~words.rlike(p)
        fit.append(F.when(ok, F.lit(name)))
    return F.array_compact(F.array(*fit))


def _parts(lower: Column, speaks: Column) -> Column:
    """The units of a text, see the module; an array of strings."""
    lines = F.split(lower, "\n", -1)
    bare = F.transform(lines, lambda l: strip_spaces(F.regexp_replace(l, MARK, "")))
    marked = F.transform(lines, lambda l: l.rlike(MARK))
    rows = F.arrays_zip(bare.alias("bare"), marked.alias("marked"), F.concat(F.array(F.lit(None).cast("boolean")), F.slice(marked, F.lit(1), F.size(marked) - 1)).alias("before"))
    runs = F.array_join(F.transform(rows, lambda r: F.when(r["marked"], F.concat(r["bare"], F.lit("\n"))).otherwise(_CUT)), "")
    paragraphs = F.array_join(F.transform(rows, lambda r: F.when(r["bare"] == "", _CUT).otherwise(
        F.concat(F.when(r["marked"] == r["before"], "").otherwise(_CUT), r["bare"], F.lit("\n")))), "")
    sentences = F.regexp_replace(paragraphs, r"[.][ \t\n]+([a-z])", f".{_CUT}$1")
    whole = F.when(speaks, F.array(lower)).otherwise(F.array().cast("array<string>"))
    return F.concat(lines, F.split(runs, _CUT, -1), F.split(paragraphs, _CUT, -1), F.split(sentences, _CUT, -1), whole)


def _scored(units: DataFrame, files: DataFrame, licences: Mapping[str, Licence]) -> DataFrame:
    """(unit, licence, score): the best template of the licence that each distinct (unit, words, only) names, if it reaches MIN_COSINE.

    ``unit`` is a hash, so that a unit's words don't carry its text along.
    """
    spark = files.sparkSession
    rows = _template_rows(licences)
    words = sorted({r[2] for r in rows})
    counted = files.select(F.explode(F.array_intersect(_terms(F.col("lower")), F.array(*[F.lit(w) for w in words]))).alias("term")).groupBy("term").count()
    known = {r["term"]: r["count"] for r in counted.collect()}  # one row per word of the templates at most
    total = files.count()
    idf = F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    vocabulary = spark.createDataFrame([(w, known.get(w, 0)) for w in words], "term string, df long").select("term", idf.alias("idf"))
    weights = spark.createDataFrame(rows, "licence string, number int, term string, tf int").join(F.broadcast(vocabulary), "term")
    length = weights.groupBy("licence", "number").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm"))
    weights = weights.join(length, ["licence", "number"]).select("licence", "number", "term", (F.col("tf") * F.col("idf") / F.col("norm")).alias("weight"))

    unknown = F.log(F.lit(1.0 + total)) + 1.0
    terms = (units.select("unit", "only", F.explode(_terms(F.col("words"))).alias("term")).groupBy("unit", "only", "term").agg(F.count("*").alias("tf"))
             .join(F.broadcast(vocabulary), "term", "left").withColumn("value", F.col("tf") * F.coalesce("idf", unknown)))
    norms = terms.groupBy("unit").agg(F.sqrt(F.sum(F.pow("value", F.lit(2)))).alias("norm"))
    dots = terms.where(F.col("idf").isNotNull()).join(
        F.broadcast(weights).withColumnRenamed("licence", "only"), ["term", "only"]).groupBy("unit", F.col("only").alias("licence"), "number").agg(
        F.sum(F.col("value") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    best = dots.join(norms, "unit").select("unit", "licence", cosine.alias("score")).where(F.col("score") >= MIN_COSINE)
    return best.groupBy("unit", "licence").agg(F.max("score").alias("score"))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licences(files: DataFrame, path_col: str = "path", text_col: str = "text",
                  licences: Mapping[str, Licence] = LICENCES) -> DataFrame:
    """Input rows plus ``licence`` (SPDX name or NULL), ``how`` (own, inherited or none), ``score`` and ``from_dir``.

    Paths use ``/``. ``score`` is the cosine of what decided, ``from_dir`` the directory that a licence is inherited from
    (empty: the root). Ties of cosine go to the first name. Several licence files of a directory: the best score
    speaks for it. NULL and empty texts hold no licence; a NULL path is a file outside all directories that shares nothing.
    Rows repeating a path are one file and get one answer. An empty table gives no rows. Columns of the four names
    are replaced; ``licences`` is a list of the caller's, whose words are broadcast.
    """
    made = ("licence", "how", "score", "from_dir")
    rows = files.select(F.struct(*[F.col(c) for c in files.columns if c not in made]).alias("row"), F.col(path_col).alias("path"))
    texts = files.select(F.col(path_col).alias("path"), ascii_lower(F.col(text_col)).alias("lower"))
    name = F.regexp_extract(F.lower("path"), r"[^/]*$", 0)
    speaks = name.rlike(LICENCE_FILE)
    units = (texts.where(F.col("path").isNotNull() & F.col("lower").rlike(CUE)).select("path", speaks.alias("speaks"), F.explode(_parts(F.col("lower"), speaks)).alias("words"))
             .where(F.col("words").rlike(CUE)).select("path", "speaks", F.array_join(_terms(F.col("words")), " ").alias("words"))
             .withColumn("unit", F.struct(F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), "words").alias("b"))).distinct())
    named = (cut(units.select("unit", "words").distinct()).withColumn("fit", _fitting(F.concat(F.lit(" "), F.col("words"), F.lit(" ")), licences))
             .where(F.size("fit") == 1).select("unit", "words", F.col("fit")[0].alias("only")))
    scored = _scored(named, texts, licences)
    best = F.min(F.struct((-F.col("score")).alias("rank"), "licence")).alias("m")
    own = units.select("path", "speaks", "unit").join(scored, "unit").groupBy("path", "speaks").agg(best).select("path", "speaks", "m.licence", (-F.col("m.rank")).alias("score"))
    speaking = (own.where("speaks").groupBy(_directory(F.col("path")).alias("from_dir")).agg(best)
                .select("from_dir", F.col("m.licence").alias("d_licence"), (-F.col("m.rank")).alias("d_score")))

    # a directory and all above it; the root is the empty one
    deep = F.split("dir", "/", -1)
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(deep))), lambda i: F.array_join(F.slice(deep, 1, i), "/"))
    homes = texts.where(F.col("path").isNotNull()).select(_directory(F.col("path")).alias("dir")).distinct()
    nearest = (homes.select("dir", F.explode(above).alias("from_dir")).join(speaking, "from_dir").groupBy("dir")
               .agg(F.max_by(F.struct("from_dir", "d_licence", "d_score"), F.char_length("from_dir")).alias("near")).select("dir", "near.*"))
    out = (rows.withColumn("dir", _directory(F.col("path"))).join(own.select("path", "licence", "score"), "path", "left").join(nearest, "dir", "left"))
    mine = F.col("licence").isNotNull()
    return out.select(
        "row.*", F.coalesce("licence", "d_licence").alias("licence"),
        F.when(mine, "own").when(F.col("d_licence").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.coalesce("score", "d_score").alias("score"), F.when(~mine, F.col("from_dir")).alias("from_dir"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: every 500th a licence file of its language, every other 50th one of its folder."""
    home = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    folder = F.concat_ws("/", home, F.floor(F.col("doc_id") / 1000).cast("string"))
    number = F.col("doc_id").cast("string")
    path = (F.when(F.col("doc_id") % 500 == 0, F.concat(home, F.lit("/LICENSE."), number))
            .when(F.col("doc_id") % 50 == 0, F.concat(folder, F.lit("/LICENSE."), number)).otherwise(F.concat(folder, F.lit("/"), number, F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle() -> str:
    """DuckDB SQL for ``scan_licences(document_files(documents))`` with LICENCES."""
    values = ", ".join(f"({_quoted(n)}, {i}, {_quoted(t)}, {c})" for n, i, t, c in _template_rows(LICENCES))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    blank = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    fit = ", ".join(f"CASE WHEN {' AND '.join([f'regexp_matches(w, {_quoted(p)})' for p in l.must] + [f'NOT regexp_matches(w, {_quoted(p)})' for p in l.never])} THEN {_quoted(n)} END"
                    for n, l in LICENCES.items())
    return rf"""
WITH tpl(licence, number, term, tf) AS (VALUES {values}),
files AS (SELECT doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') || CASE
    WHEN doc_id % 500 = 0 THEN '/LICENSE.' || doc_id
    WHEN doc_id % 50 = 0 THEN '/' || doc_id // 1000 || '/LICENSE.' || doc_id
    ELSE '/' || doc_id // 1000 || '/' || doc_id || '.txt' END AS path, coalesce({lower}, '') AS low FROM documents),
n AS (SELECT count(*)::DOUBLE AS total FROM files),
found AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(low, '{TOKEN}'))) AS term FROM files),
df AS (SELECT term, count(*) AS df FROM found WHERE term IN (SELECT term FROM tpl) GROUP BY term),
idf AS (SELECT term, ln((1 + total) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM tpl) LEFT JOIN df USING (term), n),
tw AS (SELECT licence, number, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY licence, number)) AS weight FROM tpl JOIN idf USING (term)),
looked AS (SELECT doc_id, path, low, string_split(low, chr(10)) AS lines FROM files WHERE regexp_matches(low, '{CUE}')),
kinds AS (SELECT *, list_transform(lines, lambda l: trim(regexp_replace(l, '{MARK}', ''), {blank})) AS bare,
          list_transform(lines, lambda l: regexp_matches(l, '{MARK}')) AS marked FROM looked),
joined AS (SELECT *, array_to_string(list_transform(lines, lambda l, i: CASE WHEN marked[i] THEN bare[i] || chr(10) ELSE chr(1) END), '') AS runs,
           array_to_string(list_transform(lines, lambda l, i: CASE WHEN bare[i] = '' THEN chr(1) WHEN i > 1 AND marked[i] = marked[i - 1] THEN bare[i] || chr(10)
                                                              ELSE chr(1) || bare[i] || chr(10) END), '') AS paragraphs FROM kinds),
pieces AS (
    SELECT doc_id, unnest(lines) AS unit FROM joined
    UNION ALL SELECT doc_id, unnest(string_split(runs, chr(1))) FROM joined
    UNION ALL SELECT doc_id, unnest(string_split(paragraphs, chr(1))) FROM joined
    UNION ALL SELECT doc_id, unnest(string_split(regexp_replace(paragraphs, '[.][ \t\n]+([a-z])', '.' || chr(1) || '\1', 'g'), chr(1))) FROM joined
    UNION ALL SELECT doc_id, low FROM files WHERE path LIKE '%/LICENSE.%'),
units AS (SELECT DISTINCT doc_id, array_to_string(regexp_extract_all(unit, '{TOKEN}'), ' ') AS unit FROM pieces WHERE regexp_matches(unit, '{CUE}')),
fitted AS (SELECT unit, list_filter([{fit}], lambda x: x IS NOT NULL) AS fit FROM (SELECT unit, ' ' || unit || ' ' AS w FROM (SELECT DISTINCT unit FROM units))),
tokens AS (SELECT unit, fit[1] AS only_one, unnest(string_split(unit, ' ')) AS term FROM fitted WHERE len(fit) = 1),
tf AS (SELECT unit, only_one, term, count(*) * coalesce(idf, ln(1 + total) + 1) AS value
       FROM tokens LEFT JOIN idf USING (term), n GROUP BY unit, only_one, term, idf, total),
norm AS (SELECT unit, sqrt(sum(value ** 2)) AS norm FROM tf GROUP BY unit),
scores AS (SELECT unit, licence, round(sum(value * weight) / any_value(norm), 6) AS score
           FROM tf JOIN tw ON tw.term = tf.term AND tw.licence = tf.only_one JOIN norm USING (unit) GROUP BY unit, licence, number),
ranked AS (SELECT doc_id, path, score, licence FROM units JOIN scores USING (unit) JOIN files USING (doc_id) WHERE score >= {MIN_COSINE}
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
speaking AS (SELECT regexp_replace(path, '/[^/]*$', '') AS dir, score, licence FROM ranked WHERE path LIKE '%/LICENSE.%'
             QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, licence) = 1),
heirs AS (SELECT f.doc_id, s.dir, s.score, s.licence FROM files f JOIN speaking s ON starts_with(f.path, s.dir || '/')
          QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(s.dir) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(r.licence, h.licence) AS licence,
       CASE WHEN r.licence IS NOT NULL THEN 'own' WHEN h.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       coalesce(r.score, h.score) AS score, CASE WHEN r.licence IS NULL THEN h.dir END AS from_dir
FROM files f LEFT JOIN ranked r USING (doc_id) LEFT JOIN heirs h USING (doc_id)"""
