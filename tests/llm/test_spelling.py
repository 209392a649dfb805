"""Spelling variants against brute force over all words."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginloom.llm import spelling
from marginloom.llm.registered import QUERIES

SF = "/root/testdata/sf0.001"
FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def vocabulary(rows, slip=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute_force(n, times=10):
    by_gap = defaultdict(set)  # words with a place left open, and words with a character left out
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by_gap[w[:i] + "*" + w[i + 1:]].add(w)
            if (short := w[:i] + w[i + 1:]) in n:
                near[w].add(short)
                near[short].add(w)
    for same in by_gap.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def rows_of(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = brute_force(vocabulary(docs))
    got = rows_of(QUERIES["op13_group_spellings"](spark, SF))
    assert got == want and sum(f is not None for f, *_ in want.values()) >= 10


@pytest.mark.parametrize("blocks", [64, 1 << 22])
def test_chains_ties_and_small_filters(docs_of, monkeypatch, blocks):
    monkeypatch.setattr(spelling, "MOST_BLOCKS", blocks)
    words = {"balloon": 1, "baloons": 1, "letters": 4000, "lettersx": 400, "lettersxy": 40, "lettersxyz": 4, "mississippi": 30, "missisippi": 3,
             "mississipi": 3, "missssippi": 2, "abcdefg": 2, "abcdefh": 20, "abcdefi": 20, "zéphyrs": 50, "zephyrs": 2, "ÀÀÀÀÀÀÀ": 9, "àààààààà": 9}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())] + [(None, "letters LETTERS"), (77, None), (78, ""), (78, "9 9")]
    docs = docs_of(rows).withColumnRenamed("key", "word").withColumnRenamed("id", "n")
    want = brute_force(vocabulary(rows, slip=10**10))
    got = rows_of(spelling.variant_groups(docs, slip=10**10))
    assert got == want
    assert got["lettersxyz"][:2] == ("lettersxy", "letters") and got["abcdefg"][0] == "abcdefh" and got["letters"][2] == 4002


def test_few_of_the_edits_pass_the_filters(spark):
    rnd = np.random.default_rng(1)
    words = sorted({"".join(rnd.choice(list("aeinrst"), size=rnd.integers(7, 12))) for _ in range(4000)})
    vocab = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    passed = spelling.candidates(vocab, spelling.bloom_filters(vocab)).toPandas()
    known = set(words)
    pairs = sum(x[2] for x in ((w, None, v[3]) for w, v in brute_force(dict.fromkeys(words, 2)).items())) // 2
    assert sum(o in known for o in passed["other"]) == pairs  # each pair once, none lost
    probes = sum(len(w) * len(spelling.LETTERS) / 2 for w in words)
    assert len(passed) - pairs < 0.02 * probes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=3, max_size=5), min_size=1, max_size=12, unique=True))
def test_hashes_of_edits(words):
    by = defaultdict(list)
    for w in words:
        by[len(w)].append(w)
    for own in by.values():
        codes, seen = spelling._codes(own), {}

        def known(length, h):
            seen["h"] = h
            return np.ones(len(h), dtype=bool)
        for rows, kind, i, c in spelling.edits(codes, known):
            for j, h in zip(rows, seen["h"]):
                new = own[j][:i] + ("" if kind == "delete" else chr(c)) + own[j][i + 1:]
                assert spelling._hashed(spelling._codes([new]))[0] == h


def test_empty_table(docs_of):
    got = spelling.variant_groups(docs_of([]))
    assert got.collect() == [] and got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
