"""Multiset fingerprints: edits by brute force, order independence, insertion and deletion."""

import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marginloom.llm import fingerprints

SF = "/root/testdata/sf0.001"


def edits(rows):
    """(id, n, sha of the edited text) in descending order of id."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for i, (name, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 3
        yield name, len(text), hashlib.sha256((text[:len(text) - k] + after[:k]).encode()).hexdigest()


@pytest.mark.parametrize("slice_rows, broadcast", [(4_096, 10**6), (7, 10**6), (7, 0)])
def test_query(spark, monkeypatch, slice_rows, broadcast):
    monkeypatch.setattr(fingerprints, "BROADCAST_SLICES", broadcast)
    monkeypatch.setattr(fingerprints, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(fingerprints, "QUANTILES", 5)
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    got = entry.queries()["op7_multiset_fingerprints"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(edits([(d["doc_id"], d["text"]) for d in docs]))
    prints = {}
    text = {d["doc_id"]: d["text"] for d in docs}
    for r in got:
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len(set(prints.values())) == len(prints)
    long_ones = [r for r in got if r.n_chars > 400]
    assert sum(r.near_edited for r in long_ones) / len(long_ones) > 0.55
    assert sum(r.near_edited > r.near_next for r in long_ones) > 0.95 * len(long_ones)


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, "ab"), (7, "é😀ü"), (5, "one two\nthree"), (9, "long " * 200_000), (None, "no id at all"), (12, "x")]
    got = fingerprints.compare_with_edits(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in got), key=str) == sorted(edits(rows), key=str)
    assert fingerprints.compare_with_edits(docs_of([])).collect() == []
    alone = fingerprints.compare_with_edits(docs_of([(1, "abcdef")])).first()
    assert (alone.edited, alone.near_next) == ("abcdab", 1.0)
    same = fingerprints.compare_with_edits(docs_of([(1, "a b c")] * 3)).collect()
    assert len(same) == 3 and {r.near_next for r in same} == {1.0}


def test_homomorphism(spark):
    row = spark.createDataFrame([("a b\nc d e f g\nc d e f g", "c d e f g\na b\nc d e f g", "c d e f g", "a b\nc d e f g", "a b\na b\nc d e f g")],
                                "x string, permuted string, part string, rest string, other string")
    f = fingerprints.fingerprint
    r = row.select(f(F.col("x")).alias("x"), f(F.col("permuted")).alias("permuted"), f(F.col("other")).alias("other"),
                   fingerprints.without_paragraphs(f(F.col("x")), f(F.col("part"))).alias("less"), f(F.col("rest")).alias("rest"),
                   fingerprints.with_paragraphs(f(F.col("rest")), f(F.col("part"))).alias("more")).first()
    assert r.x == r.permuted == r.more and r.less == r.rest and r.x != r.other
