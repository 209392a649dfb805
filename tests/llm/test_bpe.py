"""The BPE transducer against the tokenizers library, whole and in chunks of any size."""

import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marginloom.llm import bpe
from marginloom.llm.registered import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
MERGES = bpe.MergeList(PATH)
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "  ", "   a", "a  ", "a \n b", "\n\n x", "don't I'll 've '", " 's", "x'r", "<|endoftext|>", "a  <|endoftext|>  b<|endoftext|>",
       "<|endoftext", "<|endof<|endoftext|>text|>", "tab\t\tx  y  z　", "\x1c \x1d a\x85 b", "häß 你好 \U0001f600\U0001f468‍\U0001f469", "�﻿", "12345 678",
       "\u0000\u0001", "é́́ á", "_" * 50 + " " * 70 + "=" * 45 + "x" * 90]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def chunked(encoder, text, sizes):
    out, at = [], 0
    for n in sizes:
        out += encoder.feed(text[at:at + n])
        at += n
    return out + encoder.feed(text[at:], last=True)


def encoder(**more):
    return bpe.Encoder(MERGES, public_tokenizers.PATTERN, MERGES.special, **more)


def test_odd_texts():
    e = encoder()
    for text in ODD:
        assert e.encode(text) == library_ids(text), repr(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "'", "s", "ll", "a", "the", "ing", "é", "9", "..", "<|endoftext|>", "<|end", "|>", "\t", "你"]), max_size=40),
       st.lists(st.integers(0, 9), max_size=60))
def test_chunks_don_t_matter(parts, sizes):
    text = "".join(parts)
    assert chunked(encoder(words=3), text, sizes) == library_ids(text)


@pytest.mark.parametrize("long", [1, 6])
def test_long_runs_are_streamed(monkeypatch, long):
    monkeypatch.setattr(bpe, "LONG", long)
    rnd = random.Random(long)
    for _ in range(300):
        kinds = ["aeinrst", "0123", " ", "\n \t", "'=-_", "éü你"]
        text = "".join("".join(rnd.choices(rnd.choice(kinds), k=rnd.randint(1, 30))) for _ in range(rnd.randint(1, 6)))
        if rnd.random() < 0.3:
            text = text.replace("e", "<|endoftext|>", 1)
        assert chunked(encoder(), text, [rnd.randint(0, 12) for _ in range(30)]) == library_ids(text), repr(text)


def test_stream_holds_a_block_and_the_reach():
    rnd = random.Random(1)
    words = [MERGES.bytes_of[i] for i in MERGES.made]
    for alphabet in (b"ab", b"aeinorst", b" ", b"-=", bytes(range(97, 123)), None):
        data = bytes(rnd.choices(alphabet, k=20_000)) if alphabet else b"".join(rnd.choices(words, k=3000))
        stream, out = bpe.PieceStream(MERGES, block=1), []
        for i in range(0, len(data), 97):
            stream.push(data[i:i + 97], out)
            assert len(stream.held) < MERGES.longest + MERGES.reach
        stream.end(out)
        assert out == MERGES.encode(data)
        assert MERGES._encode_long([MERGES.single[b] for b in data[:40]]) == MERGES.encode(data[:40])


def test_reach_of_a_small_list():
    merges = [(b"b", b"c"), (b"a", b"b"), (b"x", b"ab")]
    # the boundary before c moves over b, then over a, then over x
    assert bpe.MergeList._reach(merges) == 3
    with pytest.raises(ValueError):
        bpe.MergeList._reach([(b"ab", b"c"), (b"a", b"b")])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=40), st.integers(1, 5))
def test_decoding_any_ids(ids, step):
    d = bpe.Decoder(MERGES)
    parts = [d.feed(ids[i:i + step]) for i in range(0, len(ids), step)] + [d.feed((), last=True)]
    assert "".join(parts) == LIBRARY.decode(ids, skip_special_tokens=False) == d.decode(ids)


def test_query_equals_the_library(spark):
    got = {r.doc_id: r for r in QUERIES["op11_stream_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        ids = library_ids(d["text"] or "")
        want = (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
        assert (got[d["doc_id"]].n_tokens, got[d["doc_id"]].ids_sha256, got[d["doc_id"]].decoded_sha256) == want


def test_rows_nulls_and_clashing_columns(spark, docs_of):
    long = "ab" * 40_000 + " " * 9000 + "x y " * 20_000
    rows = [(1, None), (1, "a b"), (None, ""), (2, long), (2, long), *((10 + i, t) for i, t in enumerate(ODD))]
    docs = docs_of(rows).withColumnRenamed("key", "ids").withColumnRenamed("id", "decoded")
    encoded = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    got = bpe.decode_documents(encoded, PATH).collect()
    want = [(i, library_ids(t or ""), t or "") for i, t in rows]
    assert sorted(map(str, ((r.doc_id, r.ids, r.decoded) for r in got))) == sorted(map(str, want))
    plain = bpe.encode_documents(docs_of([(1, "<|endoftext|>")]), PATH, public_tokenizers.PATTERN, special=False).first().ids
    assert plain != [50256] and LIBRARY.decode(plain) == "<|endoftext|>"
    empty = bpe.decode_documents(bpe.encode_documents(docs_of([]), PATH, public_tokenizers.PATTERN), PATH)
    assert empty.collect() == [] and empty.columns == ["doc_id", "ids", "decoded"]
    broken = spark.sql("select 1 as doc_id, cast(x'61ff62' as string) as text")
    assert bpe.encode_documents(broken, PATH, public_tokenizers.PATTERN).first().ids == library_ids("a�b")
    missing = spark.createDataFrame([(1, None), (2, [None, 64, 10**6])], "k int, ids array<int>")
    assert [r.decoded for r in bpe.decode_documents(missing, PATH).orderBy("k").collect()] == ["", "a"]
