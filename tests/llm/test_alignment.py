"""Alignment of two tokenizations against byte-by-byte brute force over the tokenizer libraries."""

import functools
import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marginloom.llm import alignment, bpe
from marginloom.llm.registered import QUERIES, TOKENS

PATHS = {"json_path": TOKENS["json_path"], "pattern": TOKENS["pattern"], "model_path": public_tokenizers.path("piece_bpe_32k.model")}
A = Tokenizer.from_file(PATHS["json_path"])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS["model_path"])
MAP = bpe.byte_alphabet()
SF = "/root/testdata/sf0.001"
START = lambda token: token[1]


def spans(tokens):
    end, out = 0, []
    for i, b in tokens:
        out.append((i, end, end + len(b)))
        end += len(b)
    return out


def tokens_of(text):
    a = [(i, bytes(MAP[c] for c in A.id_to_token(i))) for i in A.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode())
         for i in B.encode(text or "")]
    whole = (" " + (text or "")).encode()
    if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    return spans(a), spans(b)


def brute_force(rows):
    """By id: n_a, n_b, groups, pairs that end together, pairs that overlap."""
    out = {}
    for i, text in rows:
        a, b = tokens_of(text)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, before, at = [], 0, {e: y for y, _, e in b}
        for e in ends:
            groups.append("|".join(",".join(str(t) for t, s, f in x if before <= s and f <= e) for x in (a, b)) if len(a) < 60 else
                          "|".join(",".join(str(t) for t, _, _ in x[bisect_left(x, before, key=START):bisect_left(x, e, key=START)]) for x in (a, b)))
            before = e
        ending = [(x, y) for x, _, e in a for y, _, f in b if e == f] if len(a) < 60 else \
            [(x, at[e]) for x, _, e in a if e in at]
        over = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e] if len(a) < 60 else None
        out[i] = (len(a), len(b), ";".join(groups), ending, over)
    return out


ODD = ["a", " ", "  two  blanks ", "<s></s><unk><|endoftext|>", "<0x41>", "▁", "a▁b", "caféé 你好\U0001f600", "\n\n\t x", "\u0000", "ﬁ ½", "internationalization" * 5,
       "x" * 3000, "　", "﻿bom", "Ωmega naïve"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), max_size=60), st.integers(1, 40))
def test_pieces_of_any_size_give_the_same(x, y, size):
    total = max(sum(x), sum(y))
    x, y = x + [total - sum(x)] * (total > sum(x)), y + [total - sum(y)] * (total > sum(y))
    a, b = (np.cumsum(np.array(z, dtype=np.int64)) for z in (x, y))
    end_a, end_b, over_a, over_b = alignment.aligned(a, b, size)
    start = lambda ends, i: ends[i - 1] if i else 0
    assert list(zip(end_a, end_b)) == [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if start(a, i) < b[j] and start(b, j) < a[i]]
    assert list(zip(over_a, over_b)) == sorted(want)
    work = [i_to - i + j_to - j for i, j, i_to, j_to in alignment.pieces(a, b, size)]
    assert sum(work) == len(a) + len(b) and max(work, default=0) <= size + 1


@pytest.mark.parametrize("piece", [3, 1 << 15])
def test_odd_texts(docs_of, piece, monkeypatch):
    monkeypatch.setattr(alignment, "PORTION", 200 if piece == 3 else 1 << 20)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, ""), (None, "a b")]
    want = brute_force(rows)
    docs = docs_of(rows).withColumnRenamed("key", "links").withColumnRenamed("id", "groups")
    got = alignment.align_documents(docs, **PATHS, piece=piece).collect()
    assert len(got) == len(rows) and len({r.row for r in got}) == len(rows)
    number = lambda pairs: [x * alignment.B_IDS + y for x, y in pairs]
    for r in got:
        n_a, n_b, groups, ending, over = want[r.doc_id]
        assert (r.n_a, r.n_b, r.groups, r.links) == (n_a, n_b, groups, number(ending))
        assert over is None or sorted(r.overlaps) == sorted(number(over))


def digest(found):
    links = Counter(p for *_, e, _ in found.values() for p in e)
    top = defaultdict(int)
    for (_, b), n in links.items():
        top[b] = max(top[b], n)
    return {i: (n_a, n_b, len(e), len(e), sum(links[p] == top[p[1]] for p in e), sum(links[p] for p in e),
                hashlib.sha256(g.encode()).hexdigest() if n_a else "") for i, (n_a, n_b, g, e, _) in found.items()}


@functools.cache
def expected():
    return digest(brute_force([(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]))


@pytest.mark.parametrize("sent", [1, 300, 100_000])
def test_query_equals_brute_force(spark, sent, monkeypatch):
    monkeypatch.setattr(alignment, "SENT_PAIRS", sent)
    want = expected()
    got = QUERIES["op12_align_tokens"](spark, SF).collect()
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got} == want
    assert len(got) == len(want)


def test_repeated_ids_hot_pairs_and_empty_tables(spark, docs_of, monkeypatch):
    monkeypatch.setattr(alignment, "SENT_PAIRS", 2)
    docs = docs_of([(1, "the the the cat"), (1, "the the the cat"), (None, "the dog"), (2, None)])
    rows = alignment.align_documents(docs, **PATHS)
    got = alignment.weigh_links(rows, keep=["doc_id", "n_a"]).collect()
    assert sorted((str(r.doc_id), r.n_a, r.n_links, r.n_best, r.count_sum) for r in got) == \
        [("1", 4, 4, 4, 7 * 3 + 2), ("1", 4, 4, 4, 7 * 3 + 2), ("2", 0, 0, 0, 0), ("None", 2, 2, 2, 8)]
    lists = spark.createDataFrame([(1, [7, 7, 8]), (1, None), (2, [])], "k int, links array<long>")
    assert sorted((r.k, r.n_links, r.n_best, r.count_sum) for r in alignment.weigh_links(lists, keep=["k"]).collect()) == \
        [(1, 0, 0, 0), (1, 3, 3, 5), (2, 0, 0, 0)]
    none = alignment.weigh_links(alignment.align_documents(docs_of([]), **PATHS), keep=["doc_id"])
    assert none.collect() == [] and none.columns == ["doc_id", "n_links", "n_best", "count_sum"]


def test_short_pieces_equal_the_merge_list_and_the_library():
    encoder = alignment.word_encoder(PATHS["json_path"], PATHS["pattern"])
    assert isinstance(encoder.short, alignment.ShortPieces)
    words = ["the", "straße", "Ünïcödé", "naïve\n", "１２３", "a\u3000b", "\x00", "<s>", "ĿĿĿ", "x" * 63, "x" * 64, "x" * 200, "don't--stop", "ab" * 31]
    for w in words:
        assert list(encoder._learn(w)) == A.encode(" " + w, add_special_tokens=False).ids
        assert encoder.short(w) == encoder.merges.encode(w.encode())


def test_a_vocabulary_with_a_token_its_bytes_do_not_become_keeps_the_merge_list():
    merges = alignment.bpe.of_process(PATHS["json_path"]).merges
    a, b, c = (merges.single[x] for x in b"abc")
    odd = object.__new__(bpe.MergeList)
    odd.single, odd.made = merges.single, [70_000, 70_001, 70_002]
    odd.bytes_of = {i: merges.bytes_of[i] for i in merges.single} | {70_000: b"ab", 70_001: b"bc", 70_002: b"abc"}
    odd.after = [{} for _ in range(70_003)]
    odd.after[a][b], odd.after[b][c], odd.after[a][70_001] = 0, 1, 2  # "abc" becomes ab, c
    assert odd.encode(b"abc") == [70_000, c]
    assert alignment.short_pieces(odd) is None


def test_ends_that_meet_are_found_without_the_overlaps():
    a, b = np.cumsum([1, 2, 3, 1, 1, 4]), np.cumsum([3, 2, 1, 2, 4])
    for size in (2, 3, 100):
        whole, part = alignment.aligned(a, b, size), alignment.aligned(a, b, size, overlaps=False)
        assert len(part) == 2 and all(np.array_equal(x, y) for x, y in zip(whole, part))
