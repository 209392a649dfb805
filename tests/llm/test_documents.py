"""Mixing, near-duplicates, line dedup and packing against brute force on small tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check import compare
from marginloom.llm import linededup, mixing, packing, simhash
from marginloom.llm.registered import TOKENS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE = "this line is long enough to be a key of at least forty characters"


def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows):
    """id -> smallest id of its component, by comparing all pairs."""
    fps = {}
    for i, t in rows:
        fps.setdefault(fingerprint(t), []).append(i)
    names = {f: f for f in fps}

    def find(f):
        while names[f] != f:
            f = names[f]
        return f
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            names[find(a)] = find(b)
    least = defaultdict(list)
    for f, ids in fps.items():
        least[find(f)] += [i for i in ids if i is not None]
    return {(i, f): min(least[find(f)], default=None) for f, ids in fps.items() for i in ids}


def test_simhash_query_equals_brute_force(spark):
    got = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in entry.queries()["op3_simhash_groups"](spark, SF).collect()}
    assert got == groups([(d["doc_id"], d["text"]) for d in documents()])


def test_simhash_edges(docs_of):
    long_text = " ".join(f"w{i % 911}" for i in range(60_000))
    rows = [(5, None), (3, ""), (9, " \n\t"), (7, "One two THREE four"), (8, "one two three  four"), (None, "one two three four"),
            (2, long_text), (1, long_text + " tail"), (4, "é É ss"), (4, "é É ss"), (6, "a"), (None, "alone")]
    got = simhash.near_duplicate_groups(docs_of(rows)).collect()
    want = groups(rows)
    assert len(got) == len(rows)
    assert all(want[(r.doc_id, int(r.fingerprint, 16))] == r.component_id for r in got)
    assert simhash.near_duplicate_groups(docs_of([])).collect() == []
    kept = simhash.keep_one_per_group(docs_of(rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, 1, 4, 6, None], key=str)
    assert kept.columns == docs_of(rows).columns


def test_one_row_of_each_group_stays(docs_of):
    one, two, three = (" ".join(f"{c}{i}" for i in range(50)) for c in "xyz")
    rows = [(5, one), (5, two), (5, two), (9, one), (None, one), (None, three), (None, three), (7, two), (1, ""), (2, None)]
    got = sorted((str(r.doc_id), (r.text or "-")[0]) for r in simhash.keep_one_per_group(docs_of(rows)).collect())
    assert got == [("1", "-"), ("5", "x"), ("5", "y"), ("None", "z")]
    assert simhash.keep_one_per_group(docs_of([])).collect() == []


@pytest.mark.parametrize("tile", [100_000, 40])
def test_links_join_what_all_pairs_join(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE_ROWS", tile)
    monkeypatch.setattr(simhash, "BLOCK_PAIRS", 500)
    rnd = random.Random(1)
    centre = [rnd.getrandbits(64) for _ in range(60)]
    fps = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centre[:5] for _ in range(60)} | set(centre)
    fps |= {c ^ sum(1 << b for b in rnd.sample(range(64), 3)) for c in centre}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    names = {f: f for f in signed}

    def find(f):
        while names[f] != f:
            f = names[f]
        return f
    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
            names[find(a)] = find(b)
    same = defaultdict(set)
    for f in signed:
        same[find(f)].add(f)
    assert all(len({roots.get(f, f) for f in s}) == 1 for s in same.values())
    assert len({roots.get(f, f) for f in signed}) == len(same)


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(7, 7)]
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert set(roots.values()) == {0, 1000} and roots[200] == 0 and roots[1049] == 1000


def without_repeated_lines(rows, min_chars=40, min_docs=5):
    """{(id, text): kept text} by the rule as written."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    lost = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    return {(i, t): "\n".join(x for x in (t or "").split("\n") if i is None or lost.get(key(x), i) == i) for i, t in rows}


def test_an_id_with_a_third_of_the_rows_and_very_long_documents(docs_of):
    rnd = random.Random(4)
    pool = [f"line {n} " + "shared words of a passage " * 2 for n in range(60)]
    rows = [(7 if n % 3 == 0 else n, "\n".join(rnd.choice([*pool, "", " short ", f"own {n} " + "x" * 40]) for _ in range(rnd.randint(0, 30)))) for n in range(300)]
    rows += [(7, rows[0][1])] * 50 + [(None, pool[0]), (11, None)]
    long_lines = [f"{n} of many distinct lines, each long enough to count" for n in range(16_000)]
    rows += [(1000 + n, "\n".join([f"first {n}", *long_lines[::1 if n % 2 else -1], "last"])) for n in range(5)]
    want = without_repeated_lines(rows)
    got = linededup.drop_repeated_lines(docs_of(rows)).collect()
    kept = defaultdict(list)
    for i, t in rows:
        kept[i].append((want[i, t] if t is not None or want[i, t] else t, len((t or "").split("\n"))))
    mine = defaultdict(list)
    for r in got:
        mine[r.doc_id].append((r.text, r.n_lines))
    order = {k: sorted(v, key=str) for k, v in kept.items()}
    assert {k: sorted(v, key=str) for k, v in mine.items()} == order


def test_line_dedup_query_equals_sql(spark, duck):
    name = "op6_drop_repeated_lines"
    status, rows, _, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert status == "ok" and rows, note


def test_line_dedup_edges(docs_of):
    odd = f"\t{LINE.upper()}\x0b \r"
    rows = [(i, f"head {i}\n{LINE}\n{LINE}\ntail") for i in range(5)] + [
        (9, odd), (10, None), (11, ""), (None, LINE), (None, LINE), (12, "\n\n"), (12, "\n\n"), (13, f"{LINE} "),
        (14, "short\nshort"), (15, f"x\n{'y' * 2_000_000}")]
    got = linededup.drop_repeated_lines(docs_of(rows))
    assert [c for c in got.columns if c in docs_of(rows).columns] == [c for c in docs_of(rows).columns if c != "n_lines"] + ["n_lines"]
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append((r.text, r.n_lines, r.n_dropped))
    assert by[0] == [("head 0\ntail", 4, 2)] and by[9] == [(odd, 1, 0)] and by[10] == [(None, 1, 0)] and by[11] == [("", 1, 0)]
    assert by[None] == [(LINE, 1, 0)] * 2 and by[12] == [("\n\n", 3, 0)] * 2 and by[13] == [(f"{LINE} ", 1, 0)]
    assert by[14] == [("short\nshort", 2, 0)] and by[15][0][1:] == (2, 0)
    assert linededup.drop_repeated_lines(docs_of([])).collect() == []
    four = linededup.drop_repeated_lines(docs_of([(i % 4, LINE) for i in range(12)])).collect()
    assert all(r.n_dropped == 0 for r in four)  # twelve rows, but four ids
    gone = linededup.drop_repeated_lines(docs_of([(i, LINE) for i in range(5)])).collect()
    assert sorted((r.doc_id, r.text) for r in gone) == [(0, ""), (1, ""), (2, ""), (3, ""), (4, LINE)]


def check_pack(got, texts, limits=packing.Limits()):
    """Round trip: pieces give back each document's ids; sequences are gapless and within the limits."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        parts[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, text in texts:
        want = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted(parts[i], key=lambda r: r.start)
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine])[:-1])
        assert b"".join(bytes(r.ids) for r in mine) == np.array(want, dtype="<u4").tobytes()
        assert {r.doc_tokens for r in mine} == {len(want)}
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == list(np.cumsum([0] + [r.length for r in s])[:-1])
        assert sum(r.length for r in s) <= limits.tokens and len(s) <= limits.segments and sum(r.n_loss for r in s) <= limits.loss
    return sum(limits.tokens - sum(r.length for r in s) for s in seqs.values()) / (limits.tokens * len(seqs))


def test_packing_edges(docs_of):
    rows = [(0, None), (1, ""), (2, "a  b   c\n  d"), (3, " lead"), (4, "x <|endoftext|> y"), (5, "tail "), (6, "\n \n  \t x"),
            (7, "word " * 30_000), (8, "naïve café  x y don't I'll"), (9, "a   b"), (10, "12 34,56 %%%  $$")]
    check_pack(packing.pack_documents(docs_of(rows).coalesce(1), **TOKENS).collect(), rows)
    twice = packing.pack_documents(docs_of([(1, "same text"), (1, "same text"), (None, "x")]), **TOKENS).collect()
    assert [r.length for r in twice if r.doc_id == 1] == [3, 3] and [r.doc_id for r in twice].count(None) == 1
    assert packing.pack_documents(docs_of([]), **TOKENS).collect() == []


def test_packing_query_and_padding(spark):
    docs = documents()
    texts = [(d["doc_id"], d["text"]) for d in docs]
    got = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), **TOKENS).collect()
    assert check_pack(got, texts) < 0.02
    digest = {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in entry.queries()["op10_pack_sequences"](spark, SF).collect()}
    assert digest == {(r.doc_id, r.start): (r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens) for r in got}


def test_packing_limits_for_instructions(spark):
    rnd = random.Random(3)
    rows = [(i, "answer words here " * rnd.randint(1, 60), "question? " * rnd.randint(0, 80)) for i in range(400)]
    limits = packing.Limits(tokens=512, segments=6, loss=200, cut_above=10**6, window=64)
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, prompt string").coalesce(1),
                                 prompt_col="prompt", limits=limits, **TOKENS).collect()
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append(r)
    assert all(sum(r.length for r in s) <= 512 and len(s) <= 6 and sum(r.n_loss for r in s) <= 200 for s in seqs.values())
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text, _ in rows:
        assert sum(r.n_loss for r in got if r.doc_id == i) == len(tok.encode(text).ids) + 1


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Hands the excess on, again and again, until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        left, w = total - sum(capped.values()), sum(weight[s] for s in order if s not in capped)
        share = {s: capped.get(s, left * weight[s] / w if w else 0.0) for s in order}
        over = [s for s in order if s not in capped and share[s] > most * sizes[s]]
        if not over:
            return share
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("slice_rows, broadcast", [(20_000, 500_000), (7, 500_000), (7, 0)])
def test_mixing_meets_targets(spark, docs_of, monkeypatch, slice_rows, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    rnd = random.Random(5)
    plenty = {"b": 300, "ä": 20, None: 5, "c": 40, "a": 2, "empty": 3}
    rows, i = [], 0
    for s, n in plenty.items():
        for _ in range(n):
            rows.append((i, "" if s == "empty" else "w " * rnd.randint(0, 50), s))
            i += 1
    rows += [(10_000, None, "b")]
    got = mixing.mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert 0 <= r.taken <= 3 * r.size
    want = brute_targets(dict(sizes))
    for s in plenty:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]), s
        assert abs(taken[s] - target[s]) <= largest[s]
    assert mixing.mix(docs_of([])).collect() == []
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs_of(rows)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    count = defaultdict(int)
    for r in mixing.mixed(docs_of(rows)).collect():
        count[r.doc_id] += 1
    assert all(count[r.doc_id] == r.copies for r in got)


def test_mixing_prefers_quality(spark):
    from pyspark.sql import functions as F
    rows = spark.range(4000).select("id", mixing.sampling_key(F.col("id"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0)).alias("k"))
    first = [r.id for r in rows.orderBy("k").limit(500).collect()]
    assert 0.7 < sum(i % 2 == 0 for i in first) / 500 < 0.9  # four to one


def test_line_hash_of_kept_text(spark):
    got = {r.doc_id: r for r in entry.queries()["op6_drop_repeated_lines"](spark, SF).collect()}
    for d in documents():
        if got[d["doc_id"]].n_dropped == 0:
            assert got[d["doc_id"]].kept_sha256 == hashlib.sha256((d["text"] or "").encode()).hexdigest()
