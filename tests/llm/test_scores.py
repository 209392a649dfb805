"""Quality rules and toxicity scores: brute force, held-out accuracy and edges."""

import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marginloom.llm import quality, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside))


def shares(text):
    """Repetition coverage, slowly: characters of words inside windows that occurred before."""
    words = WORD.findall(text or "")
    chars, out = max(sum(map(len, words)), 1), {}
    for n in range(2, 11):
        seen, inside, count = set(), set(), Counter()
        for i in range(len(words) - n + 1):
            w = tuple(words[i:i + n])
            count[w] += 1
            if w in seen:
                inside |= set(range(i, i + n))
            seen.add(w)
        out[f"top_{n}"] = max(((c - 1) * sum(map(len, w)) / chars for w, c in count.items()), default=0.0)
        out[f"repeated_{n}"] = sum(len(words[i]) for i in inside) / chars
    return out


def failed(b):
    return b[0] < 20 or 100 * b[4] > 30 * b[0]


def test_quality_query(spark):
    docs = {d["doc_id"]: d["text"] for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got = entry.queries()["op4_repetition_rules"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        b = base(docs[r.doc_id])
        assert tuple(r[c] for c in COUNTS) == b and r.base_failed == failed(b) and not (r.kept and r.base_failed)
    assert sum(r.kept for r in got) > 0.6 * len(got)


def test_coverage_equals_brute_force(monkeypatch):
    rough = ["a b a b a b a b a b a b c", "é é\né é é é", None, "", " \n ", "x", "one two " * 50, "q\x85w q\x85w e q\x85w", "z " * 5_000]
    texts = rough + [d["text"] for d in pq.read_table(f"{SF}/documents.parquet").slice(0, 60).to_pylist()]
    for portion in (1 << 20, 300):
        monkeypatch.setattr(quality, "PORTION", portion)
        rows = quality.measure(texts)
        for i, t in enumerate(texts):
            want = shares(t)
            assert all(abs(rows[c][i] - want[c]) < 1e-9 for c in quality.SHARES if c in want), (i, t)
            assert tuple(rows[c][i] for c in COUNTS) == base(t)


def test_short_texts_alone(docs_of):
    for n in range(13):
        for text in (" ".join(f"w{i}" for i in range(n)), "a " * n):
            rows, want = quality.measure([text]), shares(text)
            assert tuple(rows[c][0] for c in COUNTS) == base(text) and all(abs(rows[c][0] - want[c]) < 1e-9 for c in quality.SHARES if c in want)
    assert [r.kept for r in quality.judge_quality(docs_of([(1, "one two three")])).collect()] == [False]


def test_quality_edges(docs_of):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, clean), (3, clean), (None, clean), (4, (clean + "\n") * 4), (5, clean + " again and again" * 15),
            (6, " ".join(f"w{i}" for i in range(200_000)))]
    got = quality.judge_quality(docs_of(rows))
    assert [c for c in got.columns if c not in ("measures", "base_failed", "kept")] == [c for c in docs_of(rows).columns if c != "kept"]
    kept = sorted(((r.doc_id, r.kept) for r in got.collect()), key=str)
    assert kept == sorted([(1, False), (2, False), (3, True), (3, True), (None, True), (4, False), (5, False), (6, True)], key=str)
    assert quality.judge_quality(docs_of([])).collect() == []


def toxic_rows(n=600):
    good = "the plan of the day was read out in the hall and all went home with a calm mind".split()
    bad = ("fool", "rotten", "vermin", "filthy")
    rows, labels = [], []
    for i in range(n):
        words = [good[(i * 7 + k * (1 + i % 5)) % len(good)] for k in range(30 + i % 9)]
        if i % 4 == 0:
            for k in range(3):
                words[(5 + 7 * k + i) % len(words)] = bad[(i + k) % 4]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity_learns_and_holds_out(spark, docs_of):
    rows, labels = toxic_rows()
    rows += [(None, None), (10_001, ""), (10_002, None), (10_003, "you filthy rotten fool " * 30_000), (7, rows[7][1])]
    rotten = [(i, 1 - v if zlib.crc32(str(i).encode()) % 5 == 0 else v) for i, v in labels]  # held-out labels are wrong on purpose
    known = spark.createDataFrame(rotten + [(None, 1), (3, None), (5, 7)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.score_documents(docs_of(rows), known).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    truth = dict(labels)
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert out and sum(r.predicted == truth[r.doc_id] for r in out) > 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert by[10_003].predicted == 1 and by[10_001].predicted == by[10_002].predicted == by[None].predicted == 0
    assert len({r.score for r in got if r.doc_id == 7}) == 1


def test_scores_keep_the_share_of_labels_when_the_sample_is_capped(spark, docs_of, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 200)
    monkeypatch.setattr(toxicity, "SAMPLE_OTHER", 100)
    rows = [(i, "the plan of the day " * (3 + i // 5 % 4)) for i in range(2_000)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.score_documents(docs_of(rows), labels).collect()
    assert abs(sum(r.score for r in got) / len(got) - 0.2) < 0.08 and not any(r.predicted for r in got)


def test_a_repeated_id_is_one_row_of_the_sample(spark, docs_of):
    """An id that holds most rows, with texts of its own, gives the sample one row; the smallest text hash says which."""
    rows, labels = toxic_rows(80)
    rows += [(4, f"text {i % 40}") for i in range(4_000)] + [(4, None)] * 10
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    first, again = ({tuple(r) for r in toxicity._sample(docs, known, "doc_id", "text", "toxic").collect()}
                    for docs in (docs_of(rows), docs_of(rows[::-1]).repartition(5)))
    learned = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in labels)
    assert len(first) <= learned and first == again
    assert toxicity._sample(docs_of(rows), known, "doc_id", "text", "toxic").count() == learned


def test_toxicity_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(docs_of([(1, "a"), (2, None)]), none).collect()} == {0.0}
    rows, labels = toxic_rows(80)
    assert toxicity.score_documents(docs_of([]), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() == []


def test_toxicity_query(spark):
    got = entry.queries()["op5_score_toxicity"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == pq.read_table(f"{SF}/documents.parquet").num_rows


def test_obfuscation_is_seen():
    lexicon = {b"idiot": 5.0}
    f = dict(zip(toxicity.FEATURES, toxicity.text_features("what an Id10t! YOU are, an i.d", lexicon, frozenset([b"you"]))))
    assert f["obfuscated_hits"] == 1
    g = dict(zip(toxicity.FEATURES, toxicity.text_features("you idiot", lexicon, frozenset([b"you"]))))
    assert g["hits_near_address"] == 1 and g["hit_rate"] == 0.5
