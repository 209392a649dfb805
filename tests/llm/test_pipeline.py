"""The corpus pipeline: every stage works on all its predecessor kept, and its decisions take effect."""

from collections import Counter, defaultdict

import pyarrow.parquet as pq
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marginloom.llm import linededup, mixing, toxicity
from test_documents import groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_toxicity_stage(spark, stages):
    scores = toxicity.score_documents(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r["doc_id"] for r in rows(stages[1])} == {r.doc_id for r in scores.where("predicted = 0").collect()}


def test_line_stage(stages):
    want = {r.doc_id: r.text for r in linededup.drop_repeated_lines(stages[1]).collect()}
    got = rows(stages[2])
    assert {r["doc_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_near_dedup_stage(stages):
    before = rows(stages[2])
    component = groups([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in rows(stages[3])} == set(component.values())


def test_mixing_and_packing_stages(stages):
    copies = {r.doc_id: r.copies for r in mixing.mix(stages[3]).collect()}
    count = Counter(r["doc_id"] for r in rows(stages[4]))
    assert dict(count) == {d: n for d, n in copies.items() if n}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in rows(stages[3])}
    total = defaultdict(int)
    for r in rows(stages[5]):
        total[r["doc_id"]] += r["length"]
    assert dict(total) == {d: n * ids[d] for d, n in count.items()}


def test_run_writes_and_returns_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == stages[-1].count()
    assert got.select(F.sum("length")).first()[0] == stages[-1].select(F.sum("length")).first()[0]
