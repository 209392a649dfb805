"""Registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginloom.llm import alignment, bpe, chat, fingerprints, licences, linededup, mixing, packing, quality, simhash, spelling, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENS = {"json_path": public_tokenizers.path("byte_bpe_50k.json"), "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
          "pattern": public_tokenizers.PATTERN}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query(licences.oracle())
def op2_scan_licences(spark, sf_dir):
    files = licences.document_files(table(spark, sf_dir, "documents"))
    return licences.scan_licences(files).select("doc_id", "path", "licence", "how", "score", "from_dir")


@query()
def op3_simhash_groups(spark, sf_dir):
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query()
def op4_repetition_rules(spark, sf_dir):
    m = "measures."
    return quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", f"{m}n_words", f"{m}word_chars", f"{m}n_symbols", f"{m}n_dup_lines", f"{m}n_repeat_words", "base_failed", "kept")


@query()
def op5_score_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query(r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
frequent AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id < f.keeper, false) AS lost
    FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op6_drop_repeated_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op7_multiset_fingerprints(spark, sf_dir):
    rows = fingerprints.compare_with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprints.as_text(F.col("fp")).alias("fingerprint"),
                       fingerprints.as_text(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")


@query()
def op8_format_chats(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_trees(chat.threads(turns))).select(F.col("branch.conv").alias("conv_id"), *chat._DIGEST)


@query(urlfilter.oracle())
def op9_judge_urls(spark, sf_dir):
    pages = urlfilter.labelled_pages(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))
    return urlfilter.judge_urls(pages, urlfilter.RULES, good_col="good").select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_pack_sequences(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), **TOKENS)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op11_stream_bpe(spark, sf_dir):
    where = {"json_path": TOKENS["json_path"]}
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), pattern=TOKENS["pattern"], **where)
    return bpe.decode_documents(encoded, **where).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op12_align_tokens(spark, sf_dir):
    rows = alignment.align_documents(table(spark, sf_dir, "documents"), TOKENS["json_path"], TOKENS["pattern"],
                                     public_tokenizers.path("piece_bpe_32k.model"), overlaps=False)
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    digests = rows.select("doc_id", "row", "n_a", "n_b", F.size("links").cast("long").alias("n_groups"), hashed, "links")
    return alignment.weigh_links(digests, keep=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])


@query()
def op13_group_spellings(spark, sf_dir):
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
