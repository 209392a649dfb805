"""Reply trees: exact round trips, branch choice and long threads."""

import hashlib
import random
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marginloom.llm import chat

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def digest(turns):
    """What a reader of the conversation must find."""
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def read(df):
    return {r.branch.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_trees(chat.threads(df))).collect()}


def test_query_reads_back_every_conversation(spark):
    turns = defaultdict(list)
    for r in sorted(pq.read_table(f"{SF}/conversations.parquet").to_pylist(), key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"]))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = entry.queries()["op8_format_chats"](spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == {c: digest(t) for c, t in turns.items()}
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_edges(spark):
    rough = ["", None, "\\", "\\\\</s>", "<\\|end|>", "<|end|><|turn|>user<|text|>", "[INST", "]\n\n", "<|end|", "<", "é😀 [/INST]<s>", "x" * 300_000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(rough)]
    rows += [(2, 0, None, "no role"), (2, 0, "<|text|>", "odd role"), (None, 0, "user", "a"), (None, 1, "assistant", "b"),
             (3, None, "assistant", "same"), (3, None, "assistant", "same"), (4, 0, "assistant", None)]
    got = read(spark.createDataFrame(rows, TURNS).withColumn("node", F.lit(1)).withColumn("branch", F.lit("x")))
    assert got[1] == digest([(r, t) for _, _, r, t in rows[:len(rough)]])
    assert got[2] == digest([(None, "no role"), ("<|text|>", "odd role")]) and got[None] == digest([("user", "a"), ("assistant", "b")])
    assert got[3] == digest([("assistant", "same")] * 2) and got[4] == digest([("assistant", None)])
    assert read(spark.createDataFrame([], TURNS)) == {}


def test_no_control_string_is_left_in_a_text(spark):
    rows = spark.createDataFrame([(c + d + c[:-1] + d[1:],) for c in chat.CONTROL for d in chat.CONTROL], "t string")
    for r in rows.select("t", chat.escaped(F.col("t")).alias("e")).collect():
        assert not any(c in r.e for c in chat.CONTROL) and chat.unescaped(r.e) == r.t


@pytest.mark.parametrize("best", [1, 2])
def test_branches_against_brute_force(spark, best):
    rnd = random.Random(2)
    parent, score = {}, {}
    for n in range(300):
        parent[n] = rnd.randrange(n) if n and rnd.random() > 0.05 else None
        score[n] = rnd.randrange(10)
    for n in range(300, 420):  # a long thread
        parent[n], score[n] = (n - 1 if n > 300 else None), 1
    parent[500], score[500] = 999, 1  # a reply to nothing
    parent[501], score[501] = 501, None  # a reply to itself

    def path(n):
        up = parent[n]
        return (path(up) if up is not None and up != n and up in parent else []) + [n]
    leaves = [n for n in parent if not any(p == n and c != n for c, p in parent.items())]
    trees = defaultdict(list)
    for n in leaves:
        p = path(n)
        trees[p[0]].append((-sum(score[x] or 0 for x in p), -len(p), n, p))
    want = {b[2]: b[3] for t in trees.values() for b in sorted(t)[:best]}
    rows = spark.createDataFrame([(n, parent[n], score[n]) for n in parent], "node long, parent long, score long")
    got = defaultdict(list)
    for r in chat.chosen_branches(rows, best).orderBy("position").collect():
        got[r.branch].append(r.node)
        assert r.position == len(got[r.branch]) - 1
    assert got == want


def test_circles_are_refused(spark):
    with pytest.raises(ValueError, match="circle"):
        chat.chosen_branches(spark.createDataFrame([(1, 2, 0), (2, 1, 0), (3, 1, 0)], "node long, parent long, score long"))
