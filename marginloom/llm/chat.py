"""Chat formatting of reply trees.

Self-joins by doubling walk from every message to its root: after k joins a message knows its ancestor
2**k replies up and the score of the messages in between, so a thread of n replies takes log2(n) joins. That
gives every branch (root to leaf) its score; only the branches that win their conversation are then enumerated,
by the same jumps. A chosen branch becomes one conversation, written as one row per turn: the turn's piece of
the formatted text and the span of it that bears loss, both placed by code points. Reading back streams the
pieces of a conversation in order, so that even a conversation holding most turns needs little memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginloom.llm.common import arrow_rows, cut

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that steer a model and so never stand in a formatted text of their own; fixed values.
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
LOSS_ROLE = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column) -> Column:
    r"""Reversible: ``\`` is doubled, and a control string gets a ``\`` after its first character."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """From (node, parent, score): (node, root, depth, total) and, per k, the jumps (node, up) of 2**k replies.

    A parent that is no node, and a message that replies to itself, starts a tree. A circle of replies is an error.
    """
    own = nodes.select("node", F.when(F.col("node") != F.col("parent"), F.col("parent")).alias("parent"), "score")
    known = own.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = cut(own.join(known, "parent", "left").select(
        "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("node").alias("root"), F.lit(0).cast("long").alias("depth"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total")))
    # ``root`` is the furthest ancestor reached, ``up`` the one above it, ``depth`` the replies in between
    state = state.select("node", "up", "root", "depth", "total")
    jumps, most = [], max(state.count(), 1)
    while not (open_ := state.where(F.col("up").isNotNull())).isEmpty():
        if 1 << len(jumps) > most:
            raise ValueError("replies form a circle")
        jumps.append(open_.select("node", "up"))
        above = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"),
                             F.col("depth").alias("depth2"), F.col("total").alias("total2"))
        # those that have arrived stay out of the join, so short threads end early
        moved = open_.join(above, "up").select(
            "node", F.col("up2").alias("up"), F.col("root2").alias("root"), (F.col("depth") + 1 + F.col("depth2")).alias("depth"),
            (F.col("total") + F.col("total2")).alias("total"))
        state = cut(state.where(F.col("up").isNull()).unionByName(moved))
    return state.select("node", "root", "depth", "total"), jumps


def chosen_branches(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(branch, root, node, position): the messages of the ``best`` branches of every tree, position 0 the root.

    Branches rank by total score, then length, then the smaller leaf.
    """
    reached, jumps = climb(nodes)
    parents = nodes.where(F.col("parent").isNotNull() & (F.col("parent") != F.col("node"))).select(F.col("parent").alias("node")).distinct()
    leaves = reached.join(parents, "node", "left_anti")
    order = Window.partitionBy("root").orderBy(F.desc("total"), F.desc("depth"), "node")
    chosen = cut(leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
                 .select(F.col("node").alias("branch"), "root", "depth"))
    paths = chosen.select("branch", "root", F.col("branch").alias("node"), F.col("depth").alias("position"))
    for k, jump in enumerate(jumps):
        up = paths.join(jump, "node").select("branch", "root", F.col("up").alias("node"), (F.col("position") - (1 << k)).alias("position"))
        paths = cut(paths.unionByName(up))
    return paths


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """One row per turn of every chosen branch: branch, root, position, piece, at, loss_from, loss_to.

    ``messages`` has node (unique), parent, score, role and text. A conversation is its pieces in order of
    ``position``; ``at`` is where a piece begins, and the code points from ``loss_from`` up to ``loss_to`` are
    the (escaped) text of an assistant turn (NULL: no loss). NULL text or role counts as empty, NULL score as
    zero. A message without a parent, or whose parent is missing, is a root. No messages give no rows.
    """
    paths = chosen_branches(messages.select("node", "parent", "score"), best)
    rows = paths.join(messages.select("node", "role", "text"), "node")
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    rows = rows.select("branch", "root", "position", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    size = F.char_length("head") + F.char_length("body") + len(END)
    before = Window.partitionBy("branch").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)).cast("long"))
    loss = F.col("role") == LOSS_ROLE
    start = F.col("at") + F.char_length("head")
    return rows.select("branch", "root", "position", F.concat("head", "body", F.lit(END)).alias("piece"), "at",
                       F.when(loss, start).alias("loss_from"), F.when(loss, start + F.char_length("body")).alias("loss_to"))


class Reader:
    """Parses one formatted conversation from its pieces as they come."""

    def __init__(self):
        self.rest, self.turns, self.size = "", 0, 0
        self.all, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0

    def feed(self, piece: str, at: int, loss_from: int | None, loss_to: int | None) -> None:
        if at != self.size:
            raise ValueError(f"a piece at {at} follows {self.size} characters")
        self.size += len(piece)
        if loss_from is not None:
            text = unescaped(piece[loss_from - at:loss_to - at])
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
        *turns, self.rest = (self.rest + piece).split(END)
        for turn in turns:
            role, _, text = turn.removeprefix(TURN).partition(TEXT)
            self.all.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1


_DIGEST = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, reader, done = None, None, []

    def finished():
        rows = [(n, r.turns, r.all.hexdigest(), r.loss_chars, r.loss.hexdigest(), r.size) for n, r in done]
        done.clear()
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["branch", *_DIGEST])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for branch, piece, at, loss_from, loss_to in zip(*(c.to_pylist() for c in batch.columns)):
            if reader is None or branch != name:
                if reader is not None:
                    done.append((name, reader))
                name, reader = branch, Reader()
            reader.feed(piece, at, loss_from, loss_to)
        if done:
            yield finished()
    if reader is not None:
        done.append((name, reader))
        yield finished()


def read_back(formatted: DataFrame) -> DataFrame:
    """(branch, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every formatted conversation.

    The pieces of a conversation stream through one task in order; what is kept of them are digests.
    """
    arrow_rows(formatted.sparkSession, 500)
    kind = formatted.schema["branch"].dataType.simpleString()
    rows = formatted.select("branch", "piece", "at", "loss_from", "loss_to", "position")
    ordered = rows.repartition("branch").sortWithinPartitions("branch", "position").drop("position")
    return ordered.mapInArrow(_read, f"branch {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def threads(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages (node, parent, score, role, text) of linear conversations: every turn replies to the one before.

    Rows of a conversation are in order of turn (NULL first), ties by role and text; repeated rows are turns of
    their own. The rows of a NULL conversation are one conversation. A message scores its characters.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(order).cast("long"))
    node = lambda n: F.struct("conv", n.alias("n"))
    return rows.select(node(F.col("n")).alias("node"), F.when(F.col("n") > 1, node(F.col("n") - 1)).alias("parent"),
                       F.char_length(F.coalesce("text", F.lit(""))).alias("score"), "role", "text")
