"""Vector bin packing of token sequences.

A sequence has limits on tokens, segments and loss-bearing tokens at once. The dot-product heuristic
fills one sequence at a time: of the pieces that fit, it takes the one whose demand points most in the
direction of what is left, each dimension weighted by the mean demand. Every task packs the documents of
its own partition in bounded windows, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from marginloom.llm.common import arrow_rows


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold; ``cut_above`` is the room (in tokens) worth cutting a document for."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    cut_above: int = 32
    window: int = 2048


class WordTokens(dict):
    """Ids (uint16, little-endian bytes) of the words of a text, each with the blank before it.

    The byte-level pre-tokenizer never joins anything across a blank that follows a non-blank, so a text
    can be cut at single blanks and each word looked up. Texts with two blanks in a row, and those that
    spell a special token, go through ``tokenizers`` whole. Memory is bounded: a full table becomes the older
    generation, from which words move up when they come again.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str, most: int = 400_000):
        super().__init__()
        self.whole = Tokenizer.from_file(json_path)
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.most, self.older = most, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.pack(self.encode(" " + word))
        self[word] = ids
        return ids

    @classmethod
    def of_process(cls, json_path: str, ranks_path: str, pattern: str) -> WordTokens:
        """The table that this worker process keeps from task to task."""
        kept = vars(sys).setdefault("_marginloom_word_tables", {})
        key = (json_path, ranks_path, pattern)
        if key not in kept:
            kept[key] = cls(json_path, ranks_path, pattern)
        return kept[key]

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        out = array("H", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def ids(self, text: str) -> np.ndarray:
        if "  " in text or "<|endoftext|>" in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u2")
        first, *rest = text.split(" ")
        head = self.pack(self.encode(first))
        return np.frombuffer(b"".join([head, *map(self.__getitem__, rest)]), dtype="<u2")


class Packer:
    """Packs pieces of one task; ``put`` and ``end`` yield finished sequences as lists of pieces.

    A piece is (document, start, ids, loss-bearing ids); only the last ``loss`` of its ids bear loss.
    """

    def __init__(self, limits: Limits):
        self.limits, self.open = limits, []
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)

    def put(self, piece: tuple) -> Iterator[list[tuple]]:
        if len(piece[2]) >= self.limits.tokens or piece[3] >= self.limits.loss:
            yield [piece]
            return
        self.open.append(piece)
        if len(self.open) >= self.limits.window:
            yield from self.pack(final=False)

    def end(self) -> Iterator[list[tuple]]:
        yield from self.pack(final=True)

    def pack(self, final: bool) -> Iterator[list[tuple]]:
        """Fills sequences from the open pieces; unless final, the last quarter stays open for better company."""
        pieces, self.open = self.open, []
        demand = np.array([(len(p[2]), 1, p[3]) for p in pieces], dtype=float).reshape(-1, 3) / self.caps
        weight = demand.mean(axis=0) if len(pieces) else demand
        alive, left = np.ones(len(pieces), dtype=bool), len(pieces)
        enough = 0 if final else self.limits.window // 4
        while left > enough:
            room, taken = np.ones(3), []
            while left:
                fits = np.flatnonzero(alive & (demand <= room + 1e-12).all(axis=1))
                if not len(fits):
                    break
                at = int(fits[np.argmax(demand[fits] @ (weight * room))])
                alive[at], left = False, left - 1
                room = room - demand[at]
                taken.append(pieces[at])
            free = round(room[0] * self.caps[0])
            if left and free >= self.limits.cut_above and round(room[1] * self.caps[1]) >= 1:
                at = int(np.argmax(np.where(alive, demand[:, 0], -1)))
                doc, start, ids, loss = pieces[at]
                head_loss = max(0, free - (len(ids) - loss))  # the loss-bearing ids come last
                if free < len(ids) and head_loss <= round(room[2] * self.caps[2]):
                    taken.append((doc, start, ids[:free], head_loss))
                    pieces[at] = (doc, start + free, ids[free:], loss - head_loss)
                    demand[at] = np.array([len(ids) - free, 1, loss - head_loss]) / self.caps
            yield taken
        self.open = [pieces[i] for i in np.flatnonzero(alive)]


def _cut(document: int, ids: np.ndarray, loss: int, limits: Limits) -> Iterator[tuple]:
    """Pieces of a document that fit a sequence on their own."""
    plain, at = len(ids) - loss, 0
    while at < len(ids):
        upto = min(at + limits.tokens, len(ids), max(at, plain) + limits.loss)
        yield document, at, ids[at:upto], max(0, upto - max(at, plain))
        at = upto


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", prompt_col: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, n_loss, sequence_id, offset.

    A document is the ids of its text followed by ``end_id``; ``ids`` holds a piece's ids as little-endian
    unsigned 32-bit numbers. With ``prompt_col`` the ids of that text come first and bear no loss; without
    it all ids do. Documents longer than a sequence are cut, shorter ones are only cut where that fills
    ``limits.cut_above`` ids or more. Each id lies in exactly one piece, pieces fill a sequence gapless from
    offset 0, and ``sequence_id`` is unique (partition, number in it).

    NULL or empty text is the end id alone. Rows repeating an id are separate documents. A NULL id passes
    through. Other columns are not read. An empty table gives no pieces.
    """
    arrow_rows(docs.sparkSession, 500)
    id_type = docs.schema[id_col].dataType
    columns = [id_col, text_col] + ([prompt_col] if prompt_col else [])
    schema = (f"`{id_col}` {id_type.simpleString()}, start long, length long, ids binary, doc_tokens long, n_loss long, "
              "sequence_id long, offset long")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = WordTokens.of_process(json_path, ranks_path, pattern), Packer(limits)
        base, made = TaskContext.get().partitionId() << 40, 0
        docs_open: dict[int, tuple] = {}
        serial = 0
        out: list[tuple] = []

        def emit(sequences):
            nonlocal made
            for sequence in sequences:
                offset = 0
                for doc, start, ids, loss in sequence:
                    name, total, left = docs_open[doc]
                    out.append((name, start, len(ids), ids.astype("<u4").tobytes(), total, loss, base + made, offset))
                    offset += len(ids)
                    if left == len(ids):
                        del docs_open[doc]
                    else:
                        docs_open[doc] = (name, total, left - len(ids))
                made += 1

        def drained():
            arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*out), target)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        target = None
        for batch in batches:
            if target is None:
                number = pa.int64()
                target = pa.schema([pa.field(id_col, batch.schema.field(0).type)] + [
                    pa.field(n, pa.binary() if n == "ids" else number)
                    for n in ("start", "length", "ids", "doc_tokens", "n_loss", "sequence_id", "offset")])
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            prompts = batch.column(2).to_pylist() if prompt_col else [None] * len(names)
            for name, text, prompt in zip(names, texts, prompts):
                ids = np.append(words.ids(text or ""), np.uint16(end_id))
                loss = len(ids)
                if prompt:
                    ids = np.concatenate([words.ids(prompt), ids])
                docs_open[serial] = (name, len(ids), len(ids))
                for piece in _cut(serial, ids, loss, limits):
                    emit(packer.put(piece))
                serial += 1
                if len(out) >= 2000:
                    yield drained()
        emit(packer.end())
        if out:
            yield drained()

    return docs.select(*columns).mapInArrow(pack, schema)
