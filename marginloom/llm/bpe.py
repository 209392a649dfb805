"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

A merge at rank r joins tokens u and v. Take the tokens of a text w and of any longer text that begins with w. While
the merges are applied in order of rank, both agree up to a boundary, at first the end of w. Merge (u, v) moves it
only by joining the token u before the boundary to a token v behind it, so by the length of u; every token that
begins at the new boundary later has u on its left spine. So the boundary moves along chains of merges of rising rank
in which each right part holds the left part before it on its left spine, and the heaviest chain, summed over the
lengths of the left parts, bounds the way (``MergeList.reach``): all tokens that end that many bytes before the end of
what was read are final, whatever follows. What stays buffered is a block and the reach, however long a word is.

The text before the merges is cut by the pre-tokenizer's pattern. A blank after anything but white space always
begins a new piece, so whole words are looked up in a bounded table; all else goes through the pattern piece by piece.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.llm.common import arrow_rows

#: Bytes beyond which a piece is merged by a heap instead of scanning.
SCANNED = 40
#: Undecided characters beyond which a piece is merged as a stream of its own.
LONG = 1 << 12
#: Characters of a text that are fed at once, and ids that one Arrow batch holds.
CHUNK, BATCH_IDS = 1 << 16, 1 << 20
#: Words in each of the two generations of a table.
WORDS = 400_000
_NONE = 1 << 40
#: Letters below are letters in every version of Unicode.
_LATIN_END = "\u0220"
_BLANK_AFTER_SPACE = re.compile(r"\s(?= )")
_RUNS = [regex.compile(p) for p in (r"\s*", r"\p{L}*", r"\p{N}*", r"[^\s\p{L}\p{N}]*")]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where Latin-1 prints it, else the next one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """Merges, token bytes, special tokens and the sufficient lookahead of a byte-level vocabulary file."""

    def __init__(self, json_path: str):
        with open(json_path, encoding="utf-8") as f:
            file = json.load(f)
        to_byte = byte_alphabet()
        raw = lambda s: bytes(map(to_byte.__getitem__, s))
        self.special = {t["content"]: t["id"] for t in file["added_tokens"] if t["special"]}
        added = {t["id"] for t in file["added_tokens"]}
        ids = {raw(k): v for k, v in file["model"]["vocab"].items() if v not in added}
        merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in file["model"]["merges"]]
        self.bytes_of = {i: b for b, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.after = [{} for _ in range(max(self.bytes_of, default=-1) + 1)]  # by left id: right id to rank
        for r, (a, b) in enumerate(merges):
            self.after[ids[a]][ids[b]] = r
        self.made = [ids[a + b] for a, b in merges]
        self.reach = self._reach(merges)
        self.longest = max(map(len, ids))

    @staticmethod
    def _reach(merges: Sequence[tuple[bytes, bytes]]) -> int:
        """Bytes from the end of what was read within which tokens can still change."""
        left, heaviest = {}, {}
        for u, v in merges:
            if any(len(x) > 1 and x not in left for x in (u, v)):
                raise ValueError("a merge uses a token that no earlier merge makes")
            before, spine = 0, v
            while spine is not None:
                before = max(before, heaviest.get(spine, 0))
                spine = left.get(spine)
            heaviest[u] = max(heaviest.get(u, 0), len(u) + before)
            left[u + v] = u
        return max(heaviest.values(), default=0)

    def encode(self, data: bytes) -> list[int]:
        """Ids of one piece: always the leftmost of the pairs of lowest rank."""
        tokens = [self.single[b] for b in data]
        if len(tokens) > SCANNED:
            return self._encode_long(tokens)
        after, made = self.after, self.made
        ranks = [after[a].get(b, _NONE) for a, b in zip(tokens, tokens[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            tokens[i] = joined = made[best]
            del tokens[i + 1], ranks[i]
            if i:
                ranks[i - 1] = after[tokens[i - 1]].get(joined, _NONE)
            if i < len(ranks):
                ranks[i] = after[joined].get(tokens[i + 1], _NONE)
        return tokens

    def _encode_long(self, tokens: list[int]) -> list[int]:
        """The same with a heap of (rank, place) over a linked list."""
        n, rank = len(tokens), lambda i, j: self.after[tokens[i]].get(tokens[j])
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if tokens[i] is None or (j := right[i]) == n or rank(i, j) != r:
                continue  # one of the two was merged meanwhile
            tokens[i], tokens[j], right[i] = self.made[r], None, right[j]
            if right[j] < n:
                left[right[j]] = i
            for a in (left[i], i):
                if a >= 0 and right[a] < n and (s := rank(a, right[a])) is not None:
                    heapq.heappush(heap, (s, a))
        return [t for t in tokens if t is not None]


class PieceStream:
    """Merges one piece of any length; holds at most a block and the reach."""

    def __init__(self, merges: MergeList, block: int = 1 << 12):
        self.merges, self.block, self.held = merges, max(block, merges.longest), b""

    def push(self, data: bytes, out: list[int]) -> None:
        self.held += data
        need, at = self.block + self.merges.reach, 0
        while len(self.held) - at >= need:
            stable = at + self.block
            for i in self.merges.encode(self.held[at:at + need]):
                end = at + len(self.merges.bytes_of[i])
                if end > stable:
                    break
                out.append(i)
                at = end
        self.held = self.held[at:]

    def end(self, out: list[int]) -> None:
        out.extend(self.merges.encode(self.held))
        self.held = b""


class Encoder:
    """Text to ids, chunk by chunk: ``feed`` returns the ids that nothing still to come can change.

    A table of words keeps the ids of those met before; when full it becomes the older generation, from which words
    move up when they come again, so its memory is bounded.
    """

    def __init__(self, merges: MergeList, pattern: str, special: Mapping[str, int] | None = None, words: int = WORDS,
                 short: Callable[[str], Sequence[int]] | None = None):
        """``short`` gives the ids of pieces of at most 64 characters in the merge list's place."""
        self.merges, self.pattern, self.special = merges, regex.compile(pattern), dict(special or {})
        self.short = short or (lambda piece: merges.encode(piece.encode("utf-8", "replace")))
        self.markers = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if special else None
        self.widest = max(map(len, self.special), default=0)
        self.most, self.known, self.older, self.bare = words, {}, {}, {}
        self.rest, self.run, self.stream = "", None, None

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        if len(text) <= CHUNK:
            return self.feed(text, last=True)
        return list(chain.from_iterable(self.feed(text[i:i + CHUNK], last=i + CHUNK >= len(text))
                                        for i in range(0, len(text), CHUNK)))

    def feed(self, chunk: str, last: bool = False) -> list[int]:
        text, out, at = self.rest + chunk, [], 0
        if self.markers:
            for hit in self.markers.finditer(text):
                if not last and hit.start() + self.widest > len(text):
                    break  # a longer one may begin here
                self._segment(text[at:hit.start()], out, hit.start() - at, last=True)
                out.append(self.special[hit.group()])
                at = hit.end()
        rest = text[at:]
        self.rest = self._segment(rest, out, len(rest) if last else len(rest) - max(self.widest - 1, 0), last)
        return out

    def _segment(self, text: str, out: list[int], sure: int, last: bool) -> str:
        """Encodes what is decided of a text between special tokens, returns the rest.

        From ``sure`` on the text may still turn out to be a special token.
        """
        at = 0
        if self.run is None and not _BLANK_AFTER_SPACE.search(text):
            at = len(text) if last else max(text.rfind(" ", 0, max(sure, 0)), 0)
            if at:
                self._words(text[:at], out)
        if last or len(text) - at > LONG:
            at = self._pieces(text, at, out, sure, last)
        return text[at:]

    def _words(self, text: str, out: list[int]) -> None:
        first, *words = text.split(" ")
        if first:
            out.extend(self._unit(first))
        known = self.known
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = self._learn(w)
                known = self.known
            out += ids

    def _learn(self, word: str) -> Sequence[int]:
        """Ids of a blank and the word; only words of some length at most are kept."""
        if len(self.known) >= self.most:
            self.older, self.known = self.known, {}
        ids = self.older.get(word)
        if ids is None:
            one_piece = word.isalpha() and (word.isascii() or max(word) < _LATIN_END)
            ids = tuple(self._unit(" " + word) if not one_piece else self.short(" " + word) if len(word) < 64 else self.merges.encode(b" " + word.encode()))
        if len(word) <= 64:
            self.known[word] = ids
        return ids

    def _unit(self, text: str) -> list[int]:
        """Ids of text that no piece leaves; its pieces are words too, or stand without a blank before them."""
        out: list[int] = []
        for piece in self.pattern.findall(text):
            if piece[0] == " " and 1 < len(piece) < len(text):
                ids = self.known.get(piece[1:])
                out += self._learn(piece[1:]) if ids is None else ids
                continue
            ids = self.bare.get(piece)
            if ids is None:
                ids = self.short(piece) if len(piece) <= 64 else self.merges.encode(piece.encode("utf-8", "replace"))
                if len(piece) <= 64:
                    if len(self.bare) >= self.most // 4:
                        self.bare = {}
                    self.bare[piece] = ids
            out += ids
        return out

    def _pieces(self, text: str, at: int, out: list[int], sure: int, last: bool) -> int:
        """The pattern's pieces from ``at`` on; returns the end of the last decided one.

        A piece is decided two characters before the end of the sure text, as contractions look that far.
        """
        safe = len(text) if last else sure - 2
        while at < len(text):
            if self.run is not None:
                stop, closed = self._run_end(text, at, safe, last)
                if stop > at:
                    self.stream.push(text[at:stop].encode("utf-8", "replace"), out)
                    at = stop
                if not closed:
                    return at
                self.stream.end(out)
                self.run = None
                continue
            hit = self.pattern.match(text, at)
            if hit is None:  # nothing in the pattern leaves a character out
                at += 1
                continue
            if hit.end() <= safe and hit.end() - at <= LONG:
                out += self.merges.encode(hit.group().encode("utf-8", "replace"))
                at = hit.end()
            elif safe - at > LONG:
                self.run = next(r for r in _RUNS if r.match(text[min(at + 1, safe - 1)]).end())
                self.stream = PieceStream(self.merges)
            else:
                return at
        if self.run is not None and last:
            self.stream.end(out)
            self.run = None
        return at

    def _run_end(self, text: str, at: int, safe: int, last: bool) -> tuple[int, bool]:
        """Where the open piece ends in the text so far, and whether it does. White space leaves its last character to what follows."""
        begin = at + 1 if not self.stream.held and text[at] == " " and self.run is not _RUNS[0] else at
        end = self.run.match(text, begin).end()
        if last and end == len(text):
            return end, True
        end -= self.run is _RUNS[0]
        return (end, True) if end <= safe else (max(safe, at), False)


class Decoder:
    """Ids to text: a UTF-8 state machine over the bytes of the tokens; invalid bytes become U+FFFD, unknown ids nothing."""

    def __init__(self, merges: MergeList):
        self.merges, self.bytes_of = merges, merges.bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Sequence[int], last: bool = False) -> str:
        find = self.bytes_of.get
        return self.machine.decode(b"".join([find(i, b"") for i in ids]), last)

    def decode(self, ids: Sequence[int]) -> str:
        self.machine.reset()
        parts = [self.feed(ids[i:i + CHUNK]) for i in range(0, len(ids), CHUNK)]
        return "".join([*parts, self.feed((), last=True)])


def of_process(json_path: str, pattern: str | None = None, special: bool = True, words: int = WORDS):
    """The encoder (decoder, without a pattern) that this worker process keeps from task to task."""
    kept = vars(sys).setdefault("_marginloom_transducers", {})
    if (key := (json_path, pattern, special, words)) not in kept:
        if json_path not in kept:
            kept[json_path] = MergeList(json_path)
        merges = kept[json_path]
        kept[key] = Encoder(merges, pattern, merges.special if special else None, words) if pattern else Decoder(merges)
    return kept[key]


def text_of(cell: pa.Scalar) -> str:
    """A binary cell as text; NULL is empty, invalid bytes become U+FFFD."""
    return cell.as_buffer().to_pybytes().decode("utf-8", "replace") if cell.is_valid else ""


def encode_documents(docs: DataFrame, json_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     special: bool = True) -> DataFrame:
    """(id, ids array<int>) of every row: the text's ids without any added ones.

    With ``special`` the strings of special tokens in a text become their ids, else they are plain text. NULL and empty
    texts have no ids. Invalid UTF-8 is read as U+FFFD. Rows stay as they are, also those repeating an id and those
    without one; other columns are not read; an empty table gives no rows. Nothing is shuffled, and a lost task is
    run again.
    """
    arrow_rows(docs.sparkSession, 500)
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_process(json_path, pattern, special)
        for batch in batches:
            begin, made, total = 0, [], 0
            for i in range(batch.num_rows):
                made.append(np.array(encoder.encode(text_of(batch.column(1)[i])), dtype=np.int32))
                total += len(made[-1])
                if total >= BATCH_IDS or i + 1 == batch.num_rows:
                    offsets = np.cumsum([0, *map(len, made)], dtype=np.int32)
                    ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(made)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(made)), ids], names=[id_col, "ids"])
                    begin, made, total = i + 1, [], 0

    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(encode, f"`{id_col}` {id_type}, ids array<int>")


def decode_documents(encoded: DataFrame, json_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows and a column with the text of their ids, special tokens included; a NULL list is the empty text.

    Ids that the vocabulary doesn't know, NULL among them, add nothing; bytes that are no UTF-8 become U+FFFD. A
    column of the name of the result is replaced.
    """
    columns = [c for c in encoded.columns if c != out]
    schema = encoded.select(columns).schema.add(out, "string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = of_process(json_path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            ids = lists.flatten().fill_null(-1).to_numpy().tolist()
            upto = np.cumsum(lists.value_lengths().fill_null(0).to_numpy()).tolist()
            texts = [decoder.decode(ids[i:j]) for i, j in zip([0, *upto], upto)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*columns, out])

    return encoded.select(columns).mapInArrow(decode, schema)
