"""SimHash near-duplicates by anchor-point covering.

The 64-bit fingerprint is read as two blocks of 31 bits (two bits stay outside). Fingerprints at most
``2 * SLACK + 1`` bits apart differ in at most ``SLACK`` bits of one block. The anchors of a block are the
words of the perfect Hamming code of length 31: every block lies within ``RADIUS`` of exactly one anchor,
its home. A fingerprint is replicated to every anchor within ``RADIUS + SLACK``; whatever differs from it
in at most ``SLACK`` bits of the block has its home among them. So comparing, at each anchor, those at
home with all replicas finds every link, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from marginloom.llm.common import XX_SEED, arrow_rows, cut

BLOCK_BITS, RADIUS, SLACK = 31, 1, 1
#: Replicas at one anchor above which its comparison is dealt to several tasks, in tiles of this many.
TILE_ROWS = 100_000
#: Pairs compared in one numpy block.
BLOCK_PAIRS = 1 << 21


def text_fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash over word shingles; a bit is set where over half of the hashes have it; no word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII white space and A-Z only
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, XX_SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([text_fingerprint(t) for t in texts], dtype="<u8").view("<i8"))


def _syndrome(word: Column) -> Column:
    """Exclusive or of the positions (from 1) of the set bits: zero for an anchor, else the bit that leads to one."""
    out = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, BLOCK_BITS + 1) if p >> k & 1)
        out = out.bitwiseOR(F.shiftleft(F.bit_count(word.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1)), k))
    return out


def _replicas(fingerprints: DataFrame) -> DataFrame:
    """(anchor, fp, home) for all anchors within reach of either block.

    Flipping two positions whose exclusive or is the syndrome leads to the anchors two bits away.
    """
    word = [F.shiftrightunsigned("fp", 32 * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for i in range(2)]
    blocks = F.array(*[F.struct(w.alias("w"), F.lit(i << BLOCK_BITS).cast("long").alias("tag")) for i, w in enumerate(word)])
    flat = (fingerprints.select("fp", F.explode(blocks).alias("b")).select("fp", "b.w", "b.tag")
            .withColumn("s", _syndrome(F.col("w"))))
    pairs = F.expr(f"""transform(filter(sequence(1, {BLOCK_BITS}), i -> i < (i ^ s)),
        i -> struct((w ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1)) | tag AS anchor, false AS home))""")
    own = F.expr("struct((CASE WHEN s = 0 THEN w ELSE w ^ shiftleft(1L, s - 1) END) | tag AS anchor, true AS home)")
    anchors = F.when(F.col("s") == 0, F.array(own)).otherwise(F.concat(F.array(own), pairs))
    return flat.select("fp", F.explode(anchors).alias("a")).select("a.anchor", "fp", "a.home")


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites the sets of a[i] and b[i]; afterwards a label is the smallest member of its set."""
    while True:
        low = np.minimum(labels[a], labels[b])
        if (labels[a] == low).all() and (labels[b] == low).all():
            return
        np.minimum.at(labels, labels[a], low)
        np.minimum.at(labels, labels[b], low)
        while not (labels[labels] == labels).all():
            np.copyto(labels, labels[labels])


def _linked(key: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of complete, sorted groups: at most one per replica, with the same components as all pairs."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    group = np.repeat(np.arange(len(starts)), sizes)
    rows = np.flatnonzero(home & (sizes[group] > 1))
    if not len(rows):
        return fp[:0], fp[:0]
    labels = np.arange(len(key))
    first, count = starts[group[rows]], sizes[group[rows]]
    at = 0
    while at < len(rows):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), BLOCK_PAIRS, side="right")) + at)
        n, f, r = count[at:upto], first[at:upto], rows[at:upto]
        for low in range(0, int(n.max()) if len(r) == 1 else 1, BLOCK_PAIRS):  # one home with very many replicas
            m = np.minimum(n - low, BLOCK_PAIRS) if len(r) == 1 else n
            a = np.repeat(r, m)
            b = np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(f + low, m)
            near = np.bitwise_count(fp[a] ^ fp[b]) <= bits
            near &= a != b
            if near.any():
                _merge(labels, a[near], b[near])
        at = upto
    joined = np.flatnonzero(labels != np.arange(len(key)))
    return fp[joined], fp[labels[joined]]


def _compare(bits: int):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts):
            key, fp, home = (np.concatenate(x) for x in zip(*parts))
            a, b = _linked(key, fp.view("<u8"), home, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), pa.array(b.view("<i8"))], schema=out)

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            last = int(np.searchsorted(part[0], part[0][-1]))
            if last or (held and held[-1][0][-1] != part[0][0]):  # all groups but the last one are complete
                yield found([*held, tuple(x[:last] for x in part)])
                held = []
            held.append(tuple(x[last:] for x in part))
        if held:
            yield found(held)

    return compare


def _tiled(replicas: DataFrame) -> DataFrame:
    """(key, fp, home): homes of a crowded anchor are dealt to tiles, each of which gets all its replicas."""
    crowded = (replicas.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > TILE_ROWS)
               .select("anchor", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("tiles")))
    crowded = cut(crowded)
    if crowded.isEmpty():
        return replicas.select(F.col("anchor").alias("key"), "fp", "home")
    dealt = replicas.join(crowded, "anchor", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), "tiles").cast("int")
    return (dealt.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
            .select(F.xxhash64("anchor", "tile").alias("key"), "fp", (F.col("home") & (F.col("own") == F.col("tile"))).alias("home")))


def near_links(fingerprints: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct fingerprints at most ``bits`` apart."""
    if bits > 2 * SLACK + 1:
        raise ValueError(f"the anchors cover at most {2 * SLACK + 1} bits")
    arrow_rows(fingerprints.sparkSession, 50_000)
    sorted_rows = _tiled(_replicas(fingerprints)).repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(_compare(bits), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links: hook to the smallest neighbour, jump, contract, repeat.

    Each turn merges every node that has a smaller neighbour, at least half of a component's nodes, so
    the turns are logarithmic; the rounds of jumping are logarithmic in the length of a chain of hooks.
    A hub's neighbours are reduced to one minimum before they move.
    """
    edges = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .where(F.col("a") < F.col("b")).distinct())
    roots = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("root")))
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = cut(hooks.join(up, "root").select("node", F.col("top").alias("root"), (F.col("root") != F.col("top")).alias("moved")))
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        end = lambda c: hooks.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        edges = cut(edges.join(end("a"), "a").join(end("b"), "b")
                    .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
                    .where(F.col("a") < F.col("b")).distinct())
        if roots is None:
            roots = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = cut(roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) for every row.

    ``component_id`` is the smallest id reachable over links of fingerprints at most ``bits`` apart, the
    row itself included. Texts are lower-cased (A-Z) and cut into 3-word shingles, repeats included; a
    shorter text is one shingle; NULL, empty and blank texts have fingerprint zero and link like any other.
    Rows repeating an id or a text are kept, one for one. A NULL id names no component: such a row gets
    the smallest other id of its component, or NULL. Only ids and fingerprints are shuffled.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    rows = cut(docs.select(F.col(id_col).alias("id"), _fingerprints(F.col(text_col)).alias("fp")))
    distinct = rows.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(near_links(distinct.select("fp"), bits))
    arrow_rows(spark)
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of = linked.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3) -> DataFrame:
    """One row of each component of ``near_duplicate_groups``: the smallest id's, NULL last, then the smallest hash of the row.

    Every component keeps exactly one row, also where ids repeat, within a component or across components, or are
    missing. NULL, empty and blank texts have fingerprint zero and are alike. Rows and columns stay as they are; an
    empty table gives no rows. Only ids, hashes and fingerprints are shuffled, and the rows once where they are chosen.
    """
    arrow_rows(docs.sparkSession)
    row_hash = F.xxhash64(F.struct("*")).alias("hash")
    rows = cut(docs.select(F.col(id_col).alias("id"), row_hash, _fingerprints(F.col(text_col)).alias("fp")))
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    first = cut(rows.groupBy("fp").agg(F.min(rank).alias("first")))
    roots = components(near_links(first.select("fp"), bits))
    arrow_rows(docs.sparkSession)
    chosen = (first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
              .agg(F.min("first").alias("first")).select(F.col("first.id").alias("keep_id"), F.col("first.hash").alias("keep_hash")).distinct())
    whole = docs.select(F.col(id_col).alias("id"), row_hash, F.struct("*").alias("row"))
    mine = whole.join(chosen, (F.col("hash") == F.col("keep_hash")) & F.col("id").eqNullSafe(F.col("keep_id")))
    order = Window.partitionBy("hash", "id").orderBy("hash")  # equal rows: any of them
    return mine.select("id", "hash", "row").withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*")
