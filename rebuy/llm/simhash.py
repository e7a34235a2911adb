"""SimHash near-duplicates with pivot distance tables.

Fingerprints are counted first, so exact copies cost one row. Distinct
fingerprints meet in groups that agree on some of the bit blocks: with ``r``
blocks free, fingerprints that differ in ``max_bits`` bits agree on all blocks
but ``max_bits``, and every choice of ``r`` equal blocks is a group. So no
link is lost. Within a group a table holds each fingerprint's Hamming distance
to many reference fingerprints. Two whose distances to any of them differ by
more than ``max_bits`` cannot be linked; only pairs that pass are verified.

A group is searched outwards from one fingerprint at a time and leaves one
link for each fingerprint it reaches (a spanning forest), so thousands of
near copies cost thousands of links, not millions of pairs. The links are
joined to components by alternating star contractions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, pieces, text_key, written

SEED = 42
#: How many reference fingerprints a distance table has.
PIVOTS = 24


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit SimHash of word shingles (A-Z lower-cased, ASCII white space);
    a bit is 1 if set in over half the shingle hashes. 0 if no words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.append(0, ends[:-1] + 1)[:n].tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    h = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends)]), np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4) -> DataFrame:
    """Struct ``row`` (columns of ``docs`` but the text), ``text_key`` and the
    signed 64-bit ``fp`` of each whole text. Null and blank texts have 0."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
                       text_key(f"`{text_col}`").alias("text_key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], rows.schema["text_key"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                fps = [fingerprint(t, shingle) for t in part.column(2).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))], schema.names)

    return rows.mapInArrow(run, schema)


def block_masks(max_bits: int, free: int) -> list[int]:
    """Masks of the bits that a group agrees on: every ``free`` of
    ``max_bits + free`` blocks, which differ in length by a bit at most."""
    blocks = max_bits + free
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(masks, free)]


def pivots() -> np.ndarray:
    """Reference fingerprints: halves of the bits, chosen by a fixed rule, so
    that their distances tell most fingerprints apart."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(PIVOTS)], np.uint64)


def group_links(fps: np.ndarray, refs: np.ndarray, max_bits: int, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join all of ``fps`` (distinct, unsigned) that are connected
    at ``max_bits`` within the group: at most one a fingerprint."""
    if len(fps) == 2:
        if int(fps[0] ^ fps[1]).bit_count() <= max_bits:
            yield fps[:1], fps[1:]
        return
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    left = np.lexsort((fps, table[:, 0]))  # not reached yet, by distance to the first reference
    step = max(1, block // len(fps))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:step], front[step:]
            near = table[left, 0]
            lo = np.searchsorted(near, table[some, 0] - max_bits)
            hi = np.searchsorted(near, table[some, 0] + max_bits, "right")
            got = np.zeros(len(left), bool)
            for f, a, b in zip(some, lo, hi):
                at = np.arange(a, b)[~got[a:b]]
                for k in range(1, len(refs)):
                    if len(at) < 32:
                        break
                    at = at[np.abs(table[left[at], k] - table[f, k]) <= max_bits]
                at = at[np.bitwise_count(fps[left[at]] ^ fps[f]) <= max_bits]
                if len(at):
                    got[at] = True
                    yield np.full(len(at), fps[f]), fps[left[at]]
            front, left = np.append(front, left[got]), left[~got]


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (``a``, ``b``) that connect the distinct ``fp`` values of ``fps``
    exactly as all pairs within ``max_bits`` bits do."""
    refs = pivots()
    n = fps.count()
    # Enough equal blocks that a group of unrelated fingerprints stays small.
    free = 1
    while 64 * free / (max_bits + free) < math.log2(max(n, 2)) + 2 and free < 2 * max_bits:
        free += 1
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(max_bits, free)]
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks]))
    # A group is a mask and the bits under it; alone in it, a fingerprint has no link.
    grouped = fps.select("fp", keys.alias("mask", "bits"))

    def run(batches):
        held: list = []
        last = None

        def solve(cols):
            mask, bits, fp = (np.concatenate(c) for c in zip(*cols))
            cut = np.flatnonzero(np.append(True, (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])))
            ends = np.append(cut[1:], len(fp))
            out = [(a, b) for s, e in zip(cut[ends - cut > 1], ends[ends - cut > 1])
                   for a, b in group_links(fp[s:e].view(np.uint64), refs, max_bits)]
            if out:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(3)]
            if not len(cols[0]):
                continue
            # Whole groups only: what the last group has so far waits.
            change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
            first = (cols[0][0], cols[1][0])
            if held and last != first:
                yield from solve(held)
                held = []
            if len(change):
                cut = change[-1] + 1
                yield from solve([*held, [c[:cut] for c in cols]])
                held, cols = [], [c[cut:] for c in cols]
            held.append(cols)
            last = (cols[0][-1], cols[1][-1])
        if held:
            yield from solve(held)

    return (grouped.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp")
            .select("mask", "bits", "fp").mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node it is connected to) of every node
    of the links (``a``, ``b``), by alternating large and small stars. Each
    round is written to the shared folder; a round that changes nothing ends
    the loop. Only one flag a round reaches the driver."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = written(small, "links")
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(edges)
        edges = new
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """``row`` (columns but the text), ``text_key``, ``fp`` and
    ``component_id`` of every row: the smallest id among the documents whose
    fingerprints are connected by links of at most ``max_bits`` bits.

    Null and blank texts share the fingerprint 0 and are linked like any
    other. Null ids are no smallest id (a component of null ids only has a
    null ``component_id``); repeated rows fall into one component. An empty
    table gives an empty result.
    """
    rows = written(fingerprints(docs, text_col, shingle), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min(f"row.{id_col}").alias("id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(low, "root").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(named, rows["fp"] == F.col("_fp")).select("row", "text_key", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row
    with the smallest id stays (null ids last; equal ids: the smallest text
    key; of rows equal in all columns one)."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    order = F.struct(F.col(f"row.{id_col}").isNull().alias("n"), F.col(f"row.{id_col}").alias("i"), F.col("text_key").alias("t"))
    # Fingerprints of a component without any id have a null component_id: they are told apart by fp.
    group = F.struct(F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")))
    stay = found.groupBy(group.alias("g")).agg(F.min(order).alias("o")).select("o")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                        F.struct(F.col(f"`{id_col}`").isNull().alias("n"), F.col(f"`{id_col}`").alias("i"),
                                 text_key(f"`{text_col}`").alias("t")).alias("_key"))
    return keyed.join(stay, F.col("_key") == F.col("o"), "left_semi").dropDuplicates(["_key"]).select("whole.*")
