"""Alignment of two tokenizers by sparse products of token-byte incidence.

Both tokenizers cut the same bytes. A token-byte incidence matrix has a row
for each token and a one for each byte it covers. Gustavson's row products
A . B' give the overlap links (how many bytes an A token and a B token share);
tokens of a group (bytes between two neighbouring offsets where both end) are
linked by the product of the token-group matrices. The matrices are plain
CSR arrays, built for many chunks of text at once.

A chunk is a word with the spaces before it. Neither tokenizer joins a space
to what stands before it, so chunks are encoded alone, each once, and no group
crosses them. Corpus-wide counts of linked ids are summed over blocks (texts
with at most 65,536 distinct chunks) and go back to the blocks by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import types
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_symbols
from .common import pieces, written

#: Distinct chunks of a block; codes are 16-bit.
BLOCK_CHUNKS = 1 << 16
#: Bytes of chunks that are encoded and multiplied together.
JOINED_BYTES = 1 << 16
#: Chunks that a worker keeps, and the bytes of their results.
KEPT_CHUNKS, KEPT_BYTES = 300_000, 64 << 20


class Csr(NamedTuple):
    """Compressed sparse rows; a row's columns ascend."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    n_cols: int


def cover(ends: np.ndarray, total: int) -> Csr:
    """Token-byte incidence: token i covers the bytes from the end of the
    token before to ``ends[i]``."""
    return Csr(np.append(0, ends), np.arange(total), np.ones(total, np.int64), total)


def member(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Token-group incidence: each token lies in the group between two cuts."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), np.ones(len(ends), np.int64), len(cuts))


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.indices, kind="stable")
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    counts = np.bincount(m.indices, minlength=m.n_cols)
    return Csr(np.append(0, np.cumsum(counts)), rows[order], m.data[order], len(m.indptr) - 1)


def product(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the entries of ``a @ b`` in row order. Row i is
    the sum of the rows of ``b`` that the entries of a's row i name."""
    sizes = np.diff(b.indptr)[a.indices]
    rows = np.repeat(np.repeat(np.arange(len(a.indptr) - 1), np.diff(a.indptr)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(b.indptr[a.indices], sizes) + within
    key, value = rows * b.n_cols + b.indices[at], np.repeat(a.data, sizes) * b.data[at]
    if (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    return key // max(b.n_cols, 1), key % max(b.n_cols, 1), np.add.reduceat(value, first) if len(first) else value


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray, total: int):
    """(A token, B token, shared bytes) of all tokens that share bytes."""
    return product(cover(ends_a, total), transposed(cover(ends_b, total)))


def group_links(ends_a: np.ndarray, ends_b: np.ndarray):
    """(A token, B token) of all tokens of the same group, and the cuts."""
    cuts = np.intersect1d(ends_a, ends_b)
    a, b, _ = product(member(ends_a, cuts), transposed(member(ends_b, cuts)))
    return a, b, cuts


def end_links(ends_a: np.ndarray, ends_b: np.ndarray, total: int):
    """(A token, B token) of the overlap links whose byte ranges end together."""
    a, b, _ = overlap_links(ends_a, ends_b, total)
    same = ends_a[a] == ends_b[b]
    return a[same], b[same]


class Vocabulary:
    """Bytes of each id, flat."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.names = np.array([str(i) for i in range(len(entries))], object)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.size[ids])

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - ends + size, size) + np.arange(size.sum())].tobytes()


def split_chunks(text: str) -> list[str]:
    """Chunks of " " + text. A space begins one if neither white space nor
    the end of the text stands beside it."""
    parts = text.split(" ")
    if "" not in parts and not any(p[-1] <= " " or p[-1] > "~" and p[-1].isspace() for p in parts):
        return [" " + p for p in parts]
    out: list[str] = []
    for i, p in enumerate(parts):
        if out and (p == "" and i == len(parts) - 1 or out[-1][-1].isspace()):
            out[-1] += " " + p
        else:
            out.append(" " + p)
    return out


class Aligner:
    """Ids, groups and end links of chunks, each worked out once."""

    def __init__(self, byte_level: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.lib_a = Tokenizer.from_str(byte_level)
        self.lib_a.encode_special_tokens = True
        self.lib_a.no_truncation()
        self.lib_a.no_padding()
        conf = json.loads(byte_level)
        names = conf["model"]["vocab"] | {t["content"]: t["id"] for t in conf["added_tokens"]}
        plain = {c: b for b, c in enumerate(byte_symbols())}
        entries = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            entries[i] = bytes(plain[c] for c in name) if all(c in plain for c in name) else name.encode()
        self.a = Vocabulary(entries)
        self.lib_b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        n = self.lib_b.get_piece_size()
        found = [self.lib_b.id_to_piece(i) for i in range(n)]
        self.b = Vocabulary([bytes([int(p[3:5], 16)]) if self.lib_b.is_byte(i) else p.replace("▁", " ").encode()
                             for i, p in enumerate(found)])
        # A piece with a space after another character would join chunks.
        self.by_chunk = not any("▁" in p.lstrip("▁") for p in found)
        self.codes: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.codes.clear()
        self.n_a, self.n_b, self.n_groups = ([] for _ in range(3))
        self.groups: list[bytes] = []
        self.pairs: list[bytes | None] = []  # None: B's bytes differ
        self.bytes = 0

    def full(self) -> bool:
        return len(self.pairs) > KEPT_CHUNKS or self.bytes > KEPT_BYTES

    def ids_a(self, text: str) -> np.ndarray:
        return np.array(self.lib_a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def ids_b(self, text: str) -> np.ndarray:
        return np.array(self.lib_b.encode(text, num_threads=1) if text else self.lib_b.encode(" x")[:1], np.int64)

    def keep(self, chunk: str, n_a: int, n_b: int, n_groups: int, groups: bytes, pairs: bytes | None) -> None:
        self.codes[chunk] = len(self.pairs)
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.n_groups.append(n_groups)
        self.groups.append(groups)
        self.pairs.append(pairs)
        self.bytes += len(groups) + len(pairs or b"")

    def learn(self, chunks: list[str]) -> None:
        """Work out new chunks, many bytes at a time. White space at the end
        of a chunk (the last of its text) would join the next chunk's space."""
        part, size = [], 0
        for c in chunks:
            if c[-1].isspace():
                self.learn_joined([c])
                continue
            part.append(c)
            size += len(c)
            if size >= JOINED_BYTES:
                self.learn_joined(part)
                part, size = [], 0
        if part:
            self.learn_joined(part)

    def learn_joined(self, chunks: list[str]) -> None:
        text = "".join(chunks)
        raw = text.encode()
        ids_a, ids_b = self.ids_a(text), self.ids_b(text[1:])
        if self.a.joined(ids_a) != raw or self.b.joined(ids_b) != raw:
            if len(chunks) == 1:
                return self.keep(chunks[0], 0, 0, 0, b"", None)
            for half in (chunks[:len(chunks) // 2], chunks[len(chunks) // 2:]):
                self.learn_joined(half)
            return None
        ends_a, ends_b = self.a.ends(ids_a), self.b.ends(ids_b)
        a, b = end_links(ends_a, ends_b, len(raw))
        cuts = ends_a[a]  # each cut is the end of one link
        stops = np.cumsum([len(c.encode()) for c in chunks]) if len(raw) != len(text) else np.cumsum([len(c) for c in chunks])
        of_a, of_b, of_cut = (np.searchsorted(x, stops, "right") for x in (ends_a, ends_b, cuts))
        pairs = (ids_a[a] << 32 | ids_b[b]).astype("<i8").tobytes()
        # Tokens of each group, A before B, each with the mark that follows it.
        g_a, g_b = member(ends_a, cuts).indices, member(ends_b, cuts).indices
        order = np.argsort(np.concatenate([2 * g_a, 2 * g_b + 1]), kind="stable")
        marks = np.full(len(order), ",", object)
        marks[a] = "|"
        marks[len(ends_a) + b] = ";"
        shown = (np.concatenate([self.a.names[ids_a], self.b.names[ids_b]]) + marks)[order].tolist()
        before = (0, 0, 0)
        for c, x, y, z in zip(chunks, of_a.tolist(), of_b.tolist(), of_cut.tolist()):
            i, j, k = before
            self.keep(c, x - i, y - j, z - k, "".join(shown[i + j:x + y])[:-1].encode(), pairs[8 * k:8 * z])
            before = x, y, z
        return None


def kept_aligner(byte_level: str, piece_model: bytes) -> Aligner:
    """The worker's aligner: what one task has learned serves later tasks."""
    kept = sys.modules.setdefault("rebuy_worker_aligners", types.ModuleType("rebuy_worker_aligners")).__dict__
    key = hashlib.md5(byte_level.encode() + piece_model).hexdigest()
    if key not in kept:
        kept.clear()
        kept[key] = Aligner(byte_level, piece_model)
    return kept[key]


class Block:
    """Texts and the distinct chunks that they consist of."""

    def __init__(self):
        self.texts: list[tuple] = []
        self.code = np.zeros(0, np.int64)  # by place in the cache; -1: not in the block
        self.chunks: list[np.ndarray] = []
        self.size = 0

    def add(self, seq: int, places: np.ndarray, n_kept: int) -> bool:
        """False if the block has no room for these chunks."""
        if len(self.code) < n_kept:
            self.code = np.append(self.code, np.full(2 * n_kept - len(self.code), -1))
        new = np.unique(places[self.code[places] < 0])
        if self.size + len(new) > BLOCK_CHUNKS:
            return False
        self.code[new] = np.arange(self.size, self.size + len(new))
        self.chunks.append(new)
        self.size += len(new)
        self.texts.append((seq, self.code[places].astype("<u2").tobytes()))
        return True


_PARTS = T.StructType([T.StructField(n, t) for n, t in (
    ("kind", T.StringType()), ("block", T.LongType()), ("seq", T.LongType()), ("codes", T.BinaryType()), ("links", T.BinaryType()),
    ("pair", T.LongType()), ("place", T.IntegerType()), ("n", T.LongType()))])
_TEXT = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()), ("groups_sha256", T.StringType())]


def _block_rows(block: Block, name: int, aligner: Aligner) -> dict[str, list]:
    """Rows of a finished block: its texts' chunk codes; for each 4096 chunks
    the places of their links' pairs; each distinct pair and how often it is linked."""
    chunks = np.concatenate(block.chunks)
    linked = [aligner.pairs[i] for i in chunks.tolist()]
    sizes = np.array([len(x) // 8 for x in linked], np.int64)
    flat = np.frombuffer(b"".join(linked), "<i8")
    times = np.bincount(np.frombuffer(b"".join(c for _, c in block.texts), "<u2"), minlength=len(chunks))
    pairs, place = np.unique(flat, return_inverse=True)
    n = np.bincount(place, weights=np.repeat(times, sizes), minlength=len(pairs)).astype(np.int64)
    place, ends = place.astype("<i4"), np.cumsum(sizes)
    rows = [("text", seq, codes, None) for seq, codes in block.texts]
    for at in range(0, len(chunks), 4096):
        s = sizes[at:at + 4096]
        rows.append(("chunks", at, s.astype("<i4").tobytes(), place[ends[at] - s[0]:ends[at] - s[0] + s.sum()].tobytes()))
    k, m = len(rows), len(pairs)
    none = [None] * max(k, m)
    return {"kind": [r[0] for r in rows] + ["pair"] * m, "block": [name] * (k + m), "seq": [r[1] for r in rows] + none[:m],
            "codes": [r[2] for r in rows] + none[:m], "links": [r[3] for r in rows] + none[:m],
            "pair": none[:k] + pairs.tolist(), "place": none[:k] + list(range(m)), "n": none[:k] + n.tolist()}


def align(docs: DataFrame, byte_level_path: str, piece_path: str, text_col: str = "text") -> DataFrame:
    """Struct ``row`` (columns of ``docs`` but the text), ``n_a``, ``n_b``
    (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256`` of every whole text.

    A link joins an A and a B token whose bytes end together; the count of an
    id pair is the number of its links in all texts, ``n_best`` the links whose
    count is their B id's highest (ties included), ``count_sum`` the sum of
    the links' counts. Null and empty texts, and texts that B's pieces do not
    spell out, have no tokens: zeros and an empty string. Rows that repeat
    count as often as they occur; an empty table gives an empty result.
    Columns of any name may stand beside the text.
    """
    with open(byte_level_path, encoding="utf-8") as f:
        byte_level = f.read()
    with open(piece_path, "rb") as f:
        piece_model = f.read()
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([*_PARTS, T.StructField("row", rows.schema["row"].dataType), *[T.StructField(n, t) for n, t in _TEXT]])
    arrow = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("codes", pa.binary()), ("links", pa.binary()),
                       ("pair", pa.int64()), ("place", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        aligner, task = kept_aligner(byte_level, piece_model), TaskContext.get().partitionId() << 40
        seq, name, block, row_type = task, task, Block(), None

        def finished() -> Iterator[pa.RecordBatch]:
            found = _block_rows(block, name, aligner)
            for at in range(0, len(found["kind"]), 4096):
                part = [pa.array(v[at:at + 4096], arrow.field(c).type) for c, v in found.items()]
                size = len(part[0])
                part += [pa.nulls(size, row_type), *[pa.nulls(size, pa.string() if n == "groups_sha256" else pa.int64()) for n, _ in _TEXT]]
                yield pa.RecordBatch.from_arrays(part, schema.names)

        for batch in batches:
            row_type = batch.column(0).type
            for part in pieces(batch, "text"):
                lists = []
                for text in part.column(1).to_pylist():
                    lists.append(([] if not text else split_chunks(text) if aligner.by_chunk else [" " + text]))
                new = [c for c in dict.fromkeys(chain.from_iterable(lists)) if c not in aligner.codes]
                aligner.learn(new)
                shown: list[tuple] = []
                for chunks in lists:
                    places = np.fromiter(map(aligner.codes.__getitem__, chunks), np.int64, len(chunks))
                    at = places.tolist()
                    if not at or any(aligner.pairs[i] is None for i in at):
                        shown.append((seq, 0, 0, 0, 0, ""))
                    else:
                        digest = hashlib.sha256()
                        for i in range(0, len(at), 8192):
                            digest.update((b";" if i else b"") + b";".join([aligner.groups[j] for j in at[i:i + 8192]]))
                        n = sum([aligner.n_groups[j] for j in at])  # as many links: one ends each group
                        shown.append((seq, sum([aligner.n_a[j] for j in at]), sum([aligner.n_b[j] for j in at]), n, n, digest.hexdigest()))
                        for i in range(0, len(at), BLOCK_CHUNKS // 2):
                            if not block.add(seq, places[i:i + BLOCK_CHUNKS // 2], len(aligner.pairs)):
                                yield from finished()
                                name, block = name + 1, Block()
                                block.add(seq, places[i:i + BLOCK_CHUNKS // 2], len(aligner.pairs))
                    seq += 1
                size = len(shown)
                cols = [pa.array(["row"] * size), pa.nulls(size, pa.int64()), pa.array([s[0] for s in shown], pa.int64()),
                        pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int32()),
                        pa.nulls(size, pa.int64()), part.column(0)]
                cols += [pa.array([s[k + 1] for s in shown], pa.string() if k == 4 else pa.int64()) for k in range(5)]
                yield pa.RecordBatch.from_arrays(cols, schema.names)
                if aligner.full():
                    if block.texts:
                        yield from finished()
                    name, block = name + 1, Block()
                    aligner.clear()
        if block.texts:
            yield from finished()

    # A text whose chunks differ from its bytes only together cannot occur:
    # chunks end where both tokenizers' pieces end.
    parts = written(rows.mapInArrow(run, schema), "alignment", compression="zstd")
    texts = parts.where("kind = 'row'").select("row", "seq", *[n for n, _ in _TEXT])
    linked = parts.where("kind = 'pair'").select(F.col("block").alias("in_block"), "pair", "place", "n")
    scores = _scored_pairs(linked)
    sums = _summed(parts.where("kind in ('text', 'chunks')").select("block", "kind", "seq", "codes", "links"), scores)
    sums = sums.groupBy(F.col("seq").alias("_seq")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return texts.join(sums, texts["seq"] == sums["_seq"], "left").select(
        "row", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def pair_counts(linked: DataFrame) -> DataFrame:
    """Corpus-wide count of each id pair and whether it is its B id's highest."""
    counts = linked.groupBy("pair").agg(F.sum("n").alias("count"))
    best = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    return counts.select("pair", "count", (F.col("count") == best).alias("best"))


def _scored_pairs(linked: DataFrame) -> DataFrame:
    counts = pair_counts(linked).withColumnRenamed("pair", "_pair")
    return linked.join(counts, linked["pair"] == counts["_pair"]).select("in_block", "place", "count", "best")


def _summed(parts: DataFrame, scores: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` of each block's texts: counts of pairs to
    sums of chunks to sums of texts."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place) + 1, np.int64), np.zeros(len(place) + 1, np.int64)
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        chunk = np.array(left.column("kind").to_pylist()) == "chunks"
        rows = left.column("seq").to_numpy(), left.column("codes").to_pylist(), left.column("links").to_pylist()
        at = [i for i in np.argsort(rows[0], kind="stable") if chunk[i]]
        sizes = np.concatenate([np.frombuffer(rows[1][i], "<i4") for i in at])
        links = np.concatenate([np.frombuffer(rows[2][i], "<i4") for i in at])
        ends = np.cumsum(sizes)
        total = [np.diff(np.append(0, np.append(0, np.cumsum(x[links]))[ends])) for x in (best, count)]
        seq, found = [], ([], [])
        for i in np.flatnonzero(~chunk):
            codes = np.frombuffer(rows[1][i], "<u2")
            seq.append(int(rows[0][i]))
            for x, out in zip(total, found):
                out.append(int(x[codes].sum()))
        return pa.table({"seq": pa.array(seq, pa.int64()), "n_best": pa.array(found[0], pa.int64()), "count_sum": pa.array(found[1], pa.int64())})

    return parts.groupBy("block").cogroup(scores.groupBy("in_block")).applyInArrow(run, "seq long, n_best long, count_sum long")
