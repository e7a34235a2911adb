"""Token ids as Parquet list columns.

Each row has a document's ids as a list column and, beside it, small metadata
columns: id, number of ids, place of the first id within its file. Rows are
written in ascending id order (range partitions, one file each), so readers
find a document by the page index of the id column, and a read of the metadata
does not touch the ids. Row groups have a fixed size; ids are dictionary
encoded, or delta encoded with ``encoding="delta"``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_symbols
from .common import pieces, shared

#: White space of the split pattern; Python splits at four more characters.
_ODD = re.compile(b"[\x1c-\x1f]")
#: Marks that may follow a word; an apostrophe can begin a piece with letters.
_TAIL = ".,;:!?)\"-"
_TAIL_BYTES = _TAIL.encode()
#: Latin-1 letters in UTF-8, and the symbols of their bytes.
_LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_SYMBOLS = {b: s for b, s in enumerate(byte_symbols()) if b != 0x20}


class CachedEncoder:
    """Encodes with the tokenizers library, each white-space-free chunk of
    text once. Right for tokenizers that drop white space before they split
    and whose added tokens hold none; others encode whole texts. New chunks
    go through the library many at a time. Words, and words with a mark after
    them, have one or two pieces: where pieces end in tokens of a known form,
    the result is cut there, if the number of ends is right. Other chunks are
    cut at the id of a special token put between them."""

    def __init__(self, spec: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.cache = Cache()
        self.lib, self.limit = Tokenizer.from_str(spec), limit
        added = json.loads(spec)["added_tokens"]
        self.added = [t["content"].encode() for t in added]
        model = json.loads(spec)["model"]
        suffix = model.get("end_of_word_suffix")
        self.ends = self.plain = None
        if suffix:
            self.plain = self.words_only(spec)
            self.ends = np.zeros(max(model["vocab"].values()) + len(added) + 1, bool)
            self.ends[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        self.mark, self.mark_id = next(((t["content"], t["id"]) for t in added if t["special"]), (None, None))
        a, b = "one", "twö"
        self.by_chunk = all(self.ids(a + s + b) == self.ids(a) + self.ids(b) for s in (" ", "\n", "　", " \t "))

    def ids(self, text: str) -> list[int]:
        return self.lib.encode(text, add_special_tokens=False).ids

    def many(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def words_only(self, spec: str):
        """The library's tokenizer without its normalizer and pre-tokenizer,
        for words of Latin-1 letters (composed, so no normal form changes them)
        given in lower case, as byte symbols and between spaces; None unless
        both would do just that to such words, and to marks after them."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        lib = Tokenizer.from_str(spec)
        letters = "".join(c for c in map(chr, [*range(97, 123), *range(0xDF, 0x100)]) if c.isalpha())
        shown = lambda t: t.encode().decode("latin-1").translate(_SYMBOLS)
        upper = "".join(c.upper() if ord(c.upper()[0]) < 0x100 and len(c.upper()) == 1 else c for c in letters)
        for text, pieces_ in [(letters, [letters])] + [(letters + m, [letters, m]) for m in (*_TAIL, _TAIL)]:
            lower = lib.normalizer.normalize_str(upper + text[len(letters):]) if lib.normalizer else upper
            if lower != text or not lib.pre_tokenizer or [p for p, _ in lib.pre_tokenizer.pre_tokenize_str(text)] != [*map(shown, pieces_)]:
                return None
        lib.normalizer, lib.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        return lib

    def learn_words(self, chunks: list[bytes]) -> list[bytes]:
        """Put the ids of words into the cache, return the other chunks."""
        others = []
        if self.plain is not None:
            ones, twos = [], []
            for c in chunks:
                word = c.rstrip(_TAIL_BYTES)
                if word.isalpha() or _LATIN.fullmatch(word):
                    (ones if len(word) == len(c) else twos).append(c)
                else:
                    others.append(c)
            for n, group in (1, ones), (2, twos):
                for at in range(0, len(group), 512):
                    part = group[at:at + 512]
                    cut = [len(c.rstrip(_TAIL_BYTES)) for c in part] if n == 2 else ()
                    raw = b" ".join(part if n == 1 else [c[:i] + b" " + c[i:] for c, i in zip(part, cut)])
                    text = raw.decode().lower().encode().decode("latin-1").translate(_SYMBOLS)
                    ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                    others += self.keep_ends(part, ids, n)
            chunks, others = others, []
            if not chunks:
                return []
        whole = b" ".join(chunks)
        if any(a in whole for a in self.added):
            others = [c for c in chunks if any(a in c for a in self.added)]
            chunks = [c for c in chunks if not any(a in c for a in self.added)]
        ones, twos = [], []
        for c in chunks:
            text = c.decode()
            (ones if text.isalpha() else twos if text.rstrip(_TAIL).isalpha() else others).append(c)
        for n, group in (1, ones), (2, twos):  # a chunk has n pieces or more
            for at in range(0, len(group), 256):
                part = group[at:at + 256]
                others += self.keep_ends(part, self.many(b" ".join(part).decode()), n)
        return others

    def keep_ends(self, part: list[bytes], ids: np.ndarray, n: int) -> list[bytes]:
        """Cut ``ids`` after every ``n`` ends of pieces into those of ``part``;
        if the number of ends is another, return ``part``."""
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != n * len(part):
            return part
        stops = stops[n - 1::n]
        self.cache.keep(part, ids, np.append(0, stops[:-1]), stops)
        return []

    def learn(self, chunks: list[bytes]) -> None:
        """Put the ids of chunks into the cache."""
        alone = [c for c in chunks if self.mark is None or any(a in c for a in self.added)]
        for c in alone:
            ids = np.array(self.ids(c.decode()), "<u4")
            self.cache.keep([c], ids, np.zeros(1, np.int64), np.array([len(ids)]))
        if alone:
            chunks = [c for c in chunks if c not in set(alone)]
        if not chunks:
            return
        joined = f" {self.mark} ".join([c.decode() for c in chunks])
        ids = self.many(joined)
        cut = np.flatnonzero(ids == self.mark_id)
        self.cache.keep(chunks, ids, np.append(0, cut + 1), np.append(cut, len(ids)))

    def encode_flat(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8) one after another, and their numbers."""
        self.cache.shrink(self.limit)
        if not self.by_chunk or any(_ODD.search(t or b"") for t in texts):
            each = [np.array(self.ids((t or b"").decode()), "<u4") for t in texts]
            return np.concatenate([np.zeros(0, "<u4"), *each]), np.array([len(x) for x in each], np.int64)
        lists = [(t or b"").split() for t in texts]
        words = list(chain.from_iterable(lists))
        known = self.cache.places
        places = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = [words[i] for i in np.flatnonzero(places < 0).tolist()]
        if missing:
            new = list(dict.fromkeys(missing))
            if self.ends is not None:
                new = self.learn_words(new)
            for at in range(0, len(new), 64):
                self.learn(new[at:at + 64])
            places[places < 0] = np.fromiter(map(known.__getitem__, missing), np.int64, len(missing))
        flat, ends = self.cache.ids_of(places)
        n = np.cumsum([len(x) for x in lists])
        return flat, np.diff(np.append(0, np.append(0, ends)[n]))

    def encode_batch(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian 32-bit integers."""
        flat, sizes = self.encode_flat(texts)
        ends, raw = np.cumsum(sizes) * 4, flat.tobytes()
        return [raw[b - 4 * n:b] for b, n in zip(ends.tolist(), sizes.tolist())]


def kept_encoder(spec: str) -> CachedEncoder:
    """The worker's encoder: what one task has learned serves later tasks."""
    kept = sys.modules.setdefault("rebuy_worker_encoders", types.ModuleType("rebuy_worker_encoders")).__dict__
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in kept:
        for other in [k for k, v in kept.items() if hasattr(v, "encode_flat")]:
            del kept[other]
        kept[key] = CachedEncoder(spec)
    return kept[key]


class Cache:
    """Ids of chunks in one flat array; chunks are numbered as they come."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.size, self.start, self.flat, self.used = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(4096, "<u4"), 0

    def keep(self, chunks: list[bytes], ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        """Chunk i has ``ids[starts[i]:stops[i]]``."""
        n, m, total = len(self.places), len(chunks), int((stops - starts).sum())
        if n + m > len(self.size):
            self.size, self.start = (np.append(x, np.zeros(len(x) + m, x.dtype)) for x in (self.size, self.start))
        if self.used + total > len(self.flat):
            self.flat = np.append(self.flat, np.zeros(len(self.flat) + total, "<u4"))
        size = stops - starts
        ends = np.cumsum(size)
        self.flat[self.used:self.used + total] = ids[np.repeat(starts - ends + size, size) + np.arange(total)]
        self.size[n:n + m], self.start[n:n + m] = size, self.used + ends - size
        self.used += total
        self.places.update(zip(chunks, range(n, n + m)))

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and where each chunk's end."""
        size = self.size[places].astype(np.int64)
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[places] - ends + size, size) + np.arange(size.sum())], ends

    def shrink(self, limit: int) -> None:
        """Over ``limit`` chunks, the first half stays: frequent chunks come first."""
        if len(self.places) > limit:
            half = limit // 2
            self.places = dict(islice(self.places.items(), half))
            self.used = int(self.start[half - 1] + self.size[half - 1]) if half else 0


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", encoding: str = "dictionary", group_bytes: int = 16 << 20,
                 page_bytes: int = 256 << 10) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, to
    ``path`` in ascending order of ``id_col`` (nulls first, equal ids by text).

    Null and blank texts have the end id only. An empty table writes files
    without rows.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # Dealt by id before the ids exist: only the documents' text is moved, and
    # the sample that finds the ranges encodes nothing.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, F.col("id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")
    schema = T.StructType([rows.schema["id"], T.StructField("place", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("tokens", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, place = kept_encoder(spec), 0
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, sizes = coder.encode_flat(part.column(1).cast(pa.binary()).to_pylist())
                sizes = sizes + 1
                ends = np.cumsum(sizes)
                flat = np.insert(ids, ends - np.arange(1, len(sizes) + 1), end_id).view("<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(place + ends - sizes), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))], schema.names)
                place += int(ends[-1]) if len(ends) else 0

    delta = {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"}
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.block.size": str(group_bytes), "parquet.page.size": str(page_bytes),
               "parquet.page.row.count.limit": "1000"} | (delta if encoding == "delta" else {"parquet.enable.dictionary": "true"})
    rows.mapInArrow(run, schema).write.options(**options).parquet(path)


def read_metadata(spark, path: str) -> DataFrame:
    """``id``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``file`` and ``row`` (within the file), without reading any token page."""
    rows = spark.read.parquet(path).select("id", "place", "n_tokens", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    # One row a file: files are numbered in id order by their names.
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select(F.col("file").alias("_file"), base.alias("base"))
    return rows.join(files, rows["file"] == F.col("_file")).select(
        "id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "file", "row")


def read_tokens(spark, path: str, ids: DataFrame | None = None, listed: int = 200) -> DataFrame:
    """``id``, ``place``, ``tokens`` and ``file``; with ``ids`` (one column
    ``id``; nulls and repeats take no part) only of those documents.

    One aggregate finds the bounds of ``ids``, and the ids themselves if there
    are at most ``listed``. The scan gets them as a filter: files are ordered
    by id, so it skips the row groups and, by the page index, the token pages
    that hold none. ``ids`` without a row gives no rows.
    """
    rows = spark.read.parquet(path).select("id", "place", "tokens", F.col("_metadata.file_name").alias("file"))
    if ids is None:
        return rows
    ids = ids.select("id").where("id is not null")
    few = [r["id"] for r in ids.distinct().limit(listed + 1).collect()]
    if len(few) <= listed:
        return rows.where(F.col("id").isin(few) if few else F.lit(False))
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    return rows.where(F.col("id").between(low, high)).join(ids, "id", "left_semi")


def digests(spark, path: str) -> DataFrame:
    """Per document, from the files: ``id``, ``start``, ``n_tokens`` and
    ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""
    rows = read_tokens(spark, path)
    schema = T.StructType([rows.schema["id"], T.StructField("place", T.LongType()), T.StructField("file", T.StringType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        for batch in batches:
            tokens = batch.column(2)
            at = tokens.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], schema.names)

    found = rows.mapInArrow(run, schema)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("_file")).agg(F.sum("n_tokens").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("_file", base.alias("base"))
    return found.join(files, found["file"] == F.col("_file")).select(
        "id", (F.col("base") + F.col("place")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def new_store(spark) -> str:
    """A fresh path for a store in the shared folder."""
    return shared(spark, "token-store")
