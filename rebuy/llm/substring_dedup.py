"""Repeated word windows by super-k-mer partitioning.

A window is ``width`` consecutive words. Its minimiser is the word gram of
``GRAM`` words with the smallest hash in it. Consecutive windows whose
minimiser is the same gram form a super-k-mer, which travels as one packed
string to the bucket of its minimiser; equal windows have equal minimisers, so
all copies of a window meet in one bucket, where sorting counts windows.

Three things keep this within bounds:

* A minimiser that occurs once in the corpus has no repeated window, so its
  super-k-mer never travels. Minimisers are counted first (numbers, no text).
* Words are numbered exactly within a bucket; windows are sorted by a hash of
  those numbers, and equal neighbours are compared word by word.
* The super-k-mers of a minimiser with over ``hot`` occurrences are dealt on by
  window, so no bucket holds more than ``hot`` strings: a window goes to the
  bucket of its 128-bit digest, once a task (map-side first), and takes its
  words along. A bucket whose smallest and largest words are the same holds one
  window; one in which they differ is counted again by digest and words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, pieces, text_key, written

#: Words of the grams that minimisers are chosen from.
GRAM = 6
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    """Fixed odd multipliers."""
    with np.errstate(over="ignore"):
        return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE = _odd(64, 1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """Words of a batch of texts: ``hash`` of each and ``first`` word of each
    text (``first[i + 1]`` ends text ``i``)."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        flat = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        space = _SPACE[flat]
        before = np.append(True, space[:-1])
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        self.first = np.searchsorted(self.start, np.append(0, np.cumsum(sizes)))
        # Multilinear hash of each word: sum of byte x multiplier of its place.
        at = np.flatnonzero(~space)
        lengths = self.end - self.start
        place = np.arange(len(at)) - np.repeat(np.append(0, np.cumsum(lengths)[:-1]), lengths) if len(at) else at
        byte = (flat[at].astype(np.uint64) + np.uint64(1)) * _BYTE[place & 63]
        if len(lengths) and lengths.max() > 64:
            byte = np.where(place > 63, _mix(byte + place.astype(np.uint64)), byte)
        heads = np.append(0, np.cumsum(lengths)[:-1]) if len(at) else at
        self.hash = _mix(np.add.reduceat(byte, heads)) if len(at) else np.zeros(0, np.uint64)


def gram_hash(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each run of ``n`` words (of word hashes)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    by, out = _odd(n, seed), np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out += words[k:len(out) + k] * by[k]
    return _mix(out)


def super_kmers(words: Words, width: int) -> tuple[np.ndarray, ...]:
    """Text number, first window (word of the text), windows and minimiser of
    each super-k-mer."""
    n = len(words.hash)
    empty = np.zeros(0, np.int64)
    if n < width:
        return empty, empty, empty, empty
    gram = min(GRAM, width)
    grams = gram_hash(words.hash, gram, 7)
    # Smallest by the upper 32 bits, then leftmost.
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, have = width - gram + 1, 1
    while have * 2 <= span:
        key, have = np.minimum(key[:-have], key[have:]), have * 2
    if have < span:
        key = np.minimum(key[:len(key) - (span - have)], key[span - have:])
    where = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)  # a window's minimiser
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    window = np.flatnonzero(text[:n - width + 1] == text[width - 1:])
    if not len(window):
        return empty, empty, empty, empty
    new = np.append(True, (where[window][1:] != where[window][:-1]) | (np.diff(window) != 1))
    heads = np.flatnonzero(new)
    first = window[heads]
    return (text[first], first - words.first[text[first]], np.diff(np.append(heads, len(window))),
            grams[where[first]].view(np.int64))


def repeated(ids: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of the windows at ``starts`` in ``ids`` (exact word numbers) occur
    twice or more: sorted by hash, then compared word by word."""
    h = gram_hash(_mix(ids.astype(np.uint64)), width, 11)[starts]
    out = np.zeros(len(starts), bool)
    hs = np.sort(h)
    twice = hs[1:][hs[1:] == hs[:-1]]
    if not len(twice):
        return out
    twice = twice[np.append(True, twice[1:] != twice[:-1])]
    some = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h)
    order = some[np.argsort(h[some], kind="stable")]
    hs, at = h[order], starts[order]
    same = np.flatnonzero(hs[1:] == hs[:-1])
    equal = np.ones(len(same), bool)
    for k in range(width):
        equal &= ids[at[same] + k] == ids[at[same + 1] + k]
    if equal.all():
        out[order[same]] = out[order[same + 1]] = True
        return out
    seen: dict[bytes, int] = {}  # two windows share a hash: count the windows themselves
    mine = [ids[s:s + width].tobytes() for s in starts]
    for w in mine:
        seen[w] = seen.get(w, 0) + 1
    return np.array([seen[w] > 1 for w in mine])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(values, kind))


def _index(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Per text: its super-k-mers as three arrays."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("text_key"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    schema = T.StructType([rows.schema["id"], rows.schema["text_key"],
                           T.StructField("minimiser", T.ArrayType(T.LongType())),
                           T.StructField("first", T.ArrayType(T.IntegerType())),
                           T.StructField("windows", T.ArrayType(T.ShortType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = part.column(2).cast(pa.binary()).to_pylist()
                text, first, windows, minimiser = super_kmers(Words(texts), width)
                n = np.bincount(text, minlength=len(texts))
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _lists(minimiser, n, pa.int64()),
                     _lists(first, n, pa.int32()), _lists(windows, n, pa.int16())], schema.names)
                yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(run, schema)


def window_digest(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each window (of word hashes). They only choose its bucket."""
    return gram_hash(words, width, 11).view(np.int64), gram_hash(words, width, 13).view(np.int64)


def _travel(parts: DataFrame, width: int, digest: Callable) -> DataFrame:
    """The packed strings of super-k-mers with a minimiser that occurs again
    (``digest`` is null), and the single windows of hot ones, with digests."""
    schema = T.StructType([
        parts.schema["id"], parts.schema["text_key"], T.StructField("minimiser", T.LongType()),
        T.StructField("digest", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("packed", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                doc, mini, dig, first, packed = [], [], [], [], []
                for i, (text, kmers) in enumerate(zip(part.column(2).cast(pa.binary()).to_pylist(), part.column(3).to_pylist())):
                    words = text.split()
                    h = None
                    for k in kmers:
                        if not k["hot"]:
                            doc.append(i)
                            mini.append(k["minimiser"])
                            dig.append(None)
                            first.append(k["first"])
                            packed.append(b" ".join(words[k["first"]:k["first"] + k["windows"] + width - 1]))
                            continue
                        if h is None:
                            h = [x.tolist() for x in digest(Words([text]).hash, width)]
                        for w in range(k["first"], k["first"] + k["windows"]):
                            doc.append(i)
                            mini.append(h[0][w])
                            dig.append(h[1][w])
                            first.append(w)
                            packed.append(b" ".join(words[w:w + width]))
                at = pa.array(doc, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(mini, pa.int64()), pa.array(dig, pa.int64()),
                     pa.array(first, pa.int32()), pa.array(packed, pa.binary())], schema.names)

    return (parts.where("kmers is not null").select("id", "text_key", "text", "kmers").mapInArrow(run, schema))


def _hot_windows(windows: DataFrame, width: int) -> DataFrame:
    """Spans of the windows (one a row, with digest and words) that occur twice
    or more. Words are compared in the bucket of their digest."""
    at = [F.col("minimiser").alias("_m"), F.col("digest").alias("_d")]
    # The smallest and the largest words: one pair a task and digest travels.
    counted = written(windows.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("packed").alias("low"), F.max("packed").alias("high"))
                      .where("n > 1").select("_m", "_d", (F.col("low") != F.col("high")).alias("mixed")), "digests")
    here = (F.col("minimiser") == F.col("_m")) & (F.col("digest") == F.col("_d"))
    span = ["id", "text_key", F.col("first").alias("s"), (F.col("first") + width).cast("int").alias("e")]
    same = windows.drop("packed").join(counted.where("not mixed"), here).select(*span)
    # Different windows with one digest: counted by their words.
    mixed = windows.join(counted.where("mixed"), here, "left_semi")
    words = mixed.groupBy(*at, F.col("packed").alias("_p")).count().where("count > 1")
    return same.unionByName(mixed.join(words, here & (F.col("packed") == F.col("_p"))).select(*span))


def _buckets(strings: DataFrame, width: int) -> DataFrame:
    """Covered word spans (``s`` to before ``e``) of the texts whose
    super-k-mers hold repeated windows."""
    rows = strings.select("minimiser", "id", "text_key", "first", "packed")
    schema = T.StructType([rows.schema["id"], rows.schema["text_key"], T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])

    def solve(table: pa.Table):
        packed = table.column("packed").to_pylist()
        lists = [p.split() for p in packed]
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        number: dict[bytes, int] = {}
        flat = [w for ws in lists for w in ws]
        number = dict(zip(set(flat), range(len(flat))))
        ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        head = np.append(0, np.cumsum(n)[:-1])
        windows = n - width + 1
        owner = np.repeat(np.arange(len(n)), windows)
        offset = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(windows)[:-1]), windows)
        # Equal windows have equal minimisers, so buckets can be solved together.
        dup = repeated(ids, head[owner] + offset, width)
        # A gap after each super-k-mer keeps the runs of two apart.
        spaced = np.zeros(len(owner) + len(n), bool)
        spaced[np.arange(len(owner)) + owner] = dup
        s, e = _runs(spaced)
        if len(s):
            who = np.searchsorted(np.cumsum(windows + 1), s, "right")
            base = np.append(0, np.cumsum(windows + 1)[:-1])[who]
            first = table.column("first").to_numpy()[who]
            at = pa.array(who)
            t = table.select(["id", "text_key"]).take(at).combine_chunks()
            s, e = first + (s - base), first + (e - base) + width - 1
            for b in t.append_column("s", pa.array(s, pa.int32())).append_column("e", pa.array(e, pa.int32())).to_batches():
                yield b

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < 1 << 23:
                continue
            table = pa.Table.from_batches(held)
            m = table.column("minimiser").to_numpy()
            cut = int(np.searchsorted(m, m[-1]))  # the last bucket may go on
            if cut:
                yield from solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield from solve(pa.Table.from_batches(held))

    return rows.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(run, schema)


def _remove(text: bytes, spans: list) -> tuple[int, int, bytes]:
    words = text.split()
    mark = np.zeros(len(words) + 1, np.int32)
    for x in spans:
        mark[x["s"]] += 1
        mark[x["e"]] -= 1
    stay = np.cumsum(mark)[:-1] == 0
    kept = [w for w, k in zip(words, stay) if k]
    return len(words), len(words) - len(kept), b" ".join(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35,
                   hot: int = 20_000, with_text: bool = True, digest: Callable = window_digest) -> DataFrame:
    """Struct ``row`` (columns of ``docs`` but the text), ``n_words``,
    ``n_removed``, ``kept_sha256`` (of the kept words, joined by a space) and,
    ``with_text``, ``text`` (null if it was null), ``kept`` (the kept words).

    A word goes if a window of ``width`` words that covers it starts anywhere
    else too, in the same text or another; windows are judged on the input.
    Null and blank texts and texts shorter than a window lose nothing. Rows
    with the same id are texts of their own; rows equal in id and text are
    copies of each other. An empty table gives an empty result. ``hot`` and
    ``digest`` decide where windows meet, never whether they are equal.
    """
    index = written(_index(docs, id_col, text_col, width), "super-kmers")
    one = index.select("id", "text_key", F.explode(F.arrays_zip("minimiser", "first", "windows")).alias("k")) \
        .select("id", "text_key", "k.minimiser", "k.first", "k.windows")
    # Written, so that the join below has plain exchanges, whose hot
    # partitions Spark can split.
    again = written(one.groupBy("minimiser").count().where("count > 1")
                    .select(F.col("minimiser").alias("_m"), (F.col("count") > hot).alias("hot")), "minimisers")
    chosen = one.join(again, one["minimiser"] == F.col("_m"))
    key = F.struct("id", "text_key").alias("key")
    chosen = (chosen.select(key, F.struct("minimiser", "first", "windows", "hot").alias("k"))
              .groupBy("key").agg(F.collect_set("k").alias("kmers")))
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.struct(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("text_key")).alias("_key"))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    joined = rows.join(chosen, rows["_key"] == chosen["key"], "left")
    whole = F.sha2(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")), 256)
    none = F.col("kmers").isNull()
    parts = written(joined.select(
        "row", F.col("_key.id").alias("id"), F.col("_key.text_key").alias("text_key"), "kmers",
        F.when(none, words).alias("n_words"), F.when(none, whole).alias("sha"),
        (F.col("text") if with_text else F.when(~none, F.col("text"))).alias("text")), "texts", compression="zstd")
    drop(index)
    drop(again)
    travel = written(_travel(parts, width, digest), "travelling", compression="zstd")
    spans = _buckets(travel.where("digest is null"), width)
    spans = spans.unionByName(_hot_windows(travel.where("digest is not null"), width))
    spans = spans.groupBy(key).agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    some = parts.where("kmers is not null").select("row", "text", F.struct("id", "text_key").alias("_key"))
    some = some.join(spans, some["_key"] == spans["key"], "left").select("row", "text", "spans")
    fields = [some.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
              T.StructField("kept_sha256", T.StringType())]
    if with_text:
        fields += [T.StructField("text", T.StringType()), T.StructField("kept", T.StringType())]
    schema = T.StructType(fields)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                n, gone, kept = zip(*[_remove(t, s or []) for t, s in zip(texts, part.column(2).to_pylist())])
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if with_text:
                    cols += [part.column(1), pa.array([k.decode() for k in kept], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    plain = parts.where("kmers is null").select("row", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
                                                *(["text", F.col("text").alias("kept")] if with_text else []))
    return some.mapInArrow(run, schema).unionByName(plain)
