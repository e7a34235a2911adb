"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of
every neighbouring pair by binary search over the sorted pair keys, takes the
lowest rank of each word and merges all its occurrences; words with no pair
left drop out. Words met before come from a bounded cache, so a round works
on the new words of a batch only.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces

#: ASCII text in one pass: lower case, white space to plain spaces.
ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz" + b" " * 5)
#: First bytes of the code points from U+0240 on. Below, case, composition and
#: letters don't differ between versions of Unicode.
BEYOND = bytes(range(0xC9, 0x100))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a word-end BPE file of the tokenizers library:
    composed, lower-cased text, byte symbols, an end-of-word suffix and no
    decoder (decoded tokens are joined by a space)."""

    def __init__(self, spec: str, cache: int = 300_000):
        conf = json.loads(spec)
        model = conf["model"]
        self.vocab = vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.known = np.array([i in names for i in range(len(self.names))])
        symbols = byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.last = np.array([vocab[c + suffix] for c in symbols], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.base = len(self.names)
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # The last rank given to a pair holds if it is listed twice.
        order = np.argsort(keys, kind="stable")
        lasts = np.append(keys[order][1:] != keys[order][:-1], True)
        self.keys, self.ranks, self.made = keys[order][lasts], order[lasts], made[order][lasts]
        rank_of = {m: r for r, m in reversed(list(enumerate(made.tolist())))}
        #: Whether no merge makes a pair of lower rank than its own: then all
        #: occurrences of the lowest pair can merge in one round.
        self.monotone = all(rank_of.get(vocab[x], -1) < r for r, (a, b) in enumerate(merges) for x in (a, b))
        self.split = regex.compile("|".join(map(regex.escape, self.special)).encode() or rb"(?!)")
        # The split pattern of this vocabulary (fixed values).
        self.piece = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.limit, self.cache = cache, {}
        self.spec, self._lib = spec, None

    @property
    def lib(self):
        """The library's own normaliser and splitter, for rare scripts."""
        if self._lib is None:
            from tokenizers import Tokenizer
            self._lib = Tokenizer.from_str(self.spec)
        return self._lib

    def chunks(self, text: bytes) -> list[bytes]:
        """Composed, lower-cased text, split at white space."""
        if text.isascii():
            return text.translate(ASCII).split()
        if len(text.translate(None, BEYOND)) < len(text):
            return self.lib.normalizer.normalize_str(text.decode()).encode().split()
        out = unicodedata.normalize("NFC", text.decode()).lower().encode()
        return out.replace(b"\xc2\x85", b" ").replace(b"\xc2\xa0", b" ").split()

    def words(self, chunk: bytes) -> list[bytes]:
        """The pieces of a chunk that are merged on their own."""
        if len(chunk.translate(None, BEYOND)) < len(chunk):
            found = self.lib.pre_tokenizer.pre_tokenize_str(chunk.decode())
            return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in found]
        text = chunk.decode()
        return [chunk] if text.isalpha() else [p.encode() for p in self.piece.findall(text)]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words (their bytes; none empty), one after the
        other, and the number of each word's."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym, word = self.inner[flat], np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[flat[ends]]
        done_sym, done_word = [sym[:0]], [word[:0]]
        none = np.int64(len(self.keys) + len(self.ranks) + 1)
        while len(sym):
            pair = sym[:-1] * self.base + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (word[:-1] == word[1:]), self.ranks[at], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(sym)))
            lowest = np.minimum.reduceat(rank, starts)
            stay = np.repeat(lowest != none, lengths)
            done_sym.append(sym[~stay])
            done_word.append(word[~stay])
            hit = (rank == np.repeat(lowest, lengths)) & (rank != none)
            # Of overlapping occurrences (a a a) the first, third, ... merge.
            where = np.flatnonzero(hit)
            if not len(where):
                break
            new_run = np.append(True, np.diff(where) != 1)
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
            take = (np.arange(len(where)) - run_start) % 2 == 0
            if not self.monotone:
                take &= np.append(True, word[where][1:] != word[where][:-1])
            where = where[take]
            sym = sym.copy()
            sym[where] = self.made[at[where]]
            stay[where + 1] = False
            sym, word = sym[stay], word[stay]
        word = np.concatenate(done_word)
        return np.concatenate(done_sym)[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def learn(self, chunks: Iterable[bytes]) -> None:
        """Put chunks of normalised text into the cache."""
        chunks = list(chunks)
        found = [[c] if c.isalpha() else self.words(c) for c in chunks]
        ids, sizes = self.merge([p for ps in found for p in ps])
        ids, at = ids.astype("<u4").tobytes(), np.append(0, np.cumsum(sizes) * 4)
        at = at[np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))].tolist()
        self.cache.update({c: ids[a:b] for c, a, b in zip(chunks, at, at[1:])})

    def encode_batch(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian 32-bit integers (null: none)."""
        if len(self.cache) > self.limit:
            self.cache = {}
        parts: list[list] = []
        new: set[bytes] = set()
        for text in texts:
            own, at, text = [], 0, text or b""
            for m in self.split.finditer(text) if b"<" in text else ():
                own += [self.chunks(text[at:m.start()]), self.special[m[0].decode()]]
                at = m.end()
            own.append(self.chunks(text[at:]))
            parts.append(own)
            for p in own:
                if isinstance(p, list):
                    new.update(p)
        new.difference_update(self.cache)
        if new:
            self.learn(new)
        get = self.cache.__getitem__
        return [b"".join([b"".join(map(get, p)) if isinstance(p, list) else int(p).to_bytes(4, "little") for p in own])
                for own in parts]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the tokens joined by a space; unknown ids are left out."""
        a = np.frombuffer(ids, "<u4")
        a = a[a < len(self.names)]
        return b" ".join(map(self.names.__getitem__, a[self.known[a]].tolist()))


def encode_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """Struct ``row`` (all columns of ``docs``), ``ids`` (binary, little-endian
    unsigned 32-bit) and ``decoded`` (string) of every whole text.

    A null or blank text has no ids and decodes to an empty text. Repeated
    rows are encoded like any other; an empty table gives no rows.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(spec)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = bpe.encode_batch(part.column(1).cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x).decode() for x in ids], pa.string())],
                    ["row", "ids", "decoded"])

    return rows.mapInArrow(run, schema)


def encoded_digests(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """Struct ``row`` without the text, ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` of ``encode_decode``, taken where the text is encoded."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        bpe = WordBpe(spec)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = bpe.encode_batch(part.column(1).cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                     pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids])], schema.names)

    return rows.mapInArrow(run, schema)
