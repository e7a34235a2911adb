"""Prefix trie of conversations, as balanced parentheses per shard.

Conversations are sorted by their sequence of turns and cut into shards. A
shard's trie is a row of parentheses in preorder: a node opens, its subtree
follows, it closes. The excess (opened minus closed) is kept with the least
value of every block and a tree over the blocks (range min-max); findclose
descends it for all nodes together and so delimits their subtrees. The rank
of "()" before an end and a start counts a subtree's leaves, differences of
cumulative arrays give its conversations and savings.

Only nodes on the path of a shard's first or last conversation (its spines)
can go on in a neighbouring shard. They leave the shard as open rows and are
merged, many neighbouring shards at a time, in rounds: a merged group is a
smaller trie of the same form, with spines of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, written

#: Parentheses of a block, children of a node of the tree over blocks.
BLOCK, FAN = 64, 8
#: Nodes or conversations after which a task begins another shard.
SHARD_SIZE = 1 << 18
#: Shards that a merge takes together.
MERGE = 64


class Parens:
    """A balanced sequence of parentheses (1 opens, 0 closes)."""

    def __init__(self, bits: np.ndarray):
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(np.where(bits, 1, -1))
        # "()" ends at these places; a rank is a count of them.
        self.leaf_rank = np.append(0, np.cumsum(bits[:-1].astype(bool) & ~bits[1:].astype(bool)))
        self.open_rank = np.cumsum(bits, dtype=np.int64)
        n = -(-len(bits) // BLOCK)
        padded = np.full(n * BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        self.padded, self.levels = padded, [padded.reshape(n, BLOCK).min(1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            n = -(-len(low) // FAN)
            wide = np.full(n * FAN, np.iinfo(np.int64).max)
            wide[:len(low)] = low
            self.levels.append(wide.reshape(n, FAN).min(1))

    @staticmethod
    def _first(values: np.ndarray, start: np.ndarray, stop: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place in [start, stop) whose value is at most the target, or -1."""
        found, live = np.full(len(start), -1), np.flatnonzero(start < stop)
        at = start.copy()
        while len(live):
            hit = values[at[live]] <= target[live]
            found[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < stop[live]]
        return found

    def close(self) -> np.ndarray:
        """Place of each node's closing parenthesis: the first place after its
        opening one where the excess is below the excess there."""
        target = self.excess[self.opens] - 1
        out = self._first(self.padded, self.opens + 1, np.minimum((self.opens // BLOCK + 1) * BLOCK, len(self.excess)), target)
        rest = np.flatnonzero(out < 0)
        # Up: the first later sibling block with a low enough minimum; then down.
        place, level = self.opens[rest] // BLOCK, 0
        while len(rest):
            low = self.levels[level]
            hit = self._first(low, place + 1, np.minimum((place // FAN + 1) * FAN, len(low)), target[rest])
            for k in [np.flatnonzero(hit >= 0)]:
                node, goal = hit[k], target[rest[k]]
                for down in range(level - 1, -1, -1):
                    node = self._first(self.levels[down], node * FAN, np.minimum((node + 1) * FAN, len(self.levels[down])), goal)
                out[rest[k]] = self._first(self.padded, node * BLOCK, np.minimum((node + 1) * BLOCK, len(self.excess)), goal)
            rest, place, level = rest[hit < 0], place[hit < 0] // FAN, level + 1
        return out


def parens_of(depth: np.ndarray) -> np.ndarray:
    """Parentheses of the nodes whose depths (root 0) are given in preorder:
    before a node opens, nodes of its depth and deeper close."""
    closes = np.append(0, np.append(depth[:-1] - depth[1:] + 1, depth[-1] + 1))
    out = np.zeros(2 * len(depth), np.uint8)
    out[np.cumsum(closes)[:-1] + np.arange(len(depth))] = 1
    return out


def parents_of(depth: np.ndarray) -> np.ndarray:
    """Preorder number of each node's parent, -1 for the root: the last node
    before it that is one level higher."""
    n = len(depth)
    key = depth * n + np.arange(n)
    order = np.argsort(key, kind="stable")
    at = np.searchsorted(key[order], (depth - 1) * n + np.arange(n)) - 1
    out = order[np.maximum(at, 0)]
    out[depth == 0] = -1
    return out


def smallest(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Least value of each subtree (a run of ``sizes`` nodes in preorder), by
    a table of minima over runs of powers of two."""
    out = values.copy()
    table, width = values.copy(), 1
    power = np.frexp(sizes.astype(np.float64))[1] - 1  # widest run that fits
    for p in range(int(power.max()) + 1):
        k = np.flatnonzero(power == p)
        out[k] = np.minimum(table[k], table[k + sizes[k] - width])
        table[:len(table) - width] = np.minimum(table[:-width], table[width:]) if width < len(table) else table[:0]
        width *= 2
    return out


class Trie:
    """Nodes in preorder, by their depths: the root's is 0."""

    def __init__(self, depth: np.ndarray):
        self.depth, n = depth, len(depth)
        self.parens = Parens(parens_of(depth))
        self.close = self.parens.close()
        self.sizes = self.parens.open_rank[self.close] - np.arange(n)  # of subtrees
        self.parent = parents_of(depth)
        # The first path is the first run of growing depths.
        self.first = np.arange(int(np.argmin(np.append(np.diff(depth) > 0, False))) + 1)
        last, v = [], n - 1
        while v >= 0:
            last.append(v)
            v = int(self.parent[v])
        self.last = np.array(last[::-1])


_INT = ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")
#: kind: node (ready), open (a spine's node, to be merged), ids (conversations
#: that end at an open node). shard and place order the open rows.
SCHEMA = T.StructType([T.StructField("kind", T.StringType()), T.StructField("shard", T.LongType()), T.StructField("place", T.LongType()),
                       T.StructField("key", T.BinaryType()), T.StructField("parent_key", T.BinaryType()), T.StructField("turn", T.BinaryType()),
                       *[T.StructField(n, T.LongType()) for n in _INT], T.StructField("parent_conv_id", T.LongType()),
                       T.StructField("ends", T.StringType())])
_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("place", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
                    ("turn", pa.binary()), *[(n, pa.int64()) for n in _INT], ("parent_conv_id", pa.int64()), ("ends", pa.string())])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _batches(columns: dict, size: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, size, 8192):
        n = min(8192, size - at)
        cols = []
        for f in _ARROW:
            v = columns.get(f.name)
            if v is None:
                cols.append(pa.nulls(n, f.type))
            elif isinstance(v, str):
                cols.append(pa.array([v] * n, f.type))
            else:
                cols.append(v[at:at + n] if isinstance(v, pa.Array) else pa.array(v[at:at + n], f.type))
        yield pa.RecordBatch.from_arrays(cols, schema=_ARROW)


def _closed(trie: Trie, turn, words, shard: int, given: dict, ends: list[str | None] | None, key_of, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a trie. ``given`` has what the nodes bring along: conv_id,
    n_convs, and n_children, n_leaves, saved_tokens of subtrees that were
    closed before. Nodes on the first and the last path stay open unless
    this is the last merge."""
    depth, parens, sizes, parent, n = trie.depth, trie.parens, trie.sizes, trie.parent, len(trie.depth)
    conv, convs = given["conv_id"], given["n_convs"]
    spine = np.zeros(n, bool)
    if not last:
        spine[trie.first] = spine[trie.last] = True
    own = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n, np.int64)
    childless = (own + given["n_children"] == 0) & ~spine
    saved = np.where(spine, 0, given["saved_tokens"] + (convs - 1) * words)
    leaves = np.where(spine, 0, given["n_leaves"] + childless)
    # Ranks of "()" are the leaves of the trie itself; leaves closed before
    # lie in cumulative arrays, as the savings do.
    rank = parens.leaf_rank[trie.close] - parens.leaf_rank[parens.opens]
    bare = np.append(0, np.cumsum(np.where(own == 0, leaves - 1, leaves)))
    run = np.append(0, np.cumsum(saved))
    at = np.arange(n)
    total_leaves = rank + bare[at + sizes] - bare[at]
    total_saved = run[at + sizes] - run[at]
    ready = ~spine
    children = own + given["n_children"]
    parent_open = np.zeros(n, bool)
    parent_open[1:] = spine[parent[1:]]
    keys = {int(v): key_of(int(v)) for v in np.flatnonzero(spine)}
    k = np.flatnonzero(ready)
    if len(k):
        up = np.maximum(parent[k], 0)
        yield from _batches({
            "kind": "node", "shard": np.full(len(k), shard), "parent_key": [keys[p] if o else None for p, o in zip(up.tolist(), parent_open[k].tolist())],
            "depth": depth[k], "conv_id": conv[k], "n_convs": convs[k], "n_children": children[k], "n_leaves": total_leaves[k],
            "saved_tokens": total_saved[k], "ends": [ends[i] for i in k.tolist()] if ends else None,
            "key": given["key"].take(pa.array(k)) if given.get("key") is not None else None,
            "parent_conv_id": pa.array(conv[up], pa.int64(), mask=parent_open[k] | (depth[k] == 0))}, len(k))
    s = np.flatnonzero(spine)
    if len(s):
        # What lies below an open node and is closed: its ready children's sums.
        below = np.flatnonzero(ready & parent_open)
        sums = [np.zeros(n, np.int64) for _ in range(3)]
        for out, x in zip(sums, (ready.astype(np.int64), total_leaves, total_saved)):
            np.add.at(out, parent[below], x[below])
        yield from _batches({
            "kind": "open", "shard": np.full(len(s), shard), "place": np.arange(len(s)), "key": [keys[v] for v in s.tolist()],
            "turn": [turn(v) for v in s.tolist()], "depth": depth[s], "conv_id": conv[s], "n_convs": convs[s],
            "n_children": (given["n_children"] + sums[0])[s], "n_leaves": (given["n_leaves"] + sums[1])[s],
            "saved_tokens": (given["saved_tokens"] + sums[2])[s], "words": words[s]}, len(s))


def _shard(paths: pa.ListArray, words: np.ndarray, ids: np.ndarray, shard: int) -> Iterator[pa.RecordBatch]:
    """Rows of the trie of sorted conversations; ``words`` has a value a turn."""
    off = paths.offsets.to_numpy().astype(np.int64)
    size = np.diff(off)
    off = off[:-1] - off[0]
    flat = paths.flatten()
    raw = np.zeros((0, 32), np.uint8)
    if len(flat):
        start = int(np.frombuffer(flat.buffers()[1], np.int32)[flat.offset])
        raw = np.frombuffer(flat.buffers()[2], np.uint8)[start:start + 32 * len(flat)].reshape(-1, 32)
    quads = np.ascontiguousarray(raw).view(np.int64)
    # Turns that each conversation shares with the one before it.
    both = np.append(0, np.minimum(size[1:], size[:-1]))
    i = np.repeat(np.arange(len(size)), both)
    within = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    differs = (quads[off[i] + within] != quads[off[np.maximum(i - 1, 0)] + within]).any(1)
    common = both.copy()
    np.minimum.at(common, i[differs], within[differs])
    new = size - common
    new[0] += 1  # the root
    n = int(new.sum())
    of = np.repeat(np.arange(len(size)), new)
    depth = np.arange(n) - np.repeat(np.cumsum(new) - new, new) + common[of] + 1
    depth[:new[0]] -= 1
    place = off[of] + depth - 1  # of the node's turn
    term = np.cumsum(new) - 1  # node where each conversation ends
    here = np.bincount(term, minlength=n)
    at = np.append(0, np.cumsum(here))
    trie = Trie(depth)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, term, ids)
    given = {"conv_id": smallest(least, trie.sizes), "n_convs": at[np.arange(n) + trie.sizes] - at[:-1]}
    given |= {c: np.zeros(n, np.int64) for c in ("n_children", "n_leaves", "saved_tokens")}
    text = ids.astype(str)
    turn = lambda v: raw[place[v]].tobytes() if v else None
    keys: dict[int, bytes] = {0: b""}  # of the spines' nodes: a digest of all turns down to them
    for v in [*trie.first[1:].tolist(), *trie.last[1:].tolist()]:
        keys[v] = hashlib.sha256(keys[int(trie.parent[v])] + turn(v)).digest()
    node_words = np.where(depth > 0, words[np.maximum(place, 0)] if len(words) else 0, 0)
    ends: list[str | None] = [None] * n
    ended = np.flatnonzero(here)
    for v in ended.tolist():
        if v not in keys:
            ends[v] = hashlib.sha256(",".join(text[at[v]:at[v + 1]].tolist()).encode()).hexdigest()
    yield from _closed(trie, turn, node_words, shard, given, ends, keys.__getitem__, False)
    pieces = [(v, a) for v in ended.tolist() if v in keys for a in range(at[v], at[v + 1], 4096)]
    if pieces:
        yield from _batches({"kind": "ids", "key": [keys[v] for v, _ in pieces], "conv_id": [int(ids[a]) for _, a in pieces],
                             "ends": [",".join(text[a:min(a + 4096, at[v + 1])].tolist()) for v, a in pieces]}, len(pieces))


def _build(paths: DataFrame, shard_size: int) -> DataFrame:
    """Rows of all shards of conversations (id, path, words), sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, held, size = TaskContext.get().partitionId() << 32, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            lists = t.column("path").chunk(0)
            words = t.column("words").chunk(0).flatten().to_numpy().astype(np.int64)
            yield from _shard(lists, words, t.column("conv_id").to_numpy(), shard)

        for batch in batches:
            step = min(1024, shard_size)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                held.append(part)
                size += max(len(part.column(1).flatten()), part.num_rows)
                if size >= shard_size:
                    yield from finished()
                    shard, held, size = shard + 1, [], 0
        if size:
            yield from finished()

    order = ["path", "conv_id"]
    return paths.select("conv_id", "path", "words").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SCHEMA)


def _merge(open_rows: DataFrame, shards: DataFrame, fan: int, last: bool) -> DataFrame:
    """Open rows of ``fan`` neighbouring shards at a time as one trie each."""
    rows = open_rows.join(shards, open_rows["shard"] == shards["_shard"]).drop("_shard", "shard")
    rows = rows.select((F.col("number") / fan).cast("long").alias("group"), "number", "place", "key", "turn",
                       *_INT).repartition("group").sortWithinPartitions("group", "number", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, path = None, [], []

        def finished() -> Iterator[pa.RecordBatch]:
            cols = list(zip(*nodes))
            arrays = {n: np.array(c, np.int64) for n, c in zip(_INT, cols[2:])}
            key, turn = cols[0], cols[1]
            given = {c: arrays[c] for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")} | {"key": pa.array(key, pa.binary())}
            yield from _closed(Trie(arrays["depth"]), lambda v: turn[v], arrays["words"], group, given, None, lambda v: key[v], last)

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if r[0] != group:
                    if nodes:
                        yield from finished()
                    group, nodes, path = r[0], [], []
                depth = r[5]
                if len(path) > depth and nodes[path[depth]][0] == r[3]:
                    node = nodes[path[depth]]  # depth, conv_id, n_convs, n_children, n_leaves, saved_tokens, words
                    node[3] = min(node[3], r[6])
                    for k in (4, 5, 6, 7):
                        node[k] += r[k + 3]
                else:
                    del path[depth:]
                    path.append(len(nodes))
                    nodes.append([r[3], r[4], *r[5:]])
        if nodes:
            yield from finished()

    return rows.mapInArrow(run, SCHEMA)


def _digests(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each key, comma-joined in order. A
    digest is taken piece by piece, whatever the number of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if digest:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_pydict({"_key": [x for x, _ in out], "digest": [x for _, x in out]}, schema)
        if digest:
            yield pa.RecordBatch.from_pydict({"_key": [key], "digest": [digest.hexdigest()]}, schema)

    schema = pa.schema([("_key", pa.binary()), ("digest", pa.string())])
    return pieces.select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "_key binary, digest string")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """One row a conversation: ``conv_id`` and ``turns`` in order (null turn
    first, equal turn numbers by role, then by digest), each with the digest
    of its role and text and the words of the text. Null roles and texts are
    empty; rows without a conv_id belong to none."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"),
                    F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
                    F.regexp_count(text, F.lit(WORD)).alias("words"))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_heads(turns: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c rebuilt as the first h turns of conversation
    c - c % block (h = crc32 of the decimal c, modulo ``heads``; fewer if it
    has fewer, none if it is not there) and its own turns after its first h."""
    first = turns.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_head"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    joined = turns.join(first, turns["conv_id"] - turns["conv_id"] % block == first["_head"], "left")
    head = F.slice(F.coalesce("head", F.array().cast(turns.schema["turns"].dataType)), F.lit(1), h)
    return joined.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns"))


def prefix_trie(turns: DataFrame, shard_size: int = SHARD_SIZE, merge: int = MERGE) -> DataFrame:
    """A row for each distinct sequence of first turns of the conversations
    ``turns`` (``conv_id``, ``turns`` as of ``turn_rows``), from the root (no
    turns) on: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``
    (null for the root), ``n_convs`` (members), ``n_children``, ``n_leaves``
    (childless nodes in the subtree, itself included), ``saved_tokens``
    (subtree's sum of (n_convs - 1) x words of a node's last turn),
    ``ends_sha256`` (of the members that end there, ascending, comma-joined).

    Conversations without turns are members of the root only; no
    conversations give no rows. Equal conversations share all their nodes; a
    group of any size is spread over shards.
    """
    paths = turns.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words"))
    built = written(_build(paths, shard_size), "trie", compression="zstd")
    tables, open_rows, last = [built], built.where("kind = 'open'"), False
    while not last:
        # A row a shard: numbered in order, in one task by its few rows.
        shards = open_rows.select(F.col("shard").alias("_shard")).distinct()
        n = shards.count()
        if n == 0:
            break
        numbered = shards.withColumn("number", F.row_number().over(Window.orderBy("_shard")) - 1)
        last = n <= merge
        tables.append(written(_merge(open_rows, numbered, merge, last), "trie-merged", compression="zstd"))
        open_rows = tables[-1].where("kind = 'open'")
    columns = [*_INT[:-1], "parent_conv_id", "ends"]
    out = built.where("kind = 'node' and parent_key is null").select(*columns)
    digests = _digests(built.where("kind = 'ids'"))
    for t in tables[1:]:
        spines = t.where("kind = 'node' and parent_key is null")
        out = out.unionByName(_with_digest(spines, digests).select(*columns))
    keyed = tables[1].where("kind = 'node'") if len(tables) > 1 else built.where("kind = 'node' and key is not null")
    for t in tables[2:]:
        keyed = keyed.unionByName(t.where("kind = 'node'"))
    parents = keyed.select(F.col("key").alias("_pkey"), F.col("conv_id").alias("_pconv"))
    for t in tables[:-1]:
        # Nodes below a spine's node, found in a later merge. A node like the
        # root has a third of all rows below it, so it is looked up once a
        # shard, and rows are joined by shard and key.
        near = t.where("kind = 'open'").select(F.col("shard").alias("_shard"), "key")
        near = near.join(parents, near["key"] == parents["_pkey"]).select("_shard", "_pkey", "_pconv")
        edge = t.where("kind = 'node' and parent_key is not null")
        edge = edge.join(near, (edge["shard"] == near["_shard"]) & (edge["parent_key"] == near["_pkey"])).drop("parent_conv_id")
        edge = edge.withColumnRenamed("_pconv", "parent_conv_id")
        out = out.unionByName((edge if t is built else _with_digest(edge, digests)).select(*columns))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def _with_digest(nodes: DataFrame, digests: DataFrame) -> DataFrame:
    return nodes.join(digests, nodes["key"] == digests["_key"], "left").withColumn("ends", F.col("digest"))
