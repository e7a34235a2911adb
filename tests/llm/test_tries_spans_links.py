"""Prefix trie, personal data and tokenizer alignment against brute force,
and their cases: nulls, empty and long texts, ties, repeated rows, empty
tables, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rebuy.llm import alignment, personal_data, prefix_trie
from rebuy.llm.bpe import byte_symbols

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TURNS = "conv_id long, turn long, role string, text string, turns string, key string"


def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    for turns in own.values():
        turns.sort(key=lambda q: q[:3])
    path = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path[c] = tuple(q[2:] for q in own.get(c - c % 20, [])[:h] + turns[h:])
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        words = len(p[-1][1].encode().split()) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in children[p])
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if len(path[c]) == len(p))))
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items()], key=str)


@pytest.fixture(scope="module")
def talks():
    r, rows = random.Random(1), []
    for c in range(300):
        for t in range(r.choice([1, 2, 3, 4, 5, 9]) if c % 50 else 70):
            rows.append((c if c < 280 else 5000 + c, None if t == 0 and c % 7 == 0 else t, r.choice(["u", None, "a"]) if c % 3 else "u",
                         r.choice(["a b", "c", None, "d e f"]) if c % 3 else f"same {t}"))
    return rows + rows[:20] + [(None, 1, "u", "x"), (7001, 1, "u", "long " * 50_000)]


@pytest.mark.parametrize("size, merge", [(1 << 18, 64), (40, 2), (1, 3)])
def test_prefix_trie(spark, talks, size, merge):
    frame = spark.createDataFrame([(*t, "t", "k") for t in talks], TURNS)
    turns = prefix_trie.with_shared_heads(prefix_trie.turn_rows(frame))
    found = prefix_trie.prefix_trie(turns, size, merge).collect()
    assert sorted(map(tuple, found), key=str) == trie_by_hand(talks)


def test_prefix_trie_without_rows(spark):
    turns = prefix_trie.with_shared_heads(prefix_trie.turn_rows(spark.createDataFrame([], TURNS)))
    assert prefix_trie.prefix_trie(turns).collect() == []


def test_findclose_and_minima():
    r = random.Random(3)
    for n in (1, 2, 65, 700, 5000):
        depth = [0]
        for _ in range(n - 1):
            depth.append(r.randint(1, depth[-1] + 1) if r.random() < 0.5 else depth[-1] + 1)
        trie, values = prefix_trie.Trie(np.array(depth)), np.array([r.randint(-99, 99) for _ in depth])
        stops = [next((j for j in range(i + 1, n) if depth[j] <= depth[i]), n) for i in range(n)] if n < 1000 else None
        if stops:
            assert trie.sizes.tolist() == [s - i for i, s in enumerate(stops)]
            assert prefix_trie.smallest(values, trie.sizes).tolist() == [values[i:s].min() for i, s in enumerate(stops)]
        assert trie.sizes[0] == n and trie.parent[0] == -1


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def spans_by_hand(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m.group().split("."))
                    or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def spans_of(found):
    return [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["base"]], [(s["kind"], s["start"], s["end"]) for s in r["added"]]) for r in found]


def test_rule_spans(spark):
    r = random.Random(3)
    texts = ["".join(r.choice("ab1.@+-() 9 05é😀_%4") for _ in range(r.randint(0, 300))) for _ in range(500)]
    texts += ["".join(r.choice("01234567890123456789.  +-(") for _ in range(r.randint(0, 200))) for _ in range(300)]
    texts += [None, "", "x" * 2000, "1" * 2000, "1.2.3.4 " * 500, "a.b" * 700 + "@", "a@b" + ".c" * 2000, "+1" + " " * 50 + "2345678",
              "a@b.c@d.e a@b.c_x@d.e 001.002.3.0255 1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111 1111 1111 1111"]
    frame = spark.createDataFrame([(i, t, "k", "m", "s") for i, t in enumerate(texts)], "doc_id long, text string, key string, match string, source string")
    found = spans_of(personal_data.find_personal_data(frame).select("row.doc_id", "base", "added").collect())
    assert sorted((d, b) for d, b, _ in found) == [(i, spans_by_hand(t)) for i, t in enumerate(texts)]


def test_long_runs_are_scanned_once(spark):
    texts = ["x" * 2_000_000, "1" * 2_000_000, "a@b" + ".c" * 500_000, "1 " * 500_000, "1.2." * 300_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = spans_of(personal_data.find_personal_data(frame).select("row.doc_id", "base", "added").collect())
    assert {d: len(b) for d, b, _ in found} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 150_000}


def test_trees_add_spans(spark):
    r, rows = random.Random(9), []
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    for i in range(400):
        rows.append((i, r.choice([
            f"call me at +1 ({digits(3)}) {digits(3)}-{digits(4)} soon", f"in the year {r.randint(1900, 2020)} and {digits(3)}-{digits(4)} units",
            f"host 10.{r.randint(0, 255)}.3.{r.randint(0, 255)} is up", f"token {digits(9)}a{digits(8)}", f"order {digits(7)} of {digits(12)}"])))
    plain = [(1000, "call me at (415) 555-0199 soon"), (1001, "the years 1998-1999 and 2001 were dry"), (1002, "no numbers here")]
    found = {d: a for d, _, a in spans_of(personal_data.find_personal_data(spark.createDataFrame(rows + plain, "doc_id long, text string"))
                                          .select("row.doc_id", "base", "added").collect())}
    assert found[1000] == [("phone", 11, 25)] and found[1001] == [] and found[1002] == []
    base = {d: spans_by_hand(t) for d, t in rows}
    assert not any(a for d, a in found.items() if d < 1000 and not base[d])  # what the rules refuse stays
    # Reruns agree; without labels nothing is added, without rows nothing comes.
    again = spans_of(personal_data.find_personal_data(spark.createDataFrame(plain, "doc_id long, text string")).select("row.doc_id", "base", "added").collect())
    assert all(b == a == [] for _, b, a in again) and len(again) == 3
    assert personal_data.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def align_by_hand(rows):
    a_lib, b_lib = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    plain = {c: b for b, c in enumerate(byte_symbols())}
    docs, counts, best = [], collections.Counter(), collections.Counter()
    for _, text in rows:
        raw = b" " + (text or "").encode()
        a = [(i, bytes(plain[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(raw.decode(), add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode())
             for i in (b_lib.encode(text) if text else []) for p in [b_lib.id_to_piece(i)]]
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for _, x in t]).tolist(), [i for i, _ in t])) for t in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        counts.update(links)
        groups, left = [], [list(e)[::-1] for e in ends]
        for c in cuts:
            sides = []
            for e, rest in zip(ends, left):
                side = []
                while rest and rest[-1] <= c:
                    side.append(str(e[rest.pop()]))
                sides.append(",".join(side))
            groups.append("|".join(sides))
        docs.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted([(d, 0, 0, 0, 0, 0, 0, "") if x is None else (d, *x[:3], len(x[3]), sum(counts[k] == best[k[1]] for k in x[3]), sum(counts[k] for k in x[3]), x[4])
                   for (d, _), x in zip(rows, docs)], key=str)


@pytest.mark.parametrize("block", [1 << 16, 64])
def test_alignment(spark, block, monkeypatch):
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéßж") for _ in range(r.randint(1, 9))) for _ in range(200)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 90))) for _ in range(30)]
    texts += ["".join(r.choice("ab \n\t'é，ﬁ½😀1.▁ \x1c") for _ in range(40)) for _ in range(60)]
    texts += [None, "", " ", "  ", "a  b", "trail ", " lead", "it's we'll 'd", "<s> </s> <|endoftext|> <0x41>", "▁ a", "\x00a", "w" * 20_000, texts[0], texts[0]]
    rows = list(enumerate(texts)) + [(None, "no id")]
    monkeypatch.setattr(alignment, "BLOCK_CHUNKS", block)
    frame = spark.createDataFrame([(*x, "r", "p", "s") for x in rows], "doc_id long, text string, row string, pair string, seq string")
    found = alignment.align(frame, BYTE_LEVEL, PIECES).select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == align_by_hand(rows)
    assert alignment.align(frame.limit(0), BYTE_LEVEL, PIECES).collect() == []


def test_sparse_products():
    r = random.Random(2)
    for _ in range(20):
        total = r.randint(1, 60)
        ends = [np.array(sorted({total, *(r.randint(1, total) for _ in range(r.randint(0, 20)))})) for _ in range(2)]
        dense = [np.zeros((len(e), total), int) for e in ends]
        for m, e in zip(dense, ends):
            for i, (x, y) in enumerate(zip([0, *e], e)):
                m[i, x:y] = 1
        got = np.zeros((len(ends[0]), len(ends[1])), int)
        a, b, n = alignment.overlap_links(*ends, total)
        got[a, b] = n
        assert (got == dense[0] @ dense[1].T).all()
        a, b, cuts = alignment.group_links(*ends)
        side = [np.searchsorted(cuts, e) for e in ends]
        assert sorted(zip(a.tolist(), b.tolist())) == [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if side[0][i] == side[1][j]]
        a, b = alignment.end_links(*ends, total)
        assert ends[0][a].tolist() == ends[1][b].tolist() == cuts.tolist()


def test_clashing_names_in_shards_and_near_duplicates(spark, tmp_path):
    from rebuy.llm import sharding, simhash
    rows = [(i, f"text {i % 3} " * 20, "s", "k", "o", "S") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string, _key string, o string, whole string")
    path = str(tmp_path / "shards")
    sharding.write_shards(frame, path, 400)
    found = sharding.read_shards(frame, path).collect()
    assert len(found) == 12 and all(r["row"]["shard"] == "s" and r["shard_bytes"] <= 400 for r in found)
    kept = simhash.keep_one(frame).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 2] and kept[0]["_key"] == "k" and kept[0]["o"] == "o"
