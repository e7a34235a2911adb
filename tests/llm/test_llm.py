"""Each operator against brute force, and its cases: nulls, empty and long
texts, ties, repeated rows, empty tables, clashing names."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rebuy.llm import bpe, mixing, quality_rules, sharding, simhash, substring_dedup, token_rollup, token_store, topk, warc
from rebuy.llm.common import shared

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, size string"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = prose(60)
    own = [prose(r.randint(1, 120)) for _ in range(40)]
    own += [f"{prose(20)}\n{passage}\n{prose(30)}" for _ in range(4)]
    own += [own[3], own[3], passage, None, "", " \t\n", "a " * 500, "x" * 50_000, prose(3000)]
    near = own[-1].split(" ")
    near[7] = "changed"
    return own + [" ".join(near), "# $ % & |\n" * 20, "One <|endoftext|> TWO\x1cthree　four", None]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", None, "de"][i % 3], ["b", "a", None][min(i % 5, 2)], len(t or ""), "r", "k", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id here at all", "en", "a", 1, "r", "k", "s"), rows[2], rows[2]], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def split(t):
    return (t or "").encode().split()


def test_mix_meets_targets(spark, docs):
    found = mixing.mix_sizes(docs.withColumn("size", mixing.word_count(F.col("text"))), mixing.pattern_weights(docs), reserve=3, fan_in=4).toPandas()
    again = mixing.mix_sizes(docs.withColumn("size", mixing.word_count(F.col("text"))), mixing.pattern_weights(docs), reserve=3, fan_in=4).toPandas()
    assert len(found) == docs.count() and found.copies.max() <= 3
    assert sorted(found.copies * found["size"]) == sorted(again.copies * again["size"])
    found["source"] = [r["source"] or "" for r in found.row]
    g = found.assign(taken=found.copies * found["size"]).groupby("source").agg(
        n=("size", "sum"), s=("source_size", "first"), t=("target", "first"), k=("taken", "sum"), most=("size", "max"))
    assert (g.n == g.s).all() and (abs(g.k - g.t) <= g.most).all()
    assert g.t.sum() == pytest.approx(g.n.sum()) and (g.t <= 3 * g.s + 1e-6).all()


def test_mix_is_unbiased(spark):
    rows = spark.range(300).select("id", F.lit("s").alias("source"), (1 + F.col("id") % 7).alias("size"))
    other = spark.range(1000, 1001).select("id", F.lit("t").alias("source"), F.lit(600).cast("long").alias("size"))
    w = spark.createDataFrame([("s", 1.0), ("t", 2.0)], "source string, weight double")
    seen = [mixing.mix_sizes(rows.unionByName(other), w, seed=k).where("row.source = 's'").select("copies", "size", "target").toPandas() for k in range(3)]
    for x in seen:
        assert abs((x.copies * x["size"]).sum() - x.target.iloc[0]) <= 7


def test_targets_reshare(spark):
    s = spark.createDataFrame([("a", 10, 100.0), ("b", 1000, 1.0), (None, 50, 1.0), ("z", 5, 0.0)], "source string, source_size long, weight double")
    t = {r["source"]: r["target"] for r in mixing.targets(s).collect()}
    assert t["a"] == 30 and t[None] == 150 and t["z"] == 0 and t["b"] == pytest.approx(1065 - 180)


def test_mix_keeps_documents(spark, docs):
    found = mixing.mix(docs, mixing.pattern_weights(docs)).select("row.*", "copies")
    assert found.columns == [*docs.columns, "copies"] and found.where("copies < 1").count() == 0
    assert mixing.mix(empty(spark), mixing.pattern_weights(empty(spark))).count() == 0


def brute_features(t):
    ws = (t or "").encode().split()
    c = collections.Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    inside = {j for i in range(len(ws) - 4) if c[tuple(ws[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        dup += bool(split(line)) and line in seen
        seen.add(line)
    chars = "".join(w.decode() for w in ws)
    return len(ws), len(chars), sum(x in "#*$%&|<>" for x in chars), dup, len(inside)


def test_quality_features(texts):
    m = quality_rules.measure([None if t is None else t.encode() for t in texts])
    assert list(zip(*(m[c].tolist() for c in quality_rules.FEATURES))) == [brute_features(t) for t in texts]


def test_binomial_bounds():
    assert quality_rules.binomial_tail(0, 100, 0.01) == pytest.approx(0.99 ** 100)
    assert quality_rules.binomial_tail(1, 3, 0.5) == pytest.approx(0.5)
    assert quality_rules.upper_bound(0, 50, 0.05) == pytest.approx(1 - 0.05 ** (1 / 50))


def test_quality_cutoffs_hold(spark, docs):
    r = random.Random(1)
    rows = []
    for i in range(6000):
        bad = i % 3 == 0
        rows.append((i, " ".join(("#" * 5 if bad and j % 2 else f"w{r.randrange(999)}") for j in range(30)), "en"))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(6000)], "doc_id long, quality int")
    x = quality_rules.judge(d, labels).select("row.doc_id", "kept", "failed_rule", "base_failed").toPandas()
    ok = x[~x.base_failed]
    assert ok[ok.doc_id % 3 != 0].kept.mean() >= 0.98 and not ok[ok.doc_id % 3 == 0].kept.any()
    few = quality_rules.judge(docs, labels.limit(3), keep_text=True)
    assert few.count() == docs.count() and few.where("failed_rule is not null").count() == 0
    assert quality_rules.judge(empty(spark), labels).count() == 0


def labelled_features(spark, counts):
    """Rows of 100 words and 500 characters: (stratum, good, symbols, repeated words, how many)."""
    rows = [(s, g, 100, 500, sym, 0, rep) for s, g, sym, rep, n in counts for _ in range(n)]
    return spark.createDataFrame(rows, "stratum string, good boolean, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")


def test_quality_cutoffs_need_few_labels(spark):
    # 230 good labels suffice for one of four strata; 90 and 60 and 70 only together, 4 not at all by themselves.
    counts = [("en", True, 0, 0, 230), ("en", False, 30, 0, 9), ("de", True, 0, 0, 90), ("de", False, 30, 0, 3), (None, True, 0, 0, 60),
              ("fr", True, 0, 0, 70), ("it", False, 30, 0, 5), ("en", None, 0, 0, 5)]
    found = {(r["stratum"], r["rule"]): r for r in quality_rules.thresholds(labelled_features(spark, counts)).collect()}
    assert quality_rules.fewest(4, 0.02, 0.05) == 217 and {s for s, _ in found} == {"en", "de", "fr", None}
    assert {(s, r["pool"], r["n_good"], r["n_rejected"]) for (s, _), r in found.items()} == {
        ("en", "own", 230, 0), ("de", "small", 220, 0), ("fr", "small", 220, 0), (None, "small", 220, 0)}
    assert all(r["cutoff"] == quality_rules.RULES[rule][1][-1] and r["bound"] <= 0.02 for (_, rule), r in found.items())
    fewer = quality_rules.thresholds(labelled_features(spark, counts[:3])).collect()
    assert {(r["stratum"], r["pool"], r["n_good"]) for r in fewer} == {("en", "own", 230), ("de", "all", 320)}
    assert all(r["cutoff"] is None for r in quality_rules.thresholds(labelled_features(spark, counts[2:5])).collect())


def test_quality_cutoffs_are_judged_together(spark):
    # Repeats tighten until the good documents lost by all rules together are too many, not beyond and not before.
    counts = [("en", True, 0, 0, 964), ("en", True, 0, 18, 5), ("en", True, 0, 12, 11), ("en", True, 30, 0, 5), ("en", True, 0, 9, 15),
              ("en", False, 200, 0, 50), ("en", False, 0, 19, 40)]
    found = quality_rules.thresholds(labelled_features(spark, counts)).collect()
    cuts = {r["rule"]: r["cutoff"] for r in found}
    lost = lambda sym, rep: sum(n for _, g, s, p, n in counts if g and (s / 500 > sym or p / 100 > rep))
    allowed = max(k for k in range(50) if quality_rules.binomial_tail(k, 1000, 0.02) <= 0.05)
    assert cuts["symbols"] == 0.05 and cuts["repeats"] == 0.15 and {r["n_rejected"] for r in found} == {lost(0.05, 0.15)}
    assert lost(0.05, 0.2) < lost(0.05, 0.15) <= allowed < lost(0.05, 0.1)


def brute_repeats(rows, w):
    ws = [split(t) for _, t in rows]
    c = collections.Counter(tuple(x[i:i + w]) for x in ws for i in range(len(x) - w + 1))
    out = []
    for (i, _), x in zip(rows, ws):
        gone = {j for k in range(len(x) - w + 1) if c[tuple(x[k:k + w])] > 1 for j in range(k, k + w)}
        kept = b" ".join(a for j, a in enumerate(x) if j not in gone)
        out.append((i, len(x), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,hot", [(35, 20_000), (35, 1), (3, 20_000)])
def test_substring_dedup(spark, docs, width, hot):
    found = substring_dedup.remove_repeats(docs, width=width, hot=hot).select("row.doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == brute_repeats(rows_of(docs), width)


@pytest.mark.parametrize("kinds", [1, 3])
def test_substring_dedup_compares_words_of_equal_digests(spark, docs, kinds):
    weak = lambda words, width: [x % kinds for x in substring_dedup.window_digest(words, width)]
    found = substring_dedup.remove_repeats(docs, width=5, hot=1, digest=weak).select("row.doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == brute_repeats(rows_of(docs), 5)


def test_substring_dedup_without_rows(spark):
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_arc_round_trip(spark):
    rows = [(1, "http://a b/é", "x" * 10), (2, None, None), (3, "http://c/", "x" * 10), (4, "http://c/", "é\r\n\r\nWARC/1.1\n"), (None, None, ""),
            (3, "http://c/", "x" * 10), (9, "http://big/", "y\n" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    by = collections.defaultdict(list)
    for r in found:
        by[r["payload_digest"]].append(r)
    for own in {(h or "") for _, _, h in rows}:
        group = by[base64.b32encode(hashlib.sha1(own.encode()).digest()).decode()]
        ids = [i for i, _, h in rows if (h or "") == own]
        most = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r["page_id"]) for r in group) == sorted(map(str, ids))
        assert all(r["payload_bytes"] == len(own.encode()) for r in group)
        assert [r["page_id"] for r in group if r["record_type"] == "response"] == [most]
        assert all(r["refers_to"] == most for r in group if r["record_type"] == "revisit")
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_arc_versions_and_damage():
    v1 = b"filedesc://x 0.0.0.0 20000101000000 text/plain 4\n1 0 \nhttp://a 1.2.3.4 19990203040506 text/html 5\nab\ncd\nnot a header\nhttp://b 1.2.3.4 199902030405 text/html 2\nzz\nhttp://c 1.2.3.4 199902030405 text/html 99\ncut"
    got = list(warc.parse_arc(v1))
    assert [(h["URL"], d) for _, h, d in got] == [("http://a", b"ab\ncd"), ("http://b", b"zz")]
    v2 = b"filedesc://x 0.0.0.0 20000101000000 text/plain 200 - - 0 x 4\n2 0 \nhttp://a 1.2.3.4 19990203040506 text/html 200 - - 9 x 3\nabc\n"
    assert [(h["Result-code"], d) for _, h, d in warc.parse_arc(v2)] == [("200", b"abc")]


def test_bpe_equals_library(texts):
    tok = Tokenizer.from_file(PATH)
    r = random.Random(3)
    odd = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x3000), 32, r.randrange(0x10000, 0x11000)])) for _ in range(30)) for _ in range(500)]
    own = [t or "" for t in texts] + odd + ["aaaa aaaaa", "İ ΑΣ ǅ ﬁ", "\x1c \x85\xa0x", "<|startoftext|><|endoftext|>"]
    coder = bpe.WordBpe(open(PATH, encoding="utf-8").read(), cache=50)
    chunked = token_store.CachedEncoder(coder.spec, limit=50)
    for at in range(0, len(own), 40):
        part = own[at:at + 40]
        want = tok.encode_batch(part, add_special_tokens=False)
        for ids, other, e in zip(coder.encode_batch([t.encode() for t in part]), chunked.encode_batch([t.encode() for t in part]), want):
            assert np.frombuffer(ids, "<u4").tolist() == e.ids and other == ids
            assert coder.decode(ids).decode() == tok.decode(e.ids, skip_special_tokens=False)


def test_bpe_frames(spark, docs):
    found = bpe.encode_decode(docs, PATH)
    assert found.count() == docs.count() and found.where("row.text is null and (length(ids) > 0 or decoded <> '')").count() == 0
    assert bpe.encoded_digests(empty(spark), PATH).count() == 0


def test_rollup(spark, docs):
    tok = Tokenizer.from_file(PATH)
    counts = token_rollup.count_tokens(docs.select("doc_id", "source", "lang", "text"), PATH).select("row.*", "n_text")
    r = token_rollup.Rollup(spark, shared(spark, "totals"))
    assert r.totals().count() == 0
    insert = token_rollup.signed(counts, 1, "n_text", "v1")
    assert r.commit("a", insert) and not r.commit("a", insert)
    gone = counts.where("lang = 'en'")
    assert r.commit("b", token_rollup.signed(gone, -1, "n_text", "v1").unionByName(token_rollup.signed(gone, 1, "n_text", "v2")))
    assert r.commit("c", token_rollup.signed(counts.where("lang = 'de'"), -1, "n_text", "v1"))
    want = collections.Counter()
    for x in docs.collect():
        if x["lang"] != "de":
            key = (x["source"], x["lang"], "v2" if x["lang"] == "en" else "v1")
            want[key] += len(tok.encode(x["text"] or "", add_special_tokens=False).ids)
    got = {(x["source"], x["lang"], x["tokenizer"]): x["tokens"] for x in r.totals().collect()}
    assert got == dict(want)
    top = token_rollup.rolled_up(r.totals()).where("level = 0").first()
    assert top["tokens"] == sum(want.values())


def brute_fingerprint(t):
    ws = [w.lower() for w in split(t)]
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + 4]), 42) for i in range(max(1, len(ws) - 3))] if ws else []
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64)) if hs else 0


def brute_components(fps, ids, bits=4):
    part = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and part[i] != part[j]:
                a, b = part[i], part[j]
                part = [b if p == a else p for p in part]
    low = {p: min((d for d, q in zip(ids, part) if q == p and d is not None), default=None) for p in part}
    return [low[p] for p in part]


def test_simhash(spark, docs):
    rows = rows_of(docs)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], fps, brute_components(fps, [i for i, _ in rows])), key=str)
    found = [(r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in simhash.near_duplicates(docs).select("row.doc_id", "fp", "component_id").collect()]
    assert sorted(found, key=str) == want
    kept = simhash.keep_one(docs).toPandas()
    assert len(kept) == len(set(c for _, _, c in want)) and list(kept.columns) == docs.columns
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_pivot_search_loses_no_link(spark):
    r = random.Random(7)
    fps = {r.getrandbits(64) for _ in range(50)} | {0, 2 ** 64 - 1}
    for f in list(fps)[:10]:
        for _ in range(30):
            for _ in range(r.randint(1, 3)):
                f ^= 1 << r.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    rows = spark.createDataFrame([(f - 2 ** 64 if f >> 63 else f,) for f in fps], "fp long")
    found = simhash.components(simhash.links(rows)).collect()
    root = {x["node"] % 2 ** 64: x["root"] % 2 ** 64 for x in found}
    want = brute_components(fps, fps)
    groups = collections.defaultdict(set)
    for f, w in zip(fps, want):
        groups[w].add(root.get(f, f))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_store(spark, docs, encoding):
    tok, path = Tokenizer.from_file(PATH), token_store.new_store(spark)
    token_store.write_tokens(docs, path, PATH, 2, encoding=encoding)
    found = sorted(token_store.digests(spark, path).collect(), key=lambda r: r["start"])
    assert [-1 if r["id"] is None else r["id"] for r in found] == sorted(-1 if i is None else i for i, _ in rows_of(docs))
    texts = collections.defaultdict(list)
    for i, t in rows_of(docs):
        texts[i].append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    at = 0
    for r in found:
        ids = texts[r["id"]].pop()
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    meta = token_store.read_metadata(spark, path)
    assert meta.agg(F.sum("n_tokens")).first()[0] == at
    assert "tokens" not in meta._jdf.queryExecution().executedPlan().toString().replace("n_tokens", "")
    one = token_store.read_tokens(spark, path, spark.range(3, 4))
    assert [len(r["tokens"]) for r in one.collect()] == [r["n_tokens"] for r in found if r["id"] == 3]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "In(id, [3])" in plan(one) or "EqualTo(id,3)" in plan(one)
    some = spark.range(2, 30, 3).union(spark.range(2, 4)).union(spark.createDataFrame([(None,)], "id long"))
    wide = token_store.read_tokens(spark, path, some, listed=2)
    assert "GreaterThanOrEqual(id,2), LessThanOrEqual(id,29)" in plan(wide)
    for df in (wide, token_store.read_tokens(spark, path, some)):
        assert sorted((r["id"], len(r["tokens"])) for r in df.collect()) == sorted(
            (r["id"], r["n_tokens"]) for r in found if r["id"] in {*range(2, 30, 3), 2, 3})
    assert token_store.read_tokens(spark, path, spark.range(0)).count() == 0


def test_shards(spark, docs):
    limit = 20_000
    found = sharding.shard(docs, limit).toPandas()
    assert len(found) == docs.count() and (found.groupby("shard").bytes.sum() == found.groupby("shard").shard_bytes.first()).all()
    # Only one hash (a single large row, a repeated id) may stay over the limit.
    for _, g in found[found.shard_bytes > limit].groupby("shard"):
        assert len({str(r["doc_id"]) for r in g.row}) == 1 and g.depth.iloc[0] == 60
    shards = sorted(found.shard.unique())
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert sharding.shard(empty(spark), limit).count() == 0


def test_written_shards(spark, docs):
    limit, docs = 20_000, docs.drop("key")
    # 300 rows without an id and 100 copies under one id: each far over the limit.
    more = [(None, f"t{i} " + "y" * 300, "en", "a", 1, "r", "s") for i in range(300)] + [(7000, "z" * 900, "en", "a", 1, "r", "s")] * 100
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    path = shared(spark, "shards")
    sharding.write_shards(docs, path, limit)
    stored = spark.read.parquet(path)
    assert stored.drop("shard").exceptAll(docs).isEmpty() and docs.exceptAll(stored.drop("shard")).isEmpty()
    found = sharding.read_shards(docs, path).toPandas()
    assert sorted(zip(found.shard, found.shard_rows, found.shard_bytes)) == sorted(
        map(tuple, sharding.shard(docs, limit).select("shard", "shard_rows", "shard_bytes").collect()))
    by = found.groupby("shard")
    assert (by.bytes.sum() == by.shard_bytes.first()).all() and (by.shard_rows.first() == by.size()).all()
    assert (found[found.shard_bytes > limit].shard_rows == 1).all() and (found.depth == found.shard.str.len()).all()
    shards = sorted(found.shard.unique())
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert len({x.shard for x in found.itertuples() if x.row["doc_id"] == 7000}) >= 5
    none = shared(spark, "shards")
    sharding.write_shards(empty(spark), none, limit)
    assert sharding.read_shards(empty(spark), none).count() == 0


def test_topk(spark):
    r = random.Random(2)
    vecs = [(i, [r.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    vecs += [(i, vecs[5][1]) for i in range(300, 420)] + [(1000, None), (1050, [float("nan")] * 8), (None, vecs[1][1]), (1100, [1.0, None] * 4), vecs[50],
                                                           (2001, [1e18] + [0.0] * 7), (2003, [0.5, 0.5])]
    frame = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    topk.DATA_BLOCK, before = 64, topk.DATA_BLOCK
    try:
        found = topk.top_k(frame, F.col("id") % 50 == 0).collect()
    finally:
        topk.DATA_BLOCK = before
    good = {i: [int(np.floor(256 * x)) for x in v] for i, v in vecs if i is not None and i not in (1000, 1050, 1100)}
    for q in [i for i in good if i % 50 == 0]:
        scores = [(-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(good[q], v)))), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        assert [(-x["score"], x["vec_id"]) for x in sorted(found, key=lambda x: x["rank"]) if x["query_id"] == q] == sorted(scores)[:5]
    assert topk.top_k(frame.limit(0), F.col("id") % 50 == 0).count() == 0
