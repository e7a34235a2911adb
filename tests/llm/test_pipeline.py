"""The corpus pipeline against brute force: whole run, single stages, nulls,
repeated rows, an empty table, and columns whose names the stages use inside."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_llm import brute_components, brute_features, brute_fingerprint, brute_repeats, split

CLASHES = ["row", "key", "_key", "o", "n_removed", "kept", "copies", "copy", "text_key", "fp", "spans", "n_words", "ids", "digest"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgé") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = prose(50)
    texts = [prose(r.randint(40, 200)) for _ in range(30)]
    texts += [f"{prose(30)}\n{passage} {prose(40)}" for _ in range(5)] + [passage]
    texts += [texts[0], texts[0], texts[1], None, "", "  \n", prose(4), "again and again " * 30, prose(20_000)]
    near = texts[-1].split(" ")
    near[9_000] = "Changed"
    texts.append(" ".join(near))
    out = [(i, t, ["en", None, "de"][i % 3], ["b", "a", None][min(i % 5, 2)], len(t or ""), *CLASHES) for i, t in enumerate(texts)]
    return [*out, (None, prose(60), "en", "a", 1, *CLASHES), out[3], out[3]]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    """A folder with ``documents`` and too few labels for any cutoff."""
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def passes(t):
    n, _, _, _, repeats = brute_features(t)
    return n >= 10 and 100 * repeats <= 20 * n


def brute_kept(rows):
    """(id, text, source) after the first three stages."""
    rows = [(r[0], r[1], r[3]) for r in rows if passes(r[1])]
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    best = {}
    for row, fp, c in zip(rows, fps, brute_components(fps, [i for i, _, _ in rows])):
        group = (c, fp if c is None else None)
        best[group] = min(best.get(group, row), row, key=lambda x: (x[0] is None, x[0] or 0))
    rows = list(best.values())
    repeats = {(i, n): (gone, sha) for i, n, gone, sha in brute_repeats([(i, t) for i, t, _ in rows], 35)}
    out = []
    for i, t, s in rows:
        gone, sha = repeats[i, len(split(t))]
        if gone == len(split(t)):
            continue
        out.append((i, t if gone == 0 else None, sha, len(split(t)) - gone, s))
    return out


def brute_targets(sizes):
    """Targets of sources in order: weights 5, 2, 1, ...; at most 3 times a source's size."""
    weight = {s: [5, 2, 1][k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, free, out = float(sum(sizes.values())), set(sizes), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_run_against_brute_force(spark, rows, folder):
    kept = brute_kept(rows)
    by_id = {i: (t, n, s) for i, t, _, n, s in kept}
    assert len(by_id) == len(kept) and 20 < len(kept) < len(rows) - 8
    found = corpus_pipeline.run(spark, folder).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    copies, taken = collections.Counter(), collections.Counter()
    for r in found:
        text, n, source = by_id[r["doc_id"]]
        assert r["source"] == source
        if text is not None:
            ids = np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert r["ids_sha256"] == hashlib.sha256(ids).hexdigest() and r["n_tokens"] * 4 == len(ids)
            assert r["decoded_sha256"] == hashlib.sha256(tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False).encode()).hexdigest()
        copies[r["doc_id"]] += 1
        taken[source] += n
    sizes, largest = collections.Counter(), collections.Counter()
    for _, _, _, n, s in kept:
        sizes[s] += n
        largest[s] = max(largest[s], n)
    targets = brute_targets(sizes)
    assert max(copies.values()) <= 3 and all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)


def test_passages_stage(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.repeated_passages(spark, docs, folder)
    assert got.columns == docs.columns
    want = collections.Counter()
    repeats = brute_repeats([(r[0], r[1]) for r in rows], 35)
    for i, n, gone, sha in repeats:
        if gone < n or not gone:
            want[str((i, sha))] += 1
    seen = collections.Counter(str((r["doc_id"], hashlib.sha256(b" ".join(split(r["text"]))).hexdigest())) for r in got.collect())
    assert seen == want
    sized = {r["doc_id"]: (r["n_chars"], r["text"]) for r in got.collect()}
    cut = [i for i, n, gone, _ in repeats if 0 < gone < n]
    assert cut and all(sized[i][0] == len(sized[i][1]) for i in cut)


def test_stages_keep_columns_and_values(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, folder)
    assert sorted(map(tuple, good.collect()), key=str) == sorted((r for r in rows if passes(r[1])), key=str)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.mix):
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns and {tuple(r) for r in got.collect()} <= set(rows)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and {"doc_id", "ids", "ids_sha256"} <= set(found.columns)
