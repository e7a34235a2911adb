"""Quality rules whose cutoffs come with a guarantee.

Each rule is a score of a text; a document goes if a score exceeds the rule's
cutoff for its stratum. A stratum's cutoffs are chosen together on a labelled
holdout: one sequence of cutoff vectors tightens one cutoff of one rule a step,
and a vector stands if the exact binomial test rejects "all rules at these
cutoffs wrongly reject more than ``risk`` of the good documents"; the first that
does not ends the search (fixed-sequence testing, which needs no further
correction along the sequence). The order of the rules comes from the bad
documents alone, so the test of the good ones stays valid. The level is divided
by the number of strata (Bonferroni).

A stratum whose good labels could not pass any test (``fewest``) shares the
cutoffs of a pool: that of all such strata if their labels suffice, else that of
all strata. So with probability ``1 - level`` the rules together reject no more
than ``risk`` of the good documents of each stratum with cutoffs of its own, and
of the good documents of the pool, mixed as its labels are; a single stratum of a
pool has no bound of its own. If even the pool has too few labels the cutoffs are
null and its strata keep all documents.

Only counts are moved: labelled documents are counted by stratum, label and the
number of cutoffs of each rule they exceed, before any shuffle; a test sees one
row for each such vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, written
from .substring_dedup import repeated

#: Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rule: score over the features, and its cutoffs from lenient to strict.
RULES = {
    "symbols": ("n_symbols / word_chars", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05]),
    "dup_lines": ("n_dup_lines / n_words", [0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]),
    "repeats": ("n_repeat_words / n_words", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08]),
    "long_words": ("word_chars / n_words", [20.0, 18.0, 16.0, 14.0, 13.0, 12.0, 11.0, 10.0]),
    "short_words": ("1.0 * n_words / word_chars", [0.6, 0.55, 0.5, 0.45, 0.4, 0.35, 0.3]),
}
REPEAT_WINDOW = 5


def measure(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """The features of each UTF-8 text (null: all 0)."""
    lists = [(t or b"").split() for t in texts]
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    joined = [b"".join(ws) for ws in lists]
    # Code points: bytes that continue none.
    chars = [len(j) if j.isascii() else len(j.translate(None, bytes(range(0x80, 0xC0)))) for j in joined]
    symbols = [len(j) - len(j.translate(None, SYMBOLS)) for j in joined]
    dup = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in (t or b"").split(b"\n") if x.strip(b" \t\n\v\f\r")]
        dup[i] = len(lines) - len(set(lines))
    flat = [w for ws in lists for w in ws]
    number = dict(zip(set(flat), range(len(flat))))
    owner = np.repeat(np.arange(len(lists)), n)
    # A word's number tells its text too: windows of two texts are never equal.
    ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat)) * len(lists) + owner
    covered = np.zeros(len(flat) + 1, np.int64)
    w, size = REPEAT_WINDOW, len(flat) + 1
    if len(flat) >= w:
        starts = np.flatnonzero(owner[:len(flat) - w + 1] == owner[w - 1:])
        starts = starts[repeated(ids, starts, w)]
        covered = np.bincount(starts, minlength=size) - np.bincount(starts + w, minlength=size)
    inside = np.cumsum(covered)[:-1] > 0
    return {"n_words": n, "word_chars": np.array(chars, np.int64), "n_symbols": np.array(symbols, np.int64),
            "n_dup_lines": dup, "n_repeat_words": np.bincount(owner[inside], minlength=len(lists)).astype(np.int64)}


def features(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Struct ``row`` (columns of ``docs``, the text only if ``keep_text``)
    and the features of each whole text."""
    kept = [c for c in docs.columns if keep_text or c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *[T.StructField(c, T.LongType()) for c in FEATURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                m = measure(part.column(1).cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(m[c]) for c in FEATURES]], schema.names)

    return rows.mapInArrow(run, schema)


def score(rule: str) -> Column:
    """A rule's score; null where a text has no words."""
    a, b = RULES[rule][0].split(" / ")
    return F.try_divide(F.expr(a).cast("double"), F.expr(b).cast("double"))


def base_failed() -> Column:
    """Too short or too repetitive whatever the labels say."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly (to rounding)."""
    if n == 0:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def upper_bound(k: int, n: int, level: float) -> float:
    """Exact (Clopper-Pearson) upper confidence bound of a rate."""
    if k >= n:
        return 1.0
    lo, hi = k / n, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if binomial_tail(k, n, min(max(mid, 1e-300), 1 - 1e-16)) > level else (lo, mid)
    return hi


def fewest(tests: int, risk: float, level: float) -> int:
    """Good labels needed for a test to pass when none of them is rejected."""
    return math.ceil(math.log(level / tests) / math.log1p(-risk))


def path(over: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Steps (rule, cutoff) of the sequence. The rules that reject the most bad
    documents not rejected by those before come first, each with all its
    cutoffs; rules that reject none then take turns. ``over``: cutoffs that
    ``n`` bad documents exceed, by rule."""
    sizes = [len(cutoffs) for _, cutoffs in RULES.values()]
    rest, order, left = list(range(len(sizes))), [], np.ones(len(n), bool)
    while rest:
        gains = [int(n[left & (over[:, r] > 0)].sum()) for r in rest]
        if not max(gains):
            break
        order.append(rest.pop(gains.index(max(gains))))
        left &= over[:, order[-1]] == 0
    return [(r, j) for r in order for j in range(sizes[r])] + [(r, j) for j in range(max(sizes)) for r in rest if j < sizes[r]]


def thresholds(labelled: DataFrame, stratum: str = "stratum", good: str = "good", risk: float = 0.02,
               level: float = 0.05) -> DataFrame:
    """``stratum``, ``rule``, ``cutoff`` (null: none stands), ``pool`` (own,
    small or all: whose labels chose the cutoffs), and of that pool ``n_good``,
    ``n_rejected`` (good labels that all its cutoffs together reject) and
    ``bound`` (upper bound of that rate, null without cutoffs) from labelled
    rows with features.

    Rows whose label is null or that fail the base rules take no part. A null
    stratum is a stratum of its own; one without good labels is left out. No
    labels give an empty result.
    """
    names = list(RULES)
    rows = labelled.where(F.col(good).isNotNull() & ~base_failed())
    # How many of each rule's cutoffs the row exceeds.
    over = [sum((F.coalesce(score(r) > c, F.lit(False)).cast("int") for c in RULES[r][1]), F.lit(0)).alias(f"over_{r}") for r in names]
    keys = [f"over_{r}" for r in names]
    counts = rows.select(F.col(stratum).alias("stratum"), F.col(good).alias("good"), *over).groupBy("stratum", "good", *keys).agg(
        F.count(F.lit(1)).alias("n"))
    counts = written(counts, "label-counts")
    sizes = written(counts.where("good").groupBy(F.col("stratum").alias("_s")).agg(F.sum("n").alias("n_good")), "label-sizes")
    tests = max(1, sizes.count())
    need = fewest(tests, risk, level)
    few = sizes.where(F.col("n_good") < need)
    kind = "small" if (few.agg(F.sum("n_good").alias("n")).first()["n"] or 0) >= need else "all"
    placed = counts.join(sizes, F.col("stratum").eqNullSafe(F.col("_s")))
    nobody = F.lit(None).cast(counts.schema["stratum"].dataType)
    # A pool's documents are counted by vector again: its size does not grow with theirs.
    pooled = (placed.where(F.col("n_good") < need) if kind == "small" else placed).groupBy("good", *keys).agg(F.sum("n").alias("n"))
    pools = placed.where(F.col("n_good") >= need).select(F.lit("own").alias("pool"), "stratum", "good", *keys, "n").unionByName(
        pooled.select(F.lit(kind).alias("pool"), nobody.alias("stratum"), "good", *keys, "n"))
    schema = T.StructType([counts.schema["stratum"], T.StructField("rule", T.StringType()), T.StructField("cutoff", T.DoubleType()),
                           T.StructField("pool", T.StringType()), T.StructField("n_good", T.LongType()),
                           T.StructField("n_rejected", T.LongType()), T.StructField("bound", T.DoubleType())])

    def choose(pdf):
        bad, fine = pdf[~pdf["good"].astype(bool)], pdf[pdf["good"].astype(bool)]
        exceeds, weight = fine[keys].to_numpy(), fine["n"].to_numpy()
        n, k, cutoffs, gone = int(weight.sum()), 0, [None] * len(names), np.zeros(len(weight), bool)
        for r, j in path(bad[keys].to_numpy(), bad["n"].to_numpy()):
            # Cutoffs go from lenient to strict: a row over the j-th is over all after it.
            more = gone | (exceeds[:, r] >= len(RULES[names[r]][1]) - j)
            if binomial_tail(int(weight[more].sum()), n, risk) > level / tests:
                break
            gone, k, cutoffs[r] = more, int(weight[more].sum()), RULES[names[r]][1][j]
        bound = upper_bound(k, n, level / tests) if any(c is not None for c in cutoffs) else None
        out = pdf.iloc[[0] * len(names)].assign(rule=names, cutoff=cutoffs, n_good=n, n_rejected=k, bound=bound)
        return out[schema.names]

    chosen = written(pools.groupBy("pool", "stratum").applyInPandas(choose, schema), "chosen")
    own, shared = chosen.where("pool = 'own'"), chosen.where("pool <> 'own'").drop("stratum")
    return own.unionByName(few.select(F.col("_s").alias("stratum")).crossJoin(shared).select(*schema.names))


def verdicts(measured: DataFrame, cutoffs: DataFrame, stratum: Column) -> DataFrame:
    """Adds ``base_failed``, ``failed_rule`` (the first rule that the row
    fails, null if none) and ``kept``. A stratum without cutoffs fails no rule.
    """
    wide = cutoffs.groupBy(F.col("stratum").alias("_s")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cuts"))
    rows = measured.withColumn("_stratum", stratum)
    rows = rows.join(wide, F.col("_stratum").eqNullSafe(F.col("_s")), "left")
    fails = F.coalesce(*[F.when(score(r) > F.col("_cuts")[r], F.lit(r)) for r in RULES])
    return (rows.withColumn("base_failed", base_failed()).withColumn("failed_rule", fails)
            .withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())
            .drop("_stratum", "_s", "_cuts"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          quality_col: str = "quality", risk: float = 0.02, level: float = 0.05, keep_text: bool = False) -> DataFrame:
    """Every row of ``docs`` (struct ``row``) with its features,
    ``base_failed``, ``failed_rule`` and ``kept``; cutoffs are chosen on the
    documents that ``labels`` (id, quality 0 or 1) covers.

    Null and blank texts fail the base rules. Rows of a null stratum, or of one
    without good labels, are judged by the base rules, and by cutoffs if that
    stratum has good labels. Null ids match no label; a repeated id takes part once a label row
    and document row. Empty tables give an empty result.
    """
    # Measured once and written; the labels then meet numbers, not texts.
    measured = written(features(docs, text_col, keep_text), "features", compression="zstd")
    named = labels.select(F.col(id_col).alias("_id"), (F.col(quality_col) == 1).alias("good")).where("_id is not null and good is not null")
    some = measured.select(F.col("row")[id_col].alias("_doc"), F.col("row")[stratum_col].alias("stratum"), *FEATURES)
    cutoffs = written(thresholds(some.join(named, F.col("_doc") == F.col("_id")), risk=risk, level=level), "cutoffs")
    return verdicts(measured, cutoffs, F.col("row")[stratum_col])
