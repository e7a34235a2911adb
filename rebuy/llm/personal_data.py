"""Personal data: rule spans, and more spans picked by boosted trees.

Rules find emails, IP addresses, card and phone numbers. Beside them,
generators of high recall propose overlapping spans (a run of digits, one
without spaces, a national phone number, a spelled-out email), each as any
kind it might be. Trees score a proposal by its format and its context; a
cutoff for each kind, calibrated on held-out proposals, selects spans to add.

The labels are weak: a proposal that is a rule's span is right, one that a
rule has refused, that crosses a span of another kind, or that is cut out of
a longer token is wrong. What only the rules look at (the plus sign of a phone
number, the at sign of an email) is no feature, so that the trees judge
proposals the rules do not see. All steps are DataFrame expressions; texts
are read once and never moved.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import trees
from .common import written

KINDS = ("email", "ip", "card", "phone")
#: The rules, so written that a long run is scanned once (a match cannot start
#: inside a run, but where the match before has ended) and not recursively.
RULES = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without these hold no match.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Generators, and the kinds they propose.
GENERATORS = {
    "digits": (r"[+(]?[0-9](?:[\x20().\-/]{0,3}[0-9]){6,}+", ("ip", "card", "phone")),
    "tight": (r"[+(]?[0-9](?:[().\-/]{0,2}[0-9]){6,}+", ("ip", "card", "phone")),
    "national": (r"\(?[0-9]{2,4}\)?[\x20.\-/][0-9]{3,4}[\x20.\-/][0-9]{3,4}", ("phone",)),
    "spelled": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[(\[{]at[)\]}])\x20?[A-Za-z0-9-]{1,63}+"
                r"(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]{1,63}+){1,8}+", ("email",)),
}
PROPOSES = {"digits": r"[0-9](?:[\x20().\-/]{0,3}[0-9]){6}", "tight": r"[0-9](?:[().\-/]{0,2}[0-9]){6}",
            "national": r"[0-9]{2}\)?[\x20.\-/][0-9]{3}", "spelled": r"@|[(\[{]at[)\]}]"}
#: Characters of context on each side.
CONTEXT = 32
#: Least precision on held-out proposals, and the trees' size.
PRECISION, ROUNDS, DEPTH = 0.95, 10, 3
#: Words that stand before each kind.
HINTS = {"email": r"(?i)e-?mail|contact|write", "ip": r"(?i)\bip\b|host|server|address|addr",
         "card": r"(?i)card|visa|credit|payment|\bcc\b", "phone": r"(?i)phone|call|\btel|mobile|fax|cell"}
FEATURES = ("kind", "n_digits", "n_groups", "longest", "n_spaces", "n_dots", "n_hyphens", "n_slashes", "n_brackets", "n_letters",
            "luhn", "octets", "before", "after", "hint", "other_hint")


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes the Luhn check."""
    right = F.rpad(F.reverse(digits), 19, "0")
    doubled = F.translate(right, "0123456789", "0246813579")
    total = sum((F.ascii(F.substring(doubled if i % 2 else right, i + 1, 1)) - 48 for i in range(19)), F.lit(0))
    return total % 10 == 0


def four_octets(text: Column) -> Column:
    return text.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$")


def _hits(name: str, regex: str, needs: str) -> Column:
    """Matches in order, each with the size and the ends of the text between
    it and the match before; the last entry has the rest of the text."""
    entry = F.arrays_zip(
        F.transform(F.split("text", regex, -1), lambda p: F.struct(F.char_length(p).alias("gap"), F.right(p, F.lit(CONTEXT)).alias("tail"),
                                                                   F.left(p, F.lit(CONTEXT)).alias("head"))).alias("p"),
        F.regexp_extract_all("text", F.lit(regex), F.lit(0)).alias("m"))
    none = F.array().cast("array<struct<p:struct<gap:int,tail:string,head:string>,m:string>>")
    return F.when(F.col("text").rlike(needs), entry).otherwise(none).alias(name)


def matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``key`` (unique), ``row`` (columns of ``docs`` but the text) and a list
    of matches for each rule and generator; written."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    hits = [_hits(k, RULES[k], NEEDS[k]) for k in KINDS] + [_hits(g, GENERATORS[g][0], PROPOSES[g]) for g in GENERATORS]
    return written(rows.select("key", "row", *hits), "matches")


def spans(found: DataFrame) -> DataFrame:
    """One row a match: ``key``, ``source`` (rule or generator), ``start``,
    ``end`` (code points), ``match``, ``head`` and ``tail`` (what stands
    before and after it)."""
    sources = [*KINDS, *GENERATORS]

    def of(source: str) -> Column:
        return F.transform(source, lambda x, i: F.struct(F.lit(source).alias("source"), i.alias("i"), x["p"]["gap"].alias("gap"), x["p"]["tail"].alias("tail"),
                                                         x["p"]["head"].alias("head"), x["m"].alias("match")))

    entries = F.concat(*map(of, sources))
    some = " or ".join(f"size({s}) > 1" for s in sources)
    rows = found.where(some).select("key", F.explode(entries).alias("e")).select("key", "e.*")
    order = Window.partitionBy("key", "source").orderBy("i")
    size = F.coalesce(F.char_length("match"), F.lit(0))
    end = F.sum((F.col("gap") + size).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = rows.select("key", "source", (end - size).alias("start"), end.alias("end"), "match", F.col("tail").alias("before_text"),
                      F.lead("head").over(order).alias("after_text"))
    return out.where("match is not null")


def valid(kind: Column, match: Column) -> Column:
    """Whether a rule's match passes the check of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", four_octets(match))
            .when(kind == "card", n.between(16, 19) & luhn(digits)).otherwise(n.between(8, 15)))


def _side(character: Column) -> Column:
    """0 nothing or white space, 1 a letter or digit, 2 another mark."""
    return F.when((character == "") | character.rlike(r"^\s"), 0).when(character.rlike(r"^[\p{L}\p{N}]"), 1).otherwise(2)


def _measured(rows: DataFrame) -> DataFrame:
    """Columns ``FEATURES`` of proposals."""
    m = F.col("match")
    digits = F.regexp_replace(m, "[^0-9]", "")
    count = lambda chars: F.length(F.regexp_replace(m, f"[^{chars}]", ""))
    groups = F.filter(F.split(m, r"[^0-9]+"), lambda g: g != "")
    hint = lambda k: F.col("before_text").rlike(HINTS[k])
    own = F.when(F.col("kind") == KINDS[0], hint(KINDS[0]))
    for k in KINDS[1:]:
        own = own.when(F.col("kind") == k, hint(k))
    any_hint = F.coalesce(*[F.when(hint(k), 1) for k in KINDS], F.lit(0))
    values = {
        "kind": F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), "n_digits": F.length(digits), "n_groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), "n_spaces": count(r"\x20"), "n_dots": count("."),
        "n_hyphens": count(r"\-"), "n_slashes": count("/"), "n_brackets": count(r"()\[\]{}"), "n_letters": count("A-Za-z"),
        "luhn": F.when(F.length(digits).between(12, 19), luhn(digits).cast("int")).otherwise(0), "octets": four_octets(m).cast("int"),
        "before": _side(F.right("before_text", F.lit(1))), "after": _side(F.left("after_text", F.lit(1))),
        "hint": own.cast("int"), "other_hint": F.when(own, 0).otherwise(any_hint),
    }
    return rows.withColumns({f"f_{k}": v.cast("double") for k, v in values.items()})


def proposals(found: DataFrame) -> DataFrame:
    """Proposals with features, ``label`` (1, 0 or null) and ``clear``
    (crosses no valid span of a rule); each beside the rules' spans of its text
    by running maxima, so that no pairs are formed."""
    kinds = F.create_map(*[x for g, (_, ks) in GENERATORS.items() for x in (F.lit(g), F.array(*map(F.lit, ks)))])
    rows = found.withColumn("kind", F.explode(F.coalesce(kinds[F.col("source")], F.array("source")))) \
        .withColumn("rule", F.col("source").isin(*KINDS))
    rows = rows.withColumn("ok", F.col("rule") & valid(F.col("kind"), F.col("match")))
    # Rules of a kind do not overlap each other: the last that starts before a
    # proposal's end tells whether any crosses it.
    order = Window.partitionBy("key").orderBy("at", "late")
    ruled = rows.where("rule").select("key", F.col("start").alias("at"), F.lit(0).alias("late"), F.col("kind").alias("r_kind"),
                                      F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("ok").alias("r_ok"))
    proposed = rows.where("not rule").select("key", F.col("end").alias("at"), F.lit(-1).alias("late"), "kind", "start", "end", "match", "before_text", "after_text")
    # At equal places a proposal's end (exclusive) comes before a rule's start.
    both = ruled.unionByName(proposed, allowMissingColumns=True)
    last = {}
    for k in KINDS:
        rule = F.struct("r_start", "r_end", "r_ok")
        last[k] = F.last(F.when(F.col("r_kind") == k, rule), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = both.select("*", *[v.alias(f"last_{k}") for k, v in last.items()]).where("kind is not null")
    crosses = {k: F.col(f"last_{k}.r_end") > F.col("start") for k in KINDS}
    fine = {k: F.coalesce(crosses[k] & F.col(f"last_{k}.r_ok"), F.lit(False)) for k in KINDS}
    clear, same, other, refused = F.lit(True), F.lit(False), F.lit(False), F.lit(False)
    for k in KINDS:
        mine, rule = F.col("kind") == k, F.col(f"last_{k}")
        clear = clear & ~fine[k]
        # The rule's span, or most of it up to its end.
        exact = (rule["r_end"] == F.col("end")) & (F.col("start") >= rule["r_start"] - 1) \
            & (5 * (F.col("end") - F.col("start")) >= 3 * (rule["r_end"] - rule["r_start"]))
        same = same | (mine & fine[k] & exact)
        other = other | (~mine & fine[k])
        refused = refused | (mine & F.coalesce(crosses[k] & ~rule["r_ok"], F.lit(False)))
    out = _measured(out)
    cut = (F.col("f_before") == 1) | (F.col("f_after") == 1)
    n, kind = F.col("f_n_digits"), F.col("kind")
    shape = F.when(kind == "ip", F.col("f_octets") == 0).when(kind == "card", (F.col("f_luhn") == 0) | (n < 16)) \
        .when(kind == "phone", (n < 7) | (n > 15)).otherwise(F.lit(False))
    label = F.when(same, 1).when(other | refused | cut | shape, 0)
    return out.select("key", "kind", "start", "end", *[f"f_{f}" for f in FEATURES], label.alias("label"), clear.alias("clear"))


def fit(labelled: DataFrame) -> tuple[list, dict[str, float]] | None:
    """Trees of all labelled proposals, and the least score at which at least
    ``PRECISION`` of a kind's held-out proposals above it are right (counting
    one more wrong and one more right one). Every fourth is held out, by hash.
    None without proposals of both labels."""
    fields = [f"f_{f}" for f in FEATURES]
    held = (F.pmod(F.xxhash64("key", "start"), F.lit(4)) == 0).alias("held")
    rows = written(labelled.select("kind", "label", *fields, held).hint("rebalance"), "labelled")
    used = rows.where("not held")
    if len(used.select("label").distinct().limit(2).collect()) < 2:
        return None
    data = VectorAssembler(inputCols=fields, outputCol="features").transform(used.withColumn("label", F.col("label").cast("double")))
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=7, minInstancesPerNode=5).fit(data.select("label", "features"))
    nodes = trees.node_table(model).collect()  # at most ROUNDS x 2^(DEPTH + 1) rows
    # A row for each score: the trees have few, however many the proposals.
    scored = rows.where("held").select("kind", "label", score(nodes).alias("score")) \
        .groupBy("kind", "score").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("kind").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    right, n = F.sum("right").over(above), F.sum("n").over(above)
    cuts = scored.select("kind", "score", ((right + 1) / (n + 2) >= PRECISION).alias("enough")).where("enough") \
        .groupBy("kind").agg(F.min("score").alias("cut")).collect()  # a row a kind
    return nodes, {r["kind"]: r["cut"] for r in cuts}


def score(nodes: list) -> Column:
    """Probability that a proposal is right."""
    return 1 / (1 + F.exp(-2 * trees.margin(nodes, [F.col(f"f_{f}") for f in FEATURES])))


def selected(candidates: DataFrame, model: tuple[list, dict[str, float]]) -> DataFrame:
    """Spans to add: at or above their kind's cutoff, clear of the rules'
    spans and of each other (an earlier and then longer one goes first)."""
    nodes, cuts = model
    cut = F.create_map(*[x for k, v in cuts.items() for x in (F.lit(k), F.lit(v))])
    good = candidates.where("clear and (label is null or label = 1)").withColumn("score", score(nodes))
    good = good.where(F.col("score") >= cut[F.col("kind")])
    # One kind for a span, then runs of overlapping spans: the longest of each.
    order = Window.partitionBy("key").orderBy("start", F.desc("end"), F.desc("score"), "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    good = good.withColumn("fresh", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    good = good.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.min_by(F.struct("kind", "start", "end"), F.struct(F.col("start") - F.col("end"), -F.col("score"), "start", "kind"))
    return good.groupBy("key", "run").agg(best.alias("s")).select("key", "s.kind", "s.start", "s.end")


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Struct ``row`` (columns of ``docs`` but the text), ``base`` and
    ``added``: spans (``rank`` of the kind, ``kind``, ``start``, ``end`` in
    code points, end exclusive) of the rules and of the trees, in order.

    A null text is empty and has no spans. Rows that repeat are documents of
    their own. Without labelled proposals of both kinds (an empty table, say)
    nothing is added. Columns of any name may stand beside the text.
    """
    found = matches(docs, text_col)
    all_spans = written(spans(found), "spans")
    candidates = written(proposals(all_spans), "proposals")
    model = fit(candidates.where("label is not null"))
    rules = all_spans.where(F.col("source").isin(*KINDS)).where(valid(F.col("source"), F.col("match"))) \
        .select("key", F.col("source").alias("kind"), "start", "end", F.lit(True).alias("base"))
    both = rules
    if model and model[1]:
        both = rules.unionByName(selected(candidates, model).withColumn("base", F.lit(False)))
    span = F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank"), "start", "end", "kind")
    lists = both.groupBy("key").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
                                    F.sort_array(F.collect_list(F.when(~F.col("base"), span))).alias("added"))
    lists = lists.withColumnRenamed("key", "_key")
    none = F.array().cast(lists.schema["base"].dataType)
    rows = found.select("key", "row")
    return rows.join(lists, rows["key"] == lists["_key"], "left").select(
        "row", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))


def shown(spans_col: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
