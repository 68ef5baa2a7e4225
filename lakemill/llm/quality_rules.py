"""Quality rules as a learned decision list: sequential covering grows and prunes threshold conjunctions.

Statistics of each text are native expressions. Rules are learned from a bounded sample of labelled statistics: a rule
grows by the (statistic, threshold) test of highest gain on a growing part of the sample, is pruned from its end on
the rest, and is kept while it is precise enough. Each step is one Spark aggregation over the sample into at most
``len(STATS) * bins`` counts. The list becomes one ordered conditional expression (CASE WHEN ... THEN reject).

Defined results: a null or empty text has no words, and so fails the base rule; statistics that divide by zero are 0;
rows with a null label teach nothing; a document labelled twice is learned with its larger label; without labelled
rows, or without a rule precise enough, the list is empty and keeps every row that passes the base rule; every row is
judged by its own text, also those with a null or a repeated doc_id; an empty table gives an empty one; other columns
of docs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: statistics that rules may test; all are shares or means, so that they mean the same in short and long texts
STATS = ["symbol_share", "dup_line_share", "repeat_share", "distinct_share", "mean_word", "upper_share", "digit_share", "mark_share", "line_words"]


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _without(col: Column, chars: str) -> Column:
    return F.length(col) - F.length(F.translate(col, chars, ""))


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the contract and the statistics of every row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("t"))
    d = d.withColumn("w", F.filter(F.split("t", BLANK), lambda x: x != "")).withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_words", F.size("w").cast("long"))
    # one 64-bit hash for each window of three words; equal neighbours in sorted order are the repeated ones
    d = d.withColumn("h", F.when(F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("s", F.sort_array("h"))
    # only a text with a repeated window has them sorted again, with their places
    d = d.withColumn("any", F.size("s") > F.size(F.array_distinct("s")))
    d = d.withColumn("p", F.when(F.col("any"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    twice = F.filter("p", lambda y, i: ((i > 0) & (y["x"] == F.get("p", i - 1)["x"])) | (F.coalesce(y["x"] == F.get("p", i + 1)["x"], F.lit(False))))
    d = d.withColumn("at", F.coalesce(F.sort_array(F.transform(twice, lambda y: y["i"])), F.array().cast("array<int>")))
    # every start covers three words, or as many as lie before the next start
    covered = F.aggregate(F.transform("at", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", covered.cast("long"))
    d = d.withColumn("word_chars", F.length(F.regexp_replace("t", BLANK, "")).cast("long"))
    d = d.withColumn("n_symbols", _without(F.col("t"), SYMBOLS).cast("long"))
    d = d.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    n = F.col("n_words")
    base = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        _share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        _share(F.col("n_dup_lines"), F.size("lines")).alias("dup_line_share"),
        _share(F.col("n_repeat_words"), n).alias("repeat_share"),
        _share(F.size(F.array_distinct("w")), n).alias("distinct_share"),
        _share(F.col("word_chars"), n).alias("mean_word"),
        _share(_without(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.col("word_chars")).alias("upper_share"),
        _share(_without(F.col("t"), "0123456789"), F.col("word_chars")).alias("digit_share"),
        _share(_without(F.col("t"), "!?"), F.col("word_chars")).alias("mark_share"),
        _share(n, F.size("lines")).alias("line_words"),
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """Statistics and label y of about max_train labelled rows at most, drawn by a hash of doc_id."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    total, parts = known.count(), 1 << 20
    take = parts if total <= max_train else int(parts * max_train / total)
    chosen = F.broadcast(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < take))  # bounded by max_train
    rows = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    # written first: a filter on a statistic would otherwise be pushed below, and the statistic computed within itself
    return written(text_stats(rows)).where(~F.col("base_failed")).join(chosen, "doc_id")


def cut_points(sample: DataFrame, bins: int) -> dict[str, list[float]]:
    """Of each statistic 0 and the quantiles of what is not 0, as most statistics are 0 in most texts."""
    some = {c: F.when(F.col(c) > 0, F.col(c)) for c in STATS}
    cuts = sample.agg(*[F.percentile_approx(some[c], [i / bins for i in range(1, bins)], 1000).alias(c) for c in STATS]).first()
    return {c: sorted({0.0, *(cuts[c] or [])}) for c in STATS}


def learn(sample: DataFrame, bins: int = 24, max_rules: int = 6, max_tests: int = 3, min_precision: float = 0.9, min_rows: int = 5) -> list[list[tuple[str, str, float]]]:
    """The decision list: each rule is a list of (statistic, '>' or '<=', threshold) that together mean reject."""
    # each statistic becomes the number of its cut points below the value
    edges = cut_points(sample, bins)
    level = {c: sum([(F.col(c) > e).cast("int") for e in edges[c]], F.lit(0)) for c in STATS}
    grow = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) < 2
    data = written(sample.select("doc_id", "y", grow.alias("grow"), *[level[c].alias(c) for c in STATS]))

    def holds(rule: list[tuple[str, str, int]]) -> Column:
        out = F.lit(True)
        for c, op, k in rule:
            out = out & ((F.col(c) > k) if op == ">" else (F.col(c) <= k))
        return out

    def gain(p: float, n: float, p0: float, n0: float) -> float:
        from math import log2

        return p * (log2((p + 1e-9) / (p + n + 1e-9)) - log2((p0 + 1e-9) / (p0 + n0 + 1e-9))) if p else 0.0

    rules: list[list[tuple[str, str, int]]] = []
    while len(rules) < max_rules:
        left = data
        for r in rules:
            left = left.where(~holds(r))
        rule: list[tuple[str, str, int]] = []
        while len(rule) < max_tests:
            long = left.where(F.col("grow") & holds(rule)).select("y", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("k")) for c in STATS])).alias("s")).groupBy("s.c", "s.k").agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")).collect()
            by = {c: sorted((r["k"], r["bad"], r["good"]) for r in long if r["c"] == c) for c in STATS}
            p0 = sum(x[1] for x in by[STATS[0]])
            n0 = sum(x[2] for x in by[STATS[0]])
            if p0 < min_rows or n0 == 0:
                break
            best = (0.0, None)
            for c in STATS:
                p = n = 0
                for k, bad, good in by[c][:-1]:
                    p, n = p + bad, n + good
                    for op, pp, nn in (("<=", p, n), (">", p0 - p, n0 - n)):
                        if pp >= min_rows and nn < n0 and (g := gain(pp, nn, p0, n0)) > best[0] + 1e-9:
                            best = (g, (c, op, k))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # prune from the end by (p - n) / (p + n) on the rows kept aside; one aggregation counts all prefixes
        aside = left.where(~F.col("grow")).agg(*[F.count_if(holds(rule[:k]) & (F.col("y") == v)).alias(f"c{k}_{v}") for k in range(1, len(rule) + 1) for v in (0, 1)]).first()
        worth = [(aside[f"c{k}_0"] - aside[f"c{k}_1"]) / max(1, aside[f"c{k}_0"] + aside[f"c{k}_1"]) for k in range(1, len(rule) + 1)]
        rule = rule[: max(range(len(rule)), key=lambda k: (worth[k], -k)) + 1]
        all_ = left.where(holds(rule)).agg(F.sum(1 - F.col("y")).alias("p"), F.count("*").alias("n")).first()
        if not all_["n"] or all_["n"] < min_rows or all_["p"] < min_precision * all_["n"]:
            break
        rules.append(rule)
    # a level k means: above k of the cut points; "> k" is value > edges[k], "<= k" is value <= edges[k]
    return [[(c, op, float(edges[c][k])) for c, op, k in r if k < len(edges[c])] for r in rules]


def verdict(rules: list[list[tuple[str, str, float]]]) -> Column:
    """The decision list as one ordered conditional expression: the number of the first rule that rejects, else 0."""
    out, first = F.lit(0), True
    for number, rule in enumerate(rules, 1):
        test = F.lit(True)
        for c, op, v in rule:
            test = test & ((F.col(c) > v) if op == ">" else (F.col(c) <= v))
        out, first = (F.when(test, number) if first else out.when(test, number)), False
    return out if first else out.otherwise(0)


def apply_rules(docs: DataFrame, labels: DataFrame, max_train: int = 6000, **settings) -> DataFrame:
    """Per row of docs: the contract's counts, base_failed, kept and the number of the rule that rejected it."""
    rules = learn(labelled_sample(docs, labels, max_train), **settings)
    used = {c for rule in rules for c, _, _ in rule}
    # written: a filter on the result must not be pushed below the statistics, where it would make their arrays again
    # within array functions; statistics that no rule tests are left out
    stats = text_stats(docs)
    stats = written(stats.select(*[c for c in stats.columns if c not in STATS or c in used]))
    s = stats.withColumn("rule", F.when(F.col("base_failed"), 0).otherwise(verdict(rules)))
    return s.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
