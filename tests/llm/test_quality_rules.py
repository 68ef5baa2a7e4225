"""The decision list of op3: consumers that filter and join, held-out rows, conjunctions, and covering restated plainly."""

import time
from math import log2

import pytest
from pyspark.sql import functions as F

from lakemill.llm import quality_rules as q
from lakemill.llm.common import crc_mod
from lakemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_the_result_can_be_filtered_joined_and_selected_from(spark):
    got = QUERIES["op3_quality_rules"](spark, SF)
    whole = {r["doc_id"]: r for r in got.collect()}
    assert len(whole) == 1000
    start = time.monotonic()
    assert got.where("kept").count() == sum(r["kept"] for r in whole.values()) > 0
    assert got.where("not base_failed").count() == sum(not r["base_failed"] for r in whole.values()) > 0
    assert got.where("n_repeat_words > 0").select("doc_id").count() == sum(r["n_repeat_words"] > 0 for r in whole.values())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert docs.join(got.where("kept and n_words > 60"), "doc_id", "left_semi").count() == sum(r["kept"] and r["n_words"] > 60 for r in whole.values())
    assert time.monotonic() - start < 60


def test_rules_hold_on_rows_that_they_were_not_learned_from(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = q.apply_rules(spark.read.parquet(f"{SF}/documents.parquet"), labels.where(crc_mod("doc_id", 3) != 1))
    held = got.where("not base_failed").join(labels.where((crc_mod("doc_id", 3) == 1) & F.col("quality").isNotNull()), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in held}
    good, bad = n.get((1, True), 0), n.get((0, False), 0)
    assert good >= 0.95 * (good + n.get((1, False), 0)) and bad >= 0.8 * (bad + n.get((0, True), 0)) and good + bad > 50


def plain_covering(rows, edges, max_rules=6, max_tests=3, min_precision=0.9, min_rows=5):
    """Sequential covering as its description says, over a list of rows: growing by gain, pruning from the end, precision."""

    def holds(rule, r):
        return all((r[c] > v) == (op == ">") for c, op, v in rule)

    def gain(inside, before):
        p, n, p0, n0 = inside.count(0), inside.count(1), before.count(0), before.count(1)
        return p * (log2((p + 1e-9) / (p + n + 1e-9)) - log2((p0 + 1e-9) / (p0 + n0 + 1e-9))) if p else 0.0

    rules, left = [], rows
    while len(rules) < max_rules:
        rule = []
        while len(rule) < max_tests:
            grown = [r for r in left if r["grow"] and holds(rule, r)]
            before = [r["y"] for r in grown]
            if before.count(0) < min_rows or 1 not in before:
                break
            best, choice = 0.0, None
            for c in q.STATS:
                for v in edges[c]:
                    for op in ("<=", ">"):
                        inside = [r["y"] for r in grown if holds([(c, op, v)], r)]
                        if inside.count(0) >= min_rows and inside.count(1) < before.count(1) and gain(inside, before) > best + 1e-9:
                            best, choice = gain(inside, before), (c, op, v)
            if choice is None:
                break
            rule.append(choice)
        if not rule:
            break
        aside = [r for r in left if not r["grow"]]
        worth = []
        for k in range(1, len(rule) + 1):
            ys = [r["y"] for r in aside if holds(rule[:k], r)]
            worth.append((ys.count(0) - ys.count(1)) / max(1, len(ys)))
        rule = rule[: max(range(len(rule)), key=lambda k: (worth[k], -k)) + 1]
        ys = [r["y"] for r in left if holds(rule, r)]
        if len(ys) < min_rows or ys.count(0) < min_precision * len(ys):
            break
        rules.append(rule)
        left = [r for r in left if not holds(rule, r)]
    return rules


def stats_table(spark, rows):
    """rows: (doc_id, y, statistics that are not 0)."""
    cols = ["doc_id long", "y int", *[f"{c} double" for c in q.STATS]]
    return spark.createDataFrame([(i, y, *[float(s.get(c, 0.0)) for c in q.STATS]) for i, y, s in rows], ", ".join(cols))


def conjunction_rows():
    """Bad where symbols and digits are both many; either alone is good; a second kind of bad text has long words."""
    rows = []
    for i in range(1200):
        s, d, w = (i * 37 % 100) / 100, (i * 61 % 100) / 100, 4 + (i * 13 % 40) / 10
        if i % 30 == 7:
            w = 12 + i % 5
        rows.append((i, 0 if (s > 0.5 and d > 0.5) or w > 10 else 1, {"symbol_share": s, "digit_share": d, "mean_word": w}))
    return rows


def test_a_conjunction_of_two_statistics_is_learned(spark):
    sample = stats_table(spark, conjunction_rows())
    rules = q.learn(sample)
    assert any({c for c, _, _ in r} == {"symbol_share", "digit_share"} for r in rules) and any({c for c, _, _ in r} == {"mean_word"} for r in rules)
    judged = sample.select("y", (q.verdict(rules) == 0).alias("kept")).groupBy("y", "kept").count().collect()
    n = {(r["y"], r["kept"]): r["count"] for r in judged}
    assert n.get((0, True), 0) <= 0.05 * n[0, False] and n.get((1, False), 0) <= 0.05 * n[1, True]


@pytest.mark.parametrize("kind", ["fixture", "noise", "documents"])
def test_covering_equals_its_plain_restatement(spark, kind):
    if kind == "fixture":
        sample = stats_table(spark, conjunction_rows())
    elif kind == "noise":
        sample = stats_table(spark, [(i, int(i * 7919 % 11 > 3) if s["symbol_share"] < 0.8 else y, s) for i, y, s in conjunction_rows()])
    else:
        sample = q.labelled_sample(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), 6000)
    sample = q.written(sample)
    edges = q.cut_points(sample, 24)
    rows = [r.asDict() for r in sample.withColumn("grow", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) < 2).collect()]
    assert [r for r in q.learn(sample) if r] == plain_covering(rows, edges)
