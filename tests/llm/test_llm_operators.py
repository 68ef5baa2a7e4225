"""The ten operators against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import chat_template as ct
from lakemill.llm import decontaminate, html_extract, language_id, license_scan, line_dedup, near_dedup, piece_sampling, quality_classifier, quality_rules
from lakemill.llm.common import CLEANUP, crc_mod, lower_ascii, written

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, *texts, ids=None):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids or range(len(texts)), texts)], DOC)


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return ["wxyz"[v % 4] + "abcdefghij"[v // 4 % 10] + "klmnopqrst"[v // 40] for v in (r.randrange(vocabulary) for _ in range(n))]


# ---- 1 --------------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_band_distance_is_the_edit_distance():
    r = random.Random(5)
    for _ in range(400):
        a = [r.randrange(4) for _ in range(r.randrange(12))]
        b = [x for x in a if r.random() < 0.8] + [r.randrange(4) for _ in range(r.randrange(3))]
        most = r.randrange(6)
        d = distance(a, b)
        assert near_dedup.band_distance(np.array(a, np.uint64), np.array(b, np.uint64), most) == (d if d <= most else None)
    # wide bands
    for _ in range(60):
        a = [r.randrange(30) for _ in range(r.randrange(60, 140))]
        b = [x for x in a if r.random() < 0.9]
        for _ in range(r.randrange(12)):
            b.insert(r.randrange(len(b) + 1), r.randrange(30))
        most, d = r.randrange(40), distance(a, b)
        assert near_dedup.band_distance(np.array(a, np.uint64), np.array(b, np.uint64), most) == (d if d <= most else None)


def test_band_distance_of_long_texts_is_quick():
    import time

    r = np.random.default_rng(3)
    a = r.integers(0, 5000, 20_000).astype(np.uint64)
    b = a.copy()
    at = r.choice(20_000, 3000, replace=False)
    b[at] = r.integers(5000, 9000, 3000)
    start = time.process_time()
    assert near_dedup.band_distance(a, b, 4000) == 3000 and time.process_time() - start < 2


def test_near_duplicates(spark):
    base = words(1, 300)
    near = base[:150] + ["x"] + base[151:]
    far = near[:290] + words(9, 60)
    texts = [" ".join(base), " ".join(near), " ".join(base).upper(), " ".join(words(2, 300)), "", None, "", "a b", "a b", " ".join(far[::-1])]
    d = docs(spark, *texts).unionByName(spark.createDataFrame([(None, " ".join(base), None, None, None)], DOC))
    out = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.near_duplicates(d).collect()}
    assert [out[i][0] for i in range(10)] == [0, 0, 0, 3, 4, 5, 6, 7, 7, 9]
    assert out[None] == (None, True) and [i for i in range(10) if not out[i][1]] == [1, 2, 8]
    kept = near_dedup.drop_near_duplicates(d.withColumn("class_id", F.lit("mine")))
    assert kept.columns == [*DOC.replace(" long", "").replace(" string", "").split(", "), "class_id"] and kept.count() == 8
    assert near_dedup.near_duplicates(d.limit(0)).count() == 0


def test_rows_of_one_doc_id_lose_no_link(spark):
    """Document 3 stands twice: one row is like 1, the other like 4; all three are one class. Ids keep their value."""
    x, y = words(41, 80), words(42, 80)
    big = 9007199254740993
    rows = [(1, x), (3, [*x[:40], "q", *x[41:]]), (3, [*y[:40], "q", *y[41:]]), (4, y), (big, words(43, 60)), (big, words(43, 60)), (None, x)]
    d = spark.createDataFrame([(i, " ".join(w), "mine", 1) for i, w in rows], "doc_id long, text string, node string, class_id int")
    got = near_dedup.near_duplicates(d).collect()
    assert {(r["doc_id"], r["class_id"], r["kept"]) for r in got} == {(1, 1, True), (3, 1, False), (4, 1, False), (big, big, True), (None, None, True)} and len(got) == 7
    kept = near_dedup.drop_near_duplicates(d)
    assert kept.columns == d.columns and sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(["1", str(big), str(big), "None"])


def test_recall_against_brute_force(spark):
    """Every id divisible by 50 against all rows: pairs whose word alignment is 0.8 or more are in one class."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    cls = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(d).collect()}
    ws = {r["doc_id"]: near_dedup.words([r["text"] or ""])[0] for r in d.collect()}
    want = found = 0
    for q in (i for i in ws if i % 50 == 0 and len(ws[i])):
        a = ws[q]
        for i, b in ws.items():
            most = int(0.2 * max(len(a), len(b)) + 1e-9)
            if i != q and len(b) and abs(len(a) - len(b)) <= most and near_dedup.alignable(a, b, most) and near_dedup.band_distance(a, b, most) is not None:
                want, found = want + 1, found + (cls[i] == cls[q])
    assert want >= 5 and found >= 0.9 * want, (found, want)


@pytest.mark.parametrize("even", [False, True])
def test_nine_of_ten_edited_texts_are_found(spark, even):
    """Pairs at and little above the similarity, their edits spread at random or evenly."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(5000)]
    texts, at = [], [0.80, 0.82, 0.85]
    for similarity in at:
        for n in [50, 100, 300, 1000] * 25:
            one = [vocab[min(int(rng.paretovariate(1) * 20), 4999)] for _ in range(n)]
            # rounded down, so that no pair is below the similarity
            edits = int((1 - similarity) * n + 1e-9)
            two = list(one)
            for p in [i * n // edits for i in range(edits)] if even else rng.sample(range(n), edits):
                two[p] = f"new{rng.randrange(10**12)}"
            texts += [" ".join(one), " ".join(two)]
    cls = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs(spark, *texts)).collect()}
    same = [cls[i] == cls[i + 1] for i in range(0, len(texts), 2)]
    found = [sum(same[i : i + 100]) for i in range(0, len(same), 100)]
    assert min(found) >= 90, dict(zip(at, found))
    # texts that are not alike stay apart
    assert len(set(cls.values())) == len(texts) - sum(found)


def test_large_group_of_copies_is_one_class(spark):
    base = words(3, 120)
    texts = [" ".join(base[:k] + ["y"] + base[k + 1 :]) for k in range(120)] + [" ".join(words(100 + k, 80)) for k in range(40)]
    out = near_dedup.near_duplicates(docs(spark, *texts).repartition(7)).groupBy("class_id").count()
    assert sorted(r["count"] for r in out.collect()) == [1] * 40 + [120]


def test_buckets_are_exhausted(spark):
    """Unequally edited copies give the classes of all pairs that share a sketch, not only of those with a leader."""
    r, base = random.Random(11), words(7, 150)
    texts = []
    for i in range(150):
        at = set(r.sample(range(150), r.randrange(12, 22)))
        texts.append(" ".join(f"e{i}x{k}" if k in at else w for k, w in enumerate(base)))
    d = docs(spark, *texts).repartition(5)
    sk = {x["doc_id"]: x["sk"] for x in near_dedup.sketches(d, [(5, 24), (3, 36)], 2).collect()}
    cls = list(range(150))
    for a in range(150):
        for b in range(a):
            if any(x == y for x, y in zip(sk[a], sk[b])) and sum(x != y for x, y in zip(texts[a].split(), texts[b].split())) <= 30:
                old, new = max(cls[a], cls[b]), min(cls[a], cls[b])
                cls = [new if c == old else c for c in cls]
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(d, m=24).collect()}
    assert [got[i] for i in range(150)] == cls and len(set(cls)) < 75


def test_links_that_only_large_buckets_show_are_kept(spark):
    """Pairs that share a passage of many texts and, beside it, no shingle: every second word of the rest is another."""
    passage, texts = words(5, 100), []
    for i in range(120):
        rest = [f"r{i}x{k}" for k in range(50)]
        texts += [" ".join([*passage, *rest])]
        if i < 15:
            texts += [" ".join([*passage, *(w if k % 2 or k > 58 else f"o{w}" for k, w in enumerate(rest))])]
    d = docs(spark, *texts).repartition(5)
    cls = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(d, block=4).collect()}
    assert [cls[2 * i] == cls[2 * i + 1] for i in range(15)] == [True] * 15 and len(set(cls.values())) == 120


def test_pieces_lose_no_pair(spark):
    """The candidates of short and long texts with insertions, deletions, moved and shared words hold all pairs that align."""
    r, rows = random.Random(12), []
    base = [[r.choice("abcdefgh") * r.randrange(1, 4) for _ in range(n)] for n in (1, 2, 3, 5, 6, 9, 10, 14, 25, 60)]
    for i in range(160):
        w = list(r.choice(base))
        for _ in range(r.randrange(1 + len(w) // 4)):
            at = r.randrange(len(w))
            w[at : at + r.randrange(2)] = [f"e{r.randrange(30)}"] * r.randrange(1 + (len(w) > 1))
            w = w or ["a"]
        rows.append((i, i // 2, " ".join(w)))
    d = spark.createDataFrame(rows, "id long, class_id long, text string").repartition(3)
    ws, want = [near_dedup.words([t])[0] for _, _, t in rows], set()
    for b in range(160):
        for a in range(b):
            most = int(0.2 * max(len(ws[a]), len(ws[b])) + 1e-9)
            if a // 2 != b // 2 and near_dedup.band_distance(ws[a], ws[b], most) is not None:
                want.add((a, b))
    # small loads, so that keys are dealt to several tasks and lists
    got = {(x["lo"], x["hi"]) for x in near_dedup.pairs_by_pieces(d, 0.8, load=50, together=3).collect()}
    assert len(want) > 300 and want <= got and all(a // 2 != b // 2 for a, b in got)


def test_pieces_make_no_row_for_a_pair_that_does_not_align(spark):
    """A large group of texts that are nearly alike gives the pairs that align and no others, by pairs of rare runs and by blocks."""
    r, base, rows = random.Random(13), words(17, 100), []
    for i in range(90):
        at = set(r.sample(range(100), r.randrange(7, 17)))
        rows.append((i, i // 2, " ".join(f"e{i}x{k}" if k in at else w for k, w in enumerate(base))))
    rows += [(90 + i, 90 + i, " ".join(["é"] * (90 + i))) for i in range(12)]
    d = spark.createDataFrame(rows, "id long, class_id long, text string").repartition(3)
    ws, want = [near_dedup.words([t])[0] for _, _, t in rows], {}
    for b in range(len(rows)):
        for a in range(b):
            most = int(0.2 * max(len(ws[a]), len(ws[b])) + 1e-9)
            if rows[a][1] != rows[b][1] and (e := near_dedup.band_distance(ws[a], ws[b], most)) is not None:
                want[a, b] = e
    assert 66 < len(want) < 2000
    for settings in ({}, {"few": 1}, {"few": 1, "together": 7, "load": 500}, {"few": 1000}, {"bins": 8}):
        got = [(x["lo"], x["hi"], x["distance"]) for x in near_dedup.pairs_by_pieces(d, 0.8, **settings).collect()]
        assert sorted(got) == sorted((*p, e) for p, e in want.items())


def test_pieces_bring_no_runs_to_the_driver_and_make_no_row_for_one(spark, monkeypatch):
    """Texts of several packs: the driver gathers nothing, and rows are as many as packs and bins, however many runs there are."""
    d = spark.createDataFrame([(i, i // 2, " ".join(words(19, 400)[i % 20 :] + words(i, 9))) for i in range(60)], "id long, class_id long, text string").repartition(3)
    for name in ("toPandas", "collect", "toLocalIterator"):
        monkeypatch.setattr(type(d), name, lambda self, *a, **b: pytest.fail("rows came to the driver"))
    found = near_dedup.pairs_by_pieces(d, 0.8)
    monkeypatch.undo()
    assert found.count() == 60 * 59 // 2 - 30
    packed = near_dedup.packed_runs(d, 2, 16)
    assert packed.count() <= 3 * 16 and packed.selectExpr("sum(size(key))").first()[0] > 20_000


def test_written_tables_leave_no_shuffle_files(spark):
    files = lambda: {n for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if (n := str(f.getName())).startswith("shuffle_")}
    before, df = files(), written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(CLEANUP) == "false" and df.count() == 7


def test_common_words(spark):
    r = random.Random(14)
    texts = [[r.choice("abcdef") for _ in range(40)] for _ in range(7)] + [[]]
    labels, off = near_dedup.shingle_labels(*near_dedup.words([" ".join(t) for t in texts]), 1)
    want = [[sum(min(a.count(c), b.count(c)) for c in set(a)) for b in texts] for a in texts]
    got = near_dedup.common_words(labels, off, 3)
    assert all(got[i][j] == want[i][j] for i in range(8) for j in range(8) if i != j)


def test_components_of_a_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 103), (101, 103)], "lo long, hi long")
    got = {r["id"]: r["class_id"] for r in near_dedup.components(e).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 103)} == {100}


# ---- 2 --------------------------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    shared = " ".join(words(4, 60))
    own = [" ".join(words(50 + i, 30)) for i in range(6)]
    texts = [f"{own[i]}\n{shared}\nuser {i} logged in from host {i * 7} at noon" for i in range(4)] + [own[4] + "\nshort line", "short line", None, "", shared + "\n" + shared]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring(docs(spark, *texts)).collect()}
    assert out[0] == texts[0]  # the first keeps everything
    assert [out[i] for i in (1, 2, 3)] == own[1:4]
    assert out[4] == texts[4] and out[5] == "short line" and out[6] is None and out[7] == "" and 8 not in out
    assert line_dedup.drop_recurring(docs(spark, *texts).limit(0)).count() == 0


def test_line_dedup_merges_variable_words(spark):
    texts = [f"{' '.join(words(60 + i, 30))}\nthis page was printed for {name} by the old press" for i, name in enumerate(["anna", "bert", "carl"])]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring(docs(spark, *texts)).collect()}
    assert out[0] == texts[0] and "\n" not in out[1] and "\n" not in out[2]


def test_rows_of_numbers_stand_for_themselves(spark):
    texts = [f"{' '.join(words(80 + i, 30))}\n{i} {i * 3} {i * 5} {i * 7} {i * 11} total" for i in range(5)]
    assert {r["text"] for r in line_dedup.drop_recurring(docs(spark, *texts)).collect()} == set(texts)


def test_line_dedup_leaves_pairs_alone(spark):
    texts = ["\n".join(" ".join(words(i, 20)) for i in range(4))] * 2
    assert {r["text"] for r in line_dedup.drop_recurring(docs(spark, *texts)).collect()} == {texts[0]}


def test_line_dedup_of_long_pairs_and_short_notices(spark):
    own, passage, line = [" ".join(words(900 + i, 30)) for i in range(60)], " ".join(words(33, 60)), " ".join(words(34, 20))
    texts = [f"{x}\nall rights reserved" + (f"\n{passage}\n{line}\nto be continued" if i in (5, 9) else "") for i, x in enumerate(own)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring(docs(spark, *texts)).collect()}
    assert out[0] == texts[0] and all(out[i] == own[i] for i in range(1, 60) if i not in (5, 9))
    assert out[5] == f"{own[5]}\n{passage}\n{line}\nto be continued" and out[9] == f"{own[9]}\n{line}\nto be continued"


def test_every_template_of_a_leaf_is_found(spark):
    """Two templates begin alike and have as many tokens; the smaller one recurs as well, and so does a line of four tokens."""
    own = [" ".join(words(700 + i, 30)) for i in range(14)]
    one = [f"please note that the page {w} was written by the old press" for w in ("abba", "bach", "cher", "dido", "enya", "falco")]
    two = [f"please note that no dogs or {w} may enter the garden today" for w in ("cats", "cows", "pigs", "rats")]
    assert len({len(x.split()) for x in one + two}) == 1
    texts = [f"{o}\n{x}" for o, x in zip(own, one + two)] + [f"{o}\nall rights reserved here" for o in own[10:]]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring(docs(spark, *texts)).collect()}
    assert [i for i in range(14) if out[i] == texts[i]] == [0, 6, 10] and all(out[i] == own[i] for i in range(14) if i not in (0, 6, 10))


def brute_templates(lines, similarity):
    """The groups of a leaf's masked forms (with their line counts) by the plain recursion."""
    from collections import Counter

    done, todo = {}, [((), lines)]
    while todo:
        name, part = todo.pop()
        if len(part) < 2 or sum(part.values()) < 3:
            continue
        n = len(next(iter(part)))
        votes = [Counter() for _ in range(n)]
        for form, c in part.items():
            for k, t in enumerate(form):
                votes[k][t] += c
        total = sum(part.values())
        top = [max(v.items(), key=lambda x: (x[1], x[0])) for v in votes]
        fixed = [t if 2 * c > total else None for t, c in top]
        rest = {}
        for form, c in part.items():
            if sum(a == b for a, b in zip(form, fixed)) >= similarity * n - 1e-9:
                done[form] = name
            else:
                rest[form] = c
        split = [(sum(c * c for c in v.values()) / total / total, -k) for k, v in enumerate(votes) if len(v) > 1]
        if split:
            at = -max(split)[1]
            for tok in {f[at] for f in rest}:
                todo.append(((*name, at, tok), {f: c for f, c in rest.items() if f[at] == tok}))
    return done


def test_templates_are_those_of_the_plain_recursion(spark):
    r = random.Random(12)
    heads = ["start here now", "other leading words"]
    lines = []
    for _ in range(260):
        form = r.choice(["a b c d e f g", "a b x y z f g", "m n o p q r s"]).split()
        for k in r.sample(range(7), r.randrange(3)):
            form[k] = r.choice("uvwxyz") * 2
        lines.append(f"{r.choice(heads)} {' '.join(form)}")
    d = docs(spark, *lines)
    keys = line_dedup._keys(d.select("doc_id", "text"), 3)
    enough = F.when(F.col("n_tokens") >= 50, 2).otherwise(3)
    got = {x["form"]: x["template"] for x in line_dedup.grouped_forms(d.select("doc_id", "text"), keys, 3, 0.8, enough).collect()}
    forms = {x["line"]: x["form"] for x in spark.createDataFrame([(x,) for x in set(lines)], "line string").select("line", F.xxhash64("line").alias("form")).collect()}
    want = {}
    for h in heads:
        counts = {}
        for x in lines:
            if x.startswith(h):
                counts[tuple(x.split())] = counts.get(tuple(x.split()), 0) + 1
        want |= {forms[" ".join(f)]: (h, *name) for f, name in brute_templates(counts, 0.8).items()}
    assert set(got) == set(want) and len(set(want.values())) > 3
    assert len(set(zip(got.values(), (want[f] for f in got)))) == len(set(got.values())) == len(set(want.values()))


def test_line_dedup_of_odd_tables(spark):
    """Clashing names, null and repeated ids (each row loses its own lines), white space, many lines in one text."""
    note, own = "this notice is on many a page", [" ".join(words(800 + i, 20)) for i in range(9)]
    rows = [(1, f"{own[0]}\n{note}"), (2, f"{own[1]}\r\n  {note}\t"), (3, f"{note}\n{own[2]}"), (3, f"{own[3]}\n{own[4]}"), (None, f"{own[5]}\n{note}"), (4, "\n".join([note, *(f"{own[6]} x{i}y z{i}" for i in range(1)), *([note] * 3000)]))]
    d = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, _gone int, _doc int, _row int, _lines int")
    out = line_dedup.drop_recurring(d)
    assert out.columns == d.columns
    got = sorted((str(r["doc_id"]), r["text"]) for r in out.collect())
    assert got == sorted([("1", rows[0][1]), ("2", f"{own[1]}\r"), ("3", own[2]), ("3", rows[3][1]), ("None", rows[4][1]), ("4", f"{own[6]} x0y z0")])


# ---- 3 --------------------------------------------------------------------------------------------------------------


def brute_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for k in range(len(w) - 2):
        seen.setdefault(tuple(w[k : k + 3]), []).append(k)
    cover = {x for v in seen.values() if len(v) > 1 for k in v for x in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)


def test_text_stats(spark):
    texts = [None, "", " \n\t", "a b c a b c a", "x x x x", "é# b c\n\na|\na|", "one\r\ntwo", "a b\x0bc d " * 50, "日本 語 *** 日本 語 ***"]
    got = {r["doc_id"]: r for r in quality_rules.text_stats(docs(spark, *texts)).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_symbols"], got[i]["n_dup_lines"], got[i]["n_repeat_words"]) == brute_stats(t), t


def test_rules_learn_and_keep(spark):
    good = [" ".join(f"word{i}x{j}" for j in range(80)) for i in range(120)]
    bad = [" ".join(f"w{i}x{j}##%%" for j in range(80)) for i in range(40)]
    d = docs(spark, *good, *bad, None, "", "too short")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(160)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in quality_rules.apply_rules(d, labels).collect()}
    assert all(out[i]["kept"] for i in range(120)) and not any(out[i]["kept"] for i in range(120, 163))
    assert [out[i]["base_failed"] for i in (0, 130, 160, 161, 162)] == [False, False, True, True, True]
    none = quality_rules.apply_rules(d, labels.limit(0))
    assert none.where("kept").count() == 160


def test_base_columns_are_those_of_sql(spark):
    """The counts of every document by DuckDB SQL."""
    duckdb = pytest.importorskip("duckdb")
    path = "/root/testdata/sf0.01/documents.parquet"
    want = duckdb.sql(f"""
      WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM '{path}'),
      k AS (SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
      twice AS (SELECT doc_id, g FROM k GROUP BY 1, 2 HAVING count(*) > 1),
      covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM k JOIN twice USING (doc_id, g)) GROUP BY 1),
      l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY 1)
      SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(l.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words FROM d LEFT JOIN l USING (doc_id) LEFT JOIN covered USING (doc_id)""").fetchall()
    got = quality_rules.text_stats(spark.read.parquet(path)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(map(int, r)) for r in want)


def test_statistics_of_long_and_repeated_texts_are_quick(spark):
    import time

    long = " ".join(words(5, 60_000, 40))
    d = docs(spark, long, long[: len(long) // 2] + " " + long[: len(long) // 2])
    start = time.time()
    got = quality_rules.text_stats(d).collect()
    assert time.time() - start < 20 and sorted(r["n_repeat_words"] for r in got) == sorted(brute_stats(t)[4] for t in (long, long[: len(long) // 2] + " " + long[: len(long) // 2]))
    assert quality_rules.apply_rules(d.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


# ---- 4 --------------------------------------------------------------------------------------------------------------


def test_segmentations_decode_and_differ(spark):
    texts = ["hello world", "", None, "a  b\n\tc", "日本語 ▁ \U0001f600", "x" * 3000, "Ouwhea the of rend " * 40]
    enc = piece_sampling.encode(docs(spark, *texts), k=3)
    out = piece_sampling.decode(enc).collect()
    assert all(r["round_trip"] and r["text"] == (texts[r["doc_id"]] or "") for r in out)
    assert all(0 < r["inclusion"] <= 1 or r["log_prob"] < -30 for r in out)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(tuple(r["ids"]))
    assert all(len(set(v)) == len(v) for v in by.values()) and len(by[1]) == len(by[2]) == 1 and len(by[0]) == 3
    again = {(r["doc_id"], r["sample_no"]): tuple(r["ids"]) for r in piece_sampling.encode(docs(spark, *texts).repartition(3), k=3).collect()}
    assert all(tuple(r["ids"]) == again[r["doc_id"], r["sample_no"]] for r in out)


def sampled(texts, keys, k):
    """Per text the list of (ids, log probability, perturbed value) and the threshold."""
    paths, kappa = piece_sampling.sample(texts, keys, k, lat := piece_sampling.Lattice())
    out = []
    for i in range(len(texts)):
        own = [p for p in paths if p.value[i] > -np.inf]
        out.append(([(tuple(lat.id[p.edge[p.offset[i] : p.offset[i + 1]]].tolist()), p.logp[i], p.value[i]) for p in own], kappa[i]))
    return out


def enumerated(text):
    """All segmentations of a text with their probabilities, unit by unit, from the vocabulary itself."""
    pieces, raw, _ = piece_sampling.vocabulary(piece_sampling.MODEL)

    def unit(u):
        if not u:
            return [((), 0.0)]
        heads = [(1, tuple(raw[x] for x in u[0].encode()), piece_sampling.FALLBACK / 2)] if u[0] not in pieces else []
        heads += [(n, (pieces[u[:n]][0],), pieces[u[:n]][1] / 2) for n in range(1, len(u) + 1) if u[:n] in pieces]
        return [(ids + more, w + v) for n, ids, w in heads for more, v in unit(u[n:])]

    out = [((), 0.0)]
    for u in re.findall(r" *[^ ]+| +", text):
        out = [(a + b, v + w) for a, v in out for b, w in unit(u)]
    total = np.logaddexp.reduce([w for _, w in out])
    return {ids: w - total for ids, w in out}


def test_sampling_follows_the_lattice():
    """Samples are the lattice's segmentations with their exact probabilities; a second is drawn from what the first leaves."""
    n, text = 4000, "hello the"
    every, keys = enumerated(text), piece_sampling.mix(np.arange(n, dtype=np.uint64))
    got = sampled([text] * n, keys, 2)
    first, pairs = {}, {}
    for (a, b), kappa in got:
        assert a[2] > b[2] > kappa and a[0] != b[0]
        assert a[1] == pytest.approx(every[a[0]]) and b[1] == pytest.approx(every[b[0]])
        first[a[0]] = first.get(a[0], 0) + 1
        pairs[a[0], b[0]] = pairs.get((a[0], b[0]), 0) + 1
    for ids, lp in every.items():
        p = np.exp(lp)
        assert abs(first.get(ids, 0) - n * p) < 5 * (n * p * (1 - p)) ** 0.5 + 3
    for (a, b), c in pairs.items():
        p = np.exp(every[a] + every[b]) / (1 - np.exp(every[a]))
        assert abs(c - n * p) < 5 * (n * p) ** 0.5 + 3


def test_all_segmentations_come_out_and_thresholds_are_the_next_value():
    for text in ("is", "é!", "日", "a", "ab", "the"):
        every = enumerated(text)
        (found, kappa), key = sampled([text], np.array([5], np.uint64), len(every) + 3)[0], np.array([5], np.uint64)
        assert {f[0] for f in found} == set(every) and kappa == -np.inf
        values = [f[2] for f in found]
        assert values == sorted(values, reverse=True)
        for k in range(1, len(every)):
            (some, bound) = sampled([text], key, k)[0]
            assert [f[0] for f in some] == [f[0] for f in found[:k]] and bound == pytest.approx(values[k])


def test_samples_do_not_depend_on_neighbours(monkeypatch):
    texts = [" ".join(words(i, 5 + i)) for i in range(12)] + ["", "  ", "x" * 200]
    keys = piece_sampling.mix(np.arange(len(texts), dtype=np.uint64))
    together = sampled(texts, keys, 3)
    alone = [sampled([t], keys[i : i + 1], 3)[0] for i, t in enumerate(texts)]
    assert [[f[0] for f in a[0]] for a in together] == [[f[0] for f in a[0]] for a in alone]
    monkeypatch.setattr(piece_sampling.Lattice, "most", 10)  # a lattice that starts over again and again
    lat = piece_sampling.Lattice()
    for i, t in enumerate(texts):
        row, _, ids, offsets, *_ = piece_sampling.segmentations([t], keys[i : i + 1], 3, lat)
        assert [tuple(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])] == [f[0] for f in alone[i][0]]


def test_segmentations_of_odd_tables(spark):
    rows = [(9007199254740993, "ab cd"), (None, "ab cd"), (9007199254740993, "ab cd"), (2, None)]
    df = spark.createDataFrame([(i, t, [1], "n") for i, t in rows], "doc_id long, text string, ids array<int>, sample_no string")
    out = piece_sampling.decode(piece_sampling.encode(df)).collect()
    assert sorted({str(r["doc_id"]) for r in out}) == ["2", "9007199254740993", "None"] and all(r["round_trip"] for r in out)
    twice = [tuple(r["ids"]) for r in out if r["doc_id"] == 9007199254740993]
    assert len(twice) == 4 and len(set(twice)) == 2
    assert piece_sampling.encode(df.limit(0)).count() == 0


# ---- 5 --------------------------------------------------------------------------------------------------------------


def brute_contamination(texts, items):
    wins = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(FOLD))
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = {}
    for d, t in enumerate(texts):
        w, hit, found = WORD.findall((t or "").translate(FOLD)), set(), set()
        for x, ids in wins.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found |= ids
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


def test_contamination(spark):
    q = words(7, 25)
    items = [(1, " ".join(q)), (2, "Few, words here"), (3, "..."), (4, None), (10, " ".join(q[3:15])), (11, "one"), (12, "É é"), (13, "ab ab ab ab ab ab ab ab ab ab ab")]
    texts = [
        "intro " + " ".join(q) + " outro", " ".join(q[5:]), " ".join(q[:9]), " ".join(q[15:25]) + " z", "FEW words; here and few words", None, "", "one", "É é É", "ab " * 30, " ".join(q) + " " + " ".join(q), "é é",
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contamination(docs(spark, *texts), bench).collect()}
    assert {d: v[:5] for d, v in out.items()} == brute_contamination(texts, items)
    near = brute_near(texts, items, 3)
    assert {d: v[5] for d, v in out.items()} == {d: len({i for x, i, *_ in near if x == d}) for d in range(len(texts))}
    clean = decontaminate.drop_contaminated(docs(spark, *texts), bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, v in out.items() if not v[4])
    none = decontaminate.contamination(docs(spark, *texts), bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(texts)
    assert decontaminate.contamination(docs(spark, "x").limit(0), bench).count() == 0


def brute_near(texts, items, slack):
    """(text, item, first, start) of all windows near a start, by trying every start: one of the slack + 1 rarest pairs at its place, and all words around."""
    from collections import Counter

    ws = [WORD.findall((t or "").translate(FOLD)) for t in texts]
    cf = Counter(p for w in ws for p in zip(w, w[1:]))
    out = set()
    for i, t in items:
        w = WORD.findall((t or "").translate(FOLD))
        n = min(10, len(w))
        for f in range(len(w) - n + 1) if w else ():
            win = w[f : f + n]
            pairs = sorted(((cf[p], k) for k, p in enumerate(zip(win, win[1:]))), key=lambda x: x)[: slack + 1]
            for d, x in enumerate(ws):
                for s in range(-n, len(x)):
                    if s < 0:
                        continue
                    anchored = any(s + k + 1 < len(x) and (x[s + k], x[s + k + 1]) == (win[k], win[k + 1]) for c, k in pairs if c)
                    if n == 1:
                        anchored = x[s] == win[0]
                    if anchored and set(win) <= set(x[max(0, s - slack) : s + n + slack]):
                        out.add((d, i, f, s))
    return out


def test_proximity_is_what_brute_force_finds(spark):
    q, z = words(8, 30), words(21, 14, 12)
    edited = q[:6] + ["new"] + q[6:13] + ["words", "in"] + q[13:]
    texts = [" ".join(q[:4] + [q[5], q[4]] + q[6:]), " ".join(words(9, 30)), " ".join(edited), "pad " + " ".join(q), " ".join(z + z[::-1]), " ".join(words(22, 60, 12)), None, "one two", q[3] + " " + " ".join(q[:10])]
    items = [(1, " ".join(q)), (2, " ".join(z)), (3, "two"), (4, "one  TWO"), (5, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index, its = decontaminate.positional_index(docs(spark, *texts)), decontaminate.items_of(bench)
    ids, names = {r["row"]: r["doc_id"] for r in index.collect()}, {r["item"]: r["item_id"] for r in its.collect()}
    terms = decontaminate.counted_terms(index, its)
    got = {(ids[r["row"]], names[r["item"]], r["first"], r["start"]) for r in decontaminate.proximity_matches(index, its, terms).collect()}
    want = brute_near(texts, items, 3)
    assert got == want and {0, 2, 3} <= {d for d, *_ in want}
    out = {r["doc_id"]: r for r in decontaminate.contamination(docs(spark, *texts), bench).collect()}
    assert {d: r["n_near"] for d, r in out.items()} == {d: len({i for x, i, *_ in want if x == d}) for d in range(len(texts))}
    assert out[0]["n_hit"] > 0 or out[0]["n_near"] > 0


def test_rows_are_judged_by_their_own_words(spark):
    q = words(31, 12)
    bench = spark.createDataFrame([(1, " ".join(q))], "item_id long, text string")
    halves, whole = [(7, " ".join(q[:6])), (7, "a b " + " ".join(q[6:]))], [(None, " ".join(q)), (8, " ".join(q)), (8, " ".join(q)), (8, "clean words"), (9007199254740993, " ".join(q))]
    d = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in halves + whole], DOC).withColumn("row", F.lit(1)).withColumn("_h", F.lit(2))
    out = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"]) for r in decontaminate.contamination(d, bench).collect())
    assert out == sorted([("7", 6, 0), ("7", 8, 0), ("None", 12, 12), ("8", 12, 12), ("8", 12, 12), ("8", 2, 0), ("9007199254740993", 12, 12)])
    kept = decontaminate.drop_contaminated(d, bench)
    assert kept.columns == d.columns and sorted(r["text"] for r in kept.collect()) == sorted([t for _, t in halves] + ["clean words"])


# ---- 6 --------------------------------------------------------------------------------------------------------------


def test_license_scan(spark):
    texts = ["Released under the MIT License.", "x relaesed under teh mit licence y", "GNU General\nPublic-License and CC-BY, mit license", None, "", "permitlicense", "Licensed under CC BY-NC 4.0. " + "pad " * 30000 + "apache license"]
    out = {r["doc_id"]: r for r in license_scan.scan(docs(spark, *texts)).collect()}
    assert (out[0]["n_base"], out[0]["first_word"], out[0]["labels"], out[0]["base_labels"]) == (1, 3, "mit", "mit")
    assert (out[1]["n_base"], out[1]["base_labels"], out[1]["labels"]) == (0, "", "") or out[1]["labels"] == "mit"
    assert (out[2]["n_base"], out[2]["first_word"], out[2]["last_word"], out[2]["base_labels"]) == (3, 0, 7, "cc-by,gpl,mit")
    assert all((out[i]["n_base"], out[i]["labels"], out[i]["score"], out[i]["first_word"]) == (0, "", 0.0, None) for i in (3, 4, 5))
    assert out[6]["base_labels"] == "apache,cc-by" and out[6]["last_word"] == 30007 and "cc-by-nc-4.0" in out[6]["labels"]


def test_pigeonhole_finds_what_a_full_search_finds():
    """Candidates are those of a fuzzy search of every notice over the whole text, with span, label and similarity."""
    import regex

    r = random.Random(3)
    some = [license_scan.NOTICES[i] for i in range(0, len(license_scan.NOTICES), 5)]
    scanner = license_scan.Scanner(some)
    for notice, label in some:
        k, words_ = license_scan.edits(notice), license_scan.telling(notice)
        for _ in range(6):
            t = list(notice)
            for _ in range(r.randrange(k + 2)):
                p = r.randrange(len(t))
                t[p] = r.choice("abz ") if r.random() < 0.5 else t[p] + "q"
            text = "zz yy " + "".join(t) + " xx"
            m = regex.search(f"(?b)(?:{regex.escape(notice)}){{e<={k}}}", text)
            fits = m and license_scan.telling(license_scan.grown(text, m.start(), m.end())) == words_
            got = [c for c in scanner.candidates(text) if c[2] == label]
            if fits:
                best = 1 - sum(m.fuzzy_counts) / len(notice)
                assert any(c[3] >= best - 1e-9 and c[0] < m.end() and m.start() < c[1] for c in got), (notice, text)
            for a, z, _, like in got:  # and nothing that a full search denies
                assert any(regex.fullmatch(f"(?:{regex.escape(n)}){{e<={round((1 - like) * len(n))}}}", text[a:z]) for n, x in some if x == label)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("licensed under cc by-nd 4.0", {"cc-by", "cc-by-nd-4.0"}),
        ("licensed under cc by 3.0", {"cc-by", "cc-by-3.0"}),
        ("Licensed under CC BY-NC-SA 4.0.", {"cc-by", "cc-by-nc-sa-4.0"}),
        ("licensed under the gnu general public license, version 1", {"gpl", "gpl-1.0"}),
        ("licensed under the gnu generl public licence, version 3", {"gpl-3.0"}),
        ("licensed under the apache license, version 1.1", {"apache", "apache-1.1"}),
        ("licensed under the apache licence, version 2.0", {"apache-2.0"}),
        ("licensed under the bsd 2-clause license", {"bsd-2-clause"}),
        ("licensed under the ms license", set()),
        ("relased under the mit licence", {"mit"}),
        ("you need a permit license here", set()),
        ("gnu lesser general public license version 2.1", {"lgpl-2.1"}),
        ("a short note on public places", set()),
    ],
)
def test_what_tells_licences_apart_is_not_edited(spark, text, labels):
    r = license_scan.scan(docs(spark, text)).first()
    assert set(filter(None, r["labels"].split(","))) == labels and 0 <= r["score"] <= 1
    for f in r["found"]:
        assert text.lower()[f["start"] : f["end"]].strip()


def test_license_scan_of_odd_tables(spark):
    d = spark.createDataFrame([(9007199254740993, "mit license", 1), (None, "x", 2), (9007199254740993, "mit license", 1)], "doc_id long, text string, found int")
    out = [tuple(r)[:2] for r in license_scan.scan(d).collect()]
    assert sorted(map(str, out)) == sorted(map(str, [(9007199254740993, 2), (9007199254740993, 2), (None, 1)]))
    assert license_scan.scan(d.limit(0)).count() == 0


# ---- 7 --------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>if(a<b){{x="</p>"}}</script></head><body class="has-menu"><header>top</header><nav><ul><li><a>menu</a><li>two</ul></nav>
<div class="ad">buy</div><article><h1>Head &amp; line</h1><p>First <b>bo</b>ld&nbsp;text {0}<p>Second<br>row<form>f</form><aside>s</aside></article><div id="comments"><p>c</p></div><footer>f</footer></body></html>"""


def test_html(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(8)] + [(8, None, None), (9, "x", ""), (10, "http://h.example", "<p>a<p>b</div>tail < 5")]
    out = {r["page_id"]: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i]["text"] == f"Head & line First bold text {i} Second row" for i in range(8))
    assert out[8]["text"] == out[9]["text"] == "" and out[10]["text"] == "a b tail < 5"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string, html string")


def test_style_tree_cuts_unmarked_templates(spark):
    page = "<html><body><div class=x1><p>the same strip on all pages</p></div><div class=x2>{}</div></body></html>"
    rows = [(i, "http://a.example/", page.format("".join(f"<p>{' '.join(words(i * 10 + k, 12))}</p>" for k in range(1 + i % 4)))) for i in range(20)]
    df = pages(spark, *rows)
    assert all("same strip" not in r["text"] and len(r["text"]) > 20 for r in html_extract.extract(df).collect())
    alike = df.withColumn("html", F.lit("<div><h1>head</h1><p>only text of them all</p></div>"))
    assert {r["text"] for r in html_extract.extract(alike).collect()} == {"head only text of them all"}
    assert all("same strip" not in r["text"] for r in html_extract.extract(df.where("page_id < 3")).collect())
    assert "same strip" in html_extract.extract(df.where("page_id < 1")).first()["text"]


def test_style_tree_extracts_pages_whose_names_say_nothing(spark):
    """No article, no main, no nav, classes at random for each host: what the pages have in common goes, what they are about stays."""
    r, rows, want = random.Random(9), [], {}
    for host in range(3):
        c = [f"q{r.randrange(10**6)}" for _ in range(6)]
        for i in range(7):
            n = host * 10 + i
            title, body = " ".join(words(500 + n, 6)), [" ".join(words(600 + 20 * n + k, 25)) for k in range(2 + i % 3)]
            rows.append((n, f"http://h{host}.example/{i}", f'<html><head><title>t</title></head><body><div class={c[0]}><ul><li><a href=/>home</a><li><a href=/n>news {host}</a></ul></div><div class={c[1]}>we use biscuits on this site</div><div class={c[2]}><h1 class={c[5]}>{title}</h1>{"".join(f"<p>{x}</p>" for x in body)}</div><div class={c[3]}><p>about us</p><p>all rights reserved {host}</p></div></body></html>'))
            want[n] = " ".join([title, *body])
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages(spark, *rows)).collect()}
    assert got == want
    plain = {r["page_id"]: r["text"] for r in html_extract.extract(pages(spark, *rows), tree=False).collect()}
    assert all(plain[n] != want[n] for n in want)  # it is the tree that does it


def test_importance_is_that_of_the_plain_recursion(spark):
    from math import log

    r = random.Random(4)
    htmls = [f"<body><div class=a><p>menu</p><p>{'x' if i % 3 else 'y'}</p></div><div class=b><h2>{' '.join(words(i, 3))}</h2>{'<p>z ' + str(i // 2) + '</p>' * (i % 2)}<b>{r.choice('uv')}</b>tail</div></body>" for i in range(7)]
    each = [{n[0]: n for n in html_extract.page_nodes(h)} for h in htmls]
    kids = {}
    for page in each:
        for k, n in page.items():
            if k:
                kids.setdefault(n[1], set()).add(k)

    def at(k):
        on = [p for p in each if k in p]
        m = len(on)
        if m == 1:
            return 1.0
        count = lambda xs: [xs.count(x) for x in set(xs)]
        styles = count([p[k][3] for p in on])
        node = -sum(c / m * log(c / m, m) for c in styles)
        texts = [p[k][4] for p in on if p[k][4] is not None]
        unlike = 1 - sum(c * log(c) for c in count(texts)) / len(texts) / log(m) if texts else 1.0
        mean = 0.0
        for p in on:
            mean += (p[k][6] * unlike + sum(p[c][5] * at(c) for c in kids.get(k, ()) if c in p)) / m
        w = 0.9 ** len(styles)
        return (1 - w) * node + w * min(1.0, mean)

    got = {r["node"]: r["importance"] for r in html_extract.style_tree(pages(spark, *((i, "http://a/", h) for i, h in enumerate(htmls)))).collect()}
    assert len(got) >= 6 and all(v == pytest.approx(at(k)) for k, v in got.items())


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<div class="sidebar-left"><article><p>body</p></article></div>', "body"),
        ('<div class="entry comments-open"><p>body of it</p></div>', "body of it"),
        ('<div id="notice-board-history"><p>body</p></div>', "body"),
        ("<form action=x><div><h1>t</h1><p>the whole page is in a form</p></div></form>", "t the whole page is in a form"),
        ("<main><h1>Title</h1><article><p>body</p></article></main>", "Title body"),
        ('<article><div class="article-header"><h1>Title</h1></div><p>body</p></article>', "Title body"),
        ("<article><header><h1>Title</h1></header><p>body</p><footer>f</footer></article>", "Title body"),
        ('<article><h2 id="related-work">Related work</h2><p>body</p></article><aside>a</aside>', "Related work body"),
        ("<article><p>a</p><select><option>x</article><p>b</p>", "a"),
        ("<p>a<button>go</p><p>b</p>", "a b"),
        ('<body><nav>menu</nav><p>body text</p><div class="cookie-banner">c</div><div id="comment-list"><p>c1</p></div></body>', "body text"),
        ("<body><nav>menu only</nav><footer>f</footer></body>", ""),
        ("<article><p>x &lt;b&gt; &amp; y&nbsp;z</p><script>var a='</p>';</script><textarea>t</textarea></article>", "x <b> & y z"),
    ],
)
def test_pages_by_what_they_declare(html, text):
    assert html_extract.page_text(html) == text


def test_html_of_odd_tables(spark):
    df = pages(spark, (9007199254740993, "http://a/", "<p>x</p>"), (None, None, "<p>y</p>"), (9007199254740993, "http://a/", "<p>x</p>"), (3, "http://a/", "<p>" + "long " * 50_000)).withColumn("host", F.lit("mine")).withColumn("cut", F.lit(1))
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(str((r["page_id"], r["n_chars"])) for r in out.collect()) == sorted(["(9007199254740993, 1)", "(9007199254740993, 1)", "(None, 1)", "(3, 249999)"])
    assert html_extract.extract(df.limit(0)).count() == 0


# ---- 8 --------------------------------------------------------------------------------------------------------------


def brute_rank(text, size):
    """The n-gram list of a text, made the plain way."""
    from collections import Counter

    c = Counter()
    for w in "".join(x if x.isalpha() else " " for x in text.lower()).split():
        p = f" {w} "
        c.update(w)
        c.update(p[i : i + 2] for i in range(len(p) - 1))
        c.update(p[i : i + 3] for i in range(len(p) - 2))
    return c


def test_ngram_counts_are_those_of_padded_words():
    for t in ["Hello, world", "a", "", "1 2 3", "Été à la Plage!", "日本語 text"]:
        keys = language_id.ngrams(t, {})
        kinds, n = np.unique(keys, return_counts=True)
        want = brute_rank(t, 0)
        assert sorted(n.tolist()) == sorted(want.values())


def test_language_id(spark):
    en, de = "the quick brown fox jumps over the lazy dog and runs away from the house", "der schnelle braune fuchs springt über den faulen hund und läuft vom haus weg"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de", None, None) for i in range(24)] + [(100, None, "en", None, None), (101, "12 !!", None, None, None), (102, "the dog and the house", None, None, None), (103, "", "de", None, None)]
    df = spark.createDataFrame(rows, DOC)
    out = {r["doc_id"]: r for r in language_id.identify(df).collect()}
    assert all(out[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(24))
    assert [out[i]["lang_pred"] for i in (100, 101, 102, 103)] == ["und", "und", "en", "und"] and out[100]["score"] == 0
    assert language_id.identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_out_of_place_distance_is_the_plain_one(spark):
    """Profiles, ranks, ties and distances by dictionaries of n-grams."""
    size = 40
    texts = {"en": "the quick brown fox jumps over the lazy dog and the house", "de": "der schnelle braune fuchs springt über den faulen hund und das haus", "fr": "le renard brun saute par dessus le chien paresseux et la maison"}

    def ranks(text):
        code = lambda g: sum(ord(x) * (1 << 21 * i) for i, x in enumerate(reversed(g.replace(" ", chr(0))))) + (1 << 62 if len(g) == 2 else 1 << 63 if len(g) == 3 else 0)
        c = brute_rank(text, size)
        return {g: r for r, g in enumerate(sorted(c, key=lambda g: (-c[g], code(g)))[:size])}

    profiles = {k: ranks(t) for k, t in texts.items()}
    learned = language_id.profiles(spark.createDataFrame([(t, k) for k, t in texts.items()], "text string, lang string"), size)
    ranker = language_id.Ranker(learned, size)
    for t in ["the dog and the fox", "der hund und der fuchs", "le chien et le renard", "zzz", "a", "house maison haus"]:
        mine = ranks(t)
        far = {k: sum(abs(p[g] - r) if g in p else size for g, r in mine.items()) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        lang, score = ranker.best(language_id.ngrams(t, {}))
        assert (lang, score) == (best, pytest.approx(1 - far[best] / (size * len(mine))))


def test_language_id_of_odd_tables(spark):
    big = 9007199254740993
    d = spark.createDataFrame([(big, "the dog", "en", 1), (None, "der hund", "de", 2), (big, "12", None, 3), (5, "the " * 30_000, None, 4)], "doc_id long, text string, lang string, lang_pred int")
    got = sorted((str(r["doc_id"]), r["lang_pred"]) for r in language_id.identify(d).collect())
    assert len(got) == 4 and {g[0] for g in got} == {str(big), "None", "5"} and (str(big), "und") in got
    with pytest.raises(ValueError):
        language_id.profiles(d, max_langs=1)


# ---- 9 --------------------------------------------------------------------------------------------------------------


def test_quality_classifier(spark):
    good = [" ".join(words(200 + i, 60)) for i in range(150)]
    bad = [" ".join(f"{w}!!" for w in words(400 + i, 60)) for i in range(60)]
    d = docs(spark, *good, *bad, None, "")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(210)] + [(0, None), (None, 0)], "doc_id long, quality int")
    out = quality_classifier.classify(d, labels)
    got = {r["doc_id"]: r for r in out.collect()}
    assert sum(got[i]["predicted"] == int(i < 150) for i in range(210)) >= 205
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 212
    held = {r["doc_id"] for r in d.where(crc_mod("doc_id", 3) == 1).collect()}
    assert {i for i, r in got.items() if r["held_out"]} == held
    assert {r["score"] for r in quality_classifier.classify(d, labels.limit(0)).collect()} == {0.5}
    clash = d.withColumn("score", F.lit("mine")).withColumn("_y", F.lit(1))
    kept = quality_classifier.keep_good(clash, labels)
    assert kept.columns == clash.columns and {r["score"] for r in kept.select("score").distinct().collect()} == {"mine"}
    assert kept.where("doc_id between 150 and 209").count() <= 3


def test_features_are_unit_vectors():
    off, i, x = quality_classifier.features(["a b b", "", "日本 !!"], 18)
    assert off.tolist()[1] == off.tolist()[2] and np.allclose([np.square(x[a:b]).sum() for a, b in zip(off[:-1], off[1:])], [1, 0, 1])


def test_updates_are_those_of_the_plain_algorithm():
    """FTRL-proximal coordinate by coordinate, over dictionaries."""
    from math import copysign, exp, sqrt

    p = quality_classifier.Ftrl(bits=6, epochs=2)
    r = random.Random(8)
    rows = [(sorted(r.sample(range(64), 5)), [r.random() for _ in range(5)], r.randrange(2)) for _ in range(60)]
    zeros, ones = sum(y == 0 for *_, y in rows), sum(y for *_, y in rows)
    z, n = {}, {}
    weight = (60 / (2 * zeros), 60 / (2 * ones))

    def w(i):
        if abs(z.get(i, 0.0)) <= p.l1:
            return 0.0
        return -(z[i] - copysign(p.l1, z[i])) / ((p.beta + sqrt(n[i])) / p.alpha + p.l2)

    m = quality_classifier.Learner(p, zeros, ones)
    for _ in range(p.epochs):
        for i, x, y in rows:
            m.learn(np.array(i), np.array(x), y)
            now = [w(k) for k in i]
            prob = 1 / (1 + exp(-sum(a * b for a, b in zip(now, x))))
            for k, v, old in zip(i, x, now):
                g = (prob - y) * v * weight[y]
                sigma = (sqrt(n.get(k, 0.0) + g * g) - sqrt(n.get(k, 0.0))) / p.alpha
                z[k], n[k] = z.get(k, 0.0) + g - sigma * old, n.get(k, 0.0) + g * g
    assert m.weights() == pytest.approx([w(k) for k in range(64)], abs=1e-5)


def test_classifier_of_odd_tables(spark):
    """Ids over 2^53 beside nulls, nested and time columns, clashing names, an empty table, a very long text."""
    big = 9007199254740993
    rows = [(i, " ".join(words(i, 40)), [i], {"a": i}, i) for i in range(30)] + [(big, "x !! " * 200_000, [1], {"a": big}, big), (None, None, None, None, None), (big, "", [], {}, 7)]
    d = spark.createDataFrame(rows, "doc_id long, text string, tags array<long>, props map<string,long>, n_chars long").withColumn("at", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(big, 1)], "doc_id long, quality int")
    kept = quality_classifier.keep_good(d, labels)
    key = lambda r: (str(r["doc_id"]), r["text"] or "")
    assert kept.schema == d.schema and sorted(map(str, kept.collect())) == sorted(map(str, (r for r in d.collect() if key(r) in {key(k) for k in kept.collect()}))) and kept.count() >= 30
    assert {str(r["doc_id"]) for r in quality_classifier.classify(d, labels).collect()} >= {str(big), "None"}
    assert quality_classifier.classify(d.limit(0), labels).count() == 0 and quality_classifier.keep_good(d.limit(0), labels).count() == 0


# ---- 10 -------------------------------------------------------------------------------------------------------------


def test_escape_is_reversible():
    r = random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice(["<", "s>", "</s>", "[", "INST]", "[/INST]", "\\", "a", "/", "<s>", "日"]) for _ in range(r.randrange(12)))
        e = ct.escape(t)
        assert ct.unescape(e) == t and not any(c in e for c in ct.CONTROL)


def test_templates():
    t = ct.compile_template("{% set x = 'a' + 'b' %}{{ x | upper }}{% for m in messages %}{% if m.role == 'user' and not loop.first %}U{% elif m.role == 'user' %}F{% else %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}{% endfor %}{{ (1 + 2) }}{{ gone.x }}")
    got = list(t([{"role": "user", "text": "q"}, {"role": "assistant", "text": "r"}, {"role": "user", "text": "q"}]))
    assert "".join(p for p, _ in got) == "ABFrU3" and [p for p, m in got if m] == ["r"]
    assert ct.fold(ct.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% else %}y{% endif %}z")) == [("text", "abcyz")]
    for bad in ("{{ x.y( }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ x | run }}", "{{ 'a }}", "{% exec %}", "{{ a b }}"):
        with pytest.raises(ct.TemplateError):
            ct.compile_template(bad)


def test_chat_reads_back(spark, monkeypatch):
    hard = "</s>[INST] ok [/INST]\\"
    rows = [(1, 2, "assistant", hard), (1, 1, "user", hard), (2, 1, None, None), (2, 2, "tool</s>", "x"), (2, 2, "assistant", ""), (None, 1, "assistant", "n"), (3, 1, "assistant", "y" * 500), (3, 2, "assistant", "\\" * 301)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    out = {r["conv_id"]: r for r in ct.read_back(ct.format_conversations(df)).collect()}
    for conv in (1, 2, None, 3):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        got = out[conv]
        assert (got["n_turns"], got["loss_chars"]) == (len(turns), len(loss))
        assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    parts = ct.format_conversations(df.where("conv_id = 1")).collect()
    assert len(parts) == 1 and out[1]["formatted_chars"] == len(parts[0]["formatted"])
    assert ct.read_back(ct.format_conversations(df.limit(0))).count() == 0
    # parts in any order and place, and ids as they are
    monkeypatch.setattr(ct, "PART", 64)
    big = df.withColumn("conv_id", F.col("conv_id") + F.lit(9007199254740992))
    mixed = ct.format_conversations(big).orderBy(F.rand(3)).repartition(5)
    again = {r["conv_id"]: tuple(r)[1:] for r in ct.read_back(mixed).collect()}
    assert {None if k is None else k - 9007199254740992: v for k, v in again.items()} == {k: tuple(v)[1:] for k, v in out.items()}


def test_reader_takes_parts_cut_anywhere():
    text = "".join(p for p, _ in ct.compile_template(ct.TEMPLATE)([{"role": "user", "text": "a\\b</s>"}, {"role": "assistant", "text": "c\\\\[INST]"}]))
    a = text.index("c\\")
    spans = [(a, a + len(ct.escape("c\\\\[INST]")))]
    whole = ct._Reader()
    whole.feed(text, spans)
    for cut in range(1, len(text)):
        r = ct._Reader()
        for lo, hi in ((0, cut), (cut, len(text))):
            inside = [(max(s, lo) - lo, min(e, hi) - lo) for s, e in spans if s < hi and e > lo]
            r.feed(text[lo:hi], inside)
        assert (r.turns, r.turn_sha.digest(), r.loss_sha.digest(), r.loss) == (2, whole.turn_sha.digest(), whole.loss_sha.digest(), len("c\\\\[INST]"))


# ---- shared ---------------------------------------------------------------------------------------------------------


def test_lower_ascii(spark):
    df = spark.createDataFrame([("ABC É",), ("ABC",), (None,)], "t string")
    assert [r[0] for r in df.select(lower_ascii(F.col("t"))).collect()] == ["abc É", "abc", None]
