"""Whitening, exact dedup and vector codes against brute force; odd tables."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import exact_dedup, vector_codes, whitening
from lakemill.llm.queries import QUERIES

EMB = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab) for i, v, lab in rows], EMB)


# ---- whitening ------------------------------------------------------------------------------------------------------


def brute_whitening(x, k):
    n, s = len(x), x.sum(axis=0)
    xc = (n * x - s) / n
    e, axes = np.linalg.eigh(xc.T @ xc / n)
    e, axes = e[::-1], axes[:, ::-1]
    return xc @ axes[:, :k] / np.sqrt(e[:k]), e, ((n * x - s) ** 2).sum(axis=1)


def test_whitening_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.01"
    src = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.floor(1024 * np.stack(src["embedding"]).astype(float)).astype(np.int64) + 100_000
    z, e, far = brute_whitening(x, 8)
    got = QUERIES["op11_embedding_whitening"](spark, sf).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 8 * len(x) and set(got["n"]) == {len(x)}
    assert np.abs(np.abs(got["whitened"].to_numpy().reshape(-1, 8)) - np.abs(z)).max() < 1e-9
    # one sign for all rows
    assert all(abs(abs(np.corrcoef(a, b)[0, 1]) - 1) < 1e-9 for a, b in zip(got["whitened"].to_numpy().reshape(-1, 8).T, z.T))
    assert (got["deviation"].to_numpy().reshape(-1, 8)[:, 0] == far).all() and (got["deviation_exact"].astype(int) == got["deviation"]).all()
    assert np.allclose(got["explained"].to_numpy()[:8], e[:8] / e.sum(), rtol=1e-9) and got["identity_error"].max() < 1e-9


def test_whitening_of_odd_tables(spark):
    empty = whitening.whitened(vectors(spark, []))
    assert empty.collect() == [] and empty.columns[:3] == ["vec_id", "component", "n"]
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0], None)])).collect() == []
    assert whitening.whitened(vectors(spark, [(i, [1.0, 2.0], None) for i in range(5)])).collect() == []
    rows = [(i, [float(i % 3), float(i % 5), 0.5], 1) for i in range(30)] + [(None, [1.0, 1.0, 0.5], None), (3, [1.0, 1.0, 0.5], None)]
    bad = [(90, None, 1), (91, [1.0, None, 2.0], 1), (92, [NAN, 0.0, 0.0], 1), (93, [INF, 0.0, 0.0], 1), (94, [], 1), (95, [1.0, 2.0], 1), (96, [1e30, 0.0, 0.0], 1)]
    got = whitening.whitened(vectors(spark, rows + bad).withColumn("component", F.lit("x"))).collect()
    # the third dimension never changes, so there are two components
    assert len(got) == 2 * len(rows) and {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {len(rows)}
    assert sum(r["vec_id"] is None for r in got) == 2 and sum(r["vec_id"] == 3 for r in got) == 4
    assert got[0]["identity_error"] < 1e-9


def test_whitening_finds_directions_of_equal_variance(spark):
    # a cube's corners: all variances are equal, of which a single start vector sees one direction
    corners = [(i, [float(i >> d & 1) for d in range(4)], 0) for i in range(16)]
    got = whitening.whitened(vectors(spark, corners)).collect()
    assert len(got) == 16 * 4 and got[0]["identity_error"] < 1e-9
    assert all(abs(r["explained"] - 0.25) < 1e-12 for r in got)


def test_deviations_are_exact_at_every_size():
    r = np.random.default_rng(3)
    for n in (7, 10**6, 10**9, 10**12, 10**15):
        x = r.integers(99_000, 101_000, (5, 64))
        sums = tuple(int(s) for s in r.integers(99_900, 100_100, 64).astype(object) * n + r.integers(0, n, 64))
        want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert whitening.Centre(n, sums).deviations(x) == want


# ---- exact dedup ----------------------------------------------------------------------------------------------------

ODD = [(5, "a  b"), (3, "a\t\nb"), (None, "a b"), (7, "a b "), (1, None), (2, ""), (2, ""), (9, " "), (8, "\n\n"), (None, "only"), (4, "w " * 200_000), (6, "w  " * 200_000), (11, "A b")]


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        out += [(i, known[0] if known else None, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def scan(spark, tmp_path, rows, files=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit(1)).withColumn("digest", F.lit("x"))
    df.repartition(files).write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


@pytest.mark.parametrize("digest", [None, lambda t: F.lit("same"), lambda t: F.length(t).cast("string")])
def test_exact_dedup_of_odd_rows_whatever_the_digest(spark, tmp_path, digest):
    got = exact_dedup.exact_duplicates(scan(spark, tmp_path, ODD), digest, files_per_batch=1).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == brute_copies(ODD)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_dedup_of_an_empty_table(spark, tmp_path):
    got = exact_dedup.exact_duplicates(scan(spark, tmp_path, [], 1))
    assert got.collect() == [] and got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_state_lasts_and_goes_on_with_new_files(spark, tmp_path):
    folder, checkpoint = f"{tmp_path}/rows", f"{tmp_path}/state"
    row = lambda i, d, at: (i, d, d, "f", at)
    spark.createDataFrame([row(5, "p", 0), row(6, "q", 1)], exact_dedup.ROWS).write.parquet(folder)
    assert exact_dedup.take_in(spark, folder, checkpoint) >= 1
    spark.createDataFrame([row(2, "p", 7), row(9, "q", 8), row(1, "r", 9)], exact_dedup.ROWS).coalesce(1).write.mode("append").parquet(folder)
    exact_dedup.take_in(spark, folder, checkpoint)
    # a run that meets nothing new changes nothing
    exact_dedup.take_in(spark, folder, checkpoint)
    got = {r["digest"]: (r["keep"]["doc_id"], r["keep"]["at"], r["group_size"]) for r in exact_dedup.state(spark, checkpoint).collect()}
    assert got == {"p": (2, 7, 2), "q": (6, 1, 2), "r": (1, 9, 1)}


def test_exact_dedup_runs_no_python_on_its_rows(spark, sf):
    plan = QUERIES["op12_exact_dedup"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- vector codes ---------------------------------------------------------------------------------------------------


def test_masks_find_the_nearest_entry_and_the_lowest_of_equals():
    r = np.random.default_rng(8)
    for entries, dims, spread in ((64, 4, 300), (64, 4, 3), (1, 4, 9), (2, 1, 5), (17, 7, 40), (64, 2, 1)):
        book = r.integers(-spread, spread + 1, (entries, dims))
        x = np.concatenate((r.integers(-2 * spread, 2 * spread + 1, (500, dims)), book, r.integers(-(2**26), 2**26, (20, dims))))
        far = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        m = vector_codes.Masks(book)
        index, error = m.nearest(x)
        assert (index == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()
        # the masks leave out entries, and never one within the radius
        mask, radius = m.candidates(x, m.radius(x)), m.radius(x)
        inside = (np.abs(x[:, None] - book[None]) <= radius[:, None, None]).all(axis=2)
        assert (np.array([[int(v) >> e & 1 for e in range(entries)] for v in mask], bool) == inside).all()
    with pytest.raises(ValueError):
        vector_codes.Masks(np.zeros((65, 2), np.int64))


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64), lab) for i, v, lab in rows]
    d = len(kept[0][1])
    ends = [p * d // parts for p in range(parts + 1)]
    seeds = [v for i, v, _ in sorted(((i, v.tolist(), lab) for i, v, lab in kept if i is not None), key=lambda t: (t[0], t[1]))][:entries]
    books = [[s[a:b] for s in seeds] for a, b in zip(ends, ends[1:])]

    def find(v, book):
        return min((sum((int(p) - q) ** 2 for p, q in zip(v, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        new = []
        for (a, b), book in zip(zip(ends, ends[1:]), books):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[find(v[a:b], book)[1]].append(v[a:b])
            new.append([[int(sum(int(x) for x in col)) // len(members[e]) for col in zip(*members[e])] if members[e] else c for e, c in enumerate(book)])
        books = new
    coded = []
    for i, v, lab in kept:
        hits = [find(v[a:b], book) for (a, b), book in zip(zip(ends, ends[1:]), books)]
        coded.append((i, "".join(f"{e:02x}" for _, e in hits), sum(f for f, _ in hits), lab))
    total = defaultdict(int)
    for _, _, error, lab in coded:
        total[lab] += error
    sha = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return sorted(((i, c, e, total[lab], sha) for i, c, e, lab in coded), key=str)


@pytest.mark.parametrize("length", [16, 32, 20, 5])
def test_vector_codes_of_odd_tables(spark, length):
    r = np.random.default_rng(length)
    rows = [(int(i), [float(x) for x in np.round(r.normal(0, 0.4, length), 3)], None if i % 7 == 0 else int(i % 3)) for i in r.permutation(90)]
    rows += [(rows[0][0], rows[1][1], 2), (None, rows[2][1], 1), (200, rows[3][1], None), (201, rows[3][1], None)]
    bad = [(-5, None, 1), (-4, [NAN] * length, 1), (-3, [INF] * length, 1), (-2, [None] * length, 1), (-1, [], 1), (-6, [1.0] * (length + 1), 1), (-7, [1e20] * length, 1)]
    df = vectors(spark, rows + bad).withColumn("code", F.lit(0)).repartition(5)
    got = sorted(map(tuple, vector_codes.compress(df).collect()), key=str)
    assert got == brute_codes(rows)


def test_vector_codes_of_few_rows_and_none(spark):
    assert vector_codes.compress(vectors(spark, [])).collect() == []
    rows = [(1, [0.5] * 16, None), (2, [0.25] * 16, 4)]
    assert sorted(map(tuple, vector_codes.compress(vectors(spark, rows)).collect()), key=str) == brute_codes(rows)
    assert vector_codes.compress(vectors(spark, rows).drop("label")).count() == 2


def test_codes_stand_for_vectors_near_the_rows(spark):
    rows = vector_codes.usable(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), 1e5)
    books, ends = vector_codes.codebooks(rows)
    back = vector_codes.decode(vector_codes.encode(rows, books, ends).select("vec_id", "code", "error"), books).withColumnRenamed("vec", "near").join(rows, "vec_id")
    far = back.select("error", F.aggregate(F.zip_with("vec", "near", lambda a, b: (F.floor(a * 256) - F.round(b * 256)) ** 2), F.lit(0.0), lambda s, x: s + x).alias("far")).collect()
    assert len(far) > 400 and all(r["error"] == r["far"] for r in far)
