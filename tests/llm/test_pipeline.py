"""The pipeline's stages on the smallest tables, each held against its own input."""

import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, sf)
        after.write.parquet(f"{base}/{i}")
        after = spark.read.parquet(f"{base}/{i}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_return_documents(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < after.count() <= before.count()


def test_classifier_keeps_labelled_good_documents(stages, spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = texts(stages[0][1])
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_lines_of_three_documents_stand_once(stages):
    before, after = texts(stages[1][0]), texts(stages[1][1])
    count = {}
    for t in after.values():
        for line in set((t or "").split("\n")):
            count[line] = count.get(line, 0) + 1
    assert all(n < 3 for line, n in count.items() if len(line.split()) >= 5)
    lines = {i: (t or "").split("\n") for i, t in before.items()}
    assert all(set((t or "").split("\n")) <= set(lines[i]) for i, t in after.items())


def test_near_copies_leave_one(stages):
    before, after = texts(stages[2][0]), texts(stages[2][1])
    grams = {}
    for i, t in before.items():
        w = WORD.findall((t or "").lower())
        grams[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(grams)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if grams[a] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                assert not (a in after and b in after)
    alone = [i for i in ids if all(i == j or len(grams[i] & grams[j]) < 0.3 * len(grams[i] | grams[j] or {0}) for j in ids)]
    assert all(i in after for i in alone)


def test_contaminated_documents_go(stages, spark, sf):
    wins = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = WORD.findall((r["text"] or "").lower())
        wins |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}
    before, after = texts(stages[3][0]), texts(stages[3][1])
    hit = lambda t: any(tuple(w[k : k + 10]) in wins for w in [WORD.findall((t or "").lower())] for k in range(len(w)))
    assert set(after) == {i for i, t in before.items() if not hit(t)}


def test_every_text_is_encoded_and_decodes(stages):
    before, after = stages[4]
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == set(texts(before)) and all(r["round_trip"] for r in rows)
