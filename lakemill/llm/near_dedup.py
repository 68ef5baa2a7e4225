"""Near-duplicate classes with Order MinHash (Marçais, DeBlasio, Pandey and Kingsford, 2019).

A text's shingles of ``k`` words are labelled with their occurrence number, so that repeats count. Each of ``m`` hash
functions picks the ``l`` smallest labelled shingles and keeps them in text order: two texts agree on such a sketch
with a probability that falls with their edit distance, as order counts and not only content. Texts whose edits leave
few or no runs of ``k`` words whole, as one edit in every five words does, are found by ``short_m`` sketches more, of
shingles of ``short_k`` words: they only propose pairs, which alignment accepts or not like any others.

1. Texts with equal word sequences are one; only one of each goes on (membership is a join on a 128-bit hash).
2. Sketches are range-partitioned by (band, sketch, next band's sketch) and sorted. A row is paired with the leader of
   its run of equal pairs of sketches; run leaders are paired with the leader before and with the bucket's first row.
   That is linear in the rows whatever a bucket's size, and the range partitioning splits large buckets; buckets that
   cross partitions are tied together by their border rows.
3. Candidate pairs are verified by banded alignment of their words: edit distance at most (1 - similarity) times the
   longer text, searched along the diagonals of that band only. The most voted pair of each text goes first; of the
   others, only pairs that still connect two classes need aligning, which gives the same classes.
   Buckets that still hold several classes are then searched: small ones (``block`` rows) try every pair of classes.
   The texts of larger ones, as passages shared by many texts make them, meet by the rarest of their runs of two
   words: so many of them that two texts that align have one in common. Those of runs of few texts are paired; those
   of common runs are gathered in blocks, and a task aligns the texts of two blocks without a row for each pair.
4. Connected components by alternating large-star and small-star steps; each step is written to the shared folder.

Steps 2 to 4 work on distinct word sequences, each with a number of its own, and not on documents.

Defined results: a text without words (null, empty) is alone in its class; a text of fewer than k words is one
shingle; rows with a null doc_id have a null class and are never grouped; rows that repeat a doc_id are one document,
which has the links of all its rows and so joins their classes; the class id is the smallest doc_id of the class; an
empty table gives an empty one; other columns are passed on by drop_near_duplicates, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import chunks, sized, written
from lakemill.llm.tokens import mix, words

_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_labels(w: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingle hashes of all texts, and their offsets; a text of 1 to k - 1 words has one shingle."""
    n = np.diff(at)
    count = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    off = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(n)), count)
    first = at[doc] + np.arange(len(doc)) - off[doc]
    s = np.zeros(len(doc), np.uint64)
    for j in range(k):
        inside = first + j < at[doc + 1]
        s = s * np.uint64(0x100000001B3) + np.where(inside, w[np.minimum(first + j, max(len(w) - 1, 0))], np.uint64(j + 1))
    s = mix(s)
    order = np.lexsort((s, doc))  # stable: equal shingles of a text stay in text order
    new = np.ones(len(s), bool)
    new[1:] = (s[order][1:] != s[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0)) if len(s) else np.zeros(0, np.int64)
    occurrence = np.empty(len(s), np.uint64)
    occurrence[order] = (np.arange(len(s)) - start).astype(np.uint64)
    return mix(s ^ (occurrence * np.uint64(0x9E3779B97F4A7C15))), off


def order_min_hash(labels: np.ndarray, off: np.ndarray, m: int, l: int) -> np.ndarray:
    """(texts, m) sketches; texts without shingles have zeros."""
    n = np.diff(off)
    some = np.flatnonzero(n > 0)
    out = np.zeros((len(n), m), np.uint64)
    if not len(some):
        return out
    starts, doc = off[some], np.repeat(np.arange(len(some)), n[some])
    rng = np.random.default_rng(20190701)
    for j in range(m):
        seed, odd = rng.integers(0, 1 << 63, 2, dtype=np.uint64) | np.uint64(1)
        v = (labels ^ seed) * odd
        v ^= v >> np.uint64(29)
        places = np.full((len(some), l), -1, np.int64)
        for i in range(l):
            least = np.minimum.reduceat(v, starts)
            hit = np.flatnonzero(v == least[doc])
            hit = hit[v[hit] != _MAX]
            places[doc[hit], i] = hit
            v[hit] = _MAX
        places.sort(axis=1)
        h = np.zeros(len(some), np.uint64)
        for i in range(l):
            p = places[:, i]
            h = h * np.uint64(0x100000001B3) + np.where(p >= 0, labels[np.maximum(p, 0)], np.uint64(7))
        out[some, j] = mix(h + np.uint64(j))
    return out


def sequence_hash(w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, 2) hashes of the word sequences."""
    out = np.zeros((len(at) - 1, 2), np.uint64)
    n = np.diff(at)
    some = np.flatnonzero(n > 0)
    if len(some):
        inner = (np.arange(len(w)) - np.repeat(at[:-1], n)).astype(np.uint64)
        for c, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            out[some, c] = mix(np.add.reduceat(mix(w ^ mix(inner + np.uint64(salt))), at[:-1][some]) + n[some].astype(np.uint64))
    return out


def sketches(docs: DataFrame, families: list[tuple[int, int]], l: int) -> DataFrame:
    """doc_id, mark (of the text), h1, h2, n_words, sk of every row with words and a doc_id.

    families: the words of a shingle and the number of sketches of them, in the order in which sk holds them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for a, z in chunks(texts):
                w, at = words(texts[a:z])
                h = sequence_hash(w, at).view(np.int64)
                sk = np.concatenate([order_min_hash(*shingle_labels(w, at, k), m, l) for k, m in families], axis=1).view(np.int64)
                out = pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[a:z], "mark": b["mark"].to_numpy()[a:z], "h1": h[:, 0], "h2": h[:, 1], "n_words": np.diff(at), "sk": list(sk)})
                yield out[out["n_words"] > 0]

    src = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return src.mapInPandas(run, f"doc_id {kind}, mark long, h1 long, h2 long, n_words long, sk array<long>")


def candidate_pairs(sk: DataFrame, m: int) -> DataFrame:
    """lo, hi, votes: linearly many pairs that share sketches. sk: node and sk of distinct texts."""
    rows = sk.select(F.col("node").alias("id"), F.posexplode("sk").alias("band", "key"), "sk")
    rows = rows.select("band", "key", F.element_at("sk", (F.col("band") + 1) % m + 1).alias("next"), "id")
    dealt = rows.repartitionByRange("band", "key", "next", "id").sortWithinPartitions("band", "key", "next", "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["band", "key", "a", "b"]
        lead = run_lead = None  # (band, key, next, id) of the bucket's first row and of the current run's first
        for pdf in batches:
            if not len(pdf):
                continue
            band, key, nxt, ids = (pdf[c].to_numpy() for c in ("band", "key", "next", "id"))
            if lead is None:
                yield pd.DataFrame([(band[0], key[0], ids[0], None)], columns=names).astype({"b": object})
                lead = run_lead = (band[0], key[0], nxt[0], ids[0])
            # the carried leaders go in front
            band = np.concatenate(([lead[0], run_lead[0]], band))
            key = np.concatenate(([lead[1], run_lead[1]], key))
            nxt = np.concatenate(([lead[2], run_lead[2]], nxt))
            ids = np.concatenate(([lead[3], run_lead[3]], ids))
            i = np.arange(len(ids))
            bucket = np.concatenate(([True], (band[1:] != band[:-1]) | (key[1:] != key[:-1])))
            runs = bucket | np.concatenate(([True], nxt[1:] != nxt[:-1]))
            first, leader = np.maximum.accumulate(np.where(bucket, i, 0)), np.maximum.accumulate(np.where(runs, i, 0))
            before = np.concatenate(([0], leader[:-1]))
            inner, heads = np.flatnonzero(~runs), np.flatnonzero(runs & ~bucket)
            a = np.concatenate((ids[inner], ids[heads], ids[heads]))
            b = np.concatenate((ids[leader[inner]], ids[before[heads]], ids[first[heads]]))
            at = np.concatenate((inner, heads, heads))
            keep = a != b
            yield pd.DataFrame({"band": band[at][keep], "key": key[at][keep], "a": a[keep], "b": b[keep].astype(object)})
            f, r = first[-1], leader[-1]
            lead, run_lead = (band[f], key[f], nxt[f], ids[f]), (band[r], key[r], nxt[r], ids[r])
        if lead is not None:
            yield pd.DataFrame([(lead[0], lead[1], lead[3], None)], columns=names).astype({"b": object})

    found = written(dealt.mapInPandas(run, "band int, key long, a long, b long"))
    borders = found.where("b is null").select("band", "key", "a").distinct()
    ties = borders.join(borders.groupBy("band", "key").agg(F.min("a").alias("b")), ["band", "key"]).where("a <> b").select("a", "b")
    pairs = found.where("b is not null").select("a", "b").unionByName(ties)
    return pairs.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).groupBy("lo", "hi").agg(F.count("*").alias("votes"))


def band_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The edit distance of two sequences if it is at most `most`, else None.

    Only the band of `most` diagonals on either side is aligned. A column's vertical differences in it are two bit
    vectors, which move down a row a column (Hyyrö, 2003); Python's integers hold a band of any width.
    """
    n = min(len(a), len(b))
    if abs(len(a) - len(b)) > most:
        return None
    # what both begin and end with aligns with itself
    same = np.flatnonzero(a[:n] != b[:n])
    head = int(same[0]) if len(same) else n
    same = np.flatnonzero(a[len(a) - n + head :][::-1] != b[len(b) - n + head :][::-1])
    tail = int(same[0]) if len(same) else n - head
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    m, n = len(a), len(b)
    if not m or not n:
        return m + n if m + n <= most else None
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    every = (1 << 2 * most + 1) - 1
    # bit t of column j is row j - most + t; rows above the first one have no differences
    goal, plus, minus = m - n + most, ((1 << most) - 1) << most + 1, 0
    score = max(m - n, 0)
    for j, x in enumerate(b.tolist()):
        match = at.get(x, 0)
        if match:
            match = (match << most - j if most >= j else match >> j - most) & every
        # the row that enters the band is one more than the one above it
        plus, minus = plus >> 1 | 1 << 2 * most, minus >> 1
        stay = (((match & plus) + plus) ^ plus) & every | match | minus
        score += not stay >> goal & 1
        if score > most:
            return None
        right, left = (minus | ~(stay | plus)) & every, plus & stay
        right, left = (right << 1 | 1) & every, left << 1 & every
        plus, minus = (left | ~(stay | right)) & every, stay & right
    return score


def alignable(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether the words that the two have in common, order aside, leave room for a distance of at most `most`."""
    x, y = np.unique(np.concatenate((a, b)), return_inverse=True)
    common = np.minimum(np.bincount(y[: len(a)], minlength=len(x)), np.bincount(y[len(a) :], minlength=len(x))).sum()
    return max(len(a), len(b)) - common <= most


def aligned(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """lo, hi, distance, similarity of the pairs of nodes whose texts align within the band. texts: node, text."""
    ids = written(pairs.select(F.col("lo").alias("node")).unionByName(pairs.select(F.col("hi").alias("node"))).distinct())
    some = written(texts.join(sized(ids), "node", "left_semi").dropDuplicates(["node"]))
    both = pairs.select("lo", "hi").join(some.select(F.col("node").alias("lo"), F.col("text").alias("ta")), "lo").join(some.select(F.col("node").alias("hi"), F.col("text").alias("tb")), "hi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for lo, hi, ta, tb in zip(p["lo"], p["hi"], p["ta"], p["tb"]):
                w, at = words([ta, tb])
                a, b = w[: at[1]], w[at[1] :]
                longest = max(len(a), len(b))
                most = int((1 - similarity) * longest + 1e-9)
                if abs(len(a) - len(b)) <= most and alignable(a, b, most):
                    d = band_distance(a, b, most)
                    if d is not None:
                        out.append((lo, hi, d, 1 - d / longest))
            yield pd.DataFrame(out, columns=["lo", "hi", "distance", "similarity"])

    return both.mapInPandas(run, "lo long, hi long, distance long, similarity double")


def _unfinished(e: DataFrame) -> bool:
    """Whether a node of the edges u > v points to two nodes, or both points and is pointed to; else all are stars."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("out")).unionByName(e.select(F.col("v").alias("id"), F.lit(0).alias("out")))
    n = ends.groupBy("id").agg(F.sum("out").alias("out"), F.count("*").alias("all"))
    return bool(n.where("out > 1 or out = 1 and all > 1").head(1))


def components(edges: DataFrame) -> DataFrame:
    """id, class_id: the connected components of edges (lo, hi), by large-star and small-star steps until they rest."""
    e = written(edges.select(F.greatest("lo", "hi").alias("u"), F.least("lo", "hi").alias("v")).where("u <> v").distinct())
    while _unfinished(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c"))
        large = both.join(least, "u").where("v > u").select("v", "c").distinct()
        # now v > c: the smaller neighbours of each node, and the node itself, go to the smallest of them
        low = written(large.select(F.col("v").alias("u"), F.col("c").alias("v")).where("u <> v"))
        least = low.groupBy("u").agg(F.min("v").alias("c"))
        small = low.join(least, "u").where("v <> c").select(F.col("v").alias("u"), F.col("c").alias("v")).unionByName(least.select("u", F.col("c").alias("v")))
        e = written(small.where("u <> v").distinct())
    return e.select(F.col("u").alias("id"), F.col("v").alias("class_id")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("class_id")).distinct())


def merged_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of classes (id, class_id) with the classes that links (lo, hi) connect made one."""
    a = classes.select(F.col("id").alias("lo"), F.col("class_id").alias("ca"))
    b = classes.select(F.col("id").alias("hi"), F.col("class_id").alias("cb"))
    joined = links.join(a, "lo").join(b, "hi").select(F.least("ca", "cb").alias("lo"), F.greatest("ca", "cb").alias("hi"))
    to = written(components(joined)).select(F.col("id").alias("class_id"), F.col("class_id").alias("to"))
    return classes.join(to, "class_id", "left").select("id", F.coalesce("to", "class_id").alias("class_id"))


def open_buckets(rows: DataFrame) -> DataFrame:
    """The rows (band, key, id, class_id and others) of the buckets that hold several classes, with the bucket's size."""
    several = rows.groupBy("band", "key").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b"), F.count("*").alias("size")).where("a <> b")
    return rows.join(several.select("band", "key", "size"), ["band", "key"])


def _apart(one: DataFrame, two: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """lo, hi: pairs of rows of one and two (id, class_id, n_words) with equal keys, of different classes and of lengths that can align."""
    a = one.select(*keys, F.col("id").alias("ia"), F.col("class_id").alias("ca"), F.col("n_words").alias("na"))
    b = two.select(*keys, F.col("id").alias("ib"), F.col("class_id").alias("cb"), F.col("n_words").alias("nb"))
    room = F.floor((1 - similarity) * F.greatest("na", "nb") + 1e-9)
    both = a.join(b, keys).where((F.col("ca") != F.col("cb")) & (F.abs(F.col("na") - F.col("nb")) <= room))
    return both.select(F.least("ia", "ib").alias("lo"), F.greatest("ia", "ib").alias("hi")).distinct()


_PACK = "pack long, ids array<long>, classes array<long>, n_words array<int>, n_runs array<int>, text array<int>, key array<long>"


def packed_runs(texts: DataFrame, k: int, bins: int) -> DataFrame:
    """The occurrence-labelled runs of k words (key) of all texts (id, class_id, text), packs of texts in a row for each bin of keys.

    text: the run's text, by its place in the pack, and of: that text's class. The row of bin 0 has the pack's texts.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            batch = p["text"].tolist()
            for x, z in chunks(batch):
                w, at = words(batch[x:z])
                key, off = shingle_labels(w, at, k)
                key, n_runs = key.view(np.int64), np.diff(off)
                text, classes = np.repeat(np.arange(z - x, dtype=np.int32), n_runs), p["class_id"].to_numpy()[x:z]
                ids = p["id"].to_numpy()[x:z]
                order = np.argsort(key % bins, kind="stable")
                cuts = np.searchsorted(key[order] % bins, np.arange(bins + 1))
                rows = [(ids[0], b, *([None] * 4 if b else (ids, classes, np.diff(at), n_runs)), text[o], key[o], classes[text[o]]) for b in range(bins) if len(o := order[cuts[b] : cuts[b + 1]]) or not b]
                yield pd.DataFrame(rows, columns=["pack", "bin", "ids", "classes", "n_words", "n_runs", "text", "key", "of"])

    return texts.select("id", "class_id", "text").mapInPandas(run, _PACK.replace("pack long", "pack long, bin int") + ", of array<long>")


def shared_runs(packed: DataFrame) -> DataFrame:
    """The packs' rows with those runs only that texts of several classes have, and how many texts have each (count)."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        cuts = np.cumsum(p["key"].map(len).to_numpy())[:-1]
        text, key, of = (np.concatenate(p[c].tolist()) for c in ("text", "key", "of"))
        kinds, kind, count = np.unique(key, return_inverse=True, return_counts=True)
        some = np.zeros(len(kinds), np.int64)
        some[kind] = of  # the class of any text that has the run
        several = np.zeros(len(kinds), bool)
        several[kind[of != some[kind]]] = True
        stays = np.split(several[kind], cuts)
        of_rows = lambda values: [v[s] for v, s in zip(np.split(values, cuts), stays)]
        return p.drop(columns=["bin", "of"]).assign(text=of_rows(text), key=of_rows(key), count=of_rows(count[kind].astype(np.int32)))

    return packed.groupBy("bin").applyInPandas(run, _PACK + ", count array<int>")


def first_runs(shared: DataFrame, k: int, similarity: float) -> DataFrame:
    """key and the texts (id, class_id, n_words) of each pack that have it among their rarest runs, in which texts that align must meet.

    Runs that texts of one class alone have count as the rarest: they take places and are left out.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        head = p[p["ids"].notna()].iloc[0]
        n = np.asarray(head["n_words"])
        text, key, count = (np.concatenate(p[c].tolist()) for c in ("text", "key", "count"))
        order = np.lexsort((key, count, text))
        text, key = text[order], key[order]
        have = np.bincount(text, minlength=len(n))
        most = (k * (1 - similarity) * n + 1e-9).astype(np.int64) + 1 - (head["n_runs"] - have)
        stays = np.arange(len(text)) - (np.cumsum(have) - have)[text] < most[text]
        text, key = text[stays], key[stays]
        order = np.argsort(key, kind="stable")
        key, start = np.unique(key[order], return_index=True)
        lists = np.split(text[order], start[1:]) if len(key) else []
        columns = {c: [np.asarray(head[of])[t] for t in lists] for c, of in (("id", "ids"), ("class_id", "classes"), ("n_words", "n_words"))}
        return pd.DataFrame({"key": key, **columns})

    return shared.groupBy("pack").applyInPandas(run, "key long, id array<long>, class_id array<long>, n_words array<int>")


def common_words(labels: np.ndarray, off: np.ndarray, width: int = 1 << 14) -> np.ndarray:
    """For every two texts, how many of their occurrence-labelled words they have in common; `width` words at a time."""
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(off))
    _, word, count = np.unique(labels, return_inverse=True, return_counts=True)
    several = count > 1
    doc, word = doc[several[word]], (np.cumsum(several) - 1)[word[several[word]]]
    order = np.argsort(word, kind="stable")
    doc, word = doc[order], word[order]
    out = np.zeros((n, n), np.float64)
    for first in range(0, int(several.sum()), width):
        a, z = np.searchsorted(word, (first, first + width))
        has = np.zeros((n, width), np.float32)
        has[doc[a:z], word[a:z] - first] = 1
        out += has @ has.T
    return out


def aligned_by_blocks(meet: DataFrame, home: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """lo, hi, distance, similarity of the texts (id, class_id, text) of different classes that align, of all pairs of blocks (x, y) that meet. home: id, block."""
    sides = meet.select("x", "y", F.col("x").alias("block")).unionByName(meet.where("x <> y").select("x", "y", F.col("y").alias("block")))
    both = sides.join(home, "block").join(texts, "id").select("x", "y", "block", "id", "class_id", "text")

    def run(p: pd.DataFrame) -> pd.DataFrame:
        w, at = words(p["text"].tolist())
        n, ids = np.diff(at), p["id"].to_numpy()
        longest = np.maximum(n[:, None], n)
        most = ((1 - similarity) * longest + 1e-9).astype(np.int64)
        tried = (p["class_id"].to_numpy()[:, None] != p["class_id"].to_numpy()) & (np.abs(n[:, None] - n) <= most)
        if p["x"].iat[0] != p["y"].iat[0]:
            tried &= p["block"].to_numpy()[:, None] != p["block"].to_numpy()
        out = []
        if tried.any():
            tried &= longest - common_words(*shingle_labels(w, at, 1)) <= most
            for a, b in zip(*np.nonzero(np.triu(tried))):
                d = band_distance(w[at[a] : at[a + 1]], w[at[b] : at[b + 1]], int(most[a, b]))
                if d is not None:
                    out.append((min(ids[a], ids[b]), max(ids[a], ids[b]), d, 1 - d / longest[a, b]))
        return pd.DataFrame(out, columns=["lo", "hi", "distance", "similarity"])

    return both.groupBy("x", "y").applyInPandas(run, "lo long, hi long, distance long, similarity double")


def pairs_by_pieces(texts: DataFrame, similarity: float, load: int = 200_000, together: int = 128, few: int = 24, bins: int = 128) -> DataFrame:
    """lo, hi, distance, similarity of all texts (id, class_id, text) of different classes that align; exact for any number of texts.

    An edit touches at most k runs of k words, so that two texts of which the longer has n words and that differ by
    `most` = (1 - similarity) * n edits have all but k * most of their runs in common, repeats counted. In whatever
    order the runs stand, one they share is then among the first k * (1 - similarity) * n + 1 of both. The order puts
    rare runs first, which passages of many texts are not. Runs are counted in `bins`, a task for each bin of keys, and
    the counts go back to the packs of texts that asked: no row is made for a run, and none comes to the driver.

    Runs of at most `few` texts give pairs, which is linear in the runs. For commoner ones no row is made for a pair:
    their texts are gathered in blocks, by the commonest of these runs, of about `together` texts or `load` words, and
    blocks meet that share a run. A task has the texts of two blocks once and aligns those with enough words in common.
    """
    k = 2 if similarity >= 0.7 else 1
    rows = first_runs(shared_runs(written(packed_runs(texts, k, bins))), k, similarity)
    lists = rows.groupBy("key").agg(F.flatten(F.collect_list(F.arrays_zip("id", "class_id", "n_words"))).alias("texts"), F.min(F.array_min("class_id")).alias("a"), F.max(F.array_max("class_id")).alias("b"))
    lists = written(lists.where("a <> b").select("key", F.size("texts").alias("size"), "texts"))
    # of each text's list only those behind it that can align
    a, behind = F.col("a"), F.slice("texts", F.col("at") + 2, F.col("size"))
    room = lambda b: F.floor((1 - similarity) * F.greatest(a["n_words"], b["n_words"]) + 1e-9)
    behind = F.filter(behind, lambda b: (a["class_id"] != b["class_id"]) & (F.abs(a["n_words"] - b["n_words"]) <= room(b)))
    pairs = lists.where(F.col("size") <= few).select("texts", "size", F.posexplode("texts").alias("at", "a")).select("a.id", F.explode(behind).alias("b"))
    pairs = written(pairs.select(F.least("id", "b.id").alias("lo"), F.greatest("id", "b.id").alias("hi")).distinct())
    flat = lists.where(F.col("size") > few).select("key", "size", F.explode("texts").alias("text")).select("text.id", "text.n_words", "size", "key")
    per_text = flat.groupBy("id", "n_words").agg(F.max(F.struct("size", "key")).alias("common"), F.collect_list("key").alias("keys"))
    # a power of two, so that texts of unlike lengths are dealt alike
    least = F.greatest(F.lit(1.0), F.col("common.size") / together, F.col("common.size") * F.col("n_words") / load)
    parts = F.pow(F.lit(2), F.ceil(F.log2(least))).cast("long")
    home = written(per_text.select("id", F.xxhash64("common.key", parts, F.pmod(F.xxhash64("id"), parts)).alias("block"), "keys"))
    sets = home.select("block", F.explode("keys").alias("key")).groupBy("key").agg(F.sort_array(F.collect_set("block")).alias("blocks")).select("blocks").distinct()
    meet = sets.select("blocks", F.explode("blocks").alias("x")).select("x", F.explode("blocks").alias("y")).where("x <= y").distinct()
    home = home.select("id", "block")
    alone = home.groupBy("block").agg(F.count("*").alias("texts")).where("texts = 1").select(F.col("block").alias("x"), F.col("block").alias("y"))
    meet = written(meet.join(alone, ["x", "y"], "left_anti"))
    found = aligned(pairs, texts.withColumnRenamed("id", "node"), similarity).unionByName(aligned_by_blocks(meet, home, texts, similarity))
    return found.dropDuplicates(["lo", "hi"])


def searched(one: DataFrame, texts: DataFrame, links: DataFrame, tried: DataFrame, similarity: float, m: int, block: int) -> tuple[DataFrame, DataFrame]:
    """links and those that only other pairs of a bucket show; id, class_id of all texts by these links.

    one: node, n_words and sk of distinct texts; tried: the pairs (lo, hi) aligned before. Buckets of at most `block`
    rows try all pairs of their classes; the texts of larger ones meet by their rarest runs of words, which loses none.
    """
    comp = written(components(links))
    ids = one.select(F.col("node").alias("id"))
    classes = written(ids.join(comp, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id")))
    known = one.withColumnRenamed("node", "id").join(classes, "id")
    rows = written(open_buckets(known.select("id", "class_id", "n_words", F.posexplode("sk").alias("band", "key"))))
    few = rows.where(F.col("size") <= block)
    pairs = written(_apart(few, few, ["band", "key"], similarity).join(tried, ["lo", "hi"], "left_anti"))
    found = aligned(pairs, texts, similarity)
    many = rows.where(F.col("size") > block)
    if many.head(1):
        many = written(many.select(F.col("id").alias("node"), "class_id").distinct())
        many = written(texts.join(sized(many), "node").dropDuplicates(["node"]).withColumnRenamed("node", "id"))
        found = found.unionByName(pairs_by_pieces(many, similarity)).dropDuplicates(["lo", "hi"])
    found = written(found)
    return links.unionByName(found), written(merged_classes(classes, found))


def links_and_classes(
    docs: DataFrame, k: int = 5, similarity: float = 0.8, m: int = 16, l: int = 2, short_k: int = 3, short_m: int = 36, block: int = 64
) -> tuple[DataFrame, DataFrame]:
    """(lo, hi, distance, similarity) links between different texts, by node; (doc_id, class_id, node) of rows with words.

    Of two texts of which a share q of the words is unchanged, here and there, one of the m sketches is the same with a
    probability of about 1 - (1 - j ** l) ** m, where j = q ** k / (2 - q ** k), and likewise one of the short_m;
    similar texts also find each other over a third.
    """
    sk = written(sketches(docs, [(k, m), (short_k, short_m)], l))
    m += short_m
    # the numbers are those of the written table, whatever tasks were run twice
    nodes = written(sk.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "mark")).alias("rep")).select("h1", "h2", F.monotonically_increasing_id().alias("node"), "rep.doc_id", "rep.mark"))
    one = sk.join(nodes, ["doc_id", "mark", "h1", "h2"]).select("node", "n_words", "sk").dropDuplicates(["node"])
    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").join(nodes.select("doc_id", "mark", "node"), ["doc_id", "mark"]).select("node", "text")
    pairs = written(candidate_pairs(one.select("node", "sk"), m))
    best = written(pairs.groupBy("hi").agg(F.min_by("lo", F.struct(-F.col("votes"), "lo")).alias("lo")).select("lo", "hi"))
    first = written(aligned(best, texts, similarity))
    comp = written(components(first))
    a = comp.select(F.col("id").alias("lo"), F.col("class_id").alias("ca"))
    b = comp.select(F.col("id").alias("hi"), F.col("class_id").alias("cb"))
    rest = pairs.select("lo", "hi").join(best, ["lo", "hi"], "left_anti").join(a, "lo", "left").join(b, "hi", "left")
    rest = written(rest.where(F.coalesce("ca", "lo") != F.coalesce("cb", "hi")).select("lo", "hi"))
    links = first.unionByName(written(aligned(rest, texts, similarity)))
    tried = best.select("lo", "hi").unionByName(rest)
    links, classes = searched(one, texts, links, tried, similarity, m, block)
    members = written(sk.select("doc_id", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("doc_id", "node").distinct())
    # rows that repeat a doc_id are one document
    twins = written(members.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("doc_id", "lo"))
    if twins.head(1):
        classes = written(merged_classes(classes, members.join(twins, "doc_id").where("node <> lo").select("lo", F.col("node").alias("hi"))))
    members = members.join(classes, members["node"] == classes["id"]).select("doc_id", "node", F.col("class_id").alias("c"))
    names = written(members.groupBy("c").agg(F.min("doc_id").alias("class_id")))
    return links, members.join(names, "c").select("doc_id", "class_id", "node")


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, class_id, kept of every row of docs; kept is true for one document of each class."""
    _, classes = links_and_classes(docs, **settings)
    mine = classes.select("doc_id", "class_id").distinct()
    out = docs.select("doc_id").join(mine, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, unchanged, without those of which another document of the class stays."""
    _, classes = links_and_classes(docs, **settings)
    gone = classes.where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
