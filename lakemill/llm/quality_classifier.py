"""Quality classifier: hashed word n-grams, logistic regression trained with follow-the-regularised-leader updates.

Training uses a bounded sample of labelled rows (``max_train``, a documented parameter); scoring covers every row as a
sparse dot product in Arrow batches. The model is one float vector of ``2**bits`` entries, so what is sent to the
executors does not grow with the input.

Defined results: a null or empty text has the bias as its only feature; rows with a null label are not learned from;
a document labelled twice is learned with its larger label; without any labelled row every score is 0.5; every row
is scored by its own text, also those with a null or a repeated doc_id; other columns are passed on by keep_good
unchanged, whatever their types and names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import chunks, crc_mod
from lakemill.llm.tokens import hashes, joined, mix, spans

#: byte classes: 0 blank, 1 word, 2 sign, 3 line end
KINDS = np.full(256, 2, np.uint8)
KINDS[[9, 11, 12, 13, 32]] = 0
KINDS[10] = 3
KINDS[48:58] = KINDS[65:91] = KINDS[97:123] = KINDS[128:] = 1


@dataclass(frozen=True)
class Ftrl:
    """Settings of the per-coordinate update (McMahan et al., 2013)."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 3
    max_train: int = 8000


def features(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, buckets, values): per text the hashed 1- and 2-grams with log counts, scaled to unit length.

    Runs of word characters and runs of signs are tokens; a token that repeats the one before it also counts
    under one bucket of its own. Bucket 0 is the bias.
    """
    data, starts = joined(texts)
    s, e = spans(KINDS[data])
    h = hashes(data, s, e)
    at = np.concatenate((np.searchsorted(s, starts), [len(s)]))
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    same = doc[1:] == doc[:-1]
    pair = mix(h[:-1] * np.uint64(3) + h[1:])
    pair[h[1:] == h[:-1]] = np.uint64(0xC0FFEE << 40)
    grams = np.concatenate((h, pair[same]))
    rows = np.concatenate((doc, doc[1:][same]))
    bucket = (grams >> np.uint64(64 - bits)).astype(np.int64)
    bucket[bucket == 0] = 1
    key, count = np.unique((rows << bits) | bucket, return_counts=True)
    rows, bucket = key >> bits, key & ((1 << bits) - 1)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(rows, value * value, len(texts)))
    value = value / norm[rows]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(texts)))))
    return offsets, bucket, value


class Learner:
    """FTRL-proximal, one example after the other."""

    def __init__(self, p: Ftrl, zeros: int, ones: int):
        self.p, self.z, self.n = p, np.zeros(1 << p.bits), np.zeros(1 << p.bits)
        self.weight = ((zeros + ones) / (2 * max(1, zeros)), (zeros + ones) / (2 * max(1, ones)))  # both classes count alike

    def current(self, i: np.ndarray) -> np.ndarray:
        zi, p = self.z[i], self.p
        w = (np.sign(zi) * p.l1 - zi) / ((p.beta + np.sqrt(self.n[i])) / p.alpha + p.l2)
        return np.where(np.abs(zi) <= p.l1, 0.0, w)

    def learn(self, i: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.current(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x * self.weight[y]
        sigma = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.p.alpha
        self.z[i] += g - sigma * w
        self.n[i] += g * g

    def weights(self) -> np.ndarray:
        return self.current(np.arange(1 << self.p.bits)).astype(np.float32)


def _with_bias(i: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(([0], i)), np.concatenate(([1.0], x))


def train(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl(), label: str = "quality") -> np.ndarray:
    """Weights learned from at most about p.max_train labelled rows, drawn by a hash of doc_id."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    total = known.count()
    parts = 1 << 20
    take = parts if total <= p.max_train else int(parts * p.max_train / total)
    # of bounded size: about max_train ids and labels
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < take)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "text", "_y")

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].fillna("").tolist()
            for a, z in chunks(texts):
                off, i, x = features(texts[a:z], p.bits)
                yield pd.DataFrame({"h": b["h"].to_numpy()[a:z], "y": b["_y"].to_numpy()[a:z], "i": [i[s:e].astype(np.int32) for s, e in zip(off[:-1], off[1:])], "x": [x[s:e] for s, e in zip(off[:-1], off[1:])]})

    zeros, ones = chosen.agg(F.count_if(F.col("_y") == 0), F.count_if(F.col("_y") != 0)).first()

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Learner(p, zeros, ones)
        for b in batches:
            for i, x, y in zip(b["i"], b["x"], b["y"]):
                m.learn(*_with_bias(np.asarray(i, np.int64), np.asarray(x)), int(y))
        yield pd.DataFrame({"w": [m.weights().tobytes()]})

    vectors = sample.mapInPandas(grams, "h long, y int, i array<int>, x array<double>")
    # every epoch goes through the sample in the order of its hashes; rows stream through the one task
    turns = vectors.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(p.epochs)))).repartition(1).sortWithinPartitions("epoch", "h", "y")
    got = turns.select("y", "i", "x").mapInPandas(learn, "w binary").collect() if zeros + ones else []
    return np.frombuffer(got[0]["w"], np.float32) if got else np.zeros(1 << p.bits, np.float32)


def score(docs: DataFrame, weights: np.ndarray, bits: int = Ftrl.bits, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns `keep` of docs and, under `name`, the probability of label 1, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    fields = [f for f in docs.schema.fields if f.name in keep]
    columns = list(dict.fromkeys([f.name for f in fields] + ["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for b in batches:
            texts = [t or "" for t in b.column(columns.index("text")).to_pylist()]
            out = np.empty(len(texts))
            for a, z in chunks(texts, 1 << 19):
                off, i, x = features(texts[a:z], bits)
                dots = np.concatenate(([0.0], np.cumsum(w[i] * x)))
                out[a:z] = 1 / (1 + np.exp(-np.clip(w[0] + dots[off[1:]] - dots[off[:-1]], -30, 30)))
            # what is kept stays in Arrow, whatever its type
            yield pa.RecordBatch.from_arrays([*b.columns[: len(fields)], pa.array(out)], names=[*(f.name for f in fields), name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{name}` double"
    return docs.select(*columns).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; rows with crc32(doc_id) mod 3 = 1 are not learned from."""
    held = crc_mod("doc_id", 3) == 1
    w = train(docs, labels.where(~held), p)
    return score(docs, w, p.bits).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """The rows of docs, unchanged, whose score is 0.5 or more."""
    w = train(docs, labels.where(crc_mod("doc_id", 3) != 1), p)
    names = docs.columns
    own = "_score"
    while own in names:
        own += "_"
    return score(docs, w, p.bits, tuple(names), own).where(F.col(own) >= 0.5).select(*names)
