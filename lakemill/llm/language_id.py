"""Language identification with rank-order profiles and the out-of-place distance (Cavnar and Trenkle, 1994).

A profile is the list of a language's ``size`` most frequent character n-grams (1 to 3 letters, words padded with a
blank), counted over all learnable documents. A document's own list of the same size is compared with each profile:
the distance is the sum of rank differences, and an n-gram the profile lacks costs ``size``.

Defined results: text null or without a letter gives ``und`` with score 0; ties between n-grams go to the smaller code,
ties between languages to the smaller name; rows with null lang or null text teach nothing; without any learned
profile every row is ``und``; every row is judged by its own text, also those with a null or a repeated doc_id; more
than ``max_langs`` different values of lang are an error; an empty table gives an empty one; other columns are ignored. The score is 1 minus the distance over the largest possible one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import chunks, crc_mod, written

SIZE = 300
_BITS = np.uint64(21)


def _letters(codes: np.ndarray, known: dict) -> np.ndarray:
    """codes with every character that is no letter turned to 0; `known` remembers characters over calls."""
    if not len(codes):
        return codes
    if int(codes.max()) < 0x3000:
        table = known.get("table")
        if table is None:
            table = known["table"] = np.array([c if chr(c).isalpha() else 0 for c in range(0x3000)], np.uint32)
        return table[codes]
    kinds, back = np.unique(codes, return_inverse=True)
    return np.array([c if chr(c).isalpha() else 0 for c in kinds.tolist()], np.uint32)[back]


def ngrams(text: str, known: dict) -> np.ndarray:
    """Sorted codes of all 1- to 3-grams of the text's words; empty if it has no letter."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = _letters(raw, known)
    c = np.concatenate((np.zeros(1, np.uint32), c, np.zeros(1, np.uint32)))
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    c = c[keep].astype(np.uint64)
    if len(c) < 3 and not c.any():
        return np.zeros(0, np.uint64)
    one = c[c != 0]
    two = (c[:-1] << _BITS) | c[1:] | np.uint64(1 << 62)
    three = ((c[:-2] << _BITS | c[1:-1]) << _BITS | c[2:])[c[1:-1] != 0] | np.uint64(1 << 63)
    return np.sort(np.concatenate((one, two, three)))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], np.diff(np.concatenate((edge, [len(keys)])))


def top(keys: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code. keys are sorted."""
    kind, count = _counted(keys)
    if len(kind) > size:
        least = np.partition(count, len(count) - size)[len(count) - size]
        some = count >= least
        kind, count = kind[some], count[some]
    return kind[np.lexsort((kind, -count))][:size]


def profiles(docs: DataFrame, size: int = SIZE, max_langs: int = 2000) -> dict[str, list[int]]:
    """The top n-gram codes of each language of docs (text, lang); at most `size` codes a language reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for b in batches:
            for lang, part in b.groupby("lang"):
                texts = part["text"].tolist()
                for a, z in chunks(texts, 1 << 21):
                    kind, n = _counted(ngrams(" ".join(texts[a:z]), known))
                    yield pd.DataFrame({"lang": lang, "gram": kind.view(np.int64), "n": n})

    counts = docs.where("lang is not null and text is not null").select("lang", "text").mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # negative codes are 3-grams: as unsigned numbers they come last, as in top()
    order = Window.partitionBy("lang").orderBy(F.desc("n"), (F.col("gram") < 0).cast("int"), "gram")
    best = written(counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= size))
    # a profile is a few KB; a column with this many names holds no languages
    if (n := best.agg(F.count_distinct("lang")).first()[0]) > max_langs:
        raise ValueError(f"{n} languages to learn; at most {max_langs} are sent to the executors")
    out: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "r").collect():
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


class Ranker:
    """Profiles laid out for lookups of many n-grams at once."""

    def __init__(self, learned: dict[str, list[int]], size: int = SIZE):
        self.size, self.langs = size, sorted(learned)
        self.keys = np.unique(np.array([g for v in learned.values() for g in v], np.int64).view(np.uint64)) if learned else np.zeros(0, np.uint64)
        self.rank = np.full((len(self.langs), len(self.keys) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            mine = np.array(learned[lang], np.int64).view(np.uint64)
            self.rank[k, np.searchsorted(self.keys, mine)] = np.arange(len(mine))

    def best(self, grams: np.ndarray) -> tuple[str, float]:
        if not len(grams) or not self.langs:
            return "und", 0.0
        mine = top(grams, self.size)
        at = np.searchsorted(self.keys, mine)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != mine)] = len(self.keys)
        rank = self.rank[:, at]
        far = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(mine)))).sum(axis=1)
        k = int(np.argmin(far))
        return self.langs[k], float(1 - far[k] / (self.size * len(mine)))


def predict(docs: DataFrame, learned: dict[str, list[int]], size: int = SIZE) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker, known = Ranker(shared.value, size), {}
        for b in batches:
            got = [ranker.best(ngrams(t, known)) if t else ("und", 0.0) for t in b.column(1).to_pylist()]
            # ids stay in Arrow: pandas would turn a column of numbers with a null into floats
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from rows whose crc32(doc_id) mod 4 is not 2."""
    held = crc_mod("doc_id", 4) == 2
    learned = profiles(docs.where(~held), size)
    return predict(docs, learned, size).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
