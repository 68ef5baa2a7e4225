"""Vector code compression: product codes whose nearest entries are found by slice-and-intersect bitmasks.

Of each codebook every dimension's coordinates are sorted, and prefix j of the order has the 64-bit mask of its j
entries. An entry within a radius of a vector's part lies, in each dimension, in one slice of the order, whose mask is
the difference of two prefix masks; the AND over the dimensions leaves the candidates. The initial radius is the
distance to the best of the entries nearest in one dimension each, so the nearest entry, and every entry that ties with
it, is always among the candidates, and the result is exact. Only candidates' distances are worked out.

Each round is one pass in which a task adds up counts and component sums of its own rows; Spark sums them by codebook
slot, and the driver holds the codebooks alone (parts * entries * dimensions numbers).

Defined results: rows count as `vectors.usable` says, with entries below 2**18 in size (so that 256 times them, and
squared distances, are exact in 64 bits). Where the length is no multiple of the parts, part i ends at
floor((i + 1) * length / parts); an empty part has code 00. Rows with null vec_id are coded but start no entry; ids
that stand twice start two entries, ordered by vector. With fewer than 64 rows there are fewer entries. An empty table
gives an empty one. Other columns are ignored; a missing label counts as null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import sized, written
from lakemill.llm.vectors import matrix, usable

SCALE = 256
ONE = np.uint64(1)


def part_ends(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


class Masks:
    """One codebook (entries x dimensions, at most 64 entries), ready for exact nearest-entry search."""

    def __init__(self, book: np.ndarray):
        if not 1 <= len(book) <= 64:
            raise ValueError("a codebook has 1 to 64 entries")
        self.book = book
        order = np.argsort(book, axis=0, kind="stable")
        self.values = np.take_along_axis(book, order, axis=0).T
        bits = ONE << order.T.astype(np.uint64)
        self.order = order.T
        self.prefix = np.concatenate((np.zeros((book.shape[1], 1), np.uint64), np.bitwise_or.accumulate(bits, axis=1)), axis=1)

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.book[entry]) ** 2).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """A whole number not below the distance to the nearest entry."""
        best = None
        for d, values in enumerate(self.values):
            at = np.clip(np.searchsorted(values, x[:, d]), 1, len(values) - 1) if len(values) > 1 else np.zeros(len(x), np.int64)
            at = at - (2 * x[:, d] < values[at - 1] + values[at]) if len(values) > 1 else at
            far = self.distance(x, self.order[d][at])
            best = far if best is None else np.minimum(best, far)
        return np.floor(np.sqrt(best.astype(np.float64))).astype(np.int64) + 1

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row of x the mask of the entries within radius in every dimension."""
        mask = np.full(len(x), ~np.uint64(0))
        for d, values in enumerate(self.values):
            low, high = np.searchsorted(values, x[:, d] - radius, "left"), np.searchsorted(values, x[:, d] + radius, "right")
            mask &= self.prefix[d][high] ^ self.prefix[d][low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lowest of equals) and squared distance, for each row of x."""
        index, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not x.shape[1] or not len(x):
            return index, error
        mask, rows = self.candidates(x, self.radius(x)), np.arange(len(x))
        error[:] = np.iinfo(np.int64).max
        while len(rows):
            low = mask & (~mask + ONE)
            entry = np.bitwise_count(low - ONE).astype(np.int64)
            far = self.distance(x[rows], entry)
            better = far < error[rows]
            index[rows[better]], error[rows[better]] = entry[better], far[better]
            mask = mask ^ low
            left = mask != 0
            mask, rows = mask[left], rows[left]
        return index, error


def _seeds(rows: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, which start the codebooks: at most `entries` rows."""
    first = rows.where("vec_id is not null").orderBy("vec_id", "vec").limit(entries).collect()
    return np.array([np.floor(SCALE * np.array(r["vec"])) for r in first], np.int64)


def _sums(rows: DataFrame, books: list[np.ndarray], ends: list[int]) -> dict[int, int]:
    """slot -> sum over all rows: of each part's entry, how many rows have it and the sums of their components."""
    width = max(b.shape[1] for b in books) + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [Masks(b) for b in books]
        total = np.zeros((len(books), len(books[0]), width), np.int64)
        for b in batches:
            x = matrix(b.column(0), SCALE)
            for i, m in enumerate(masks if len(x) else []):
                part = x[:, ends[i] : ends[i + 1]]
                entry, _ = m.nearest(part)
                np.add.at(total[i, :, 0], entry, 1)
                np.add.at(total[i, :, 1 : part.shape[1] + 1], entry, part)
        flat = total.reshape(-1)
        slot = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(flat[slot])], ["slot", "value"])

    return {r["slot"]: r["value"] for r in rows.select("vec").mapInArrow(add, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).collect()}


def codebooks(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[list[np.ndarray], list[int]]:
    """The codebooks (one for each part) after the rounds, and where the parts end; none for an empty table."""
    seeds = _seeds(rows, entries)
    if not len(seeds):
        return [], []
    ends = part_ends(seeds.shape[1], parts)
    books = [seeds[:, a:b] for a, b in zip(ends, ends[1:])]
    for _ in range(rounds):
        total, width = _sums(rows, books, ends), max(b.shape[1] for b in books) + 1
        new = []
        for i, book in enumerate(books):
            at = [(i * len(book) + k) * width for k in range(len(book))]
            new.append(np.array([[total.get(s + 1 + j, 0) // total[s] for j in range(book.shape[1])] if total.get(s) else list(book[k]) for k, s in enumerate(at)], np.int64).reshape(book.shape))
        books = new
    return books, ends


def encode(rows: DataFrame, books: list[np.ndarray], ends: list[int]) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error of all rows."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [Masks(b) for b in books]
        for b in batches:
            x = matrix(b.column(2), SCALE)
            found = [m.nearest(x[:, ends[i] : ends[i + 1]]) for i, m in enumerate(masks)] if len(x) else []
            text = np.stack([e for e, _ in found], axis=1).astype(np.uint8) if found else np.zeros((0, 0), np.uint8)
            error = sum((d for _, d in found), np.zeros(len(x), np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([bytes(t).hex() for t in text], pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    kind = dict(rows.dtypes)
    return rows.select("vec_id", "label", "vec").mapInArrow(code, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def decode(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """codes with `vec`, the vector that the code stands for (in the units of the table)."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = [np.concatenate([book[e] for book, e in zip(books, bytes.fromhex(c))]) / SCALE for c in b.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([v.tolist() for v in vecs], pa.list_(pa.float64()))], [*b.schema.names, "vec"])

    return codes.mapInArrow(back, ", ".join(f"`{n}` {t}" for n, t in codes.dtypes) + ", vec array<double>")


def compress(embeddings: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, spread: int = 16) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that counts."""
    rows = usable(embeddings, float(1 << 18))
    books, ends = codebooks(rows, parts, entries, rounds)
    if not books:
        books, ends = [np.zeros((1, 0), np.int64)] * parts, [0] * (parts + 1)
    coded = written(encode(rows, books, ends))
    labels = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    few = sized(labels.withColumnRenamed("label", "_label"))
    # where there are too many labels to send them along, each label's sum goes to several parts, among which its rows are dealt
    few = few.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    dealt = coded.withColumn("_p", F.pmod(F.xxhash64("vec_id", "code"), F.lit(spread)).cast("int"))
    out = dealt.join(few, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_p") == F.col("_part")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
