"""Vectorised word hashing for tasks: whole batches of texts become flat numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain splitmix64 constants)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _R, np.uint64), np.full(n, _R_INV, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def table_of(word_bytes: bytes) -> np.ndarray:
    """A 256-entry class table: 1 for the bytes of words (every byte of a non-ASCII character is one)."""
    t = np.zeros(256, np.uint8)
    t[list(word_bytes)] = 1
    t[128:] = 1
    return t


ALNUM = table_of(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts with a newline after each, and where each text starts."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(parts), np.int64)
    if len(parts) > 1:
        np.cumsum([len(p) + 1 for p in parts[:-1]], out=starts[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8), starts


def spans(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of one non-zero class."""
    cut = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    start = np.concatenate(([0], cut))
    end = np.concatenate((cut, [len(kind)]))
    keep = kind[start] != 0
    return start[keep], end[keep]


def span_hasher(data: np.ndarray):
    """A function from starts and ends to 64-bit hashes of these spans of data, equal for equal spans wherever they stand."""
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    acc = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=acc[1:])
    return lambda start, end: mix((acc[end] - acc[start]) * down[start] + (end - start).astype(np.uint64))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hasher(data)(start, end)


def words(texts: list[str], kinds: np.ndarray = ALNUM, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the offsets at which each text's words begin (one more than texts)."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data, starts = joined(texts)
    if fold:
        data = LOWER[data]
    s, e = spans(kinds[data])
    at = np.concatenate((np.searchsorted(s, starts), [len(s)]))
    return hashes(data, s, e), at
