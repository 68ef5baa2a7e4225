"""SentencePiece encoding and decoding with Gumbel top-k sampling of segmentations, without replacement.

A text is cut into units (blanks and the non-blank run behind them; no piece reaches over a unit's end). The lattice
of a unit has a state for each character and an edge for each vocabulary piece; characters that no piece covers have a
byte-fallback edge, so every text can be encoded and decoded exactly. An edge's log weight is the piece's score
divided by ``temperature``, where a merge-rank score r is read as -log(1 - r) (Zipf's law). The exact sum over all
completions of a state, computed backwards, is the bound of the search.

Perturbed A* (Kool, van Hoof and Welling, 2019; Maddison et al., 2014): the best segmentation is drawn edge by edge
from the exact conditional probabilities, and its perturbed value G is the root's. Each state along it leaves a side
branch, the mass of the edges not taken, whose own perturbed value is a Gumbel truncated at G; the best side branch of
all paths found so far is expanded next. This gives the k segmentations of largest perturbed log probability: a sample
without replacement. With kappa the (k+1)-th value, ``inclusion`` is 1 - exp(-exp(log p - kappa)).

All draws are a hash of (row key, segmentation number, unit, step), so a row gives the same result in any batch, task
or retry. The lattices of a chunk's distinct units are laid out together, and all its texts advance together, in numpy.

Defined results: a null or empty text has one segmentation, of no pieces, with log probability 0 and inclusion 1; a
text with fewer than k segmentations gives all of them, with inclusion 1; repeated rows with one key give equal rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import chunks
from lakemill.llm.tokens import hashes, mix, span_hasher

MODEL = os.environ.get("LAKEMILL_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: characters whose texts are worked on together
CHUNK = 1 << 18
#: log weight of the byte fallback of a character that no piece covers
FALLBACK = -12.0
_BLANK = "▁"


@lru_cache(maxsize=2)
def vocabulary(model: str) -> tuple[dict[str, tuple[int, float]], list[int], list[bytes]]:
    """Pieces with id and log weight, the ids of the 256 byte pieces, and the bytes each id decodes to."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, raw, out = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            b = int(p[3:5], 16)
            raw[b] = i
            out.append(bytes([b]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(b"")
        else:
            pieces[p.replace(_BLANK, " ")] = (i, -log(1 - min(0.0, sp.get_score(i))))
            out.append(p.replace(_BLANK, " ").encode())
    return pieces, raw, out


@lru_cache(maxsize=2)
def _table(model: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted hashes of the pieces with their ids and log weights, marks of the first bits of pieces' and of all their
    beginnings' hashes, and the longest piece."""
    pieces = vocabulary(model)[0]
    names = list(pieces)
    codes = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
    end = np.cumsum([len(p) for p in names])
    h = hashes(codes, end - [len(p) for p in names], end)
    order = np.argsort(h)
    ids, weights = (np.array([pieces[p][c] for p in names])[order] for c in (0, 1))
    marks = np.zeros(1 << 20, np.uint8)  # bit 1: a piece may begin so; bit 2: it may be a piece
    begin = end - [len(p) for p in names]
    for size in range(1, max(map(len, names)) + 1):
        a = begin[begin + size <= end]
        marks[(hashes(codes, a, a + size) >> np.uint64(44)).astype(np.int64)] |= 1
    marks[(h >> np.uint64(44)).astype(np.int64)] |= 2
    h = h[order]
    guess = np.zeros(1 << 20, np.int32)  # of each first bits one piece, nearly always the only one
    guess[(h >> np.uint64(44)).astype(np.int64)] = np.arange(len(h))
    return h, ids.astype(np.int32), weights, marks, guess, max(map(len, names))


class Lattice:
    """States and edges of distinct units, laid out together in flat arrays that grow with the units seen.

    Edges of state s are lo[s] .. lo[s] + n[s]; each has a piece id, a next state (-1: end of unit), its conditional
    probability and its log, the sum of those before it and the log of the sum of the state's others.
    A byte-fallback edge carries the first byte's id; the others follow through states of a single edge.
    """

    #: states after which a lattice starts over (about 200 bytes each)
    most = 1 << 20

    def __init__(self, model: str = MODEL, temperature: float = 2.0):
        self.model, self.temperature = model, temperature
        self.lo, self.n, self.next = (np.zeros(0, np.int64) for _ in range(3))
        self.p, self.logp, self.before, self.logrest = (np.zeros(0) for _ in range(4))
        self.id = np.zeros(0, np.int32)
        self._clear()

    def _clear(self) -> None:
        """Forgets all units; the arrays keep their room."""
        self.keys, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.states = self.edges = 0

    def _put(self, name: str, x: np.ndarray, at: int) -> None:
        """Writes x from place `at` on; the array gets more room than it needs just now."""
        old = getattr(self, name)
        if at + len(x) > len(old):
            new = np.empty((at + len(x)) * 3 // 2, old.dtype)
            new[:at] = old[:at]
            setattr(self, name, new)
            old = new
        old[at : at + len(x)] = x

    def starts(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first states of the units codes[begin:end], which are laid out if they are new."""
        keys, some, back = np.unique(hashes(codes, begin, end), return_index=True, return_inverse=True)
        if self.states > self.most:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            size = (end - begin)[some[new]]
            stop = np.cumsum(size)
            within = np.repeat(begin[some[new]] - (stop - size), size) + np.arange(stop[-1])
            first = self._add(codes[within], size)
            every, firsts = np.concatenate((self.keys, keys[new])), np.concatenate((self.first, first))
            order = np.argsort(every, kind="stable")
            self.keys, self.first = every[order], firsts[order]
        return self.first[np.searchsorted(self.keys, keys)][back]

    def _add(self, codes: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Lays out units that stand behind each other in codes; their first states."""
        raw = vocabulary(self.model)[1]
        keys, ids, weights, marks, guess, longest = _table(self.model)
        n = len(codes)
        unit_end = np.cumsum(length)
        stop = np.repeat(unit_end, length)  # of each character, its unit's end
        parts = []
        single = np.zeros(n, bool)
        hasher, a = span_hasher(codes), np.arange(n)
        for size in range(1, min(longest, int(length.max(initial=0))) + 1):
            a = a[a + size <= stop[a]]
            h = hasher(a, a + size)
            bits = (h >> np.uint64(44)).astype(np.int32)
            mark = marks[bits]
            maybe = np.flatnonzero(mark > 1)
            b, h, at = a[maybe], h[maybe], guess[bits[maybe]]
            hit = keys[at] == h
            if not hit.all():
                other = np.flatnonzero(~hit)
                at[other] = np.minimum(np.searchsorted(keys, h[other]), len(keys) - 1)
                hit[other] = keys[at[other]] == h[other]
            b, at = b[hit], at[hit]
            if size == 1:
                single[b] = True
            parts.append((b, b + size, ids[at], weights[at] / self.temperature))
            a = a[mark > 0]  # no piece begins with the others
        lost = np.flatnonzero(~single)
        parts.append((lost, lost + 1, np.full(len(lost), -1, np.int32), np.full(len(lost), FALLBACK / self.temperature)))
        # edges by state; the longest piece of a state comes first: it is the likeliest, and draws go through them in order
        count = np.zeros(n, np.int64)
        for b, *_ in parts:
            count[b] += 1
        lo = np.cumsum(count) - count
        total = int(count.sum())
        a, b, piece, w = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int32), np.empty(total)
        put = lo.copy()
        for x, y, i, v in parts[::-1]:
            to = put[x]
            a[to], b[to], piece[to], w[to] = x, y, i, v
            put[x] += 1
        ends = b == stop[a]
        # backwards over the distance from the unit's end, all units together; beta[n] stands for every end
        beta = np.zeros(n + 1)
        goal = np.where(ends, n, b)
        rest = stop[a] - a
        turn = np.argsort(rest.astype(np.uint16) if len(rest) and rest.max() < 1 << 16 else rest, kind="stable")
        w_, goal_, a_ = w[turn], goal[turn], a[turn]
        cuts = np.flatnonzero(np.diff(rest[turn], prepend=-1)).tolist()
        for i, j in zip(cuts, [*cuts[1:], len(turn)]):
            v = w_[i:j] + beta[goal_[i:j]]
            seg = np.flatnonzero(np.diff(a_[i:j], prepend=-1))
            top = np.maximum.reduceat(v, seg)
            v = np.exp(v - np.repeat(top, np.diff(np.append(seg, j - i))))
            beta[a_[i:j][seg]] = top + np.log(np.add.reduceat(v, seg))
        logp = w + beta[goal] - beta[a]
        p = np.exp(logp)
        # sums within each state, one rank of edges after the other, so that small ones are not lost beside large ones
        before, others, run = np.zeros(total), np.zeros(total), np.zeros(n)
        most = int(count.max(initial=0))
        ranks = [np.flatnonzero(count > r) for r in range(most)]
        for r, x in enumerate(ranks):
            before[lo[x] + r] = run[x]
            run[x] += p[lo[x] + r]
        run = np.zeros(n)
        for r, x in zip(range(most - 1, -1, -1), ranks[::-1]):
            others[lo[x] + r] = run[x] + before[lo[x] + r]
            run[x] += p[lo[x] + r]
        nxt = np.where(ends, -1, b + self.states)
        # bytes of characters without a piece
        more_id, more_next, base = [], [], self.states + n
        for e in np.flatnonzero(piece < 0).tolist():
            data = chr(codes[a[e]]).encode("utf-8", "surrogatepass")
            piece[e] = raw[data[0]]
            if len(data) > 1:
                after, nxt[e] = nxt[e], base + len(more_id)
                for x in data[1:-1]:
                    more_id.append(raw[x])
                    more_next.append(base + len(more_id))
                more_id.append(raw[data[-1]])
                more_next.append(after)
        k = len(more_id)
        with np.errstate(divide="ignore"):
            logrest = np.log(others)
        grown = {
            "lo": np.concatenate((lo, total + np.arange(k))) + self.edges, "n": np.concatenate((count, np.ones(k, np.int64))),
            "id": np.concatenate((piece, np.array(more_id, np.int32))), "next": np.concatenate((nxt, np.array(more_next, np.int64))),
            "p": np.concatenate((p, np.ones(k))), "logp": np.concatenate((logp, np.zeros(k))),
            "before": np.concatenate((before, np.zeros(k))), "logrest": np.concatenate((logrest, np.full(k, -np.inf))),
        }
        for name, x in grown.items():
            self._put(name, x, self.states if name in ("lo", "n") else self.edges)
        first = unit_end - length + self.states
        self.states, self.edges = self.states + n + k, self.edges + total + k
        return first


def uniform(key: np.ndarray, number: int = 0, unit=0, step=0) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key and the three numbers alone."""
    parts = np.asarray(unit, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(step, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = mix(key + np.uint64(number * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) + parts)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def truncated(loc: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel at loc given that it is below bound, by inversion: -log(exp(-bound) - exp(-loc) log u), in logs."""
    return -np.logaddexp(-bound, -loc + np.log(-np.log(u)))


#: numbers that keep the draws of different kinds apart
_SIDE, _ROOT, _TURN, _LEFT = 1 << 20, 1 << 21, 1 << 22, 1 << 23


def _walk(lat: Lattice, key: np.ndarray, unit: np.ndarray, state: np.ndarray, step: np.ndarray):
    """From each (unit, state) on to the unit's end: unit, step, state and edge of every step, in no order."""
    us, ts, ss, es = [], [], [], []
    live = state >= 0
    key, unit, state, step = key[live], unit[live], state[live], step[live]
    while len(state):
        e, many = lat.lo[state], np.flatnonzero(lat.n[state] > 1)
        u = uniform(key[many], 0, 0, step[many])
        at, last = e[many], e[many] + lat.n[state[many]] - 1
        more = np.flatnonzero((at < last) & (lat.p[at] <= u))
        while len(more):
            at[more] += 1
            more = more[(at[more] < last[more]) & (lat.before[at[more]] + lat.p[at[more]] <= u[more])]
        e[many] = at
        us.append(unit)
        ts.append(step)
        ss.append(state)
        es.append(e)
        state = lat.next[e]
        live = np.flatnonzero(state >= 0)
        key, unit, state, step = key[live], unit[live], state[live], step[live] + 1
    if not us:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    return tuple(np.concatenate(x) for x in (us, ts, ss, es))


def _ordered(unit, step, state, edge):
    """The steps in order of unit and step; the steps of a unit are 0, 1, 2 ..."""
    at = np.cumsum(np.bincount(unit)) if len(unit) else unit
    count = np.bincount(unit) if len(unit) else unit
    to = (at - count)[unit] + step
    out = []
    for x in (unit, step, state, edge):
        y = np.empty_like(x)
        y[to] = x
        out.append(y)
    return out


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0] + size[0] - 1, begin[1] .. and so on."""
    stop = np.cumsum(size)
    return np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


class _Paths:
    """One segmentation of each text in flat arrays of steps, with the perturbed values of the steps' side branches."""

    def __init__(self, lat, key, number, owner, inside, n, unit, step, state, edge, value, own_from):
        self.unit, self.step, self.state, self.edge, self.value = unit, step, state, edge, value
        self.text = text = owner[unit]
        self.size = np.bincount(text, minlength=n)
        self.offset = np.concatenate(([0], np.cumsum(self.size))).astype(np.int64)
        total = np.concatenate(([0.0], np.cumsum(lat.logp[edge])))
        self.before = total[:-1] - np.repeat(total[self.offset[:-1]], self.size)
        self.logp = total[self.offset[1:]] - total[self.offset[:-1]]
        self.side = lat.logrest[edge]
        # steps before the divergence belong to the path that this one left
        if own_from is not None:
            self.side[_ranges(self.offset[:-1], own_from)] = -np.inf
        self.taken: dict[int, list[int]] = {}
        open_ = np.flatnonzero(self.side > -np.inf)
        u = uniform(key[text[open_]], number + _SIDE, inside[unit[open_]], step[open_])
        self.side[open_] = truncated(self.before[open_] + self.side[open_], value[text[open_]], u)

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Per text the largest side value and its step; -inf where there is none."""
        n = len(self.size)
        top, where = np.full(n, -np.inf), np.zeros(n, np.int64)
        full = np.flatnonzero(self.size)
        if len(full):
            top[full] = np.maximum.reduceat(self.side, self.offset[:-1][full])
            at = np.flatnonzero(self.side == np.repeat(top, self.size))[::-1]
            where[self.text[at]] = at  # the first of equal ones is written last
        return top, where

    def expand(self, lat: Lattice, at: np.ndarray, bound: np.ndarray, pick: np.ndarray, again: np.ndarray) -> np.ndarray:
        """Draws one of the edges left at each of the steps `at`; what is left then gets a new value below bound."""
        lo, size = lat.lo[self.state[at]], lat.n[self.state[at]]
        begin = np.cumsum(size) - size
        q = lat.p[_ranges(lo, size)]
        q[begin + self.edge[at] - lo] = 0.0
        if self.taken:
            for i, m in enumerate(at.tolist()):
                for e in self.taken.get(m, ()):
                    q[begin[i] + e - lo[i]] = 0.0
        draw = pick * np.add.reduceat(q, begin)
        # through the edges left in order, all steps together; the last of them takes what rounding leaves
        got, run, after = np.full(len(at), -1, np.int64), np.zeros(len(at)), np.zeros(len(at))
        for r in range(int(size.max())):
            x = np.flatnonzero((size > r) & (q[np.minimum(begin + r, len(q) - 1)] > 0))
            v = q[begin[x] + r]
            taken = (got[x] < 0) | (run[x] <= draw[x])
            run[x] += v
            after[x[~taken]] += v[~taken]
            x, v = x[taken], v[taken]
            older = got[x]
            after[x[older >= 0]] += q[begin[x[older >= 0]] + older[older >= 0]]
            got[x] = r
        for m, e in zip(at.tolist(), (lo + got).tolist()):
            self.taken.setdefault(m, []).append(e)
        with np.errstate(divide="ignore"):
            rest = np.log(after)
        self.side[at] = -np.inf
        x = np.flatnonzero(rest > -np.inf)
        self.side[at[x]] = truncated(self.before[at[x]] + rest[x], bound[x], again[x])
        return lo + got


def units_of(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of the texts codes[starts:ends], which stand in order: each is blanks and what follows up to the next blank."""
    blank = codes == 32
    head = np.zeros(len(codes), bool)
    head[1:] = blank[1:] & ~blank[:-1]
    head[starts[starts < ends]] = True
    begin = np.flatnonzero(head)
    return begin, np.append(begin[1:], len(codes)) if len(begin) else begin


def sample(texts: list[str], keys: np.ndarray, k: int, lat: Lattice) -> tuple[list[_Paths], np.ndarray]:
    """The first k paths of all texts and, per text, the perturbed value of the best segmentation that is not among them (-inf: none).

    Of a text with fewer than k segmentations the later paths have the value -inf and are to be left out.
    """
    n = len(texts)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    begin, stop = units_of(codes, np.concatenate(([0], ends[:-1])), ends)
    owner = np.searchsorted(ends, begin, "right")
    first = lat.starts(codes, begin, stop) if len(begin) else begin
    count = np.bincount(owner, minlength=n)
    start = np.cumsum(count) - count
    # draws go by the unit's place in its own text, so that a text's neighbours in the batch do not matter
    inside = np.arange(len(owner)) - start[owner]
    value = gumbel(uniform(keys, _ROOT))
    unit_keys = mix(keys[owner] + mix(inside.astype(np.uint64)))

    def walk(number: int, unit: np.ndarray, state: np.ndarray, step: np.ndarray):
        # a unit's key holds its place; the walk adds the step
        return _walk(lat, unit_keys[unit] ^ mix(np.uint64(number)), unit, state, step)

    steps = _ordered(*walk(0, np.arange(len(owner)), first, np.zeros(len(owner), np.int64)))
    paths = [_Paths(lat, keys, 0, owner, inside, n, *steps, value, None)]
    for number in range(1, k + 1):
        # the best side branch of each text over all its paths
        best, which, at = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for j, p in enumerate(paths):
            top, where = p.best()
            better = top > best
            best[better], which[better], at[better] = top[better], j, where[better]
        if number == k:
            return paths, best
        # expand: draw one of the edges left, then walk on to the end of the text
        some = np.flatnonzero(best > -np.inf)
        pick, again = uniform(keys, number + _TURN), uniform(keys, number + _LEFT)
        old, new, turn = [], [], np.zeros(n, np.int64)
        for j, p in enumerate(paths):
            i = some[which[some] == j]
            if not len(i):
                continue
            m = at[i]
            e = p.expand(lat, m, best[i], pick[i], again[i])
            turn[i] = m - p.offset[i] + 1
            there = _ranges(p.offset[i], turn[i])
            edge = p.edge[there]
            edge[np.cumsum(turn[i]) - 1] = e
            old.append((p.unit[there], p.step[there], p.state[there], edge))
            new.append((p.unit[m], lat.next[e], p.step[m] + 1, start[i] + count[i]))
        if not new:
            return paths, best
        g, s, t, end = (np.concatenate(x) for x in zip(*new))
        later = np.flatnonzero(_after(g, end, len(owner)))
        walked = walk(number, np.concatenate((g, later)), np.concatenate((s, first[later])), np.concatenate((t, np.zeros(len(later), np.int64))))
        steps = _ordered(*(np.concatenate(x) for x in zip(*old, walked)))
        # the step of the divergence stays with the parent, whose side branch holds what is left there
        paths.append(_Paths(lat, keys, number, owner, inside, n, *steps, best, turn))
    return paths, best


def _after(unit: np.ndarray, stop: np.ndarray, n: int) -> np.ndarray:
    """Marks the units behind each given one, up to its text's end."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, unit + 1, 1)
    np.add.at(edge, stop, -1)
    return np.cumsum(edge)[:n] > 0


def decode_ids(ids: np.ndarray, offsets: np.ndarray, model: str = MODEL) -> list[str]:
    """The texts whose piece ids stand in ids[offsets[i]:offsets[i+1]]."""
    flat, start = _piece_bytes(model)
    size = (start[1:] - start[:-1])[ids]
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start[ids] - ends[:-1], size) + np.arange(ends[-1])
    data = flat[at].tobytes()
    cut = ends[offsets]
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(cut[:-1], cut[1:])]


@lru_cache(maxsize=2)
def _piece_bytes(model: str) -> tuple[np.ndarray, np.ndarray]:
    out = vocabulary(model)[2]
    return np.frombuffer(b"".join(out), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int64)


def segmentations(texts: list[str], keys: np.ndarray, k: int, lat: Lattice) -> tuple[np.ndarray, ...]:
    """row, sample_no, ids (flat), their offsets, log_prob and inclusion of all segmentations, rows in order."""
    paths, kappa = sample(texts, keys, k, lat)
    has = np.stack([p.value > -np.inf for p in paths], 1)
    row, no = np.nonzero(has)
    size = np.stack([p.size for p in paths], 1)[has]
    logp = np.stack([p.logp for p in paths], 1)[has]
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    ids = np.empty(offsets[-1], np.int32)
    for j, p in enumerate(paths):
        mine = no == j  # a path has steps of just the texts that it is a segmentation of
        ids[_ranges(offsets[:-1][mine], size[mine])] = lat.id[p.edge]
    gap = np.minimum(logp - kappa[row], 50.0)
    return row, no.astype(np.int32), ids, offsets, logp, np.where(kappa[row] == -np.inf, 1.0, -np.expm1(-np.exp(gap)))


def encode(docs: DataFrame, k: int = 2, temperature: float = 2.0, key: str = "doc_id", model: str = MODEL) -> DataFrame:
    """key, sample_no, ids, log_prob, inclusion, round_trip: k distinct sampled segmentations of every row of docs.

    docs has key and text. round_trip tells whether the ids, decoded where they are made, give the text again.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattice(model, temperature)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            seeds = b.column(2).to_numpy().view(np.uint64)
            for a, z in chunks(texts, CHUNK):
                row, no, ids, offsets, logp, inclusion = segmentations(texts[a:z], mix(seeds[a:z]), k, lat)
                same = [t == texts[a + i] for t, i in zip(decode_ids(ids, offsets, model), row.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(a + row)), pa.array(no), lists, pa.array(logp), pa.array(inclusion), pa.array(same)], names=[key, "sample_no", "ids", "log_prob", "inclusion", "round_trip"])

    src = docs.select(key, "text", F.xxhash64(F.col(key).cast("string")).alias("_seed"))
    return src.mapInArrow(run, f"`{key}` {kind}, sample_no int, ids array<int>, log_prob double, inclusion double, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """encoded, all of its columns but one named text, with the column text, decoded from ids (null ids: null)."""
    encoded = encoded.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.names.index("ids"))
            text: list[str | None] = []
            for a in range(0, len(lists), 500):
                part = lists.slice(a, 500)
                size = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                off = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
                got = decode_ids(part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), off, model)
                text += [t if ok else None for t, ok in zip(got, part.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], names=[*b.schema.names, "text"])

    return encoded.mapInArrow(run, schema)
