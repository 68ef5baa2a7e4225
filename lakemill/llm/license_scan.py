"""Licence scan with fuzzy short-notice search.

A notice of length n matched with at most k edits holds at least one of k + 1 consecutive pieces unchanged
(pigeonhole), so exact hits of the pieces, found for all notices at once by one automaton, locate every candidate.
The regex library's bounded-error matching then verifies the few characters around each hit and gives the span.

Edits must not fall on what tells licences apart: the words of a span that name a family, a kind or a version (grown to
whole words) are exactly those of its notice, or it is no match.

Defined results: a null text is empty; an empty text has no words, no labels and score 0; texts are read whole,
however long; of overlapping spans the one most like its notice is reported, then the longer, then the first; repeated
rows give equal rows; an empty table gives an empty one; other columns of docs are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakemill.llm.common import chunks
from lakemill.llm.tokens import ALNUM, LOWER, joined, spans

#: fixed values of the contract: phrase, label
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: families of licences that notices name, with their versions ("": named without one)
FAMILIES = [
    ("mit license", "mit", [""]),
    ("apache license", "apache", ["", "1.0", "1.1", "2.0"]),
    ("gnu general public license", "gpl", ["", "1", "2", "3"]),
    ("gnu lesser general public license", "lgpl", ["", "2.1", "3"]),
    ("gnu library general public license", "lgpl", ["", "2"]),
    ("gnu affero general public license", "agpl", ["", "3"]),
    ("gnu free documentation license", "gfdl", ["", "1.1", "1.2", "1.3"]),
    ("mozilla public license", "mpl", ["", "1.0", "1.1", "2.0"]),
    ("eclipse public license", "epl", ["", "1.0", "2.0"]),
    ("european union public licence", "eupl", ["", "1.1", "1.2"]),
    ("common development and distribution license", "cddl", ["", "1.0", "1.1"]),
    ("boost software license", "bsl", ["", "1.0"]),
    ("artistic license", "artistic", ["", "1.0", "2.0"]),
    ("academic free license", "afl", ["", "3.0"]),
    ("sil open font license", "ofl", ["", "1.0", "1.1"]),
    ("isc license", "isc", [""]),
    ("zlib license", "zlib", [""]),
    ("bsd 2-clause license", "bsd-2-clause", [""]),
    ("bsd 3-clause license", "bsd-3-clause", [""]),
    ("bsd 4-clause license", "bsd-4-clause", [""]),
    ("bsd license", "bsd", [""]),
    ("unlicense", "unlicense", [""]),
]
#: kinds and versions of the attribution licences
CC_KINDS = ["by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = ["", "1.0", "2.0", "2.5", "3.0", "4.0"]
#: first lines of licence texts and other set phrases
SET_PHRASES = [
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms, with or without modification", "bsd"),
    ("permission to use, copy, modify, and/or distribute this software for any purpose", "isc"),
    ("this software is provided 'as-is', without any express or implied warranty", "zlib"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("do what the fuck you want to public license", "wtfpl"),
    ("creative commons zero", "cc0"),
    ("public domain dedication", "cc0"),
    ("spdx-license-identifier", "spdx"),
]
_WORD = "[0-9a-z\x80-\U0010ffff]"


def _notices() -> list[tuple[str, str]]:
    """(notice, label) of all short notices, lower case, made from the families."""
    out = list(SET_PHRASES)
    for name, label, versions in FAMILIES:
        for v in versions:
            tag = f"{label}-{v + '.0' if label in ('gpl', 'lgpl', 'agpl') and '.' not in v else v}" if v else label
            if v:
                out += [(f"{name}, version {v}", tag), (f"{name} version {v}", tag), (f"{name} {v}", tag), (f"{name} v{v}", tag)]
            out.append((name if not v else f"{name} ({tag})", tag))
            out.append((f"licensed under the {name}" + (f", version {v}" if v else ""), tag))
            out.append((f"released under the {name}" + (f", version {v}" if v else ""), tag))
    for kind in CC_KINDS:
        for v in CC_VERSIONS:
            tag = f"cc-{kind}" + (f"-{v}" if v else "")
            out += [(f"licensed under cc {kind} {v}".rstrip(), tag), (f"cc {kind} {v}".rstrip(), tag), (f"cc-{kind}-{v}".rstrip("-"), tag)]
    long = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
    for kind in CC_KINDS:
        name = "creative commons " + "-".join(long[x] for x in kind.split("-"))
        for v in CC_VERSIONS:
            out.append((f"{name} {v}".rstrip(), f"cc-{kind}" + (f"-{v}" if v else "")))
            if v:
                out.append((f"{name} {v} international license", f"cc-{kind}-{v}"))
    return list(dict.fromkeys(out))


NOTICES = _notices()
#: words that tell notices apart, besides versions
_TELLING = frozenset(
    "mit apache gnu gpl lgpl agpl gfdl lesser library affero documentation mozilla mpl eclipse epl european eupl cddl distribution boost artistic academic sil font isc zlib bsd clause unlicense wtfpl "
    "cc by sa nc nd attribution sharealike noncommercial noderivatives zero spdx ms microsoft oracle sun ibm intel python ruby php perl lua qt x11 ncsa w3c zpl postgresql openssl proprietary commercial".split()
)
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*)")
_TOKENS = re.compile(r"\d+(?:\.\d+)+|[0-9a-z\x80-\U0010ffff]+")


def telling(text: str) -> tuple[str, ...]:
    """The words of a lower-case text that name a family, a kind or a version, sorted; 2 and 2.0 are one version."""
    out = []
    for w in _TOKENS.findall(text):
        if m := _VERSION.fullmatch(w):
            v = m[1]
            while v.endswith(".0"):
                v = v[:-2]
            out.append(v)
        elif w in _TELLING:
            out.append(w)
    return tuple(sorted(set(out)))


def edits(notice: str, per: int = 12) -> int:
    """Edits allowed: one for every `per` characters."""
    return len(notice) // per


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """k + 1 consecutive pieces of nearly equal length, with their offsets."""
    cut = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut, cut[1:])]


_INSIDE = re.compile(_WORD)
#: what may stand around a version or a word that a span ends within
_HEAD = re.compile(r"[0-9a-z\x80-\U0010ffff]*\Z")
_TAIL = re.compile(r"(?:[0-9a-z\x80-\U0010ffff]|\.(?=\d))*")


def grown(text: str, start: int, end: int) -> str:
    """The span with the words (and versions) it begins or ends within completed."""
    if start < len(text) and _INSIDE.match(text, start):
        while start and _INSIDE.match(text, start - 1):
            start -= 1
    if end and _INSIDE.match(text, end - 1):
        end = _TAIL.match(text, end).end()
    return text[start:end]


class Scanner:
    """The automaton of all pieces and the bounded-error patterns; made once in each worker."""

    def __init__(self, notices: list[tuple[str, str]]):
        import ahocorasick
        import regex

        self.notices = [(n, label, edits(n), telling(n)) for n, label in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k, _) in enumerate(self.notices):
            for off, piece in pieces(n, k):
                seeds.setdefault(piece, []).append((i, off))
        self.automaton = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k, _ in self.notices]

    def candidates(self, text: str) -> list[tuple[int, int, str, float]]:
        """start, end, label, similarity of every notice in the lower-case text that agrees in the telling words."""
        tried: set[tuple[int, int]] = set()
        out: set[tuple[int, int, str, float]] = set()
        for end, (length, where) in self.automaton.iter(text):
            for i, off in where:
                n, label, k, words = self.notices[i]
                at = end + 1 - length - off
                if (i, at) in tried:
                    continue
                tried.add((i, at))
                lo, hi = max(0, at - k), min(len(text), at + len(n) + k)
                # a notice whose telling words are not even near is not there
                near = telling(grown(text, lo, hi))
                if not set(words) <= set(near):
                    continue
                m = self.patterns[i].search(text, lo, hi)
                if m and telling(grown(text, m.start(), m.end())) == words:
                    out.add((m.start(), m.end(), label, 1 - sum(m.fuzzy_counts) / len(n)))
        return sorted(out)

    def find(self, text: str) -> list[tuple[int, int, str, float]]:
        """The candidates that do not overlap: those most like their notice first, then the longer, then the first."""
        out: list[tuple[int, int, str, float]] = []
        # candidates that overlap stand near each other: groups of them are few and short
        group: list[tuple[int, int, str, float]] = []
        reach = -1
        for c in [*self.candidates(text), None]:
            if c is None or c[0] >= reach:
                taken: list[tuple[int, int, str, float]] = []
                for x in sorted(group, key=lambda x: (-(x[1] - x[0]) * x[3], -x[3], x)):
                    if all(x[1] <= y[0] or x[0] >= y[1] for y in taken):
                        taken.append(x)
                out += sorted(taken)
                group = []
            if c is not None:
                group.append(c)
                reach = max(reach, c[1])
        return out


@lru_cache(maxsize=1)
def _scanner(notices: tuple) -> Scanner:
    return Scanner(list(notices))


@lru_cache(maxsize=1)
def _phrases() -> list[tuple[re.Pattern, str]]:
    gap = "[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    return [(re.compile(f"(?<!{_WORD}){gap.join(p.split())}(?!{_WORD})"), label) for p, label in PHRASES]


def scan_text(text: str, notices: tuple) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
    """(character, label) of each base phrase, and the fuzzy notices, of a text whose A-Z are lower-cased."""
    base = []
    if "license" in text or "cc" in text:
        base = [(m.start(), label) for p, label in _phrases() for m in p.finditer(text)]
    return base, _scanner(notices).find(text)


_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(f"{_WORD}+")


def _folded(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_FOLD)


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("similarity", pa.float64())]))
_FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("found", _FOUND)]


def scan(docs: DataFrame, notices: tuple = tuple(NOTICES)) -> DataFrame:
    """Per row of docs (doc_id, text): the contract's columns and `found`, the notices with spans and similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = []
            for a, z in chunks(texts):
                data, starts = joined(texts[a:z])
                s, _ = spans(ALNUM[LOWER[data]])
                n_words = np.diff(np.concatenate((np.searchsorted(s, starts), [len(s)])))
                for t, n in zip(texts[a:z], n_words.tolist()):
                    t = _folded(t)
                    base, found = scan_text(t, notices)
                    if not base and not found:
                        rows.append((n, 0, None, None, "", "", 0.0, []))
                        continue
                    first, last = (len(_WORDS.findall(t, 0, p)) for p in (min(base)[0], max(base)[0])) if base else (None, None)
                    labels = sorted({x for _, x in base})
                    every = sorted({*labels, *(f[2] for f in found)})
                    rows.append((n, len(base), first, last, ",".join(labels), ",".join(every), 1.0 if base else max(f[3] for f in found), [{"start": f[0], "end": f[1], "label": f[2], "similarity": f[3]} for f in found]))
            columns = list(zip(*rows)) or [()] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS))], names=["doc_id", *(n for n, _ in _FIELDS)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, found array<struct<start:int,end:int,label:string,similarity:double>>")
