"""License scan by ordered signature rules.

A text is lower-cased and its words are the runs of ASCII letters, digits and
characters outside ASCII.  Rules are regular expressions over words (a blank
in a rule stands for any separators), each with a label, a confidence that
also is its priority, and a keyword.  One Aho-Corasick pass over a step of
texts finds the keywords; a rule runs only on texts that hold its keyword.
Overlapping detections are resolved by priority and containment: in order of
priority and length, a detection that lies inside one already kept is dropped.

No shuffle; tasks hold one step of whole texts.

Defined cases: a null or empty text has no words and no label; equal
detections go to the rule listed first; repeated rows are scanned each;
columns other than id and text are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import LOWER, steps, words
from tessera.llm.op6_rules import BASE, SPDX_IDS, WRITTEN

_WORD = "0-9a-z\x80-\xff"
GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Confidence of a place that only the base phrases find.
BASE_SCORE = 0.7


class Rule(NamedTuple):
    label: str
    score: float
    keyword: str
    pattern: re.Pattern


def _compile(pattern: str) -> re.Pattern:
    """Blanks become separators; the whole starts and ends at word edges."""
    return re.compile(f"(?<![{_WORD}])(?:{pattern.replace(' ', f'[^{_WORD}]+')})(?![{_WORD}])")


@functools.cache
def rules() -> tuple[Rule, ...]:
    """Priority order: identifier tags, then the written rules by confidence."""
    out = [Rule(i.lower(), 1.0, "spdx", _compile(
        "spdx license identifier " + " ".join(re.split(r"[^0-9a-z]+", i.lower())) + "(?: or later| only|(?! ?[0-9a-z+]))")) for i in
        sorted(SPDX_IDS, key=len, reverse=True)]
    out += [Rule(label, score, key, _compile(p)) for label, score, key, p in WRITTEN]
    return tuple(sorted(out, key=lambda r: -r.score))


@functools.cache
def _base() -> tuple[tuple[str, str, re.Pattern], ...]:
    return tuple((label, phrase.split()[0], _compile(phrase)) for phrase, label in BASE.items())


@functools.cache
def _machine():
    """Keyword -> numbers of the base phrases (negative) and rules it opens."""
    a: dict[str, list[int]] = {}
    for n, (_, key, _) in enumerate(_base()):
        a.setdefault(key, []).append(-n - 1)
    for n, r in enumerate(rules()):
        a.setdefault(r.keyword, []).append(n)
    m = ahocorasick.Automaton()
    for k, v in a.items():
        m.add_word(k, tuple(v))
    m.make_automaton()
    return m


def detect(text: str, opened: Iterable[int] | None = None) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) in a lower-cased text."""
    every = rules()
    found = [(m.start(), m.end(), every[n]) for n in (sorted(opened) if opened is not None else range(len(every)))
             for m in every[n].pattern.finditer(text)]
    kept: list[tuple[int, int, Rule]] = []
    for f in sorted(found, key=lambda x: (-x[2].score, x[0] - x[1])):
        if not any(k[0] <= f[0] and f[1] <= k[1] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda x: x[:2])


def scan_step(data: np.ndarray, off: np.ndarray) -> Iterator[dict]:
    low = LOWER[data]
    start, _, row = words(low, off, GAP)
    n_words = np.bincount(row, minlength=len(off) - 1)
    first = np.concatenate([[0], np.cumsum(n_words)])
    text = low.tobytes().decode("latin-1")  # one character a byte
    opened: dict[int, set[int]] = {}
    hits = [(end, what) for end, what in _machine().iter(text)]
    at = np.searchsorted(off, np.array([e for e, _ in hits], np.int64), "right") - 1
    for r, (_, what) in zip(at.tolist(), hits):
        opened.setdefault(r, set()).update(what)
    for r, n in enumerate(n_words.tolist()):
        out = {"n_words": n, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "n_found": 0}
        if what := opened.get(r):
            t, mine = text[off[r]:off[r + 1]], start[first[r]:first[r + 1]] - off[r]
            places, base = [], set()
            for x in sorted(what):
                if x < 0:
                    label, _, pattern = _base()[-x - 1]
                    if p := [m.start() for m in pattern.finditer(t)]:
                        places += p
                        base.add(label)
            kept = detect(t, [x for x in what if x >= 0])
            pos = np.searchsorted(mine, places).tolist()
            miss = 1.0
            for s in {f[2].label: f[2].score for f in reversed(kept)}.values():
                miss *= 1 - s
            out |= {"n_base": len(places), "base_labels": ",".join(sorted(base)), "n_found": len(kept),
                    "labels": ",".join(sorted(base | {f[2].label for f in kept})), "score": max(1 - miss, BASE_SCORE if base else 0.0)}
            if pos:
                out |= {"first_word": min(pos), "last_word": max(pos)}
        yield out


_COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_found long"


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_words, n_base (places of the base phrases), first_word,
    last_word, base_labels, labels, score (0 to 1), n_found (kept detections)."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in steps(batches):
            got = pa.Table.from_pylist(list(scan_step(data, off)), pa.schema([
                ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_found", pa.int64())])).combine_chunks()
            yield pa.RecordBatch.from_arrays([b.column(0), *(c.chunk(0) for c in got.columns)], ["id", *got.column_names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(task, f"id {dict(rows.dtypes)['id']}, {_COLUMNS}").withColumnRenamed("id", id_col)
