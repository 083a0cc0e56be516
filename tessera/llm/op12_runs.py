"""Periodic run detection by block convolution.

A run is a stretch of words with smallest period q (words q apart are equal)
and a length of at least ``max(least, times * q)`` that no neighbouring word
extends.  Texts are worked on at dyadic scales L = 1, 2, 4, ...: the words of
a step's texts, one after another, are cut into blocks of L.  A run with L <=
q < 2L holds a whole block within its first 2L - 1 words, and that block comes
again q words later.  So for every block the distances L to 2L - 1 at which it
occurs again without a mismatch are looked up in the following window of 2L
words, and each such distance is the seed of an extension to both sides.

Mismatches are sums of squared differences, as integers and exact: sum(B^2) +
sum(W^2) - 2 * (B correlated with W), the correlation by a number theoretic
transform modulo ``PRIME``.  Words are mapped to so many bits that no sum
reaches the modulus; a distance found for such images is tested on the words
themselves by the extension.  Blocks under ``DIRECT`` words form the same sums
without a transform, from the word numbers as they are.

Extensions compare rolling hashes by bisection, for all seeds at once, and a
stretch that is long enough is then compared word by word.  Seeds inside a
known run whose period divides the distance are left out first: the stretch of
such a seed has that smaller period.

Memory in a task follows one step of texts (or one longer text): the
transforms run over ``CELLS`` numbers at a time, or one block's 2L.

Defined cases: a null or empty text has no words and no runs; rows with equal
ids are separate documents and null ids are kept; extra columns of the input
are ignored; ties and repeated texts need no rule, as documents do not meet;
an empty table gives an empty result.  A very long text is a step of its own,
worked on whole.  ``times`` is 3 at least: the block argument needs it.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import Rolling, SPACE, ragged, steps, words

#: 15 * 2^27 + 1: roots of unity for transforms of up to 2^27 numbers, and
#: products of two residues stay under 2^62.
PRIME = 2013265921
_P = np.uint64(PRIME)
_GENERATOR = 31
#: Blocks of fewer words are compared without a transform.
DIRECT = 32
#: Numbers in one batch of transforms.
CELLS = 1 << 18


@functools.cache
def _roots(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. size/2 - 1 of a root of unity of that order, and of its inverse."""
    out = []
    for g in (_GENERATOR, pow(_GENERATOR, -1, PRIME)):
        w, got = pow(g, (PRIME - 1) // size, PRIME), np.ones(1, np.uint64)
        while len(got) < size // 2:  # doubling: the next half is the first times a power
            got = np.concatenate([got, got * np.uint64(pow(w, len(got), PRIME)) % _P])
        out.append(got[:, None])
    return out[0], out[1]


@functools.cache
def _mirrored(size: int) -> np.ndarray:
    """Where frequency -k lies, for every place of the bit-reversed order."""
    bits = size.bit_length() - 1
    at = np.arange(size)
    rev = np.zeros(size, np.int64)
    for b in range(bits):
        rev |= (at >> b & 1) << (bits - 1 - b)
    return rev[-rev % size]


def _less(x: np.ndarray) -> np.ndarray:
    """Values under 2 * PRIME to residues."""
    return np.minimum(x, x - _P)


def transform(x: np.ndarray) -> np.ndarray:
    """Transform each column, whose second half is zero, to bit-reversed order.

    ``x`` holds the first half of the rows only.
    """
    size = 2 * len(x)
    x = np.concatenate([x, x * _roots(size)[0] % _P])
    half = size // 4
    while half:
        v = x.reshape(-1, 2, half, x.shape[1])
        a, b = v[:, 0], v[:, 1]
        low, high = _less(a + b), _less(a + (_P - b)) * _roots(2 * half)[0] % _P
        v[:, 0], v[:, 1] = low, high
        half //= 2
    return x


def inverse(x: np.ndarray) -> np.ndarray:
    """Back from bit-reversed order; overwrites ``x``."""
    size, half = len(x), 1
    while half < size:
        v = x.reshape(-1, 2, half, x.shape[1])
        a, b = v[:, 0], v[:, 1] * _roots(2 * half)[1] % _P
        low, high = _less(a + b), _less(a + (_P - b))
        v[:, 0], v[:, 1] = low, high
        half *= 2
    return x * np.uint64(pow(size, -1, PRIME)) % _P


def _again_direct(x: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the blocks at ``at`` that come again ``size`` to
    ``2 * size - 1`` words later; sums of squared differences, formed as such."""
    blocks = x[:len(x) // size * size].reshape(-1, size)
    far = np.concatenate([x, np.full(2 * size, -1, x.dtype)])
    where, gaps = [], []
    for t in range(size, 2 * size):
        d = blocks - far[t:t + blocks.size].reshape(-1, size)
        hit = at[np.einsum("ij,ij->i", d, d)[at // size] == 0]
        where.append(hit)
        gaps.append(np.full(len(hit), t))
    return np.concatenate(where), np.concatenate(gaps)


def _again(x: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_again_direct``, by transforms of ``2 * size`` numbers."""
    bits = (31 - size.bit_length()) // 2
    image = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
    n_blocks = -(-len(x) // size) + 2
    image = np.concatenate([image, np.zeros(n_blocks * size - len(x), np.uint64)])
    squares = np.concatenate([np.zeros(1, np.int64), np.cumsum((image * image).astype(np.int64))])
    need, width = at // size, max(1, CELLS // (2 * size))
    where, gaps = [], []
    lo = 0
    while lo < len(need):
        b = need[lo:np.searchsorted(need, need[lo] + width)]
        first, last = int(b[0]), int(b[-1]) + 3
        f = transform(np.ascontiguousarray(image[first * size:last * size].reshape(-1, size).T))
        mine, one, two = f[:, b - first], f[:, b - first + 1], f[:, b - first + 2]
        # the window is two blocks; the second one, moved by half a turn, changes sign at odd frequencies
        window = np.concatenate([_less(one[:size] + two[:size]), _less(one[size:] + (_P - two[size:]))])
        c = inverse(mine[_mirrored(2 * size)] * window % _P)[:size].astype(np.int64)
        start = b * size
        far = start + size + np.arange(size)[:, None]
        miss = (squares[start + size] - squares[start]) + (squares[far + size] - squares[far]) - 2 * c
        t, k = np.nonzero(miss == 0)
        where.append(start[k])
        gaps.append(t + size)
        lo += len(b)
    return np.concatenate(where), np.concatenate(gaps)


def _reach(same: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
    """The largest k up to ``most`` with ``same(k)``, which is true up to some k; all at once."""
    lo, hi = np.zeros_like(most), most.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi + 1) // 2
        yes = same(mid) & open_
        lo = np.where(yes, mid, lo)
        hi = np.where(open_ & ~yes, mid - 1, hi)
    return lo


def _stretch(x: np.ndarray, p: int, t: int, lo: int, hi: int) -> tuple[int, int]:
    """The stretch of period ``t`` around ``p``, word by word (after a hash collision)."""
    s = p
    while s > lo and x[s - 1] == x[s - 1 + t]:
        s -= 1
    e = s + t
    while e < hi and x[e] == x[e - t]:
        e += 1
    return s, e


@functools.cache
def _primes(n: int) -> tuple[int, ...]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return tuple(out + [n] * (n > 1))


def find(x: np.ndarray, off: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs in texts laid one after another.

    ``x`` are the numbers of the words (equal words, equal numbers, under
    2^31) and ``off`` the texts' bounds; places count from the first text's
    first word, ordered by start, then period.
    """
    if times < 3:
        raise ValueError("times is 3 at least")
    none = np.empty(0, np.int64)
    if not len(x):
        return none, none, none
    x = x.astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    lo, hi = off[:-1][row], off[1:][row]
    h = Rolling(x)
    found: set[tuple[int, int, int]] = set()
    known: dict[int, list[tuple[int, int]]] = {}
    size, longest = 1, int(np.diff(off).max())
    while times * size <= longest:
        at = np.arange(0, len(x), size)
        at = at[at + (times - 1) * size <= hi[at]]  # a block at a run's head has this much behind it
        if len(at):
            p, t = (_again_direct if size < DIRECT else _again)(x, at, size)
            inside = p + t + size <= hi[p]
            p, t = p[inside], t[inside]
            for q, runs in known.items():
                if not len(p):
                    break
                starts, ends = np.array(sorted(runs)).T
                k = np.searchsorted(starts, p, "right") - 1
                inner = (t % q == 0) & (k >= 0) & (ends[k] >= p + t + size)
                p, t = p[~inner], t[~inner]
            left = _reach(lambda k: h(p - k, p) == h(p + t - k, p + t), p - lo[p])
            right = _reach(lambda k: h(p, p + k) == h(p + t, p + t + k), hi[p] - p - t)
            s, e = p - left, p + t + right
            long = e - s >= np.maximum(least, times * t)
            s, e, p, t = s[long], e[long], p[long], t[long]
            some, which = np.unique(np.stack([s, e, t], 1), axis=0, return_inverse=True)
            for n, (a, z, q) in enumerate(some.tolist()):
                at = [(a, z)]
                if not np.array_equal(x[a:z - q], x[a + q:z]):  # hashes collided: word by word from each of the seeds
                    at = {_stretch(x, int(k), q, int(lo[k]), int(hi[k])) for k in p[which == n]}
                for a, z in at:
                    if z - a >= max(least, times * q) and not any(np.array_equal(x[a:z - q // r], x[a + q // r:z]) for r in _primes(q)):
                        found.add((a, q, z))
        for a, q, z in found:
            if size <= q < 2 * size:
                known.setdefault(q, []).append((a, z))
        size *= 2
    if not found:
        return none, none, none
    a, q, z = np.array(sorted(found)).T
    return a, z, q


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """The query's rewriting of a document's n words: which word stands where
    (None: unchanged).  Every tenth document, by its id's checksum, repeats a
    stretch from word a on with period p; a null id is never rewritten."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def run_step(ids: list, data: np.ndarray, off: np.ndarray, least: int, times: int,
             rewrite: Callable[[object, int], np.ndarray | None] | None) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(words, runs, collapsed text) of every text of a step."""
    start, end, row = words(data, off)
    n = np.bincount(row, minlength=len(ids)).astype(np.int64)
    bound = np.concatenate([[0], np.cumsum(n)])
    size = end - start
    held = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])),
                                                                pa.py_buffer(np.ascontiguousarray(data[ragged(start, size)]))])
    x = held.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(size) else np.empty(0, np.int64)
    src = np.arange(len(x))
    if rewrite:
        for r, i in enumerate(ids):
            if (new := rewrite(i, int(n[r]))) is not None:
                src[bound[r]:bound[r + 1]] = bound[r] + new
    a, z, q = find(x[src], bound, least, times)
    doc = np.searchsorted(bound, a, "right") - 1
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(ids) + 1)), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(a - bound[doc]), pa.array(z - a), pa.array(q)], ["start", "length", "period"]))
    # words covered by a run after its first q words go
    edge = np.zeros(len(x) + 1, np.int64)
    np.add.at(edge, a + q, 1)
    np.add.at(edge, z, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    spaced = np.full(int(size.sum()) + len(size), 32, np.uint8)  # every word with a blank behind it
    first = np.cumsum(size + 1) - size - 1
    spaced[ragged(first, size)] = data[ragged(start, size)]
    w = src[kept]
    text = spaced[ragged(first[w], size[w] + 1)]
    per_row = np.bincount(np.searchsorted(bound, kept, "right") - 1, weights=size[w] + 1, minlength=len(ids)).astype(np.int64)
    cut = np.concatenate([[0], np.cumsum(per_row)])
    last = cut[1:][per_row > 0] - 1  # the blank behind a text's last word
    text = np.delete(text, last)
    cut = cut - np.concatenate([[0], np.cumsum(per_row > 0)])
    out = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(text))])
    return pa.array(n), runs.cast(_RUN), out.cast(pa.large_string()).cast(pa.string())


def runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 6, times: int = 4,
         rewrite: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """Per document: id, n_words, runs (array of start, length, period, by start
    and period) and collapsed (its words without those that a run repeats,
    joined by one space)."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in steps(batches):
            n, found, left = run_step(b.column(0).to_pylist(), data, off, least, times, rewrite)
            yield pa.RecordBatch.from_arrays([b.column(0), n, found, left], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(task, f"id {dict(rows.dtypes)['id']}, n_words long, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and checksums of ``runs``: the longest run (ties: smallest start,
    then period; nulls without a run) and digests of all runs and of the words left."""
    top = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return (found.withColumn("__top", top)
            .select(id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("__top.start")).alias("start"),
                    F.col("__top.length").alias("length"), (-F.col("__top.period")).alias("period"),
                    F.expr("1000 * __top.length div -__top.period").alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
                    "n_words"))
