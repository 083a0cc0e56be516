"""Helpers shared by the training-data operators.

Intermediate tables go under ``spark.checkpoint.dir`` (a folder that driver
and executors share); nothing is kept in a machine-local folder on a cluster.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import tessera

from tessera.session import scratch_path

#: Bytes of text that one vectorised step works on inside a task (a longer
#: text is a step of its own; texts are never cut).
STEP_BYTES = 2 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the session's Python workers, wherever
    they start (once per application)."""
    sc = spark.sparkContext
    if not getattr(sc, "_tessera_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(tessera.__file__)))
        d = tempfile.mkdtemp()  # Spark serves the archive from the driver as long as the application runs
        atexit.register(shutil.rmtree, d, True)
        sc.addPyFile(shutil.make_archive(os.path.join(d, "tessera_code"), "zip", root, "tessera"))
        sc._tessera_shipped = True
    return spark


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it
    back: the work is done once, and a lost executor costs only its own part."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark) -> int:
    """Partitions of the session's shuffles (sized from the input by whoever runs the job)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _marked(df: DataFrame, ids: DataFrame, key: str, bits: int) -> DataFrame:
    """``df`` with ``__tessera_hit``: whether the key may occur in ``ids`` (one column).

    A bitmap of ``2**bits`` hash slots, held in at most ``2**bits / 64`` rows
    whatever the input, is broadcast.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    words = (ids.select(slot(F.col(ids.columns[0])).alias("s"))
             .groupBy(F.expr("s div 64").alias("__tessera_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("__tessera_bits")))
    out = df.withColumn("__tessera_slot", slot(F.col(key))).join(F.broadcast(words), F.expr("__tessera_slot div 64 = __tessera_word"), "left")
    hit = F.expr("coalesce(shiftrightunsigned(__tessera_bits, cast(__tessera_slot % 64 as int)) & 1L, 0L) = 1L")
    return out.withColumn("__tessera_hit", hit).drop("__tessera_slot", "__tessera_word", "__tessera_bits")


def within(df: DataFrame, ids: DataFrame, key: str, bits: int = 23) -> DataFrame:
    """Rows of ``df`` whose ``key`` may occur in ``ids``: rows that cannot match
    are left out before a shuffle.  False positives remain: an exact join has to follow."""
    return _marked(df, ids, key, bits).where("__tessera_hit").drop("__tessera_hit")


def without(df: DataFrame, ids: DataFrame, key: str, bits: int = 23) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids``; only rows that the bitmap
    cannot clear are shuffled for the exact anti-join."""
    marked = _marked(df, ids, key, bits)
    doubt = marked.where("__tessera_hit").drop("__tessera_hit")
    clear = marked.where("not __tessera_hit").drop("__tessera_hit")
    return clear.unionByName(doubt.join(ids.toDF("__tessera_gone"), F.col(key) == F.col("__tessera_gone"), "left_anti"))


def steps(batches: Iterable[pa.RecordBatch], text: str = "text",
          budget: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches holding about ``budget`` text bytes.

    Yields (slice, bytes of its texts one after another, row offsets into
    them).  A null text counts as empty.
    """
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(text))
        if col.null_count:
            col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        _, obuf, dbuf = col.buffers()
        off = np.frombuffer(obuf, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(dbuf, np.uint8) if dbuf is not None and dbuf.size else np.empty(0, np.uint8)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + budget, "right")) - 1)
            yield b.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, rows: int = 1) -> Iterator[list[pa.RecordBatch]]:
    """Batches sorted by ``key`` put together to ``rows`` rows or more, cut only
    where the key changes (with ``rows`` 1: one group after another)."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        k = column(b, key)
        starts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and column(held[-1], key)[-1] != k[0]:
            starts = np.r_[0, starts]
        lo = 0
        for i in starts.tolist():
            if n + i - lo >= rows:
                if i > lo:
                    held.append(b.slice(lo, i - lo))
                yield held
                held, n, lo = [], 0, i
        held.append(b.slice(lo))
        n += b.num_rows - lo
    if held:
        yield held


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


_MULT = 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling-hash base and of its inverse (mod 2**64)."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_MULT, pow(_MULT, -1, 1 << 64))):
            _powers[i] = np.cumprod(np.r_[np.uint64(1), np.full(n + 1, np.uint64(base))], dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(_MULT)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


class Rolling:
    """64-bit hashes of any substrings of a byte array, in O(1) each."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        pw, self.inv = _power(n)
        c = np.empty(n + 1, np.uint64)
        c[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:n], dtype=np.uint64, out=c[1:])
        self.c = c

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.c[end] - self.c[start]) * self.inv[start])


def byte_set(chars: str | bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode() if isinstance(chars, str) else chars)] = True
    return t


#: Separators of the words ``[^\x20\x09-\x0D]+``.
SPACE = byte_set(b" \t\n\v\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words of the texts: runs of bytes not in ``gap``,
    never across texts."""
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, z
    g = gap[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = ~g & (edge[:n] | np.r_[True, g[:-1]])
    last = ~g & (edge[1:] | np.r_[g[1:], True])
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)


def pack_rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key; ``rows`` counts the key's rows
    on the left, or more) without sending a hot key to one task.

    Keys with over 1/1000 of the left rows, of which there are at most 1000 as
    the counts add up to those rows, are broadcast; the rest is shuffled.
    """
    total = left.count()
    hot = right.where(F.col(rows) * 1000 > total)
    rest = right.where(F.col(rows) * 1000 <= total)
    a = left.join(F.broadcast(hot), keys, "inner")
    cold = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return a.unionByName(cold.join(rest, keys, how).select(*a.columns))


def connected(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b), for ids that have a link.

    Alternating large-star and small-star contraction: every round is a few
    joins and partial aggregations over the links, kept in written tables.
    """
    a, b = links.columns[:2]
    e = store(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        big = (skew_join(both, low, ["u"], "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .where("u <> v").distinct())
        big = store(big, "links")
        low = big.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (skew_join(big, low, ["u"], "n").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where("u <> v").distinct())
        e = store(small, "links")
        now = tuple(e.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = now
