"""Blocks of a table and the answers that they ask for.

An operator that looks up corpus-wide figures for every word or byte string of
every text would send each occurrence through a shuffle.  Instead a pass over
the rows forms blocks of about ``BLOCK_BYTES`` of text, writes each block's
content once (packed) and its *distinct* keys as plain rows; figures are
joined to those rows; and each block then meets its own answers.  A block is
bounded by its bytes (one longer text is a block of its own), so is what meets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20

#: Bytes of text that one vectorised step of a block works on.
STEP_BYTES = 1 << 20

_CODEC = "zstd"


def lean() -> None:
    """Give freed Arrow memory back to the system: a worker holds a block beside
    the executor's heap, and lives on between tasks."""
    pa.set_memory_pool(pa.system_memory_pool())


def block_names() -> Iterable[int]:
    """Names for the blocks of the running task: no two tasks' are equal."""
    name = TaskContext.get().partitionId() << 32
    while True:
        yield name
        name += 1


def squeeze(a: np.ndarray) -> bytes:
    """An array's bytes, packed; its length in bytes in front."""
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec(_CODEC).compress(raw, asbytes=True)


def unsqueeze(raw: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.Codec(_CODEC).decompress(raw[8:], size, asbytes=True), dtype)


def meet(blocks: DataFrame, answers: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block with the answers to its rows (both have the column ``block``)."""
    def met(block: pa.Table, asked: pa.Table) -> pa.Table:
        lean()
        return f(block, asked)

    answers = answers.toDF(*answers.columns)  # both may come from one table: columns of its own
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(met, schema)


def unified(parts: list[pa.DictionaryArray]) -> tuple[np.ndarray, pa.Array]:
    """One numbering for arrays that were coded one by one: (numbers, the coded values)."""
    every = pa.chunked_array(parts, parts[0].type).unify_dictionaries()
    return np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in every.chunks]), every.chunk(0).dictionary


def binary_array(data: np.ndarray, start: np.ndarray, end: np.ndarray, taken: np.ndarray) -> pa.Array:
    """The stretches start .. end of ``data`` as an array; ``taken`` marks their bytes."""
    off = np.concatenate([[0], np.cumsum(end - start)])
    small = off[-1] < 1 << 31
    return pa.Array.from_buffers(pa.binary() if small else pa.large_binary(), len(start),
                                 [None, pa.py_buffer(off.astype(np.int32) if small else off), pa.py_buffer(data[taken])])
