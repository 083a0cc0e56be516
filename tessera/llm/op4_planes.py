"""Token ids as bit-plane shuffled, compressed shard files.

Documents are range-partitioned by id; each task tokenizes its texts, cuts the
id stream into blocks of ``BLOCK`` ids, transposes each block into planes
(bytes of equal significance, and for the low byte optionally its bits),
compresses every plane with zstandard and appends them to one shard file.
A footer holds the chunk index and the document table, so any block can be
read on its own.  Files are written under a temporary name and renamed, and
the returned table names only files that a finished task wrote.

File format (little endian):
    b"TPLN0001"
    chunks: the compressed planes of each block, one after another
    index: zstandard frame of int64 rows (offset, n_ids, n_planes, plane sizes...)
    documents: zstandard frame of int64 pairs (doc id, n ids), in id order
    three int64: length of index frame, length of document frame, n chunks
    b"TPLNEND1"

Defined cases: a null or empty text is a document of just the end id; a null
id comes first; a
repeated id is a document for each row; an empty table gives no shard; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm.common import column, ragged, steps, store, width
from tessera.session import scratch_path

MAGIC, END = b"TPLN0001", b"TPLNEND1"
BLOCK = 1 << 16
#: Stands for a null document id in the files.
NO_ID = -(1 << 63)
#: Text bytes tokenized together: equal pieces are tokenized once.
TOGETHER = 16 << 20


def planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Transpose a block of ids into byte planes (lowest first) or bit planes.
    Planes above the largest id's are left out."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max(initial=0))
    if kind == "byte":
        return [raw[:, i].tobytes() for i in range(max(1, (top.bit_length() + 7) // 8))]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(max(1, top.bit_length()))]


def unplanes(parts: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    if kind == "byte":
        raw = np.zeros((n, 4), np.uint8)
        for i, p in enumerate(parts):
            raw[:, i] = np.frombuffer(p, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for i, p in enumerate(parts):
            bits[:, i] = np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n]
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class Writer:
    """Appends ids to one shard file."""

    def __init__(self, sink, block: int = BLOCK, kind: str = "byte", level: int = 3):
        self.sink, self.block, self.kind = sink, block, kind
        self.zip = zstandard.ZstdCompressor(level=level)
        self.index: list[int] = []
        self.chunks = 0
        self.docs: list[np.ndarray] = []
        self.held, self.n_held = [], 0
        sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_ids: np.ndarray, n_ids: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(np.stack([doc_ids, n_ids], 1).astype("<i8"))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            every = np.concatenate(self.held)
            full = len(every) // self.block * self.block
            for lo in range(0, full, self.block):
                self._chunk(every[lo:lo + self.block])
            self.held, self.n_held = [every[full:]], len(every) - full

    def _chunk(self, ids: np.ndarray) -> None:
        parts = [self.zip.compress(p) for p in planes(ids, self.kind)]
        self.index += [self.at, len(ids), len(parts), *map(len, parts)]
        self.chunks += 1
        for p in parts:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        a = self.zip.compress(np.array(self.index, "<i8").tobytes())
        b = self.zip.compress(np.concatenate(self.docs).tobytes() if self.docs else b"")
        self.sink.write(a + b + np.array([len(a), len(b), self.chunks], "<i8").tobytes() + END)


class Reader:
    """Reads a shard file through its index; any chunk can be read alone."""

    def __init__(self, source, size: int, kind: str = "byte"):
        self.source, self.kind, self.zip = source, kind, zstandard.ZstdDecompressor()
        tail = 24 + len(END)
        a, b, n = np.frombuffer(self._at(size - tail, 24), "<i8")
        if self._at(0, len(MAGIC)) != MAGIC or self._at(size - len(END), len(END)) != END:
            raise ValueError("not a complete shard file")
        flat = np.frombuffer(self.zip.decompress(self._at(size - tail - b - a, a)), "<i8").tolist() if a else []
        self.docs = np.frombuffer(self.zip.decompress(self._at(size - tail - b, b)), "<i8").reshape(-1, 2)
        self.chunks, i = [], 0
        for _ in range(n):
            k = flat[i + 2]
            self.chunks.append((flat[i], flat[i + 1], flat[i + 3:i + 3 + k]))
            i += 3 + k

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(n))

    def chunk(self, i: int) -> np.ndarray:
        at, n, sizes = self.chunks[i]
        raw, parts = self._at(at, sum(sizes)), []
        for s in sizes:
            parts.append(self.zip.decompress(raw[:s]))
            raw = raw[s:]
        return unplanes(parts, n, self.kind)

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """(doc id, ids), chunk after chunk: one document and one chunk in memory."""
        k, held, at = 0, np.empty(0, "<u4"), 0
        for doc, n in self.docs.tolist():
            got = [held[at:at + n]]
            have = len(got[0])
            at += have
            while have < n:
                held, k = self.chunk(k), k + 1
                at = min(n - have, len(held))
                got.append(held[:at])
                have += at
            yield doc, got[0] if len(got) == 1 else np.concatenate(got)


# White space of the byte-level pre-tokenizer's pattern outside ASCII (fixed values).
_BLANKS = "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Classes of bytes: blank, letter, digit, apostrophe, part of a longer character, any other.
_BLANK, _LETTER, _DIGIT, _QUOTE, _LONG, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _BLANK
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[39] = _QUOTE
_CLASS[128:] = _LONG
#: Between these two classes the pre-tokenizer always cuts; what is left
#: uncut (apostrophes, longer characters) is looked at once per distinct piece.
_CUTS = np.zeros((6, 6), bool)
for _a in (_LETTER, _DIGIT, _OTHER):
    for _b in (_LETTER, _DIGIT, _OTHER):
        _CUTS[_a, _b] = _a != _b
_CUTS = _CUTS.reshape(-1)


class Pieces:
    """Tokenizes texts by running the library's model once per distinct piece.

    The byte-level pre-tokenizer cuts a text into pieces that the model then
    encodes one by one.  Cuts that ASCII bytes decide are found for all texts
    at once; the library's own pre-tokenizer splits distinct pieces that hold
    other characters or apostrophes.  Texts with a special token's string or
    with blanks outside ASCII go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.pre = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = [c.encode() for c in _BLANKS]
        self.odd_leads = sorted({b[:2] for b in self.odd})
        # the pre-tokenizer's letter for each byte, as it shows it itself for characters that hold the byte
        self.letters = {}
        for c in [*map(chr, range(0x800)), *map(chr, range(0x800, 0xD800, 0x400)), *map(chr, range(0xE000, 0x110000, 0x1000))]:
            self.letters.update(zip(c.encode(), "".join(x for x, _ in self.pre.pre_tokenize_str(c))))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def piece(self, raw: bytes) -> list[int]:
        if b"'" not in raw and (raw.isascii() or raw.decode().strip(" ").isalpha()):
            return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(self.letters))]
        return [t.id for part, _ in self.pre.pre_tokenize_str(raw.decode()) for t in self.model.tokenize(part)]

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text), the end id after each."""
        n_docs, n = len(off) - 1, len(data)
        if not n:
            return np.full(n_docs, end_id, np.uint32), np.ones(n_docs, np.int64)
        kind = _CLASS[data]
        blank = kind == _BLANK
        first = np.zeros(n + 1, bool)
        first[off] = True
        opens, closes = first[:n], first[1:]
        # next byte is a blank, or the text ends
        ends = closes.copy()
        ends[:-1] |= blank[1:]
        ends[-1] = True
        # a space before a run belongs to it; other blanks form one piece, but the last one before a run stands alone
        lead = (data == 32) & ~ends
        start = opens | lead
        start[1:] |= _CUTS[kind[:-1] * np.uint8(6) + kind[1:]]
        start[1:] |= ~blank[1:] & blank[:-1] & ~lead[:-1]
        rest = blank & ~lead
        start[1:] |= rest[1:] & ~blank[:-1]
        start |= rest & ~ends
        cut = np.flatnonzero(start)
        del kind, blank, first, opens, closes, ends, lead, start, rest
        bounds = np.append(cut, n).astype(np.int32)
        arr = pa.BinaryArray.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        enc = [self.piece(x) for x in arr.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, enc), np.int64, len(enc))
        flat = np.fromiter(itertools.chain.from_iterable(enc), np.uint32, int(sizes.sum()))
        idx = arr.indices.to_numpy(zero_copy_only=False)
        per = sizes[idx]
        before = np.concatenate([[0], np.cumsum(per)])
        n_ids = np.diff(before[np.searchsorted(cut, off)])
        ids = flat[ragged((np.cumsum(sizes) - sizes)[idx], per)]
        ids = np.insert(ids, np.cumsum(n_ids), np.uint32(end_id))
        n_ids += 1
        raw = data.tobytes()
        odd = self.odd if any(x in raw for x in self.odd_leads) else []
        hit = sorted({i for w in (*self.specials, *odd) for i in self._rows(raw, w, off)})
        if hit:
            parts = np.split(ids, np.cumsum(n_ids)[:-1])
            for i in hit:
                parts[i] = np.append(self.whole(raw[off[i]:off[i + 1]].decode()), np.uint32(end_id))
            n_ids, ids = np.array([len(p) for p in parts], np.int64), np.concatenate(parts)
        return ids, n_ids

    @staticmethod
    def _rows(raw: bytes, word: bytes, off: np.ndarray) -> list[int]:
        rows, at = [], raw.find(word)
        while at >= 0:
            i = int(np.searchsorted(off, at, "right") - 1)
            rows.append(i)
            at = raw.find(word, int(off[i + 1]))
        return rows


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


_INDEX = "path string, first_doc long, n_docs long, n_ids long, bytes long"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                 text: str = "text", block: int = BLOCK, kind: str = "byte") -> DataFrame:
    """Tokenize ``docs`` and write shard files in id order into ``folder`` (a
    path that all machines share); returns the stored table of shards."""
    spark = docs.sparkSession

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open_fs(folder)
        files.create_dir(base, recursive=True)
        name = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
        pieces, out, first, n_docs, n_all = Pieces(tokenizer), None, 0, 0, 0
        for b, data, off in steps(batches, budget=TOGETHER):
            if out is None:
                sink = files.open_output_stream(f"{name}.tmp")
                out, first = Writer(sink, block, kind), int(column(b, "id")[0])
            ids, n_ids = pieces.encode(data, off, end_id)
            out.add(column(b, "id"), n_ids, ids)
            n_docs, n_all = n_docs + len(n_ids), n_all + len(ids)
        if out is not None:
            out.close()
            sink.close()
            files.move(f"{name}.tmp", f"{name}.planes")
            size = files.get_file_info(f"{name}.planes").size
            yield pa.RecordBatch.from_pylist([{"path": f"{folder.rstrip('/')}/{name.rsplit('/', 1)[1]}.planes",
                                               "first_doc": first, "n_docs": n_docs, "n_ids": n_all, "bytes": size}])

    rows = (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
            .repartitionByRange(width(spark), "id").sortWithinPartitions("id"))
    return store(rows.mapInArrow(task, _INDEX), "shards")


def read_shards(shards: DataFrame, kind: str = "byte") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files."""
    total = Window.orderBy("first_doc", "path").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file: bounded by the partitions, not by the documents
    at = shards.select("path", "bytes", F.coalesce(F.sum("n_ids").over(total), F.lit(0)).alias("start"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                files, path = _open_fs(row["path"])
                with files.open_input_file(path) as f:
                    ids, n, crc = [], [], []
                    for doc, x in Reader(f, row["bytes"], kind).documents():
                        ids.append(doc)
                        n.append(len(x))
                        crc.append(zlib.crc32(x.astype("<u4").tobytes()))
                n = np.array(n, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(row["start"] + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    out = (at.repartition(width(shards.sparkSession), "path")
           .mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long"))
    return out.withColumn("doc_id", F.expr(f"nullif(doc_id, cast('{NO_ID}' as bigint))"))


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, folder, tokenizer, end_id))
