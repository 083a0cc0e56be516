"""Subword encoding and decoding with N-best segmentation.

The lattice of a text has an edge for every vocabulary piece that occurs in
it; its score is the piece's score, and a path's score the sum.  A forward
Viterbi pass gives the best score from the start to every place; these scores
are exact heuristics for a backward A-star search from the end, which yields
paths in order of score.

No piece spans two neighbouring characters that stand side by side in no
piece, so the lattice falls into independent segments there.  Equal segments
of a step are solved once: forward and backward scores and the loss of the
second path for all distinct segments together (numpy), the A-star search for
the segments that an N-best list can change.  Among the N best paths of a
text only the N - 1 segment occurrences of least loss ever leave their best
path, so searching those is exact.

Characters that are no piece become their UTF-8 byte pieces at the score
``min score - 10``.  Spaces are written as U+2581, and a text gets one in
front; decoding undoes both.  Everything runs inside the scan's tasks: no
shuffle, and nothing that grows with the corpus is held.

Defined cases: a null or empty text has no pieces, score 0 and one (empty)
segmentation; equal scores prefer the longer last piece; a text that itself
holds U+2581 does not survive the round trip (``round_trip`` false).
"""

from __future__ import annotations

import functools
import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import ragged, steps

SPACE_MARK = "▁"
N_BEST = 4
#: Text bytes whose equal segments are solved once.
TOGETHER = 2 << 20
#: Longer segments are solved one by one instead of side by side.
SIDE_BY_SIDE = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces and scores of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece: dict[str, int] = {}
        self.bytes = np.zeros(256, np.int64)
        self.text: list[bytes] = []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(p[3:-1], 16)] = i
                self.text.append(bytes([int(p[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text.append(b"")
            else:
                self.piece[p] = i
                self.text.append(p.encode())
        self.score = np.array([sp.get_score(i) for i in range(len(self.text))])
        self.unknown = float(self.score[list(self.piece.values())].min()) - 10
        self.longest = max(map(len, self.piece))
        keys = sorted((self._key(p), i) for p, i in self.piece.items())
        self.keys = np.array([k for k, _ in keys], np.uint64)
        self.key_id = np.array([i for _, i in keys], np.int64)
        chars = sorted({c for p in self.piece for c in p})
        self.char = np.zeros(0x110000, np.uint16)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1,) * 2, bool)
        for p in self.piece:
            c = self.char[[ord(x) for x in p]]
            self.joined[c[:-1], c[1:]] = True

    @staticmethod
    def _key(p: str) -> int:
        h = 0
        for c in p:
            h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
        return h

    def ids(self, edges: list[tuple[int, str]]) -> list[int]:
        out = []
        for i, chars in edges:
            out += [i] if i >= 0 else self.bytes[list(chars.encode())].tolist()
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids: pieces joined, marks as spaces, without the first one."""
        s = b"".join(self.text[i] for i in ids).decode("utf-8", "replace").replace(SPACE_MARK, " ")
        return s[1:] if s.startswith(" ") else s

    def edges(self, s: str) -> list[list[tuple[int, int, float]]]:
        """By end: (start, id or -1, score) of the lattice's edges, longest first."""
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(s) + 1)]
        for j in range(1, len(s) + 1):
            for i in range(max(0, j - self.longest), j):
                k = self.piece.get(s[i:j])
                if k is not None:
                    out[j].append((i, k, float(self.score[k])))
            if not out[j] or out[j][-1][0] != j - 1:
                out[j].append((j - 1, -1, self.unknown))
        return out

    def n_best(self, s: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of ``s``: forward Viterbi, then backward A-star."""
        edges = self.edges(s)
        ahead = [0.0] + [0.0] * len(s)
        for j in range(1, len(s) + 1):
            ahead[j] = max(ahead[i] + x for i, _, x in edges[j])
        agenda, count, out = [(-ahead[-1], 0, len(s), 0.0, None)], 0, []
        while agenda and len(out) < n:
            f, _, at, done, path = heapq.heappop(agenda)
            if at == 0:
                ids = []
                while path:
                    ids += self.ids([path[0]])
                    path = path[1]
                out.append((-f, ids))
                continue
            for i, k, x in edges[at]:
                count += 1
                heapq.heappush(agenda, (-(ahead[i] + x + done), count, i, done + x, ((k, s[i:at]), path)))
        return out

    def solve(self, seg: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """For segments of one length (rows of code points): best score, loss of
        the second path, and the best path's starts and ids from its end."""
        m, spans = len(seg), min(length, self.longest)
        pre = np.zeros((length + 1, m), np.uint64)
        for j in range(length):
            pre[j + 1] = pre[j] * _BASE + seg[:, j].astype(np.uint64) + np.uint64(1)
        score = np.full((length, spans + 1, m), -np.inf)
        ident = np.full((length, spans + 1, m), -1, np.int32)
        for k in range(1, spans + 1):
            key = pre[k:] - pre[:-k] * np.uint64(pow(int(_BASE), k, 1 << 64))
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            ident[:length - k + 1, k] = np.where(hit, self.key_id[at], -1)
            score[:length - k + 1, k] = np.where(hit, self.score[self.key_id[at]], -np.inf)
        lone = ident[:, 1] < 0
        score[:, 1][lone] = self.unknown
        fwd, back = np.full((length + 1, m), -np.inf), np.zeros((length + 1, m), np.int64)
        fwd[0] = 0
        for j in range(1, length + 1):
            for i in range(max(0, j - spans), j):
                x = fwd[i] + score[i, j - i]
                better = x > fwd[j]
                fwd[j] = np.where(better, x, fwd[j])
                back[j] = np.where(better, i, back[j])
        bwd = np.full((length + 1, m), -np.inf)
        bwd[length] = 0
        for i in range(length - 1, -1, -1):
            for k in range(1, min(spans, length - i) + 1):
                bwd[i] = np.maximum(bwd[i], score[i, k] + bwd[i + k])
        # the best path from its end; then its edges no longer count
        row, at, starts, ids = np.arange(m), np.full(m, length), [], []
        while (at > 0).any():
            on = at > 0
            i = np.where(on, back[at, row], 0)
            k = np.where(on, at - i, 0)
            starts.append(np.where(on, i, -1))
            ids.append(np.where(on, ident[i, k, row], -2))
            score[i[on], k[on], row[on]] = -np.inf
            at = i
        second = np.full(m, -np.inf)
        for i in range(length):
            for k in range(1, min(spans, length - i) + 1):
                second = np.maximum(second, fwd[i] + score[i, k] + bwd[i + k])
        return fwd[length], fwd[length] - second, starts, ids


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Segments:
    """Distinct segments of a step with their best paths."""

    def __init__(self, voc: Vocabulary, raw: list[bytes]):
        self.voc, self.raw = voc, raw
        n = len(raw)
        self.best, self.loss = np.zeros(n), np.full(n, np.inf)
        self.path: list[list[int] | None] = [None] * n
        self.cache: dict[int, list[tuple[float, list[int]]]] = {}
        size = np.fromiter(map(len, raw), np.int64, n) // 4
        for length in np.unique(size).tolist():
            rows = np.flatnonzero(size == length)
            if length > SIDE_BY_SIDE:
                for r in rows.tolist():
                    self._one(r)
                continue
            part = max(256, (1 << 20) // (length * length))
            for lo in range(0, len(rows), part):
                self._many(rows[lo:lo + part], length)

    def _one(self, r: int) -> None:
        both = self.voc.n_best(self.string(r), 2)
        self.best[r], self.path[r] = both[0]
        self.loss[r] = both[0][0] - both[1][0] if len(both) > 1 else np.inf

    def _many(self, rows: np.ndarray, length: int) -> None:
        seg = np.frombuffer(b"".join([self.raw[r] for r in rows.tolist()]), np.uint32).reshape(-1, length)
        self.best[rows], self.loss[rows], starts, ids = self.voc.solve(seg, length)
        ids = np.stack(ids[::-1], 1)
        plain = (ids != -1).all(1)
        for r, x, ok in zip(rows.tolist(), ids.tolist(), plain.tolist()):
            if ok:
                self.path[r] = [i for i in x if i >= 0]
        for n in np.flatnonzero(~plain).tolist():  # a character without a piece: its bytes
            s, at, path = self.string(int(rows[n])), length, []
            for st, i in zip(starts, ids[n][::-1].tolist()):
                if st[n] >= 0:
                    path.append((i, s[st[n]:at]))
                    at = int(st[n])
            self.path[int(rows[n])] = self.voc.ids(path[::-1])

    def string(self, r: int) -> str:
        return self.raw[r].decode("utf-32-le")

    def n_best(self, r: int, n: int) -> list[tuple[float, list[int]]]:
        if r not in self.cache:
            self.cache[r] = self.voc.n_best(self.string(r), n)
        return self.cache[r]


def split(voc: Vocabulary, data: np.ndarray, off: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct segments as UTF-32, segment of each occurrence, occurrences per text)."""
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off]
    some = np.diff(at) > 0
    chars = np.insert(np.where(chars == 32, np.uint32(ord(SPACE_MARK)), chars), at[:-1][some], np.uint32(ord(SPACE_MARK)))
    at = at + np.concatenate([[0], np.cumsum(some)])
    n = len(chars)
    if not n:
        return [], np.empty(0, np.int64), np.zeros(len(off) - 1, np.int64)
    kind = voc.char[chars]
    start = np.ones(n, bool)
    start[1:] = ~voc.joined[kind[:-1], kind[1:]]
    start[at[:-1][some]] = True
    cut = np.flatnonzero(start)
    bounds = (np.append(cut, n) * 4).astype(np.int64)
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(bounds), pa.py_buffer(chars)]).dictionary_encode()
    return arr.dictionary.to_pylist(), arr.indices.to_numpy(zero_copy_only=False), np.diff(np.searchsorted(cut, at))


def best_sums(lists: list[list[float]], n: int) -> list[float]:
    """The n largest sums of one value from each (descending) list."""
    out = [0.0]
    for x in lists:
        out = heapq.nlargest(n, (a + b for a in out for b in x))
    return out


def encode_step(voc: Vocabulary, data: np.ndarray, off: np.ndarray, n: int):
    """Per text: ids, score, n best scores, whether decoding gives the text back."""
    raw, idx, per = split(voc, data, off)
    seg = Segments(voc, raw)
    sizes = np.fromiter(map(len, seg.path), np.int64, len(raw))
    flat = np.fromiter((i for p in seg.path for i in p), np.uint32, int(sizes.sum()))
    back = np.fromiter((b"".join([voc.text[i] for i in p]) == x.decode("utf-32-le").encode() for p, x in zip(seg.path, raw)), bool, len(raw))
    many = sizes[idx]
    ids = flat[ragged((np.cumsum(sizes) - sizes)[idx], many)]
    ends = np.concatenate([[0], np.cumsum(per)])
    cuts = np.concatenate([[0], np.cumsum(many)])[ends]
    mark, text = SPACE_MARK.encode(), data.tobytes()
    marked = mark in text
    for d in range(len(off) - 1):
        here = idx[ends[d]:ends[d + 1]]
        loss = seg.loss[here]
        k = min(n - 1, len(here))
        least = here[np.argpartition(loss, k - 1)[:k]] if k else here[:0]
        base = float(seg.best[here].sum())
        alter = [[x - float(seg.best[r]) for x, _ in seg.n_best(r, n)] for r in least.tolist() if np.isfinite(seg.loss[r])]
        tops = [base + x for x in best_sums(alter, n)]
        ok = bool(back[here].all()) and not (marked and mark in text[off[d]:off[d + 1]])
        yield ids[cuts[d]:cuts[d + 1]], base, tops, ok


def digest(docs: DataFrame, model: str, n: int = N_BEST, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_pieces, ids_crc32 (of the best ids as little-endian 32-bit
    integers), score, scores of the n best segmentations, round_trip."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(model)
        for b, data, off in steps(batches, budget=TOGETHER):
            got = list(encode_step(voc, data, off, n))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(x[0]) for x in got], pa.int64()),
                pa.array([zlib.crc32(np.ascontiguousarray(x[0], "<u4").tobytes()) for x in got], pa.int64()),
                pa.array([x[1] for x in got], pa.float64()), pa.array([x[2] for x in got], pa.list_(pa.float64())),
                pa.array([x[3] for x in got], pa.bool_())],
                ["id", "n_pieces", "ids_crc32", "score", "scores", "round_trip"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return (rows.mapInArrow(task, f"id {kind}, n_pieces long, ids_crc32 long, score double, scores array<double>, round_trip boolean")
            .withColumnRenamed("id", id_col))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the best ids and the text decoded from them."""
    def task(batches):
        voc = vocabulary(model)
        for b, data, off in steps(batches, budget=TOGETHER):
            got = [x[0].tolist() for x in encode_step(voc, data, off, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32())),
                                              pa.array([voc.decode(x) for x in got], pa.string())], ["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(task, f"id {dict(rows.dtypes)['id']}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
