"""Scoring texts by context-tree weighting over bytes.

A text is its lower-cased bytes and one end byte (0xFF, which UTF-8 never
uses).  Every byte is eight binary decisions along a tree of 255 nodes; each
decision is predicted in the context of the ``depth`` bytes before it (ends in
front of a text).  For every context of 0 to ``depth`` bytes and every node the
training counts give a Krichevsky-Trofimov estimate, and contexts are mixed by
their weighted probabilities:

    P(s) = 1/2 KT(s) + 1/2 * product of P(c) over the contexts c one byte longer

(P = KT at the full depth).  A decision's probability given the training texts
is then, from the shortest context down, ``w * kt + (1 - w) * the longer
context's``, with w = KT(s) / (KT(s) + product): an unseen context predicts 1/2.

On Spark: blocks of text (``blocks``) list their distinct byte strings of
``depth + 1`` bytes; these are counted, spread over the tree's nodes and summed
level by level up the contexts, and the mixed estimates go down again level by
level.  Each level is one aggregation or join of plain rows, with at most 256
children a parent and one row per block and string; no context is gathered in
one task, and the model is as large as the corpus has contexts.  Blocks then
meet the code lengths of their own strings.  The base scores of words go the
same way; a word is answered only where other blocks change its count.

Figures gathered on the driver: the sums of tokens and of distinct tokens.

Defined cases: a null or empty text is its end alone; a null id is not held
out; rows with equal ids are separate documents; extra columns of the input are
ignored; repeated texts count as often as they stand there and ties need no
rule; without training rows every decision has probability 1/2; an empty table
gives an empty result.  A very long text is a block of its own, scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.blocks import BLOCK_BYTES, STEP_BYTES, binary_array, block_names, lean, meet, unified
from tessera.llm.common import LOWER, SPACE, ragged, steps, store, words

#: Bytes of context.  The strings of a block have one byte more; at most 6.
DEPTH = 4
END = 255


def strings(data: np.ndarray, off: np.ndarray, depth: int) -> np.ndarray:
    """For every byte of the texts and every end, text by text: its context and
    itself as a number, the oldest byte highest."""
    size = np.diff(off)
    head = np.arange(len(size)) * (depth + 1) + off[:-1]
    padded = np.full(len(data) + len(size) * (depth + 1), END, np.uint8)
    padded[ragged(head + depth, size)] = data
    out = np.zeros(len(padded) - depth, np.int64)
    for i in range(depth + 1):
        out <<= 8
        out |= padded[i:len(padded) - depth + i]
    return out[ragged(head, size + 1)]


def _sum_by_key(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[first], np.add.reduceat(c, first)


_BLOCK = pa.schema([("block", pa.int64()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64()),
                    ("docs", pa.binary()), ("tokens", pa.int64()), ("ends", pa.int64())])
_BLOCK_SQL = "block long, gram long, word binary, n long, docs binary, tokens long, ends long"


def _packed(parts: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        for p in parts:
            w.write_batch(p)
    return sink.getvalue().to_pybytes()


class _Words:
    """The words of a block, coded, and how often each stands in training texts."""

    def __init__(self, parts: list[tuple[pa.DictionaryArray, np.ndarray]]):
        self.ids, self.words = unified([w for w, _ in parts])
        train = np.concatenate([t for _, t in parts])
        self.n = np.bincount(self.ids[train], minlength=len(self.words)).astype(np.int64)


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of the texts, coded, and the text of each."""
    start, end, row = words(data, off)
    return binary_array(data, start, end, ~SPACE[data]).cast(pa.binary()).dictionary_encode(), row


def _blocks(depth: int):
    def flush(block: int, docs: list, grams: list, said: list) -> Iterator[pa.RecordBatch]:
        gram, n = _sum_by_key([g for g, _ in grams], [c for _, c in grams])
        w = _Words(said)
        held = np.concatenate([d.column(2).to_numpy(zero_copy_only=False) for d in docs])
        for field, keys, c in (("gram", pa.array(gram), n), ("word", w.words, w.n)):
            cols = {"block": pa.array(np.full(len(keys), block)), field: keys, "n": pa.array(c)}
            yield pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(len(keys), f.type)) for f in _BLOCK], schema=_BLOCK)
        yield pa.RecordBatch.from_pylist([{"block": block, "docs": _packed(docs), "tokens": int(w.n.sum()), "ends": int((~held).sum())}], _BLOCK)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        names, docs, grams, said, size = iter(block_names()), [], [], [], 0
        for b, data, off in steps(batches, budget=STEP_BYTES):
            low, held = LOWER[data], b.column(2).to_numpy(zero_copy_only=False)
            g, lengths = strings(low, off, depth), np.diff(off) + 1
            mine = np.repeat(~held, lengths)
            for part, counts in ((g[mine], True), (g[~mine], False)):
                key, n = np.unique(part, return_counts=True)
                grams.append((key, n if counts else np.zeros(len(key), np.int64)))
            w, row = _tokens(low, off)
            said.append((w, ~held[row]))
            docs.append(b)
            size += len(data)
            if size >= BLOCK_BYTES:
                yield from flush(next(names), docs, grams, said)
                docs, grams, said, size = [], [], [], 0
        if docs:
            yield from flush(next(names), docs, grams, said)

    return task


def _log_gamma(x: Column) -> Column:
    """Stirling's series seven further up; good to 1e-10 for x of 1/2 and more."""
    y, below = x + 7, x
    for i in range(1, 7):
        below = below * (x + i)
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - F.log(below))


def _kt() -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    a, b = F.col("n0").cast("double"), F.col("n1").cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)


def _decisions(df: DataFrame) -> DataFrame:
    """Eight rows a string: the node of each decision (context, then the bits so far behind a one) and its bit."""
    at = df.withColumn("__i", F.explode(F.array(*map(F.lit, range(8)))))
    # nodes are numbered 1 to 255 below their context
    return (at.withColumn("node", F.expr("(shiftright(gram, 8) * 256) | (256L | (gram & 255L)) >> (8 - __i)"))
            .withColumn("bit", F.expr("cast((gram >> (7 - __i)) & 1L as int)")).drop("__i"))


def _levels(grams: DataFrame, depth: int) -> list[DataFrame]:
    """Per depth 0 .. ``depth``: node, n0, n1, kt and the children's log probability."""
    leaf = (_decisions(grams.withColumn("context", F.shiftright("gram", 8)).repartition("context").groupBy("context", "gram").agg(F.sum("n").alias("n")))
            .groupBy("context", "node").agg(F.sum(F.expr("if(bit = 0, n, 0L)")).alias("n0"), F.sum(F.expr("if(bit = 1, n, 0L)")).alias("n1")))
    here = store(leaf.select("node", "n0", "n1").withColumn("kt", _kt()).withColumn("below", F.lit(None).cast("double")), "tree-level")
    out = [here]
    for d in range(depth - 1, -1, -1):
        # ln(1/2 e^kt + 1/2 e^below), the larger one in front
        mixed = F.expr("if(below is null, kt, greatest(kt, below) + ln(0.5D * (1D + exp(least(kt, below) - greatest(kt, below)))))")
        up = (here.select(F.col("node").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("node"), "n0", "n1", mixed.alias("p"))
              .groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("p").alias("below")))
        here = store(up.select("node", "n0", "n1", _kt().alias("kt"), "below"), "tree-level")
        out.append(here)
    return out[::-1]


def _mixtures(levels: list[DataFrame]) -> list[DataFrame]:
    """Per depth: node, its mixed probability of a one down to here (``one``) and
    the weight left to longer contexts (``rest``)."""
    w = F.expr("if(below is null, 1D, 1D / (1D + exp(below - kt)))")
    kt = F.expr("(n1 + 0.5D) / (n0 + n1 + 1D)")
    out = []
    for d, level in enumerate(levels):
        x = level.select("node", w.alias("__w"), (w * kt).alias("__one"))
        if d:
            above = out[-1].select(F.col("node").alias("__up"), F.col("one").alias("__so"), F.col("rest").alias("__left"))
            x = (x.withColumn("__up", F.col("node").bitwiseAND((1 << 8 * d) - 1)).join(above, "__up")
                 .select("node", (F.col("__so") + F.col("__left") * F.col("__one")).alias("one"), (F.col("__left") * (1 - F.col("__w"))).alias("rest")))
        else:
            x = x.select("node", F.col("__one").alias("one"), (1 - F.col("__w")).alias("rest"))
        out.append(store(x, "tree-mixed"))
    return out


def code_lengths(asked: DataFrame, depth: int) -> DataFrame:
    """(gram, log10 of its last byte's probability) for all strings ``asked``
    (gram, n), learning from their counts n."""
    mixed = _mixtures(_levels(asked.where("n > 0"), depth))
    every = store(asked.groupBy("gram").agg(F.sum("n").alias("n")), "tree-strings")
    bit = "log10(if({b} = 1, {p}, 1D - {p}))"
    # seen strings: all their decisions stand at the full depth; the nodes of a context together are 255 at most
    nodes = (mixed[-1].select(F.shiftright("node", 8).alias("context"), F.struct(F.col("node").bitwiseAND(255).cast("int").alias("k"), "one").alias("x"))
             .groupBy("context").agg(F.map_from_entries(F.collect_list("x")).alias("nodes")))
    terms = [bit.format(b=f"(gram >> {7 - i}) & 1L", p=f"nodes[cast((256L | (gram & 255L)) >> {8 - i} as int)]") for i in range(8)]
    seen = (every.where("n > 0").withColumn("context", F.shiftright("gram", 8)).join(nodes, "context")
            .select("gram", F.expr(" + ".join(terms)).alias("log_p")))
    # the others: each decision at the longest context that has its node
    model = None
    for d, m in enumerate(mixed):
        m = m.select(F.lit(d).alias("d"), "node", (F.col("one") + 0.5 * F.col("rest")).alias("p"))
        model = m if model is None else model.unionByName(m)
    unseen = every.where("n = 0").select("gram")
    tries = (_decisions(unseen).withColumn("d", F.explode(F.array(*map(F.lit, range(depth + 1)))))
             .withColumn("full", F.col("node")).withColumn("node", F.expr("node & (shiftleft(1L, 8 * (d + 1)) - 1L)")))
    best = (tries.join(model, ["d", "node"]).groupBy("gram", "full").agg(F.max("bit").alias("bit"), F.max_by("p", "d").alias("p"))
            .groupBy("gram").agg(F.sum(F.expr(bit.format(b="bit", p="p"))).alias("log_p"), F.count("*").alias("k")))
    half = math.log10(0.5)
    unseen = unseen.join(best, "gram", "left").select("gram", F.coalesce(F.col("log_p") + (8 - F.col("k")) * half, F.lit(8 * half)).alias("log_p"))
    return seen.unionByName(unseen)


def _scores(depth: int, tokens: int, distinct: int):
    bottom = tokens + distinct + 1

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        told = answers.select(["word", "count"]).filter(answers["word"].is_valid())
        grams = answers.select(["gram", "value"]).filter(answers["gram"].is_valid())
        del answers
        gram, log_p = grams["gram"].to_numpy(), grams["value"].to_numpy()
        order = np.argsort(gram)
        gram, log_p = gram[order], log_p[order]
        parts, said, rows, char_score = [], [], [], []
        for b, data, off in steps(pa.ipc.open_stream(block["docs"][0].as_buffer()), budget=STEP_BYTES):
            low, held = LOWER[data], b.column(2).to_numpy(zero_copy_only=False)
            size = np.diff(off) + 1
            p = log_p[np.searchsorted(gram, strings(low, off, depth))]
            char_score.append(np.add.reduceat(p, np.cumsum(size) - size))
            w, row = _tokens(low, off)
            said.append((w, ~held[row]))
            rows.append((row, len(size)))
            parts.append((b, size))
        w = _Words(said)
        c = w.n
        if len(told):
            c = c.copy()
            at = pc.index_in(told["word"].combine_chunks(), value_set=w.words).to_numpy(zero_copy_only=False)
            c[at.astype(np.int64)] = told["count"].to_numpy()
        base = np.log10((c + 1) / bottom)
        ends = block["all_ends"][0].as_py()
        lo, tables = 0, []
        for (b, size), (row, n), s in zip(parts, rows, char_score):
            ids = w.ids[lo:lo + len(row)]
            lo += len(row)
            known = np.bincount(row, weights=c[ids] > 0, minlength=n).astype(np.int64) + (ends > 0)
            total = np.bincount(row, weights=base[ids], minlength=n) + math.log10((ends + 1) / bottom)
            tables.append(pa.table({"id": b.column(0), "held_out": b.column(2), "n_tokens": np.bincount(row, minlength=n).astype(np.int64) + 1,
                                    "n_known": known, "train_tokens": np.full(n, tokens, np.int64), "base_score": total, "score": s,
                                    "bits_per_byte": -s / math.log10(2) / size}))
        return pa.concat_tables(tables)

    return score


def score(docs: DataFrame, held: Column | None = None, id_col: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 of the text's probability) and bits_per_byte (its code length).

    ``held``: rows to score only; all others are learned from (default: the ids
    whose checksum leaves 2 modulo 7).
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth is 1 to 6")
    if held is None:
        held = F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    base = store(rows.mapInArrow(_blocks(depth), _BLOCK_SQL), "tree-blocks")
    by_word = Window.partitionBy("word").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # rows: what a block has to be told, and one (without a word, if there is nothing to tell) per distinct training word
    told = lambda c: F.expr(f"if(count <> n, {c}, null)").alias(c)
    said = store(base.where("word is not null").select("block", "word", "n").withColumn("count", F.sum("n").over(by_word))
                 .withColumn("fresh", (F.first("block").over(by_word) == F.col("block")) & (F.col("count") > 0))
                 .where("fresh or count <> n").select(told("block"), told("word"), told("count"), "fresh"), "tree-words")
    distinct = said.where("fresh").count()
    tokens, ends = base.where("docs is not null").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("ends"), F.lit(0))).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    asked = base.where("gram is not null").select("block", "gram", "n")
    length = code_lengths(asked.select("gram", "n"), depth)
    none = F.lit(None)
    answers = (asked.select("block", "gram").join(length, "gram")
               .select("block", "gram", F.col("log_p").alias("value"), none.cast("binary").alias("word"), none.cast("long").alias("count"))
               .unionByName(said.where("word is not null").select("block", none.cast("long").alias("gram"), none.cast("double").alias("value"), "word", "count")))
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    texts = base.where("docs is not null").select("block", "docs", F.lit(ends).alias("all_ends"))
    return meet(texts, answers, _scores(depth, tokens, distinct), schema).withColumnRenamed("id", id_col)

