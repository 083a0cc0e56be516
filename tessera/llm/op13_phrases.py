"""Phrase collocation mining over sorted count streams.

Texts are cut at punctuation into pieces and those into words; per language,
phrases of 2 to ``most`` words that occur ``least`` times or more are scored by
how much more often their two parts stand together than apart, at the cut
where that is lowest.

Counting goes by length, so that what is rare is left out before it is sent:
blocks of text (``blocks``) ask which of their words are frequent, then which
pairs of these are.  Windows of 3 to ``most`` words whose pairs are all frequent
are mostly rare themselves, so they are counted by hash first: every block adds
its windows to ``_slots`` slots, packed (``_sketch``), and learns which of its
slots reach ``least`` in all blocks together (``_hot``).  A slot counts all that
a window in it occurs, or more, so one in a slot below is rare for certain.
From every word on the longest stretch without such a window is then counted
exactly.  A phrase that occurs ``least`` times has no rarer part, so nothing is
lost.  Words, pairs and stretches send one row per block and distinct key, the
sketch one per block and part of the slots.  Sorted, the stretches are one
stream that gives the counts of all longer phrases in one reading: those with a
common prefix stand together (``prefix_counts``).

The counts are then kept as two streams: in prefix order (sorted by first
word, second word, ...) and in suffix order (by last word, the one before it,
...).  Reading the prefix stream once gives each phrase the counts of the
phrases it begins with (left counts: the last shorter row of each length) and
to each phrase the highest count of those that go on from it by a word (right
extensions); the suffix stream gives right counts and left extensions the same
way.  Both streams are then merged on the phrase.  Streams are range-partitioned
by their first two words; single words' counts travel with the phrase, so no
partition needs another's rows, and each is read batch by batch with at most
``most`` open rows kept (``annotate``).

A candidate inside a longer one with (almost) its count is dropped; by
monotony one word more on either side decides that.

Defined cases: a null or empty text has no words; a null language is ``und``;
rows with equal ids are separate documents (ids are not read); extra columns of
the input are ignored; a repeated text counts as often as it stands there; ties
in score and count go by the phrase's bytes; an empty table or one without
frequent phrases gives an empty result.  A very long text is a block of its
own, read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm.blocks import BLOCK_BYTES, STEP_BYTES, binary_array, block_names, lean, meet, squeeze, unified, unsqueeze
from tessera.llm.common import LOWER, byte_set, mix, steps, store, width, words

#: Bytes that end a piece; blank and tab only part words.
STOPS = byte_set(b".,;:!?\n\v\f\r")
GAPS = STOPS | byte_set(b" \t")
UNKNOWN = "und"


def _pieces(data: np.ndarray, off: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of the texts, coded, and whether each is the first of its piece."""
    data = LOWER[data]
    start, end, row = words(data, off, GAPS)
    stops = np.cumsum(STOPS[data])
    first = np.ones(len(start), bool)
    if len(start):
        at = stops[start]
        first[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    return binary_array(data, start, end, ~GAPS[data]).cast(pa.binary()).dictionary_encode(), first


_BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("place", pa.int32()), ("n", pa.int64()),
                    ("langs", pa.list_(pa.string())), ("bounds", pa.list_(pa.int32())), ("ids", pa.binary())])
_BLOCK_SQL = "block long, lang string, word binary, place int, n long, langs array<string>, bounds array<int>, ids binary"


def _flush(block: int, held: dict[str, list]) -> Iterator[pa.RecordBatch]:
    """One row per distinct (language, word) of the block and one row with its sequence of words."""
    bounds, seq = [0], []
    for lang, parts in held.items():
        ids, found = unified([w for w, _ in parts])
        n, k = np.bincount(ids, minlength=len(found)).astype(np.int64), len(found)
        seq.append((ids + bounds[-1]) * 2 + np.concatenate([f for _, f in parts]))
        place = np.arange(bounds[-1], bounds[-1] + k, dtype=np.int32)
        bounds.append(bounds[-1] + k)
        empty = [pa.nulls(k, _BLOCK.field(c).type) for c in ("langs", "bounds", "ids")]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, block)), pa.array([lang] * k, pa.string()), found, pa.array(place), pa.array(n), *empty],
                                         schema=_BLOCK)
    yield pa.RecordBatch.from_pylist([{"block": block, "langs": list(held), "bounds": bounds,
                                       "ids": squeeze(np.concatenate(seq).astype(np.int32))}], _BLOCK)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lean()
    names, held, size = iter(block_names()), {}, 0
    for b in batches:
        by_lang = b.column(0).dictionary_encode()
        for code, lang in enumerate(by_lang.dictionary.to_pylist()):
            mine = b.filter(pa.array(by_lang.indices.to_numpy(zero_copy_only=False) == code))
            for _, data, off in steps([mine], budget=STEP_BYTES):
                w, first = _pieces(data, off)
                if len(w):
                    held.setdefault(lang, []).append((w, first))
                    size += len(data)
                if size >= BLOCK_BYTES:
                    yield from _flush(next(names), held)
                    held, size = {}, 0
    if held:
        yield from _flush(next(names), held)


def _known(block: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block's words as numbers into the answered ones (-1: rare), whether a
    word goes on a piece, and the answers' keys and counts, by place."""
    ids = unsqueeze(block["ids"][0].as_py(), np.int32)
    rows = answers.select(["place", "key", "count"]).filter(answers["place"].is_valid()).sort_by("place")
    number = np.full(block["bounds"][0].as_py()[-1], -1, np.int32)
    number[rows["place"].to_numpy()] = np.arange(len(rows), dtype=np.int32)
    return number[ids >> 1], (ids & 1) == 0, rows["key"].to_numpy(), rows["count"].to_numpy()


def _counted(block: pa.Table, **columns) -> pa.Table:
    return pa.table({"block": np.full(len(columns["n"]), block["block"][0].as_py() if len(block) else 0), **columns})


def _pairs(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Distinct pairs of neighbouring frequent words, counted."""
    none = np.empty(0, np.int64)
    if not len(block) or not len(answers):
        return _counted(block, g1=none, g2=none, n=none)
    x, on, key, _ = _known(block, answers)
    good = (x[:-1] >= 0) & (x[1:] >= 0) & on[1:]
    pair, n = np.unique(x[:-1][good].astype(np.int64) * len(key) + x[1:][good], return_counts=True)
    return _counted(block, g1=key[pair // len(key)], g2=key[pair % len(key)], n=n.astype(np.int64))


class _Windows:
    """A block's words as numbers; by size, where windows of 3 to ``most`` words begin
    whose every pair is frequent (``at``), and their slots."""

    def __init__(self, block: pa.Table, answers: pa.Table, most: int, slots: int):
        self.x, on, self.key, _ = _known(block, answers)
        x, k, order = self.x, len(self.key), np.argsort(self.key)
        rank = lambda c: order[np.searchsorted(self.key[order], c.to_numpy())]
        pairs = answers.select(["key", "g2"]).filter(answers["g2"].is_valid())
        known = np.sort(rank(pairs["key"]) * k + rank(pairs["g2"]))
        pair = np.zeros(len(x) + most, bool)
        at = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0) & on[1:])
        code = x[at].astype(np.int64) * k + x[at + 1]
        pair[at] = known[np.minimum(np.searchsorted(known, code), len(known) - 1)] == code
        at, hashed = np.flatnonzero(pair), mix(self.key.view(np.uint64))
        code = mix(hashed[x[at]]) + hashed[x[at + 1]]
        self.at, self.slot = {}, {}
        for m in range(3, most + 1):
            longer = pair[at + m - 2]
            at, code = at[longer], mix(code[longer])
            code += hashed[x[at + m - 1]]
            self.at[m], self.slot[m] = at, (mix(code) % np.uint64(slots)).astype(np.int64)

    def every_slot(self) -> np.ndarray:
        return np.concatenate(list(self.slot.values()))


def _slots(occurrences: int, least: int) -> int:
    """Slots for the windows of a table whose frequent pairs occur so often: a rare
    window shares its slot with an eighth of ``least`` others (at most 100 / 8), roughly."""
    return max(1, occurrences * 8 // max(1, min(least, 100)))


def _sketch(most: int, slots: int, parts: int):
    """How often the block's windows fall into each slot: a row per part of the slots,
    with the steps from slot to slot and the counts."""
    schema, span = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("steps", pa.binary()), ("counts", pa.binary())]), -(-slots // parts)

    def count(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(block) or not answers["g2"].is_valid().to_numpy().any():
            return schema.empty_table()
        slot, n = np.unique(_Windows(block, answers, most, slots).every_slot(), return_counts=True)
        cut, out = np.searchsorted(slot, np.arange(parts + 1) * span), []
        for p in np.flatnonzero(np.diff(cut)).tolist():
            mine = slice(cut[p], cut[p + 1])
            out.append({"block": block["block"][0].as_py(), "part": p, "steps": squeeze(np.diff(slot[mine], prepend=p * span).astype(np.int32)),
                        "counts": squeeze(n[mine].astype(np.int32))})
        return pa.Table.from_pylist(out, schema)

    return count, "block long, part int, steps binary, counts binary"


def _hot(span: int, least: int):
    """For each block's row of a part of ``span`` slots: which of its slots reach ``least`` in all rows together."""
    def hot(rows: pa.Table) -> pa.Table:
        lean()
        total = np.zeros(span, np.int64)
        slots = lambda packed: np.cumsum(unsqueeze(packed.as_py(), np.int32), dtype=np.int64)
        for packed, n in zip(rows["steps"], rows["counts"]):
            total[slots(packed)] += unsqueeze(n.as_py(), np.int32)
        reached = [np.packbits(total[slots(packed)] >= least).tobytes() for packed in rows["steps"]]
        return pa.table({"block": rows["block"], "part": rows["part"], "hot": pa.array(reached, pa.binary())})

    return hot, "block long, part int, hot binary"


def _stretches(most: int, slots: int, parts: int):
    schema, span = pa.schema([*[(f"g{i + 1}", pa.int64()) for i in range(most)], ("n", pa.int64())]), -(-slots // parts)

    def count(block: pa.Table, answers: pa.Table) -> pa.Table:
        """Distinct stretches of 3 to ``most`` words, counted: from every word on as
        far as all windows' slots are hot."""
        hot = answers.select(["part", "hot"]).filter(answers["hot"].is_valid()).sort_by("part")
        if not len(block) or not len(hot):
            return schema.empty_table()
        w = _Windows(block, answers, most, slots)
        slot, number = np.unique(w.every_slot(), return_inverse=True)
        asked = np.bincount(slot // span)
        reached = np.concatenate([np.unpackbits(np.frombuffer(h.as_py(), np.uint8), count=k)
                                  for h, k in zip(hot["hot"], asked[asked > 0].tolist(), strict=True)]).astype(bool)[number]
        good, lo, out = {most + 1: np.zeros(len(w.x) + 1, bool)}, 0, []
        for m in range(3, most + 1):
            good[m] = np.zeros(len(w.x) + 1, bool)
            good[m][w.at[m]] = reached[lo:lo + len(w.at[m])]
            lo += len(w.at[m])
            if m > 3:
                good[m][:-1] &= good[m - 1][:-1] & good[m - 1][1:]
        for m in range(3, most + 1):
            mine = np.flatnonzero(good[m] & ~good[m + 1])  # that end here
            got = pa.table({f"{i}": w.x[mine + i] for i in range(m)}).group_by([f"{i}" for i in range(m)]).aggregate([([], "count_all")])
            out.append(pa.table([*[w.key[got[f"{i}"].to_numpy()] if i < m else np.full(len(got), -1) for i in range(most)], got["count_all"].to_numpy()],
                                schema=schema))
        return pa.concat_tables(out)

    return count, ", ".join([*[f"g{i + 1} long" for i in range(most)], "n long"])


def prefix_counts(batches: Iterable[pa.RecordBatch], most: int, least: int, shortest: int = 4) -> Iterator[pa.RecordBatch]:
    """Read a sorted stream of stretches (keys g1 .. g<most>, -1 behind the last
    word, n) once: the phrases of ``shortest`` words or more that they begin with
    and that occur ``least`` times, with their size and count ``a``.

    Stretches with one prefix stand together; the last group of each size stays
    open until the next batch.
    """
    open_: dict[int, tuple[np.ndarray, int]] = {}

    def made(keys: np.ndarray, a: np.ndarray, m: int) -> pa.RecordBatch:
        enough = a >= least
        cols = [keys[enough, i] if i < m else np.full(int(enough.sum()), -1) for i in range(most)]
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.full(int(enough.sum()), m, np.int32)), pa.array(a[enough])],
                                          [*[f"g{i + 1}" for i in range(most)], "size", "a"])

    for b in batches:
        every = np.stack([b.column(i).to_numpy() for i in range(most)], 1)
        n = b.column(most).to_numpy()
        for m in range(shortest, most + 1):
            here = every[:, m - 1] >= 0
            k, c = every[here, :m], n[here]
            if m in open_:
                k, c = np.concatenate([open_[m][0][None], k]), np.concatenate([[open_[m][1]], c])
            if not len(k):
                continue
            first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)])
            a = np.add.reduceat(c, first)
            open_[m] = k[first[-1]], int(a[-1])
            yield made(k[first[:-1]], a[:-1], m)
    for m, (k, a) in open_.items():
        yield made(k[None], np.array([a]), m)


def counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases): frequent words (lang, word, key, count), words per
    language (lang, n) and phrases (lang, keys g1 .. g<most> with -1 behind the
    last word, size, counts of first and last word, a)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    base = store(rows.mapInArrow(_blocks, _BLOCK_SQL), "phrase-blocks")
    asked = base.where("word is not null").select("block", "lang", "word", "place", "n")
    texts = base.where("ids is not null").select("block", "langs", "bounds", "ids")
    totals = asked.groupBy("lang").agg(F.sum("n").alias("n"))
    # one shuffle: every block's row of a word gets the word's count and key (one of its rows' numbers; the
    # numbers differ between rows and the written table keeps them); the word itself stays in one row
    whole = lambda *c: Window.partitionBy(*c).orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    asked = (asked.withColumn("row", F.monotonically_increasing_id()).withColumn("count", F.sum("n").over(whole("lang", "word")))
             .withColumn("key", F.first("row").over(whole("lang", "word"))).where(F.col("count") >= least))
    once = lambda c: F.expr(f"if(key = row, {c}, null)").alias(c)
    known = store(asked.select("block", "place", "key", "count", once("lang"), once("word")), "phrase-known")
    found = known.where("word is not null").select("lang", "word", "key", "count")
    known = known.select("block", "place", "key", "count")
    keys = [f"g{i + 1}" for i in range(most)]

    # the frequent ones of all blocks' pairs; a row per block, one of each as head
    pairs = meet(texts, known, _pairs, "block long, g1 long, g2 long, n long")
    pairs = store(pairs.withColumn("a", F.sum("n").over(whole("g1", "g2"))).withColumn("head", F.first("block").over(whole("g1", "g2")) == F.col("block"))
                  .where(F.col("a") >= least).drop("n"), "phrase-frequent")
    phrases = pairs.where("head").select("g1", "g2", *[F.lit(-1).cast("long").alias(k) for k in keys[2:]], F.lit(2).alias("size"), "a")
    if most > 2:
        null = lambda kind, name: F.lit(None).cast(kind).alias(name)
        answers = (known.select("*", null("long", "g2"))
                   .unionByName(pairs.select("block", null("int", "place"), F.col("g1").alias("key"), null("long", "count"), "g2")))
        slots, parts = _slots(pairs.where("head").agg(F.sum("a")).first()[0] or 0, least), width(docs.sparkSession)
        hot = meet(texts, answers, *_sketch(most, slots, parts)).groupBy("part").applyInArrow(*_hot(-(-slots // parts), least))
        answers = (answers.select("*", null("int", "part"), null("binary", "hot"))
                   .unionByName(hot.select("block", null("int", "place"), null("long", "key"), null("long", "count"), null("long", "g2"), "part", "hot")))
        stretches = store(meet(texts, answers, *_stretches(most, slots, parts)), "phrase-windows").repartitionByRange(width(docs.sparkSession), *keys[:3])
        phrases = phrases.unionByName(stretches.sortWithinPartitions(*keys).mapInArrow(
            lambda it: prefix_counts(it, most, least, 3), ", ".join([*[f"{k} long" for k in keys], "size int, a long"])))
    phrases = (phrases.withColumn("last", F.element_at(F.array(*keys), F.col("size")))
               .join(found.select("lang", F.col("key").alias("g1"), F.col("count").alias("__first")), "g1")
               .join(found.select(F.col("key").alias("last"), F.col("count").alias("__last")), "last"))
    return found, totals, store(phrases.select("lang", *keys, "size", F.col("__first").alias("first"), F.col("__last").alias("last"), "a"), "phrase-counts")


def annotate(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Read a sorted stream of phrases once: to every row are added ``part2`` ..
    (the counts of the shorter phrases it starts with, 0 beyond) and ``more``
    (the highest count of a row that goes on from it by a word).

    The row a phrase starts with stands before it, and the last row of that
    size is it: every part of a counted phrase is counted itself.
    """
    names = [f"part{k}" for k in range(2, most)]
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        more = np.zeros(b.num_rows, np.int64)
        if held is not None:
            t = pa.Table.from_batches([held[0], b]).combine_chunks()
            b, more = t.to_batches()[0], np.concatenate([held[1], more])
        size, a, at = b.column("size").to_numpy(), b.column("a").to_numpy(), np.arange(b.num_rows)
        last = {k: np.maximum.accumulate(np.where(size == k, at, -1)) for k in range(2, most + 1)}
        for k in range(3, most + 1):
            np.maximum.at(more, last[k - 1][size == k], a[size == k])
        open_ = np.array([last[k][-1] for k in range(2, size[-1] + 1)])
        done = np.ones(b.num_rows, bool)
        done[open_] = False
        out = [np.where(size > k, a[last[k]], 0)[done] for k in range(2, most)]
        yield pa.RecordBatch.from_arrays([*b.filter(pa.array(done)).columns, *map(pa.array, out), pa.array(more[done])],
                                         [*b.schema.names, *names, "more"])
        held = b.take(pa.array(open_)), more[open_]
    if held is not None:
        b, more = held
        size, a = b.column("size").to_numpy(), b.column("a").to_numpy()
        out = [np.where(size > k, a[min(k - 2, len(a) - 1)], 0) for k in range(2, most)]
        yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, out), pa.array(more)], [*b.schema.names, *names, "more"])


def _stream(rows: DataFrame, order: list[str], most: int) -> DataFrame:
    schema = ", ".join([*[f"{c} {t}" for c, t in rows.dtypes], *[f"part{k} long" for k in range(2, most)], "more long"])
    return (rows.repartitionByRange(width(rows.sparkSession), *order[:2]).sortWithinPartitions(*order)
            .mapInArrow(lambda it: annotate(it, most), schema))


def scored(phrases: DataFrame, totals: DataFrame, most: int = 5, inside: int = 100) -> DataFrame:
    """Phrases with l, r, n and score of their lowest cut, without those inside a
    longer one that has ``inside`` percent of their count."""
    keys = [f"g{i + 1}" for i in range(most)]
    prefix = _stream(phrases, keys, most)
    turned = [F.expr(f"if(size > {i}, element_at(array({', '.join(keys)}), size - {i}), -1)").alias(f"s{i + 1}") for i in range(most)]
    suffix = _stream(phrases.select(*keys, "size", "a", *turned), [f"s{i + 1}" for i in range(most)], most)
    suffix = suffix.select(*keys, *[F.col(f"part{k}").alias(f"tail{k}") for k in range(2, most)], F.col("more").alias("before"))
    both = prefix.join(suffix.hint("merge"), keys).join(totals, "lang")
    # 1000 * a * n passes 64 bits: decimals, whose product and quotient are exact here
    dec = lambda c: F.col(c).cast("decimal(18,0)").cast("decimal(38,0)")
    both = both.withColumn("__top", (dec("a") * dec("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)"))
    left = lambda k: "first" if k == 1 else f"part{k}"
    right = lambda k: "last" if k == 1 else f"tail{k}"
    cuts = []
    for m in range(2, most + 1):
        at = [f"named_struct('score', __top div (cast({left(k)} as decimal(19,0)) * cast({right(m - k)} as decimal(19,0))), "
              f"'k', {k}, 'l', {left(k)}, 'r', {right(m - k)})" for k in range(1, m)]
        cuts.append(f"when {m} then array_min(array({', '.join(at)}))")
    return (both.where(f"greatest(more, before) * 100 < {inside} * a")
            .withColumn("__cut", F.expr(f"case size {' '.join(cuts)} end"))
            .select("lang", *keys, "size", "a", F.col("__cut.l").alias("l"), F.col("__cut.r").alias("r"), "n", F.col("__cut.score").alias("score")))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, most: int = 5,
                 inside: int = 100, top: int | None = 2000) -> DataFrame:
    """Per language its ``top`` phrases (None: all) by score, count and phrase:
    lang, rank, phrase, a, l, r, n, score."""
    found, totals, phrases = counts(docs, lang, text, least, most)
    best = scored(phrases, totals, most, inside)
    if top:  # all that can be among the first, ties included; their words are looked up after that
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        best = best.withColumn("__rank", F.rank().over(order)).where(F.col("__rank") <= top).drop("__rank")
    best = store(best, "phrase-best")
    keys = [f"g{i + 1}" for i in range(most)]
    spelled = (best.select(*keys, F.posexplode(F.slice(F.array(*keys), 1, F.col("size"))).alias("__at", "key"))
               .join(found.select("key", F.col("word").cast("string").alias("word")), "key")
               .groupBy(*keys).agg(F.expr("array_join(transform(array_sort(collect_list(struct(__at, word))), x -> x.word), ' ')").alias("phrase")))
    out = best.join(spelled, keys)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = out.withColumn("rank", rank.cast("long")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return out.where(F.col("rank") <= top) if top else out
