"""Mixing sources to target weights by subset-sum budget fitting.

Targets: every source's share of all words follows its weight, stops at
``max_repeats`` times the source's size, and what is cut off goes to the
others by weight (water filling: target = min(cap, level * weight)).

Selection per source with target T and size S: every document is taken
``floor(T / S)`` times; the remaining budget is filled with one more copy of
some documents.  Documents are counted by exact length; every length first
gives the same share of its count (rounded down); the budget still open is
fitted exactly, or else as closely as possible from below, by a
bounded-knapsack dynamic program over the counts left.  Which documents of a
length are taken follows a seeded hash of the id.

Only counts by (source, length) meet in one task: their number is bounded by
the distinct lengths, not by the documents.  Ranking within a length works on
hash slices (``SLICES`` per length), so no length has to fit in a task.

Defined cases: a null text has size 0 and is taken 0 words; a null source is
a source of its own, last in order; an empty table gives an empty result;
sources without words have target 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm.common import skew_join, store

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SLICES = 1024
SEED = 20
#: Budget (words) up to which the dynamic program runs; above it whole lengths
#: are given out first, so this bounds its memory and not what is mixed.
FIT = 1 << 16


def targets(sizes: list[int], weights: list[float], cap: float = MAX_REPEATS) -> list[float]:
    """Share sum(sizes) by weight; no share above ``cap`` times its size."""
    out, left = [0.0] * len(sizes), float(sum(sizes))
    open_ = [i for i in range(len(sizes)) if sizes[i] > 0]
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length: their total is the largest one up to ``budget``
    that the even start and the knapsack reach (exact where a sum exists)."""
    take = [0] * len(lengths)
    total = sum(x * c for x, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    left = budget
    if left > FIT:  # an even share of every length
        for i, (x, c) in enumerate(zip(lengths, counts)):
            take[i] = c * budget // total
            left -= take[i] * x
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:  # then the longest that still fit, until the program can take over
        if left <= FIT:
            break
        k = min(counts[i] - take[i], (left - FIT) // lengths[i] + 1, left // lengths[i]) if lengths[i] else 0
        take[i] += k
        left -= k * lengths[i]
    # reachable sums as bits of an integer; lengths in binary-split bundles, short ones first
    reach, mask, log = 1, (1 << (left + 1)) - 1, []
    for i in reversed(order):
        x, c = lengths[i], counts[i] - take[i]
        if x == 0 or x > left:
            continue
        c, k = min(c, left // x), 1
        while c > 0 and not reach >> left & 1:
            m = min(k, c)
            log.append((i, m, reach))
            reach |= (reach << (m * x)) & mask
            c, k = c - m, k * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, m, before in reversed(log):
        if not before >> at & 1:
            at -= m * lengths[i]
            take[i] += m
    return take


def _fitter(groups: Iterator[pd.DataFrame]) -> pd.DataFrame:
    g = groups.sort_values("__size")
    take = fit([int(x) for x in g["__size"]], [int(x) for x in g["__count"]], int(g["__budget"].iloc[0]))
    return pd.DataFrame({"__src": g["__src"], "__size": g["__size"], "__count": g["__count"], "__extra": take})


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """Per document: id, source, size, source_size, target, copies, taken.

    The same seed gives the same mix, however the rows are partitioned; of
    repeated rows each is taken or not by itself.  One row per source (a list the user sets weights for) is
    read on the driver.
    """
    spark = docs.sparkSession
    size = F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")
    # a null source gets a key that no string has
    src = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    d = store(docs.select(F.col(id_col).alias("__id"), src.alias("__src"), size.alias("__size"), h.alias("__h")), "mix-sizes")
    found = {r[0]: int(r[1]) for r in d.groupBy("__src").agg(F.sum("__size")).collect()}
    order = sorted((k for k in found if k != "n"), key=lambda k: [ord(c) for c in k]) + [k for k in found if k == "n"]
    sizes = [found[k] for k in order]
    want = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(order))], max_repeats)
    plan = []
    for k, s, t in zip(order, sizes, want):
        # a target of k times the size is k whole copies, whatever the last bits of the division
        whole = min(max_repeats, int((t + 1e-6) // s)) if s else 0
        plan.append((k, s, float(t), whole, max(0, round(t) - whole * s)))
    per_source = spark.createDataFrame(plan, "__src string, source_size long, target double, __whole int, __budget long")
    by_length = d.where("__size > 0").groupBy("__src", "__size").agg(F.count("*").alias("__count"))
    extra = (by_length.join(F.broadcast(per_source.select("__src", "__budget").where("__budget > 0")), "__src")
             .groupBy("__src").applyInPandas(_fitter, "__src string, __size long, __count long, __extra long").where("__extra > 0"))
    extra = store(extra, "mix-lengths")
    c = store(skew_join(d, extra, ["__src", "__size"], "__count", "left")
              .withColumn("__slice", F.shiftrightunsigned("__h", 64 - (SLICES.bit_length() - 1)).cast("int")), "mix-classes")
    # rank by hash within (source, length): slices before this one, then inside the slice
    key = ["__src", "__size", "__slice"]
    some = c.where("__extra is not null")
    before = (some.groupBy(*key).agg(F.count("*").alias("__rows"))
              .withColumn("__before", F.sum("__rows").over(Window.partitionBy("__src", "__size").orderBy("__slice")) - F.col("__rows"))
              .drop("__rows"))
    inside = F.row_number().over(Window.partitionBy(*key).orderBy("__h", "__id"))
    ranked = some.withColumn("__rank", inside).join(before, key)
    more = ranked.withColumn("__more", (F.col("__before") + F.col("__rank") <= F.col("__extra")).cast("int"))
    cols = ["__id", "__src", "__size", "__more"]
    out = more.select(*cols).unionByName(c.where("__extra is null").withColumn("__more", F.lit(0)).select(*cols))
    copies = (F.col("__whole") + F.col("__more")).cast("int")
    return (out.join(F.broadcast(per_source), "__src")
            .select(F.col("__id").alias(id_col), F.expr("if(__src = 'n', null, substring(__src, 2))").alias(source),
                    F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"),
                    (copies * F.col("__size")).cast("long").alias("taken")))
