"""Joins (C1-C14).

Broadcast policy: a side is hinted only if its row bound is known from
parameters (a generated calendar, a level list, a bin frame).  Every table is
left to the planner, which broadcasts by the size of its files or, at run
time, of its shuffle output, so the choice follows the data of each run.

Skewed keys (``Link.skewed``): the fact's frequent keys, found by a mergeable
heavy-hitter sketch, meet their few dimension rows by broadcast; all other rows
are shuffled, and no key among them holds more than a small share.

Key uniqueness (``Link.unique``, ``unique_by``): checked in the plan itself, by an
aggregate on the join's own key; a repeated key fails the job.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_MAX_ROWS = 100_000
#: A key with more than 1/HOT of the rows is hot, so there are fewer than HOT; counters of the sketch.
HOT, COUNTERS = 200, 10_000
#: Words of 64 bits in a semi-join's prefilter.
FILTER_WORDS = 1 << 14


def bounded(df: DataFrame, known_rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast-hint ``df``, which holds at most ``known_rows`` rows by
    construction, if that is within ``max_rows``; else leave it to the planner."""
    return F.broadcast(df) if known_rows <= max_rows else df


@dataclass
class Link:
    """One step of an enrichment chain: join ``dim`` on ``left_key = dim_key``."""
    dim: DataFrame
    left_key: str | list[str]
    dim_key: str | list[str]
    columns: list[str] = field(default_factory=list)
    how: str = "left"
    rows: int | None = None      # row bound known from parameters: may be broadcast
    skewed: bool = False         # the fact's frequent keys go by broadcast (the key is unique in ``dim``)
    unique: bool = False         # a repeated ``dim_key`` fails the job


def _one_key(df: DataFrame, keys: list[str]) -> Column:
    """The key as one value: itself, or a hash of its parts (as text, so that numbers
    of different types agree).  NULL if a part is NULL."""
    if len(keys) == 1:
        return df[keys[0]]
    known = reduce(lambda a, b: a & b, [df[k].isNotNull() for k in keys])
    return F.when(known, F.xxhash64(*[df[k].cast("string") for k in keys]))


def hot_keys(df: DataFrame, *keys: str) -> Column:
    """The keys with more than 1/``HOT`` of the rows (and some of little less), as
    an array: one aggregate over the key columns, a sketch of ``COUNTERS`` counters
    whose error is far below that share.  A scalar subquery: nothing runs until
    the plan does."""
    top = df.select(_one_key(df, list(keys)).alias("__k")).where("__k is not null").agg(
        F.expr(f"approx_top_k(__k, {HOT}, {COUNTERS})").alias("__t"), F.count(F.lit(1)).alias("__n"))
    return top.select(F.expr(f"transform(filter(__t, x -> x.count * {HOT} > __n), x -> x.item)")).scalar()


def unique_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, whose rows must differ in ``keys``: a repeated key fails the job
    with its values.  The check is the aggregate that puts a key's rows together on
    the way to the join, not a second pass.  Rows with a NULL key never join and
    are kept as they are."""
    others = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    text = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(f"`{k}`").cast("string")) for k in keys])
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    once = (df.where(known).groupBy(*keys).agg(F.any_value(row).alias("__row"), F.count(F.lit(1)).alias("__n"))
            .withColumn("__row", F.when(F.col("__n") == 1, F.col("__row")).otherwise(F.raise_error(F.concat(F.lit("repeated key: "), text)))))
    # the row is read from the checked value, so that the check cannot be pruned away; with no other column a filter reads it
    out = once.select(*[F.col(f"`{c}`") if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]) if others else \
        once.where("__row = 0").select(*keys)
    return out.unionByName(df.where(~known))


def enrich(fact: DataFrame, chain: list[Link]) -> DataFrame:
    """Walk a star/snowflake chain of joins from a fact.

    Each dimension is cut to its key plus the listed columns before joining,
    so only those columns are scanned.  Keys are renamed away after the join
    so chains never produce repeated column names.
    """
    out = fact
    for link in chain:
        lk = [link.left_key] if isinstance(link.left_key, str) else list(link.left_key)
        dk = [link.dim_key] if isinstance(link.dim_key, str) else list(link.dim_key)
        tmp = [f"__k{i}" for i in range(len(dk))]
        dim = link.dim.select(*[F.col(k).alias(t) for k, t in zip(dk, tmp)], *link.columns)
        if link.unique:
            dim = unique_by(dim, tmp)
        if link.rows is not None:
            dim = bounded(dim, link.rows)
        join = _skew_join if link.skewed else _join
        out = join(out, dim, lk, tmp, link.how).drop(*tmp)
    return out


def _join(fact: DataFrame, dim: DataFrame, left: list[str], right: list[str], how: str) -> DataFrame:
    return fact.join(dim, reduce(lambda a, b: a & b, [fact[a] == dim[b] for a, b in zip(left, right)]), how)


def _skew_join(fact: DataFrame, dim: DataFrame, left: list[str], right: list[str], how: str) -> DataFrame:
    if how not in ("left", "inner"):
        raise ValueError("a skewed link is a left or inner join")
    hot = hot_keys(fact, *left)
    often = lambda key: F.coalesce(F.array_contains(hot, key), F.lit(False))
    key = _one_key(fact, left)
    # a NULL key joins nothing: such rows are not shuffled either
    here = often(key) | key.isNull()
    few = F.broadcast(dim.where(often(_one_key(dim, right))))  # fewer than HOT keys, a row each (more only if hashes collide)
    return _join(fact.where(here), few, left, right, how).unionByName(_join(fact.where(~here), dim, left, right, how))


def _slot(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(FILTER_WORDS * 64))


def key_filter(keys: DataFrame) -> Column:
    """A Bloom filter (one hash, ``FILTER_WORDS`` words) of the only column of
    ``keys`` as an array of longs: a scalar subquery of bounded size."""
    slot = _slot(F.col(keys.columns[0]))
    words = keys.select(slot.alias("s")).selectExpr("cast(s div 64 as int) as w", "shiftleft(1L, cast(s % 64 as int)) as b")
    every = keys.sparkSession.range(FILTER_WORDS).selectExpr("cast(id as int) as w", "0L as b")
    return (words.groupBy("w").agg(F.bit_or("b").alias("b")).unionByName(every).groupBy("w").agg(F.bit_or("b").alias("b"))
            .agg(F.expr("transform(array_sort(collect_list(struct(w, b))), x -> x.b)")).scalar())


def may_hold(filter_: Column, key: Column) -> Column:
    """Whether ``key`` can be in the filter's set (never false for one that is)."""
    slot = _slot(key)
    word = F.get(filter_, F.floor(slot / 64).cast("int"))
    return F.call_function("shiftright", word, (slot % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def semi(df: DataFrame, keys: DataFrame, on: str | list[str], anti: bool = False, prefilter: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is (not) in ``keys`` -- IN (subquery).

    The key side is reduced to distinct keys first (combined map-side), so a
    key repeated on many fact rows is shuffled once per task, not per row.
    ``prefilter`` (one key column, not ``anti``): a Bloom filter of the keys is
    built first and applied where ``df`` is scanned, so that most rows without a
    partner never reach the shuffle; the join after it is exact.
    """
    cols = [on] if isinstance(on, str) else list(on)
    wanted = keys.select(*cols).distinct()
    if prefilter:
        if len(cols) != 1 or anti:
            raise ValueError("a prefilter takes one key column and a semi-join")
        # both sides hash the same type, or equal keys would get different slots
        kind = df.schema[cols[0]].dataType
        df = df.where(may_hold(key_filter(wanted.select(F.col(cols[0]).cast(kind))), F.col(cols[0])))
    return df.join(wanted, cols, "left_anti" if anti else "left_semi")


def parent_lookup(df: DataFrame, people: DataFrame, key: str, parent_key: str,
                  columns: list[str], prefix: str = "parent_") -> DataFrame:
    """Self-join along a parent key (employee -> manager).

    ``people`` must hold ``key``, ``parent_key`` and ``columns``; ``df`` holds
    ``key``.  Adds the person's columns and the parent's under ``prefix``.
    """
    me = people.select(F.col(key).alias("__me"), F.col(parent_key).alias("__parent"),
                       *columns)
    boss = people.select(F.col(key).alias("__boss"),
                         *[F.col(c).alias(prefix + c) for c in columns])
    out = df.join(me, df[key] == me["__me"], "left").drop("__me")
    out = out.join(boss, out["__parent"] == boss["__boss"], "left")
    return out.drop("__parent", "__boss")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that repeat, with their rows (empty: the key is unique); ``unique_by`` enforces it."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
