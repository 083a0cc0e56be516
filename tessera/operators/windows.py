"""Window-shaped operators (W1-W6), written so no window runs over an
unbounded partition of raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def best_per_group(df: DataFrame, group: list[str], measure: str, desc: bool = True,
                   rank: int = 1) -> DataFrame:
    """Rows whose ``rank()`` within ``group`` is <= ``rank`` (ties kept).

    Use it on aggregated rows; Catalyst adds a partial ``WindowGroupLimit``
    before the shuffle so each partition forwards at most the leading rows.
    """
    order = F.col(measure).desc() if desc else F.col(measure).asc()
    w = Window.partitionBy(*group).orderBy(order)
    return df.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") <= rank).drop("__rank")


def latest_revision(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Rows carrying the latest ``date`` of their key (ties kept).

    Written as aggregate + join on (keys, date) instead of
    ``max() over (partition by keys)``: the aggregate combines map-side, and
    the join key includes the date, so a key with very many revisions is
    spread over many tasks instead of sorted inside one.
    """
    latest = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(latest, [*keys, date], "left_semi")


def latest_slice(df: DataFrame, date: str) -> DataFrame:
    """Rows of the latest ``date`` in the whole frame.

    ``max() over ()`` would move every row to one partition; a scalar
    subquery computes the maximum once and filters in place.
    """
    return df.filter(F.col(date) == df.select(F.max(date)).scalar())


def previous_value(df: DataFrame, keys: list[str], order: list[str], col: str,
                   out: str) -> DataFrame:
    """``lag(col)`` within ``keys`` by ``order`` (give a full tie-break)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.lag(col).over(w))


def sample_per_group(df: DataFrame, by: list[str], k: int, key: list[str], seed: int = 0, ties: list[str] | None = None) -> DataFrame:
    """Exactly ``k`` rows of every group (all, if it has fewer): those whose key has the
    lowest hash.  The same rows in any partitioning.

    Bottom-k by hash merges: each task keeps its ``k`` lowest rows per group before
    anything is shuffled, so a group sends k rows per task, however large it is.
    Rows with equal keys are told apart by ``ties``.
    """
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    lowest = Window.partitionBy(*by).orderBy("__h", *key, *(ties or []))
    return df.withColumn("__h", h).withColumn("__r", F.row_number().over(lowest)).where(F.col("__r") <= k).drop("__h", "__r")
