"""Exact top-k search by inner product, in tiles.

Vectors are turned into integers, so scores are exact.  Queries are packed
into blocks and all vectors into shards by a hash of the id; every block
meets every shard once (one tile per pair), a tile is one matrix product and
keeps only its ``k`` best per query, and the per-query lists are merged by a
tree of fixed fan-in.  A task holds one block, one shard and their scores:
the tile sizes are parameters and do not grow with the input.

Defined cases: vectors that are null, or hold null, NaN or infinite
components, take no part; shorter vectors count as padded with zeros; equal
scores go to the smaller id; a query has fewer rows if there are fewer
candidates; no query or no vector gives an empty result; a repeated id is a
candidate once per row but never of its own id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import store

QUERY_TILE = 1024
SHARD_TILE = 4096
FAN = 32
_LIST = "query_id long, vec_id long, score long"


def quantise(v: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null unless all are finite numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(math.inf)))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    m = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return m


def tile_best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """The k best (query, candidate, score) of one tile; ties to the smaller id."""
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], c[order]
    top = lambda m: int(np.abs(m).max(initial=0))
    exact = q.shape[1] * top(q) * top(c) < 1 << 53
    s = (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if exact else q @ c.T
    out = []
    for i, (me, row) in enumerate(zip(qid, s)):
        ok = np.flatnonzero(cid != me)
        if len(ok) > k:  # all that reach the k-th score, then by (score, id)
            least = np.partition(row[ok], len(ok) - k)[len(ok) - k]
            ok = ok[row[ok] >= least]
        best = ok[np.argsort(-row[ok], kind="stable")][:k]
        out.append((np.full(len(best), me), cid[best], row[best]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec: str = "v",
          query_tile: int = QUERY_TILE, shard_tile: int = SHARD_TILE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors.

    ``queries`` and ``vectors`` hold an id and an array of integers.
    """
    a = queries.select(F.col(id_col).alias("id"), F.col(vec).alias("v")).where("id is not null and v is not null")
    b = vectors.select(F.col(id_col).alias("id"), F.col(vec).alias("v")).where("id is not null and v is not null")
    n_q, n_v = a.count(), b.count()
    blocks, shards = max(1, -(-n_q // query_tile)), max(1, -(-n_v // shard_tile))
    slot = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = a.withColumn("block", slot(blocks)).withColumn("shard", every(shards))
    c = b.withColumn("shard", slot(shards)).withColumn("block", every(blocks))

    def tile(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or cs.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "part": []})
        dim = max(map(len, [*qs["v"], *cs["v"]]))
        i, j, s = tile_best(qs["id"].to_numpy(), _matrix(qs["v"], dim), cs["id"].to_numpy(), _matrix(cs["v"], dim), k)
        return pd.DataFrame({"query_id": i, "vec_id": j, "score": s, "part": int(cs["shard"].iloc[0])})

    tops = q.groupBy("block", "shard").cogroup(c.groupBy("block", "shard")).applyInPandas(tile, _LIST + ", part int")
    best = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    while shards > FAN:
        shards = -(-shards // FAN)
        tops = (tops.withColumn("part", F.expr(f"part % {shards}"))
                .withColumn("rank", best("query_id", "part")).where(F.col("rank") <= k).drop("rank"))
    return (tops.withColumn("rank", best("query_id")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search(table: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Queries: rows whose id is divisible by ``every``; candidates: all other rows."""
    v = store(table.select(F.col(id_col), quantise(F.col(vec)).alias("v")).where("v is not null"), "vectors")
    return top_k(v.where(F.col(id_col) % every == 0), v, k, id_col)
