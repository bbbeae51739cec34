"""Exact top-k search by inner product, in tiles.

Queries and candidates are dealt into blocks; a tile is one query block times one candidate block,
a matrix product with a partial selection per query. The short lists of a query are merged in a
tree of fixed fan-in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a block, and of the part of a query block multiplied at once: 4,096 x 8,192 scores of
# 8 bytes would not fit beside others, 512 x 8,192 (32 MB) do.
QUERY_BLOCK = 4_096
ROW_BLOCK = 8_192
STRIP = 512
FAN_IN = 16
LISTS = "query_id long, shard long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * component), as double; products and sums of these are exact below 2**53."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def best_of_tile(queries, q_ids, rows, ids, k: int):
    """The k best rows of each query: places of queries and rows, and scores. ``ids`` ascend, so of
    equal scores the earlier rows win. A query's own rows are left out."""
    scores = queries @ rows.T
    low, high = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
    for q in np.flatnonzero(high > low):
        scores[q, low[q] : high[q]] = -np.inf
    if scores.shape[1] > k:
        bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        q, r = np.nonzero((scores >= bound[:, None]) & np.isfinite(scores))
    else:
        q, r = np.nonzero(np.isfinite(scores))
    order = np.lexsort((r, -scores[q, r], q))
    q, r = q[order], r[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, "left")
    q, r = q[place < k], r[place < k]
    return q, r, scores[q, r]


def score_tile(k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(queries) and len(rows):
            rows = rows.sort_values("vec_id", kind="stable")
            ids = rows["vec_id"].to_numpy()
            matrix = np.stack(rows["row"].to_numpy()).astype(np.float64).reshape(len(rows), -1)
            names = queries["query_id"].to_numpy()
            for at in range(0, len(queries), STRIP):
                own = np.stack(queries["query"].to_numpy()[at : at + STRIP]).astype(np.float64)
                own_ids = names[at : at + STRIP]
                q, r, s = best_of_tile(own.reshape(len(own_ids), -1), own_ids, matrix, ids, k)
                parts.append(
                    pd.DataFrame(
                        {"query_id": own_ids[q], "shard": key[1], "vec_id": ids[r], "score": s.astype(np.int64)}
                    )
                )
        if not parts:
            return pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in LISTS.split(", ")})
        return pd.concat(parts)

    return run


def search(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for every query its ``k`` highest inner
    products with rows of another id, all if fewer; of equal scores the smaller id comes first.

    Both sides: ``id`` long, ``vector`` array<double> of whole numbers. Rows without id or with an
    unusable vector take no part; vectors meet only those of their own length. A row that is repeated is
    listed as often as it is there; of several queries with one id the smallest vector asks.
    Empty sides give an empty result.
    """
    queries = queries.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    queries = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shards = max(1, -(-rows.count() // ROW_BLOCK))
    size = F.size("vector").alias("size")
    # By a hash of the row, so that a repeated task deals it as before; copies of a row go to one shard.
    left = queries.select(
        F.expr(f"pmod(xxhash64(id), {blocks})").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        size,
        F.col("id").alias("query_id"),
        F.col("vector").alias("query"),
    )
    right = rows.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("row_block"),
        F.expr(f"pmod(xxhash64(id, vector), {shards})").alias("row_shard"),
        size.alias("row_size"),
        F.col("id").alias("vec_id"),
        F.col("vector").alias("row"),
    )
    lists = (
        left.groupBy("block", "shard", "size")
        .cogroup(right.groupBy("row_block", "row_shard", "row_size"))
        .applyInPandas(score_tile(k), LISTS)
    )
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        lists = lists.withColumn("shard", F.expr(f"shard div {FAN_IN}"))
        lists = ranked(lists, k, "query_id", "shard").drop("rank")
    return ranked(lists, k, "query_id").select("query_id", "rank", "vec_id", "score")


def ranked(lists: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
