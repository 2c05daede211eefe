"""Exact top-k search: tiles of queries and shards, the best of each tile, and a tree that merges them.

Components become floor(64 x).  Queries and candidates are dealt by their ids to blocks of about ``BLOCK`` and shards of
about ``SHARD`` vectors.  A tile is one block against one shard: a matrix product, of which each query keeps its k best.
Lists of a query are merged ``FAN_IN`` at a time until one is left, so no task sees more than a tile or a few lists.

The score is the integer inner product, exact: products whose sums could leave the 53 bits of a double are computed on
Python integers, and scores beyond 64 bits stop at 2^63 - 1 or its negative.  Equal scores are ordered by the smaller
vec_id.  Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without a vec_id.
Rows that share a vec_id are one vector, the smallest of them.  Vectors meet those of their own length only.  Without
candidates a query has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import store

SCALE = 64
BLOCK = 2048  # queries of a tile
SHARD = 4096  # candidates of a tile
FAN_IN = 16  # lists merged at a time
_ROWS = 256  # queries of a product at a time


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Stores (vec_id, size, v): the vectors that take part, times SCALE; tiles take the floor."""
    finite = F.forall(F.col(embedding), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    used = vectors.where(F.col(vec_id).isNotNull() & finite & (F.size(embedding) > 0))
    wide = F.transform(F.col(embedding).cast("array<double>"), lambda c: c * SCALE)
    return store(used.groupBy(F.col(vec_id).cast("long").alias("vec_id")).agg(F.min(wide).alias("v")).select(
        "vec_id", F.size("v").alias("size"), "v"), "vectors")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of a row; ties go to the smaller id.  ``ids`` ascends."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= edge)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:k]


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    top = [float(np.abs(m).max()) for m in (queries, candidates)]
    if top[0] * top[1] * queries.shape[1] < 2.0**53:
        return queries @ candidates.T
    whole = [np.array([[int(c) for c in row] for row in m], object) for m in (queries, candidates)]
    end = np.iinfo(np.int64).max
    return np.clip(whole[0] @ whole[1].T, -end, end).astype(np.int64)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table["id"].to_numpy()
    flat = table["x"].combine_chunks().flatten().to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], np.floor(flat.reshape(len(ids), -1)[order])


def _tile(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query, shard, lists, scores = [], [], [], []
        if left.num_rows and right.num_rows:
            own, one = _matrix(left)
            ids, two = _matrix(right)
            for at in range(0, len(own), _ROWS):
                for q, row in zip(own[at:at + _ROWS].tolist(), _products(one[at:at + _ROWS], two)):
                    places = best(row, ids, k + 1)
                    places = places[ids[places] != q][:k]
                    query.append(q)
                    lists.append(ids[places])
                    scores.append(row[places].astype(np.int64))
            shard = [right["shard"][0].as_py()] * len(query)
        return pa.table({"query_id": pa.array(query, pa.int64()), "shard": pa.array(shard, pa.int64()),
                         "ids": pa.array(lists, pa.list_(pa.int64())), "scores": pa.array(scores, pa.list_(pa.int64()))})

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of every quantised vector where ``is_query`` holds."""
    queries = vectors.where(is_query)
    n_queries, n = queries.count(), vectors.count()
    blocks, shards = max(1, -(-n_queries // block)), max(1, -(-n // shard))
    left = queries.select("size", F.col("vec_id").alias("id"), F.col("v").alias("x")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    right = vectors.select("size", F.col("vec_id").alias("id"), F.col("v").alias("x")).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["size", "block", "shard"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _tile(k), "query_id long, shard long, ids array<long>, scores array<long>")
    order = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("low"), x["ids"].alias("vec_id")))
    lists = found.select("query_id", "shard", order.alias("top"))
    while shards > 1:
        shards = -(-shards // FAN_IN)
        lists = lists.groupBy("query_id", F.floor(F.col("shard") / FAN_IN).alias("shard")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return lists.select("query_id", F.posexplode("top").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.low")).alias("score"))
