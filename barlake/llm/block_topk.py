"""Exact top-k inner products by block-at-a-time pruning.

A vector is a document whose terms are its components. Documents fall into blocks, ranges of a document order,
and a block keeps the largest and the smallest value of each term: summed over a query's components, they
bound every score in the block. A query takes its blocks in falling order of that bound, scores a block's
documents through its forward index (the block's own rows), and stops where the next bound is below its k-th
best score. A bound equal to the k-th score is still taken, since a tie goes to the smaller id.

Documents are dealt into shards and queries into chunks; a task has one chunk and one shard, so its memory is
bounded whatever the tables hold, and all that leaves a task is k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

#: Documents in a shard, in a block, and queries in a chunk, about.
SHARD_ROWS = 8192
BLOCK_ROWS = 128
CHUNK_ROWS = 512
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or has a null or non-finite component."""
    doubles = vector.cast("array<double>")
    broken = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~broken, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of numbers as a matrix; shorter rows end in zeros."""
    lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products of rows: in doubles where every sum is exact in them, else in 64-bit numbers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def block_order(vectors: np.ndarray) -> np.ndarray:
    """Rows so that like vectors are neighbours: by their signs along a few fixed directions, which makes the
    term maxima of blocks tight."""
    directions = np.random.default_rng(5).normal(size=(vectors.shape[1], 12))
    signs = (vectors.astype(np.float64) @ directions) > 0
    codes = signs @ (1 << np.arange(12))
    gray = codes ^ (codes >> 1)
    return np.argsort(gray, kind="stable")


def search_shard(q_ids, queries, ids, vectors, k: int, block_rows: int = BLOCK_ROWS):
    """The k best of a shard for every query: row of the query, id, score; the query's own id is passed over.

    ``queries`` and ``vectors`` are matrices of equal width; of rows of one id the best counts.
    """
    order = block_order(vectors)
    ids, vectors = ids[order], vectors[order]
    starts = np.arange(0, len(ids), block_rows)
    high = np.maximum.reduceat(vectors, starts, axis=0)
    low = np.minimum.reduceat(vectors, starts, axis=0)
    bounds = _products(np.maximum(queries, 0), high) + _products(np.minimum(queries, 0), low)
    turn = np.argsort(-bounds, axis=1, kind="stable")
    out = []
    kth = np.full(len(queries), np.iinfo(np.int64).min)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
    going = np.arange(len(queries))
    for step in range(len(starts)):
        going = going[bounds[going, turn[going, step]] >= kth[going]]
        if not len(going):
            break
        block_of = turn[going, step]
        for block in np.unique(block_of):  # queries that are at the same block are scored together
            own = going[block_of == block]
            rows = slice(starts[block], starts[block] + block_rows)
            scores = _products(queries[own], vectors[rows])
            for q, row in zip(own, scores):
                held_ids, held = best[q]
                take = (row >= kth[q]) & (ids[rows] != q_ids[q])
                if not take.any():
                    continue
                some_ids = np.concatenate([held_ids, ids[rows][take]])
                some = np.concatenate([held, row[take]])
                top = np.lexsort((some_ids, -some))
                top = top[np.sort(np.unique(some_ids[top], return_index=True)[1])][:k]  # an id counts once
                best[q] = some_ids[top], some[top]
                if len(top) == k:
                    kth[q] = some[top[-1]]
    for q, (found, scores) in enumerate(best):
        out.append((np.full(len(found), q), found, scores))
    return tuple(np.concatenate(c) for c in zip(*out))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows for every query.

    ``vectors`` has vec_id and embedding (an array of numbers; other columns are ignored); ``is_query`` marks
    the queries. Components become floor(scale * x), the score is their inner product (a shorter vector ends in
    zeros), and ties go to the smaller vec_id. Vectors that are null or hold a null or non-finite component, and
    rows without a vec_id, take no part. A row is no candidate for queries of its own vec_id; equal rows are one
    candidate, and rows of one vec_id with different vectors are candidates with the score of the best. Sums
    must stay within 64 bits.
    """
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_components(F.col("embedding"), scale).alias("whole"), is_query.alias("asks"))
        .filter("vec_id is not null and whole is not null")
    )
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    chunks = max(1, -(-rows.filter("asks").count() // CHUNK_ROWS))
    # by a hash of id and vector, so that neither clustered ids nor many vectors of one id crowd a task
    candidates = rows.select("vec_id", "whole", F.pmod(F.xxhash64("vec_id", "whole"), F.lit(shards)).cast("int").alias("shard"))
    candidates = candidates.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    queries = rows.filter("asks").select(F.col("vec_id").alias("query_id"), F.col("whole").alias("asked"), F.pmod(F.xxhash64("vec_id", "whole", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return FOUND.empty_table()
        q, v = _matrix(asked.column("asked")), _matrix(held.column("whole"))
        width = max(q.shape[1], v.shape[1])
        q, v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, v))
        q_ids = asked.column("query_id").to_numpy()
        at, found, scores = search_shard(q_ids, q, held.column("vec_id").to_numpy(), v, k)
        return pa.table([pa.array(q_ids[at]), pa.array(found), pa.array(scores)], schema=FOUND)

    pairs = queries.groupBy("chunk", "shard").cogroup(candidates.groupBy("chunk", "shard"))
    found = pairs.applyInArrow(search, from_arrow_schema(FOUND)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
