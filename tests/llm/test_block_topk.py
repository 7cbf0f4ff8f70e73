"""Block-at-a-time top-k against all products."""

import numpy as np
import pytest
from compare import differences, duck
from llm.cases import TINY
from pyspark.sql import functions as F

from barlake.llm import block_topk
from barlake.llm.block_topk import search_shard, top_k
from barlake.llm.queries import OP8_SQL, op8_block_topk

INF, NAN = float("inf"), float("nan")


def plain(rows, queries, k, scale=256):
    """(query_id, rank): (vec_id, score) by all products; ids are all different."""
    whole = {
        i: [int(np.floor(x * scale)) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = {}
    for q in queries & whole.keys():
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def collected(frame):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in frame.collect()}


@pytest.mark.parametrize("shard,block,chunk", [(8192, 128, 512), (40, 7, 5)])
def test_equals_all_products(spark, monkeypatch, shard, block, chunk):
    monkeypatch.setattr(block_topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(block_topk, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # equal vectors tie
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [NAN] * 8), (403, [INF] + [0.0] * 7), (None, rows[0][1])]
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = collected(top_k(docs, F.col("vec_id") % 10 == 0, k=6))
    assert got == plain(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 6)


@pytest.mark.parametrize("block", [1, 3, 64, 1000])
def test_pruning_loses_nothing(block):
    rng = np.random.default_rng(block)
    vectors = rng.integers(-300, 300, (500, 16))
    ids, queries, q_ids = rng.permutation(500), vectors[:40], np.arange(40)
    at, found, scores = search_shard(ids[:40], queries, ids, vectors, 5, block)
    for q in range(40):
        every = sorted((-int(s), int(i)) for s, i in zip(vectors @ queries[q], ids) if i != ids[q])[:5]
        assert sorted((-s, i) for a, i, s in zip(at.tolist(), found.tolist(), scores.tolist()) if a == q) == every
    assert len(q_ids) == 40


def test_few_rows_repeated_rows_and_ragged_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0]), (2, [1.0, 1.0, 1.0]), (3, [])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(top_k(docs, F.col("vec_id") == 0, k=5))
    assert got == {(0, 1): (2, 3 * 65536), (0, 2): (1, 65536), (0, 3): (3, 0)}


def test_many_vectors_of_one_id_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(block_topk, "SHARD_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [(7, rng.normal(size=4).round(2).tolist()) for _ in range(400)] + [(k, rng.normal(size=4).round(2).tolist()) for k in range(20, 40)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(top_k(docs, F.col("vec_id") == 20, k=3))
    whole = [(i, np.floor(np.array(v) * 256).astype(int)) for i, v in rows]
    asked = dict(whole)[20]
    best = {}
    for i, v in whole:
        if i != 20:
            best[i] = max(best.get(i, -(10**9)), int(v @ asked))
    assert [got[20, rank] for rank in (1, 2, 3)] == sorted(best.items(), key=lambda p: (-p[1], p[0]))[:3]
    parts = docs.select(F.pmod(F.xxhash64("vec_id", block_topk.whole_components(F.col("embedding"))), F.lit(9)).alias("s")).groupBy("s").count()
    assert parts.agg({"count": "max"}).first()[0] < 80


def test_sums_beyond_doubles_are_whole(spark):
    rows = [(0, [2.0**20 + 1, 1.0]), (1, [2.0**20 + 1, 1.0]), (2, [2.0**20 + 1, 2.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert collected(top_k(docs, F.col("vec_id") == 0, k=2)) == plain(rows, {0}, 2)


def test_empty_table_and_no_query(spark):
    docs = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert top_k(docs.limit(0), F.lit(True)).count() == 0
    assert top_k(docs, F.lit(False)).count() == 0
    assert top_k(docs, F.lit(True)).count() == 0


def test_query_equals_sql(spark):
    assert differences(op8_block_topk(spark, TINY), duck(TINY), OP8_SQL) is None
