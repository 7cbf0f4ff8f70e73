"""Hard negatives against all scores."""

import numpy as np
import pytest
from compare import differences, duck
from llm.cases import TINY
from pyspark.sql import functions as F

from barlake.llm import hard_negatives
from barlake.llm.hard_negatives import Candidates, find_negatives, find_positives, mine, spanning_tree, visit_order
from barlake.llm.queries import OP13_SQL, op13_hard_negatives

INF, NAN = float("inf"), float("nan")


def plain(rows, anchors, k_positive=5, k_negative=3, least=50, most=95, scale=256):
    """Rows are (vec_id, label, vector), ids are all different."""
    whole = {
        i: (label, [int(np.floor(x * scale)) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for a in sorted(anchors & whole.keys()):
        label, own = whole[a]
        scored = sorted((-sum(x * y for x, y in zip(own, v)), i, other == label) for i, (other, v) in whole.items() if i != a)
        for s, p, _ in [t for t in scored if t[2]][:k_positive]:
            fit = [(i, -t) for t, i, same in scored if not same and least * -s <= 100 * -t <= most * -s][:k_negative]
            out += [(a, p, rank, i, -s, t) for rank, (i, t) in enumerate(fit, 1)]
    return sorted(out)


def collected(frame):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in frame.collect())


def clustered(rng, n, width=16, centres=12, noise=0.05):
    middle = rng.normal(size=(centres, width))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    return middle[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, width))


@pytest.mark.parametrize("shard,chunk,first", [(1 << 15, 1 << 12, 8), (60, 7, 1)])
@pytest.mark.parametrize("make", [lambda rng, n: rng.normal(size=(n, 16)), clustered])
def test_equals_all_scores(spark, monkeypatch, shard, chunk, first, make):
    for name, value in (("SHARD_ROWS", shard), ("CHUNK_ROWS", chunk), ("FIRST_LOOK", first)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(0, 4)), v.round(3).tolist()) for i, v in enumerate(make(rng, 300))]
    rows += [(300 + i, i % 3, rows[10][2]) for i in range(30)]  # equal vectors tie
    rows += [(400, None, rows[0][2]), (401, 1, None), (402, 1, [NAN] * 16), (403, 1, [INF] + [0.0] * 15), (404, 2, [None] + [0.0] * 15), (None, 1, rows[0][2]), (410, 2, [0.0] * 16)]
    docs = spark.createDataFrame([(i, label, v, 1, "x") for i, label, v in rows], "vec_id long, label int, embedding array<double>, node int, whole string")
    got = collected(mine(docs, F.col("vec_id") % 10 == 0))
    assert got == plain(rows, {i for i, *_ in rows if i is not None and i % 10 == 0})
    assert got


def test_few_repeated_and_ragged_rows(spark):
    rows = [(0, "a", [2.0]), (0, "a", [2.0]), (1, "a", [2.0, 5.0]), (2, "b", [1.5, -3.0]), (2, "c", [9.0]), (3, "b", [1.0]), (4, "b", [0.5]), (5, "b", [])]
    docs = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    # the row of label b stands for vec_id 2: its 1.5 becomes 1, and its score of 2 is in the window from 2 to 3
    assert collected(mine(docs, F.col("vec_id") == 0, scale=1)) == [(0, 1, 1, 2, 4, 2), (0, 1, 2, 3, 4, 2)]


def test_negative_and_zero_positive_scores(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 1, [0.0, 1.0]), (3, 2, [0.0, 2.0]), (4, 2, [-0.7, 0.0]), (5, 2, [0.5, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert collected(mine(docs, F.col("vec_id") == 0)) == plain(rows, {0}) == [(0, 2, 1, 3, 0, 0)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<double>")
    assert mine(docs.limit(0), F.lit(True)).count() == 0
    assert mine(docs, F.lit(False)).count() == 0
    assert mine(docs, F.lit(True)).count() == 0


def test_scores_beyond_doubles_are_whole(spark):
    big = 2.0**20 + 1
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big * 0.9, 7.0]), (3, 2, [big * 0.9, 8.0])]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert collected(mine(docs, F.col("vec_id") == 0)) == plain(rows, {0})


def test_spanning_tree_is_least_and_visits_hold_few():
    rng = np.random.default_rng(2)
    points = rng.integers(-50, 50, (80, 5))
    order, parent, edge = spanning_tree(points)
    assert sorted(order) == list(range(80)) and parent[0] == -1 and (parent[1:] < np.arange(1, 80)).all()
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    edges, root = sorted((apart[i, j], i, j) for i in range(80) for j in range(i)), list(range(80))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    total = 0.0  # the greedy forest of shortest edges
    for length, i, j in edges:
        if top(i) != top(j):
            root[top(i)] = top(j)
            total += length
    assert np.isclose(edge.sum(), total)
    held, most = {0}, 0
    for node, last in visit_order(parent):
        assert node == 0 or parent[node] in held
        if last and node:
            held.discard(parent[node])
        if (parent == node).any():
            held.add(node)
        most = max(most, len(held))
    assert not held and most <= 8
    chain = np.arange(-1, 5000)
    assert [n for n, _ in visit_order(chain)] == list(range(5001))


def test_bounds_spare_candidates():
    """On clustered vectors most candidates of most anchors are never scored."""
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * clustered(rng, 6000, 32, 40, 0.01)).astype(np.int64)
    labels, ids = rng.integers(0, 5, 6000), np.arange(6000)
    order, parents, edges = spanning_tree(vectors[:300])
    anchors = vectors[:300][order]
    held = Candidates(ids, labels, vectors, anchors)
    positives = find_positives(held, ids[order], labels[order], parents, edges, anchors, 5)
    spent = held.scored
    assert spent < 0.35 * 300 * 6000
    windows = [[(-(-50 * int(s[0]) // 100), 95 * int(s[0]) // 100, 0)] for _, _, s in sorted(positives, key=lambda p: p[0])]
    found = find_negatives(held, ids[order], labels[order], parents, edges, anchors, windows, 3)
    assert held.scored - spent < 0.35 * 300 * 6000
    whole = vectors @ anchors.T
    for node, rows, scores in positives:
        same = np.flatnonzero((labels == labels[order][node]) & (ids != ids[order][node]))
        top = same[np.lexsort((same, -whole[same, node]))[:5]]
        assert rows.tolist() == top.tolist() and scores.tolist() == whole[top, node].tolist()
    for node, _, rows, _ in found:
        low, high, _ = windows[node][0]
        fit = np.flatnonzero((labels != labels[order][node]) & (whole[:, node] >= low) & (whole[:, node] <= high))
        assert rows.tolist() == fit[np.lexsort((fit, -whole[fit, node]))[:3]].tolist()


def test_query_equals_sql(spark):
    assert differences(op13_hard_negatives(spark, TINY), duck(TINY), OP13_SQL) is None
