"""Hard negatives by bounds along a spanning tree of the anchors.

Two anchors that lie near each other score any candidate nearly alike: the scores differ by at most the distance of the
anchors times the candidate's norm. Anchors are therefore joined into a least spanning tree and taken from its root on.
Every candidate has an interval for its score; from parent to child it widens by the edge times the norm. Only
candidates whose interval meets what the child looks for are scored anew, and then have an exact score to pass on.

What an anchor looks for is known step by step. First its positives: rows of its label at or above the k-th score,
which a few candidates with the greatest upper ends give. The positives fix the windows of the negatives, and in a
second run over the tree the rows of other labels are scored that may lie in a window.

Anchors are dealt into chunks, each with its tree, and candidates into shards. A task has one chunk and one shard, so
its memory is bounded; a vector is sent once per chunk, for thousands of scores each time, and k rows per anchor or
window come back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.workspace import materialise

#: Candidates of a shard and anchors of a chunk, about.
SHARD_ROWS = 1 << 15
CHUNK_ROWS = 1 << 12
#: Candidates scored first to find a floor for the positives, for each positive wanted.
FIRST_LOOK = 8
#: Room for rounding in bounds, as a share of the greatest possible score.
SLACK = 1e-9
TREE = pa.schema([("chunk", pa.int32()), ("node", pa.int32()), ("parent", pa.int32()), ("edge", pa.float64()), ("anchor_id", pa.int64()), ("anchor_label", pa.string()), ("asked", pa.list_(pa.int64()))])
POSITIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
NEGATIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def floors(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null, or one is not finite."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(doubles.isNotNull() & ~bad, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def matrix(lists: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers as a matrix of ``width`` columns at least; shorter rows end in zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A least spanning tree by nearest neighbours of the grown part: rows in the order they join it, the place of
    each one's parent in that order (-1 for the root), and the edge's length."""
    points = vectors.astype(np.float64)
    n = len(points)
    squares = (points**2).sum(axis=1)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    near, at, joined = np.full(n, np.inf), np.full(n, -1), np.zeros(n, bool)
    near[:1] = 0.0
    for step in range(n):
        row = int(np.where(joined, np.inf, near).argmin())
        order[step], parent[step], joined[row] = row, at[row], True
        if step:  # the length anew from the difference, which loses nothing to rounding
            edge[step] = np.linalg.norm(points[row] - points[order[at[row]]])
        apart = squares + squares[row] - 2 * (points @ points[row])
        closer = ~joined & (apart < near)
        near[closer], at[closer] = apart[closer], step
    return order, parent, edge


def visit_order(parent: np.ndarray) -> list[tuple[int, bool]]:
    """Nodes parent before child, the child with the most below it last, and whether a node is its parent's last one.

    A parent's intervals can be dropped at its last child, so only as many are held at once as there are turns off
    the heaviest path: the logarithm of the nodes at most."""
    n = len(parent)
    below, children = np.ones(n, np.int64), [[] for _ in range(n)]
    for node in range(n - 1, 0, -1):  # parents come before their children
        below[parent[node]] += below[node]
        children[parent[node]].append(node)
    out, stack = [], [(0, True)] if n else []
    while stack:
        node, last = stack.pop()
        out.append((node, last))
        own = sorted(children[node], key=lambda c: -below[c])
        stack += [(c, k == 0) for k, c in enumerate(own)]  # popped from the end: the heaviest last
    return out


class Candidates:
    """A shard: ids, label numbers and vectors, scored against single anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        greatest = float(np.abs(vectors).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(1, vectors.shape[1])
        self.type = np.float64 if greatest < 2.0**53 else np.int64  # doubles where every sum is exact in them
        self.vectors = vectors.astype(self.type)
        self.scored = 0

    def score(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact scores of some rows."""
        self.scored += len(rows)
        anchor = anchor.astype(self.type)
        if 2 * len(rows) > len(self.ids):
            return (self.vectors @ anchor)[rows].astype(np.int64)
        return (self.vectors[rows] @ anchor).astype(np.int64)


def along_tree(held: Candidates, parents: np.ndarray, edges: np.ndarray, anchors: np.ndarray, look):
    """Calls ``look(node, low, high, score)`` for every anchor with an interval for each candidate's score. ``score``
    takes rows, returns their exact scores and narrows the intervals that go on to the anchor's children."""
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for node, last in visit_order(parents):
        norm = float(np.linalg.norm(anchors[node].astype(np.float64)))
        reach = norm * held.norms * (1 + SLACK) + SLACK
        if node == 0:
            low, high = -reach, reach.copy()
        else:
            before = kept.pop(int(parents[node])) if last else kept[int(parents[node])]
            wider = edges[node] * held.norms * (1 + SLACK) + SLACK * (1 + reach)
            low, high = np.maximum(before[0] - wider, -reach), np.minimum(before[1] + wider, reach)

        def score(rows: np.ndarray) -> np.ndarray:
            exact = held.score(rows, anchors[node])
            low[rows] = high[rows] = exact
            return exact

        if node == 0:
            score(np.arange(len(held.ids)))
        look(node, low, high, score)
        if (parents == node).any():
            kept[node] = low, high


def find_positives(held: Candidates, ids, labels, parents, edges, anchors, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For every anchor the rows and scores of its k best candidates of its label, its own row passed over."""
    out = []

    def look(node, low, high, score):
        rows = np.flatnonzero((held.labels == labels[node]) & (held.ids != ids[node]))
        if len(rows) > FIRST_LOOK * k:
            first = rows[np.argpartition(-high[rows], FIRST_LOOK * k)[: FIRST_LOOK * k]]
            floor = np.sort(score(first))[-k]
            rows = rows[high[rows] >= floor]
        scores = score(rows)
        top = np.lexsort((held.ids[rows], -scores))[:k]
        out.append((node, rows[top], scores[top]))

    along_tree(held, parents, edges, anchors, look)
    return out


def find_negatives(held: Candidates, ids, labels, parents, edges, anchors, windows, k: int):
    """For every window (from, to, mark) of an anchor the k best candidates of other labels inside it: mark, rows, scores."""
    out = []

    def look(node, low, high, score):
        own = windows[node]
        if not own:
            return
        least, most = min(w[0] for w in own), max(w[1] for w in own)
        rows = np.flatnonzero((high >= least) & (low <= most) & (held.labels != labels[node]) & (held.ids != ids[node]))
        scores = score(rows)
        for least, most, mark in own:
            inside = (scores >= least) & (scores <= most)
            some, found = rows[inside], scores[inside]
            top = np.lexsort((held.ids[some], -found))[:k]
            out.append((node, mark, some[top], found[top]))

    along_tree(held, parents, edges, anchors, look)
    return out


def _task(asked: pa.Table, shard: pa.Table):
    """Numpy columns of one chunk and one shard; nodes in tree order."""
    asked = asked.sort_by("node")
    width = max(int(max(t.column(c).combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0) for t, c in ((asked, "asked"), (shard, "whole")))), 1)
    anchors, vectors = matrix(asked.column("asked"), width), matrix(shard.column("whole"), width)
    names = pa.concat_arrays([asked.column("anchor_label").combine_chunks(), shard.column("label").combine_chunks()])
    labels = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    held = Candidates(shard.column("vec_id").to_numpy(), labels[len(anchors) :], vectors, anchors)
    return held, (asked.column("anchor_id").to_numpy(), labels[: len(anchors)], asked.column("parent").to_numpy(), asked.column("edge").to_numpy(), anchors)


def _plant(chunk: pa.Table) -> pa.Table:
    """The tree of one chunk of anchors, a row per node."""
    if not chunk.num_rows:
        return TREE.empty_table()
    order, parent, edge = spanning_tree(matrix(chunk.column("asked")))
    chunk = chunk.take(pa.array(order))
    nodes = pa.array(np.arange(len(order), dtype=np.int32))
    columns = [chunk.column("chunk"), nodes, pa.array(parent.astype(np.int32)), pa.array(edge)]
    return pa.table(columns + [chunk.column(c) for c in ("anchor_id", "anchor_label", "asked")], schema=TREE)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label (of any type) and embedding (an array of numbers; a shorter one ends in zeros; other
    columns are ignored); ``is_anchor`` marks the anchors. Components become floor(scale * x), the score is their
    inner product, ties go to the smaller vec_id. Each anchor has the ``positives`` best other rows of its label, and
    for each of those the ``negatives`` best rows of other labels whose score is from ``least`` to ``most`` percent of
    the positive's. Rows with a null vec_id, label, vector or component, or a component that is not finite, take no part. Of
    rows that share a vec_id the one with the least label as text, then the least vector, stands for all. Scores must
    stay within 64 bits. An empty table, or one without anchors, gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.struct(F.col("label").cast("string").alias("label"), floors(F.col("embedding"), scale).alias("whole"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).alias("row"),
    ).filter("vec_id is not null and row.label is not null and row.whole is not null")
    rows = materialise(rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*"), "negatives-rows")
    anchors = rows.filter("asks").select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("whole").alias("asked"))
    shards, chunks = max(1, -(-rows.count() // SHARD_ROWS)), max(1, -(-anchors.count() // CHUNK_ROWS))
    # ids are single by now, so a hash of them fills shards and chunks evenly
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(chunks)).cast("int"))
    tree = materialise(anchors.groupBy("chunk").applyInArrow(_plant, from_arrow_schema(TREE)), "negatives-tree")
    dealt = rows.select("vec_id", "label", "whole", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).groupBy("chunk", "shard")

    def every_shard(asked: DataFrame):
        return asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).groupBy("chunk", "shard")

    def positive(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if not asked.num_rows or not shard.num_rows:
            return POSITIVES.empty_table()
        held, tree_columns = _task(asked, shard)
        found = find_positives(held, *tree_columns, positives)
        ids = np.concatenate([np.full(len(r), tree_columns[0][node]) for node, r, _ in found])
        columns = [ids, held.ids[np.concatenate([r for _, r, _ in found])], np.concatenate([s for _, _, s in found])]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=POSITIVES)

    found = every_shard(tree).cogroup(dealt).applyInArrow(positive, from_arrow_schema(POSITIVES))
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = found.withColumn("rank", rank).filter(F.col("rank") <= positives)
    # at most `positives` entries each
    chosen = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("pairs"))
    asked = materialise(tree.join(chosen, "anchor_id", "left").select(*tree.columns, "pairs"), "negatives-windows")

    def negative(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if not asked.num_rows or not shard.num_rows:
            return NEGATIVES.empty_table()
        held, tree_columns = _task(asked, shard)
        pairs = asked.sort_by("node").column("pairs").to_pylist()
        windows = [
            [(-(-least * p["positive_score"] // 100), most * p["positive_score"] // 100, (p["positive_id"], p["positive_score"])) for p in own or []]
            for own in pairs
        ]
        windows = [[w for w in own if w[0] <= w[1]] for own in windows]
        found = find_negatives(held, *tree_columns, windows, negatives)
        out = [(tree_columns[0][node], *mark, i, s) for node, mark, r, scores in found for i, s in zip(held.ids[r], scores)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], schema=NEGATIVES)

    mined = every_shard(asked).cogroup(dealt).applyInArrow(negative, from_arrow_schema(NEGATIVES))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return mined.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
