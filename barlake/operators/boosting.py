"""Leaf-wise boosted trees from distributed histograms, for many training sets at once.

Rows are binned once and packed into blocks that stay cached on the executors. Training sets that fit into a task are
dealt out whole, a task for each, and grown there without a round trip; a round per level of a tree costs a job each, which
is most of the time of a small set. For larger sets a round sends every block the trees as far as they are grown and asks for gradient histograms of a few leaves; blocks answer for all training sets (every
fold, its probe and its final fit: a bit per set in the row's mask). The answers are shuffled by training set and leaf,
added up there, and searched for the leaf's best split. The driver gets that split alone, a few numbers per leaf
whatever the number of rows, features and bins, and chooses which leaves are split.

Trees grow best first: of all leaves the one of the greatest gain is split next, to ``leaves`` leaves. A round splits
every leaf that could still be among these, so a tree takes as many rounds as it is deep, and best-first order is taken
from the gains afterwards. Both ways take the same steps and give the same trees.

Gradients are rounded to whole multiples of 2**-20, so sums of histograms are exact and don't depend on the order in
which blocks are added: a lost executor, other partitions or another cluster give the same trees to the last bit.
A block's running predictions are a memo of the worker process; where it is missing they are computed again from the
trees, which are broadcast.
"""

from __future__ import annotations

import pickle
import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barlake.settings import TreeSettings

#: Gradients are whole multiples of 1 / GRID.
GRID = float(1 << 20)
#: Rows of a block at most, about.
BLOCK_ROWS = 1 << 17
#: Trees that travel with every round; older ones are broadcast once.
RECENT_TREES = 8
#: Histograms of parts that a task adds up, about; the tasks of a round follow from it.
TASK_HISTOGRAMS = 512
#: Rows of a training set that one task grows, at most; a row takes some 100 bytes there.
TASK_ROWS = 1 << 20
#: Rows whose histograms are counted at once.
CHUNK_ROWS = 1 << 14
#: Bytes of predictions that a worker process remembers.
MEMO_BYTES = 512 << 20


@dataclass
class Tree:
    """Splits in the order they were made: the split leaf keeps its number for rows up to the bin, the others get the
    next free number. ``values`` has what each leaf adds to the prediction."""

    leaf: list[int]
    feature: list[int]
    bin: list[int]
    gain: list[float]
    values: list[float]


@dataclass
class Forest:
    """A fitted ensemble: bin edges per feature, the mean it starts from, its trees."""

    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def gains(self) -> dict[str, float]:
        """Share of the total gain per feature."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain):
                total[self.features[f]] += g
        whole = sum(total.values())
        return {name: g / whole if whole else 0.0 for name, g in total.items()}


def bins_of(values: np.ndarray, edges: Sequence[float]) -> np.ndarray:
    """Number of edges below each value."""
    return np.searchsorted(np.asarray(edges, np.float64), values, side="left").astype(np.uint8)


def leaf_of(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """The leaf of every row; ``bins`` has a line per feature."""
    kind = np.int8 if len(tree.leaf) < 128 else np.int16
    node = np.zeros(bins.shape[1], kind)
    for k, (leaf, feature, at) in enumerate(zip(tree.leaf, tree.feature, tree.bin), 1):
        moved = node == leaf
        moved &= bins[feature] > at
        node += moved.view(np.int8) * kind(k - leaf)  # several times as fast as setting them by the mask
    return node


def predict(bins: np.ndarray, forest: Forest) -> np.ndarray:
    out = np.full(bins.shape[1], forest.base)
    for tree in forest.trees:
        out += np.asarray(tree.values)[leaf_of(bins, tree)]
    return out


def sampled(keys: np.ndarray, tree: int, settings: TreeSettings) -> np.ndarray:
    """Rows that a tree sees: by a hash of the row's key and the tree's number, the same wherever the row lies."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(tree + 1 + (settings.seed << 20))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) < settings.row_fraction * 2.0**53


def tree_features(n: int, tree: int, settings: TreeSettings) -> np.ndarray:
    """Which features a tree may split on."""
    out = np.zeros(n, bool)
    drawn = np.random.default_rng([settings.seed, tree]).permutation(n)
    out[drawn[: max(1, int(n * settings.feature_fraction + 0.5))]] = True
    return out


def best_splits(sums: np.ndarray, counts: np.ndarray, features: Sequence[int], settings: TreeSettings) -> list[tuple | None]:
    """For every leaf with these histograms (leaves x features x bins, of the features with these numbers) the gain,
    feature, bin, left sum and left count of its best split, the first one of equals; None if no split leaves enough rows
    on both sides or gains anything."""
    total, n = sums[:, :1, :].sum(axis=2, keepdims=True), counts[:, :1, :].sum(axis=2, keepdims=True)
    left, held = np.cumsum(sums, axis=2)[:, :, :-1], np.cumsum(counts, axis=2)[:, :, :-1]
    penalty = settings.l2
    fits = (held >= settings.min_rows_per_leaf) & (n - held >= settings.min_rows_per_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):  # of empty sides, which don't count
        gains = left**2 / (held + penalty) + (total - left) ** 2 / (n - held + penalty) - total**2 / (n + penalty)
    gains = np.where(fits, gains, 0.0).reshape(len(sums), -1)
    if not gains.shape[1]:
        return [None] * len(sums)
    at = gains.argmax(axis=1)
    out = []
    for k, place in enumerate(at.tolist()):
        feature, cell = divmod(place, left.shape[2])
        gain = float(gains[k, place])
        split = gain, int(features[feature]), cell, float(left[k, feature, cell]), float(held[k, feature, cell])
        out.append(split if gain > 0 else None)
    return out


class Growing:
    """One tree while it grows: every split tried so far, the best splits of its nodes, and the best-first choice."""

    def __init__(self, settings: TreeSettings):
        self.settings = settings
        self.tried = Tree([], [], [], [], [])  # splits of all rounds, for the blocks
        self.children: dict[int, tuple[int, int]] = {}  # node: (left, right), nodes counted as they appear
        self.end = {0: 0}  # node: its number at the blocks, for nodes without children
        self.splits: dict[int, tuple | None] = {}
        self.totals: dict[int, tuple[float, float]] = {}
        self.asked = [0]  # nodes whose best split is wanted
        self.nodes, self.level = 1, {0: 0}

    def take(self, found: Sequence[tuple[float, float, tuple | None]]) -> None:
        """Sum, count and best split of the nodes asked for, in their order."""
        for node, (total, n, split) in zip(self.asked, found, strict=True):
            self.totals[node], self.splits[node] = (total, n), split
        self.asked = []

    def choose(self) -> tuple[list[int], bool]:
        """Nodes split in best-first order as far as gains are known, and whether gains not yet known could change it."""
        queue, order, unknown, sure = [0], [], False, True
        while len(order) < self.settings.leaves - 1:
            sure = sure and not unknown  # the children of a node taken before could be better
            known = [n for n in queue if self.splits.get(n) is not None]
            if not known:
                break
            best = max(known, key=lambda n: (self.splits[n][0], -n))
            order.append(best)
            queue.remove(best)
            if best in self.children:
                queue += self.children[best]
            elif self.level[best] + 1 < self.settings.depth:
                unknown = True
        return order, sure

    def grow(self) -> bool:
        """Splits what could be part of the tree and asks for its children; False when the tree is done."""
        order, sure = self.choose()
        if sure:
            return False
        fresh = [n for n in order if n not in self.children and self.level[n] + 1 < self.settings.depth]
        for node in fresh:
            _, feature, at, _, _ = self.splits[node]
            left, right = self.nodes, self.nodes + 1
            self.nodes += 2
            self.level[left] = self.level[right] = self.level[node] + 1
            place = self.end.pop(node)
            self.tried.leaf.append(place)
            self.tried.feature.append(feature)
            self.tried.bin.append(at)
            self.children[node] = (left, right)
            self.end[left], self.end[right] = place, len(self.tried.leaf)
            self.asked += [left, right]
        return True

    def finished(self) -> Tree:
        """The best-first tree with its leaves' values."""
        order, _ = self.choose()
        out = Tree([], [], [], [], [])
        rate, penalty = self.settings.learning_rate, self.settings.l2
        place, sums = {0: 0}, {0: self.totals[0]}
        for k, node in enumerate(order, 1):
            gain, feature, at, left_sum, left_count = self.splits[node]
            own = place[node]
            for column, value in ((out.leaf, own), (out.feature, feature), (out.bin, at), (out.gain, gain)):
                column.append(value)
            total, n = sums[own]
            sums[own], sums[k] = (left_sum, left_count), (total - left_sum, n - left_count)
            if node in self.children:
                place[self.children[node][0]], place[self.children[node][1]] = own, k
        out.values = [rate * sums[k][0] / GRID / (sums[k][1] + penalty) if sums[k][1] else 0.0 for k in range(len(order) + 1)]
        return out


class Block:
    """What a worker process holds of a block: its columns and, per training set, the predictions so far."""

    held: OrderedDict[tuple, Block] = OrderedDict()

    def __init__(self, packed: bytes, bases: Sequence[float], max_bins: int):
        self.keys, self.y, self.mask, self.bins = pickle.loads(packed)
        self.member = [(self.mask >> np.uint64(m)) & np.uint64(1) == 1 for m in range(len(bases))]
        self.now = np.repeat(np.asarray(bases)[:, None], len(self.y), axis=1)
        self.applied, self.max_bins = 0, max_bins
        self.places: dict[int, tuple[int, int, np.ndarray]] = {}  # set: tree, its splits so far, each row's leaf
        self.drawn: tuple[int, np.ndarray] = (-1, np.zeros(0, bool))

    @classmethod
    def of(cls, name: tuple, packed: bytes, bases: Sequence[float], max_bins: int) -> Block:
        block = cls.held.pop(name, None)
        if block is None or len(block.now) != len(bases):
            block = cls(packed, bases, max_bins)
        cls.held[name] = block
        while len(cls.held) > 1 and sum(b.now.nbytes for b in cls.held.values()) > MEMO_BYTES:
            cls.held.popitem(last=False)
        return block

    def catch_up(self, upto: int, older: Sequence, recent: Sequence[Sequence[Tree]], each: int) -> None:
        """Adds the trees that the predictions lack: ``older`` are broadcasts of ``each`` rounds' trees, ``recent`` is
        what came since."""
        first_recent = upto - len(recent)
        while self.applied < upto:
            if self.applied < first_recent:
                batch, k = divmod(self.applied, each)
                trees = older[batch].value[k]
            else:
                trees = recent[self.applied - first_recent]
            for m, tree in enumerate(trees):
                if tree.leaf:
                    self.now[m] += np.asarray(tree.values)[leaf_of(self.bins, tree)]
                else:
                    self.now[m] += tree.values[0]
            self.applied += 1

    def histograms(
        self, m: int, grown: Tree, wanted: Sequence[int], tree: int, features: Sequence[int], settings: TreeSettings
    ) -> np.ndarray:
        """Sums and counts of one training set's sampled rows: wanted leaves x 2 x features x bins."""
        if self.drawn[0] != tree:
            self.drawn = tree, sampled(self.keys, tree, settings)
        slot = np.full(len(grown.leaf) + 1, -1, np.int32)
        slot[list(wanted)] = np.arange(len(wanted))
        known, done, node = self.places.get(m, (-1, 0, None))
        if known != tree:
            done, node = 0, np.zeros(len(self.y), np.int16)
        for k in range(done, len(grown.leaf)):
            node[(node == grown.leaf[k]) & (self.bins[grown.feature[k]] > grown.bin[k])] = k + 1
        self.places[m] = tree, len(grown.leaf), node
        own = slot[node]
        rows = np.flatnonzero((own >= 0) & self.member[m] & self.drawn[1])
        base = own[rows] * self.max_bins
        pull = np.rint((self.y[rows] - self.now[m][rows]) * GRID)
        size = len(wanted) * self.max_bins
        out = np.empty((len(wanted), 2, len(features), self.max_bins))
        for k, f in enumerate(features):
            cell = base + self.bins[f][rows]
            out[:, 0, k] = np.bincount(cell, pull, size).reshape(len(wanted), self.max_bins)
            out[:, 1, k] = np.bincount(cell, None, size).reshape(len(wanted), self.max_bins)
        return out


class WholeSet:
    """A training set in one task: its rows and their predictions so far."""

    def __init__(self, pieces: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], base: float, max_bins: int):
        keys, y, bins = zip(*pieces)
        self.keys, self.y, self.bins = np.concatenate(keys), np.concatenate(y), np.concatenate(bins, axis=1)
        self.now, self.max_bins = np.full(len(self.y), base), max_bins

    def grow(self, number: int, drawn: Sequence[int], settings: TreeSettings) -> Tree:
        """The next tree, whose splits then count in the predictions."""
        seen = np.flatnonzero(sampled(self.keys, number, settings))
        pull = np.rint((self.y[seen] - self.now[seen]) * GRID)
        bins = {f: self.bins[f][seen] for f in drawn}
        codes = np.empty((len(seen), len(drawn)), np.min_scalar_type(len(drawn) * self.max_bins))
        for k, f in enumerate(drawn):
            np.add(bins[f], k * self.max_bins, out=codes[:, k], casting="unsafe", dtype=np.int64)
        growing = Growing(settings)
        rows, hists = {0: np.arange(len(seen))}, {0: self.counted(codes, pull, slice(None))}
        while True:
            asked = np.array([hists[n] for n in growing.asked]).reshape(-1, 2, len(drawn), self.max_bins)
            splits = best_splits(asked[:, 0], asked[:, 1], drawn, settings)
            totals = asked[:, :, 0].sum(axis=2).tolist()
            growing.take([(*total, split) for total, split in zip(totals, splits)])
            if not growing.grow():
                break
            fresh = len(growing.asked) // 2
            for node, (left, right) in list(growing.children.items())[len(growing.children) - fresh :]:
                _, feature, at, _, _ = growing.splits[node]
                own, hist = rows.pop(node), hists.pop(node)
                high = bins[feature][own] > at
                rows[left], rows[right] = own[~high], own[high]
                few, many = (left, right) if len(rows[left]) <= len(rows[right]) else (right, left)
                hists[few] = self.counted(codes, pull, rows[few])
                hists[many] = hist - hists[few]  # whole numbers, so exact
        tree = growing.finished()
        self.now += np.asarray(tree.values)[leaf_of(self.bins, tree)]
        return tree

    def counted(self, codes: np.ndarray, pull: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        """Sums and counts of some sampled rows: 2 x features x bins."""
        features, own = codes.shape[1], pull[rows]
        out = np.zeros((2, features * self.max_bins))
        for start in range(0, len(own), CHUNK_ROWS):
            part = slice(start, start + CHUNK_ROWS)
            cells = (codes[part] if isinstance(rows, slice) else codes[rows[part]]).ravel().astype(np.intp)
            out[0] += np.bincount(cells, np.repeat(own[part], features), out.shape[1])
            out[1] += np.bincount(cells, None, out.shape[1])
        return out.reshape(2, features, self.max_bins)


def pack(rows: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], parts: int) -> DataFrame:
    """Blocks (name, packed) of ``rows``: key (long), y, mask (long) and the features; dealt out by the key."""
    names = list(features)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            columns = [table.column(c).to_numpy() for c in ("key", "y", "mask")]
            bins = np.stack([bins_of(table.column(c).to_numpy(), e) for c, e in zip(names, edges)])
            data = pickle.dumps((columns[0], columns[1], columns[2].astype(np.uint64), bins), protocol=5)
            name = f"{len(columns[0])}-{int(columns[0].astype(np.uint64).sum(dtype=np.uint64))}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], names=["name", "packed"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block()
                held = []
        if held:
            yield block()

    even = rows.select("key", "y", "mask", *names).repartition(parts, "key")
    return even.mapInArrow(packed, "name string, packed binary")


def boost(spark: SparkSession, blocks: DataFrame, n_sets: int, features: Sequence[str], edges: Sequence[Sequence[float]], settings: TreeSettings) -> list[Forest]:
    """A forest for each training set; bit m of a row's mask tells whether it belongs to set m.

    ``blocks`` is what ``pack`` makes, as a written table. A set without rows has a forest of mean 0 and no splits.
    """
    max_bins = max((len(e) for e in edges), default=0) + 1
    run = uuid.uuid4().hex
    cached = blocks.select("name", "packed").rdd.map(lambda r: (r[0], bytes(r[1]))).persist(StorageLevel.MEMORY_AND_DISK)
    def totals(row):
        _, y, mask, _ = pickle.loads(row[1])
        member = (mask[None, :] >> np.arange(n_sets, dtype=np.uint64)[:, None]) & np.uint64(1)
        return np.stack([member @ np.rint(y * GRID), member.sum(axis=1).astype(np.float64)])

    sums, counts = cached.map(totals).treeReduce(np.add)
    bases = [float(s / GRID / c) if c else 0.0 for s, c in zip(sums, counts)]
    forests = [Forest(list(features), [list(map(float, e)) for e in edges], b) for b in bases]
    parts = cached.getNumPartitions()
    whole = [m for m in range(n_sets) if _fits_a_task(int(counts[m]), settings)]
    for m, trees in _grown_whole(cached, whole, bases, counts, max_bins, len(features), settings):
        forests[m].trees = trees
    rounds = [m for m in range(n_sets) if m not in whole]
    older, recent = [], []
    for number in range(settings.trees if rounds else 0):
        drawn = np.flatnonzero(tree_features(len(features), number, settings)).tolist()
        growing = [Growing(settings) for _ in range(n_sets)]
        busy = [m for m in rounds if counts[m]]
        while busy:
            asked = [(m, growing[m].tried, [growing[m].end[n] for n in growing[m].asked]) for m in busy]
            answer = _answers(run, bases, max_bins, number, list(older), list(recent), asked, drawn, settings)
            leaves = sum(len(wanted) for _, _, wanted in asked)
            tasks = min(leaves, -(-leaves * parts // TASK_HISTOGRAMS))
            added = cached.mapPartitions(answer).reduceByKey(np.add, tasks, int)
            found = dict(added.mapPartitions(_searched(drawn, settings)).collect())
            at = 0
            for m, _, wanted in asked:
                growing[m].take([found[k] for k in range(at, at + len(wanted))])
                at += len(wanted)
            busy = [m for m in busy if growing[m].grow()]
        trees = [growing[m].finished() if m in rounds and counts[m] else Tree([], [], [], [], [0.0]) for m in range(n_sets)]
        for m in rounds:
            forests[m].trees.append(trees[m])
        recent.append(trees)
        if len(recent) == RECENT_TREES:
            older.append(spark.sparkContext.broadcast(recent))
            recent = []
    cached.unpersist()
    for batch in older:
        batch.unpersist()
    return forests


def _fits_a_task(rows: int, settings: TreeSettings) -> bool:
    """Whether one task may grow a training set: by its rows, and by what a task adds up of the blocks that they fill."""
    return 0 < rows <= TASK_ROWS and -(-rows // BLOCK_ROWS) * settings.leaves <= TASK_HISTOGRAMS


def _grown_whole(cached, whole, bases, counts, max_bins, n_features, settings):
    """Number and trees of each of the ``whole`` training sets. Each is sent its rows and grown by a task of its own, the
    largest first."""
    if not whole:
        return []
    place = {m: k for k, m in enumerate(sorted(whole, key=lambda m: (-counts[m], m)))}

    def dealt(row):
        keys, y, mask, bins = pickle.loads(row[1])
        for m, k in place.items():
            own = np.flatnonzero((mask >> np.uint64(m)) & np.uint64(1))
            if len(own):
                yield k, (m, keys[own], y[own], bins[:, own])

    def grown(pieces):
        held: dict[int, list] = {}
        for _, (m, *piece) in pieces:
            held.setdefault(m, []).append(piece)
        for m in list(held):
            rows = WholeSet(held.pop(m), bases[m], max_bins)
            drawn = (np.flatnonzero(tree_features(n_features, number, settings)).tolist() for number in range(settings.trees))
            yield m, [rows.grow(number, features, settings) for number, features in enumerate(drawn)]

    return cached.flatMap(dealt).partitionBy(len(place), int).mapPartitions(grown).collect()


def _answers(run, bases, max_bins, number, older, recent, asked, drawn, settings):
    """What one round asks blocks: histograms of some leaves for some training sets, by place in the question."""
    each = RECENT_TREES

    def answer(rows):
        total = None
        for name, packed in rows:
            block = Block.of((run, name), packed, bases, max_bins)
            block.catch_up(number, older, recent, each)
            got = np.concatenate([block.histograms(m, grown, wanted, number, drawn, settings) for m, grown, wanted in asked])
            total = got if total is None else total + got
        return [] if total is None else enumerate(total)

    return answer


def _searched(drawn, settings):
    """Sum, count and best split of every leaf from its whole histogram."""

    def search(leaves):
        leaves = list(leaves)  # histograms of some leaves of one round, a bounded number
        if not leaves:
            return []
        hists = np.stack([h for _, h in leaves])
        splits = best_splits(hists[:, 0], hists[:, 1], drawn, settings)
        totals = hists[:, :, 0].sum(axis=2).tolist()
        return [(k, (*total, split)) for (k, _), total, split in zip(leaves, totals, splits)]

    return search


def with_predictions(df: DataFrame, forests: Sequence[Forest], name: str) -> DataFrame:
    """``df`` with an array of the forests' predictions; it has the features' columns, as doubles without nulls. The
    forests share one list of features and edges."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    features, edges = forests[0].features, forests[0].edges

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.stack([bins_of(batch.column(batch.schema.get_field_index(f)).to_numpy(zero_copy_only=False), e) for f, e in zip(features, edges)])
            values = np.stack([predict(bins, f) for f in forests], axis=1)
            offsets = np.arange(0, values.size + 1, len(forests), dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return df.mapInArrow(predicted, schema)


FOREST_SCHEMA = "tree int, leaf array<int>, feature array<int>, bin array<int>, gain array<double>, values array<double>"
EDGES_SCHEMA = "place int, feature string, edges array<double>, base double"


def save_forest(spark: SparkSession, forest: Forest, path: str) -> None:
    """A row per tree, and a row per feature with its bin edges."""
    trees = [(k, t.leaf, t.feature, t.bin, t.gain, t.values) for k, t in enumerate(forest.trees)]
    edges = [(k, f, e, forest.base) for k, (f, e) in enumerate(zip(forest.features, forest.edges))]
    for name, rows, schema in (("trees", trees, FOREST_SCHEMA), ("edges", edges, EDGES_SCHEMA)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def load_forest(spark: SparkSession, path: str) -> Forest:
    edges = spark.read.schema(EDGES_SCHEMA).parquet(f"{path}/edges").orderBy("place").collect()
    rows = spark.read.schema(FOREST_SCHEMA).parquet(f"{path}/trees").orderBy("tree").collect()
    trees = [Tree(*(list(r[c]) for c in ("leaf", "feature", "bin", "gain", "values"))) for r in rows]
    return Forest([r["feature"] for r in edges], [list(r["edges"]) for r in edges], edges[0]["base"], trees)
