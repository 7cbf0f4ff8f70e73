"""The distributed learner against a plain one on a single machine, and what must not change its trees."""

import heapq
import pickle
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.operators import boosting
from barlake.operators.boosting import GRID, Block, Tree, WholeSet, boost, leaf_of, bins_of, load_forest, pack, sampled, save_forest, tree_features, with_predictions
from barlake.operators.folds import Scope
from barlake.operators.trees import fit_trees, membership, tree_inputs, tree_out_of_sample
from barlake.plans.training import cross_validate, labelled_rows
from barlake.schema import MODEL_FEATURES
from barlake.settings import Settings, TreeSettings
from barlake.workspace import materialise

FEATURES = ["a", "b", "c", "d", "e"]
QUICK = TreeSettings(trees=25, leaves=12, min_rows_per_leaf=15, learning_rate=0.2, max_bins=16)


def plain_gain(q, rows, bins, settings, allowed):
    """Best split of some rows by trying each one: (gain, feature, bin), the first of equals."""
    total, n, best = q[rows].sum(), len(rows), None
    for f in range(len(bins)):
        if not allowed[f]:
            continue
        for at in range(int(bins.max())):
            low = bins[f, rows] <= at
            k = int(low.sum())
            if min(k, n - k) < settings.min_rows_per_leaf:
                continue
            s = q[rows][low].sum()
            gain = s**2 / (k + settings.l2) + (total - s) ** 2 / (n - k + settings.l2) - total**2 / (n + settings.l2)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, at)
    return best


def plain_boost(keys, y, bins, settings):
    """Best-first boosting with a heap, one split after another; (base, trees as lists of (leaf, feature, bin), predictions)."""
    base = np.rint(y * GRID).sum() / GRID / len(y)
    now, trees = np.full(len(y), base), []
    for number in range(settings.trees):
        allowed = tree_features(len(bins), number, settings)
        q = np.rint((y - now) * GRID)
        seen = sampled(keys, number, settings)
        leaf, splits = np.zeros(len(y), int), []
        heap, made, level = [], 0, [0]

        def offer(k):
            nonlocal made
            best = None if level[k] == settings.depth else plain_gain(q, np.flatnonzero((leaf == k) & seen), bins, settings, allowed)
            if best:
                heapq.heappush(heap, (-best[0], made, k, best[1], best[2]))
            made += 1

        offer(0)
        while heap and len(splits) < settings.leaves - 1:
            _, _, k, f, at = heapq.heappop(heap)
            splits.append((k, f, at))
            level[k] += 1
            level.append(level[k])
            leaf[(leaf == k) & (bins[f] > at)] = len(splits)
            offer(k)
            offer(len(splits))
        for k in range(len(splits) + 1):
            rows = (leaf == k) & seen
            if rows.any():
                now[leaf == k] += settings.learning_rate * q[rows].sum() / GRID / (rows.sum() + settings.l2)
        trees.append(splits)
    return base, trees, now


def made_rows(n=700):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 5)).round(2)
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] * (x[:, 2] > 0) + 0.3 * rng.normal(size=n)
    keys = rng.integers(-(2**62), 2**62, n)
    mask = 1 + 2 * (rng.random(n) < 0.6).astype(int) + 8 * (x[:, 3] > 0)  # the set of bit 2 is empty
    return keys, y, mask, x


@pytest.fixture(scope="module")
def made(spark):
    keys, y, mask, x = made_rows()
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, 16) / 16)).tolist() for f in range(5)]
    rows = [(int(k), float(t), int(m), *map(float, line)) for k, t, m, line in zip(keys, y, mask, x)]
    frame = spark.createDataFrame(rows, "key long, y double, mask long, a double, b double, c double, d double, e double")
    bins = np.stack([bins_of(x[:, f], edges[f]) for f in range(5)])
    return frame, edges, (keys, y, mask, bins)


def fitted(spark, frame, edges, parts, settings=QUICK, sets=4):
    return boost(spark, materialise(pack(frame, FEATURES, edges, parts), "blocks"), sets, FEATURES, edges, settings)


@pytest.mark.parametrize("depth", [99, 4, 1])
def test_trees_equal_those_of_a_plain_learner(spark, made, depth):
    frame, edges, (keys, y, mask, bins) = made
    quick = replace(QUICK, depth=depth)
    forests = fitted(spark, frame, edges, 5, quick)
    for m, forest in enumerate(forests):
        own = (mask >> m) & 1 == 1
        if not own.any():
            assert forest.base == 0 and all(t.leaf == [] for t in forest.trees)
            continue
        base, trees, now = plain_boost(keys[own], y[own], bins[:, own], quick)
        assert forest.base == base
        assert [list(zip(t.leaf, t.feature, t.bin)) for t in forest.trees] == trees
        assert np.allclose(boosting.predict(bins[:, own], forest), now, atol=1e-12)
        if depth == 99:
            assert max(len(t.leaf) for t in forest.trees) == 11
            assert forest.gains()["a"] == max(forest.gains().values())
        assert sum(forest.gains().values()) == pytest.approx(1)


def test_partitions_and_blocks_change_nothing(spark, made, monkeypatch):
    frame, edges, _ = made
    quick = replace(QUICK, trees=12)
    whole = fitted(spark, frame, edges, 3, quick)
    monkeypatch.setattr(boosting, "RECENT_TREES", 3)
    assert fitted(spark, frame.repartition(7), edges, 1, quick) == whole


def test_the_driver_gets_splits_and_no_histograms(spark, made, monkeypatch):
    """Bytes per leaf that come to the driver: a histogram of 5 features and 16 bins would have 1280."""
    frame, edges, _ = made
    quick = replace(QUICK, trees=4)
    whole, taken, take = fitted(spark, frame, edges, 3, quick), [], boosting.Growing.take

    def spy(self, *found):
        taken.append(len(pickle.dumps(found)) / len(self.asked))
        take(self, *found)

    monkeypatch.setattr(boosting.Growing, "take", spy)
    monkeypatch.setattr(boosting, "TASK_HISTOGRAMS", 2)  # many tasks search for splits
    assert fitted(spark, frame, edges, 3, quick) == whole
    assert taken and max(taken) < 300


def test_sets_that_fit_a_task_take_no_rounds(spark, made):
    """A round is a job; these trees took some 200 of them."""
    frame, edges, _ = made
    blocks = materialise(pack(frame, FEATURES, edges, 3), "blocks")
    context = spark.sparkContext
    context.setLocalProperty("spark.jobGroup.id", "whole-sets")
    forests = boost(spark, blocks, 4, FEATURES, edges, QUICK)
    context.setLocalProperty("spark.jobGroup.id", None)
    assert [len(f.trees) for f in forests] == [25] * 4
    assert len(context.statusTracker().getJobIdsForGroup("whole-sets")) <= 5


@pytest.mark.parametrize("most", [0, 400])
def test_rounds_and_tasks_give_the_same_trees(spark, made, monkeypatch, most):
    """Sets beyond the bound of a task: all of them, or all but one."""
    frame, edges, _ = made
    quick = replace(QUICK, trees=5)
    whole, rounds, take = fitted(spark, frame, edges, 3, quick), [], boosting.Growing.take
    monkeypatch.setattr(boosting.Growing, "take", lambda self, found: (rounds.append(self), take(self, found)))
    monkeypatch.setattr(boosting, "TASK_ROWS", most)
    assert fitted(spark, frame, edges, 3, quick) == whole
    assert len(set(map(id, rounds))) == (15 if most == 0 else 10)


def test_pieces_and_chunks_of_a_set_change_nothing(spark, made, monkeypatch):
    frame, edges, (keys, y, mask, bins) = made
    quick = replace(QUICK, trees=5)
    forest = fitted(spark, frame, edges, 3, quick)[0]
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 32)
    pieces = [(keys[at], y[at], bins[:, at]) for at in (slice(0, 300), slice(300, 301), slice(301, None))]
    rows = WholeSet(pieces, forest.base, 16)
    drawn = [np.flatnonzero(tree_features(5, k, quick)).tolist() for k in range(5)]
    assert [rows.grow(k, drawn[k], quick) for k in range(5)] == forest.trees
    assert np.allclose(rows.now, boosting.predict(bins, forest), atol=1e-12)


def test_leaves_of_a_tree_of_many():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 64, (3, 2000)).astype(np.uint8)
    splits = [(int(rng.integers(0, k)), int(rng.integers(0, 3)), int(rng.integers(0, 63))) for k in range(1, 300)]
    for tree in (Tree(*map(list, zip(*splits[:n])), [], []) for n in (1, 127, 128, 299)):
        want = np.zeros(2000, int)
        for k, (leaf, feature, at) in enumerate(zip(tree.leaf, tree.feature, tree.bin), 1):
            want[(want == leaf) & (bins[feature] > at)] = k
        assert (leaf_of(bins, tree) == want).all()


def test_catching_up_from_broadcast_trees(spark, made):
    frame, edges, (keys, y, mask, bins) = made
    forests = fitted(spark, frame, edges, 2, replace(QUICK, trees=11))
    packed = pickle.dumps((keys, y, mask.astype(np.uint64), bins))
    block = Block(packed, [f.base for f in forests], 16)
    per_tree = [[f.trees[k] for f in forests] for k in range(11)]
    older = [spark.sparkContext.broadcast(per_tree[:8])]
    block.catch_up(11, older, per_tree[8:], 8)
    for m, forest in enumerate(forests):
        assert np.allclose(block.now[m], boosting.predict(bins, forest), atol=1e-12)


def test_a_forest_comes_back_from_its_table(spark, made, tmp_path):
    frame, edges, (_, _, _, bins) = made
    forest = fitted(spark, frame, edges, 2, replace(QUICK, trees=4))[0]
    save_forest(spark, forest, str(tmp_path / "f"))
    assert load_forest(spark, str(tmp_path / "f")) == forest
    scored = with_predictions(frame.withColumn("extra", F.lit("x")), [forest, forest], "p").collect()
    order = {int(k): p for k, p in zip(made[2][0], boosting.predict(bins, forest))}
    assert all(r.p == [order[r.key]] * 2 and r.extra == "x" for r in scored)


def test_no_split_is_possible(spark):
    rows = [(k, float(k % 3), 1, 1.0, 1.0, 1.0, 1.0, 1.0) for k in range(40)]
    frame = spark.createDataFrame(rows, "key long, y double, mask long, a double, b double, c double, d double, e double")
    (forest,) = fitted(spark, frame, [[1.0]] * 5, 2, replace(QUICK, trees=2), sets=1)
    assert all(t.leaf == [] and len(t.values) == 1 for t in forest.trees)


def test_probes_and_folds_are_those_of_separate_training(spark, history):
    """One run for all training sets gives what a run for each gives."""
    labelled = materialise(labelled_rows(history["features"]), "labelled")
    quick = Settings(n_splits=2, test_days=126, candidates=("naive", "trees"), trees=TreeSettings(trees=6, leaves=8))
    validation = cross_validate(labelled, quick)
    inputs = materialise(tree_inputs(labelled), "inputs")
    for k, scope in enumerate(validation.scopes):
        (alone,) = fit_trees(inputs, [scope], quick.trees)
        assert alone == validation.trees[k]
    rows = tree_out_of_sample(inputs, validation.folds, validation.trees)
    assert rows.count() == validation.out_of_sample.where("model = 'trees'").count() == 2 * 126 * 4
    first = validation.scopes[0]
    marked = inputs.select("date", "ticker", membership(validation.scopes).alias("m"))
    assert marked.where("m & 2 > 0").count() == first.rows and marked.where("m & 1 > 0").count() == first.fit_rows
    assert isinstance(first, Scope) and validation.trees[0].forest.features == MODEL_FEATURES


def test_out_of_sample_predictions_are_those_of_a_plain_training(spark, history):
    """Bins, probe, level correction, final fit and test block of a fold, each made again on a single machine."""
    labelled = materialise(labelled_rows(history["features"]), "labelled")
    tiny = Settings(n_splits=2, test_days=126, candidates=("naive", "trees"), trees=TreeSettings(trees=3, leaves=6, max_bins=12))
    validation = cross_validate(labelled, tiny)
    scope, fold = validation.scopes[1], validation.folds[1]
    pdf = tree_inputs(labelled).withColumn("key", F.xxhash64("ticker", "date")).toPandas()
    edges = [np.unique(np.quantile(pdf[f], np.arange(1, 12) / 12)) for f in MODEL_FEATURES]
    assert all(np.allclose(a, b) for a, b in zip(edges, validation.trees[1].forest.edges))
    bins = np.stack([bins_of(pdf[f].to_numpy(), e) for f, e in zip(MODEL_FEATURES, validation.trees[1].forest.edges)])
    inside = (pdf["date"] < scope.end).to_numpy()
    fitted_rows = inside & ((pdf["date"] < scope.cut_date) | ((pdf["date"] == scope.cut_date) & (pdf["ticker"] <= (scope.cut_ticker or "")))).to_numpy()
    y, keys = pdf["y"].to_numpy(), pdf["key"].to_numpy()

    def trained_on(rows):
        base, trees, now = plain_boost(keys[rows], y[rows], bins[:, rows], tiny.trees)
        forest = boosting.Forest(MODEL_FEATURES, [], base)
        own = bins[:, rows]
        left = np.full(rows.sum(), base)
        for number, splits in enumerate(trees):
            tree = boosting.Tree([s[0] for s in splits], [s[1] for s in splits], [s[2] for s in splits], [], [])
            leaf, seen = boosting.leaf_of(own, tree), sampled(keys[rows], number, tiny.trees)
            pull = np.rint((y[rows] - left) * GRID)
            tree.values = [
                tiny.trees.learning_rate * pull[(leaf == k) & seen].sum() / GRID / (((leaf == k) & seen).sum() + tiny.trees.l2)
                for k in range(len(splits) + 1)
            ]
            left += np.array(tree.values)[leaf]
            forest.trees.append(tree)
        assert np.allclose(left, now)
        return forest

    probe, final = trained_on(fitted_rows), trained_on(inside)
    tail = inside & ~fitted_rows
    smear = 0.5 * np.log(np.mean(np.exp(2 * (y[tail] - boosting.predict(bins[:, tail], probe)))))
    tested = ((pdf["date"] >= fold.test_start) & (pdf["date"] <= fold.test_end)).to_numpy()
    wanted = dict(zip(zip(pdf["ticker"][tested], pdf["date"][tested]), boosting.predict(bins[:, tested], final) + smear))
    rows = validation.out_of_sample.where(f"model = 'trees' and fold = {fold.number}").collect()
    assert len(rows) == len(wanted) == 126 * 4
    assert all(abs(r["y_pred_log"] - wanted[r["ticker"], r["date"]]) < 1e-9 for r in rows)
