"""The n-gram Jaccard join against all pairs, on generated groups of copies and on the smallest table."""

import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from llm.cases import AWKWARD, TINY

from barlake.llm import ngram_join
from barlake.llm.ngram_join import (
    components,
    join_documents,
    least_similarity,
    linked_pairs,
    one_of_each,
    prefix_length,
    prefix_lengths,
    shared_counts,
    tie_runs,
)
from barlake.llm.queries import op1_ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(texts):
    found = []
    for text in texts:
        words = WORD.findall(text or "")
        found.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return found


def brute(rows, threshold=Fraction(4, 5)):
    """class_id, n_copies and n_links by comparing all pairs; ids are all different."""
    ids, texts = [i for i, _ in rows], [t for _, t in rows]
    sets = sets_of(texts)
    label, links = dict(zip(ids, ids)), dict.fromkeys(ids, 0)
    edges = []
    for a in range(len(ids)):
        for b in range(a):
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if shared >= threshold * (len(sets[a]) + len(sets[b]) - shared):
                    edges.append((ids[a], ids[b]))
                    links[ids[a]] += 1
                    links[ids[b]] += 1
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    copies = {i: texts.count(t) if s else 1 for (i, t), s in zip(rows, sets)}
    return {i: (label[i], copies[i], links[i]) for i in ids}


def collected(frame):
    return {r.doc_id: (r.class_id, r.n_copies, r.n_links) for r in frame.collect()}


def near_copies(seed, groups=12, most=30):
    """Texts of 5 to 300 words, each with copies in which some words differ, from none to a third."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choice(words, rng.integers(5, 300)).tolist()
        for _ in range(rng.integers(1, most)):
            copy = list(base)
            for at in rng.choice(len(copy), int(len(copy) * rng.choice([0, 0, 0.01, 0.02, 0.03, 0.05, 0.3])), replace=False):
                copy[at] = str(rng.choice(words))
            rows.append((len(rows) + 1, " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = near_copies(seed)
    assert collected(join_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_blocks_of_a_large_group(spark, monkeypatch):
    """The same result where groups are cut into many blocks."""
    rows = near_copies(7, groups=4, most=40)
    monkeypatch.setattr(ngram_join, "UNIT_SHINGLES", 2000)
    assert collected(join_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_awkward_rows(spark, awkward):
    rows = join_documents(awkward).collect()
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.class_id, r.n_copies, r.n_links) for r in rows), key=str)
    expected = [(i is None, i or 0, i, 2 if i == 4 else 1, 1 if i == 4 else 0) for i, _ in AWKWARD]
    assert got == sorted(expected, key=str)
    kept = one_of_each(awkward).collect()
    assert sorted((r.doc_id or 0) for r in kept) == sorted({i or 0 for i, _ in AWKWARD})
    assert kept[0].asDict().keys() == awkward.first().asDict().keys()


def test_empty_table(spark, awkward):
    assert join_documents(awkward.limit(0)).count() == 0
    assert one_of_each(awkward.limit(0)).count() == 0


def test_prefixes_shorten_until_the_recall():
    length = prefix_length(0.8, 32, 10, 0.999)
    assert 1 - (1 - 0.8**length) ** 32 >= 0.999 > 1 - (1 - 0.8 ** (length + 1)) ** 32
    assert prefix_length(0.99, 32, 10, 0.999) == 10


@pytest.mark.parametrize("threshold", [Fraction(4, 5), Fraction(1, 2), Fraction(9, 10), Fraction(2, 3)])
def test_least_similarity_of_a_set(threshold):
    for size in range(1, 30):
        every = {Fraction(i, u) for i in range(1, size + 1) for u in range(size, 4 * size + 1)}
        assert least_similarity(size, threshold) == min(s for s in every if s >= threshold)


def test_small_sets_keep_longer_prefixes():
    lengths = prefix_lengths(0.8, 0.999)
    assert set(lengths[1:4]) == {10}  # no set has a similarity between 0.8 and 1 to one of up to 3
    assert lengths[4] == lengths[5] == lengths[-1] == 7 and lengths[7] > 7
    hashes = np.array([5, 5, 5, 6, 7, 8, 8], np.uint64)
    assert ngram_join.set_sizes(hashes, np.array([3, 0, 4]), 4).tolist() == [1, 0, 4]


@pytest.mark.parametrize("seed", range(6))
def test_ties_join_all_that_meet(seed):
    """Ties of a sorted forest, cut into ranges and batches anywhere, reach between all pairs that share the longer
    of their prefixes in some tree, and only over such pairs."""
    rng = np.random.default_rng(seed)
    n, trees, depth, shortest = 60, 3, 5, 2
    codes, lengths = rng.integers(0, 2, (n, trees, depth)).astype(np.uint8), rng.integers(shortest, depth + 1, n)
    rows = sorted((t, codes[i, t].tobytes(), i, int(lengths[i])) for t in range(trees) for i in range(n))
    ties, ends = [], {}
    for part in np.array_split(np.arange(len(rows)), sorted(rng.integers(0, len(rows), 4))):
        cuts = [rows[a] for a in part]
        batches = [cuts[k : k + 7] for k in range(0, len(cuts), 7)]
        batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*b)], names=["tree", "branch", "node", "length"]) for b in batches)
        for batch in tie_runs(batches, shortest, depth):
            for u, v, run in zip(*(c.to_pylist() for c in batch.columns)):
                ties.append((u, v)) if run is None else ends.setdefault(run, set()).add(u)
    for nodes in ends.values():
        ties += [(u, min(nodes)) for u in nodes]
    meets = {(a, b) for a in range(n) for b in range(n) for t in range(trees) if (codes[a, t, : max(lengths[a], lengths[b])] == codes[b, t, : max(lengths[a], lengths[b])]).all()}
    names = np.arange(n)
    label = ngram_join.least_of(n, *np.array(ties).T, names)
    assert (label == ngram_join.least_of(n, *np.array(sorted(meets)).T, names)).all()
    assert set(ties) <= meets


def test_shared_counts_are_exact(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in rng.integers(1, 60, 40)]
    for few in (2, 5, 24, 100):
        monkeypatch.setattr(ngram_join, "FEW", few)
        got = shared_counts(sets)
        assert all(got[a, b] == len(np.intersect1d(sets[a], sets[b])) for a in range(40) for b in range(a + 1, 40))
    left, right = linked_pairs(sets, Fraction(1, 3))
    union = lambda a, b: len(np.union1d(sets[a], sets[b]))
    assert set(zip(left, right)) == {(a, b) for a in range(40) for b in range(a + 1, 40) if 3 * got[a, b] >= union(a, b)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {k: 100 for k in range(101, 160)}


def test_query_equals_all_pairs(spark, documents):
    assert collected(op1_ngram_join(spark, TINY)) == brute(documents)


def test_texts_of_one_id_and_rows_without_one(spark):
    """Ids are names of rows only: unrelated texts of one id stay apart, rows without an id have copies as well."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(5, a), (5, b), (7, b + " more"), (None, c), (None, c), (None, c + " more"), (9, d), (None, d), (8, d + " more"), (None, " "), (None, " ")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    got = sorted(((r.doc_id, r.class_id, r.n_copies, r.n_links) for r in join_documents(docs).collect()), key=str)
    assert got == sorted(
        [(5, 5, 1, 0), (5, 5, 1, 1), (7, 5, 1, 1), (None, None, 2, 2), (None, None, 2, 2), (None, None, 1, 2)]
        + [(9, 8, 2, 2), (None, 8, 2, 2), (8, 8, 1, 2), (None, None, 1, 0), (None, None, 1, 0)],
        key=str,
    )
    kept = sorted(r.n for r in one_of_each(docs).collect())
    assert kept in ([0, 1, 3, 8, 9, 10], [0, 1, 5, 8, 9, 10])  # of the class without ids, the row of either text


def test_columns_of_any_name_keep_their_values(spark):
    rows = [(1, "one two three four five six seven", "mine1", 5), (2, "one two three four five six seven", "mine2", 6), (3, "x", "mine3", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text_key string, node int")
    got = one_of_each(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == {rows[0], rows[2]}
