"""Subword embeddings: collapsed scores against the plain average, and accuracy on held-out rows."""

import zlib

import duckdb
import numpy as np
from llm.cases import AWKWARD

from barlake.llm import quality_embeddings as quality
from barlake.llm.queries import op7_quality
from barlake.llm.quality_embeddings import BLANKS, BUCKETS, QualityModel, fit, keep_good, score, text_features, word_features
from barlake.llm.ragged import PieceTable


def some_model():
    rng = np.random.default_rng(2)
    return QualityModel(np.array([0.1, 0.3], np.float32), rng.normal(size=(BUCKETS, 2)).astype(np.float32) * 20)


def test_words_keep_their_features_in_any_batch():
    words = [b"a", "né".encode(), b"longer-word", b"x" * 3000]
    hashes, counts = word_features(words)
    for word, found, count in zip(words, np.split(hashes, np.cumsum(counts)[:-1]), counts):
        assert (word_features([word])[0] == found).all()
        size = len(word) + 2
        assert count == 1 + sum(max(0, size - n + 1) for n in quality.NGRAMS)


def test_scores_are_those_of_averaged_vectors():
    model = some_model()
    texts = [t.encode() for t in ("", "one", "one two one", "two two two ###", "é " * 50, "a b c d e f")]
    got = model.probabilities(texts)
    table = PieceTable(word_features, np.uint32)
    for text, row in zip(texts, got):
        buckets, shares = text_features(table, text)
        logits = model.bias + shares @ model.weights[buckets]
        expected = np.exp(logits - logits.max())
        assert np.allclose(row, expected / expected.sum(), atol=1e-4)
    assert np.allclose(model.probabilities(texts[::-1])[::-1], got, atol=1e-9)


def test_a_word_after_itself_is_one_feature():
    pairs, counts = quality.pair_features(np.array([5, 5, 9, 9, 3], np.uint32), np.array([5]))
    assert counts.tolist() == [4] and pairs[0] == pairs[2] and pairs[1] != pairs[0]
    assert BLANKS > 0


def test_training_separates_and_repeats():
    texts = [f"plain words number {k} here".encode() for k in range(60)] + [f"plain### words$$$ {k}%%% here".encode() for k in range(60)]
    labels = np.array([1] * 60 + [0] * 60)
    bias, weights = quality.train(texts, labels)
    again = quality.train(texts, labels)
    assert (bias == again[0]).all() and (weights == again[1]).all()
    found = QualityModel(bias, weights).probabilities([b"plain words number 99 here", b"plain### words$$$ 99%%% here"])[:, 1]
    assert found[0] > 0.8 and found[1] < 0.2


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_labels_that_teach_nothing(spark, awkward):
    for rows, share in (([], 0.5), ([(1, 1, 0), (5, 1, 0), (5, 1, 1), (None, 0, 0), (6, None, 0), (7, 3, 0), (99, 0, 0)], 1.0)):
        model = fit(awkward, labels_of(spark, rows))
        got = score(awkward, model).collect()
        assert len(got) == len(AWKWARD) and all(abs(r.score - share) < 1e-5 and r.predicted == 1 for r in got)


def test_awkward_rows_and_repeated_labels(spark, awkward):
    rows = [(i, i % 2, 0) for i in (1, 1, 4, 4, 5, 6, 7, 8, 9, 2, 3)] + [(4, 1, 0)]
    model = fit(awkward, labels_of(spark, rows))
    first = sorted((r.doc_id or 0, r.score, r.predicted) for r in score(awkward, model).collect())
    second = sorted((r.doc_id or 0, r.score, r.predicted) for r in score(awkward, fit(awkward, labels_of(spark, rows))).collect())
    assert first == second and all(0 <= s <= 1 and p == (s >= 0.5) for _, s, p in first)
    kept = keep_good(awkward, model)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [i for i, _, p in first if p]


def test_sample_is_bounded(spark, awkward):
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(1, 13)])
    model = fit(awkward, labels, rows=3)
    assert model.weights.shape == (BUCKETS, 2)


def test_empty_table(spark, awkward):
    model = fit(awkward.limit(0), labels_of(spark, [(1, 1, 0)]))
    assert score(awkward.limit(0), model).count() == 0 and keep_good(awkward.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    marks = dict(duckdb.sql(f"select doc_id, quality from read_parquet('{sf_dir}/labels.parquet')").fetchall())
    rows = op7_quality(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    assert np.mean([p == m for p, m in held]) > 0.95
    good = [p for p, m in held if m]
    assert np.mean(good) > 0.98
