"""Naive Bayes against a plain count, and its accuracy on held-out rows."""

import math
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
from llm.cases import TINY

from barlake.llm import language_bayes
from barlake.llm.language_bayes import SMOOTHING, LanguageModel, identify, learn, long_ngrams, ngrams
from barlake.llm.queries import op5_language_id
from barlake.llm.ragged import slices


def plain_ngrams(text):
    """Letters in lower case, any run of other characters a space."""
    folded = " " + "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text) + " "
    while "  " in folded:
        folded = folded.replace("  ", " ")
    return Counter(folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1))


def test_ngrams_are_those_of_the_text_alone():
    texts = ["Abc, déf!! 12 x", "", "...", "abc déf x", "zz"]
    found, owners, lettered = ngrams([t.encode() for t in texts], 1 << 18)
    own = [Counter(found[owners == k].tolist()) for k in range(len(texts))]
    assert [sorted(c.values()) for c in own] == [sorted(plain_ngrams(t).values()) for t in texts]
    assert own[0] == own[3] and lettered.tolist() == [True, False, False, True, True]


def test_model_is_the_plain_one(spark):
    rows = [("aab", "x"), ("abb b", "x"), ("ccd", "y"), (None, "y"), ("zzz", None), ("", "x")]
    model = learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["x", "y"]
    total = {g: sum((plain_ngrams(t or "") for t, lang in rows if lang == g), Counter()) for g in "xy"}
    texts = ["ab", "cd", "zb"]
    names, score = model.predict([t.encode() for t in texts])
    for text, name, s in zip(texts, names, score):
        logs = []
        for g, docs in (("x", 3), ("y", 2)):
            size = sum(total[g].values()) + SMOOTHING * model.buckets
            logs.append(math.log(docs / 5) + sum(n * math.log((total[g][k] + SMOOTHING) / size) for k, n in plain_ngrams(text).items()))
        assert name == "xy"[int(np.argmax(logs))]
        assert abs(s - 1 / sum(math.exp(v - max(logs)) for v in logs)) < 1e-3


def test_long_texts_in_pieces(monkeypatch):
    texts = ["Abc, déf!! 12 x日本 " * 40, "   ", "x" * 50, ". , é" * 30, "日" * 33 + "  b"]
    for piece in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(language_bayes, "PIECE_BYTES", piece)
        for text in texts:
            found, _, lettered = ngrams([text.encode()], 1 << 10)
            times, some = long_ngrams(text.encode(), 1 << 10)
            assert times.tolist() == np.bincount(found, minlength=1 << 10).tolist() and some == lettered[0]


def test_memory_follows_neither_languages_nor_length():
    rng = np.random.default_rng(1)
    many = LanguageModel([f"l{k:04d}" for k in range(4096)], rng.random((1025, 4096), np.float32))
    four = LanguageModel(list("abcd"), rng.random(((1 << 18) + 1, 4), np.float32))
    words = "".join(map(chr, rng.integers(97, 123, 500_000))).replace("e", " ").encode()
    short = [words[k : k + 5] for k in range(0, 100_000, 5)]
    language_bayes.fold_table()
    for model, texts in ((many, [words]), (many, short), (four, [words * 100])):
        tracemalloc.start()
        for i, j in slices(texts, language_bayes.SCORED_BYTES, model.most_texts()):
            model.predict(texts[i:j])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 300 << 20


def test_awkward_rows(spark, awkward):
    model = learn(awkward.selectExpr("text", "'a' lang"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(awkward, model).collect()}
    assert got[2] == got[3] == got[9] == ("und", 0.0) and got[1] == ("a", 1.0)
    assert identify(awkward, model).count() == awkward.count()


def test_nothing_learned(spark, awkward):
    model = learn(awkward.selectExpr("text", "cast(null as string) lang"))
    assert {(r.lang_pred, r.score) for r in identify(awkward, model).collect()} == {("und", 0.0)}
    assert identify(awkward.limit(0), LanguageModel([], np.zeros((1, 0), np.float32))).count() == 0


def test_many_languages_keep_the_matrix_small(spark):
    rows = [(f"text {i}", f"l{i}") for i in range(300)]
    model = learn(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 300 and model.log_probs.size <= (1 << 22) + 300


def test_held_out_accuracy(spark):
    langs = dict(duckdb.sql(f"select doc_id, lang from read_parquet('{TINY}/documents.parquet')").fetchall())
    rows = op5_language_id(spark, TINY).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
