"""Hybrid search against scores by their definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import differences, duck
from llm.cases import AWKWARD, TINY

from barlake.llm import hybrid_search
from barlake.llm.hybrid_search import Best, Postings, count_terms, pieces, search, search_slice, split_terms
from barlake.llm.queries import OP12_SQL, op12_hybrid_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, n_all = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, Counter()).update(terms_of(text))
    out = []
    for item, asked in wanted.items():
        scores = []
        for (i, c), n in zip(counted, lengths):
            m = 25 + (75 * n * n_docs) // n_all if n_all else 0
            score = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 5, "s") for i, t in docs], "doc_id long, text string, score int, item_id string")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in search(d.repartition(3), q, k).collect()]
    return sorted(got, key=str)


def prose(rng, words, most):
    return " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randint(0, most)))


@pytest.mark.parametrize("slice_bytes,window,short", [(8 << 20, 1024, 32), (700, 3, 2), (2000, 7, 10**9), (2000, 7, 1)])
def test_equals_the_definition(spark, monkeypatch, slice_bytes, window, short):
    for name, value in (("SLICE_BYTES", slice_bytes), ("WINDOW_DOCS", window), ("SHORT_ONE_IN", short)):
        monkeypatch.setattr(hybrid_search, name, value)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    docs = [(i, prose(rng, words, 40)) for i in range(250)] + [(500 + i, "w5 w7 w5") for i in range(30)]
    docs += [(600, "w1 " * 3000), (601, "w40 " * 900 + "w3")]
    items = [(i, prose(rng, words, 25)) for i in range(15)] + [(99, "nothing known"), (100, None), (3, "w59 w58")]
    assert found(spark, docs, items) == plain(docs, items)


def test_awkward_rows(spark):
    items = [(1, "One two THREE"), (2, ""), (3, None), (None, "a text"), (4, "café Σας 日本語 ﬁ ½"), (5, "same same x" + "y" * 5000), (6, "12345 don t s endoftext")]
    assert found(spark, AWKWARD, items) == plain(AWKWARD, items)
    assert found(spark, AWKWARD, [(1, "same words")]) == plain(AWKWARD, [(1, "same words")])


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "...")], [(1, "a")]) == []


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(hybrid_search, "BLOCK_ITEMS", 2)
    docs = [(i, f"alpha beta{i % 3} gamma{i}") for i in range(20)]
    items = [(5, "alpha"), (1, "beta1 gamma4"), (5, "beta0"), (2, "gamma7"), (9, "beta2")]
    assert found(spark, docs, items) == plain(docs, items)


def test_terms_never_cross_texts():
    terms, sizes = split_terms([b"ab", b"cd ef", b"", b"-", "é1".encode(), b"X"])
    assert terms.to_pylist() == [b"ab", b"cd", b"ef", "é1".encode(), b"x"]
    assert sizes.tolist() == [1, 2, 0, 0, 1, 1]


def test_a_long_text_in_pieces(monkeypatch):
    text = b"alpha  beta " * 500 + b"z" * 700 + b" alpha"
    parts = list(pieces(text, 64))
    assert b"".join(parts) == text and len(parts) > 50
    assert Counter(t for p in parts for t in p.split()) == Counter(text.split())
    monkeypatch.setattr(hybrid_search, "SLICE_BYTES", 100)
    which, doc, times, sizes = count_terms([text], pa.array([b"alpha", b"zz", b"beta"], pa.large_binary()))
    assert (which.tolist(), doc.tolist(), times.tolist(), sizes.tolist()) == ([0, 2], [0, 0], [501, 500], [1002])


def test_bounds_spare_documents():
    """A rare term decides: documents that hold common terms only are never scored whole once k are found."""
    n, rng = 20_000, np.random.default_rng(1)
    rare, mid, common = np.arange(0, n, 100), np.sort(rng.choice(n, 8000, False)), np.arange(n)
    docs = np.concatenate([rare, mid, common])
    values = np.concatenate([np.full(len(rare), 1000) + rare % 7, np.full(len(mid), 30), np.full(n, 20)]).astype(np.int64)
    starts = np.cumsum([0, len(rare), len(mid), n])
    postings = Postings(docs, values, starts, np.array([1006, 30, 20]))
    best = Best(10)
    scored = search_slice(postings, n, np.arange(3), np.ones(3, np.int64), best, np.arange(n), np.zeros(n, bool))
    whole = np.bincount(docs, weights=values, minlength=n).astype(int)
    assert best.ids.tolist() == sorted(range(n), key=lambda i: (-whole[i], i))[:10]
    assert scored < n / 10
    assert search_slice(postings, n, np.array([1, 2]), np.ones(2, np.int64), best, np.arange(n), np.zeros(n, bool)) == 0


def test_query_equals_sql(spark):
    assert differences(op12_hybrid_search(spark, TINY), duck(TINY), OP12_SQL) is None
