"""Rank-synchronous counts against the sentencepiece library."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import AWKWARD, TINY

from barlake.llm.queries import op3_token_counts
from barlake.llm.token_counts import MergeTable, count_texts, count_tokens

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)


def wanted(texts):
    return [len(ids) for ids in LIBRARY.encode(list(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab e\n\t▁éthinr日🙂.,\r\x00", max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    assert count_texts(VOCABULARY, [t.encode() for t in texts]).tolist() == wanted(texts)


@pytest.mark.parametrize("unit", ["a", "aab", "the", " ", "  x", " \n", "ab▁", "é"])
def test_long_unsplit_texts(unit):
    texts = [unit * n for n in (1, 2, 15, 16, 17, 33, 700, 3000)]
    assert count_texts(VOCABULARY, [t.encode() for t in texts]).tolist() == wanted(texts)


def test_ranks_merged_one_by_one_are_known():
    table = MergeTable(VOCABULARY)
    assert table.one_by_one.any() and not table.one_by_one.all()


def test_awkward_rows(spark, awkward):
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(awkward, VOCABULARY, limit=100).collect())
    texts = [t or "" for _, t in AWKWARD]
    expected = [(i or -1, len(t.encode()), n, n > 100) for (i, _), t, n in zip(AWKWARD, texts, wanted(texts))]
    assert got == sorted(expected)


def test_empty_table(spark, awkward):
    assert count_tokens(awkward.limit(0), VOCABULARY).count() == 0


def test_query_equals_library(spark, documents):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op3_token_counts(spark, TINY).collect()}
    texts = [t or "" for _, t in documents]
    assert got == {i: (len(t.encode()), n, n > 4096) for (i, _), t, n in zip(documents, texts, wanted(texts))}
