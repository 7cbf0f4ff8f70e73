"""Tree concatenation and decoding against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import AWKWARD, TINY

from barlake.llm import bpe_tree
from barlake.llm.bpe_tree import decode_documents, encode_documents, halves, loaded
from barlake.llm.queries import op4_bpe_tree

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    found = loaded(VOCABULARY).library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab e\n\t's日é🙂.,1　\xa0\x1c\x85|<>", max_size=80))
def test_chunks_give_the_texts_ids(text):
    assert loaded(VOCABULARY).encode([text.encode()])[0].tolist() == library([text])[0]


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(["ab", "theinr", "é日🙂", "!?#$", "0189", " ", "ana"]), st.integers(1, 10**9), st.integers(2, 1500))
def test_joined_halves_are_the_runs_encoding(alphabet, seed, length):
    run = "".join(np.random.default_rng(seed).choice(list(alphabet), length))
    bpe = loaded(VOCABULARY)
    parts = [np.asarray(ids, np.uint32) for ids in bpe.whole(halves(run.encode(), 32))]
    assert bpe.join_all(parts).tolist() == library([run])[0]


def test_windows_grow(monkeypatch):
    monkeypatch.setattr(bpe_tree, "WINDOW", 1)
    run = "the" * 400 + "a" * 333 + "ing" * 200
    bpe = loaded(VOCABULARY)
    parts = [np.asarray(ids, np.uint32) for ids in bpe.whole(halves(run.encode(), 16))]
    assert bpe.join_all(parts).tolist() == library([run])[0]


def test_halves_cut_at_characters():
    run = "日本é" * 3000
    parts = halves(run.encode(), 100)
    assert b"".join(parts) == run.encode() and all(p.decode() for p in parts) and max(map(len, parts)) <= 100


@pytest.mark.parametrize("most", [64, bpe_tree.LEAF_BYTES])
def test_awkward_rows(spark, awkward, monkeypatch, most):
    monkeypatch.setattr(bpe_tree, "LEAF_BYTES", most)  # the tasks keep the module's own leaf size for halving
    rows = decode_documents(encode_documents(awkward, VOCABULARY), VOCABULARY).collect()
    got = sorted((r.doc_id or -1, r.n_tokens, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.decoded) for r in rows)
    expected = sorted((i or -1, len(ids), ids, t or "") for (i, t), ids in zip(AWKWARD, library([t for _, t in AWKWARD])))
    assert got == expected


def test_repeated_long_rows(spark):
    text = "q" * 20_000 + " end " + "7" * 9000
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    rows = encode_documents(docs, VOCABULARY).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 1, 2]
    assert all(np.frombuffer(bytes(r.ids), "<u4").tolist() == library([text])[0] for r in rows)


def test_broken_ids_decode_like_the_library(spark):
    bpe = loaded(VOCABULARY)
    ids = [np.array(library(["é日🙂"])[0][:-1], "<u4"), np.array([50256, 1, 60_000, 2], "<u4"), np.zeros(0, "<u4")]
    rows = [(k, len(i), bytearray(i.tobytes())) for k, i in enumerate(ids)]
    frame = spark.createDataFrame([*rows, (9, 0, None)], "doc_id long, n_tokens long, ids binary")
    got = {r.doc_id: r.decoded for r in decode_documents(frame, VOCABULARY).collect()}
    assert got == {k: bpe.library.decode(i.tolist(), skip_special_tokens=False) for k, i in enumerate(ids)} | {9: ""}


def test_empty_table(spark, awkward):
    assert encode_documents(awkward.limit(0), VOCABULARY).count() == 0


def test_query_equals_library(spark, documents):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op4_bpe_tree(spark, TINY).collect()}
    expected = {}
    for (i, text), ids in zip(documents, library([t for _, t in documents])):
        decoded = loaded(VOCABULARY).library.decode(ids, skip_special_tokens=False).encode()
        expected[i] = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()
    assert got == expected
