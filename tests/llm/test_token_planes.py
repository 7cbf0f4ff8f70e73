"""Byte-plane files against the tokenizers library on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import AWKWARD, TINY
from tokenizers import Tokenizer

from barlake.llm import token_planes
from barlake.llm.queries import op2_token_planes
from barlake.llm.token_planes import document_index, encode_texts, pack, read_tokens, stretches, unpack, write_tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def encoded(texts, end_id=None):
    """Ids of every text by the runs of encode_texts."""
    runs = list(encode_texts(VOCABULARY, pa.array(texts, pa.string()), end_id))
    ids, over = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, int) for k in range(2))
    return [part.tolist() for part in np.split(ids, over)[:-1]]


#: Letters, marks, digits and what combines with them, white space of several kinds, contractions, special tokens.
TRICKY = "aBz 1'-.,!<|>=\n\t\r\x0b\x0c\x00\x1c\x85\xa0\u0338\u0301\u20e3\u200déßẞİıſ½²٣日ǅΣς🙂\u3000\ufb01s'tllre"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=TRICKY, max_size=60), st.text(max_size=20)), max_size=5))
def test_any_text_equals_the_library(texts):
    assert encoded(texts) == library(texts)


def test_stretches_and_special_tokens_between_texts(monkeypatch):
    texts = ["", "a b", None, "<|endoftext|>", "it's 12,5 words." * 9, "", "x" * 90, "<|STARTOFTEXT|> a<|b", "tail", None]
    whole = encoded(texts, 1)
    assert whole == [ids + [1] for ids in library(texts)]
    for most in (1, 5, 16, 64):
        monkeypatch.setattr(token_planes, "STRETCH_BYTES", most)
        assert encoded(texts, 1) == whole
    data = np.frombuffer(b"one two" + b"x" * 40 + b" three", np.uint8)
    cuts = list(stretches(data, np.array([0, 7, 47, 53, 53]), 4))
    assert [c[0] for c in cuts[1:]] == [c[1] for c in cuts[:-1]] and cuts[-1][1] == 53
    assert [c[2:] for c in cuts if c[2] < c[3]][-1] == (3, 5)


def test_one_id_over_many_parts_lies_in_the_order_of_its_hashes(spark, tmp_path):
    rows = [(7, f"text number {k} " * (k % 5)) for k in range(900)] + [(k, "other") for k in range(14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    starts = []
    for run in range(2):
        folder = write_tokens(docs.repartition(3 + run), str(tmp_path / f"w{run}"), VOCABULARY, partitions=8)
        found = document_index(spark, folder).collect()
        assert len({r.part for r in found if r.doc_id == 7}) > 3
        starts.append(sorted((r.doc_id, r.start, r.n_tokens) for r in found))
    assert starts[0] == starts[1]
    ends = [start + n for _, start, n in starts[0]]
    assert [start for _, start, _ in starts[0]] == [0, *ends[:-1]]


@pytest.mark.parametrize("count", [1, 7, token_planes.BLOCK_IDS])
def test_blocks_come_back(count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)
    assert (unpack(pack(ids), count) == ids).all()


def test_high_planes_of_small_ids_shrink():
    sizes = [len(p) for p in pack(np.arange(token_planes.BLOCK_IDS, dtype=np.uint32) % 49_000)]
    assert sizes[2] < 100 and sizes[3] < 100


def test_awkward_texts(spark, awkward, tmp_path):
    folder = write_tokens(awkward, str(tmp_path / "w"), VOCABULARY, partitions=3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.start, bytes(r.ids)) for r in read_tokens(spark, folder).collect())
    rows = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for (_, doc_id, start, ids), (wanted, _), expected in zip(got, rows, library([t for _, t in rows]), strict=True):
        assert (doc_id, start) == (wanted or 0, at)
        assert np.frombuffer(ids, "<u4").tolist() == expected + [1]
        at += len(expected) + 1


def test_documents_over_several_blocks(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * n) for i, n in enumerate([5, 70_000, 0, 140_000, 3])], "doc_id long, text string")
    folder = write_tokens(docs, str(tmp_path / "w"), VOCABULARY, partitions=2)
    assert [r.n_tokens for r in document_index(spark, folder).orderBy("doc_id").collect()] == [6, 70_001, 1, 140_001, 4]
    word = library(["word"])[0][0]
    for r in read_tokens(spark, folder).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert ids[-1] == 1 and (ids[:-1] == word).all()


def test_empty_table(spark, awkward, tmp_path):
    folder = write_tokens(awkward.limit(0), str(tmp_path / "w"), VOCABULARY)
    assert read_tokens(spark, folder).count() == 0


def test_damage_is_noticed(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words to write")], "doc_id long, text string")
    folder = write_tokens(docs, str(tmp_path / "w"), VOCABULARY, partitions=1)
    part = next((tmp_path / "w" / "files").iterdir())
    raw = bytearray(part.read_bytes())
    raw[-1] ^= 1
    part.write_bytes(bytes(raw))
    with pytest.raises(Exception, match="not a whole file"):
        read_tokens(spark, folder).collect()


def test_query_equals_library(spark, documents):
    got = {r.doc_id: r for r in op2_token_planes(spark, TINY).collect()}
    assert len(got) == len(documents)
    at = 0
    rows = sorted(documents)
    for (doc_id, _), expected in zip(rows, library([t for _, t in rows])):
        ids = np.array(expected + [1], "<u4")
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
