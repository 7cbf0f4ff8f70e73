"""Ranked lexical search, a hybrid of term-at-a-time and document-at-a-time evaluation.

A first read of the documents counts what scores need of all of them: documents, terms, and the documents that hold
each term of the items. A second read indexes the documents slice by slice inside the tasks and searches every item
in every slice:

* the short lists of an item are taken term by term; their sums are written to one accumulator list;
* that list and the long lists are then evaluated together, window of documents by window of documents, each an
  iterator with a known greatest value. Iterators that together cannot reach the k-th score found so far bring
  forward no document; they are only looked up, by binary search, for documents that others brought forward and
  that the values still to come can lift to the k-th score.

The k-th score carries over from slice to slice of a task, and a slice whose greatest values don't reach it is
passed over. A task sends k rows per item; no text is shuffled. Items are a stated set of queries, taken in blocks
of bounded size, each block with its own two reads.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import byte_runs, byte_texts, runs_of, slices

#: Bytes of text indexed at once, and of a piece of one long text.
SLICE_BYTES = 8 << 20
#: Documents of a window.
WINDOW_DOCS = 1024
#: A list is short if at most one in so many documents of the slice is on it.
SHORT_ONE_IN = 32
#: Items and terms (each item's own counted) of a block; an item of more terms is a block of its own.
BLOCK_ITEMS = 2000
BLOCK_TERMS = 400_000
DF = pa.schema([("term", pa.int64()), ("docs", pa.int64())])
FOUND = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

#: Lower-cased byte of every byte, 0 for those that no term has.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[[b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)]] = 0


class Items(NamedTuple):
    """Queries of a block: their names, the distinct terms, and per item
    the terms' numbers and how often each is in it."""

    names: list
    terms: pa.Array
    lists: list[tuple[np.ndarray, np.ndarray]]


def split_terms(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts one after another, and how many each has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _BYTES[np.frombuffer(b"".join(texts), np.uint8)]
    ends = np.cumsum(sizes)
    inside = data != 0
    first, last = runs_of(inside, ends)
    return byte_runs(data, inside, first, last), np.diff(np.searchsorted(first, ends), prepend=0)


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """Parts of a long text of about ``most`` bytes, cut only at bytes that no term has."""
    start = 0
    while len(text) - start > most:
        end = start + most
        while end < len(text):  # on to the next cut, a stretch at a time
            stretch = np.flatnonzero(_BYTES[np.frombuffer(text[end : end + most], np.uint8)] == 0)
            if len(stretch):
                end += int(stretch[0])
                break
            end = min(len(text), end + most)
        yield text[start:end]
        start = end
    yield text[start:]


def _count(texts: list[bytes], terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found, sizes = split_terms(texts)
    coded = found.dictionary_encode()
    known = pc.fill_null(pc.index_in(coded.dictionary, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    number = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    some = number >= 0
    key, times = np.unique(number[some] * len(texts) + text[some], return_counts=True)
    return key // len(texts), key % len(texts), times.astype(np.int64), sizes


def count_terms(texts: list[bytes], terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the texts hold of ``terms``: number of the term, number of the text and times, by term and then text; and
    how many terms of any kind each text has. A long text, which is alone, is counted in pieces."""
    if len(texts) > 1 or len(texts[0]) <= 2 * SLICE_BYTES:
        return _count(texts, terms)
    parts = [_count([p], terms) for p in pieces(texts[0], SLICE_BYTES)]
    which, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.zeros(len(which), np.int64)
    np.add.at(times, at, np.concatenate([p[2] for p in parts]))
    return which, np.zeros(len(which), np.int64), times, sum(p[3] for p in parts)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """doc_id and texts of bounded runs of rows."""
    for batch in batches:
        texts = byte_texts(batch.column(1))
        for i, j in slices(texts, SLICE_BYTES):
            yield batch.column(0).slice(i, j - i), texts[i:j]


def _statistics(docs: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the documents that hold each term of the items."""
    n_terms = len(items.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_of = np.zeros(n_terms + 2, np.int64)
        for _, texts in _batches(batches):
            which, _, _, sizes = count_terms(texts, items.terms)
            docs_of[:n_terms] += np.bincount(which, minlength=n_terms)
            docs_of[n_terms] += (sizes > 0).sum()
            docs_of[n_terms + 1] += sizes.sum()
        some = np.flatnonzero(docs_of)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(docs_of[some])], schema=DF)

    out = np.zeros(n_terms + 2, np.int64)
    counted = docs.mapInArrow(count, from_arrow_schema(DF)).groupBy("term").agg(F.sum("docs").alias("docs"))
    for term, held in counted.collect():  # as many rows as the block has terms
        out[term] = held
    return int(out[n_terms]), int(out[n_terms + 1]), out[:n_terms]


class Best:
    """The k best documents of an item so far, ties to the smaller id, null last."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.scores, self.ids, self.unnamed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        take = scores >= self.floor
        if not take.any():
            return
        scores = np.concatenate([self.scores, scores[take]])
        ids, unnamed = np.concatenate([self.ids, ids[take]]), np.concatenate([self.unnamed, unnamed[take]])
        top = np.lexsort((ids, unnamed, -scores))[: self.k]
        self.scores, self.ids, self.unnamed = scores[top], ids[top], unnamed[top]
        if len(top) == self.k:
            self.floor = int(self.scores[-1])


class Postings(NamedTuple):
    """A slice's lists: documents and values of term t lie in [starts[t], starts[t + 1]); greatest value of each term."""

    docs: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    greatest: np.ndarray


def index_slice(texts: list[bytes], terms: pa.Array, weights: np.ndarray, n_docs: int, n_all: int) -> Postings:
    which, doc, times, sizes = count_terms(texts, terms)
    m = 100 - 75 + (75 * sizes * n_docs) // max(1, n_all)
    values = weights[which] * ((1_000_000_000 * times) // (1000 * times + 8 * m[doc]))
    starts = np.searchsorted(which, np.arange(len(weights) + 1))
    greatest = np.zeros(len(weights), np.int64)
    held = np.flatnonzero(np.diff(starts))
    if len(held):
        greatest[held] = np.maximum.reduceat(values, starts[held])
    return Postings(doc, values, starts, greatest)


def search_slice(postings: Postings, n_docs: int, terms: np.ndarray, repeats: np.ndarray, best: Best, ids: np.ndarray, unnamed: np.ndarray) -> int:
    """Adds to ``best`` what the slice's ``n_docs`` documents have for one item; returns how many documents got a
    whole score."""
    sizes = postings.starts[terms + 1] - postings.starts[terms]
    terms, repeats, sizes = terms[sizes > 0], repeats[sizes > 0], sizes[sizes > 0]
    bounds = repeats * postings.greatest[terms]
    if bounds.sum() < best.floor:
        return 0
    short = sizes * SHORT_ONE_IN <= n_docs
    lists: list[tuple[int, np.ndarray, np.ndarray]] = []
    if short.any():  # term at a time
        runs = [slice(postings.starts[t], postings.starts[t + 1]) for t in terms[short]]
        docs, at = np.unique(np.concatenate([postings.docs[r] for r in runs]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, at, np.concatenate([c * postings.values[r] for r, c in zip(runs, repeats[short])]))
        lists.append((int(sums.max()), docs, sums))
    for t, c, bound in zip(terms[~short], repeats[~short], bounds[~short]):
        run = slice(postings.starts[t], postings.starts[t + 1])
        lists.append((int(bound), postings.docs[run], c * postings.values[run] if c > 1 else postings.values[run]))
    lists.sort(key=lambda entry: -entry[0])
    upper = np.array([entry[0] for entry in lists])
    to_come = np.concatenate([np.cumsum(upper[::-1])[::-1], [0]])  # what the lists from here on can add at most
    windows = np.append(np.arange(0, n_docs, WINDOW_DOCS), n_docs)
    cuts = [np.searchsorted(docs, windows) for _, docs, _ in lists]
    scored = 0
    for w, start in enumerate(windows[:-1]):
        leading = int((to_come[:-1] >= best.floor).sum())  # the lists behind them can't reach the floor on their own
        if not leading:
            break
        window = np.zeros(windows[w + 1] - start, np.int64)
        seen = np.zeros(len(window), bool)
        for (_, docs, values), cut in zip(lists[:leading], cuts):
            place = docs[cut[w] : cut[w + 1]] - start
            window[place] += values[cut[w] : cut[w + 1]]
            seen[place] = True
        near = np.flatnonzero(seen)
        for k in range(leading, len(lists)):
            near = near[window[near] + to_come[k] >= best.floor]
            if not len(near):
                break
            docs, values = (part[cuts[k][w] : cuts[k][w + 1]] for part in lists[k][1:])
            if len(docs):
                place = np.minimum(np.searchsorted(docs, near + start), len(docs) - 1)
                held = docs[place] == near + start
                window[near[held]] += values[place[held]]
        scored += len(near)
        best.add(window[near], ids[start:][near], unnamed[start:][near])
    return scored


def _blocks(items: DataFrame) -> Iterator[Items]:
    """Items in blocks of bounded size; rows of one item_id are one item."""
    names, counts = [], []

    def block() -> Items:
        terms = list(dict.fromkeys(t for c in counts for t in c))
        number = {t: k for k, t in enumerate(terms)}
        lists = [(np.array([number[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counts]
        return Items(list(names), pa.array(terms, pa.large_binary()), lists)

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id").toLocalIterator()
    for item_id, text in rows:
        if not names or names[-1] != item_id:
            if names and (len(names) == BLOCK_ITEMS or sum(map(len, counts)) >= BLOCK_TERMS):
                yield block()
                names, counts = [], []
            names.append(item_id)
            counts.append(Counter())
        counts[-1].update(split_terms([(text or "").encode()])[0].to_pylist())
    if names:
        yield block()


def _search(docs: DataFrame, items: Items, k: int) -> DataFrame:
    n_docs, n_all, df = _statistics(docs, items)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items.names]
        for doc_ids, texts in _batches(batches):
            unnamed = doc_ids.is_null().to_numpy(zero_copy_only=False)
            ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            postings = index_slice(texts, items.terms, weights, n_docs, n_all)
            for (terms, repeats), own in zip(items.lists, best):
                search_slice(postings, len(texts), terms, repeats, own, ids, unnamed)
        for item, own in enumerate(best):
            n = len(own.ids)
            columns = [pa.array([item] * n, pa.int64()), pa.array([items.names[item]] * n, pa.int64()), pa.array(own.ids, mask=own.unnamed), pa.array(own.scores)]
            yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

    found = docs.mapInArrow(search, from_arrow_schema(FOUND))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of every item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Every row of ``docs`` is a
    document, so repeated rows are ranked as often as they come, and a text that is null or has no term counts
    nowhere. Rows of one item_id, null like any other, are one item whose terms are added up; an item without terms
    has no result. Equal scores go to the smaller doc_id, null last.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(items):
        if len(block.terms):
            found = _search(texts, block, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
