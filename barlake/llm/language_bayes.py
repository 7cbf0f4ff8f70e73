"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts n-grams per language where the texts lie; what is shuffled is one number per task, language and
bucket. The log-probability matrix is bounded by ``MATRIX_CELLS`` whatever the corpus holds, is broadcast, and
texts are scored in batches: the n-grams of a slice are entries (text, bucket) of a sparse matrix, whose product with
the log-probabilities is added up a bounded number of cells at a time. A long text is read in pieces that share their
last characters and counted by bucket first, so memory follows neither its length nor the number of languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import byte_texts, slices, starts_of

#: N-gram lengths.
LENGTHS = (1, 2, 3)
#: Most buckets, and most cells of the log-probability matrix (buckets times languages).
MOST_BUCKETS = 1 << 18
MATRIX_CELLS = 1 << 22
#: Most languages: beyond it a label column doesn't hold languages.
MOST_LANGUAGES = 4096
#: Additive smoothing of the counts.
SMOOTHING = 0.1
#: Cells that a counting task holds before it passes them on.
HELD_CELLS = 1 << 23
#: Cells of scores, or of rows of the matrix, that scoring holds at once.
SCORED_CELLS = 1 << 21
#: Bytes of a slice of texts that are scored together, and of a piece of a long text.
SCORED_BYTES = 1 << 19
PIECE_BYTES = 1 << 20
COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
UNDETERMINED = "und"

_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Lower case of every letter; a space for every other character."""
    if not _fold:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _fold.append(table)
    return _fold[0]


def ngrams(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the number of the text each belongs to, and the texts that hold a letter.

    Only letters count: any run of other characters is one space, and a text has a space on both sides.
    """
    points = [np.frombuffer(t.decode().encode("utf-32-le"), "<u4") for t in texts]
    sizes = np.fromiter((len(p) + 2 for p in points), np.int64, len(points))
    text = np.repeat(np.arange(len(points), dtype=np.int32), sizes)
    chars = np.full(len(text), 32, np.uint32)
    starts = starts_of(sizes)
    inner = np.ones(len(text), bool)
    inner[starts] = inner[starts + sizes - 1] = False
    if inner.any():
        chars[inner] = fold_table()[np.concatenate(points)]
    keep = np.ones(len(text), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (text[1:] != text[:-1])
    chars, text = chars[keep], text[keep]
    lettered = np.zeros(len(texts), bool)
    lettered[text[chars != 32]] = True
    found, owners = [], []
    for n, mixed in enumerate(_mixed(chars), 1):
        if n in LENGTHS:
            whole = text[: len(mixed)] == text[n - 1 :]
            found.append(_bucket(mixed[whole], buckets))
            owners.append(text[: len(mixed)][whole])
    return np.concatenate(found), np.concatenate(owners), lettered


def _mixed(chars: np.ndarray) -> Iterator[np.ndarray]:
    """A number for the characters i .. i + n - 1 at every place i, for n from 1 on."""
    mixed = np.zeros(len(chars), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        mixed = mixed[: max(0, len(chars) - n + 1)]
        mixed = (mixed * np.uint32(0x01000193) + chars[n - 1 :] * np.uint32(0x9E3779B1)) ^ np.uint32(n)
        yield mixed


def _bucket(mixed: np.ndarray, buckets: int) -> np.ndarray:
    spread = mixed * np.uint32(0x85EBCA6B)
    return ((spread ^ (spread >> np.uint32(15))) * np.uint32(0xC2B2AE35) >> np.uint32(33 - buckets.bit_length())).astype(np.int32)


def long_ngrams(text: bytes, buckets: int) -> tuple[np.ndarray, bool]:
    """Times that each bucket is met in one long text, and whether it has a letter; the same n-grams as ``ngrams``."""
    times, lettered = np.zeros(buckets, np.int64), False
    before, at = np.zeros(0, np.uint32), 0
    while True:
        end = min(at + PIECE_BYTES, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:  # not inside a character
            end += 1
        inner = fold_table()[np.frombuffer(text[at:end].decode().encode("utf-32-le"), "<u4")]
        edge = np.full(1, 32, np.uint32)
        chars = np.concatenate([before, edge if at == 0 else edge[:0], inner, edge if end == len(text) else edge[:0]])
        keep = np.ones(len(chars), bool)
        keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32)
        chars = chars[keep]
        lettered = lettered or bool((chars != 32).any())
        for n, mixed in enumerate(_mixed(chars), 1):
            if n in LENGTHS:  # those that end in a character of this piece
                times += np.bincount(_bucket(mixed[max(0, len(before) - n + 1) :], buckets), minlength=buckets)
        if end == len(text):
            return times, lettered
        before, at = chars[-(max(LENGTHS) - 1) :], end


@dataclass(frozen=True)
class LanguageModel:
    """Languages in code point order, and log probabilities: a row per bucket, the last row the prior."""

    languages: list[str]
    log_probs: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.log_probs) - 1

    def most_texts(self) -> int:
        """Texts that are scored together at most."""
        return max(1, SCORED_CELLS // max(1, len(self.languages)))

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language of each text and its posterior probability; ``und`` with 0 where there is no letter or
        nothing was learned."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if len(texts) == 1 and len(texts[0]) > PIECE_BYTES:
            times, some = long_ngrams(texts[0], self.buckets)
            found, lettered = np.flatnonzero(times), np.array([some])
            owners, times = np.zeros(len(found), np.int64), times[found]
        else:
            found, owners, lettered = ngrams(texts, self.buckets)
            times = None
        total = np.repeat(self.log_probs[-1:].astype(np.float64), len(texts), axis=0)
        step = self.most_texts()  # as many rows of the matrix as scores
        for i in range(0, len(found), step):
            rows = self.log_probs[found[i : i + step]]
            if times is not None:
                rows = rows * times[i : i + step, None].astype(np.float64)
            own = owners[i : i + step]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            np.add.at(total, own[first], np.add.reduceat(rows, first, axis=0, dtype=np.float64))
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if known else UNDETERMINED for b, known in zip(best, lettered)]
        return names, np.where(lettered, score, 0.0)


def learn(docs: DataFrame) -> LanguageModel:
    """Counts of every whole text of ``docs`` (text, lang; other columns are ignored) as a model.

    Rows without a language teach nothing; a null or empty text only counts for its language's prior. The
    counts are whole numbers, so the model doesn't depend on how rows are dealt out.
    """
    rows = docs.filter("lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    priors = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(priors) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(priors)
    if not languages:
        return LanguageModel([], np.zeros((1, 0), np.float32))
    buckets = min(MOST_BUCKETS, 1 << (MATRIX_CELLS // len(languages)).bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, cells in held.items():
                at = np.flatnonzero(cells)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(cells[at])], schema=COUNTS
                )
            held.clear()

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for i, j in slices(texts, SCORED_BYTES):
                names, number = np.unique(np.array(langs[i:j], object), return_inverse=True)
                if j - i == 1 and len(texts[i]) > PIECE_BYTES:
                    cells = long_ngrams(texts[i], buckets)[0]
                else:  # the model's languages times buckets at most
                    found, owners, _ = ngrams(texts[i:j], buckets)
                    cells = np.bincount(number[owners] * buckets + found, minlength=len(names) * buckets)
                for lang, own in zip(names, cells.reshape(len(names), buckets)):
                    if lang not in held and (len(held) + 1) * buckets > HELD_CELLS:
                        yield from passed_on()
                    held[lang] = held.get(lang, 0) + own
        yield from passed_on()

    counted = (
        rows.mapInArrow(count, from_arrow_schema(COUNTS)).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    place = {lang: k for k, lang in enumerate(languages)}
    cells = np.full((buckets, len(languages)), SMOOTHING)
    column = np.fromiter(map(place.__getitem__, counted.column("lang").to_pylist()), np.int64, counted.num_rows)
    cells[counted.column("bucket").to_numpy(), column] += counted.column("n").to_numpy()
    log_probs = np.log(cells) - np.log(cells.sum(axis=0))
    prior = np.log(np.array([priors[lang] for lang in languages]) / sum(priors.values()))
    return LanguageModel(languages, np.vstack([log_probs, prior]).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every whole text of ``docs`` (doc_id, text; other columns are ignored).

    A null text, or one without a letter, is ``und`` with score 0. A row comes back for every row given. Very long texts
    count whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for i, j in slices(texts, SCORED_BYTES, sent.value.most_texts()):
                names, score = sent.value.predict(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score)], schema=PREDICTED
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, from_arrow_schema(PREDICTED))


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast(T.BinaryType())) % folds == fold
