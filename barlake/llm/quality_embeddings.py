"""Quality classifier: supervised subword embeddings.

A text's features are its words, its pairs of neighbouring words and the byte n-grams of its words, all hashed
into one set of buckets; a word that follows itself makes the same pair whatever the word. Every bucket has a
learned vector; a text is the average of its features' vectors and of some vectors of nothing, so that a few
words decide little, and a softmax layer over that average gives the class probabilities. Vectors and layer are trained together by
stochastic gradient descent in numpy, one text a step.

Training reads a bounded sample of the labelled rows, ``SAMPLE_ROWS``, in one task; the sample is drawn by a
hash of the id, so it is the same on every run. Since the layer is linear, vectors and layer collapse into one
number per bucket and class, which is all that scoring needs: a table of fixed size, broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import PieceTable, byte_texts, filter_texts, ragged_index, slices, starts_of

#: Most labelled rows that training reads.
SAMPLE_ROWS = 6000
BUCKETS = 1 << 17
DIMENSIONS = 12
#: Passes over the sample, more if it takes fewer steps than these.
EPOCHS = 5
LEAST_STEPS = 8000
#: Features of nothing that every text has.
BLANKS = 64
#: Step of the layer, and how many times larger that of the vectors is: each gets a small share of a text.
RATE = 0.5
VECTOR_RATE = 50
#: Byte n-grams of a word, with a mark on both of its ends.
NGRAMS = (2, 3, 4)
MODEL = pa.schema([("classes", pa.int64()), ("bias", pa.binary()), ("weights", pa.binary())])
SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])


def _spread(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint32(16))) * np.uint32(0x7FEB352D)
    return hashes ^ (hashes >> np.uint32(15))


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word, first its own, then those of its byte n-grams; and how many each has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    chars = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint32)
    word = np.repeat(np.arange(len(words)), lengths)
    # a polynomial over the whole word, by differences of running sums of powers
    powers = np.full(int(lengths.max()), 0x01000193, np.uint32)
    powers[0] = 1
    powers = np.multiply.accumulate(powers, dtype=np.uint32)
    within = np.arange(len(chars)) - np.repeat(starts_of(lengths), lengths)
    own = _spread(np.add.reduceat(chars * powers[within], starts_of(lengths), dtype=np.uint32))
    parts, owners = [own], [np.arange(len(words))]
    mixed = np.zeros(len(chars), np.uint32)
    for n in range(1, max(NGRAMS) + 1):
        if len(chars) < n:
            break
        mixed = mixed[: len(chars) - n + 1] * np.uint32(0x01000193) + chars[n - 1 :] + np.uint32(n)
        if n in NGRAMS:
            whole = word[: len(mixed)] == word[n - 1 :]
            parts.append(_spread(mixed[whole]))
            owners.append(word[: len(mixed)][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return np.concatenate(parts)[order], counts


def pair_features(own: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbouring words of each text, and how many each text has."""
    pairs = np.maximum(sizes - 1, 0)
    at = ragged_index(starts_of(sizes), pairs)
    left, right = own[at], own[at + 1]
    return _spread(np.where(left == right, np.uint32(0), left * np.uint32(0x9E3779B1) + right)), pairs


def text_features(table: PieceTable, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text in rising order and the share of its features in each; a text without a word has none.
    The shares fall short of 1 by that of the blanks."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    rows = table.rows(words)
    hashes, _ = table.gather(rows)
    pairs, _ = pair_features(table.values[table.starts[rows]], np.array([len(words)]))
    buckets, counts = np.unique(np.concatenate([hashes, pairs]) % BUCKETS, return_counts=True)
    return buckets.astype(np.int64), (counts / (counts.sum() + BLANKS)).astype(np.float32)


@dataclass
class QualityModel:
    """Bias per class and one number per bucket and class; without a class nothing was learned."""

    bias: np.ndarray
    weights: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Softmax over the classes, a row per text; a text without a word gets that of the bias."""
        if self.name not in _memos:
            _memos.clear()

            def sums(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
                """Of every word: its own hash (below 2**32, whole in a double), its features, their weights."""
                found, counts = word_features(words)
                total = np.add.reduceat(self.weights[found % BUCKETS], starts_of(counts), axis=0, dtype=np.float64)
                values = np.column_stack([found[starts_of(counts)].astype(np.float64), counts, total])
                return values.ravel(), np.full(len(words), values.shape[1])

            _memos[self.name] = PieceTable(sums, np.float64, limit=400_000)
        memo, classes = _memos[self.name], len(self.bias)
        words = [t.split() for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.repeat(self.bias[None].astype(np.float64), len(texts), axis=0)
        full = sizes > 0
        if full.any():
            rows = memo.rows([w for own in words for w in own])
            values = memo.values[(memo.starts[rows][:, None] + np.arange(classes + 2))]
            pairs, n_pairs = pair_features(values[:, 0].astype(np.uint32), sizes)
            total = np.add.reduceat(values[:, 1:], starts_of(sizes)[full], axis=0)
            picked = np.vstack([self.weights[pairs % BUCKETS].astype(np.float64), np.zeros((1, classes))])
            ends = np.cumsum(n_pairs)
            running = np.vstack([np.zeros((1, classes)), np.cumsum(picked, axis=0)])
            of_pairs = running[ends] - running[ends - n_pairs]
            logits = total[:, 1:] + of_pairs[full]
            out[full] += logits / (total[:, 0] + n_pairs[full] + BLANKS)[:, None]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


_memos: dict[str, PieceTable] = {}


def train(texts: list[bytes], labels: np.ndarray, classes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Bias and collapsed weights, by stochastic gradient descent over the texts in a drawn order per epoch."""
    table = PieceTable(word_features, np.uint32, limit=200_000)
    features = [text_features(table, t) for t in texts]
    rng = np.random.default_rng(17)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, classes), np.float32), np.zeros(classes, np.float32)
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(texts)))
    steps, done = epochs * len(texts), 0
    for _ in range(epochs):
        for k in rng.permutation(len(texts)):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            buckets, shares = features[k]
            hidden = shares @ vectors[buckets]
            logits = hidden @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[k]] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= rate * error
            vectors[buckets] -= np.outer(rate * VECTOR_RATE * shares, back)
    return bias, vectors @ layer


def shares_only(shares: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Bias and weights of a model that gives every text the classes' shares."""
    return np.log(np.clip(shares, 1e-6, 1)).astype(np.float32), np.zeros((BUCKETS, len(shares)), np.float32)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> QualityModel:
    """Train on documents (doc_id, text) that ``labels`` (doc_id, quality) marks 0 or 1; others are passed over.

    At most ``rows`` labels are drawn, by a hash of the id. A repeated label counts once; an id with both
    labels counts for both; of several texts of one id the first in code point order is taken. Without a label,
    or with labels of one class only, scores are that class's share of the labels (one half without any).
    """
    drawn = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(rows)
    )
    taught = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(drawn), "doc_id")  # a row per drawn label, ``rows`` at most
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "quality", "text")
    )

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2)))
        found.sort()
        quality = np.array([q for _, q, _ in found], np.int64)
        if len(set(quality)) == 2:
            bias, weights = train([t for _, _, t in found], quality)
        else:
            bias, weights = shares_only([np.mean(quality == c) if len(found) else 0.5 for c in (0, 1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int64()), pa.array([bias.tobytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary())], schema=MODEL
        )

    made = taught.repartition(1).mapInArrow(train_all, from_arrow_schema(MODEL)).head()
    if made is None:  # no row, no task
        return QualityModel(*shares_only([0.5, 0.5]))
    classes = made.classes
    return QualityModel(np.frombuffer(bytes(made.bias), np.float32), np.frombuffer(bytes(made.weights), np.float32).reshape(-1, classes))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score (probability of class 1) and predicted (1 from one half on) of every whole text of ``docs``
    (doc_id, text; other columns are ignored). Null and empty texts get the probability without any feature.
    A row comes back for every row given; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for i, j in slices(texts):
                found = sent.value.probabilities(texts[i:j])[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], schema=SCORED
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, from_arrow_schema(SCORED))


def keep_good(docs: DataFrame, model: QualityModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_texts(docs, lambda texts: sent.value.probabilities(texts)[:, 1] >= least)
