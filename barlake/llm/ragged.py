"""Small numpy helpers shared by the text operators: byte texts, bounded slices, ragged arrays, piece memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame



def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores behind it while a column of the table has it (whatever the case of its letters)."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


#: ASCII white space as the word contracts mean it; ``bytes.split()`` splits at exactly these.
SPACE = " \t\n\r\x0b\x0c"
#: Bytes of text worked on at once inside a task.
SLICE_BYTES = 1 << 21


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def slices(texts: Sequence[bytes], most: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs ``[i, j)`` of rows of about ``most`` bytes and at most ``rows`` rows, one row at least, so that memory follows
    neither the batch size nor the number of rows."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > most or i - start == rows):
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Exclusive running sum."""
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


def ragged_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the values of several runs, run after run."""
    total = int(lengths.sum())
    return np.repeat(starts - starts_of(lengths), lengths) + np.arange(total, dtype=np.int64)


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values``; an empty run sums to 0."""
    running = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(lengths)
    return running[ends] - running[ends - lengths]


def runs_of(inside: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of places ``inside``; a run never goes beyond one of ``ends`` (exclusive)."""
    joined = np.zeros(len(inside) + 1, bool)  # whether a place goes on with the run of the place before it
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[ends] = False
    return np.flatnonzero(inside & ~joined[:-1]), np.flatnonzero(inside & ~joined[1:])


def byte_runs(data: np.ndarray, inside: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The bytes of each run of places ``inside``."""
    offsets = np.zeros(len(first) + 1, np.int64)
    np.cumsum(last - first + 1, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])


#: ASCII marks but for the apostrophe, which may begin a contraction.
MARKS = b".,!?;:$%&*#|()[]{}\"-_+=/<>@~^`\\"


def split_marks(piece: bytes) -> tuple[bytes, ...]:
    """The piece, or its two parts if it ends in ASCII marks after an ASCII letter: the vocabularies' splitters
    cut between a letter and a mark whatever surrounds them, so the parts can be encoded alone."""
    base = piece.rstrip(MARKS)
    if len(base) < len(piece) and base[-1:].isalpha() and b"<|" not in piece:
        return base, piece[len(base) :]
    return (piece,)


def ragged(lists: Sequence[Sequence], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of several lists one after another, and how many each has."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype, int(lengths.sum())), lengths


class PieceTable:
    """Memo from a piece of text to its values, kept as one ragged array.

    ``encode`` gets a list of distinct new pieces and returns their values one after another and how many each
    has. With ``split``, a piece of two parts has the values of its parts, which are pieces of their own. The
    memo holds about ``limit`` pieces at most: it is emptied when full, so its memory is bounded, and results
    never depend on it. A worker process that goes on to another table empties the one before.
    """

    in_use: PieceTable | None = None

    def __init__(self, encode: Callable, dtype, limit: int = 1_000_000, split: Callable | None = None):
        self.encode, self.dtype, self.limit, self.split = encode, dtype, limit, split
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.values = np.zeros(1 << 16, self.dtype)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _store(self, pieces: list[bytes], flat: np.ndarray, lengths: np.ndarray) -> None:
        first, total = len(self.index), len(flat)
        while self.used + total > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while first + len(pieces) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.values[self.used : self.used + total] = flat
        self.starts[first : first + len(pieces)] = self.used + starts_of(lengths)
        self.lengths[first : first + len(pieces)] = lengths
        self.used += total
        self.index.update(zip(pieces, range(first, first + len(pieces))))

    def _add(self, pieces: list[bytes]) -> None:
        if self.split is None:
            self._store(pieces, *self.encode(pieces))
            return
        split = list(map(self.split, pieces))
        parts = [p for p in dict.fromkeys(chain.from_iterable(split)) if p not in self.index]
        if parts:
            self._store(parts, *self.encode(parts))
        joined = [s for s in split if len(s) == 2]
        if joined:
            rows = np.fromiter(map(self.index.__getitem__, chain.from_iterable(joined)), np.int64, 2 * len(joined))
            flat, lengths = self.gather(rows)
            self._store([a + b for a, b in joined], flat, lengths[::2] + lengths[1::2])

    def rows(self, pieces: list[bytes]) -> np.ndarray:
        """Row of every piece, valid until the next call, to this or another table."""
        other, PieceTable.in_use = PieceTable.in_use, self
        if other is not None and other is not self:
            other._clear()
        if len(self.index) >= self.limit:
            self._clear()
        out = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new = [pieces[i] for i in missing]
            self._add(list(dict.fromkeys(new)))
            out[missing] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
        return out

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the rows one after another, and how many each row has."""
        lengths = self.lengths[rows]
        return self.values[ragged_index(self.starts[rows], lengths)], lengths


def filter_texts(docs: DataFrame, keeps: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text (null: empty) ``keeps`` marks, with all their columns; nothing is shuffled."""
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(at))
            for i, j in slices(texts):
                yield batch.slice(i, j - i).filter(pa.array(keeps(texts[i:j]), pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
