"""Byte-level BPE encoding and decoding, with tree concatenation for long unsplit text.

The vocabulary's splitter never joins a non-space to a following ASCII space, so texts are cut there and each
distinct chunk is encoded once. A run of letters, digits or marks that the splitter leaves whole may be as long
as the text; such a run is halved until its parts are small, the parts are encoded in parallel by different
tasks, and neighbouring results are joined in a tree. At a join, a window of tokens around the seam is encoded
again and grows until it begins with the left side's token and ends with the right side's. Then every pair of
neighbouring tokens is one that the merges leave alone, which makes the joined sequence the run's own encoding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import SLICE_BYTES, PieceTable, byte_texts, ragged, ragged_index, slices, split_marks, starts_of

#: Unsplit text of more bytes than this is halved.
LEAF_BYTES = 4096
#: Tokens on each side of a seam that are encoded again at first.
WINDOW = 16
CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: White space beyond ASCII (fixed values): beside it a cut at an ASCII space may not be the splitter's.
WIDE_SPACE = re.compile(
    "[\x85\xa0  -     　]".encode().decode() if False else "[\x85\xa0  -     　]"
)
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
DECODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
PARTS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("copy", pa.int64()), ("seq", pa.int64()), ("unsplit", pa.int64()), ("part", pa.string())])


class ByteBpe:
    """A byte-level vocabulary file of the tokenizers library, and the memo of its chunks."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memo = PieceTable(self._encode, np.uint32, limit=500_000, split=split_marks)
        self._bytes: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def whole(self, texts: list[bytes]) -> list[list[int]]:
        """The library's ids of each text."""
        found = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return ragged([ids for i in range(0, len(chunks), 2000) for ids in self.whole(chunks[i : i + 2000])], np.uint32)

    def chunks(self, text: bytes) -> list[bytes]:
        """Parts of the text whose ids, one after another, are the text's."""
        string = text.decode()
        if not any(s in string for s in self.specials) and (string.isascii() or not WIDE_SPACE.search(string)):
            return CHUNK.findall(text)
        out = []
        for part in re.split("(" + "|".join(map(re.escape, self.specials)) + ")", string):
            if part in self.specials:
                out.append(part.encode())
            else:
                out += [part[i:j].encode() for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def unsplit(self, chunk: bytes) -> list[bytes]:
        """The runs that the library's splitter leaves whole in a chunk."""
        string = chunk.decode()
        return [string[i:j].encode() for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(string)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every whole text one after another, and how many each has."""
        pieces = [self.chunks(t) for t in texts]
        ids, lengths = self.memo.gather(self.memo.rows([c for p in pieces for c in p]))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        return ids, ends[cuts[1:]] - ends[cuts[:-1]]

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of every id as a ragged array; an id without a token has none."""
        if self._bytes is None:
            # fixed values: byte-level vocabularies write printable bytes as themselves, the others from 256 on
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            others = [b for b in range(256) if b not in printable]
            byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
            vocabulary = self.library.get_vocab(with_added_tokens=True)
            tokens = [b""] * (max(vocabulary.values()) + 1)
            for token, i in vocabulary.items():
                known = token not in self.specials and all(c in byte_of for c in token)
                tokens[i] = bytes(map(byte_of.__getitem__, token)) if known else token.encode()
            lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
            self._bytes = np.frombuffer(b"".join(tokens), np.uint8), starts_of(lengths), lengths
        return self._bytes

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        flat, starts, lengths = self._table()
        ids = ids[ids < len(lengths)]
        return flat[ragged_index(starts[ids], lengths[ids])].tobytes()

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the concatenation of two neighbouring parts of one unsplit run."""
        k = WINDOW
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            # a window must hold whole characters
            while a > 0 and self.decode_bytes(left[a : a + 1])[0] & 0xC0 == 0x80:
                a -= 1
            while b < len(right) and self.decode_bytes(right[b : b + 1])[0] & 0xC0 == 0x80:
                b += 1
            window = np.asarray(self.whole([self.decode_bytes(np.concatenate([left[a:], right[:b]]))])[0], left.dtype)
            agrees_left = a == 0 or window[0] == left[a]
            agrees_right = b == len(right) or window[-1] == right[b - 1]
            if agrees_left and agrees_right:
                return np.concatenate([left[:a], window, right[b:]])
            k *= 2

    def join_all(self, parts: list[np.ndarray]) -> np.ndarray:
        while len(parts) > 1:
            pairs = [self.join(parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        return parts[0]


def halves(run: bytes, most: int = LEAF_BYTES) -> list[bytes]:
    """A run halved, at characters, until no part has more than ``most`` bytes."""
    if len(run) <= most:
        return [run]
    middle = len(run) // 2
    while run[middle] & 0xC0 == 0x80:
        middle += 1
    return halves(run[:middle], most) + halves(run[middle:], most)


_loaded: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def _rows(ids_column: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    starts = starts_of(lengths)
    raw = [ids[s : s + n].astype("<u4").tobytes() for s, n in zip(starts, lengths)]
    return pa.RecordBatch.from_arrays([ids_column, pa.array(lengths), pa.array(raw, pa.binary())], schema=ENCODED)


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian 32-bit numbers, as bytes) of every whole text.

    Reads the columns doc_id and text and ignores others. Null and empty texts have no ids; repeated rows and
    null ids stay. Texts without long unsplit runs are encoded where they are. The others are dealt out in
    parts of about ``SLICE_BYTES``, or leaves of ``LEAF_BYTES`` of a run, and put together again by row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = LEAF_BYTES // 4 + 1  # in characters: no shorter run can have more bytes
    long = F.col("text").rlike(f"[^ \\t-\\r]{{{n},}}|[ \\t-\\r]{{{n},}}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for i, j in slices(texts):
                yield _rows(batch.column(0).slice(i, j - i), *loaded(vocabulary).encode(texts[i:j]))

    short = rows.filter(~long).mapInArrow(encode, from_arrow_schema(ENCODED))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for doc_id, text, key, copies in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                parts: list[tuple[int, bytes]] = []  # number of the unsplit run, -1 outside; text
                plain, size = [], 0
                for chunk in bpe.chunks(text):
                    runs = bpe.unsplit(chunk) if len(chunk) > LEAF_BYTES else [chunk]
                    for run in runs:
                        if len(run) > LEAF_BYTES:
                            parts += [(-1, b"".join(plain))] if plain else []
                            number = len(parts)
                            parts += [(number, leaf) for leaf in halves(run)]
                            plain, size = [], 0
                        else:
                            plain.append(run)
                            size += len(run)
                            if size > SLICE_BYTES:
                                parts, plain, size = [*parts, (-1, b"".join(plain))], [], 0
                parts += [(-1, b"".join(plain))] if plain or not parts else []
                for i in range(0, len(parts), 256):
                    some = parts[i : i + 256]
                    m = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(([doc_id] * m, [key] * m, [copies] * m, range(i, i + m), [u for u, _ in some], [p.decode() for _, p in some]), PARTS)],
                        schema=PARTS,
                    )

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            raw = []
            for unsplit, text in zip(batch.column("unsplit").to_pylist(), byte_texts(batch.column("part"))):
                ids = bpe.encode([text])[0] if unsplit < 0 else np.asarray(bpe.whole([text])[0], np.uint32)
                raw.append(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(raw, pa.binary())], names=[*PARTS.names[:5], "ids"])

    def put_together(part: pa.Table) -> pa.Table:
        bpe, runs, number = loaded(vocabulary), [], None
        part = part.sort_by("seq")
        for unsplit, ids in zip(part.column("unsplit").to_pylist(), part.column("ids").to_pylist()):
            ids = np.frombuffer(ids, "<u4")
            if unsplit >= 0 and unsplit == number:
                runs[-1].append(ids)
            else:
                runs.append([ids])
            number = unsplit
        ids = np.concatenate([bpe.join_all(r) for r in runs])
        copies = part.column("copy")[0].as_py()
        one = _rows(part.column("doc_id").combine_chunks()[:1], ids, np.array([len(ids)]))
        return pa.Table.from_batches([one] * copies)

    # rows that repeat are put together once; a row's parts meet in one task, bounded by its own text
    spread = (
        rows.filter(long)
        .groupBy("doc_id", "text")
        .count()
        .select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"), "count")
        .mapInArrow(deal, from_arrow_schema(PARTS))
        .repartition("key", "seq")
        .mapInArrow(encode_parts, "doc_id long, key long, copy long, seq long, unsplit long, ids binary")
    )
    long_rows = spread.groupBy("doc_id", "key").applyInArrow(put_together, from_arrow_schema(ENCODED))
    return short.unionByName(long_rows)


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the text its ids spell; broken UTF-8 becomes U+FFFD, ids
    outside the vocabulary spell nothing, null ids an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            rows = [b"" if v is None else v for v in batch.column(2).to_pylist()]
            for i, j in slices(rows):
                texts = [bpe.decode_bytes(np.frombuffer(r, "<u4")).decode("utf-8", "replace") for r in rows[i:j]]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(texts, pa.string())], schema=DECODED)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(decode, from_arrow_schema(DECODED))
