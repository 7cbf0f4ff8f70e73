"""Token ids in binary files of byte planes.

Ids are cut into fixed-size blocks. A block of 32-bit ids is transposed into four byte planes, every plane is
compressed with zstandard on its own (the high planes of a small vocabulary shrink to nothing), and a chunk
index tells where each block's planes lie. A written corpus is a folder:

``files/part-*.planes``   one file per writing task: compressed planes; then the chunk index, a row per block
                          (ids, offset, length of each plane, crc32 of the ids); then the index's length; MAGIC
``documents/``            Parquet, a row per document: doc_id, part, task (its writer's place in the order of
                          documents), first (its first id's place in the part), n_tokens

Each task attempt writes a file of its own name, and only the rows of attempts that Spark committed name their
files, so a lost executor or a repeated task leaves at most a file that nothing refers to. Files are written
and read through ``pyarrow.fs``, so the folder may be on any store it knows; the folder's full address is taken from
Spark once, so that files lie where Spark's own tables do.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import MARKS, SLICE_BYTES, PieceTable, ragged, ragged_index, starts_of

#: Ids in a block.
BLOCK_IDS = 1 << 16
PLANES = 4
#: Words that neither normalising nor splitting changes.
LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Bytes of text worked on at once.
STRETCH_BYTES = 1 << 22
#: What a byte is: white space 0, ASCII letter 1, ASCII mark but for the apostrophe 3, digit 4, anything else 2.
_KIND = np.full(256, 2, np.uint8)
_KIND[list(b" \t\n\r\x0b\x0c")] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[list(MARKS)] = 3
_KIND[48:58] = 4
#: Where the vocabulary's splitter cuts whatever surrounds the place: at white space, between a letter and a mark, and
#: on either side of a digit. By 5 x the kind before + the kind behind.
_CUTS = np.array([a == 0 or b == 0 or a == 4 or b == 4 or {a, b} == {1, 3} for a in range(5) for b in range(5)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
MAGIC = b"IDPLANE1"
CHUNK = np.dtype([("ids", "<u4"), ("crc", "<u4"), ("offset", "<u8"), ("planes", "<u4", (PLANES,))])
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("task", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64())])
TOKENS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

_tables: dict[str, PieceTable] = {}


def pack(ids: np.ndarray) -> list[bytes]:
    """The compressed byte planes of one block, lowest byte first."""
    press = zstandard.ZstdCompressor(level=3)
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, PLANES).T)
    return [press.compress(p.tobytes()) for p in planes]


def unpack(planes: list[bytes], count: int) -> np.ndarray:
    """The ids of a block from its planes."""
    press = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(press.decompress(p, max_output_size=count), np.uint8) for p in planes]
    return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").ravel()


def full_address(spark: SparkSession, path: str) -> str:
    """The path with the store that Spark would take it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def store_of(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" not in path and ":/" not in path:
        return pa.fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pa.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def word_table(path: str) -> PieceTable:
    """Memo of the ids of pieces, as the tokenizers library encodes them with the vocabulary at ``path``.

    Pieces of lower-case Latin letters alone are what normalising and splitting leave as they are: for them the library
    is loaded a second time without these two steps.
    """
    if path not in _tables:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        whole, merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for tokenizer in (whole, merges):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        merges.normalizer = None
        merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

        # where the vocabulary marks word ends, they tell the words of a run apart
        suffix = whole.model.end_of_word_suffix
        marked = suffix is not None
        ends = np.zeros(whole.get_vocab_size(), bool)
        ends[[i for token, i in whole.get_vocab(False).items() if marked and token.endswith(suffix)]] = True

        def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            strings = [w.decode() for w in words]
            plain = np.fromiter(map(bool, map(LETTERS.fullmatch, strings)), bool, len(strings)) & marked
            order = np.argsort(~plain, kind="stable")
            first = [strings[i] for i in order[: plain.sum()]]
            rest = [strings[i] for i in order[plain.sum() :]]
            runs = [first[i : i + 1000] for i in range(0, len(first), 1000)]
            flat, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
            for e in merges.encode_batch_fast(runs, add_special_tokens=False, is_pretokenized=True):
                flat.append(np.array(e.ids, np.uint32))
                lengths.append(np.diff(np.flatnonzero(ends[flat[-1]]), prepend=-1))
            for i in range(0, len(rest), 2000):
                some = whole.encode_batch_fast(rest[i : i + 2000], add_special_tokens=False)
                for values, out in zip(ragged([e.ids for e in some], np.uint32), (flat, lengths)):
                    out.append(values)
            flat, lengths = np.concatenate(flat), np.concatenate(lengths)
            back = np.argsort(order)
            return flat[ragged_index(starts_of(lengths)[back], lengths[back])], lengths[back]

        _tables[path] = PieceTable(encode, np.uint32, limit=700_000)
    return _tables[path]


def encode_stretch(table: PieceTable, data: np.ndarray, ends: np.ndarray, special: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a stretch of bytes, and how many of them come before each of ``ends``, the places where texts end.

    The vocabulary drops white space and lower-cases, so the pieces between its splitter's certain cuts are encoded
    alone, each distinct one once. ``special`` has whole texts that are encoded by the library at the end they stand for.
    """
    kinds = _KIND[data]
    cut = _CUTS[kinds[:-1] * np.uint8(5) + kinds[1:]]
    cut[ends[(ends > 0) & (ends < len(data))] - 1] = True
    inside = kinds != 0
    first = np.flatnonzero(inside & np.concatenate([[True], cut])[: len(data)])
    last = np.flatnonzero(inside & np.concatenate([cut, [True]])[: len(data)])
    offsets = np.zeros(len(first) + 1, np.int64)
    np.cumsum(last - first + 1, out=offsets[1:])
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])]
    )
    coded = pieces.dictionary_encode()
    rows = table.rows(coded.dictionary.to_pylist() + list(special.values()))
    known = len(coded.dictionary)
    of_pieces = rows[coded.indices.to_numpy()]
    before = np.searchsorted(first, ends)
    if special:
        where = np.fromiter(special, np.int64, len(special))
        of_pieces = np.insert(of_pieces, before[where], rows[known:])
        added = np.zeros(len(ends), np.int64)
        added[where] = 1
        before = before + np.cumsum(added)
    ids, lengths = table.gather(of_pieces)
    running = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=running[1:])
    return ids, running[before]


def stretches(data: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[int, int, int, int]]:
    """Stretches [a, b) of about ``most`` bytes and the texts [i, j) that end in them. A long text is cut at white space."""
    a = i = 0
    while a < len(data) or i < len(ends):
        b = min(a + most, len(data))
        while b < len(data):
            window = data[b : b + most]
            place = np.flatnonzero(_KIND[window] == 0)
            close = ends[np.searchsorted(ends, b)]
            b = min(int(close), b + (int(place[0]) if len(place) else len(window)))
            if b == close or len(place):
                break
        j = int(np.searchsorted(ends, b, side="right"))
        yield a, b, i, j
        a, i = b, j


def encode_texts(path: str, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of every whole text one after another in bounded runs, with the number of ids, counted from the first
    text, at which each text that ends in the run is over. Null texts are empty; ``end_id`` closes each text.

    A text that holds ``<|`` may hold a special token, which is matched before lower-casing: the library gets it whole.
    """
    table = word_table(path)
    texts = texts.cast(pa.large_string()).fill_null("")
    marked = pc.match_substring(texts, "<|")
    special: dict[int, bytes] = {}
    if pc.any(marked).as_py():
        where = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        special = {int(i): texts[i].as_py().encode() for i in where}
        texts = pc.if_else(marked, "", texts).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    done = 0
    for a, b, i, j in stretches(data, ends, STRETCH_BYTES):
        own = {k - i: special[k] for k in range(i, j) if k in special} if special else {}
        ids, over = encode_stretch(table, data[a:b], ends[i:j] - a, own)
        if end_id is not None:
            ids = np.insert(ids, over, np.uint32(end_id))
            over = over + np.arange(1, j - i + 1)
        yield ids, done + over
        done += len(ids)


class PartWriter:
    """Writes one part file: blocks as they fill, the chunk index at the end."""

    def __init__(self, folder: str):
        fs, place = store_of(folder)
        self.name = f"part-{uuid.uuid4().hex}.planes"
        fs.create_dir(place, recursive=True)
        self.out = fs.open_output_stream(f"{place}/{self.name}")
        self.chunks: list[tuple] = []
        self.waiting, self.held, self.offset, self.ids = [], 0, 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= BLOCK_IDS:
            flat = np.concatenate(self.waiting)
            whole = self.held - self.held % BLOCK_IDS
            for i in range(0, whole, BLOCK_IDS):
                self._block(flat[i : i + BLOCK_IDS])
            self.waiting, self.held = [flat[whole:]], self.held - whole

    def _block(self, ids: np.ndarray) -> None:
        planes = pack(ids)
        for p in planes:
            self.out.write(p)
        sizes = [len(p) for p in planes]
        self.chunks.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), self.offset, sizes))
        self.offset += sum(sizes)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        index = np.array(self.chunks, CHUNK).tobytes()
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()


class PartReader:
    """Reads runs of ids of one part file; keeps the last block, so that rising reads unpack each block once."""

    def __init__(self, folder: str, name: str):
        fs, place = store_of(folder)
        self.file = fs.open_input_file(f"{place}/{name}")
        size = self.file.size()
        self.file.seek(size - len(MAGIC) - 8)
        tail = self.file.read()
        if tail[8:] != MAGIC:
            raise ValueError(f"{name} is not a whole file of token planes")
        length = int.from_bytes(tail[:8], "little")
        self.file.seek(size - len(MAGIC) - 8 - length)
        self.chunks = np.frombuffer(self.file.read(length), CHUNK)
        self.at, self.last = -1, None

    def _block(self, k: int) -> np.ndarray:
        if k != self.at:
            chunk = self.chunks[k]
            self.file.seek(int(chunk["offset"]))
            raw, planes = self.file.read(int(chunk["planes"].sum())), []
            for size in chunk["planes"].tolist():
                planes.append(raw[:size])
                raw = raw[size:]
            ids = unpack(planes, int(chunk["ids"]))
            if zlib.crc32(ids.tobytes()) != chunk["crc"]:
                raise ValueError(f"block {k} of the part is damaged")
            self.at, self.last = k, ids
        return self.last

    def read(self, first: int, count: int) -> np.ndarray:
        out, done = np.empty(count, "<u4"), 0
        while done < count:
            k, skip = divmod(first + done, BLOCK_IDS)
            some = self._block(k)[skip : skip + count - done]
            out[done : done + len(some)] = some
            done += len(some)
        return out

    def close(self) -> None:
        self.file.close()


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = 1, partitions: int | None = None
) -> str:
    """Encode ``docs`` (doc_id, text; other columns are ignored) and write them under ``folder``, which it returns.

    Documents lie in ascending doc_id order, null first; rows of one doc_id in the order of their texts' hash,
    so that they need not share a task. A null or empty text has the end id alone. Repeated rows are written as
    often as they come. An empty table writes an empty folder of documents.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = full_address(docs.sparkSession, folder)
    order = [F.col("doc_id"), F.xxhash64("text")]
    # texts are dealt out before they are encoded: finding the ranges then samples the scan, not the encoder
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, task = None, TaskContext.get().partitionId()
        for batch in batches:
            part = part or PartWriter(f"{folder}/files")
            begin, over = part.ids, []
            for ids, ends in encode_texts(vocabulary, batch.column(1), end_id):
                part.add(ids)
                over.append(ends)
            counts = np.diff(np.concatenate(over), prepend=0)
            columns = [batch.column(0), [part.name] * len(counts), [task] * len(counts), begin + starts_of(counts), counts]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, DOCUMENTS)], schema=DOCUMENTS)
        if part:
            part.close()

    ordered.mapInArrow(write, from_arrow_schema(DOCUMENTS)).write.parquet(f"{folder}/documents")
    return folder


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, part, first, n_tokens, and start: the ids of all documents before it.

    Parts are put in the order of the tasks that wrote them, which is that of their documents, also where one doc_id
    fills several. There is one part per writing task, so this small table of parts is bounded by the task count of the
    write, whatever the number of documents.
    """
    documents = spark.read.schema(from_arrow_schema(DOCUMENTS)).parquet(f"{folder}/documents")
    parts = documents.groupBy("part").agg(F.sum("n_tokens").alias("ids"), F.min("task").alias("task"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return documents.join(F.broadcast(parts), "part").select(
        "doc_id", "part", "first", "n_tokens", (F.col("before") + F.col("first")).alias("start")
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every written document from the files: doc_id, start, n_tokens, and ids as little-endian 32-bit numbers."""
    folder = full_address(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, None
        for batch in batches:
            done, size, ids = 0, 0, []
            for k, (name, first, count) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if name != at:
                    if part:
                        part.close()
                    part, at = PartReader(f"{folder}/files", name), name
                ids.append(part.read(first, count).tobytes())
                size += count * 4
                if size > SLICE_BYTES or k + 1 == batch.num_rows:
                    some = batch.slice(done, k + 1 - done)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(3), some.column(4), some.column(2), pa.array(ids, pa.binary())], schema=TOKENS
                    )
                    done, size, ids = k + 1, 0, []
        if part:
            part.close()

    index = document_index(spark, folder).select("part", "first", "n_tokens", "doc_id", "start")
    return index.mapInArrow(read, from_arrow_schema(TOKENS))
