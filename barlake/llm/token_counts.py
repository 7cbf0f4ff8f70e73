"""Token counts by rank-synchronous merging of ragged arrays.

The vocabulary is a sentencepiece BPE model with byte fallback. Texts fall into pieces that no merge can cross;
the distinct pieces of a batch are laid out as one ragged array of symbols, and in every round each piece's
lowest-ranked pair is merged, in all pieces at once. What survives is counted.

Merging every occurrence of a piece's lowest pair in one round equals merging them one by one as long as no
merge makes a pair of the same or a lower rank. The vocabulary's ranks for which that can happen are found
when it is loaded; for those only the leftmost occurrence is merged in a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import PieceTable, byte_texts, ragged_index, segment_sums, slices, starts_of

COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
#: The vocabulary's stand-in for a space.
MARK = "▁"
NONE = np.iinfo(np.int32).max


class MergeTable:
    """Symbols, pairs and ranks of a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = {
            model.id_to_piece(i): i
            for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        scores = np.array([model.get_score(i) for i in range(size)])
        symbols = dict(pieces)
        for piece in pieces:
            for char in piece:
                symbols.setdefault(char, len(symbols) + size)
        #: Symbols of characters outside the vocabulary, by their length in bytes.
        other = max(symbols.values()) + 1
        self.cost = np.ones(other + 5, np.int64)
        self.cost[other + 1 : other + 5] = np.arange(1, 5)
        for text, symbol in symbols.items():
            if symbol >= size:  # in pieces only, not a piece itself
                self.cost[symbol] = len(text.encode())
        points = np.arange(0x110000)
        self.symbol_of = (other + 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int32)
        for text, symbol in symbols.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = symbol
        self.mark = self.symbol_of[ord(MARK)]
        self.symbol_of[ord(" ")] = self.mark

        merged = [(p, i) for p, i in pieces.items() if len(p) > 1]
        ranks = {s: r for r, s in enumerate(sorted({scores[i] for _, i in merged}, reverse=True))}
        born = np.full(other + 5, -1, np.int64)  # rank at which a symbol comes to be
        for _, i in merged:
            born[i] = ranks[scores[i]]
        self.width = other + 5
        pairs = [
            (symbols[p[:k]] * self.width + symbols[p[k:]], born[i], i)
            for p, i in merged
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        ]
        keys, rank, made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], rank[order].astype(np.int32), made[order].astype(np.int32)
        self.one_by_one = np.zeros(len(ranks), bool)  # by rank
        for part in (self.keys // self.width, self.keys % self.width):
            self.one_by_one[born[part[self.rank <= born[part]]]] = True

        # what the splitting of texts rests on: a mark begins a piece or is all of it, runs of marks merge last
        marks = {p for p in pieces if set(p) == {MARK} and len(p) > 1}
        last = max((born[pieces[p]] for p in marks), default=NONE)
        if (
            any(MARK in p.lstrip(MARK) or "\n" in p or p.startswith(MARK * 2) and p not in marks for p in pieces)
            or any(born[i] >= last for p, i in merged if p not in marks)
            or any(born[pieces[p]] < last for p in marks)
        ):
            raise ValueError("this vocabulary merges across spaces or line ends")
        longest = max(map(len, marks), default=1)
        self.runs = self.count([" " * k for k in range(1, 4 * longest + 1)])[:, 0]
        self.longest = longest
        if any(self.runs[k] != self.runs[k - longest] + 1 for k in range(longest, len(self.runs))):
            raise ValueError("runs of spaces don't repeat after the longest piece")

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.rank[at], NONE).astype(np.int32), self.made[at]

    def count(self, pieces: list[str]) -> np.ndarray:
        """A row per piece: its tokens, and 1 if its first symbol is a bare mark."""
        out = np.zeros((len(pieces), 2), np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sym = self.symbol_of[np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4")]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        joined = np.zeros(len(sym), bool)
        joined[:-1] = piece[1:] == piece[:-1]
        rank = np.full(len(sym), NONE, np.int32)
        made = np.zeros(len(sym), np.int32)
        at = np.flatnonzero(joined)
        rank[at], made[at] = self._pairs(sym[at], sym[at + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            sizes = np.diff(np.append(starts, len(sym)))
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == NONE
            if over.any():  # finished pieces are counted and leave
                ended = starts[over]
                out[piece[ended], 0] = np.add.reduceat(self.cost[sym], starts)[over]
                out[piece[ended], 1] = sym[ended] == self.mark
                stay = np.repeat(~over, sizes)
                sym, piece, rank, made = sym[stay], piece[stay], rank[stay], made[stay]
                lowest, sizes = lowest[~over], sizes[~over]
                starts = starts_of(sizes)
                if not len(sym):
                    break
            hit = rank == np.repeat(lowest, sizes)
            where = np.flatnonzero(hit)
            # of overlapping occurrences every other one is merged, from the left
            run = np.concatenate([[True], where[1:] != where[:-1] + 1])
            place = np.arange(len(where))
            place -= np.maximum.accumulate(np.where(run, place, 0))
            take = place % 2 == 0
            single = self.one_by_one[rank[where]]
            if single.any():
                first = np.concatenate([[True], piece[where[1:]] != piece[where[:-1]]])
                take &= first | ~single
            where = where[take]
            sym[where] = made[where]
            keep = np.ones(len(sym), bool)
            keep[where + 1] = False
            # the pairs beside each merged symbol are looked up again
            moved = np.cumsum(keep) - 1
            sym, piece, rank, made = sym[keep], piece[keep], rank[keep], made[keep]
            new = moved[where]
            around = np.concatenate([new, new - 1])
            around = around[around >= 0]
            last = (around + 1 >= len(sym)) | (piece[np.minimum(around + 1, len(sym) - 1)] != piece[around])
            rank[around[last]] = NONE
            at = around[~last]
            rank[at], made[at] = self._pairs(sym[at], sym[at + 1])
        return out

    def run_tokens(self, lengths: np.ndarray) -> np.ndarray:
        """Tokens of runs of so many bare marks."""
        table = np.concatenate([[0], self.runs[: 2 * self.longest]])
        over = np.maximum(0, lengths // self.longest - 1)
        return table[lengths - over * self.longest] + over


_tables: dict[str, tuple[MergeTable, PieceTable]] = {}


def tables(path: str) -> tuple[MergeTable, PieceTable]:
    if path not in _tables:
        merges = MergeTable(path)

        def count(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            return merges.count([p.decode() for p in pieces]).ravel(), np.full(len(pieces), 2)

        _tables[path] = merges, PieceTable(count, np.int64)
    return _tables[path]


def count_texts(path: str, texts: list[bytes]) -> np.ndarray:
    """Tokens of every whole text, as the library counts them.

    A text gets a space before it. Spaces begin pieces, line ends are tokens of their own, and a bare space
    before others is put together with them once it is known whether a word took it.
    """
    merges, memo = tables(path)
    pieces, lines = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        text = text.replace(MARK.encode(), b" ")
        lines[k] = text.count(b"\n")
        pieces.append((b" " + text).replace(b" ", b"\n ").split(b"\n")[1:] if text else [])
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = [p for own in pieces for p in own]
    if not flat:
        return lines
    rows = memo.rows(flat)
    values = memo.values.reshape(-1, 2)[memo.starts[rows] // 2]
    tokens, bare_first = values[:, 0].copy(), values[:, 1] == 1
    bare = np.fromiter((p == b" " for p in flat), bool, len(flat))
    if bare.any():
        # a run of bare spaces ends before the next piece, and takes that piece's mark if no word did
        at = np.flatnonzero(bare)
        begins = at[~bare[at - 1] | (at == 0) | np.isin(at, starts_of(sizes))]
        cut = np.zeros(len(flat) + 1, bool)
        cut[starts_of(sizes)[sizes > 0]] = True
        cut[-1] = True
        bare_to = np.append(np.where(bare, len(flat), np.arange(len(flat))), len(flat))
        nearest = np.minimum.accumulate(bare_to[::-1])[::-1][begins]
        next_cut = np.minimum.accumulate(np.where(cut, np.arange(len(cut)), len(flat))[::-1])[::-1][begins + 1]
        ends = np.minimum(nearest, next_cut)
        length = ends - begins
        after = np.minimum(ends, len(flat) - 1)
        takes = (ends < next_cut) & bare_first[after] & np.fromiter((flat[i][:1] == b" " for i in after), bool, len(after))
        tokens[at] = 0
        tokens[begins] = merges.run_tokens(length + takes) - takes
    return segment_sums(tokens, sizes) + lines


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text.

    Reads the columns doc_id and text and ignores others. Null and empty texts have no bytes and no tokens; a
    row comes back for every row given, so repeated rows and null ids stay. Rows are never moved: there is no
    shuffle and nothing a frequent key could gather on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for i, j in slices(texts):
                some = texts[i:j]
                sizes = pa.array(list(map(len, some)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), sizes, pa.array(count_texts(vocabulary, some))], schema=COUNTS
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, from_arrow_schema(COUNTS))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
