"""Quality rules by tokeniser fertility.

How a public vocabulary takes a text apart tells text of the kind it was made from from other text: characters
per token fall where words are broken by marks or noise, the share of byte-fallback tokens rises with characters
that are in no vocabulary, and the entropy of a text's tokens falls with repetition. Each of the three has a band
per script, and Latin script has a second one for languages that write many marked letters (Vietnamese, Yoruba,
Navajo), which the vocabulary takes letter by letter; a text outside its band is rejected. Bands are parameters: they
don't depend on the other texts, so a text's verdict is its own.

Plain counts of words, symbols, repeated lines and repeated word windows are made in the same pass.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from barlake.llm.ragged import PieceTable, byte_runs, byte_texts, filter_texts, ragged, runs_of, segment_sums, slices, starts_of

SYMBOLS = b"#*$%&|<>"
#: Words of a window, words a text must have, and the share of words in repeated windows it may have.
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
MEASURES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("script", pa.string()), ("n_pieces", pa.int64())]
    + [(n, pa.float64()) for n in ("chars_per_token", "byte_share", "token_entropy")]
)


class Band(NamedTuple):
    """What a text may have: characters per token from and to, byte tokens among all tokens up to, and entropy
    of its tokens in bits from. A short text can't have much entropy: half of what so many different tokens
    would have is enough for any. A long one must have ``growth`` more for each doubling beyond GROWS_FROM tokens;
    where the vocabulary has single letters only, entropy stays that of the alphabet, and nothing is added."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float
    growth: float = 0.0


GROWS_FROM = 256
#: A text fewer than one in so many of whose characters are letters counts as one without.
LETTERS_ONE_IN = 10
#: Latin text is ``latin_marked`` if one in so many of its letters, or more, is no ASCII letter or carries a mark.
MARKED_ONE_IN = 20
#: Bands by script; ``none`` is for texts without letters, ``other`` for letters of all other scripts. They leave a
#: margin about reference prose of each script and of Latin languages of few and of many marked letters, composed and
#: decomposed (see the tests). What falls outside is hex and other encoded data, marks, digits, unknown characters,
#: and endless repetition. Letters that the vocabulary doesn't know are unknown characters, but for scripts with a band.
BANDS: dict[str, Band] = {
    "latin": Band(1.35, 8.0, 0.12, 4.0, 0.25),
    "latin_marked": Band(0.85, 8.0, 0.35, 3.8),
    "cyrillic": Band(1.2, 8.0, 0.20, 4.0, 0.25),
    "greek": Band(0.6, 8.0, 0.40, 3.5),
    "han": Band(0.25, 4.0, 0.75, 3.5, 0.10),
    "arabic": Band(0.55, 4.0, 0.25, 3.5),
    "hebrew": Band(0.55, 4.0, 0.25, 3.5),
    "armenian": Band(0.50, 4.0, 0.40, 3.5),
    "georgian": Band(0.55, 4.0, 0.25, 3.3),
    "devanagari": Band(0.50, 4.0, 0.35, 3.5),
    "bengali": Band(0.45, 4.0, 0.45, 3.5),
    "gurmukhi": Band(0.30, 4.0, 0.92, 3.0),
    "gujarati": Band(0.30, 4.0, 0.92, 3.0),
    "odia": Band(0.28, 4.0, 0.97, 2.8),
    "tamil": Band(0.50, 4.0, 0.40, 3.5),
    "telugu": Band(0.40, 4.0, 0.75, 3.3),
    "kannada": Band(0.45, 4.0, 0.65, 3.3),
    "malayalam": Band(0.30, 4.0, 0.93, 3.0),
    "sinhala": Band(0.33, 4.0, 0.85, 3.2),
    "thai": Band(0.55, 4.0, 0.30, 3.5),
    "lao": Band(0.30, 4.0, 0.97, 2.8),
    "myanmar": Band(0.40, 4.0, 0.80, 3.3),
    "ethiopic": Band(0.30, 4.0, 0.93, 3.2),
    "khmer": Band(0.50, 4.0, 0.55, 3.5),
    "tibetan": Band(0.50, 4.0, 0.65, 3.5),
    "mongolian": Band(0.28, 4.0, 0.97, 2.5),
    "thaana": Band(0.35, 4.0, 0.97, 2.8),
    "other": Band(0.25, 8.0, 0.90, 3.0),
    "none": Band(1.5, 8.0, 0.10, 4.0, 0.25),
}
#: Letters of each script (fixed values: ranges of code points), the first code point after each range behind it.
SCRIPTS = {
    "latin": (0x41, 0x5B, 0x61, 0x7B),
    "latin_marked": (0xC0, 0xD7, 0xD8, 0xF7, 0xF8, 0x370, 0x1E00, 0x1F00, 0x2C60, 0x2C80, 0xA720, 0xA800, 0xAB30, 0xAB70),
    "greek": (0x370, 0x400, 0x1F00, 0x2000),
    "cyrillic": (0x400, 0x530),
    "han": (0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0),
    "arabic": (0x600, 0x700, 0x750, 0x780, 0x8A0, 0x900, 0xFB50, 0xFE00, 0xFE70, 0xFF00),
    "hebrew": (0x590, 0x600, 0xFB1D, 0xFB50),
    "armenian": (0x530, 0x590),
    "georgian": (0x10A0, 0x1100, 0x1C90, 0x1CC0),
    "devanagari": (0x900, 0x980),
    "bengali": (0x980, 0xA00),
    "gurmukhi": (0xA00, 0xA80),
    "gujarati": (0xA80, 0xB00),
    "odia": (0xB00, 0xB80),
    "tamil": (0xB80, 0xC00),
    "telugu": (0xC00, 0xC80),
    "kannada": (0xC80, 0xD00),
    "malayalam": (0xD00, 0xD80),
    "sinhala": (0xD80, 0xE00),
    "thai": (0xE00, 0xE80),
    "lao": (0xE80, 0xF00),
    "myanmar": (0x1000, 0x10A0),
    "ethiopic": (0x1200, 0x13A0),
    "khmer": (0x1780, 0x1800),
    "tibetan": (0xF00, 0x1000),
    "mongolian": (0x1800, 0x18B0),
    "thaana": (0x780, 0x7C0),
}
#: Marks that stand apart from the letter they belong to (fixed values: a range of code points).
COMBINING = (0x300, 0x370)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(string.ascii_letters.encode())] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

RATED = MEASURES.append(pa.field("base_failed", pa.bool_())).append(pa.field("kept", pa.bool_()))

_tables: dict[str, tuple[PieceTable, np.ndarray, np.ndarray]] = {}
_scripts: list[np.ndarray] = []


def script_table() -> np.ndarray:
    """Number of the script of every code point, from 1 in the order of SCRIPTS; 0 for other letters, 255 for
    what is no letter."""
    if not _scripts:
        table = np.array([0 if chr(i).isalpha() else 255 for i in range(0x110000)], np.uint8)
        table[slice(*COMBINING)] = 0  # counts as a marked letter
        for k, edges in enumerate(SCRIPTS.values(), 1):
            for a, b in zip(edges[::2], edges[1::2]):
                table[a:b][table[a:b] == 0] = k
        _scripts.append(table)
    return _scripts[0]


def tables(path: str) -> tuple[PieceTable, np.ndarray, np.ndarray]:
    """Memo of the token ids of pieces of words, which ids are byte-fallback tokens, and which bytes are marks that a
    word can be cut before.

    Merging joins neighbours only into what is a token, so where no token holds an ASCII letter followed by a certain
    mark, nothing is ever joined across the two. A piece from inside a word has a blank before it in the memo: it is
    encoded behind a letter, whose token is left out, since the library takes what it gets as the beginning of a word.
    """
    if path not in _tables:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        pairs = {a + b for p in map(model.id_to_piece, np.flatnonzero(~is_byte).tolist()) for a, b in zip(p, p[1:])}
        letters = string.ascii_letters
        cut = np.zeros(256, bool)
        cut[[ord(m) for m in string.punctuation if not any(x + m in pairs for x in letters)]] = True
        if len(model.encode("a")) != 1:
            cut[:] = False

        def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            inner = np.fromiter((w[:1] == b" " for w in words), bool, len(words))
            flat, lengths = ragged(model.encode([("a" + w[1:].decode()) if t else w.decode() for w, t in zip(words, inner)], num_threads=1), np.int32)
            drop = np.zeros(len(flat), bool)
            drop[starts_of(lengths)[inner]] = True
            return flat[~drop], lengths - inner

        _tables[path] = PieceTable(encode, np.int32, limit=600_000), is_byte, cut
    return _tables[path]


def repeated_words(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many words of each text lie in a window of WINDOW words that the text holds twice or more.

    ``codes`` numbers the words of all texts one after another. A hash of each window and its text finds windows that
    may be equal; these few are then compared word by word, so the count is exact.
    """
    out = np.zeros(len(sizes), np.int64)
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return out
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    key = text[:n].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for k in range(WINDOW):
        key = key * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    key = key[place]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return out
    where = np.searchsorted(twice, key)
    place = place[twice[np.minimum(where, len(twice) - 1)] == key]
    windows = np.column_stack([text[place], *(codes[place + k] for k in range(WINDOW))])
    _, which, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    first = place[times[which.ravel()] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + WINDOW, -1)
    return np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=len(sizes))


def entropies(ids: np.ndarray, sizes: np.ndarray, kinds: int) -> np.ndarray:
    """Entropy in bits of each text's tokens; 0 for a text without tokens."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    key, times = np.unique(text * kinds + ids, return_counts=True)
    total = segment_sums(times * np.log2(times), np.bincount(key // kinds, minlength=len(sizes)))
    some = np.maximum(sizes, 1)
    return np.log2(some) - total / some


def script_of(text: bytes, chars: int) -> str:
    """The script that most letters of a text belong to; ``none`` for a text of few letters or none."""
    if text.isascii():
        return "latin" if text.lower() != text.upper() else "none"
    code_points = np.frombuffer(text.decode().encode("utf-32-le"), "<u4")
    kinds = np.bincount(script_table()[code_points], minlength=256)[:255]
    if LETTERS_ONE_IN * kinds.sum() < max(1, chars):
        return "none"
    names = ["other", *SCRIPTS]
    plain, marked = kinds[names.index("latin")], kinds[names.index("latin_marked")]
    if plain + marked >= kinds.max():
        return "latin_marked" if MARKED_ONE_IN * marked >= plain + marked else "latin"
    return names[kinds.argmax()]


def measure_texts(path: str, texts: list[bytes]) -> list[np.ndarray]:
    """The columns of MEASURES behind doc_id for every whole text."""
    memo, is_byte, cut = tables(path)
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    inside = ~_SPACE[data]
    first, last = runs_of(inside, ends)
    sizes = np.diff(np.searchsorted(first, ends), prepend=0)
    codes = byte_runs(data, inside, first, last).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    repeated = repeated_words(codes, sizes)
    # words are encoded in pieces, each distinct one once
    apart = np.flatnonzero(_LETTER[data[:-1]] & cut[data[1:]]) + 1
    begin, end = runs_of(inside, np.concatenate([ends, apart]))
    coded = byte_runs(data, inside, begin, end).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    inner = np.ones(len(begin), bool)
    inner[np.searchsorted(begin, first)] = False
    some_inner = np.flatnonzero(np.bincount(codes[inner], minlength=1))
    whole = coded.dictionary.to_pylist()
    rows = memo.rows(whole + [b" " + whole[c] for c in some_inner])
    of_inner = np.zeros(len(whole), np.int64)
    of_inner[some_inner] = rows[len(whole) :]
    ids, lengths = memo.gather(np.where(inner, of_inner[codes], rows[codes]) if len(codes) else rows[:0])
    pieces = segment_sums(lengths, np.diff(np.searchsorted(begin, ends), prepend=0))
    by_bytes = segment_sums(is_byte[ids].astype(np.int64), pieces)

    def count(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(flags), ends), prepend=0)

    chars = segment_sums(last - first + 1, sizes) - count((data & 0xC0) == 0x80)  # bytes that go on with a character
    symbols = count(_SYMBOL[data])
    lines = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        full = [line for line in text.split(b"\n") if line.strip()]
        lines[k] = len(full) - len(set(full))
    scripts = [script_of(text, n) if size else "other" for text, n, size in zip(texts, chars, sizes)]
    per_token = np.divide(chars, pieces, out=np.zeros(len(texts)), where=pieces > 0)
    share = np.divide(by_bytes, pieces, out=np.zeros(len(texts)), where=pieces > 0)
    return [sizes, chars, symbols, lines, repeated, scripts, pieces, per_token, share, entropies(ids, pieces, len(is_byte))]


def verdicts(found: list[np.ndarray], bands: Mapping[str, Band] = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept of texts whose measures (without doc_id) are ``found``; a script without a band of
    its own has that of ``other``, and without one there every text holds."""
    words, _, _, _, repeated, scripts, pieces, per_token, share, entropy = found
    failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)
    none = Band(0.0, np.inf, 1.0, -np.inf)
    own = np.array([bands.get(s, bands.get("other", none)) for s in scripts], np.float64).reshape(-1, 5)
    size = np.log2(np.maximum(pieces, 1))
    floor = np.minimum(own[:, 3] + own[:, 4] * np.maximum(size - np.log2(GROWS_FROM), 0), 0.5 * size)
    inside = (per_token >= own[:, 0]) & (per_token <= own[:, 1]) & (share <= own[:, 2]) & (entropy >= floor)
    return failed, ~failed & inside


def rate(docs: DataFrame, vocabulary: str, bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """The columns of MEASURES, base_failed and kept for every whole text of ``docs`` (doc_id, text; other
    columns are ignored).

    A text of fewer than LEAST_WORDS words, or more than MOST_REPEATED percent of whose words lie in repeated
    windows, fails the base rules, so null and empty texts do. The others are kept if they lie in the bands of
    their script. A row comes back for every row given; nothing is shuffled. Very long texts are measured whole, one at
    a time. Columns of ``docs`` that share a name with a measure are not read.
    """

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for i, j in slices(texts):
                found = measure_texts(vocabulary, texts[i:j])
                columns = [*found, *verdicts(found, bands)]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, list(RATED)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *arrays], schema=RATED)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(rated, from_arrow_schema(RATED))


def keep_kept(docs: DataFrame, vocabulary: str, bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """The rows of ``docs`` that ``rate`` keeps, with all their columns."""
    return filter_texts(docs, lambda texts: verdicts(measure_texts(vocabulary, texts), bands)[1])
