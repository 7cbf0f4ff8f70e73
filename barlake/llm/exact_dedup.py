"""Exact duplicates by progressive refinement, in DataFrame operations only.

Two texts are equal if they are identical without white space. Rows are told apart by ever dearer marks: first the
length, then a hash of the beginning, last a hash of the whole, which is taken only for rows whose length and
beginning another row shares. What one step hands to the next is a sieve: a bitmap with a bit for each (hash of a)
mark that two rows or more have. Its size is fixed, so it is broadcast at any size of the corpus; two marks that
share a bit only let a few more rows through to the next step, where they are told apart. No text is ever shuffled.

Groups are then formed by the full hash, on narrow rows. A group that holds more than one in HOT_ONE_IN of all rows
is looked up from a broadcast table (there are fewer than HOT_ONE_IN such groups), the others by a join in which
no key can be large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.workspace import materialise

#: White space that equal texts may differ in (fixed value).
SPACES = " \t\n\x0b\x0c\r"
#: Characters of the beginning that the second step hashes.
PREFIX_CHARS = 64
#: Bits of a sieve, and bits of one of its rows (what bitmap_construct_agg makes).
SIEVE_BITS = 1 << 25
ROW_BITS = 1 << 15
HOT_ONE_IN = 1024


def without_spaces(text: Column) -> Column:
    """The text without its white space; null is empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def _bit(*mark: Column) -> Column:
    return F.pmod(F.xxhash64(*mark), F.lit(SIEVE_BITS)).cast("int")


def sieve(rows: DataFrame, bit: str) -> DataFrame:
    """part and bits: bitmaps of the values of ``bit`` that two rows or more have."""
    shared = rows.groupBy(bit).agg(F.count("*").alias("times")).filter("times > 1")
    part, place = F.floor(F.col(bit) / ROW_BITS).cast("int"), (F.col(bit) % ROW_BITS).cast("long")
    return shared.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(place).alias("bits"))


def with_passes(rows: DataFrame, bit: str, mesh: DataFrame, name: str) -> DataFrame:
    """``rows`` with the flag ``name``: whether the sieve ``mesh`` has their ``bit``."""
    place = F.col(bit) % ROW_BITS
    byte = F.substring(F.col("bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1
    joined = rows.join(F.broadcast(mesh), F.floor(F.col(bit) / ROW_BITS).cast("int") == F.col("part"), "left")
    return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop("part", "bits")


def equal_texts(docs: DataFrame, carry: Sequence[Column] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, keep_id, group_size, kept.

    Of equal texts the row with the most code points stays, then the least doc_id, null last; of rows that are equal
    in that too, one. keep_id is the doc_id of the row that stays. Null texts are empty, and texts of white space alone
    equal them. ``carry`` are further columns, computed from the columns of ``docs`` while whole texts are read.
    full_hash, the last column, is null for rows that a sieve told apart. An empty table gives none.
    """
    names = [f"carried_{k}" for k in range(len(carry))]
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("chars"),
        without_spaces(F.col("text")).alias("bare"),
        *(c.alias(n) for c, n in zip(carry, names)),
    )
    size, begin = F.octet_length("bare"), F.xxhash64(F.left("bare", F.lit(PREFIX_CHARS)))
    by_length, by_begin = _bit(size).alias("by_length"), _bit(size, begin).alias("by_begin")

    marks = materialise(read.select(by_length, by_begin), "dedup-marks")
    shared_length = with_passes(marks, "by_length", sieve(marks, "by_length"), "passes").filter("passes")
    mesh = materialise(sieve(shared_length, "by_begin"), "dedup-sieve")

    whole = with_passes(read.withColumn("by_begin", by_begin), "by_begin", mesh, "passes")
    full = F.when(F.col("passes"), F.sha2("bare", 256)).alias("full_hash")
    rows = materialise(whole.select("doc_id", "chars", full, F.monotonically_increasing_id().alias("place"), *names), "dedup-rows")

    best = F.struct((-F.col("chars")).alias("fewest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place")
    groups = rows.filter("full_hash is not null").groupBy("full_hash").agg(F.count("*").alias("size"), F.min(best).alias("best"))
    groups = groups.filter("size > 1")
    hot = F.col("size") > rows.count() / HOT_ONE_IN
    found = rows.join(F.broadcast(groups.filter(hot)), "full_hash", "left")
    rest = found.filter("full_hash is not null and size is null").drop("size", "best").join(groups.filter(~hot), "full_hash", "left")
    done = found.filter("full_hash is null or size is not null").unionByName(rest)
    alone = F.col("size").isNull()
    return done.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.place") == F.col("place"))).alias("kept"),
        *names,
        "full_hash",
    )
