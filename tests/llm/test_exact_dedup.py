"""Exact duplicates by refinement against plain grouping."""

import re

import pytest
from compare import differences, duck
from llm.cases import AWKWARD, TINY

from barlake.llm import exact_dedup
from barlake.llm.exact_dedup import equal_texts
from barlake.llm.queries import OP11_SQL, op11_exact_dedup


def plain(rows):
    """(doc_id, keep_id, size) of every row, sorted, and per text how many rows stay."""
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub("[ \t\n\x0b\x0c\r]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for members in groups.values():
        keep = min(members, key=lambda m: m[:3])[3]
        out += [(m[3], keep, len(members)) for m in members]
    return sorted(out, key=str), len(groups)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 3, "c", True) for i, t in rows], "doc_id long, text string, size int, full_hash string, kept boolean")


def check(spark, rows):
    got = equal_texts(frame(spark, rows)).collect()
    expected, n_groups = plain(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == expected
    stay = [r for r in got if r.kept]
    assert len(stay) == n_groups
    assert all(r.doc_id == r.keep_id for r in stay)
    return got


def test_awkward_rows(spark):
    rows = AWKWARD + [(20, "one  two\nthree "), (21, "onetwothree"), (None, None), (22, " \t\n\x0b\x0c\r"), (23, "x\x00y"), (24, "x y"), (25, "xy"), (26, "x y")]
    got = check(spark, rows)
    assert {r.keep_id for r in got if r.doc_id in (1, 20, 21)} == {20}  # most code points
    assert {r.group_size for r in got if r.doc_id in (23, 26)} == {1}  # other blanks are no white space here


def test_ties_and_a_group_of_a_third(spark, monkeypatch):
    rows = [(i, "the same text") for i in range(300, 0, -1)] + [(7, "the same text")] * 40
    rows += [(1000 + i, f"text number {i // 3}") for i in range(500)] + [(None, "text number 1")] * 3
    got = check(spark, rows)
    assert {r.keep_id for r in got if r.group_size == 340} == {1}
    monkeypatch.setattr(exact_dedup, "HOT_ONE_IN", 2)  # nothing is hot
    check(spark, rows)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 25])
def test_shared_bits_and_beginnings_change_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "SIEVE_BITS", bits)
    same = "b" * 200
    rows = [(i, same + str(i % 40 + 100)) for i in range(120)]  # one length, one beginning, 40 texts
    rows += [(1000 + i, "c" * (i + 1)) for i in range(300)]
    check(spark, rows)


def test_only_shared_beginnings_are_hashed_whole(spark):
    rows = [(1, "a" * 100), (2, "a" * 101), (3, "x" * 100), (4, "same here"), (5, "same  here")]
    hashed = {r.doc_id for r in equal_texts(frame(spark, rows)).collect() if r.full_hash}
    assert hashed == {4, 5}


def test_very_long_texts(spark):
    long = "ab " * 1_000_000
    got = check(spark, [(1, long), (2, long + "\n"), (3, long + "c")])
    assert [r.kept for r in sorted(got, key=lambda r: r.doc_id)] == [False, True, True]


def test_empty_table_and_carried_columns(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    assert equal_texts(docs.limit(0)).count() == 0
    got = equal_texts(docs, carry=[docs["size"] + docs["doc_id"]]).collect()
    assert {r.doc_id: r.carried_0 for r in got} == {1: 4, 2: 5}


def test_native_and_texts_stay(spark):
    plan = op11_exact_dedup(spark, TINY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark):
    assert differences(op11_exact_dedup(spark, TINY), duck(TINY), OP11_SQL) is None
