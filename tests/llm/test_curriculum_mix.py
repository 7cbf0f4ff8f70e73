"""The mix against a plain resharing loop, and the order of its positions."""

import duckdb
import pytest
from compare import differences, duck
from llm.cases import AWKWARD, TINY
from pyspark.sql import functions as F

from barlake.llm import curriculum_mix
from barlake.llm.curriculum_mix import in_training_order, mix, source_targets, training_documents
from barlake.llm.queries import OP6_SQL, op6_curriculum_mix


def reshared(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if target[s] > 3 * sizes[s]}
        if not above:
            return target | {s: 3.0 * sizes[s] for s in stopped}
        stopped |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 1000, None: 3},
        {"a": 1, "b": 2, "c": 3, "d": 4, "é": 5, "z": 900, None: 1},
        {"a": 0, "b": 7},
        {"a": 0},
        {None: 5},
        {f"s{k}": k * k for k in range(40)},
    ],
)
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: (r.source_size, r.target) for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    expected = reshared(sizes)
    assert got == {s: (n, pytest.approx(expected[s])) for s, n in sizes.items()}


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (i % 17 + 1), f"s{i % 5}" if i % 3 else "hot") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mix(docs, keep=["doc_id", "source"]).collect()
    assert len(mixed) == len(rows)
    for source in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.mix_size * r.mix_passes for r in own) - own[0].mix_target) <= 17
    assert max(r.mix_passes for r in mixed) <= 3
    assert all(len(r.mix_positions) == r.mix_passes and all(0 <= p <= 1 for p in r.mix_positions) for r in mixed)


def test_sources_grow_and_shrink_over_training(spark):
    rows = [(i, "one two three", "ab"[i % 2]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    ordered = in_training_order(mix(docs, keep=["source"])).collect()
    positions = [r.mix_position for r in ordered]
    assert positions == sorted(positions)
    early = [r.source for r in ordered if r.mix_position < 0.5]
    late = [r.source for r in ordered if r.mix_position >= 0.5]
    # weights 1 and 2: a grows from half to one and a half times its mean, b shrinks
    assert early.count("a") / late.count("a") == pytest.approx(0.6, abs=0.05)
    assert early.count("b") / late.count("b") == pytest.approx(1 / 0.6, abs=0.1)


@pytest.mark.parametrize("run_rows", [2, 20_000])
def test_runs_change_nothing(spark, monkeypatch, run_rows):
    monkeypatch.setattr(curriculum_mix, "RUN_ROWS", run_rows)
    rows = [(i, "w " * (i % 7), "hot" if i % 2 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.mix_passes, tuple(r.mix_positions)) for r in mix(docs).collect())
    monkeypatch.setattr(curriculum_mix, "RUN_ROWS", 100_000)
    assert got == sorted((r.doc_id, r.mix_passes, tuple(r.mix_positions)) for r in mix(docs).collect())


def test_awkward_rows(spark, awkward):
    rows = mix(awkward, keep=awkward.columns).collect()
    assert len(rows) == len(AWKWARD) and set(awkward.columns) <= set(rows[0].asDict())
    assert all(r.mix_passes == 0 for r in rows if not (r.text or "").strip(" \t\n\r"))
    assert mix(awkward.limit(0)).count() == 0 and in_training_order(mix(awkward.limit(0))).count() == 0


def test_no_python_in_the_plan(spark, awkward):
    plan = in_training_order(mix(awkward))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_the_query_inverts_the_demand_and_range_sorts(spark):
    frame = op6_curriculum_mix(spark, TINY)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(" in plan and "SQRT" in plan.upper()
    firsts = [r.first_position for r in frame.collect()]
    taken = [f for f in firsts if f is not None]
    assert taken == sorted(taken) and firsts[: len(taken)] == taken and len(taken) > 100


def test_clashing_columns_stay(spark):
    rows = [(1, "a b", "x", 7, "k", 0.5), (2, "c", "y", 8, "l", 0.25), (3, "", None, 9, "m", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size int, mix_key string, mix_position double")
    mixed = mix(docs, keep=docs.columns)
    assert {r.doc_id: (r.mix_size, r.mix_size_) for r in mixed.collect()} == {1: (7, 2), 2: (8, 1), 3: (9, 0)}
    got = training_documents(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == set(rows[:2])


def test_a_source_without_words(spark):
    docs = spark.createDataFrame([(1, "", "x"), (2, None, "x"), (3, "a b c", "y")], "doc_id long, text string, source string")
    got = {r.doc_id: (r.mix_passes, r.mix_target) for r in mix(docs).collect()}
    assert got == {1: (0, 0.0), 2: (0, 0.0), 3: (1, 3.0)}


def test_one_id_is_split_into_runs(spark, monkeypatch):
    monkeypatch.setattr(curriculum_mix, "RUN_ROWS", 50)
    rows = [(7, f"word {k}", "hot") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mix(docs).agg({"mix_passes": "sum"}).first()[0] == 600
    run = F.substring(F.md5(F.concat(F.lit("7:"), F.md5(F.col("text").cast("binary"))).cast("binary")), 1, 1)
    assert docs.groupBy(run).count().agg({"count": "max"}).first()[0] < 100


def test_sql_twin_on_awkward_rows(spark, tmp_path):
    rows = [(1, "a b", "x"), (2, None, "x"), (3, "", None), (4, "c d e", None), (4, "c d e", None), (None, "f", "y"), (5, "g " * 50, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert differences(op6_curriculum_mix(spark, str(tmp_path)), con, OP6_SQL) is None


def test_query_equals_sql(spark):
    assert differences(op6_curriculum_mix(spark, TINY), duck(TINY), OP6_SQL) is None
