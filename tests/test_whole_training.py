"""Queries that train all candidates, with every default: 400 trees for each fold, its probe and the final fit."""

import pytest
from conftest import TINY

from barlake.registry import all_queries, forecasting


@pytest.mark.parametrize("name", ["gbt_properties", "selection"])
def test_jobs_of_a_training_run_dont_follow_its_trees(spark, monkeypatch, name):
    monkeypatch.setattr(forecasting, "_trained", {})
    context, group = spark.sparkContext, f"whole-{name}"
    context.setLocalProperty("spark.jobGroup.id", group)
    rows = all_queries()[name](spark, TINY).collect()
    context.setLocalProperty("spark.jobGroup.id", None)
    ((_, result),) = forecasting._trained.values()
    fitted = result.validation.trees
    assert len(fitted) == 6 and all(len(t.forest.trees) == 400 for t in fitted)
    assert len(context.statusTracker().getJobIdsForGroup(group)) < 200
    check = {"gbt_properties": sound_rows, "selection": ranked_rows}[name]
    check(rows, result)


def sound_rows(rows, _):
    """Persistence and trees are measured on the same rows of every fold."""
    assert len(rows) == 10 and all(r["sound"] for r in rows)
    sizes = {m: sorted((r["fold"], r["train_rows"], r["test_rows"]) for r in rows if r["model"] == m) for m in ("naive", "trees")}
    assert sizes["naive"] == sizes["trees"] and len(sizes["naive"]) == 5


def ranked_rows(rows, result):
    """All three candidates by their loss; the first one alone may be promoted."""
    assert sorted(r["model"] for r in rows) == ["har", "naive", "trees"]
    best = min(rows, key=lambda r: (r["qlike_mean"], r["model"]))
    assert best["model"] == result.champion
    assert [r["model"] for r in rows if r["promoted"]] == [result.champion] * result.promoted
