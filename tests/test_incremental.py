"""The features mart brought up to date around touched sessions, against a rebuild."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from barlake.plans.incremental import feature_table, remade_features, touched_spans, update_features
from barlake.plans.marts import daily_returns, volatility_features
from barlake.workspace import materialise, work_path


def as_rows(df):
    numbers = [F.round(c, 10).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(tuple, df.select(*numbers).collect()), key=lambda r: r[:2])


def corrected(bars, ticker, days):
    """The bars with other prices of one ticker on some days."""
    hit = (F.col("ticker") == ticker) & F.col("date").isin(days)
    prices = {c: F.when(hit, F.col(c) * 1.07).otherwise(F.col(c)) for c in ("high", "close", "adj_close")}
    return materialise(bars.withColumns(prices), "corrected")


def rebuilt(bars, **windows):
    return volatility_features(materialise(daily_returns(bars), "returns"), **windows)


def mart_of(spark, features):
    mart = feature_table(spark, work_path(spark, "mart"), features.schema)
    mart.upsert(features)
    return mart


def touched_frame(spark, keys):
    return spark.createDataFrame(keys, "ticker string, date date")


@pytest.fixture(scope="module")
def short(history):
    return materialise(history["staged"].where("date >= '2019-01-01'"), "short")


def test_runs_equal_a_rebuild(spark, short):
    """Sessions missing in the middle and at both ends land late, others are corrected; a run is repeated."""
    days = [r.date for r in short.where("ticker = 'AAA'").select("date").orderBy("date").collect()]
    late = {("BBB", days[0]), ("BBB", days[40]), ("CCC", days[150]), ("AAA", days[-1]), ("DDD", days[-1])}
    missing = touched_frame(spark, sorted(late))
    start = materialise(short.join(missing, ["ticker", "date"], "left_anti").select(*short.columns), "start")
    mart = mart_of(spark, rebuilt(start))
    update_features(mart, short, missing)
    assert as_rows(mart.read()) == as_rows(rebuilt(short))
    fixed = corrected(short, "CCC", [days[5], days[100]])
    touched = touched_frame(spark, [("CCC", days[5]), ("CCC", days[100]), ("CCC", days[100])])
    for _ in range(2):
        update_features(mart, fixed, touched)
    assert as_rows(mart.read()) == as_rows(rebuilt(fixed))


def test_only_days_in_reach_change(spark, short):
    """A correction changes the sessions from the horizon before it to the longest window after it, at most."""
    features = rebuilt(short)
    mart = mart_of(spark, features)
    days = [r.date for r in short.where("ticker = 'AAA'").select("date").orderBy("date").collect()]
    fixed = corrected(short, "AAA", [days[120]])
    touched = touched_frame(spark, [("AAA", days[120])])
    span = touched_spans(fixed, touched).collect()
    assert len(span) == 1 and span[0].first == days[114] and span[0].last == days[184]
    assert span[0].read_from == days[114 - 65] and span[0].read_to == days[184 + 5]
    remade = remade_features(mart, fixed, touched)
    assert {r.date for r in remade.select("date").distinct().collect()} == set(days[114:185])
    before, after = as_rows(features), as_rows(rebuilt(fixed))
    changed = {a[:2] for a, b in zip(after, before) if a != b}
    assert changed <= {tuple(r) for r in remade.select("ticker", "date").collect()}


def test_other_windows_and_nothing_touched(spark, short):
    days = [r.date for r in short.where("ticker = 'BBB'").select("date").orderBy("date").collect()]
    windows = {"horizon": 9, "min_history": 80}
    mart = mart_of(spark, rebuilt(short, **windows))
    update_features(mart, short, touched_frame(spark, []), **windows)
    update_features(mart, short, touched_frame(spark, [("ZZZ", days[0]), ("BBB", days[0] - timedelta(days=400))]), **windows)
    assert as_rows(mart.read()) == as_rows(rebuilt(short, **windows))
    fixed = corrected(short, "BBB", [days[90]])
    update_features(mart, fixed, touched_frame(spark, [("BBB", days[90])]), **windows)
    assert as_rows(mart.read()) == as_rows(rebuilt(fixed, **windows))
