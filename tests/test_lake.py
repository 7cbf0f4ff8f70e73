from dataclasses import replace
from datetime import date, datetime, timedelta

import hypothesis
import pandas as pd
import pytest
from conftest import frame, made_bars
from hypothesis import HealthCheck, given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.plans.ingest import fetch_windows, ingest, window_lists
from barlake.plans.staging import staged
from barlake.settings import Settings
from barlake.sources.bars import TableSource, missing_tickers, normalise_tickers, ticker_frame
from barlake.sources.lake import Lake, MixedSources
from barlake.sources.wide import tidy, widen

SETTINGS = Settings(source="vendor", start_date=date(2020, 1, 1))
NAMES = ["AAA", "BBB", "CCC", "DDD"]


@pytest.fixture(scope="module")
def vendor(spark):
    pdf = made_bars(NAMES, "2020-01-01", 400)
    return frame(spark, pdf).withColumn("arrived", F.lit(0)).persist()


def source(df, name="vendor"):
    return TableSource(name, df, ["arrived"])


@hypothesis.settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.sampled_from([f"T{k}" for k in range(12)]), st.one_of(st.none(), st.integers(-900, 40)), min_size=1),
    st.integers(0, 30),
    st.integers(1, 500),
)
def test_windows_of_any_calendar(spark, newest, lookback, history):
    """Tickers by the day of their newest bar, counted from the end of the plan; null for those without one."""
    end = date(2023, 5, 17)
    begin = end - timedelta(days=history)
    days = {t: None if n is None else end + timedelta(days=n) for t, n in newest.items()}
    marks = [(t, d) for t, d in days.items() if d is not None] + [("NOT ASKED FOR", end)]
    plan = fetch_windows(ticker_frame(spark, list(newest)), spark.createDataFrame(marks, "ticker string, watermark date"), begin, lookback, end)
    wanted = {t: begin if d is None else max(begin, d - timedelta(days=lookback)) for t, d in days.items()}
    assert {r["ticker"]: r["start"] for r in plan.collect()} == {t: start for t, start in wanted.items() if start < end}


def test_window_lists_have_a_row_per_start(spark):
    names = spark.range(25).selectExpr("concat('T', lpad(id, 2, '0')) ticker", "date_add(date'2020-01-01', cast(id % 2 as int)) start")
    lists = {r["start"].day: r["tickers"] for r in window_lists(names).collect()}
    assert lists == {1 + k: [f"T{i:02d}" for i in range(25) if i % 2 == k] for k in (0, 1)}


@pytest.mark.parametrize("lookback", [0, 5, 40])
def test_a_later_run_lands_what_its_windows_hold(spark, vendor, tmp_path, lookback):
    lake, tickers = Lake(spark, str(tmp_path)), ticker_frame(spark, NAMES)
    settings = replace(SETTINGS, lookback_days=lookback)
    days = sorted(r[0] for r in vendor.select("date").distinct().collect())
    stops = [days[200], days[207], days[207], days[260]]
    landed = []
    for k, stop in enumerate(stops):
        run = ingest(lake, source(vendor), tickers, stop, settings, f"r{k}", datetime.combine(stop, datetime.min.time()))
        since = days[0] if k == 0 else stops[k - 1] - timedelta(days=lookback)
        assert run["rows_landed"] == len(NAMES) * sum(since <= d <= stop for d in days)
        landed.append(run["rows_landed"])
    assert {r["watermark"] for r in lake.watermarks().collect()} == {days[260]}
    assert {r["run_id"]: r["rows_landed"] for r in lake.manifests().collect()} == {f"r{k}": n for k, n in enumerate(landed)}
    assert lake.bronze().count() == sum(landed)
    assert staged(lake.bronze()).count() == len(NAMES) * 261


def test_planning_reads_the_state_and_not_bronze(spark, vendor, tmp_path):
    lake, tickers = Lake(spark, str(tmp_path)), ticker_frame(spark, NAMES)
    ingest(lake, source(vendor), tickers, date(2020, 9, 1), SETTINGS, "r1")
    for frame_ in (lake.watermarks(), lake.sources()):
        assert all("/_runs/state/" in f for f in frame_.inputFiles()) and frame_.inputFiles()
    advanced = {tuple(r) for r in lake.state().collect()}
    assert advanced == {tuple(r) for r in lake.rebuild_state().collect()} and len(advanced) == len(NAMES)
    lake.clear_run(date(2020, 9, 1), "r1")
    assert lake.watermarks().count() == 0
    ingest(lake, source(vendor), tickers, date(2020, 8, 3), SETTINGS, "r2")
    ingest(lake, source(vendor), tickers, date(2020, 8, 4), SETTINGS, "r2b")
    lake.land(lake.bronze().where("run_id = 'r2b' and date < '2020-08-04'"))  # a landing that takes rows back
    assert {r["watermark"] for r in lake.watermarks().collect()} == {date(2020, 8, 3)}


def test_files_of_other_numeric_types_are_widened(spark, vendor, tmp_path):
    lake = Lake(spark, str(tmp_path))
    ingest(lake, source(vendor), ticker_frame(spark, NAMES), date(2020, 2, 3), SETTINGS, "r1")
    some = lake.bronze().where("date = '2020-02-03'").drop("run_id", "ingest_date")
    for k, kind in enumerate(("int", "bigint", "decimal(20,3)", "smallint", "float")):
        own = some.withColumn("volume", F.col("volume").cast(kind)).withColumn("open", F.col("open").cast("decimal(18,6)"))
        own.drop("source").write.parquet(f"{lake.bronze_path}/ingest_date=2019-01-0{k + 1}/run_id={kind[:3]}")
    volumes = {r["run_id"]: (r["n"], r["v"], r["s"]) for r in lake.bronze().where("date = '2020-02-03'").groupBy("run_id").agg(
        F.count("*").alias("n"), F.sum("volume").alias("v"), F.count("source").alias("s")).collect()}
    assert volumes.pop("r1")[2] == 4
    assert len(volumes) == 5 and len(set(volumes.values())) == 1 and volumes["int"][2] == 0
    assert lake.bronze().schema == Lake(spark, str(tmp_path / "none")).bronze().schema
    types = lake.catalogue()
    assert len(types) == 6 and lake.catalogue() == types
    assert spark.read.json(f"{lake.runs_path}/types").count() == 6  # every footer was read once


def test_repeating_a_run_replaces_its_own_files_only(spark, vendor, tmp_path):
    lake = Lake(spark, str(tmp_path))
    tickers = ticker_frame(spark, NAMES)
    days = date(2020, 3, 2)
    landed = [
        ingest(lake, source(vendor), tickers, days, SETTINGS, run, datetime(2020, 3, i + 2))["rows_landed"]
        for i, run in enumerate(["a", "b", "b"])
    ]
    assert landed[1] == landed[2]
    assert lake.bronze().count() == landed[0] + landed[1]
    latest = staged(lake.bronze())
    assert latest.count() == latest.select("ticker", "date").distinct().count() == landed[0]
    newest = latest.where("date = date'2020-03-02'").select("run_id").distinct().collect()
    assert [r["run_id"] for r in newest] == ["b"]


def test_other_vendor_is_refused(spark, vendor, tmp_path):
    lake = Lake(spark, str(tmp_path))
    tickers = ticker_frame(spark, NAMES)
    ingest(lake, source(vendor), tickers, date(2020, 2, 3), SETTINGS, "r1")
    with pytest.raises(MixedSources, match="can't take those of"):
        ingest(lake, source(vendor, "other"), tickers, date(2020, 2, 4), SETTINGS, "r2")


@pytest.mark.parametrize("spoil,reason", [
    ({"volume": None}, "volume:not_nullable"),
    ({"open": -3.0}, "open:greater_than(0)"),
    ({"low": 1e6}, None),
])
def test_a_bar_that_was_set_aside_is_asked_for_again(spark, tmp_path, spoil, reason):
    """A vendor sends a broken bar on top of a good older copy of another, and mends it days later."""
    lake, tickers = Lake(spark, str(tmp_path)), ticker_frame(spark, ["QQ", "RR"])
    pdf = made_bars(["QQ", "RR"], "2022-03-07", 45).assign(arrived=1)
    stop = sorted(pdf["date"].unique())[30]
    sent = pdf[pdf["date"] <= stop].copy()
    at = sent.index[(sent["ticker"] == "QQ") & (sent["date"] == stop)][0]
    sent.loc[at, list(spoil)] = list(spoil.values())
    twice = pd.concat([sent, sent[sent["ticker"] == "RR"].head(7).assign(arrived=0)], ignore_index=True)
    run = ingest(lake, source(spark.createDataFrame(twice)), tickers, stop, SETTINGS, "one")
    assert (run["duplicates_dropped"], run["rows_quarantined"], run["rows_landed"]) == (7, 1, len(sent) - 1)
    (set_aside,) = lake.quarantine().collect()
    assert (set_aside["ticker"], set_aside["date"]) == ("QQ", stop)
    assert reason is None or reason in set_aside["_reject_reason"]
    marks = {r["ticker"]: r["watermark"] for r in lake.watermarks().collect()}
    assert marks["RR"] == stop > marks["QQ"]
    later = sorted(pdf["date"].unique())[33]
    ingest(lake, source(spark.createDataFrame(pdf)), tickers, later, SETTINGS, "two")
    assert staged(lake.bronze()).where(f"ticker = 'QQ' and date = '{stop}'").count() == 1
    assert {r["watermark"] for r in lake.watermarks().collect()} == {later}


def test_a_retry_clears_what_the_first_attempt_set_aside(spark, tmp_path):
    pdf = made_bars(["AAA"], "2024-01-01", 10).assign(arrived=0)
    broken = pdf.assign(close=-1.0)
    lake, today, tickers = Lake(spark, str(tmp_path)), pdf["date"].max(), ticker_frame(spark, ["AAA"])
    ingest(lake, source(spark.createDataFrame(broken)), tickers, today, SETTINGS, "r1")
    assert (lake.bronze().count(), lake.quarantine().count()) == (0, 10)
    ingest(lake, source(spark.createDataFrame(pdf)), tickers, today, SETTINGS, "r1")
    assert (lake.bronze().count(), lake.quarantine().count()) == (10, 0)


def test_nothing_fetched_still_leaves_a_manifest(spark, vendor, tmp_path):
    lake = Lake(spark, str(tmp_path))
    result = ingest(lake, source(vendor), ticker_frame(spark, ["ZZZ"]), date(2021, 1, 4), SETTINGS, "r1")
    assert result["rows_fetched"] == 0 and "bronze_path" not in result
    assert lake.manifests().first()["rows_landed"] == 0
    assert lake.bronze().count() == 0


def test_older_files_without_a_column_are_unified_by_name(spark, vendor, tmp_path):
    lake = Lake(spark, str(tmp_path))
    ingest(lake, source(vendor), ticker_frame(spark, NAMES), date(2020, 2, 3), SETTINGS, "r1")
    old = lake.bronze().limit(3).drop("source", "run_id", "ingest_date")
    old.write.parquet(f"{lake.bronze_path}/ingest_date=2019-01-01/run_id=old")
    assert lake.bronze().where("run_id = 'old' and source is null").count() == 3


def test_wide_frames_keep_every_ticker(spark):
    pdf = made_bars(["AAPL", "MSFT", "BRK.B"], "2024-01-01", 3)
    wide = widen(frame(spark, pdf), ["AAPL", "BRK.B", "MSFT"])
    back = tidy(wide)
    assert back.count() == 9
    assert back.select("ticker").distinct().count() == 3
    unlisted = wide.withColumns(
        {c: F.when(F.col("Date") > F.lit(date(2024, 1, 1)), F.col(f"`{c}`")) for c in wide.columns if c.startswith("MSFT")}
    )
    assert tidy(unlisted).where("ticker = 'MSFT'").count() == 2
    no_adjusted = wide.drop(*[c for c in wide.columns if c.endswith("Adj Close")])
    assert tidy(no_adjusted).where("adj_close = close").count() == 9
    with pytest.raises(ValueError, match="expected TICKER_Field"):
        tidy(wide.withColumnRenamed("AAPL_Open", "open"))
    plan = tidy(wide.limit(3)).select("ticker")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # the two of ``widen``; going back to tidy rows adds none


def test_ticker_lists(spark):
    raw = spark.createDataFrame([(" msft",), ("AAPL ",), ("msft",), ("  ",)], "ticker string")
    assert {r[0] for r in normalise_tickers(raw).collect()} == {"AAPL", "MSFT"}
    assert [r[0] for r in ticker_frame(spark, ["msft", "aapl", "msft"]).collect()] == ["AAPL", "MSFT"]
    with pytest.raises(ValueError, match="at least one"):
        ticker_frame(spark, ["  "])
    wanted = ticker_frame(spark, ["A", "B"])
    got = missing_tickers(wanted, spark.createDataFrame([("B",)], "ticker string"))
    assert [r[0] for r in got.collect()] == ["A"]
