
from datetime import date, datetime, timedelta

import pytest
from conftest import frame, made_bars
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.plans.pipeline import StaleSource, build_marts, run_daily
from barlake.operators.upsert import KeyedTable
from barlake.plans.monitoring import matured_forecasts, recent_sessions
from barlake.plans.publishing import publish, published
from barlake.plans.staging import staged
from barlake.plans.training import load_card
from barlake.registry import lake as lake_queries
from barlake.settings import Settings, TreeSettings
from barlake.sources.bars import TableSource, ticker_frame
from barlake.sources.lake import Lake
from barlake.sources.versions import newest_version, write_version
from barlake.streaming.ingest import keep_trade_bars, land_stream, trade_bar_stream, trade_bars

NAMES = ["AAA", "BBB", "CCC"]


def test_whole_run_twice(spark, tmp_path):
    pdf = made_bars(NAMES, "2018-01-01", 900)
    source = TableSource("vendor", frame(spark, pdf).withColumn("arrived", F.lit(0)), ["arrived"])
    settings = Settings(
        start_date=date(2018, 1, 1),
        n_splits=2,
        test_days=60,
        min_train_days=300,
        min_improvement=-1.0,
        candidates=("naive", "har", "trees"),
        trees=TreeSettings(trees=2, leaves=4),
    )
    lake = Lake(spark, str(tmp_path / "lake"))
    newest = pdf["date"].max()
    first_day = newest - timedelta(days=7)
    tickers = ticker_frame(spark, NAMES)
    to = str(tmp_path / "published")
    one = run_daily(
        lake, source, tickers, first_day, settings, publish_to=to,
        now=datetime.combine(first_day, datetime.min.time()),
    )
    assert one["landed"] > 2000 and one["forecasts"] == 3
    assert one["train"]["promoted"] == (one["train"]["champion"] != "naive")
    two = run_daily(
        lake, source, tickers, newest, settings, now=datetime.combine(newest, datetime.min.time())
    )
    assert 0 < two["landed"] < 60
    if load_card(spark, f"{lake.root}/models") is not None and "retrain" not in two:
        assert "train" not in two
    assert spark.read.parquet(lake.mart_path("volatility_forecasts")).count() >= 6
    latest = spark.read.parquet(f"{to}/gold/features_volatility/latest")
    pinned = spark.read.parquet(f"{to}/gold/features_volatility/snapshot_date={first_day}")
    assert latest.count() == pinned.count() > 0
    with pytest.raises(StaleSource):
        build_marts(lake, settings, datetime.combine(newest, datetime.min.time()) + timedelta(days=30))


def test_publishing_twice_replaces_the_same_snapshot(spark, tmp_path):
    tables = {"monthly_summary": spark.range(5)}
    for _ in range(2):
        written = publish(spark, tables, {"version": "v1"}, str(tmp_path), date(2024, 1, 5))
    assert len(written) == 4
    for key in ("snapshot_date=2024-01-05", "latest"):
        assert spark.read.parquet(f"{tmp_path}/gold/monthly_summary/{key}").count() == 5
        assert spark.read.text(f"{tmp_path}/gold/model_card/{key}").count() == 1


def test_a_failing_table_leaves_the_publication_as_it_was(spark, tmp_path):
    to = str(tmp_path)
    publish(spark, {"monthly_summary": spark.range(5)}, {"version": "v1"}, to, date(2024, 1, 5))
    lost = spark.range(3).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, {"monthly_summary": spark.range(9), "daily_returns": lost}, None, to, date(2024, 1, 5))
    for key in ("snapshot_date=2024-01-05", "latest"):
        assert spark.read.parquet(f"{to}/gold/monthly_summary/{key}").count() == 5
    assert published(spark, to).count() == 4


def test_a_version_is_read_once_its_checks_have_passed(spark, tmp_path):
    path = str(tmp_path / "t")
    assert newest_version(spark, path) is None
    for n in (3, 4, 5):
        assert write_version(spark.range(n), path).count() == n
        assert spark.read.parquet(newest_version(spark, path)).count() == n

    def refuse(written):
        raise ValueError(f"{written.count()} rows")

    with pytest.raises(ValueError, match="6 rows"):
        write_version(spark.range(6), path, refuse)
    assert spark.read.parquet(newest_version(spark, path)).count() == 5
    assert write_version(spark.range(7), path).count() == 7
    assert len(list((tmp_path / "t").glob("version=*"))) == 2


def test_upserts_rewrite_months_and_reads_open_months(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "k"), T.StructType.fromDDL("ticker string, date date, x int"), ("ticker", "date"), "date", ())
    rows = spark.sql("select concat('T', id % 5) ticker, date_add(date'2020-01-01', cast(id div 5 as int)) date, 1 x from range(1000)")
    table.upsert(rows)
    month = tmp_path / "k" / "date_month=2020-03"
    before = {f.name for f in (tmp_path / "k" / "date_month=2020-02").iterdir()}
    files = {f.name for f in month.iterdir()}
    table.upsert(rows.where("date between '2020-03-05' and '2020-03-08'").withColumn("x", F.lit(2)))
    assert {f.name for f in (tmp_path / "k" / "date_month=2020-02").iterdir()} == before
    assert {f.name for f in month.iterdir()} != files
    assert table.read().count() == 1000 and table.read().where("x = 2").count() == 20
    some = table.read(date(2020, 2, 28), date(2020, 3, 2))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan and some.count() == 4 * 5


def test_recent_sessions_and_matured_forecasts_scan_literal_days(history):
    features = history["features"]
    recent = recent_sessions(features, 10)
    forecasts = recent.select("ticker", F.col("date").alias("as_of_date"), F.lit(0.2).alias("forecast_vol"), F.lit("v").alias("model_version"))
    for df in (recent, matured_forecasts(forecasts, features)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(date," in plan


def test_streamed_bars_land_like_a_batch_and_replays_add_nothing(spark, tmp_path):
    pdf = made_bars(NAMES, "2024-01-01", 20)
    bad = pdf.copy()
    bad.loc[3, "close"] = None
    inbox = str(tmp_path / "inbox")
    frame(spark, bad).withColumn("arrived", F.lit(1)).write.parquet(inbox)
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = spark.read.parquet(inbox).schema

    def run(checkpoint: str) -> None:
        stream = spark.readStream.schema(schema).parquet(inbox)
        land_stream(
            stream, lake, "vendor", "feed", date(2024, 6, 1), str(tmp_path / checkpoint), ["arrived"],
            datetime(2024, 6, 1),
        ).awaitTermination()

    run("a")
    assert (lake.bronze().count(), lake.quarantine().count()) == (len(pdf) - 1, 1)
    run("a")  # nothing new
    run("b")  # the batch replayed from scratch under the same name
    assert (lake.bronze().count(), lake.quarantine().count()) == (len(pdf) - 1, 1)
    frame(spark, pdf.iloc[[3]]).withColumn("arrived", F.lit(2)).write.mode("append").parquet(inbox)
    run("b")
    assert staged(lake.bronze()).count() == len(pdf)


def test_a_run_of_the_feed_arrives_in_parts_and_is_one_micro_batch(spark, tmp_path):
    pdf = made_bars(NAMES, "2024-01-01", 40)
    raw = frame(spark, pdf).withColumn("run", F.lit(1)).repartition(6)
    raw = raw.unionByName(raw.withColumn("run", F.lit(2)))
    inbox, lake = str(tmp_path / "inbox"), Lake(spark, str(tmp_path / "lake"))
    for run in (1, 2):
        lake_queries.arrive(raw, run, inbox)
        stream = spark.readStream.schema(raw.schema).parquet(inbox)
        land_stream(
            stream, lake, "vendor", "feed", date(2024, 6, 1), str(tmp_path / "cp"), ["run"], datetime(2024, 6, 1)
        ).awaitTermination()
        assert spark.read.parquet(inbox).where(F.col("run") == run).select(F.input_file_name()).distinct().count() == 6
    batches = lake.manifests().orderBy("run_id").collect()
    assert [(r["run_id"], r["rows_fetched"]) for r in batches] == [("feed-000000000", len(pdf)), ("feed-000000001", len(pdf))]


def test_trades_become_daily_bars(spark, tmp_path):
    rows = [
        ("AAA", datetime(2024, 1, 1, h), float(p)) for h, p in ((9, 10), (12, 14), (10, 8), (16, 11))
    ] + [("AAA", datetime(2024, 1, 2, 9), 12.0), ("AAA", datetime(2024, 1, 4, 9), 13.0), ("AAA", datetime(2024, 1, 4, 10), None)]
    trades = spark.createDataFrame(rows, "symbol string, ts timestamp, price double")
    one = trade_bars(trades, "symbol", "ts", "price").orderBy("date").first()
    assert (one["open"], one["high"], one["low"], one["close"], one["trades"]) == (10, 14, 8, 11, 4)
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    trades.write.parquet(inbox)
    bars = trade_bar_stream(spark.readStream.schema(trades.schema).parquet(inbox), "symbol", "ts", "price")
    for _ in range(2):  # the second run has nothing new
        keep_trade_bars(bars, out, str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.parquet(out).orderBy("date").collect()
    assert [(r["date"].day, r["close"], r["trades"]) for r in kept] == [(1, 11, 4), (2, 12, 1), (4, 13, 1)]
    late = [("AAA", datetime(2024, 1, 4, 11), 15.0), ("BBB", datetime(2024, 1, 4, 11), 1.0)]
    spark.createDataFrame(late, trades.schema).write.mode("append").parquet(inbox)
    keep_trade_bars(bars, out, str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.parquet(out).orderBy("date", "ticker").collect()
    assert [(r["ticker"], r["date"].day, r["close"]) for r in kept] == [
        ("AAA", 1, 11), ("AAA", 2, 12), ("AAA", 4, 15), ("BBB", 4, 1)
    ]


