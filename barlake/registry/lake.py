"""Queries that write and read back: lake, publishing, model artefacts, streams, the whole run."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.checks import CheckFailure, staged_report
from barlake.operators.linear import Linear
from barlake.operators.upsert import ForecastTable, KeyedTable, bar_table
from barlake.plans.ingest import ingest
from barlake.plans.marts import monthly_summary, volatility_features
from barlake.plans.pipeline import build_marts, run_daily, write_mart
from barlake.plans.publishing import existing_tables, export_gold, publish
from barlake.plans.scoring import latest_features, score, write_forecast_files
from barlake.plans.staging import staged
from barlake.plans.training import Champion, load_card, load_champion, train, write_artifacts
from barlake.registry import forecasting
from barlake.registry.forecasting import LINEAR, SCORED_AT, card, features_table, trained
from barlake.registry.relational import returns_feed, rounded
from barlake.schema import BAR_COLUMNS, REASON
from barlake.sources.bars import TableSource
from barlake.sources.feeds import (
    ARRIVAL,
    AS_OF,
    FEED,
    brands,
    landed_bars,
    quarantined_bars,
    raw_bars,
    table,
)
from barlake.sources.lake import Lake, MixedSources
from barlake.streaming.ingest import keep_trade_bars, land_stream, trade_bar_stream, trade_bars
from barlake.workspace import materialise, remove, small_frame, work_path

FEED_SETTINGS = replace(LINEAR, source=FEED, start_date=date(1995, 1, 1))
PERSISTENCE = Champion("naive", linear=Linear(-1, "naive", 0.0, (0.0, 1.0, 0.0)))


def new_lake(spark) -> Lake:
    return Lake(spark, work_path(spark, "lake"))


def feed_source(spark, sf) -> TableSource:
    return TableSource(FEED, raw_bars(spark, sf), ["run", *ARRIVAL])


def counted(frames: dict[str, DataFrame], label: str = "name") -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(label), "rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def q_lake_roundtrip(spark, sf):
    """All runs landed in one write, read back from bronze."""
    lake = new_lake(spark)
    lake.land(landed_bars(spark, sf))
    return rounded(lake.bronze().drop("ingested_at"))


def q_quarantine_counts(spark, sf):
    lake = new_lake(spark)
    lake.set_aside(quarantined_bars(spark, sf))
    return lake.quarantine().groupBy("run_id", "ingest_date", REASON).agg(
        F.count(F.lit(1)).alias("bars")
    )


def q_lake_sources(spark, sf):
    lake = new_lake(spark)
    lake.land(landed_bars(spark, sf))
    return lake.sources()


def q_lake_partition_pruning(spark, sf):
    """One ingest date of bronze: a partition filter, no other file is opened."""
    lake = new_lake(spark)
    lake.land(landed_bars(spark, sf))
    one_day = lake.bronze().where(F.col("ingest_date") == F.lit(date(2002, 1, 5)))
    return rounded(one_day.select(*BAR_COLUMNS))


def q_bronze_widened(spark, sf):
    """Bronze whose runs have volumes of five numeric types, read as one table."""
    lake, bars = new_lake(spark), materialise(landed_bars(spark, sf), "landed")
    types = {2: "int", 4: "bigint", 6: "decimal(12,2)", 3: "decimal(14,1)", 5: "float"}
    for run in range(1, 8):
        own = bars.where(F.col("run_id") == f"run-{run}")
        own = own.withColumn("volume", F.col("volume").cast(types.get(run, "double")))
        own.write.mode("append").partitionBy("ingest_date", "run_id").parquet(lake.bronze_path)
    return rounded(lake.bronze().drop("ingested_at"))


def q_lake_state(spark, sf):
    """Watermarks from the state that seven landings have advanced, and whether one built from bronze is the same."""
    lake, bars = new_lake(spark), materialise(landed_bars(spark, sf), "landed")
    lake.state()
    for run in range(1, 8):
        lake.land(bars.where(F.col("run_id") == f"run-{run}"))
    advanced = materialise(lake.watermarks(), "advanced")
    rebuilt = lake.rebuild_state().select("ticker", F.col("watermark").alias("rebuilt"))
    same = F.col("watermark").eqNullSafe(F.col("rebuilt")).alias("same")
    return advanced.join(rebuilt, "ticker", "full").select("ticker", "watermark", same)


def q_run_manifest(spark, sf):
    """The whole feed as one ingest run, and its manifest read back."""
    lake = new_lake(spark)
    run = ingest(lake, feed_source(spark, sf), brands(spark, sf), AS_OF, FEED_SETTINGS, "first")
    plan = spark.read.parquet(run["windows_path"])
    starts = [str(r["start"]) for r in plan.select("start").distinct().orderBy("start").collect()]
    return lake.manifests().select(
        "run_id",
        "source",
        "rows_fetched",
        "rows_landed",
        "rows_quarantined",
        "duplicates_dropped",
        F.lit(",".join(starts)).alias("window_starts"),
        F.lit(plan.count()).cast("int").alias("tickers"),
    )


def q_lake_idempotence(spark, sf):
    """The same day ingested twice: bronze grows by the re-fetched tail, staging does not change."""
    lake, source, tickers = new_lake(spark), feed_source(spark, sf), brands(spark, sf)
    ingest(lake, source, tickers, AS_OF, FEED_SETTINGS, "first", datetime(2002, 1, 1))
    ingest(lake, source, tickers, AS_OF, FEED_SETTINGS, "second", datetime(2002, 1, 2))
    bars = lake.bronze()
    by_run = bars.groupBy(F.col("run_id").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    keys = bars.select("ticker", "date").distinct()
    return by_run.unionByName(counted({"staged": staged(bars), "keys": keys}))


def q_gold_export(spark, sf):
    """Marts exported as compressed Parquet and read back; an absent mart is skipped."""
    root = work_path(spark, "gold")
    returns = materialise(returns_feed(spark, sf), "returns")
    marts = {
        "daily_returns": returns,
        "features_volatility": volatility_features(returns),
        "monthly_summary": monthly_summary(returns),
    }
    names = export_gold(marts, root)
    found = existing_tables(spark, {n: f"{root}/{n}" for n in [*names, "volatility_forecasts"]})
    return counted(found)


def q_publish_counts(spark, sf):
    """Dated snapshot and latest copy of two marts and a card, published twice."""
    target = work_path(spark, "published")
    returns = materialise(returns_feed(spark, sf), "returns")
    tables = {"daily_returns": returns, "monthly_summary": monthly_summary(returns)}
    for _ in range(2):
        written = publish(spark, tables, card("naive", "v1"), target, AS_OF)
    frames = {
        path.removeprefix(target): (
            spark.read.text(path) if "model_card" in path else spark.read.parquet(path)
        )
        for path in written
    }
    return counted(frames, "path")


def q_published_monthly(spark, sf):
    """The monthly summary as readers of the latest publication find it, after an older one and one that failed."""
    target = work_path(spark, "published")
    returns = materialise(returns_feed(spark, sf), "returns")
    whole = monthly_summary(returns)
    publish(spark, {"monthly_summary": whole.limit(3)}, None, target, AS_OF - timedelta(days=1))
    publish(spark, {"monthly_summary": whole}, card("naive", "v1"), target, AS_OF)
    broken = whole.select(F.raise_error(F.lit("lost on the way")).alias("ticker"))
    try:
        publish(spark, {"monthly_summary": whole.limit(1), "daily_returns": broken}, None, target, AS_OF)
    except Exception as lost:  # noqa: BLE001
        if "lost on the way" not in str(lost):
            raise
    return rounded(spark.read.parquet(f"{target}/gold/monthly_summary/latest"))


def q_marts_after_failure(spark, sf):
    """Rows of each mart as readers find them when a later build breaks a check: those of the build before."""
    lake = new_lake(spark)
    lake.land(landed_bars(spark, sf))
    marts = build_marts(lake, FEED_SETTINGS)
    spoiled = lake.mart("staged").withColumn("adj_close", F.when(F.col("ticker") > "BRAND.3", F.col("adj_close")))
    try:
        write_mart(lake, spoiled, "staged", staged_report)
    except CheckFailure:
        return counted({name: lake.mart(name).where("adj_close is not null" if name == "staged" else "true") for name in marts})
    raise AssertionError("a broken table was committed")


def q_forecast_files(spark, sf):
    """Forecasts dropped as files under their newest session and version, twice."""
    path = work_path(spark, "forecast-files")
    features = features_table(spark, sf)
    scored = materialise(
        score(latest_features(features), PERSISTENCE, card("naive", "v1"), SCORED_AT), "scored"
    )
    for _ in range(2):
        write_forecast_files(scored, path)
    files = spark.read.schema(
        "ticker string, scored_session date, forecast_vol double, as_of_date date, model_version string"
    ).parquet(path)
    return rounded(files)


def q_cv_artifacts(spark, sf):
    """Validation files of the whole training run, written and read back: rows per file."""
    _, result = trained(spark, sf)
    path = work_path(spark, "evaluation")
    write_artifacts(result, path)
    return counted(
        {
            "cv_folds": spark.read.csv(f"{path}/cv_folds", header=True),
            "cv_summary": spark.read.csv(f"{path}/cv_summary", header=True),
            "oos_predictions": spark.read.parquet(f"{path}/oos_predictions"),
        }
    )


def q_cv_files_by_value(spark, sf):
    """The same files: what those of persistence and HAR say of every fold, and the predictions' sums of each model."""
    _, result = trained(spark, sf)
    path = work_path(spark, "evaluation")
    write_artifacts(result, path)
    folds = spark.read.csv(f"{path}/cv_folds", header=True, inferSchema=True).where("model <> 'trees'")
    rows = spark.read.parquet(f"{path}/oos_predictions").where("model <> 'trees'")
    sums = rows.groupBy("fold", "model").agg(F.count(F.lit(1)).alias("predictions"), F.avg("y_pred_log").alias("mean_prediction"))
    counts = [F.col(c).cast("long").alias(c) for c in ("train_rows", "test_rows")]
    return rounded(folds.select("fold", "model", *counts, "qlike", "rmse_log").join(sums, ["fold", "model"]))


def q_model_card(spark, sf):
    """The card of the model trained on all rows with all candidates: gate, data profile, scores of the linear ones."""
    _, result = trained(spark, sf)
    c = result.card
    row = (
        ",".join(sorted(c["cv"])),
        c["promoted"],
        c["data"]["rows"],
        c["data"]["n_tickers"],
        c["data"]["start"],
        c["data"]["end"],
        ",".join(sorted(r[0] for r in spark.read.parquet(c["data"]["tickers_path"]).collect())),
        c["cv"]["naive"]["qlike_mean"],
        c["cv"]["har"]["rmse_log_mean"],
        len(c["reference_profile"]),
    )
    schema = (
        "candidates string, promoted boolean, rows long, n_tickers long, start string, end string, "
        "tickers string, naive_qlike double, har_rmse double, profiled int"
    )
    return small_frame(spark, [row], schema)


def q_model_reload(spark, sf):
    """Forecasts of the promoted model after reading it back from its card."""
    settings = replace(LINEAR, candidates=("naive", "har"), min_improvement=-1.0)
    models = work_path(spark, "models")
    features = features_table(spark, sf)
    train(features, models, settings, version="v1")
    if load_card(spark, models) is None:
        return small_frame(spark, [], "ticker string, model_name string, forecast_vol double")
    champion, loaded = load_champion(spark, models)
    scored = score(latest_features(features), champion, loaded, SCORED_AT)
    return rounded(scored.select("ticker", "model_name", "forecast_vol"))


def q_pipeline_summary(spark, sf):
    """The whole run over the feed, every candidate: ingest, marts with checks, train, score, monitor, publish."""
    lake = new_lake(spark)
    whole = forecasting.WHOLE
    settings = replace(FEED_SETTINGS, candidates=whole.candidates, trees=whole.trees, min_improvement=-1.0)
    summary = run_daily(
        lake,
        feed_source(spark, sf),
        brands(spark, sf),
        AS_OF,
        settings,
        publish_to=f"{lake.root}/published",
        now=datetime(2002, 1, 2),
    )
    marts = ["staged", "daily_returns", "features_volatility", "monthly_summary"]
    forecasts = ForecastTable(spark, lake.mart_path("volatility_forecasts")).read()
    counts = counted(
        {name: lake.mart(name) for name in marts}
        | {"bronze": lake.bronze(), "quarantine": lake.quarantine(), "forecasts": forecasts}
    )
    steps = [("landed", summary["landed"]), ("published", summary.get("published", 0))]
    return counts.unionByName(small_frame(spark, steps, "name string, rows long"))


def streamed(spark, sf) -> Lake:
    """The raw feed as a file stream into a lake."""
    lake = new_lake(spark)
    inbox = work_path(spark, "inbox")
    raw_bars(spark, sf).write.partitionBy("run").parquet(inbox)
    schema = spark.read.parquet(inbox).schema
    stream = spark.readStream.schema(schema).parquet(inbox)
    query = land_stream(
        stream,
        lake,
        FEED,
        "feed",
        AS_OF,
        work_path(spark, "stream-checkpoint"),
        ["run", *ARRIVAL],
        datetime(2002, 1, 1),
    )
    query.awaitTermination()
    return lake


_streamed: dict[tuple, tuple[Lake, KeyedTable]] = {}


def streamed_by_run(spark, sf) -> tuple[Lake, KeyedTable]:
    """The feed as a file stream of a micro-batch per run, whose last batch is replayed as after a failure. Queries of
    one application share it."""
    key = spark.sparkContext.applicationId, sf
    if key not in _streamed:
        _streamed[key] = _stream_by_run(spark, sf)
    return _streamed[key]


def arrive(raw: DataFrame, run: int, inbox: str) -> None:
    """The files of one run, from as many tasks as the feed has parts."""
    raw.where(F.col("run") == run).write.mode("append").parquet(inbox)


def _stream_by_run(spark, sf) -> tuple[Lake, KeyedTable]:
    lake, bars = new_lake(spark), bar_table(spark, work_path(spark, "current-bars"))
    inbox, checkpoint = work_path(spark, "inbox"), work_path(spark, "stream-checkpoint")
    raw = materialise(raw_bars(spark, sf), "raw")

    def run_stream():
        stream = spark.readStream.schema(raw.schema).parquet(inbox)
        land_stream(
            stream, lake, FEED, "feed", AS_OF, checkpoint, ["run", *ARRIVAL], datetime(2002, 1, 1), bars
        ).awaitTermination()

    for run in range(1, 8):  # the stream goes on where it stopped: its next micro-batch is all files of the run
        arrive(raw, run, inbox)
        run_stream()
    remove(spark, f"{checkpoint}/commits/6")  # as if the driver was lost before the last batch was committed
    remove(spark, f"{checkpoint}/commits/.6.crc")
    run_stream()
    return lake, bars


def q_stream_keep_last(spark, sf):
    """The current bar of every ticker and session after seven micro-batches, the last one replayed."""
    _, bars = streamed_by_run(spark, sf)
    return rounded(bars.read())


def q_stream_batches(spark, sf):
    """What the manifests say of the micro-batches, and the bars that bronze holds of each."""
    lake, _ = streamed_by_run(spark, sf)
    held = lake.bronze().groupBy("run_id").agg(F.count(F.lit(1)).alias("bars"))
    counts = ("rows_fetched", "rows_landed", "rows_quarantined", "duplicates_dropped")
    return lake.manifests().select("run_id", *counts).join(held, "run_id", "left")


def q_stream_ingest_counts(spark, sf):
    """Rows landed, quarantined and staged by the stream."""
    lake = streamed(spark, sf)
    return counted(
        {"bronze": lake.bronze(), "quarantine": lake.quarantine(), "staged": staged(lake.bronze())}
    )


def q_stream_ingest(spark, sf):
    """The bars the stream has landed."""
    return rounded(streamed(spark, sf).bronze().select(*BAR_COLUMNS, "source", "ingest_date", "run_id"))


def q_stream_manifest(spark, sf):
    """What the stream's manifest says of its batch."""
    counts = ("rows_fetched", "rows_landed", "rows_quarantined", "duplicates_dropped")
    return streamed(spark, sf).manifests().select("run_id", "source", *counts)


def q_other_vendor_refused(spark, sf):
    """A lake with the feed's bars: whether a batch run and a stream of another vendor are refused."""
    lake = new_lake(spark)
    lake.land(landed_bars(spark, sf))
    other = TableSource("other", raw_bars(spark, sf), ["run", *ARRIVAL])

    def stream():
        land_stream(raw_bars(spark, sf), lake, "other", "s", AS_OF, "", ["run"], datetime(2002, 1, 1))

    def refused(attempt) -> bool:
        try:
            attempt()
        except MixedSources:
            return True
        return False

    batch = refused(lambda: ingest(lake, other, brands(spark, sf), AS_OF, FEED_SETTINGS))
    rows = [("batch", batch, lake.bronze().count()), ("stream", refused(stream), lake.bronze().count())]
    return small_frame(spark, rows, "path string, refused boolean, bars long")


def q_model_in_use(spark, sf):
    """Versions v9 and then v10 are promoted: forecasts are those of v10, the last."""
    settings = replace(LINEAR, candidates=("naive", "har"), min_improvement=-1.0)
    models = work_path(spark, "models")
    features = features_table(spark, sf)
    for version in ("v9", "v10"):
        train(features, models, settings, version=version)
    if load_card(spark, models) is None:
        return small_frame(spark, [], "ticker string, model_version string, forecast_vol double")
    champion, loaded = load_champion(spark, models)
    scored = score(latest_features(features), champion, loaded, SCORED_AT)
    return rounded(scored.select("ticker", "model_version", "forecast_vol"))


def q_event_bars(spark, sf):
    events = table(spark, sf, "events")
    return rounded(trade_bars(events, "event_type", "ts", "value"))


def q_event_bars_stream(spark, sf):
    """The same bars over a stream, kept in a table by key, days that are still open included."""
    out = work_path(spark, "event-bars")
    schema = table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema)
        .parquet(f"{sf}/events.parquet*")
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    bars = trade_bar_stream(events, "event_type", "ts", "value")
    keep_trade_bars(bars, out, work_path(spark, "event-checkpoint")).awaitTermination()
    return rounded(spark.read.schema(bars.schema).parquet(out))
