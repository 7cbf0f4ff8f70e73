"""The bar contract and landing as a file stream, and trades to daily bars."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.upsert import KeyedTable
from barlake.plans.ingest import land_batch
from barlake.schema import BAR_COLUMNS, BAR_SCHEMA
from barlake.sources.lake import Lake
from barlake.workspace import materialise, read_table


def land_stream(
    bars: DataFrame,
    lake: Lake,
    source: str,
    stream: str,
    as_of: date,
    checkpoint: str,
    arrival: Sequence[str],
    ingested_at: datetime,
    current: KeyedTable | None = None,
) -> StreamingQuery:
    """Land each micro-batch under its own run id, through the same steps as the batch ingest, with a manifest.

    The run id is the stream's name and batch number, and a run replaces only its own partition: a batch
    replayed after a failure writes the same files again instead of adding rows. Batch numbers restart
    with a new checkpoint, so a new checkpoint needs a new stream name. Another vendor's lake is refused before
    the stream starts.

    ``current`` is kept up to date with the last bar of every ticker and session over all batches, by merging each
    batch's landed bars into the months they touch; a replayed batch merges the same bars again.
    """
    lake.refuse_other_sources(source)

    def land(batch: DataFrame, number: int) -> None:
        clock = time.perf_counter()
        run = {"run_id": f"{stream}-{number:09d}", "source": source}
        extra = [c for c in arrival if c not in BAR_COLUMNS]
        run = land_batch(lake, batch.select(*BAR_COLUMNS, *extra), list(arrival), run, as_of, ingested_at)
        if current is not None and run["rows_landed"]:
            current.upsert(read_table(lake.spark, run["bronze_path"], BAR_SCHEMA))
        lake.write_manifest(run | {"duration_s": round(time.perf_counter() - clock, 2)})

    return (
        bars.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def trade_bars(trades: DataFrame, key: str, ts: str, price: str) -> DataFrame:
    """Daily bars from trades: first, highest, lowest and last price, and the number of trades.

    Batch form; all aggregates combine before the shuffle, so a key with most of the trades is no hot
    spot.
    """
    return (
        trades.where(F.col(price).isNotNull())
        .groupBy(F.col(key).alias("ticker"), F.col(ts).cast("date").alias("date"))
        .agg(*_bar_aggregates(ts, price))
    )


def trade_bar_stream(
    trades: DataFrame, key: str, ts: str, price: str, lateness: str = "1 day"
) -> DataFrame:
    """The same bars over a stream: one-day tumbling windows, whose state is dropped once the watermark has
    passed. In update mode a day that is still open comes out as well, and again whenever it changes."""
    return (
        trades.where(F.col(price).isNotNull())
        .withWatermark(ts, lateness)
        .groupBy(F.col(key).alias("ticker"), F.window(ts, "1 day").alias("day"))
        .agg(*_bar_aggregates(ts, price))
        .withColumn("date", F.col("day.start").cast("date"))
        .drop("day")
    )


def keep_trade_bars(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a table with the newest state of every bar of ``trade_bar_stream``, partitioned by date.

    Each micro-batch replaces the bars it brings in the dates it touches, so open days are in the table too, and
    a replayed batch changes nothing. The dates of a batch are bounded by the calendar.
    """
    spark, schema = bars.sparkSession, bars.schema

    def merge(batch: DataFrame, number: int) -> None:
        new = materialise(batch, "new-bars")
        touched = [r[0] for r in new.select("date").distinct().collect()]
        if not touched:
            return
        old = read_table(spark, path, schema).where(F.col("date").isin(touched))
        stays = old.join(new.select("ticker", "date"), ["ticker", "date"], "left_anti")
        merged = materialise(stays.select(*new.columns).unionByName(new), "merged-bars")
        (
            merged.hint("rebalance", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(path)
        )

    return (
        bars.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def _bar_aggregates(ts: str, price: str) -> list:
    return [
        F.min_by(price, ts).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, ts).alias("close"),
        F.count(F.lit(1)).alias("trades"),
    ]
