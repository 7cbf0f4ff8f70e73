"""Typed, deduplicated bars: the latest landed observation of each (ticker, date)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import whole
from barlake.operators.latest import latest_by


def staged(bronze: DataFrame) -> DataFrame:
    """Re-landing the same sessions any number of times leaves this table unchanged."""
    typed = bronze.select(
        F.col("ticker").cast("string").alias("ticker"),
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "adj_close")],
        whole(F.col("volume")).alias("volume"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        F.col("source").cast("string").alias("source"),
        F.col("run_id").cast("string").alias("run_id"),
    )
    return latest_by(
        typed, ["date", "ticker"], [F.col("ingested_at").desc(), F.col("run_id").desc()]
    )
