"""Gold tables to compressed Parquet: a local export, a dated snapshot and the latest copy."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barlake.workspace import move, read_table, remove, small_frame, table_exists

PUBLISHED = T.StructType([T.StructField(name, T.StringType()) for name in ("snapshot", "published_at", "path")])
GOLD_TABLES = ["daily_returns", "features_volatility", "monthly_summary", "volatility_forecasts"]


def existing_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The gold tables that were built so far."""
    return {
        name: spark.read.parquet(paths[name])
        for name in GOLD_TABLES
        if name in paths and table_exists(spark, paths[name])
    }


def write_gold(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def export_gold(tables: Mapping[str, DataFrame], path: str) -> list[str]:
    for name, df in tables.items():
        write_gold(df, f"{path}/{name}")
    return list(tables)


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    card: dict | None,
    target: str,
    snapshot: date,
) -> list[str]:
    """Every table and the card twice under ``target`` (any Hadoop URI): pinned by date, and latest.

    All are written aside first and put in place when the last one is written, so a failure on the way leaves what
    readers see as it was; then the publication is noted under ``gold/_published``. A repeat on the same day replaces
    its own snapshot only.
    """
    aside = f"{target}/gold/_aside/{uuid.uuid4().hex}"
    keys = (f"snapshot_date={snapshot}", "latest")
    written = []
    for key in keys:
        for name, df in tables.items():
            write_gold(df, f"{aside}/{name}/{key}")
            written.append(f"{name}/{key}")
        if card is not None:
            row = small_frame(spark, [(json.dumps(card),)], "value string").coalesce(1)
            row.write.mode("overwrite").text(f"{aside}/model_card/{key}")
            written.append(f"model_card/{key}")
    for own in written:
        move(spark, f"{aside}/{own}", f"{target}/gold/{own}")
    remove(spark, aside)
    note = [(str(snapshot), datetime.now(UTC).isoformat(timespec="microseconds"), own) for own in written]
    noted = small_frame(spark, note, "snapshot string, published_at string, path string").coalesce(1)
    noted.write.mode("append").json(f"{target}/gold/_published")
    return [f"{target}/gold/{own}" for own in written]


def published(spark: SparkSession, target: str) -> DataFrame:
    """What was published, and when: snapshot, published_at, path."""
    return read_table(spark, f"{target}/gold/_published", PUBLISHED, "json")
