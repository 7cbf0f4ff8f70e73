"""Keyed upsert into Parquet tables partitioned by month: the later write wins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.latest import latest_by
from barlake.schema import BAR_SCHEMA, FORECAST_KEY, FORECAST_SCHEMA
from barlake.workspace import materialise, read_table


@dataclass(frozen=True)
class KeyedTable:
    """One row per key. ``day`` is the date column whose month is the partition: a file a day would be a file per
    session of a few rows. ``newest`` orders rows of one key within a batch."""

    spark: SparkSession
    path: str
    schema: T.StructType = FORECAST_SCHEMA
    key: Sequence[str] = tuple(FORECAST_KEY)
    day: str = "as_of_date"
    newest: Sequence[str] = ("scored_at",)

    @property
    def month(self) -> str:
        return f"{self.day}_month"

    def _stored(self) -> DataFrame:
        return read_table(self.spark, self.path, T.StructType([*self.schema.fields, T.StructField(self.month, T.StringType())]))

    def read(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """The rows, all or those of some days: whole months outside of these are not opened."""
        rows = self._stored()
        if since is not None:
            rows = rows.where((F.col(self.month) >= F.lit(f"{since:%Y-%m}")) & (F.col(self.day) >= F.lit(since)))
        if until is not None:
            rows = rows.where((F.col(self.month) <= F.lit(f"{until:%Y-%m}")) & (F.col(self.day) <= F.lit(until)))
        return rows.select(*self.schema.fieldNames())

    def upsert(self, batch: DataFrame) -> None:
        """Rewrite only the months the batch touches.

        The merged rows go to the shared folder first: a path must not be overwritten while it is read,
        and an interrupted overwrite can be repeated from the copy. The touched months are bounded by the
        calendar, and as literals they prune the existing table to its own partitions.
        """
        month = F.date_format(self.day, "yyyy-MM").alias(self.month)
        batch = materialise(batch.select(*self.schema.fieldNames(), month), "upsert-batch")
        touched = [r[0] for r in batch.select(self.month).distinct().collect()]
        if not touched:
            return
        existing = self._stored().where(F.col(self.month).isin(touched))
        both = existing.withColumn("_batch", F.lit(0)).unionByName(
            batch.withColumn("_batch", F.lit(1))
        )
        order = [F.col("_batch").desc(), *[F.col(c).desc() for c in self.newest]]
        merged = materialise(latest_by(both, self.key, order).drop("_batch"), "upsert-merge")
        (
            merged.hint("rebalance", self.month)  # a month's rows together, a large month in parts
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.month)
            .parquet(self.path)
        )


class ForecastTable(KeyedTable):
    """Forecasts, one row per (ticker, as_of_date, model_version)."""


def bar_table(spark: SparkSession, path: str) -> KeyedTable:
    """The current bar of every ticker and session."""
    return KeyedTable(spark, path, BAR_SCHEMA, ("ticker", "date"), "date", ())
