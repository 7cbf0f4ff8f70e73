"""Bar sources: anything that can hand over typed bars for planned fetch windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import BAR_COLUMNS, BAR_SCHEMA
from barlake.workspace import small_frame


class BarSource(Protocol):
    """``fetch`` returns bars in [start, end) per planned ticker, plus the arrival columns.

    ``windows`` has one row per ticker: (ticker, start). Arrival columns order the copies a vendor may
    return for one (date, ticker); Spark rows have no order of their own.
    """

    name: str
    arrival: Sequence[str]

    def fetch(self, windows: DataFrame, earliest: date, end: date) -> DataFrame: ...


def empty_bars(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BAR_SCHEMA)


@dataclass(frozen=True)
class TableSource:
    """Bars that already sit in a table (files in any Spark format, a catalog table, a view)."""

    name: str
    table: DataFrame
    arrival: Sequence[str] = field(default_factory=lambda: ["date"])

    def fetch(self, windows: DataFrame, earliest: date, end: date) -> DataFrame:
        """Literal date bounds reach the scan; the per-ticker start is an equi join on ticker."""
        in_bounds = self.table.where((F.col("date") >= F.lit(earliest)) & (F.col("date") < F.lit(end)))
        return in_bounds.join(windows, "ticker").where("date >= start").drop("start")


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Fetched frames as one, projected to the bar columns."""
    return reduce(DataFrame.unionByName, [f.select(*BAR_COLUMNS) for f in frames])


def missing_tickers(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """Requested tickers for which nothing came back."""
    return requested.select("ticker").distinct().join(
        returned.select("ticker").distinct(), "ticker", "left_anti"
    )


def normalise_tickers(raw: DataFrame) -> DataFrame:
    """Trimmed, upper-cased, distinct tickers without blanks."""
    return (
        raw.select(F.upper(F.trim("ticker")).alias("ticker")).where("ticker != ''").distinct()
    )


def ticker_frame(spark: SparkSession, tickers: Sequence[str]) -> DataFrame:
    """A configured ticker list as a table; an empty list is a mistake in the configuration."""
    cleaned = sorted({t.strip().upper() for t in tickers} - {""})
    if not cleaned:
        raise ValueError("at least one ticker is required")
    return small_frame(spark, [(t,) for t in cleaned], "ticker string")
