"""A vendor-like daily-bar feed derived from order lines, for data sets that hold no market data.

One raw bar per (line, part): the ticker is the brand, the session is the ship date, and the line number is
the ingest run, so a (run, date, ticker) may hold several observations. Some quantities stand for bad
vendor rows (a missing close, a negative close, an inverted bar).
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.contract import flag_bars, rejected_rows, valid_rows
from barlake.operators.latest import keep_last
from barlake.schema import BAR_COLUMNS

FEED = "derived"
AS_OF = date(2002, 1, 1)
FIRST_LANDING = datetime(2002, 1, 1)
NOW = FIRST_LANDING + timedelta(days=11)
ARRIVAL = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def brand_ticker(brand: str | Column = "p_brand") -> Column:
    return F.upper(F.replace(brand, F.lit("#"), F.lit(".")))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with their run and the columns that order arrivals within a run."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    price, quantity = F.col("p_retailprice"), F.col("l_quantity")
    close = (
        F.when(quantity == 50, None)
        .when(quantity == 49, -1.0)
        .otherwise(price * (1 + F.col("l_tax") - 0.04))
    )
    high = F.when(quantity == 48, price * 0.4).otherwise(price * (1.05 + F.col("l_tax") / 4))
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_shipdate").cast("date").alias("date"),
        brand_ticker().alias("ticker"),
        (price * (1 - F.col("l_discount") + 0.04)).alias("open"),
        high.alias("high"),
        (price * (0.93 - F.col("l_discount") / 10)).alias("low"),
        close.alias("close"),
        close.alias("adj_close"),
        (quantity * 100 + F.col("l_linenumber") / 2.0).alias("volume"),
        F.col("l_linenumber").alias("run"),
        *ARRIVAL,
    )


def fetched_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last arrival of each (run, date, ticker)."""
    raw = raw_bars(spark, sf_dir)
    return keep_last(raw, ["date", "ticker", "run"], ARRIVAL).select(*BAR_COLUMNS, "run")


def flagged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_bars(fetched_bars(spark, sf_dir), AS_OF, keys_unique=True)


def with_lineage(bars: DataFrame) -> DataFrame:
    """Landing columns from the run number: run n is landed n days after the first date."""
    landed_on = F.date_add(F.lit(FIRST_LANDING.date()), F.col("run"))
    return bars.withColumns(
        {
            "ingested_at": landed_on.cast("timestamp_ntz"),
            "source": F.lit(FEED),
            "ingest_date": landed_on,
            "run_id": F.concat(F.lit("run-"), F.col("run").cast("string")),
        }
    ).drop("run")


def landed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all runs put into bronze."""
    return with_lineage(valid_rows(flagged_bars(spark, sf_dir), ["run"]))


def quarantined_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lineage(rejected_rows(flagged_bars(spark, sf_dir)))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticker universe of the feed."""
    return table(spark, sf_dir, "part").select(brand_ticker().alias("ticker")).distinct()
