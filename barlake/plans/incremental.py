"""The features mart brought up to date around the sessions that a run touched, in place of a rebuild.

A bar reaches only so far: its own return and the next one, the trailing windows of the 63 sessions after it, and the
forward targets of ``horizon`` sessions before it. So a run changes one span of sessions per touched ticker, which is
recomputed from the bars around it, and the market level of the days in these spans, which all tickers of the day
share. Other days are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.upsert import KeyedTable
from barlake.plans.marts import FEATURE_COLUMNS, by_date, daily_returns, ticker_features, with_market
from barlake.workspace import materialise

#: Sessions of the longest trailing window.
LONGEST = 63
MARKET_COLUMNS = ["market_rv_21d", "relative_rv_21d", "day_of_week"]


def feature_table(spark: SparkSession, path: str, schema: T.StructType) -> KeyedTable:
    """The features of every ticker and session, by month."""
    return KeyedTable(spark, path, schema, ("ticker", "date"), "date", ())


def touched_spans(bars: DataFrame, touched: DataFrame, horizon: int = 5, min_history: int = LONGEST) -> DataFrame:
    """For every ticker of ``touched`` (ticker, date): ``first`` to ``last``, the sessions whose features its touched
    bars can change, and ``read_from`` to ``read_to``, the bars that these are computed from.

    Two columns of the touched tickers are read; sessions are counted, not days, so gaps in a ticker's calendar
    don't matter.
    """
    history = max(LONGEST, min_history)
    sessions = bars.select("ticker", "date").join(touched.select("ticker").distinct(), "ticker", "left_semi")
    sessions = sessions.withColumn("n", F.row_number().over(by_date()))
    changed = sessions.join(touched.select("ticker", "date").distinct(), ["ticker", "date"])
    changed = changed.groupBy("ticker").agg((F.min("n") - horizon - 1).alias("low"), (F.max("n") + history + 1).alias("high"))
    inside = F.col("n").between(F.col("low"), F.col("high"))
    near = F.col("n").between(F.col("low") - history - 2, F.col("high") + horizon)
    return (
        sessions.join(changed, "ticker")
        .where(near)
        .groupBy("ticker")
        .agg(
            F.min("date").alias("read_from"),
            F.max("date").alias("read_to"),
            F.min(F.when(inside, F.col("date"))).alias("first"),
            F.max(F.when(inside, F.col("date"))).alias("last"),
        )
    )


def remade_features(
    table: KeyedTable,
    bars: DataFrame,
    touched: DataFrame,
    horizon: int = 5,
    trading_days: int = 252,
    min_history: int = LONGEST,
) -> DataFrame:
    """All rows of the days on which features change, as a rebuild from ``bars`` would have them.

    ``bars`` are the staged bars after the run, ``touched`` the (ticker, date) of what it landed, in any number and
    order; ``table`` holds the features from before. Bars are replaced or added, never withdrawn, and their prices are
    positive, as the row contract asks.
    """
    spans = materialise(touched_spans(bars, touched, horizon, min_history), "spans")
    ends = spans.agg(F.min("read_from"), F.max("read_to"), F.min("first"), F.max("last")).head()
    if ends[0] is None:
        return bars.sparkSession.createDataFrame([], table.schema)
    read_from, read_to, first, last = ends
    near = bars.where(F.col("date").between(F.lit(read_from), F.lit(read_to))).join(spans, "ticker")
    near = near.where(F.col("date").between(F.col("read_from"), F.col("read_to"))).select(*bars.columns)
    span = spans.select("ticker", "first", "last")
    within = F.col("date").between(F.col("first"), F.col("last"))
    own = [c for c in FEATURE_COLUMNS if c not in MARKET_COLUMNS]
    fresh = ticker_features(daily_returns(near), horizon, trading_days, min_history).join(span, "ticker").where(within)
    fresh = materialise(fresh.select(*own), "fresh")
    # the other tickers of these days, for the market level; a day is one row of the broadcast table
    held = table.read(first, last).join(F.broadcast(fresh.select("date").distinct()), "date", "left_semi")
    held = held.join(span, "ticker", "left").where(F.col("first").isNull() | ~within).select(*own)
    return with_market(materialise(held.unionByName(fresh), "seasoned"))


def update_features(table: KeyedTable, bars: DataFrame, touched: DataFrame, **windows: int) -> None:
    """Put the changed days into the mart; only their months are rewritten. A repeated call changes nothing."""
    table.upsert(remade_features(table, bars, touched, **windows))
