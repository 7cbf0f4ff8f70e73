"""Returns, volatility features with a forward target, and the monthly summary.

All per-ticker expressions share one window specification, so returns, features and the monthly summary
of one plan cost one exchange and one sort on the ticker. The input has one row per (ticker, date), so a
ticker's group is never larger than the calendar, whatever the number of raw observations behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.columns import annualised_vol, iso_weekday, parkinson_vol, whole

FEATURE_COLUMNS = [
    "ticker",
    "date",
    "log_return",
    "abs_return_1d",
    "overnight_gap",
    "rv_5d",
    "rv_21d",
    "rv_63d",
    "parkinson_5d",
    "parkinson_21d",
    "momentum_21d",
    "volume_z_21d",
    "market_rv_21d",
    "relative_rv_21d",
    "day_of_week",
    "target_rv_fwd",
    "is_labeled",
]


def by_date() -> WindowSpec:
    """The one window all per-ticker expressions share."""
    return Window.partitionBy("ticker").orderBy("date")


def daily_returns(staged: DataFrame) -> DataFrame:
    """Bars with returns on the adjusted close, the intraday range and the overnight gap."""
    bars = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    before = F.lag("adj_close").over(by_date())
    close_before = F.lag("close").over(by_date())
    return (
        staged.select(*bars, before.alias("_before"), close_before.alias("_close_before"))
        .select(
            *bars,
            F.ln(F.col("adj_close") / F.col("_before")).alias("log_return"),
            (F.col("adj_close") / F.col("_before") - 1).alias("simple_return"),
            (F.col("close") - F.col("open")).alias("price_change"),
            F.ln(F.col("high") / F.col("low")).alias("log_range"),
            F.ln(F.col("open") / F.col("_close_before")).alias("overnight_gap"),
        )
    )


def ticker_features(
    returns: DataFrame, horizon: int = 5, trading_days: int = 252, min_history: int = 63
) -> DataFrame:
    """Everything that needs one ticker's history only; rows with too little history are dropped."""

    def trailing(rows: int):
        return by_date().rowsBetween(-rows + 1, 0)

    ahead = by_date().rowsBetween(1, horizon)
    r, span = F.col("log_return"), F.col("log_range")
    log_volume = F.ln(F.col("volume") + 1)
    spread = F.nullif(F.stddev_samp(log_volume).over(trailing(21)), F.lit(0.0))
    z = (log_volume - F.avg(log_volume).over(trailing(21))) / spread
    complete = F.count(F.lit(1)).over(ahead) == horizon
    return (
        returns.where(r.isNotNull())
        .select(
            "ticker",
            "date",
            "log_return",
            F.abs(r).alias("abs_return_1d"),
            "overnight_gap",
            annualised_vol(r, trailing(5), trading_days).alias("rv_5d"),
            annualised_vol(r, trailing(21), trading_days).alias("rv_21d"),
            annualised_vol(r, trailing(63), trading_days).alias("rv_63d"),
            parkinson_vol(span, trailing(5), trading_days).alias("parkinson_5d"),
            parkinson_vol(span, trailing(21), trading_days).alias("parkinson_21d"),
            F.sum(r).over(trailing(21)).alias("momentum_21d"),
            F.coalesce(z, F.lit(0.0)).alias("volume_z_21d"),
            F.row_number().over(by_date()).alias("_history"),
            F.when(complete, annualised_vol(r, ahead, trading_days)).alias("target_rv_fwd"),
            complete.alias("is_labeled"),
        )
        .where(F.col("_history") >= min_history)
        .drop("_history")
    )


def market_level(seasoned: DataFrame) -> DataFrame:
    """Mean 21-session volatility per session over the tickers with enough history.

    A partial-aggregated group-by: a window over the date would put every ticker of a session into
    one task.
    """
    return seasoned.groupBy("date").agg(F.avg("rv_21d").alias("market_rv_21d"))


def with_market(seasoned: DataFrame) -> DataFrame:
    """Join the market level back. One row per calendar date is a proven bound, so it is broadcast."""
    level = F.nullif(F.col("market_rv_21d"), F.lit(0.0))
    return (
        seasoned.join(F.broadcast(market_level(seasoned)), "date")
        .withColumn("relative_rv_21d", F.col("rv_21d") / level)
        .withColumn("day_of_week", iso_weekday(F.col("date")))
        .select(*FEATURE_COLUMNS)
    )


def volatility_features(
    returns: DataFrame, horizon: int = 5, trading_days: int = 252, min_history: int = 63
) -> DataFrame:
    """One row per seasoned (ticker, date): features known on that day and the forward target.

    ``returns`` is read twice (the market level needs three of its columns); hand over a written table
    where it is costly to derive.
    """
    return with_market(ticker_features(returns, horizon, trading_days, min_history))


def monthly_summary(returns: DataFrame, trading_days: int = 252) -> DataFrame:
    """Performance per ticker and month. Over lazily derived returns this needs no further exchange."""
    up = F.sum(F.when(F.col("simple_return") > 0, 1).otherwise(0)).cast("double")
    days = F.count(F.lit(1))
    return (
        returns.where(F.col("log_return").isNotNull())
        .groupBy("ticker", F.trunc("date", "month").alias("month"))
        .agg(
            days.alias("trading_days"),
            (F.exp(F.sum("log_return")) - 1).alias("monthly_return"),
            (F.sqrt(F.lit(float(trading_days))) * F.stddev_samp("log_return")).alias("realised_vol"),
            F.min("low").alias("month_low"),
            F.max("high").alias("month_high"),
            whole(F.avg("volume")).alias("avg_daily_volume"),
            (up / days).alias("pct_up_days"),
        )
    )
