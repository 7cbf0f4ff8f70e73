"""Table checks: each counts its offending rows, and a suite is one small report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.columns import annualised_vol, utc_literal


class CheckFailure(RuntimeError):
    """At least one table check found offending rows."""


@dataclass(frozen=True)
class RowCheck:
    name: str
    offends: Column


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null({column})", F.col(column).isNull())


def in_range(column: str, low: float | None = None, high: float | None = None) -> RowCheck:
    """Non-null values outside the inclusive range."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    bounds = f"{'' if low is None else low},{'' if high is None else high}"
    return RowCheck(f"in_range({column},{bounds})", F.col(column).isNotNull() & outside)


def ohlc_consistent(tolerance: float = 1e-6) -> RowCheck:
    high_low = F.col("high") < F.greatest("open", "close") * (1 - tolerance)
    low_high = F.col("low") > F.least("open", "close") * (1 + tolerance)
    return RowCheck("ohlc_consistent", high_low | low_high)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def leaking_targets(features: DataFrame, horizon: int = 5, trading_days: int = 252) -> DataFrame:
    """Rows whose target differs from the trailing volatility seen ``horizon`` sessions later.

    The trailing volatility is recomputed over exactly ``horizon`` returns, so the guard means
    something for any horizon.
    """
    by_date = Window.partitionBy("ticker").orderBy("date")
    trailing = annualised_vol(
        F.col("log_return"), by_date.rowsBetween(-horizon + 1, 0), trading_days
    )
    return (
        features.withColumn("_trailing", trailing)
        .withColumn("trailing_at_horizon", F.lead("_trailing", horizon).over(by_date))
        .where(F.abs(F.col("target_rv_fwd") - F.col("trailing_at_horizon")) > 1e-9)
        .select("ticker", "date", "target_rv_fwd", "trailing_at_horizon")
    )


def row_report(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks of a table in one scan: one aggregate each, turned into report rows."""
    counts = df.agg(*[F.count_if(c.offends).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(F.lit(f"{table}.{c.name}").alias("check"), F.col(f"c{i}").alias("violations"))
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def count_report(violations: DataFrame, name: str) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def staged_report(staged: DataFrame) -> DataFrame:
    rows = [not_null("ticker"), not_null("date"), not_null("adj_close"), in_range("adj_close", 0)]
    return row_report(staged, "staged", [*rows, ohlc_consistent()]).unionByName(
        count_report(repeated_keys(staged, ["ticker", "date"]), "staged.unique(ticker,date)")
    )


def returns_report(returns: DataFrame) -> DataFrame:
    rows = [in_range("log_return", -1.5, 1.5), in_range("log_range", 0)]
    return row_report(returns, "returns", rows).unionByName(
        count_report(repeated_keys(returns, ["ticker", "date"]), "returns.unique(ticker,date)")
    )


def features_report(features: DataFrame, horizon: int = 5) -> DataFrame:
    rows = [not_null(c) for c in ("rv_5d", "rv_21d", "rv_63d", "parkinson_21d", "is_labeled")]
    rows += [in_range("rv_5d", 0, 10), in_range("target_rv_fwd", 0, 10)]
    keys = ["ticker", "date"]
    parts = [
        row_report(features, "features", rows),
        count_report(repeated_keys(features, keys), "features.unique(ticker,date)"),
        count_report(leaking_targets(features, horizon), "features.target_is_forward"),
    ]
    return reduce(DataFrame.unionByName, parts)


def monthly_report(monthly: DataFrame) -> DataFrame:
    return count_report(repeated_keys(monthly, ["ticker", "month"]), "monthly.unique(ticker,month)")


def enforce(report: DataFrame) -> None:
    """Raise when any check has offending rows."""
    failed = report.where("violations > 0").orderBy("check").collect()
    if failed:
        raise CheckFailure("; ".join(f"{r['check']}: {r['violations']} rows" for r in failed))


def freshness(bronze: DataFrame, now: datetime, warn_days: int = 3, error_days: int = 7) -> DataFrame:
    """Age of the newest landed row. No rows at all is an error."""
    seconds = F.timestamp_diff("SECOND", F.col("newest"), utc_literal(now))
    status = (
        F.when(F.col("newest").isNull() | (seconds > error_days * 86400), "error")
        .when(seconds > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    return bronze.agg(F.max("ingested_at").alias("newest")).select(
        "newest", (seconds / 86400.0).alias("age_days"), status.alias("status")
    )
