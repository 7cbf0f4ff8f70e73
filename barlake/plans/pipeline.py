"""The whole daily run as one function over a lake: ingest, marts, checks, train, score, monitor, publish."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame

from barlake.operators.checks import (
    enforce,
    features_report,
    freshness,
    monthly_report,
    returns_report,
    staged_report,
)
from barlake.operators.upsert import ForecastTable
from barlake.plans.ingest import ingest
from barlake.plans.marts import daily_returns, monthly_summary, ticker_features, with_market
from barlake.plans.monitoring import monitor
from barlake.plans.publishing import existing_tables, publish
from barlake.plans.scoring import latest_features, score, write_forecast_files
from barlake.plans.staging import staged
from barlake.plans.training import load_card, load_champion, train, write_artifacts
from barlake.settings import Settings
from barlake.sources.bars import BarSource
from barlake.sources.lake import Lake
from barlake.sources.versions import newest_version, write_version
from barlake.workspace import materialise


class StaleSource(RuntimeError):
    """Nothing was landed for too long."""


def write_mart(lake: Lake, df: DataFrame, table: str, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A new version of a mart: readers see it when the checks of ``report`` have passed on what was written."""
    return write_version(df, lake.mart_path(table), lambda written: enforce(report(written)))


def build_marts(lake: Lake, settings: Settings, now: datetime | None = None) -> dict[str, DataFrame]:
    """Freshness, staged bars, returns, features and the monthly summary; each table is checked after it is written and
    before it is read, and every later step scans written tables instead of recomputing them. Where a check fails, that
    mart and those after it stay as they were."""
    if now is not None:
        age = freshness(
            lake.bronze(), now, settings.freshness_warn_days, settings.freshness_error_days
        )
        if age.first()["status"] == "error":
            raise StaleSource(f"no bars landed for {settings.freshness_error_days} days")
    bars = write_mart(lake, staged(lake.bronze()), "staged", staged_report)
    returns = write_mart(lake, daily_returns(bars), "daily_returns", returns_report)
    seasoned = materialise(
        ticker_features(returns, settings.horizon, settings.trading_days, settings.min_history),
        "seasoned",
    )
    features = write_mart(
        lake, with_market(seasoned), "features_volatility", lambda df: features_report(df, settings.horizon)
    )
    monthly = write_mart(lake, monthly_summary(returns, settings.trading_days), "monthly_summary", monthly_report)
    return {
        "staged": bars,
        "daily_returns": returns,
        "features_volatility": features,
        "monthly_summary": monthly,
    }


def run_daily(
    lake: Lake,
    source: BarSource,
    tickers: DataFrame,
    as_of: date,
    settings: Settings,
    retrain: bool = False,
    publish_to: str | None = None,
    now: datetime | None = None,
) -> dict:
    """One end-to-end run; a model is trained when asked for, when none exists, and again when the
    monitoring report is unhealthy."""
    now = now or datetime.now(UTC).replace(tzinfo=None)
    models = f"{lake.root}/models"
    summary: dict = {"landed": ingest(lake, source, tickers, as_of, settings, now=now)["rows_landed"]}
    marts = build_marts(lake, settings, now)
    features = marts["features_volatility"]

    if retrain or load_card(lake.spark, models) is None:
        summary["train"] = _train(features, lake, models, settings)
    report = _score_and_monitor(lake, features, models, settings, now, summary)
    if report is not None and not report["healthy"]:
        summary["retrain"] = _train(features, lake, models, settings)
        _score_and_monitor(lake, features, models, settings, now, summary)
    if publish_to is not None:
        paths = {name: newest_version(lake.spark, lake.mart_path(name)) for name in marts}
        tables = existing_tables(lake.spark, paths | {"volatility_forecasts": lake.mart_path("volatility_forecasts")})
        card = load_card(lake.spark, models)
        summary["published"] = len(publish(lake.spark, tables, card, publish_to, as_of))
    return summary


def _train(features: DataFrame, lake: Lake, models: str, settings: Settings) -> dict:
    result = train(features, models, settings)
    write_artifacts(result, f"{lake.root}/evaluation/{result.version}")
    return {"champion": result.champion, "promoted": result.promoted, "version": result.version}


def _score_and_monitor(
    lake: Lake, features: DataFrame, models: str, settings: Settings, now: datetime, summary: dict
) -> dict | None:
    if load_card(lake.spark, models) is None:
        return None
    champion, card = load_champion(lake.spark, models)
    forecasts = materialise(
        score(latest_features(features), champion, card, now, settings.stale_after_days), "scored"
    )
    table = ForecastTable(lake.spark, lake.mart_path("volatility_forecasts"))
    table.upsert(forecasts)
    write_forecast_files(forecasts, f"{lake.root}/gold/forecasts")
    report = monitor(features, table.read(), card, settings, f"{lake.root}/reports", now)
    summary["forecasts"] = forecasts.count()
    summary["healthy"] = report["healthy"]
    return report
