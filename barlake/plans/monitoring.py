"""Feature drift against the training profile and live accuracy of matured forecasts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.columns import log_vol
from barlake.functions.losses import METRICS, metric_columns
from barlake.operators.drift import FeatureProfile, drift_report
from barlake.plans.training import card_profiles
from barlake.schema import TARGET
from barlake.settings import Settings
from barlake.workspace import small_frame


def recent_sessions(features: DataFrame, sessions: int = 63) -> DataFrame:
    """Rows of the newest ``sessions`` dates: from the first of them on, as a literal that the scan can skip files and row
    groups by. Finding it reads the date column alone."""
    newest = features.select("date").distinct().orderBy(F.col("date").desc()).limit(sessions)
    first = newest.agg(F.min("date")).first()[0]
    return features.where(F.col("date") >= F.lit(first))


def matured_forecasts(forecasts: DataFrame, features: DataFrame) -> DataFrame:
    """Forecasts whose realised target is known by now. Features outside the forecasts' days are not scanned."""
    first, last = forecasts.agg(F.min("as_of_date"), F.max("as_of_date")).first()
    realised = features.where(F.col(TARGET).isNotNull() & F.col("date").between(F.lit(first), F.lit(last))).select(
        "ticker", F.col("date").alias("as_of_date"), TARGET
    )
    return forecasts.select("ticker", "as_of_date", "forecast_vol", "model_version").join(
        realised, ["ticker", "as_of_date"]
    )


def live_accuracy(matured: DataFrame) -> DataFrame:
    """The five metrics per model version, and over all versions (version null), in one pass."""
    truth = log_vol(F.col(TARGET))
    forecast = F.ln("forecast_vol")
    measured = matured.rollup("model_version").agg(
        F.count(F.lit(1)).alias("n_forecasts"), *metric_columns(truth, forecast)
    )
    return measured.where("n_forecasts > 0")


def health(
    drift: DataFrame, live: DataFrame, model_version: str, cv_qlike: float, degradation: float = 1.5
) -> DataFrame:
    """One row: drifted features, regime shifts, live QLIKE and the verdict.

    Volatility-level features move with the market; they are reported but never make a model unhealthy.
    """
    alert = F.col("status") == "alert"

    def named(condition):
        return F.sort_array(F.collect_list(F.when(condition, F.col("feature"))))

    drifted = drift.agg(
        named(alert & F.col("gates_health")).alias("drifted_features"),
        named(alert & ~F.col("gates_health")).alias("regime_shift_features"),
    )
    mine = live.where(F.col("model_version") == model_version)
    measured = mine.agg(F.max("qlike").alias("live_qlike"), F.max("n_forecasts").alias("n_forecasts"))
    degraded = F.coalesce(F.col("live_qlike") > degradation * cv_qlike, F.lit(False))
    return (
        drifted.withColumn("_one", F.lit(1))
        .join(measured.withColumn("_one", F.lit(1)), "_one")
        .select(
            F.lit(model_version).alias("model_version"),
            "drifted_features",
            "regime_shift_features",
            F.coalesce("n_forecasts", F.lit(0)).alias("n_forecasts"),
            "live_qlike",
            F.lit(cv_qlike).alias("cv_qlike"),
            degraded.alias("degraded"),
            ((F.size("drifted_features") == 0) & ~degraded).alias("healthy"),
        )
    )


def monitor(
    features: DataFrame,
    forecasts: DataFrame,
    card: dict,
    settings: Settings,
    reports_path: str | None = None,
    now: datetime | None = None,
) -> dict:
    """The monitoring report: drift records, live metrics and health; written as one JSON row."""
    spark: SparkSession = features.sparkSession
    now = now or datetime.now(UTC)
    profiles: Sequence[FeatureProfile] = card_profiles(card)
    recent = recent_sessions(features, settings.recent_sessions)
    drift_rows = [
        r.asDict()
        for r in drift_report(profiles, recent, settings.psi_warn, settings.psi_alert).collect()
    ]
    drift = small_frame(
        spark,
        [(r["feature"], r["psi"], r["status"], r["gates_health"]) for r in drift_rows],
        "feature string, psi double, status string, gates_health boolean",
    )
    live_rows = [r.asDict() for r in live_accuracy(matured_forecasts(forecasts, features)).collect()]
    live = small_frame(
        spark,
        [(r["model_version"], r["n_forecasts"], r["qlike"]) for r in live_rows],
        "model_version string, n_forecasts long, qlike double",
    )
    cv_qlike = card["cv"][card["champion"]]["qlike_mean"]
    verdict = health(drift, live, card["version"], cv_qlike, settings.degradation).first().asDict()
    report = {
        "generated_at": now.isoformat(timespec="seconds"),
        "window_sessions": settings.recent_sessions,
        "drift": drift_rows,
        "live": [
            {**r, **{m: None if r[m] is None else round(r[m], 5) for m in METRICS}}
            for r in live_rows
        ],
        **verdict,
    }
    if reports_path is not None:
        row = small_frame(spark, [(json.dumps(report),)], "value string").coalesce(1)
        row.write.mode("overwrite").text(f"{reports_path}/report_date={now:%Y-%m-%d}")
    return report
