"""Batch scoring of each ticker's latest session, and forecast lookup."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import log_vol, utc_literal
from barlake.operators.latest import latest_by
from barlake.operators.boosting import with_predictions
from barlake.operators.trees import tree_inputs
from barlake.plans.training import Champion
from barlake.schema import FORECAST_SCHEMA, MODEL_FEATURES


def latest_features(features: DataFrame) -> DataFrame:
    """The newest row of every ticker."""
    return latest_by(features, ["ticker"], [F.col("date").desc()])


def for_ticker(df: DataFrame, ticker: str) -> DataFrame:
    return df.where(F.col("ticker") == ticker.upper())


def predict_vol(champion: Champion, features: DataFrame) -> DataFrame:
    """``features`` with a ``forecast_vol`` column."""
    if champion.trees is None:
        model = champion.linear
        log_forecast = F.lit(model.intercept + model.smear)
        for slope, name in zip(model.coefficients, ("rv_5d", "rv_21d", "rv_63d"), strict=True):
            log_forecast = log_forecast + F.lit(slope) * log_vol(F.col(name))
        return features.withColumn("forecast_vol", F.exp(log_forecast))
    rows = features.select(F.struct(*features.columns).alias("_row"), *MODEL_FEATURES)
    scored = with_predictions(tree_inputs(rows, carry=["_row"]), [champion.trees], "_predicted")
    return scored.select("_row.*", F.exp(F.col("_predicted")[0] + F.lit(champion.smear)).alias("forecast_vol"))


def score(
    features: DataFrame,
    champion: Champion,
    card: dict,
    scored_at: datetime,
    stale_after_days: int = 4,
    freshest: DataFrame | None = None,
) -> DataFrame:
    """Forecast rows. A ticker is stale when its session lags the freshest one of ``freshest``.

    ``freshest`` defaults to the scored frame itself; a lookup of one ticker passes the whole table, so
    that a lone stale ticker is still seen as stale.
    """
    newest = (features if freshest is None else freshest).agg(F.max("date")).scalar()
    lag = F.datediff(newest, "date")
    return (
        predict_vol(champion, features)
        .select(
            "ticker",
            F.lit(card["horizon_days"]).cast("int").alias("horizon_days"),
            "forecast_vol",
            F.col("rv_21d").alias("current_rv_21d"),
            (lag > stale_after_days).alias("is_stale"),
            F.lit(card["version"]).alias("model_version"),
            F.lit(card["champion"]).alias("model_name"),
            utc_literal(scored_at).alias("scored_at"),
            F.col("date").alias("as_of_date"),
        )
        .select(*FORECAST_SCHEMA.fieldNames())
    )


def write_forecast_files(forecasts: DataFrame, path: str) -> None:
    """Files under ``as_of_date=<newest scored session>/model_version=...``; a repeat replaces its own."""
    newest = forecasts.agg(F.max("as_of_date")).scalar()
    (
        forecasts.withColumn("scored_session", F.col("as_of_date"))
        .withColumn("as_of_date", newest)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("as_of_date", "model_version")
        .parquet(path)
    )
