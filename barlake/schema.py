"""Declared schemas and fixed values shared by every step."""

from __future__ import annotations

from pyspark.sql import types as T

BAR_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("adj_close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)
BAR_COLUMNS = BAR_SCHEMA.fieldNames()
PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close"]
REASON = "_reject_reason"

LINEAGE_FIELDS = [
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("source", T.StringType()),
]
PARTITION_FIELDS = [
    T.StructField("ingest_date", T.DateType()),
    T.StructField("run_id", T.StringType()),
]
BRONZE_SCHEMA = T.StructType([*BAR_SCHEMA.fields, *LINEAGE_FIELDS, *PARTITION_FIELDS])
QUARANTINE_SCHEMA = T.StructType(
    [*BAR_SCHEMA.fields, T.StructField(REASON, T.StringType()), *LINEAGE_FIELDS, *PARTITION_FIELDS]
)

FORECAST_KEY = ["ticker", "as_of_date", "model_version"]
FORECAST_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("horizon_days", T.IntegerType()),
        T.StructField("forecast_vol", T.DoubleType()),
        T.StructField("current_rv_21d", T.DoubleType()),
        T.StructField("is_stale", T.BooleanType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("scored_at", T.TimestampNTZType()),
        T.StructField("as_of_date", T.DateType()),
    ]
)

# Feature names and their split into volatility levels and the rest.
LEVEL_FEATURES = ["rv_5d", "rv_21d", "rv_63d", "parkinson_5d", "parkinson_21d", "market_rv_21d"]
SCALE_FREE_FEATURES = [
    "relative_rv_21d",
    "abs_return_1d",
    "log_return",
    "overnight_gap",
    "momentum_21d",
    "volume_z_21d",
    "day_of_week",
]
MODEL_FEATURES = LEVEL_FEATURES + SCALE_FREE_FEATURES
TARGET = "target_rv_fwd"
