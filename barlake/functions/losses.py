"""Forecast losses as aggregate columns over rows of (true, predicted) log volatility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ["rmse_log", "mae_log", "r2_log", "qlike", "bias_log"]


def qlike(true_vol: Column, predicted_vol: Column) -> Column:
    ratio = (true_vol * true_vol) / (predicted_vol * predicted_vol)
    return F.avg(ratio - F.log(ratio) - 1)


def qlike_of_logs(true_log: Column, predicted_log: Column) -> Column:
    """The same loss with ln(ratio) taken exactly from the logs."""
    log_ratio = 2 * (true_log - predicted_log)
    return F.avg(F.exp(log_ratio) - log_ratio - 1)


def smearing(residual: Column) -> Column:
    """Level correction that makes exp(2 * prediction) unbiased for the variance."""
    return F.lit(0.5) * F.log(F.avg(F.exp(2 * residual)))


def regression_metrics(true_log: Column, predicted_log: Column) -> dict[str, Column]:
    """All five metrics in one aggregation.

    The total sum of squares is n * var_pop, which Spark merges from centred partial moments, so there
    is no cancellation of large sums. R2 of a constant truth is null.
    """
    err = predicted_log - true_log
    total = F.var_pop(true_log) * F.count(true_log)
    return {
        "rmse_log": F.sqrt(F.avg(err * err)),
        "mae_log": F.avg(F.abs(err)),
        "r2_log": F.when(total > 0, 1 - F.sum(err * err) / total),
        "qlike": qlike_of_logs(true_log, predicted_log),
        "bias_log": F.avg(err),
    }


def metric_columns(true_log: Column, predicted_log: Column) -> list[Column]:
    return [c.alias(name) for name, c in regression_metrics(true_log, predicted_log).items()]
