"""Least squares over many overlapping training sets in one pass of additive moments.

Training sets are prefixes of the (date, ticker) order. Rows are reduced once to one moment row per cell (a
session, cut where a holdout boundary falls inside it); every training set is then a sum of cells. The
range join of rows with folds thus runs on calendar-sized data instead of on copies of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.columns import log_vol
from barlake.functions.losses import smearing
from barlake.operators.folds import Fold, Scope
from barlake.schema import TARGET
from barlake.workspace import small_frame

REGRESSORS = ["l5", "l21", "l63"]
SYMBOLS = [*REGRESSORS, "y"]
PAIRS = [(a, b) for i, a in enumerate(SYMBOLS) for b in SYMBOLS[i:]]
SUMS = [f"s_{a}" for a in SYMBOLS] + [f"s_{a}_{b}" for a, b in PAIRS]


@dataclass(frozen=True)
class Linear:
    """log-vol forecast = intercept + coefficients . (log rv_5d, log rv_21d, log rv_63d) + smear."""

    scope: int
    model: str
    intercept: float
    coefficients: tuple[float, float, float]
    smear: float = 0.0


def log_design(labelled: DataFrame) -> DataFrame:
    """Keys, the three log volatilities and the log target."""
    return labelled.select(
        "ticker",
        "date",
        log_vol(F.col("rv_5d")).alias("l5"),
        log_vol(F.col("rv_21d")).alias("l21"),
        log_vol(F.col("rv_63d")).alias("l63"),
        log_vol(F.col(TARGET)).alias("y"),
    )


def cell_moments(design: DataFrame, scopes: Sequence[Scope]) -> DataFrame:
    """One row per (date, cell): count, sums and sums of products."""
    cuts = {(s.cut_date, s.cut_ticker) for s in scopes if s.cut_ticker is not None}
    past = [
        F.when((F.col("date") == F.lit(d)) & (F.col("ticker") > F.lit(t)), 1).otherwise(0)
        for d, t in sorted(cuts)
    ]
    cell = reduce(add, past, F.lit(0))
    sums = [F.sum(a).alias(f"s_{a}") for a in SYMBOLS]
    sums += [F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in PAIRS]
    return design.groupBy("date", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), *sums)


def scope_moments(cells: DataFrame, scopes: Sequence[Scope]) -> DataFrame:
    """Moments of each training set and of its fitted part."""
    spark = cells.sparkSession
    rows = []
    for s in scopes:
        on_date = sorted({o.cut_ticker for o in scopes if o.cut_date == s.cut_date and o.cut_ticker})
        fit_cells = on_date.index(s.cut_ticker) + 1 if s.cut_ticker else 0
        rows.append((s.number, s.end, s.cut_date, fit_cells))
    bounds = small_frame(spark, rows, "scope int, end date, cut_date date, fit_cells int")
    in_fit = (F.col("date") < F.col("cut_date")) | (
        (F.col("date") == F.col("cut_date")) & (F.col("cell") < F.col("fit_cells"))
    )
    aggregates = []
    for name in ["n", *SUMS]:
        aggregates.append(F.sum(name).alias(f"all_{name}"))
        aggregates.append(F.sum(F.when(in_fit, F.col(name))).alias(f"fit_{name}"))
    return (
        cells.join(F.broadcast(bounds), F.col("date") < F.col("end"))
        .groupBy("scope")
        .agg(*aggregates)
    )


def solve(moments: dict[str, float], part: str) -> tuple[float, tuple[float, float, float]]:
    """Intercept and coefficients from centred normal equations (3 x 3)."""
    n = moments[f"{part}_n"]
    mean = np.array([moments[f"{part}_s_{a}"] for a in SYMBOLS]) / n
    second = np.zeros((4, 4))
    for a, b in PAIRS:
        i, j = SYMBOLS.index(a), SYMBOLS.index(b)
        second[i, j] = second[j, i] = moments[f"{part}_s_{a}_{b}"] / n
    centred = second - np.outer(mean, mean)
    beta, *_ = np.linalg.lstsq(centred[:3, :3], centred[:3, 3], rcond=None)
    return float(mean[3] - mean[:3] @ beta), tuple(float(b) for b in beta)


def fit_candidates(moments: Sequence[dict], part: str, models: Sequence[str]) -> list[Linear]:
    """Persistence is the linear forecast (0; 0, 1, 0); HAR is the least-squares one."""
    fitted = []
    for m in moments:
        if "naive" in models:
            fitted.append(Linear(m["scope"], "naive", 0.0, (0.0, 1.0, 0.0)))
        if "har" in models:
            fitted.append(Linear(m["scope"], "har", *solve(m, part)))
    return fitted


def linear_frame(spark: SparkSession, models: Sequence[Linear]) -> DataFrame:
    rows = [(m.scope, m.model, m.intercept, *m.coefficients, m.smear) for m in models]
    schema = "scope int, model string, b0 double, b5 double, b21 double, b63 double, smear double"
    return small_frame(spark, rows, schema)


def linear_prediction() -> Column:
    slopes = F.col("b5") * F.col("l5") + F.col("b21") * F.col("l21") + F.col("b63") * F.col("l63")
    return F.col("b0") + slopes + F.col("smear")


def calibrate(
    design: DataFrame, scopes: Sequence[Scope], probes: Sequence[Linear], finals: Sequence[Linear]
) -> list[Linear]:
    """Give each final model the level correction its probe needs on the held-out tail.

    One pass for all scopes and models: the models are a handful of rows, broadcast.
    """
    spark = design.sparkSession
    bounds = small_frame(
        spark,
        [(s.number, s.end, s.cut_date, s.cut_ticker or "") for s in scopes],
        "scope int, end date, cut_date date, cut_ticker string",
    )
    probe_rows = linear_frame(spark, probes).join(bounds, "scope")
    held_out = (F.col("date") < F.col("end")) & (
        (F.col("date") > F.col("cut_date"))
        | ((F.col("date") == F.col("cut_date")) & (F.col("ticker") > F.col("cut_ticker")))
    )
    earliest = min(s.cut_date for s in scopes)
    smears = {
        (r["scope"], r["model"]): r["smear"]
        for r in design.where(F.col("date") >= F.lit(earliest))
        .join(F.broadcast(probe_rows), held_out)
        .groupBy("scope", "model")
        .agg(smearing(F.col("y") - linear_prediction()).alias("smear"))
        .collect()
    }
    return [
        Linear(m.scope, m.model, m.intercept, m.coefficients, smears[m.scope, m.model])
        for m in finals
    ]


def fit_linear(design: DataFrame, scopes: Sequence[Scope], models: Sequence[str]) -> list[Linear]:
    """Smeared persistence and HAR for every scope: two passes over the rows in total."""
    moments = [r.asDict() for r in scope_moments(cell_moments(design, scopes), scopes).collect()]
    probes = fit_candidates(moments, "fit", models)
    finals = fit_candidates(moments, "all", models)
    return calibrate(design, scopes, probes, finals)


def linear_out_of_sample(
    design: DataFrame, folds: Sequence[Fold], models: Sequence[Linear]
) -> DataFrame:
    """Predictions on every fold's test block; blocks are disjoint, so each row meets one fold."""
    spark = design.sparkSession
    blocks = small_frame(
        spark,
        [(f.number, f.test_start, f.test_end) for f in folds],
        "scope int, test_start date, test_end date",
    )
    per_fold = linear_frame(spark, models).join(blocks, "scope")
    in_block = F.col("date").between(F.col("test_start"), F.col("test_end"))
    first = min(f.test_start for f in folds)
    return (
        design.where(F.col("date") >= F.lit(first))
        .join(F.broadcast(per_fold), in_block)
        .select(
            F.col("scope").alias("fold"),
            "model",
            "ticker",
            "date",
            F.col("y").alias("y_true_log"),
            linear_prediction().alias("y_pred_log"),
        )
    )
