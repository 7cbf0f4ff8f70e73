"""Boosted trees over the full feature set, for all training sets of a validation at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import log_vol
from barlake.functions.losses import smearing
from barlake.operators.boosting import BLOCK_ROWS, Forest, boost, pack, with_predictions
from barlake.operators.folds import Fold, Scope
from barlake.operators.quantiles import exact_quantiles
from barlake.schema import LEVEL_FEATURES, MODEL_FEATURES, SCALE_FREE_FEATURES, TARGET
from barlake.settings import TreeSettings
from barlake.workspace import materialise, small_frame

# A market without any movement has no relative level; 1 is the level of the average ticker.
NEUTRAL = {"relative_rv_21d": 1.0}
#: Rows for which a task of its own is worth its while.
LEAST_ROWS = 1 << 13
#: Training sets of one run of the learner: a row's mask has a bit for the probe and one for the final fit of each.
SCOPES_AT_ONCE = 16


@dataclass(frozen=True)
class Trees:
    """The final fit of one training set, with the level correction that its probe needs."""

    scope: int
    forest: Forest
    smear: float


def tree_inputs(features: DataFrame, carry: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """Carried columns, the features as doubles without nulls (levels logged, the rest as they are), and the log
    target ``y`` where there is one."""
    keep = list(carry)
    logged = [log_vol(F.col(c)).alias(c) for c in LEVEL_FEATURES]
    raw = [
        F.coalesce(F.col(c).cast("double"), F.lit(NEUTRAL.get(c, 0.0))).alias(c)
        for c in SCALE_FREE_FEATURES
    ]
    if TARGET in features.columns:
        keep = [*keep, log_vol(F.col(TARGET)).alias("y")]
    return features.select(*keep, *logged, *raw)


def bin_edges(inputs: DataFrame, max_bins: int) -> list[list[float]]:
    """Quantiles of each feature between its bins. Only features are looked at, no target."""
    fractions = [k / max_bins for k in range(1, max_bins)]
    found = exact_quantiles(inputs, MODEL_FEATURES, fractions)
    return [np.unique(found[f]).tolist() for f in MODEL_FEATURES]


def membership(scopes: Sequence[Scope]) -> Column:
    """Bit 2k: the row is fitted by the probe of the k-th training set; bit 2k + 1: it belongs to the set."""
    bits = []
    for k, scope in enumerate(scopes):
        probe = F.when(scope.contains() & scope.fitted(), F.lit(1 << (2 * k))).otherwise(F.lit(0))
        whole = F.when(scope.contains(), F.lit(1 << (2 * k + 1))).otherwise(F.lit(0))
        bits += [probe.cast("long"), whole.cast("long")]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fit_trees(inputs: DataFrame, scopes: Sequence[Scope], settings: TreeSettings) -> list[Trees]:
    """Trees for every scope, probes and final fits in the same rounds. ``inputs`` is scanned several times: hand over
    a written table."""
    edges = bin_edges(inputs, settings.max_bins)
    out = []
    for start in range(0, len(scopes), SCOPES_AT_ONCE):
        out += _fit(inputs, scopes[start : start + SCOPES_AT_ONCE], edges, settings)
    return out


def _fit(inputs: DataFrame, scopes: Sequence[Scope], edges: list[list[float]], settings: TreeSettings) -> list[Trees]:
    spark = inputs.sparkSession
    inside = reduce(or_, [s.contains() for s in scopes])
    rows = inputs.where(inside).select(
        F.xxhash64("ticker", "date").alias("key"), "y", membership(scopes).alias("mask"), *MODEL_FEATURES
    )
    most = max(s.rows for s in scopes)
    parts = max(-(-most // BLOCK_ROWS), min(spark.sparkContext.defaultParallelism, -(-most // LEAST_ROWS)))
    blocks = materialise(pack(rows, MODEL_FEATURES, edges, parts), "tree-blocks")
    forests = boost(spark, blocks, 2 * len(scopes), MODEL_FEATURES, edges, settings)
    tails = reduce(or_, [s.contains() & ~s.fitted() for s in scopes])
    probed = with_predictions(inputs.where(tails), forests[::2], "predicted")
    smears = probed.agg(
        *[
            smearing(F.when(s.contains() & ~s.fitted(), F.col("y") - F.col("predicted")[k])).alias(f"smear_{k}")
            for k, s in enumerate(scopes)
        ]
    ).first()
    return [Trees(s.number, forest, float(smear)) for s, forest, smear in zip(scopes, forests[1::2], smears)]


def tree_out_of_sample(inputs: DataFrame, folds: Sequence[Fold], fitted: Sequence[Trees]) -> DataFrame:
    """Predictions on every fold's test block; blocks are disjoint, so each row meets one fold."""
    smears = {t.scope: t.smear for t in fitted}
    forests = [t.forest for t in fitted if t.scope in {f.number for f in folds}]
    blocks = small_frame(
        inputs.sparkSession,
        [(f.number, k, f.test_start, f.test_end, smears[f.number]) for k, f in enumerate(folds)],
        "fold int, place int, test_start date, test_end date, smear double",
    )
    tested = reduce(or_, [F.col("date").between(F.lit(f.test_start), F.lit(f.test_end)) for f in folds])
    return (
        with_predictions(inputs.where(tested), forests, "predicted")
        .join(F.broadcast(blocks), F.col("date").between(F.col("test_start"), F.col("test_end")))
        .select(
            "fold",
            F.lit("trees").alias("model"),
            "ticker",
            "date",
            F.col("y").alias("y_true_log"),
            (F.get("predicted", F.col("place")) + F.col("smear")).alias("y_pred_log"),
        )
    )


def gain_shares(forest: Forest) -> list[tuple[str, float]]:
    """Share of the total gain per feature, largest first."""
    return sorted(forest.gains().items(), key=lambda p: (-p[1], p[0]))
