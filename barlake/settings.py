"""Run settings as one immutable value; every step takes what it needs from it."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class TreeSettings:
    """Boosted trees, grown best first to ``leaves`` leaves none of which lies deeper than ``depth``; ``l2`` is added to
    every leaf's row count. Rounds over the data follow the depth of a tree, so ``depth`` bounds the time of a fit."""

    trees: int = 400
    learning_rate: float = 0.03
    leaves: int = 31
    depth: int = 7
    min_rows_per_leaf: int = 100
    row_fraction: float = 0.8
    feature_fraction: float = 0.8
    l2: float = 1.0
    max_bins: int = 64
    seed: int = 42


@dataclass(frozen=True)
class Settings:
    source: str = "vendor"
    start_date: date = date(2015, 1, 1)
    lookback_days: int = 5
    horizon: int = 5
    min_history: int = 63
    trading_days: int = 252
    n_splits: int = 5
    test_days: int = 252
    min_train_days: int = 504
    holdout: float = 0.2
    min_improvement: float = 0.05
    stale_after_days: int = 4
    recent_sessions: int = 63
    degradation: float = 1.5
    psi_warn: float = 0.1
    psi_alert: float = 0.25
    freshness_warn_days: int = 3
    freshness_error_days: int = 7
    candidates: tuple[str, ...] = ("naive", "har", "trees")
    trees: TreeSettings = field(default_factory=TreeSettings)
