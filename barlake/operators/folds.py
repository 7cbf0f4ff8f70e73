"""Walk-forward folds and the time-ordered holdout, over the calendar of labelled sessions.

The calendar (one row per session with its row count) is bounded by the number of calendar days, so it may
sit on the driver; the rows themselves never do.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.workspace import materialise, small_frame


@dataclass(frozen=True)
class Fold:
    number: int
    train_end: date  # exclusive, the embargo is already taken off
    test_start: date
    test_end: date  # inclusive


@dataclass(frozen=True)
class Scope:
    """One training set: every row before ``end``, its first part to fit, the rest to calibrate.

    Rows up to (cut_date, cut_ticker) in (date, ticker) order are fitted; no ticker means the whole cut
    session calibrates.
    """

    number: int
    end: date
    rows: int
    fit_rows: int
    cut_date: date
    cut_ticker: str | None

    def contains(self) -> Column:
        return F.col("date") < F.lit(self.end)

    def fitted(self) -> Column:
        before = F.col("date") < F.lit(self.cut_date)
        if self.cut_ticker is None:
            return before
        on_cut = F.col("date") == F.lit(self.cut_date)
        return before | (on_cut & (F.col("ticker") <= F.lit(self.cut_ticker)))


def session_calendar(labelled: DataFrame) -> list[tuple[date, int]]:
    """(session, rows) in date order."""
    counts = labelled.groupBy("date").agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["date"], r["n"]) for r in counts)


def walk_forward(
    sessions: Sequence[date], n_splits: int, test_days: int, min_train_days: int, embargo_days: int
) -> list[Fold]:
    """Consecutive test blocks at the end of the calendar, each trained on all sessions before it.

    Exactly ``embargo_days`` sessions lie between training and test, since a label looks that far ahead.
    Test blocks shrink when history is short.
    """
    days = sorted(set(sessions))
    spare = len(days) - min_train_days - embargo_days
    if spare < n_splits:
        needed = min_train_days + embargo_days + n_splits
        raise ValueError(f"too few sessions for {n_splits} folds: {len(days)}, at least {needed} are needed")
    block = min(test_days, spare // n_splits)
    starts = range(len(days) - n_splits * block, len(days), block)
    return [
        Fold(k, days[s - embargo_days], days[s], days[s + block - 1]) for k, s in enumerate(starts)
    ]


def fold_frame(spark: SparkSession, folds: Sequence[Fold]) -> DataFrame:
    rows = [(f.number, f.train_end, f.test_start, f.test_end) for f in folds]
    return small_frame(spark, rows, "fold int, train_end date, test_start date, test_end date")


def holdout_scopes(
    labelled: DataFrame,
    calendar: Sequence[tuple[date, int]],
    ends: Sequence[tuple[int, date]],
    holdout: float = 0.2,
) -> list[Scope]:
    """Split each training set by position in (date, ticker) order without ranking all rows.

    Positions follow from the calendar's running count; only the one session that holds the cut needs
    an order among its tickers.
    """
    days = [d for d, _ in calendar]
    running = [0, *accumulate(n for _, n in calendar)]
    drafts, wanted = [], set()
    for number, end in ends:
        rows = running[bisect_left(days, end)]
        fit_rows = int(rows * (1 - holdout))
        at = next(i for i in range(len(days)) if running[i + 1] > fit_rows)
        within = fit_rows - running[at]
        drafts.append((number, end, rows, fit_rows, days[at], within))
        if within:
            wanted.add((days[at], within))
    tickers = ranked_tickers(labelled, wanted) if wanted else {}
    return [Scope(*draft[:5], tickers.get(draft[4:])) for draft in drafts]


def ranked_tickers(df: DataFrame, wanted: set[tuple[date, int]]) -> dict[tuple[date, int], str]:
    """The k-th ticker of a session for each (session, k).

    Only sessions that hold a cut are looked at. Their tickers are dealt into ranges, the ranges are counted, and
    just the range that holds a k-th ticker is ranked, from the count before it on. So no task orders a session.
    """
    dates = sorted({d for d, _ in wanted})
    ranges = df.where(F.col("date").isin(dates)).select("date", "ticker").repartitionByRange("date", "ticker")
    ranges = materialise(ranges.withColumn("part", F.spark_partition_id()), "cut-sessions")
    counts = ranges.groupBy("date", "part").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("date").orderBy("part"))  # a row per range of a session
    cuts = small_frame(df.sparkSession, sorted(wanted), "date date, k long")
    holding = counts.withColumn("until", running).join(F.broadcast(cuts), "date")
    holding = holding.where((F.col("k") <= F.col("until")) & (F.col("k") > F.col("until") - F.col("n")))
    holding = holding.select("date", "part", "k", (F.col("k") - F.col("until") + F.col("n")).alias("within"))
    rank = F.row_number().over(Window.partitionBy("date", "part", "k").orderBy("ticker"))
    held = ranges.join(F.broadcast(holding), ["date", "part"]).withColumn("rank", rank)  # one row per cut is broadcast
    rows = held.where("rank = within").select("date", "k", "ticker").collect()
    return {(r["date"], r["k"]): r["ticker"] for r in rows}


def fold_ends(folds: Sequence[Fold]) -> list[tuple[int, date]]:
    return [(f.number, f.train_end) for f in folds]


def everything(calendar: Sequence[tuple[date, int]]) -> tuple[int, date]:
    """The scope of the final fit: every labelled session."""
    return (-1, calendar[-1][0] + timedelta(days=1))
