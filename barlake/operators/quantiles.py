"""Exact quantiles of many columns at any size, by one method.

A group with all of a column's values would grow with the data, so the wanted order statistics are cornered:
each pass counts the values between the boundaries known so far and adds finer boundaries (approximate
percentiles, which merge from partial results) inside the intervals that still hold a wanted rank. A pass is two
scans with a small aggregate each; no values are shuffled or collected until an interval holds no more values
than one task sorts at once. Values are placed between boundaries by binary search inside tasks: boundaries come by the
hundreds, and as an expression with a term for each they don't compile.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import known
from barlake.workspace import small_frame

SORTED_ROWS = 100_000  # an interval of so many values is sorted; the result doesn't depend on it
GRID = 1024


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    sorted_rows: int = SORTED_ROWS,
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of the non-null values of each column; [] for an empty column."""
    return _cornered(df, columns, fractions, sorted_rows)


def _cornered(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], limit: int
) -> dict[str, list[float]]:
    bounds: dict[str, list[float]] = {c: [] for c in columns}
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    while True:
        counts = _interval_counts(df, bounds)
        wanted = {c: _ranks(sum(counts[c].values()), fractions) for c in columns}
        large: dict[tuple[str, int], list[int]] = {}
        small: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for c in columns:
            for rank in sorted(wanted[c] - set(found[c])):
                place, inside = _locate(counts[c], rank)
                if place % 2:
                    found[c][rank] = bounds[c][place // 2]
                elif counts[c][place] <= limit:
                    small.setdefault((c, place), []).append((rank, inside))
                else:
                    large.setdefault((c, place), []).append(inside)
        if not large:
            break
        bounds = _tighter(df, bounds, counts, large, small)
    if small:
        _pick(df, bounds, small, found)
    totals = {c: sum(counts[c].values()) for c in columns}
    return {
        c: [_interpolate(found[c], totals[c], f) for f in fractions] if totals[c] else []
        for c in columns
    }


def _ranks(total: int, fractions: Sequence[float]) -> set[int]:
    ranks = set()
    for f in fractions:
        at = f * (total - 1)
        ranks |= {math.floor(at), math.ceil(at)}
    return ranks if total else set()


def _interpolate(found: dict[int, float], total: int, fraction: float) -> float:
    at = fraction * (total - 1)
    low, high = math.floor(at), math.ceil(at)
    return found[low] + (found[high] - found[low]) * (at - low)


def _locate(counts: dict[int, int], rank: int) -> tuple[int, int]:
    for place in sorted(counts):
        if rank < counts[place]:
            return place, rank
        rank -= counts[place]
    raise AssertionError("rank beyond the number of values")


def _tighter(df: DataFrame, bounds, counts, large, small) -> dict[str, list[float]]:
    """Boundaries of the next pass: those around open intervals, and two close to each wanted rank."""
    fresh: dict[str, set[float]] = {c: set() for c in bounds}
    for c, place in [*large, *small]:
        around = (place // 2 - 1, place // 2)
        fresh[c] |= {bounds[c][i] for i in around if 0 <= i < len(bounds[c])}
    for (c, place), grid in _grids(df, bounds, list(large)).items():
        for inside in large[c, place]:
            at = GRID * inside // counts[c][place]
            fresh[c] |= {grid[max(at - 2, 0)], grid[min(at + 3, GRID)]}
    return {c: sorted(edges) for c, edges in fresh.items()}


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, under the numbers of their places; NaN is null."""
    return df.select(*[known(F.col(c).cast("double")).alias(str(k)) for k, c in enumerate(columns)])


def _places(batch: pa.RecordBatch, edges: Sequence[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, values and intervals of each column: odd numbers are the boundaries themselves, even numbers the open gaps
    between them."""
    for k, bounds in enumerate(edges):
        values = batch.column(k).drop_null().to_numpy(zero_copy_only=False)
        yield k, values, np.searchsorted(bounds, values, "left") + np.searchsorted(bounds, values, "right")


def _placed(df: DataFrame, bounds: Mapping[str, Sequence[float]], places: Sequence[tuple[str, int]]) -> DataFrame:
    """(column, place, value) of the values in some intervals."""
    columns, edges = list(bounds), [np.array(b, np.float64) for b in bounds.values()]
    wanted = [np.zeros(2 * len(b) + 1, bool) for b in edges]
    for c, place in places:
        wanted[columns.index(c)][place] = True

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, values, at in _places(batch, edges):
                inside = wanted[k][at]
                found = at[inside].astype(np.int32)
                names = pa.array([columns[k]] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(found), pa.array(values[inside])], names=["column", "place", "value"])

    return _values(df, columns).mapInArrow(placed, "column string, place int, value double")


def _interval_counts(df: DataFrame, bounds: dict[str, list[float]]) -> dict[str, dict[int, int]]:
    columns, edges = list(bounds), [np.array(b, np.float64) for b in bounds.values()]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(2 * len(b) + 1, np.int64) for b in edges]
        for batch in batches:
            for k, _, at in _places(batch, edges):
                held[k] += np.bincount(at, minlength=len(held[k]))
        for k, numbers in enumerate(held):
            place = np.flatnonzero(numbers)
            names = pa.array([columns[k]] * len(place), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(place.astype(np.int32)), pa.array(numbers[place])], names=["column", "place", "n"]
            )

    counts: dict[str, dict[int, int]] = {c: {} for c in bounds}
    of_tasks = _values(df, columns).mapInArrow(counted, "column string, place int, n long")
    for r in of_tasks.groupBy("column", "place").agg(F.sum("n").alias("n")).collect():
        counts[r["column"]][r["place"]] = r["n"]
    return counts


def _grids(df: DataFrame, bounds, targets: list[tuple[str, int]]) -> dict:
    """Approximate percentiles of each interval, evenly spaced by rank."""
    spaced = [i / GRID for i in range(GRID + 1)]
    rows = (
        _placed(df, bounds, targets)
        .groupBy("column", "place")
        .agg(F.percentile_approx("value", spaced, GRID * 8).alias("grid"))
        .collect()
    )
    return {(r["column"], r["place"]): r["grid"] for r in rows}


def _pick(df: DataFrame, bounds, small, found) -> None:
    """Sort the intervals of a checked size and read the wanted positions off."""
    positions = [(c, place, [inside for _, inside in ranks]) for (c, place), ranks in small.items()]
    wanted = small_frame(df.sparkSession, positions, "column string, place int, positions array<int>")
    rows = (
        _placed(df, bounds, list(small))
        .groupBy("column", "place")
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
        .join(F.broadcast(wanted), ["column", "place"])
        .select("column", "place", F.transform("positions", lambda i: F.get("values", i)).alias("picked"))
        .collect()
    )
    for r in rows:
        for (rank, _), value in zip(small[r["column"], r["place"]], r["picked"], strict=True):
            found[r["column"]][rank] = value


def unique_sorted(values: Sequence[float]) -> list[float]:
    kept: list[float] = []
    for v in sorted(values):
        if bisect_left(kept, v) == len(kept):
            kept.append(v)
    return kept
