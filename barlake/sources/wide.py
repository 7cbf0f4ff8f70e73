"""Wide vendor frames: one row per date, one column per (ticker, field)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.schema import BAR_COLUMNS

# Vendor field names and ours.
FIELD_NAMES = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}


def tidy(wide: DataFrame, date_column: str = "Date", separator: str = "_") -> DataFrame:
    """One row per (date, ticker) from columns named ``TICKER_Field``.

    All fields of a ticker sit in the same input row, so each row expands into an array of per-ticker
    structs: no grouping, no pivot, no shuffle. An absent adjusted close takes the close; a row without
    any of open, high, low, close is dropped.
    """
    tickers: dict[str, dict[str, str]] = {}
    for column in wide.columns:
        if column == date_column:
            continue
        ticker, found, field = column.rpartition(separator)
        if not found or field not in FIELD_NAMES:
            raise ValueError(f"expected TICKER{separator}Field columns, got {column!r}")
        tickers.setdefault(ticker, {})[FIELD_NAMES[field]] = column
    if not tickers:
        raise ValueError("the wide frame holds no ticker columns")

    structs = []
    for ticker in sorted(tickers):
        have = tickers[ticker]
        have.setdefault("adj_close", have.get("close", ""))
        fields = [F.lit(ticker).alias("ticker")]
        for name in BAR_COLUMNS[2:]:
            source = have.get(name)
            value = F.col(f"`{source}`") if source else F.lit(None)
            fields.append(value.cast("double").alias(name))
        structs.append(F.struct(*fields))
    return (
        wide.select(F.col(f"`{date_column}`").cast("date").alias("date"), F.inline(F.array(*structs)))
        .dropna(how="all", subset=["open", "high", "low", "close"])
        .select(*BAR_COLUMNS)
    )


def widen(bars: DataFrame, tickers: list[str]) -> DataFrame:
    """The vendor's shape from tidy bars with one row per (date, ticker)."""
    values = [F.first(ours).alias(theirs) for theirs, ours in FIELD_NAMES.items()]
    return bars.groupBy(F.col("date").alias("Date")).pivot("ticker", tickers).agg(*values)
