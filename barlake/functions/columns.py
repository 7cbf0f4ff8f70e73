"""Column builders; all stay inside generated code."""

from __future__ import annotations

import math
from datetime import UTC, datetime

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

VOL_FLOOR = 1e-3  # annualised; keeps the log finite on flat sessions


def known(value: Column) -> Column:
    """NaN and null are the same thing to a contract; Spark alone would call NaN > 0 true."""
    return F.when(~F.isnan(value), value)


def whole(value: Column) -> Column:
    """Nearest bigint, halves to even. A bare cast would truncate."""
    return F.rint(value).cast("bigint")


def utc_literal(moment: datetime) -> Column:
    """A zone-free UTC timestamp, whatever the zones of the Python process and the session."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def log_vol(value: Column) -> Column:
    """Log of a volatility clipped at the floor; null stays null (``greatest`` alone would floor it)."""
    return F.when(value.isNotNull(), F.log(F.greatest(value, F.lit(VOL_FLOOR))))


def annualised_vol(log_return: Column, frame: WindowSpec, trading_days: int = 252) -> Column:
    """Un-centred realised volatility of the log returns in the frame."""
    return F.sqrt(F.lit(float(trading_days)) * F.avg(log_return * log_return).over(frame))


def parkinson_vol(log_range: Column, frame: WindowSpec, trading_days: int = 252) -> Column:
    """High-low range volatility over the frame."""
    scale = trading_days / (4 * math.log(2))
    return F.sqrt(F.lit(scale) * F.avg(log_range * log_range).over(frame))


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(day) + 1).cast("int")
