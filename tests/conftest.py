from __future__ import annotations

import sys

from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from barlake.schema import BAR_SCHEMA  # noqa: E402
from barlake.session import build_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "barlake-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def made_bars(tickers: list[str], start: str, sessions: int) -> pd.DataFrame:
    """Weekday bars in closed form: a slow and a fast wave around a level of each ticker's own."""
    i = np.arange(sessions)
    days = [d.date() for d in pd.bdate_range(start, periods=sessions)]
    tables = []
    for k, ticker in enumerate(tickers):
        middle = 40 + 7 * k + 6 * np.sin(i / 23 + k) + 0.8 * np.cos(i * (1.7 + k / 5))
        reach = 0.7 + 0.3 * np.cos(i / 51 + k) + 0.2 * np.sin(i * i / 7)
        table = pd.DataFrame({"date": days, "ticker": ticker})
        table["open"] = middle - reach * np.sin(i * 2.3) / 2
        table["high"] = middle + reach
        table["low"] = middle - reach
        table["close"] = table["adj_close"] = middle + reach * np.sin(i * 3.1) / 2
        table["volume"] = 1000.0 + 10 * ((i * 7919 + k * 31) % 500)
        tables.append(table)
    return pd.concat(tables, ignore_index=True)


@pytest.fixture(scope="session")
def bars_pdf() -> pd.DataFrame:
    return made_bars(["AAA", "BBB"], "2024-01-01", 24)


@pytest.fixture(scope="session")
def history_pdf() -> pd.DataFrame:
    return made_bars(["AAA", "BBB", "CCC", "DDD"], "2016-01-04", 1100)


def frame(spark, pdf: pd.DataFrame):
    return spark.createDataFrame(pdf, BAR_SCHEMA)


@pytest.fixture(scope="session")
def history(spark, history_pdf):
    """Staged bars, returns and features of four tickers over about four years."""
    from barlake.plans.marts import daily_returns, volatility_features
    from barlake.workspace import materialise

    staged = materialise(
        frame(spark, history_pdf).selectExpr(
            "ticker", "date", "open", "high", "low", "close", "adj_close", "cast(volume as bigint) volume"
        ),
        "staged",
    )
    returns = materialise(daily_returns(staged), "returns")
    features = materialise(volatility_features(returns), "features")
    return {"staged": staged, "returns": returns, "features": features}


