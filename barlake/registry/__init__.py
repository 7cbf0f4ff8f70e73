"""Named queries over the driver tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.registry import forecasting, lake, relational
from barlake.registry.oracle_forecasting import forecasting_sql
from barlake.registry.oracle_lake import lake_sql
from barlake.registry.oracle_relational import relational_sql

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (relational, forecasting, lake):
        for name, value in vars(module).items():
            if name.startswith("q_"):
                found[name[2:]] = value
    return found


def all_sql() -> dict[str, str]:
    return {**relational_sql(), **forecasting_sql(), **lake_sql()}
