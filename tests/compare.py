"""Compare a query with its SQL twin: schema by kind, row count, and order-free values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SPENT: dict[str, float] = {}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def kind(value) -> str:
    return "none" if value is None else type(value).__name__


def differences(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    columns = sorted(df.columns)
    start = time.perf_counter()
    ours = df.select(*columns).collect()
    SPENT["collect"] = time.perf_counter() - start
    start = time.perf_counter()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in order) for row in result.fetchall()]
    SPENT["sql"] = time.perf_counter() - start
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    kinds = [
        {kind(r[i]) for r in rows} - {"none"} for rows in (ours, theirs) for i in range(len(columns))
    ]
    half = len(columns)
    for i, c in enumerate(columns):
        if kinds[i] != kinds[half + i]:
            return f"type of {c}: {kinds[i]} != {kinds[half + i]}"
    a = Counter(tuple(plain(v) for v in row) for row in ours)
    b = Counter(tuple(plain(v) for v in row) for row in theirs)
    if a != b:
        more, fewer = a - b, b - a
        some = [sorted(c.items(), key=str)[:3] for c in (more, fewer)]
        return f"values: ours {some[0]} theirs {some[1]} ({sum(more.values())} rows)"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from barlake.registry import all_queries, all_sql
    from barlake.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.driver.memory": "10g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(sf_dir), all_sql()
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            if name in sql:
                verdict = differences(query(spark, sf_dir), con, sql[name]) or "equal"
            else:
                verdict = f"rows only: {len(query(spark, sf_dir).collect())}"
        except Exception as err:  # noqa: BLE001
            verdict = f"FAILED {type(err).__name__}: {str(err)[:600]}"
        whole = time.perf_counter() - start - SPENT.pop("sql", 0.0)
        print(f"{name:28s} {whole:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
