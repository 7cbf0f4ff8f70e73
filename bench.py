"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). Every
query starts from the raw tables and runs to completion into a sink that discards its rows; nothing is
cached between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barlake.registry import all_queries  # noqa: E402
from barlake.session import build_session  # noqa: E402

HEADLINE = [
    "raw_bars",
    "keep_last_dedup",
    "contract_valid",
    "contract_repeated_keys",
    "staged_bars",
    "daily_returns",
    "monthly_summary",
    "features_volatility",
    "check_report",
    "lake_roundtrip",
    "run_manifest",
    "fold_metrics",
    "champion_gate",
    "forecasts_har",
    "forecast_upsert",
    "psi_report",
    "health",
    "event_bars",
    "pipeline_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "barlake-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{sf_dir}/part.parquet").groupBy("p_brand").count().collect()  # JVM start-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
