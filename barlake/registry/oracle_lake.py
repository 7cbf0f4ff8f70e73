"""The write-and-read-back queries in plain SQL: what the files must hold."""

from __future__ import annotations

from barlake.registry.oracle_forecasting import FOLDS, LATEST, MODELS, _HAR_VOL, _MONTH_VOL
from barlake.registry.oracle_relational import BASE, r6, reason

_PRICES = "open, high, low, close, adj_close, volume"

# The feed as a single run: the last arrival over all runs, then the contract.
ONE_RUN = f""", single AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY date, ticker ORDER BY run DESC,
    l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
one AS (SELECT *, {reason()} AS _reject_reason
  FROM (SELECT *, close IS NOT NULL AND adj_close IS NOT NULL AS complete FROM single)),
good AS (SELECT * FROM one WHERE _reject_reason = ''),
tail AS (SELECT g.* FROM good g JOIN
  (SELECT ticker, max(date) AS newest FROM good GROUP BY 1) USING (ticker) WHERE date >= newest - 5)"""

# The marts over that single run.
ONE_RUN_BASE = BASE.replace("staged AS (", "staged_all AS (", 1).replace(
    "\nlagged AS (",
    f"\n{ONE_RUN.removeprefix(', ')}, staged AS (SELECT * FROM good),\nlagged AS (",
    1,
)

_COUNTS = "SELECT '{}' AS name, count(*) AS rows FROM {}"


def _counts(pairs: dict[str, str]) -> str:
    return " UNION ALL ".join(_COUNTS.format(name, source) for name, source in pairs.items())


def _published(table: str, rows: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '/gold/{table}/{key}' AS path, cast(({rows}) AS bigint) AS rows"
        for key in ("snapshot_date=2002-01-01", "latest")
    )


LAKE_SQL = {
    "lake_roundtrip": f"""SELECT date, ticker, {r6(_PRICES)}, source, ingest_date, run_id FROM landed""",
    "bronze_widened": f"""SELECT date, ticker, {r6(_PRICES)}, source, ingest_date, run_id FROM landed""",
    "lake_state": "SELECT ticker, max(date) AS watermark, true AS same FROM landed GROUP BY 1",
    "stream_keep_last": f"""SELECT date, ticker, {r6(_PRICES)} FROM landed
      QUALIFY row_number() OVER (PARTITION BY date, ticker ORDER BY run_id DESC) = 1""",
    "stream_batches": """SELECT 'feed-00000000' || cast(run - 1 AS varchar) AS run_id,
        (SELECT count(*) FROM raw WHERE raw.run = f.run) AS rows_fetched,
        count(*) FILTER (WHERE _reject_reason = '') AS rows_landed,
        count(*) FILTER (WHERE _reject_reason <> '') AS rows_quarantined,
        (SELECT count(*) FROM raw WHERE raw.run = f.run) - count(*) AS duplicates_dropped,
        count(*) FILTER (WHERE _reject_reason = '') AS bars
      FROM flagged f GROUP BY run""",
    "quarantine_counts": """SELECT 'run-' || cast(run AS varchar) AS run_id,
        DATE '2002-01-01' + run AS ingest_date, _reject_reason, count(*) AS bars
      FROM flagged WHERE _reject_reason <> '' GROUP BY 1, 2, 3""",
    "lake_sources": "SELECT DISTINCT source FROM landed",
    "lake_partition_pruning": f"""SELECT date, ticker, {r6(_PRICES)} FROM landed
      WHERE ingest_date = DATE '2002-01-05'""",
    "run_manifest": f"""{ONE_RUN} SELECT 'first' AS run_id, 'derived' AS source,
        (SELECT count(*) FROM raw) AS rows_fetched, (SELECT count(*) FROM good) AS rows_landed,
        (SELECT count(*) FROM one WHERE _reject_reason <> '') AS rows_quarantined,
        (SELECT count(*) FROM raw) - (SELECT count(*) FROM one) AS duplicates_dropped,
        '1995-01-01' AS window_starts,
        (SELECT cast(count(DISTINCT p_brand) AS integer) FROM part) AS tickers""",
    "lake_idempotence": f"""{ONE_RUN} {_counts(
        {"first": "good", "second": "tail", "staged": "good", "keys": "good"})}""",
    "gold_export": _counts(
        {
            "daily_returns": "returns",
            "features_volatility": "features",
            "monthly_summary": "monthly",
        }
    ),
    "publish_counts": " UNION ALL ".join(
        [
            _published("daily_returns", "SELECT count(*) FROM returns"),
            _published("monthly_summary", "SELECT count(*) FROM monthly"),
            _published("model_card", "1"),
        ]
    ),
    "published_monthly": f"""SELECT ticker, month, trading_days, {r6('monthly_return, realised_vol')},
      {r6('month_low, month_high')}, avg_daily_volume, {r6('pct_up_days')} FROM monthly""",
    "marts_after_failure": _counts(
        {"staged": "staged", "daily_returns": "returns", "features_volatility": "features", "monthly_summary": "monthly"}
    ),
    "forecast_files": f"""{LATEST} SELECT ticker, date AS scored_session,
        round({_MONTH_VOL}, 6) AS forecast_vol, (SELECT max(date) FROM latest) AS as_of_date,
        'v1' AS model_version FROM latest""",
    "cv_artifacts": f"""{FOLDS} SELECT 'cv_folds' AS name, 3 * count(*) AS rows FROM folds
      UNION ALL SELECT 'cv_summary', 3
      UNION ALL SELECT 'oos_predictions', 3 * count(*) FROM labelled
        JOIN folds ON date BETWEEN test_start AND test_end""",
    "cv_files_by_value": f"""{MODELS} SELECT fold, model, train_rows, test_rows, round(qlike, 6) AS qlike,
        round(rmse_log, 6) AS rmse_log, predictions, round(mean_prediction, 6) AS mean_prediction
      FROM fold_table JOIN (SELECT fold, model, count(*) AS predictions, avg(y_pred_log) AS mean_prediction
        FROM oos GROUP BY 1, 2) USING (fold, model)""",
    "model_card": f"""{MODELS}
      SELECT 'har,naive,trees' AS candidates,
        (SELECT qlike_improvement_vs_naive >= 0.05 FROM summary WHERE model = 'har') AS promoted,
        (SELECT count(*) FROM labelled) AS rows,
        (SELECT count(DISTINCT ticker) FROM labelled) AS n_tickers,
        (SELECT cast(min(date) AS varchar) FROM labelled) AS start,
        (SELECT cast(max(date) AS varchar) FROM labelled) AS "end",
        (SELECT string_agg(ticker, ',' ORDER BY ticker) FROM (SELECT DISTINCT ticker FROM labelled))
          AS tickers,
        (SELECT round(qlike_mean, 5) FROM summary WHERE model = 'naive') AS naive_qlike,
        (SELECT round(rmse_log_mean, 5) FROM summary WHERE model = 'har') AS har_rmse,
        cast(13 AS integer) AS profiled""",
    "model_reload": f"""{MODELS} {LATEST}, best AS (
        SELECT model, qlike_improvement_vs_naive AS gain FROM summary ORDER BY qlike_mean, model LIMIT 1)
      SELECT ticker, 'har' AS model_name, round({_HAR_VOL}, 6) AS forecast_vol
      FROM latest JOIN har ON scope = -1 JOIN best ON model = 'har' AND gain >= -1""",
    "model_in_use": f"""{MODELS} {LATEST}, best AS (
        SELECT model, qlike_improvement_vs_naive AS gain FROM summary ORDER BY qlike_mean, model LIMIT 1)
      SELECT ticker, 'v10' AS model_version, round({_HAR_VOL}, 6) AS forecast_vol
      FROM latest JOIN har ON scope = -1 JOIN best ON model = 'har' AND gain >= -1""",
    "other_vendor_refused": """SELECT unnest(['batch', 'stream']) AS path, true AS refused,
      (SELECT count(*) FROM landed) AS bars""",
    "stream_ingest": f"""{ONE_RUN} SELECT date, ticker, {r6(_PRICES)}, 'derived' AS source,
      DATE '2002-01-01' AS ingest_date, 'feed-000000000' AS run_id FROM good""",
    "stream_manifest": f"""{ONE_RUN} SELECT 'feed-000000000' AS run_id, 'derived' AS source,
      (SELECT count(*) FROM raw) AS rows_fetched, (SELECT count(*) FROM good) AS rows_landed,
      (SELECT count(*) FROM one WHERE _reject_reason <> '') AS rows_quarantined,
      (SELECT count(*) FROM raw) - (SELECT count(*) FROM one) AS duplicates_dropped""",
    "stream_ingest_counts": f"""{ONE_RUN} {_counts(
        {"bronze": "good", "quarantine": "one WHERE _reject_reason <> ''", "staged": "good"})}""",
}

_EVENT_BARS = """SELECT event_type AS ticker, cast(ts AS date) AS date,
    round(arg_min(value, ts), 6) AS open, round(max(value), 6) AS high, round(min(value), 6) AS low,
    round(arg_max(value, ts), 6) AS close, count(*) AS trades
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2"""

_SUMMARY = f"""{MODELS}, best AS (SELECT * FROM summary ORDER BY qlike_mean, model LIMIT 1)
  {_counts({
      "staged": "good",
      "daily_returns": "returns",
      "features_volatility": "features",
      "monthly_summary": "monthly",
      "bronze": "good",
      "quarantine": "one WHERE _reject_reason <> ''",
      "landed": "good",
  })}
  UNION ALL SELECT 'forecasts', count(DISTINCT ticker) FROM features
    JOIN best ON model = 'har' AND qlike_improvement_vs_naive >= -1
  UNION ALL SELECT 'published', CASE WHEN model = 'har' THEN 10 ELSE 6 END FROM best"""
# Trees take part as well, by values no SQL knows: where HAR is better than persistence, some model is promoted.


def lake_sql() -> dict[str, str]:
    return {
        **{name: BASE + body for name, body in LAKE_SQL.items()},
        "pipeline_summary": ONE_RUN_BASE + _SUMMARY,
        "event_bars": _EVENT_BARS,
        "event_bars_stream": _EVENT_BARS,
    }
