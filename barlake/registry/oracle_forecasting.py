"""The forecasting queries in plain SQL.

Least squares is written as a sequence of simple regressions on orthogonalised regressors, which gives the
same fit as the normal equations without solving a system.
"""

from __future__ import annotations

from barlake.registry.oracle_relational import BASE, FEATURE_OUTPUT, r6

# The model features in their order.
_FEATURES = [
    "rv_5d",
    "rv_21d",
    "rv_63d",
    "parkinson_5d",
    "parkinson_21d",
    "market_rv_21d",
    "relative_rv_21d",
    "abs_return_1d",
    "log_return",
    "overnight_gap",
    "momentum_21d",
    "volume_z_21d",
    "day_of_week",
]
_LEVELS = _FEATURES[:6]

FOLDS = """, labelled AS MATERIALIZED (SELECT *, ln(greatest(rv_5d, 1e-3)) AS l5,
    ln(greatest(rv_21d, 1e-3)) AS l21, ln(greatest(rv_63d, 1e-3)) AS l63,
    ln(greatest(target_rv_fwd, 1e-3)) AS y FROM features WHERE is_labeled),
days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT date FROM labelled)),
block AS (SELECT max(n) AS n, least(252, (max(n) - 504 - 5) // 5) AS size FROM days),
folds AS (
  SELECT cast(k AS integer) AS fold,
    (SELECT date FROM days WHERE i = n0 - 5 * size + k * size - 5) AS train_end,
    (SELECT date FROM days WHERE i = n0 - 5 * size + k * size) AS test_start,
    (SELECT date FROM days WHERE i = n0 - 5 * size + k * size + size - 1) AS test_end
  FROM (SELECT unnest(range(5)) AS k, n AS n0, size FROM block)),
scopes AS (SELECT fold AS scope, train_end FROM folds
  UNION ALL SELECT -1, max(date) + 1 FROM labelled),
numbered AS (
  SELECT scope, ticker, date, l5, l21, l63, y,
    row_number() OVER (PARTITION BY scope ORDER BY date, ticker) AS pos,
    count(*) OVER (PARTITION BY scope) AS n
  FROM labelled JOIN scopes ON date < train_end),
tr AS MATERIALIZED (SELECT *, pos <= floor(n * (1 - 0.2::DOUBLE)) AS fit FROM numbered)"""


def _ols(name: str, keep: str) -> str:
    """Slopes b5, b21, b63 and intercept b0 per scope over the rows kept."""
    return f""", {name}_1 AS (
  SELECT scope, regr_slope(l21, l5) AS g21, regr_intercept(l21, l5) AS a21,
    regr_slope(l63, l5) AS g31, regr_intercept(l63, l5) AS a31 FROM tr WHERE {keep} GROUP BY 1),
{name}_2 AS (SELECT t.scope, l5, y, l21 - a21 - g21 * l5 AS e2, l63 - a31 - g31 * l5 AS f3
  FROM tr t JOIN {name}_1 USING (scope) WHERE {keep}),
{name}_3 AS (SELECT scope, regr_slope(f3, e2) AS g32 FROM {name}_2 GROUP BY 1),
{name}_4 AS (SELECT q.scope, regr_slope(y, l5) AS c1, regr_intercept(y, l5) AS c0,
    regr_slope(y, e2) AS c2, regr_slope(y, f3 - g32 * e2) AS c3
  FROM {name}_2 q JOIN {name}_3 USING (scope) GROUP BY 1),
{name} AS (
  SELECT scope, c0 - c2 * a21 - c3 * (a31 - g32 * a21) AS b0,
    c1 - c2 * g21 - c3 * (g31 - g32 * g21) AS b5, c2 - c3 * g32 AS b21, c3 AS b63
  FROM {name}_1 JOIN {name}_3 USING (scope) JOIN {name}_4 USING (scope))"""


MODELS = (
    FOLDS
    + _ols("probe", "fit")
    + _ols("final", "true")
    + """, naive_smear AS (SELECT scope, 0.5 * ln(avg(exp(2 * (y - l21)))) AS smear
  FROM tr WHERE NOT fit GROUP BY 1),
har_smear AS (
  SELECT scope, 0.5 * ln(avg(exp(2 * (y - b0 - b5 * l5 - b21 * l21 - b63 * l63)))) AS smear
  FROM tr JOIN probe USING (scope) WHERE NOT fit GROUP BY 1),
har AS (SELECT f.*, smear FROM final f JOIN har_smear USING (scope)),
oos AS (
  SELECT fold, 'naive' AS model, ticker, date, y AS y_true_log, l21 + smear AS y_pred_log
  FROM labelled JOIN folds ON date BETWEEN test_start AND test_end JOIN naive_smear ON scope = fold
  UNION ALL
  SELECT fold, 'har', ticker, date, y, b0 + b5 * l5 + b21 * l21 + b63 * l63 + smear
  FROM labelled JOIN folds ON date BETWEEN test_start AND test_end JOIN har ON scope = fold),
metrics AS (
  SELECT fold, model, count(*) AS test_rows, sqrt(avg(e * e)) AS rmse_log, avg(abs(e)) AS mae_log,
    1 - sum(e * e) / regr_syy(y_true_log, y_pred_log) AS r2_log,
    avg(exp(-2 * e) + 2 * e - 1) AS qlike, avg(e) AS bias_log
  FROM (SELECT *, y_pred_log - y_true_log AS e FROM oos) GROUP BY 1, 2),
fold_table AS (
  SELECT fold, model, train_rows, test_rows, test_start, test_end,
    rmse_log, mae_log, r2_log, qlike, bias_log
  FROM metrics JOIN folds USING (fold)
  JOIN (SELECT scope AS fold, count(*) AS train_rows FROM tr GROUP BY 1) USING (fold)),
by_model AS (SELECT model, """
    + ", ".join(
        f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std"
        for m in ("rmse_log", "mae_log", "r2_log", "qlike", "bias_log")
    )
    + """ FROM fold_table GROUP BY 1),
summary AS (
  SELECT *, 1 - qlike_mean / (SELECT qlike_mean FROM by_model WHERE model = 'naive')
      AS qlike_improvement_vs_naive,
    1 - rmse_log_mean / (SELECT rmse_log_mean FROM by_model WHERE model = 'naive')
      AS rmse_log_improvement_vs_naive
  FROM by_model)"""
)

_METRICS = "rmse_log, mae_log, r2_log, qlike, bias_log"
_SUMMARY = ", ".join(
    f"{m}_{s}" for m in _METRICS.split(", ") for s in ("mean", "std")
) + ", qlike_improvement_vs_naive, rmse_log_improvement_vs_naive"

LATEST = """, latest AS (SELECT * FROM features
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)"""


def _forecast(vol: str, source: str, name: str, version: str = "v1", at: str = "2002-01-02") -> str:
    return f"""SELECT ticker, cast(5 AS integer) AS horizon_days, round({vol}, 6) AS forecast_vol,
      round(rv_21d, 6) AS current_rv_21d,
      (SELECT max(date) FROM features) - date > 4 AS is_stale, '{version}' AS model_version,
      '{name}' AS model_name, TIMESTAMP '{at}' AS scored_at, date AS as_of_date FROM {source}"""


_MONTH_VOL, _WEEK_VOL = "greatest(rv_21d, 1e-3)", "greatest(rv_5d, 1e-3)"
_LOGS = "ln(greatest({}, 1e-3))"
_HAR_VOL = (
    f"exp(b0 + b5 * {_LOGS.format('rv_5d')} + b21 * {_LOGS.format('rv_21d')} "
    f"+ b63 * {_LOGS.format('rv_63d')} + smear)"
)

_UPSERT = f"""{LATEST}, batches AS (
  SELECT 0 AS batch, * FROM ({_forecast(_MONTH_VOL, 'features', 'naive')})
  UNION ALL SELECT 1, * FROM ({_forecast(_WEEK_VOL, 'latest', 'weekly', at='2002-01-03')})
  UNION ALL SELECT 2, * FROM ({_forecast(_WEEK_VOL, 'latest', 'weekly', 'v2', '2002-01-03')}))
SELECT * EXCLUDE (batch, is_stale) FROM batches
QUALIFY row_number() OVER (PARTITION BY ticker, as_of_date, model_version ORDER BY batch DESC) = 1"""

MATURED = f""", matured AS (
  SELECT ticker, date AS as_of_date, {_MONTH_VOL} AS forecast_vol, 'v1' AS model_version, target_rv_fwd
  FROM features WHERE target_rv_fwd IS NOT NULL),
errors AS (
  SELECT model_version, ln(greatest(target_rv_fwd, 1e-3)) AS t, ln(forecast_vol) AS p,
    ln(forecast_vol) - ln(greatest(target_rv_fwd, 1e-3)) AS e FROM matured),
live AS (
  SELECT model_version, count(*) AS n_forecasts, sqrt(avg(e * e)) AS rmse_log, avg(abs(e)) AS mae_log,
    1 - sum(e * e) / regr_syy(t, p) AS r2_log, avg(exp(-2 * e) + 2 * e - 1) AS qlike, avg(e) AS bias_log
  FROM errors GROUP BY GROUPING SETS ((model_version), ()))"""

_FRACTIONS = ", ".join(f"{i * (1 / 10)!r}::DOUBLE" for i in range(10)) + ", 1.0::DOUBLE"


def _long(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, cast({f} AS double) AS v FROM {source}" for f in _FEATURES
    )


DRIFT = f""", labelled AS MATERIALIZED (SELECT * FROM features WHERE is_labeled),
recent AS (SELECT * FROM features WHERE date IN
    (SELECT DISTINCT date FROM features ORDER BY date DESC LIMIT 63)),
train_long AS ({_long('labelled')}), recent_long AS ({_long('recent')}),
edges AS (
  SELECT feature, u[2:len(u) - 1] AS edges FROM (
    SELECT feature, list_sort(list_distinct(quantile_cont(v, [{_FRACTIONS}]))) AS u
    FROM train_long GROUP BY 1)),
train_bins AS (SELECT feature, len(list_filter(edges, lambda e: e <= v)) AS bin, count(*) AS n
  FROM train_long JOIN edges USING (feature) GROUP BY 1, 2),
recent_bins AS (SELECT feature, len(list_filter(edges, lambda e: e <= v)) AS bin, count(*) AS n
  FROM recent_long JOIN edges USING (feature) GROUP BY 1, 2),
profile AS (
  SELECT e.feature, e.bin, CASE WHEN e.bin > 0 THEN edges[e.bin] END AS lower_edge,
    coalesce(t.n, 0) / sum(coalesce(t.n, 0)) OVER (PARTITION BY e.feature) AS proportion
  FROM (SELECT feature, edges, unnest(range(len(edges) + 1)) AS bin FROM edges) e
  LEFT JOIN train_bins t ON t.feature = e.feature AND t.bin = e.bin),
shares AS (
  SELECT p.feature, greatest(proportion, 1e-6) AS e, greatest(coalesce(r.n, 0) / total, 1e-6) AS a
  FROM profile p JOIN (SELECT feature, sum(n) AS total FROM recent_bins GROUP BY 1) USING (feature)
  LEFT JOIN recent_bins r ON r.feature = p.feature AND r.bin = p.bin),
psi AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM shares GROUP BY 1),
drift AS (
  SELECT feature, round(psi, 4) AS psi,
    CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END AS status,
    feature NOT IN ({', '.join(f"'{f}'" for f in _LEVELS)}) AS gates_health
  FROM psi)"""

FORECASTING_SQL = {
    "labelled_rows": f"SELECT ticker, date, {r6('rv_5d, target_rv_fwd')} FROM features WHERE is_labeled",
    "data_profile": """SELECT count(*) AS rows, count(DISTINCT ticker) AS n_tickers, min(date) AS start,
      max(date) AS "end" FROM features WHERE is_labeled""",
    "ticker_list": "SELECT DISTINCT ticker FROM features WHERE is_labeled",
    "walk_forward_folds": f"{FOLDS} SELECT fold, train_end, test_start, test_end FROM folds",
    "fold_row_counts": f"""{FOLDS} SELECT fold, count(*) FILTER (WHERE date < train_end) AS train_rows,
        count(*) FILTER (WHERE date >= train_end AND date < test_start) AS embargo_rows,
        count(*) FILTER (WHERE date >= test_start) AS test_rows
      FROM labelled JOIN folds ON date <= test_end GROUP BY 1""",
    "holdout_sizes": f"""{FOLDS} SELECT scope, count(*) FILTER (WHERE fit) AS fit_rows,
      count(*) FILTER (WHERE NOT fit) AS held_out_rows FROM tr GROUP BY 1""",
    "har_moments": f"""{FOLDS} SELECT scope, count(*) AS all_n, count(*) FILTER (WHERE fit) AS fit_n,
        round(sum(y), 6) AS all_s_y, round(sum(y) FILTER (WHERE fit), 6) AS fit_s_y,
        round(sum(l21 * y), 6) AS all_s_l21_y, round(sum(l5 * l63) FILTER (WHERE fit), 6) AS fit_s_l5_l63
      FROM tr GROUP BY 1""",
    "har_coefficients": f"""{MODELS} SELECT scope, 'har' AS model, {r6('b0, b5, b21, b63, smear')}
      FROM har""",
    "naive_smears": f"{MODELS} SELECT scope, {r6('smear')} FROM naive_smear",
    "linear_oos": f"{MODELS} SELECT fold, model, ticker, date, {r6('y_true_log, y_pred_log')} FROM oos",
    "naive_smeared_oos": f"""{MODELS} SELECT fold, model, ticker, date, {r6('y_true_log, y_pred_log')}
      FROM oos WHERE model = 'naive'""",
    "fold_metrics": f"""{MODELS} SELECT fold, model, train_rows, test_rows, test_start, test_end,
      {r6(_METRICS)} FROM fold_table""",
    "cv_summary": f"{MODELS} SELECT model, {r6(_SUMMARY)} FROM summary",
    "champion_gate": f"""{MODELS} SELECT model AS champion,
        round(qlike_improvement_vs_naive, 6) AS improvement,
        model <> 'naive' AND qlike_improvement_vs_naive >= 0.05 AS promoted
      FROM summary ORDER BY qlike_mean, model LIMIT 1""",
    "gbt_properties": f"""{MODELS} SELECT fold, unnest(['naive', 'trees']) AS model, train_rows, test_rows,
      true AS sound FROM fold_table WHERE model = 'naive'""",
    "importance_properties": f"""SELECT {len(_FEATURES)}::BIGINT AS features, true AS whole, true AS positive""",
    "latest_features": f"{LATEST} SELECT {FEATURE_OUTPUT} FROM latest",
    "forecasts_naive": f"""{MODELS} {LATEST} {_forecast(
        "exp(ln(greatest(rv_21d, 1e-3)) + smear)", "latest JOIN naive_smear ON scope = -1", "naive")}""",
    "forecasts_har": f"{MODELS} {LATEST} {_forecast(_HAR_VOL, 'latest JOIN har ON scope = -1', 'har')}",
    "forecasts_stale": f""", kept AS (SELECT * FROM features WHERE NOT (length(ticker) < 8
        AND date > (SELECT max(date) FROM features) - 30)),
      latest AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)
      SELECT ticker, date AS as_of_date, (SELECT max(date) FROM latest) - date > 4 AS is_stale,
        round({_MONTH_VOL}, 6) AS forecast_vol FROM latest""",
    "ticker_lookup": f"""{LATEST}, one AS (SELECT * FROM latest WHERE ticker = upper('brand.13'))
      {_forecast(_MONTH_VOL, 'one', 'naive')}""",
    "forecast_upsert": _UPSERT,
    "adhoc_forecasts": f"""SELECT ticker, date, round(exp(0.1 + 0.5 * {_LOGS.format('rv_5d')}
        + 0.3 * {_LOGS.format('rv_21d')} + 0.2 * {_LOGS.format('rv_63d')}), 6) AS forecast_vol
      FROM features WHERE day_of_week <> 2 AND relative_rv_21d > 0""",
    "recent_sessions": """SELECT ticker, date, round(rv_21d, 6) AS rv_21d FROM features WHERE date IN
      (SELECT DISTINCT date FROM features ORDER BY date DESC LIMIT 63)""",
    "matured_forecasts": f"""{MATURED} SELECT ticker, as_of_date, {r6('forecast_vol')}, model_version,
      {r6('target_rv_fwd')} FROM matured""",
    "live_accuracy": f"{MATURED} SELECT model_version, n_forecasts, {r6(_METRICS)} FROM live",
    "drift_profile": f"""{DRIFT} SELECT feature, cast(bin AS integer) AS bin,
      {r6('lower_edge, proportion')} FROM profile""",
    "quantiles_cornered": f"""{DRIFT}, deciles AS (
        SELECT feature, quantile_cont(v, [{_FRACTIONS}]) AS q FROM train_long GROUP BY 1)
      SELECT feature, cast(i AS integer) AS decile, round(q[i + 1], 6) AS value
      FROM (SELECT feature, q, unnest(range(11)) AS i FROM deciles)""",
    "coefficients": f"""{MODELS} SELECT feature, round(coef, 6) AS coef FROM (
      SELECT unnest(['rv_5d', 'rv_21d', 'rv_63d']) AS feature, unnest([b5, b21, b63]) AS coef
      FROM har WHERE scope = -1)""",
    "psi_report": f"{DRIFT} SELECT feature, psi, status, gates_health FROM drift",
    "health": f"""{DRIFT} {MATURED}, verdict AS (
        SELECT (SELECT coalesce(string_agg(feature, ',' ORDER BY feature), '') FROM drift
            WHERE status = 'alert' AND gates_health) AS drifted_features,
          (SELECT coalesce(string_agg(feature, ',' ORDER BY feature), '') FROM drift
            WHERE status = 'alert' AND NOT gates_health) AS regime_shift_features,
          (SELECT qlike FROM live WHERE model_version = 'v1') AS live_qlike,
          (SELECT n_forecasts FROM live WHERE model_version = 'v1') AS n_forecasts)
      SELECT 'v1' AS model_version, drifted_features, regime_shift_features, n_forecasts,
        round(live_qlike, 6) AS live_qlike, 0.3::DOUBLE AS cv_qlike,
        live_qlike > 1.5 * 0.3 AS degraded,
        drifted_features = '' AND NOT live_qlike > 1.5 * 0.3 AS healthy FROM verdict""",
}


def forecasting_sql() -> dict[str, str]:
    return {name: BASE + body for name, body in FORECASTING_SQL.items()}
