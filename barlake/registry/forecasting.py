"""Queries over folds, candidate models, scoring, drift and live accuracy."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.contract import split_feature_vectors
from barlake.operators.drift import drift_report, feature_profiles, profile_frame
from barlake.operators.folds import (
    everything,
    fold_ends,
    fold_frame,
    holdout_scopes,
    session_calendar,
    walk_forward,
)
from barlake.operators.linear import (
    Linear,
    cell_moments,
    fit_linear,
    linear_frame,
    log_design,
    scope_moments,
)
from barlake.operators.upsert import ForecastTable
from barlake.operators.quantiles import exact_quantiles
from barlake.plans.monitoring import health, live_accuracy, matured_forecasts, recent_sessions
from barlake.plans.scoring import for_ticker, latest_features, predict_vol, score
from barlake.plans.training import (
    Champion,
    TrainResult,
    choose,
    cross_validate,
    cv_summary,
    data_profile,
    feature_importance,
    fit_final,
    fold_metrics,
    labelled_rows,
    ticker_list,
    train,
)
from barlake.registry.relational import features_feed, rounded
from barlake.schema import MODEL_FEATURES
from barlake.settings import Settings
from barlake.workspace import materialise, small_frame, work_path

LINEAR = Settings(candidates=("naive", "har"))
SCORED_AT = datetime(2002, 1, 2)
# All candidates, every default: 400 trees for each of the folds, their probes and the final fit.
WHOLE = Settings()


def features_table(spark, sf) -> DataFrame:
    return materialise(features_feed(spark, sf), "features")


def labelled_table(spark, sf) -> DataFrame:
    return materialise(labelled_rows(features_feed(spark, sf)), "labelled")


def folds_and_scopes(labelled: DataFrame, settings: Settings = LINEAR):
    calendar = session_calendar(labelled)
    folds = walk_forward(
        [d for d, _ in calendar],
        settings.n_splits,
        settings.test_days,
        settings.min_train_days,
        settings.horizon,
    )
    ends = [*fold_ends(folds), everything(calendar)]
    return folds, holdout_scopes(labelled, calendar, ends, settings.holdout)


def final_model(labelled: DataFrame, name: str) -> Champion:
    calendar = session_calendar(labelled)
    scopes = holdout_scopes(labelled, calendar, [everything(calendar)])
    (model,) = fit_linear(log_design(labelled), scopes, [name])
    return Champion(name, linear=model, smear=model.smear)


def card(name: str, version: str) -> dict:
    return {"champion": name, "version": version, "horizon_days": 5}


def q_labelled_rows(spark, sf):
    labelled = labelled_rows(features_feed(spark, sf))
    return rounded(labelled.select("ticker", "date", "rv_5d", "target_rv_fwd"))


def q_data_profile(spark, sf):
    labelled = labelled_table(spark, sf)
    return data_profile(labelled)


def q_ticker_list(spark, sf):
    return ticker_list(labelled_rows(features_feed(spark, sf)))


def q_walk_forward_folds(spark, sf):
    folds, _ = folds_and_scopes(labelled_table(spark, sf))
    return fold_frame(spark, folds)


def q_fold_row_counts(spark, sf):
    """Rows each fold trains on, leaves out as embargo, and tests on."""
    labelled = labelled_table(spark, sf)
    folds, _ = folds_and_scopes(labelled)
    day = F.col("date")
    spans = {
        "train_rows": day < F.col("train_end"),
        "embargo_rows": (day >= F.col("train_end")) & (day < F.col("test_start")),
        "test_rows": day.between(F.col("test_start"), F.col("test_end")),
    }
    per_day = labelled.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_day.join(F.broadcast(fold_frame(spark, folds)), day <= F.col("test_end"))
        .groupBy("fold")
        .agg(*[F.sum(F.when(span, F.col("n")).otherwise(0)).alias(n) for n, span in spans.items()])
    )


def q_holdout_sizes(spark, sf):
    """Fitted and held-out rows per training set, counted from the rows themselves."""
    labelled = labelled_table(spark, sf)
    _, scopes = folds_and_scopes(labelled)
    counts = [
        labelled.where(s.contains()).agg(
            F.lit(s.number).alias("scope"),
            F.count_if(s.fitted()).alias("fit_rows"),
            F.count_if(~s.fitted()).alias("held_out_rows"),
        )
        for s in scopes
    ]
    frame = counts[0]
    for c in counts[1:]:
        frame = frame.unionByName(c)
    return frame


def q_har_moments(spark, sf):
    """The sums behind the least-squares fits, per training set and its fitted part."""
    labelled = labelled_table(spark, sf)
    _, scopes = folds_and_scopes(labelled)
    moments = scope_moments(cell_moments(log_design(labelled), scopes), scopes)
    return rounded(
        moments.select(
            "scope", "all_n", "fit_n", "all_s_y", "fit_s_y", "all_s_l21_y", "fit_s_l5_l63"
        )
    )


def q_har_coefficients(spark, sf):
    labelled = labelled_table(spark, sf)
    _, scopes = folds_and_scopes(labelled)
    models = fit_linear(log_design(labelled), scopes, ["har"])
    return rounded(linear_frame(spark, models))


def q_naive_smears(spark, sf):
    labelled = labelled_table(spark, sf)
    _, scopes = folds_and_scopes(labelled)
    models = fit_linear(log_design(labelled), scopes, ["naive"])
    return rounded(linear_frame(spark, models).select("scope", "smear"))


def q_linear_oos(spark, sf):
    """Out-of-sample rows of persistence and HAR over all folds."""
    return rounded(cross_validate(labelled_table(spark, sf), LINEAR).out_of_sample)


def q_naive_smeared_oos(spark, sf):
    only = replace(LINEAR, candidates=("naive",))
    return rounded(cross_validate(labelled_table(spark, sf), only).out_of_sample)


def q_fold_metrics(spark, sf):
    return rounded(fold_metrics(cross_validate(labelled_table(spark, sf), LINEAR)))


def q_cv_summary(spark, sf):
    return rounded(cv_summary(fold_metrics(cross_validate(labelled_table(spark, sf), LINEAR))))


def q_champion_gate(spark, sf):
    summary = cv_summary(fold_metrics(cross_validate(labelled_table(spark, sf), LINEAR)))
    name, gain, promoted = choose(summary, LINEAR.min_improvement)
    row = [(name, round(gain, 6), promoted)]
    return small_frame(spark, row, "champion string, improvement double, promoted boolean")


_trained: dict[tuple, tuple[str, TrainResult]] = {}


def trained(spark, sf) -> tuple[str, TrainResult]:
    """The whole training run, all candidates under default settings, and where its models are. Queries of one
    application share it: it is written to the shared folder."""
    key = spark.sparkContext.applicationId, sf
    if key not in _trained:
        models = work_path(spark, "models")
        _trained[key] = models, train(features_table(spark, sf), models, WHOLE, version="v1")
    return _trained[key]


def q_gbt_oos_metrics(spark, sf):
    """Fold metrics of the boosted trees."""
    _, result = trained(spark, sf)
    return result.folds.where("model = 'trees'")


def q_gbt_properties(spark, sf):
    """Rows that persistence and trees are measured on, in every fold, and whether the loss is a sound number."""
    folds = trained(spark, sf)[1].folds.where("model in ('naive', 'trees')")
    sound = F.col("qlike").between(0, 100) & F.col("rmse_log").between(0, 100)
    return folds.select("fold", "model", "train_rows", "test_rows", sound.alias("sound"))


def q_selection(spark, sf):
    """Summary of all three candidates, their order, and which one is promoted."""
    _, result = trained(spark, sf)
    return rounded(result.summary).withColumn(
        "promoted", (F.col("model") == F.lit(result.champion)) & F.lit(result.promoted)
    )


def q_feature_importance(spark, sf):
    """Shares of gain of the boosted trees fitted on all labelled rows."""
    labelled = labelled_table(spark, sf)
    _, result = trained(spark, sf)
    return feature_importance(spark, fit_final(labelled, result.validation, "trees", WHOLE))


def q_importance_properties(spark, sf):
    """Features with a share of gain, and whether the shares are shares."""
    shares = q_feature_importance(spark, sf)
    return shares.agg(
        F.count_distinct("feature").alias("features"),
        (F.abs(F.sum("gain") - 1) < 1e-6).alias("whole"),
        (F.min("gain") >= 0).alias("positive"),
    )


def q_latest_features(spark, sf):
    return rounded(latest_features(features_feed(spark, sf)))


def q_forecasts_naive(spark, sf):
    features = features_table(spark, sf)
    model = final_model(labelled_rows(features), "naive")
    return rounded(score(latest_features(features), model, card("naive", "v1"), SCORED_AT))


def q_forecasts_har(spark, sf):
    features = features_table(spark, sf)
    model = final_model(labelled_rows(features), "har")
    return rounded(score(latest_features(features), model, card("har", "v1"), SCORED_AT))


def q_forecasts_stale(spark, sf):
    """The newest rows before and after a cut: tickers whose bars stopped are stale."""
    features = features_table(spark, sf)
    newest = features.agg(F.max("date")).first()[0]
    quiet = (F.length("ticker") < 8) & (F.col("date") > F.lit(newest - timedelta(days=30)))
    model = Champion("naive", linear=Linear(-1, "naive", 0.0, (0.0, 1.0, 0.0)))
    scored = score(latest_features(features.where(~quiet)), model, card("naive", "v1"), SCORED_AT)
    return rounded(scored.select("ticker", "as_of_date", "is_stale", "forecast_vol"))


def q_ticker_lookup(spark, sf):
    """One ticker's forecast, asked for in lower case; staleness against all tickers."""
    features = features_table(spark, sf)
    model = Champion("naive", linear=Linear(-1, "naive", 0.0, (0.0, 1.0, 0.0)))
    one = for_ticker(latest_features(features), "brand.13")
    return rounded(score(one, model, card("naive", "v1"), SCORED_AT, freshest=features))


def q_forecast_upsert(spark, sf):
    """Three batches into one keyed table: a backfill, a re-score of its newest rows, a new version."""
    features = features_table(spark, sf)
    table = ForecastTable(spark, work_path(spark, "forecasts"))
    monthly = Champion("naive", linear=Linear(-1, "naive", 0.0, (0.0, 1.0, 0.0)))
    weekly = Champion("weekly", linear=Linear(-1, "weekly", 0.0, (1.0, 0.0, 0.0)))
    newest = latest_features(features)
    table.upsert(score(features, monthly, card("naive", "v1"), SCORED_AT))
    table.upsert(score(newest, weekly, card("weekly", "v1"), SCORED_AT + timedelta(days=1)))
    table.upsert(score(newest, weekly, card("weekly", "v2"), SCORED_AT + timedelta(days=1)))
    return rounded(table.read().drop("is_stale"))


def q_recent_sessions(spark, sf):
    recent = recent_sessions(features_table(spark, sf))
    return rounded(recent.select("ticker", "date", "rv_21d"))


def backdated(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Features, and persistence forecasts for every one of their rows."""
    features = features_table(spark, sf)
    model = Champion("naive", linear=Linear(-1, "naive", 0.0, (0.0, 1.0, 0.0)))
    return features, score(features, model, card("naive", "v1"), SCORED_AT)


def q_matured_forecasts(spark, sf):
    features, forecasts = backdated(spark, sf)
    return rounded(matured_forecasts(forecasts, features))


def q_live_accuracy(spark, sf):
    features, forecasts = backdated(spark, sf)
    return rounded(live_accuracy(matured_forecasts(forecasts, features)))


def q_drift_profile(spark, sf):
    """Bin edges and training shares per feature."""
    frame = profile_frame(spark, feature_profiles(labelled_table(spark, sf)))
    lower = F.when(F.col("bin") > 0, F.get("edges", F.col("bin") - 1))
    return rounded(
        frame.select("feature", "edges", F.posexplode("proportions").alias("bin", "proportion"))
        .select("feature", "bin", lower.alias("lower_edge"), "proportion")
    )


def q_quantiles_cornered(spark, sf):
    """Deciles of every feature where an interval may hold two thousand values only: several passes of cornering."""
    fractions = [i / 10 for i in range(11)]
    found = exact_quantiles(labelled_table(spark, sf), MODEL_FEATURES, fractions, sorted_rows=2000)
    rows = [(f, i, v) for f in MODEL_FEATURES for i, v in enumerate(found[f])]
    return rounded(small_frame(spark, rows, "feature string, decile int, value double"))


def q_coefficients(spark, sf):
    """What a promoted linear model tells of its features."""
    labelled = labelled_table(spark, sf)
    return rounded(feature_importance(spark, final_model(labelled, "har")))


def q_psi_report(spark, sf):
    features = features_table(spark, sf)
    profiles = feature_profiles(labelled_rows(features))
    return drift_report(profiles, recent_sessions(features))


def q_health(spark, sf):
    """The verdict of the monitoring run, with 0.3 as the validated loss."""
    features, forecasts = backdated(spark, sf)
    profiles = feature_profiles(labelled_rows(features), MODEL_FEATURES)
    drift = drift_report(profiles, recent_sessions(features))
    live = live_accuracy(matured_forecasts(forecasts, features))
    verdict = health(drift, live, "v1", 0.3)
    joined = {
        c: F.array_join(c, ",") for c in ("drifted_features", "regime_shift_features")
    }
    return rounded(verdict.withColumns(joined))


def q_adhoc_forecasts(spark, sf):
    """Feature vectors as a caller might send them: limits first, then a forecast per valid vector."""
    spoiled = F.when(F.col("day_of_week") == 2, -F.col("rv_5d")).otherwise(F.col("rv_5d"))
    vectors = features_feed(spark, sf).select("ticker", "date", *MODEL_FEATURES)
    valid, _ = split_feature_vectors(vectors.withColumn("rv_5d", spoiled))
    weekly = Champion("weekly", linear=Linear(-1, "weekly", 0.1, (0.5, 0.3, 0.2)))
    return rounded(predict_vol(weekly, valid).select("ticker", "date", "forecast_vol"))
