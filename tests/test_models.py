from dataclasses import replace
from datetime import date, datetime, timedelta
from itertools import pairwise

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.functions.losses import metric_columns, qlike, smearing
from barlake.operators.drift import drift_report, feature_profiles
from barlake.operators.folds import (
    everything,
    holdout_scopes,
    ranked_tickers,
    session_calendar,
    walk_forward,
)
from barlake.operators.linear import fit_linear, log_design
from barlake.operators.quantiles import exact_quantiles
from barlake.operators.upsert import ForecastTable
from barlake.plans.monitoring import live_accuracy, matured_forecasts, monitor, recent_sessions
from barlake.plans.scoring import for_ticker, latest_features, score
from barlake.plans.training import (
    NoTrainingData,
    cross_validate,
    fold_metrics,
    labelled_rows,
    load_card,
    load_champion,
    train,
)
from barlake.schema import FORECAST_SCHEMA, LEVEL_FEATURES, MODEL_FEATURES
from barlake.settings import Settings, TreeSettings
from barlake.workspace import materialise

SMALL = Settings(n_splits=3, test_days=126, min_train_days=504, candidates=("naive", "har"))
NOW = datetime(2024, 1, 1)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 400), st.integers(1, 7), st.integers(1, 60), st.integers(1, 120), st.integers(0, 12))
def test_folds_of_any_calendar(sessions, n_splits, test_days, min_train, embargo):
    """Test blocks follow each other up to the last session, each with a whole embargo behind its training."""
    days = [date(2021, 3, 1) + timedelta(days=3 * k) for k in range(sessions)]
    if sessions - min_train - embargo < n_splits:
        with pytest.raises(ValueError, match="too few sessions"):
            walk_forward(days, n_splits, test_days, min_train, embargo)
        return
    folds = walk_forward(days[::-1] + days[:3], n_splits, test_days, min_train, embargo)
    block = min(test_days, (sessions - min_train - embargo) // n_splits)
    starts = [days.index(f.test_start) for f in folds]
    assert [f.number for f in folds] == list(range(n_splits))
    assert starts == [sessions - (n_splits - k) * block for k in range(n_splits)]
    assert [days.index(f.test_end) + 1 for f in folds] == [s + block for s in starts]
    assert [days.index(f.train_end) for f in folds] == [s - embargo for s in starts]
    assert starts[0] - embargo >= min_train


def test_qlike_falls_to_zero_from_both_sides_and_faster_from_below(spark):
    ratios = [0.25, 0.5, 0.9, 1.0, 1.1, 2.0, 4.0]
    rows = spark.createDataFrame([(r, 0.17, 0.17 * r) for r in ratios], "r double, y double, p double")
    by_ratio = rows.groupBy("r").agg(qlike(F.col("y"), F.col("p")).alias("loss")).orderBy("r")
    loss = [r["loss"] for r in by_ratio.collect()]
    assert loss[3] == pytest.approx(0, abs=1e-12)
    assert loss[:4] == sorted(loss[:4], reverse=True) and loss[3:] == sorted(loss[3:])
    assert all(under > over for under, over in zip(loss[:3], loss[:3:-1]))


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(3)
    t = rng.normal(-1.5, 0.4, 400)
    p = t + rng.normal(0.05, 0.3, 400)
    row = spark.createDataFrame(pd.DataFrame({"t": t, "p": p})).agg(*metric_columns(F.col("t"), F.col("p"))).first()
    e = p - t
    ratio = np.exp(2 * (t - p))
    want = [np.sqrt(np.mean(e**2)), np.mean(abs(e)), 1 - np.sum(e**2) / np.sum((t - t.mean()) ** 2),
            np.mean(ratio - np.log(ratio) - 1), e.mean()]
    assert np.allclose(list(row), want, atol=1e-12)
    flat = spark.createDataFrame([(0.5, 0.4)] * 3, "t double, p double")
    assert flat.agg(*metric_columns(F.col("t"), F.col("p"))).first()["r2_log"] is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1.5, 1.5), min_size=1, max_size=40))
def test_smeared_forecasts_have_the_mean_variance_of_what_came(spark, residuals):
    """With y = p + residual, exp(2 (p + smear)) and exp(2 y) have the same mean for any constant p."""
    df = spark.createDataFrame([(r,) for r in residuals], "r double")
    smear = df.agg(smearing(F.col("r"))).first()[0]
    assert np.exp(2 * smear) == pytest.approx(np.mean(np.exp(2 * np.array(residuals))))


@pytest.fixture(scope="module")
def labelled(history):
    return materialise(labelled_rows(history["features"]), "labelled")


def test_holdout_cut_equals_a_sorted_split(labelled):
    pdf = labelled.select("date", "ticker").toPandas().sort_values(["date", "ticker"], ignore_index=True)
    calendar = session_calendar(labelled)
    ends = [everything(calendar), *[(k, calendar[i][0]) for k, i in enumerate((301, 523, 777))]]
    for s in holdout_scopes(labelled, calendar, ends):
        want = pdf[pdf["date"] < s.end]
        cut = int(len(want) * 0.8)
        got = labelled.where(s.contains()).where(s.fitted()).select("date", "ticker").toPandas()
        assert s.rows == len(want) and len(got) == cut == s.fit_rows
        pd.testing.assert_frame_equal(
            got.sort_values(["date", "ticker"], ignore_index=True), want.iloc[:cut], check_dtype=False
        )


def test_the_kth_ticker_of_a_session_whatever_its_length(spark):
    names = ["A", "AA", "B-1", "BRK.A", "A NAME OF MANY MORE LETTERS", "A NAME OF MANY MORE LETTERT", "^IX", "0A"]
    day = date(2024, 1, 2)
    df = spark.createDataFrame([(day, n) for n in names], "date date, ticker string")
    wanted = {(day, k) for k in range(1, len(names) + 1)}
    assert ranked_tickers(df, wanted) == {(day, k): n for k, n in enumerate(sorted(names), 1)}


def test_the_kth_ticker_over_many_ranges(spark):
    """Sessions of hundreds of tickers cut at their ends and between, some at several places."""
    days = [date(2024, 1, d) for d in (2, 3, 4)]
    names = {d: [f"T{(k * 7919) % 1000:03d}" for k in range(300 + 100 * i)] for i, d in enumerate(days)}
    df = spark.createDataFrame([(d, n) for d in days for n in names[d]], "date date, ticker string").repartition(5)
    wanted = {(days[0], 1), (days[0], 300), (days[1], 57), (days[1], 58), (days[1], 399)}
    assert ranked_tickers(df, wanted) == {(d, k): sorted(names[d])[k - 1] for d, k in wanted}


def test_har_equals_least_squares(labelled):
    calendar = session_calendar(labelled)
    scopes = holdout_scopes(labelled, calendar, [everything(calendar)])
    design = log_design(labelled)
    (har,) = fit_linear(design, scopes, ["har"])
    pdf = design.toPandas().sort_values(["date", "ticker"], ignore_index=True)
    x, y = pdf[["l5", "l21", "l63"]].to_numpy(), pdf["y"].to_numpy()
    ones = np.ones((len(x), 1))
    beta = np.linalg.lstsq(np.hstack([ones, x]), y, rcond=None)[0]
    assert np.allclose([har.intercept, *har.coefficients], beta, atol=1e-9)
    cut = int(len(y) * 0.8)
    probe = np.linalg.lstsq(np.hstack([ones, x])[:cut], y[:cut], rcond=None)[0]
    resid = y[cut:] - np.hstack([ones, x])[cut:] @ probe
    assert har.smear == pytest.approx(0.5 * np.log(np.mean(np.exp(2 * resid))), abs=1e-9)


def test_cross_validation_covers_every_test_row_once_per_model(labelled):
    validation = cross_validate(labelled, SMALL)
    metrics = fold_metrics(validation).toPandas()
    assert set(metrics["fold"]) == {0, 1, 2} and set(metrics["model"]) == {"naive", "har"}
    assert (metrics["test_rows"] == 4 * 126).all()
    keys = validation.out_of_sample.groupBy("model", "ticker", "date").count()
    assert keys.where("count > 1").count() == 0


def test_trees_take_part_in_selection(labelled):
    tiny = replace(SMALL, n_splits=2, candidates=("naive", "trees"), trees=TreeSettings(trees=3, leaves=8))
    metrics = fold_metrics(cross_validate(labelled, tiny)).toPandas()
    assert len(metrics) == 4 and metrics["qlike"].between(0, 5).all()


@pytest.fixture(scope="module")
def promoted(history, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models"))
    easy = replace(SMALL, min_improvement=-1.0, candidates=("naive", "har"))
    result = train(history["features"], path, easy, version="v1")
    return path, result


def test_card_describes_the_promoted_model(spark, promoted):
    path, result = promoted
    champion, card = load_champion(spark, path)
    assert card["champion"] == result.champion == champion.name != "naive"
    assert card["features"] == MODEL_FEATURES
    assert [p["feature"] for p in card["reference_profile"]] == MODEL_FEATURES
    listed = spark.read.parquet(card["data"]["tickers_path"]).collect()
    assert sorted(r[0] for r in listed) == ["AAA", "BBB", "CCC", "DDD"]
    assert set(card["cv"]) == {"naive", "har"}


def test_gate_keeps_the_current_model(spark, history, promoted):
    path, _ = promoted
    before = load_card(spark, path)
    result = train(history["features"], path, replace(SMALL, min_improvement=0.99), version="v2")
    assert not result.promoted
    assert load_card(spark, path) == before


def test_the_last_promoted_version_is_in_use(spark, tmp_path):
    from barlake.plans.training import write_card

    for version in ("v9", "v10", "a"):
        write_card(spark, {"version": version}, str(tmp_path))
        assert load_card(spark, str(tmp_path))["version"] == version
    write_card(spark, {"version": "v9"}, str(tmp_path))
    assert load_card(spark, str(tmp_path))["version"] == "v9"


def test_trees_can_be_promoted_and_reloaded(spark, history, tmp_path):
    from barlake.plans import training

    tiny = replace(SMALL, trees=TreeSettings(trees=3, leaves=8), candidates=("naive",))
    labelled = labelled_rows(history["features"])
    fitted = training.fit_final(labelled, cross_validate(labelled, tiny), "trees", tiny)
    shares = training.feature_importance(spark, fitted).toPandas()
    assert shares["gain"].sum() == pytest.approx(1) and shares["gain"].is_monotonic_decreasing
    card = {"version": "v9", "champion": "trees", "horizon_days": 5, "model": {"smear": fitted.smear, "linear": None}}
    training.save_champion(spark, fitted, card, str(tmp_path))
    training.write_card(spark, card, str(tmp_path))
    champion, card = load_champion(spark, str(tmp_path))
    newest = latest_features(history["features"])
    a = score(newest, fitted, card, NOW).orderBy("ticker").toPandas()
    b = score(newest, champion, card, NOW).orderBy("ticker").toPandas()
    pd.testing.assert_frame_equal(a, b)
    assert a["forecast_vol"].between(0, 5).all()


def test_no_labelled_rows_is_a_clear_error(history, tmp_path):
    with pytest.raises(NoTrainingData, match="nothing to train on"):
        train(history["features"].where("not is_labeled"), str(tmp_path), SMALL)
    with pytest.raises(FileNotFoundError, match="no model in use"):
        load_champion(history["features"].sparkSession, str(tmp_path))


def test_scoring_twice_is_an_upsert(spark, history, promoted, tmp_path):
    champion, card = load_champion(spark, promoted[0])
    table = ForecastTable(spark, str(tmp_path / "forecasts"))
    newest = latest_features(history["features"])
    for minute in (0, 1):
        table.upsert(score(newest, champion, card, NOW + timedelta(minutes=minute)))
    rows = table.read().toPandas()
    assert len(rows) == 4 and (rows["scored_at"] == NOW + timedelta(minutes=1)).all()
    assert table.read().columns == FORECAST_SCHEMA.fieldNames()
    assert rows["forecast_vol"].between(0, 5).all() and not rows["is_stale"].any()


def test_stale_ticker_is_flagged_even_when_asked_for_alone(spark, history, promoted):
    champion, card = load_champion(spark, promoted[0])
    features = history["features"]
    newest = features.agg(F.max("date")).first()[0]
    quiet = features.where((F.col("ticker") != "AAA") | (F.col("date") < F.lit(newest - timedelta(days=9))))
    latest = latest_features(quiet)
    stale = score(latest, champion, card, NOW).orderBy("ticker").toPandas()["is_stale"].tolist()
    assert stale == [True, False, False, False]
    alone = score(for_ticker(latest, "aaa"), champion, card, NOW, freshest=quiet).first()
    assert alone["is_stale"]


def test_matured_forecasts_and_monitoring(spark, history, promoted, tmp_path):
    champion, card = load_champion(spark, promoted[0])
    features = history["features"]
    since = features.agg(F.max("date")).first()[0] - timedelta(days=60)
    past = features.where("is_labeled").where(F.col("date") >= F.lit(since))
    backdated = materialise(score(past, champion, card, NOW), "backdated")
    assert matured_forecasts(backdated, features).count() == past.count()
    report = monitor(features, backdated, card, SMALL, str(tmp_path), NOW)
    overall = next(r for r in report["live"] if r["model_version"] is None)
    assert overall["n_forecasts"] == report["n_forecasts"] == past.count()
    assert report["healthy"] == (not report["drifted_features"] and not report["degraded"])
    assert {d["feature"] for d in report["drift"]} == set(MODEL_FEATURES)
    assert {d["feature"] for d in report["drift"] if not d["gates_health"]} == set(LEVEL_FEATURES)
    assert spark.read.text(str(tmp_path)).count() == 1
    nothing = monitor(features, backdated.limit(0), card, SMALL)
    assert nothing["live"] == [] and not nothing["degraded"]


def test_live_accuracy_of_no_forecasts_is_empty(history):
    none = history["features"].limit(0).select(
        "ticker", "date", F.lit("v").alias("model_version"), F.lit(1.0).alias("forecast_vol"), "target_rv_fwd"
    )
    assert live_accuracy(none).count() == 0


def test_recent_sessions(history):
    recent = recent_sessions(history["features"], 10)
    assert recent.select("date").distinct().count() == 10 and recent.count() == 40


def test_psi_grows_with_the_shift(spark):
    """Values 0..999 as the profile; later samples of them moved up by a share of their range."""
    line = lambda shift, step: spark.createDataFrame([(float(v + shift),) for v in range(0, 1000, step)], "f double")
    profile = feature_profiles(line(0, 1), ["f"])
    rows = [drift_report(profile, line(shift, 3)).first() for shift in (0, 30, 100, 400)]
    psi = [r["psi"] for r in rows]
    assert psi == sorted(psi) and psi[0] < 0.01
    assert [rows[0]["status"], rows[-1]["status"]] == ["ok", "alert"]


def test_psi_of_constant_and_of_empty_features(spark):
    flat = spark.createDataFrame([(1.0, 2.0)] * 20, "a double, b double")
    profile = feature_profiles(flat, ["a", "b"])
    assert profile[0].edges == () and profile[0].proportions == (1.0,)
    now = flat.withColumn("b", F.lit(None).cast("double"))
    found = {r["feature"]: (r["psi"], r["status"]) for r in drift_report(profile, now).collect()}
    assert found == {"a": (0.0, "ok"), "b": (None, "no_data")}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6, allow_subnormal=False)),
        min_size=1,
        max_size=300,
    ),
    st.integers(1, 12),
)
def test_cornered_quantiles_equal_sorted_ones(spark, values, limit):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    fractions = [i / 10 for i in range(11)]
    want = np.quantile(np.array(values), fractions)
    for most in (10_000, limit):
        got = exact_quantiles(df, ["x"], fractions, sorted_rows=most)["x"]
        assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


def test_cornered_quantiles_of_features(labelled):
    fractions = [i / 10 for i in range(11)]
    whole = exact_quantiles(labelled, MODEL_FEATURES, fractions)
    cornered = exact_quantiles(labelled, MODEL_FEATURES, fractions, sorted_rows=20)
    for f in MODEL_FEATURES:
        assert np.allclose(whole[f], cornered[f], rtol=1e-12)


def test_many_cornered_quantiles_of_many_columns(labelled):
    """Bin edges where no column can be sorted whole: hundreds of boundaries to each of 13 columns."""
    fractions = [k / 64 for k in range(1, 64)]
    found = exact_quantiles(labelled, MODEL_FEATURES, fractions, sorted_rows=200)
    pdf = labelled.select(*[F.col(f).cast("double") for f in MODEL_FEATURES]).toPandas()
    for f in MODEL_FEATURES:
        assert np.allclose(found[f], np.quantile(pdf[f].dropna(), fractions), rtol=1e-12, atol=1e-12)
