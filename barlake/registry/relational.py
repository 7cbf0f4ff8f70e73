"""Queries over bars: feed, contract, staging, marts, checks."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.checks import (
    features_report,
    freshness,
    leaking_targets,
    monthly_report,
    ohlc_consistent,
    returns_report,
    row_report,
    staged_report,
)
from barlake.operators.contract import (
    ContractViolation,
    flag_bars,
    rejected_rows,
    split_feature_vectors,
    valid_rows,
)
from barlake.operators.latest import keep_last
from barlake.plans.incremental import feature_table, update_features
from barlake.plans.ingest import fetch_windows, window_lists
from barlake.plans.marts import daily_returns, market_level, monthly_summary, volatility_features
from barlake.plans.marts import ticker_features
from barlake.plans.staging import staged
from barlake.schema import BAR_COLUMNS, REASON
from barlake.sources.bars import empty_bars, missing_tickers, normalise_tickers, union_sources
from barlake.sources.feeds import (
    ARRIVAL,
    AS_OF,
    NOW,
    brand_ticker,
    brands,
    fetched_bars,
    flagged_bars,
    landed_bars,
    raw_bars,
    table,
)
from barlake.sources.wide import tidy, widen
from barlake.workspace import materialise, work_path

PLACES = 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that two engines' last bits do not matter."""
    return df.select(
        *[
            F.round(f.name, PLACES).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


def staged_feed(spark: SparkSession, sf: str) -> DataFrame:
    return staged(landed_bars(spark, sf))


def returns_feed(spark: SparkSession, sf: str) -> DataFrame:
    return daily_returns(staged_feed(spark, sf))


def features_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Features over a written returns table, as in the daily run: they read it twice."""
    return volatility_features(materialise(returns_feed(spark, sf), "returns"))


def q_raw_bars(spark, sf):
    return rounded(raw_bars(spark, sf).select(*BAR_COLUMNS, "run"))


def q_keep_last_dedup(spark, sf):
    return rounded(fetched_bars(spark, sf))


def q_contract_valid(spark, sf):
    return rounded(valid_rows(flagged_bars(spark, sf), ["run"]))


def q_contract_rejected(spark, sf):
    return rounded(rejected_rows(flagged_bars(spark, sf)))


def q_reject_reason_counts(spark, sf):
    return rejected_rows(flagged_bars(spark, sf)).groupBy(REASON, "run").agg(
        F.count(F.lit(1)).alias("bars")
    )


def q_contract_repeated_keys(spark, sf):
    """The contract on the raw feed: every copy of a repeated key is rejected."""
    flagged = flag_bars(raw_bars(spark, sf), AS_OF)
    return flagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("bars"))


def q_contract_cutoff(spark, sf):
    """The contract as of an earlier day: later bars are in the future."""
    flagged = flag_bars(fetched_bars(spark, sf), date(2000, 1, 1), keys_unique=True)
    return flagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("bars"))


def text_bars(spark, sf) -> DataFrame:
    """The raw feed as a vendor's text file would have it: dates with times of day, a price that is no number,
    lower-case names, and one run whose dates are no dates."""
    stamped = F.concat(F.col("date").cast("string"), F.format_string(" %02d:30:00", F.col("run") + 8))
    return raw_bars(spark, sf).select(
        F.when(F.col("run") == 7, "soon").otherwise(stamped).alias("date"),
        F.when(F.col("run") == 6, F.lower("ticker")).otherwise(F.col("ticker")).alias("ticker"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "adj_close", "volume")],
        F.coalesce(F.col("close").cast("string"), F.lit("n/a")).alias("close"),
    )


def q_contract_coerced(spark, sf):
    """The contract on text: values are coerced, and those that can't be are breaks of their row. Two stamps on
    one day are one session."""
    flagged = flag_bars(text_bars(spark, sf), AS_OF)
    return flagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("bars"))


def q_staged_bars(spark, sf):
    return rounded(staged_feed(spark, sf).drop("ingested_at"))


def q_wide_to_tidy(spark, sf):
    bars = materialise(staged_feed(spark, sf), "staged")
    tickers = [r["ticker"] for r in brands(spark, sf).orderBy("ticker").collect()]
    return rounded(tidy(widen(bars, tickers)))


def universe(spark, sf) -> DataFrame:
    """Brands, which the feed knows, and part types, which it does not."""
    types = table(spark, sf, "part").select(F.upper("p_type").alias("ticker"))
    return brands(spark, sf).unionByName(types).distinct()


def q_source_union(spark, sf):
    """Three fetched frames as one, one of them without a row and one with columns of its own."""
    raw = raw_bars(spark, sf)
    early = raw.where("run <= 3").select(*BAR_COLUMNS)
    return rounded(union_sources([early, raw.where("run > 3"), empty_bars(spark)]))


def q_structural_contract(spark, sf):
    """The feed as it is, without one of its columns, and with one of another kind: whether it is refused, and how many
    bars get through."""
    bars = fetched_bars(spark, sf)
    cases = {"whole": bars}
    cases |= {f"no {c}": bars.drop(c) for c in BAR_COLUMNS}
    cases["no number"] = bars.withColumn("close", F.col("close") > 10)
    rows = None
    for name, frame in cases.items():
        try:
            passed, refused = valid_rows(flag_bars(frame, AS_OF, keys_unique=True), ["run"]), False
        except ContractViolation:
            passed, refused = bars.limit(0), True
        found = passed.agg(F.lit(name).alias("feed"), F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("bars"))
        rows = found if rows is None else rows.unionByName(found)
    return rows


def q_window_overlap(spark, sf):
    """A month fetched again against the whole feed: keys that both have, and where their closes differ."""
    whole = keep_last(raw_bars(spark, sf), ["date", "ticker"], ["run", *ARRIVAL])
    month = F.col("date").between(F.lit(date(1998, 3, 1)), F.lit(date(1998, 3, 31)))
    again = fetched_bars(spark, sf).where(month & (F.col("run") <= 2))
    again = keep_last(again, ["date", "ticker"], ["run"]).select("date", "ticker", F.col("close").alias("again"))
    both = whole.join(again, ["date", "ticker"])
    return both.agg(F.count(F.lit(1)).alias("keys"), F.count_if(~F.col("close").eqNullSafe(F.col("again"))).alias("other_close"))


def q_missing_tickers(spark, sf):
    return missing_tickers(universe(spark, sf), raw_bars(spark, sf))


def q_normalised_tickers(spark, sf):
    padded = table(spark, sf, "part").select(
        F.concat(F.lit("  "), F.lower(brand_ticker()), F.lit(" ")).alias("ticker"), "p_type"
    )
    blanks = padded.select(F.lit("   ").alias("ticker"))
    types = padded.select(F.lower("p_type").alias("ticker"))
    return normalise_tickers(padded.select("ticker").unionByName(types).unionByName(blanks))


def q_watermarks(spark, sf):
    return landed_bars(spark, sf).groupBy("ticker").agg(F.max("date").alias("watermark"))


def planned_windows(spark, sf) -> DataFrame:
    marks = landed_bars(spark, sf).groupBy("ticker").agg(F.max("date").alias("watermark"))
    end = AS_OF + timedelta(days=1)
    return fetch_windows(universe(spark, sf), marks, date(1996, 1, 1), 5, end)


def q_fetch_plan(spark, sf):
    return planned_windows(spark, sf)


def q_fetch_plan_grouped(spark, sf):
    lists = window_lists(materialise(planned_windows(spark, sf), "windows"))
    return lists.select("start", F.array_join("tickers", ",").alias("tickers"))


def q_daily_returns(spark, sf):
    return rounded(returns_feed(spark, sf))


def q_monthly_summary(spark, sf):
    return rounded(monthly_summary(returns_feed(spark, sf)))


def q_features_volatility(spark, sf):
    return rounded(features_feed(spark, sf))


def q_features_incremental(spark, sf):
    """The features mart of four runs, brought up to date by three more with corrections all over the past."""
    landed = materialise(landed_bars(spark, sf), "landed")

    def until(run: str) -> DataFrame:
        return materialise(staged(landed.where(F.col("run_id") <= run)), "staged")

    first = volatility_features(materialise(daily_returns(until("run-4")), "returns"))
    mart = feature_table(spark, work_path(spark, "features-mart"), first.schema)
    mart.upsert(first)
    for run in ("run-5", "run-6", "run-7"):
        update_features(mart, until(run), landed.where(F.col("run_id") == run).select("ticker", "date"))
    return rounded(mart.read())


def q_market_vol(spark, sf):
    return rounded(market_level(ticker_features(returns_feed(spark, sf))))


def q_features_ten_sessions(spark, sf):
    """The same features with a ten-session horizon: one parameter, no second setting to forget."""
    returns = materialise(returns_feed(spark, sf), "returns")
    features = volatility_features(returns, horizon=10)
    return rounded(features.select("ticker", "date", "target_rv_fwd", "is_labeled"))


def q_unlabelled_per_ticker(spark, sf):
    seasoned = ticker_features(returns_feed(spark, sf))
    return seasoned.groupBy("ticker").agg(
        F.count_if(~F.col("is_labeled")).alias("unlabelled"), F.count(F.lit(1)).alias("feature_rows")
    )


def q_check_report(spark, sf):
    bars = materialise(staged_feed(spark, sf), "staged")
    returns = materialise(daily_returns(bars), "returns")
    features = materialise(volatility_features(returns), "features")
    reports = [
        staged_report(bars),
        returns_report(returns),
        features_report(features),
        monthly_report(monthly_summary(returns)),
    ]
    return reduce(DataFrame.unionByName, reports)


def q_check_report_raw(spark, sf):
    """The staged-table checks on unchecked bars, where they do find rows."""
    return staged_report(raw_bars(spark, sf))


def q_ohlc_check(spark, sf):
    bars = fetched_bars(spark, sf)
    return rounded(bars.where(ohlc_consistent().offends))


def q_row_checks(spark, sf):
    return row_report(fetched_bars(spark, sf), "fetched", [ohlc_consistent()])


def q_leakage_guard(spark, sf):
    """Five-session targets pass the five-session guard and fail any other."""
    features = materialise(features_feed(spark, sf), "features")
    found = [
        leaking_targets(features, h)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(h).alias("horizon"), "violations")
        for h in (5, 10)
    ]
    return found[0].unionByName(found[1])


def q_freshness(spark, sf):
    age = freshness(landed_bars(spark, sf), NOW)
    return age.select("age_days", "status")


def q_feature_vector_validation(spark, sf):
    """Every feature row as an ad-hoc vector, some of them spoiled."""
    vectors = features_feed(spark, sf).withColumns(
        {
            "rv_5d": F.when(F.col("day_of_week") == 2, -F.col("rv_5d")).otherwise(F.col("rv_5d")),
            "momentum_21d": F.when(F.col("day_of_week") == 3, None).otherwise(F.col("momentum_21d")),
            "day_of_week": F.when(F.col("abs_return_1d") > 0.05, 9).otherwise(F.col("day_of_week")),
        }
    )
    valid, rejected = split_feature_vectors(vectors)
    verdicts = valid.select(F.lit("").alias(REASON)).unionByName(rejected.select(REASON))
    return verdicts.groupBy(REASON).agg(F.count(F.lit(1)).alias("vectors"))


def q_keep_last_across_runs(spark, sf):
    """One row per (date, ticker): the last arrival of the last run, checked or not."""
    raw = raw_bars(spark, sf)
    last = keep_last(raw, ["date", "ticker"], ["run", *ARRIVAL])
    return rounded(last.select(*BAR_COLUMNS, "run"))
