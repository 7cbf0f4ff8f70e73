"""Population stability of features against a stored training profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.columns import known
from barlake.operators.quantiles import SORTED_ROWS, exact_quantiles, unique_sorted
from barlake.schema import LEVEL_FEATURES, MODEL_FEATURES
from barlake.workspace import small_frame

PROPORTION_FLOOR = 1e-6


@dataclass(frozen=True)
class FeatureProfile:
    """Interior bin edges (both ends are open) and the share of training rows per bin."""

    feature: str
    edges: tuple[float, ...]
    proportions: tuple[float, ...]


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin, n) for every profiled feature in one scan.

    The edges (a few per feature) are broadcast, and each value finds its bin by comparing with them.
    Counts combine before the shuffle, which moves a row per feature and bin and task.
    """
    features = list(edges)
    edge_rows = [(f, [float(e) for e in sorted(edges[f])]) for f in features]
    edge_frame = small_frame(df.sparkSession, edge_rows, "feature string, edges array<double>")
    place = F.lit(0)
    for i in range(max(len(e) for _, e in edge_rows)):
        reached = (F.col("value") >= F.get("edges", F.lit(i))).cast("int")
        place = place + F.coalesce(reached, F.lit(0))
    return (
        df.select(*[known(F.col(f).cast("double")).alias(f) for f in features])
        .unpivot([], features, "feature", "value")
        .where("value is not null")
        .join(F.broadcast(edge_frame), "feature")
        .groupBy("feature", place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def feature_profiles(
    df: DataFrame,
    features: Sequence[str] = tuple(MODEL_FEATURES),
    bins: int = 10,
    sorted_rows: int = SORTED_ROWS,
) -> list[FeatureProfile]:
    """Decile edges of each feature and the share of rows in every bin."""
    fractions = [i * (1 / bins) for i in range(bins)] + [1.0]
    quantiles = exact_quantiles(df, features, fractions, sorted_rows)
    edges = {f: unique_sorted(quantiles[f])[1:-1] for f in features}
    counts = {(r["feature"], r["bin"]): r["n"] for r in bin_counts(df, edges).collect()}
    profiles = []
    for f in features:
        per_bin = [counts.get((f, b), 0) for b in range(len(edges[f]) + 1)]
        total = sum(per_bin) or 1
        profiles.append(FeatureProfile(f, tuple(edges[f]), tuple(n / total for n in per_bin)))
    return profiles


def profile_frame(spark: SparkSession, profiles: Sequence[FeatureProfile]) -> DataFrame:
    rows = [(p.feature, list(p.edges), list(p.proportions)) for p in profiles]
    return small_frame(
        spark, rows, "feature string, edges array<double>, proportions array<double>"
    )


def drift_report(
    profiles: Sequence[FeatureProfile], current: DataFrame, warn: float = 0.1, alert: float = 0.25
) -> DataFrame:
    """PSI per feature present in ``current``, largest first.

    A feature without any current value has status 'no_data'. Only features that do not track the
    volatility level gate health.
    """
    present = [p for p in profiles if p.feature in current.columns]
    per_feature = (
        bin_counts(current, {p.feature: p.edges for p in present})
        .groupBy("feature")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),
            F.sum("n").alias("total"),
        )
    )
    floor = F.lit(PROPORTION_FLOOR)

    def term(expected: Column, place: Column) -> Column:
        share = F.coalesce(F.try_element_at(F.col("counts"), place), F.lit(0)) / F.col("total")
        a, e = F.greatest(share, floor), F.greatest(expected, floor)
        return (a - e) * F.ln(a / e)

    terms = F.transform("proportions", term)
    psi = (
        profile_frame(current.sparkSession, present)
        .join(F.broadcast(per_feature), "feature", "left")
        .select(
            "feature",
            F.when(
                F.col("total") > 0, F.aggregate(terms, F.lit(0.0), lambda t, x: t + x)
            ).alias("psi"),
        )
    )
    status = (
        F.when(F.col("psi").isNull(), "no_data")
        .when(F.col("psi") >= alert, "alert")
        .when(F.col("psi") >= warn, "warn")
        .otherwise("ok")
    )
    return psi.select(
        "feature",
        F.round("psi", 4).alias("psi"),
        status.alias("status"),
        (~F.col("feature").isin(LEVEL_FEATURES)).alias("gates_health"),
    ).orderBy(F.col("psi").desc_nulls_last(), "feature")
