"""Row contracts: split rows into valid and rejected with every broken rule named.

Structural breaks (a missing column, a type that can't hold the values) raise before any job starts. Values of
other types are coerced; one that can't be is a break of its row. Row breaks are labelled
in one projection: rules are sorted by label when the plan is built, so the reason string needs no
per-row array, sort or Python.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.columns import known
from barlake.schema import BAR_COLUMNS, BAR_SCHEMA, PRICE_COLUMNS, REASON
from barlake.workspace import materialise

PRICE_TOLERANCE = 1e-6
BROADCAST_KEYS = 500_000  # repeated (date, ticker) keys that may be broadcast, some 20 MB
TICKER_PATTERN = r"^[A-Z0-9.\-^=]{1,12}$"


class ContractViolation(RuntimeError):
    """The frame does not have the agreed columns or types."""


@dataclass(frozen=True)
class Rule:
    label: str
    broken: Column


def reason_column(rules: Iterable[Rule]) -> Column:
    """Labels of all broken rules in label order, joined by '; '; empty when the row is clean."""
    ordered = sorted(rules, key=lambda r: r.label)
    return F.concat_ws("; ", *[F.when(r.broken, F.lit(r.label)) for r in ordered])


def check_structure(df: DataFrame, expected: T.StructType = BAR_SCHEMA) -> None:
    problems = []
    actual = {f.name: f.dataType for f in df.schema.fields}
    for field in expected.fields:
        got = actual.get(field.name)
        if got is None:
            problems.append(f"column_in_dataframe: {field.name} is missing")
        elif not _coercible(got, field.dataType):
            problems.append(f"dtype: {field.name} is {got.simpleString()}")
    if problems:
        raise ContractViolation("bars without the agreed columns: " + "; ".join(problems))


def _coercible(got: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.DateType):
        return isinstance(got, T.DateType | T.TimestampType | T.TimestampNTZType | T.StringType)
    return isinstance(got, T.NumericType | T.StringType)


def _coerced(name: str) -> Column:
    return F.col(name).try_cast(BAR_SCHEMA[name].dataType)


def _typed(name: str) -> Column:
    """The value as the schema has it; null where it can't be coerced, or is no number."""
    return known(_coerced(name)) if isinstance(BAR_SCHEMA[name].dataType, T.DoubleType) else _coerced(name)


def bar_rules(as_of: date, given: T.StructType = BAR_SCHEMA) -> list[Rule]:
    """The rules for bars that come with the types of ``given``."""
    v = {name: _typed(name) for name in BAR_COLUMNS}
    rules = []
    for name in BAR_COLUMNS:
        missing = v[name].isNull()
        if given[name].dataType != BAR_SCHEMA[name].dataType:
            odd = F.col(name).isNotNull() & _coerced(name).isNull()
            rules.append(Rule(f"{name}:coerce_dtype", odd))
            missing = missing & ~odd
        rules.append(Rule(f"{name}:not_nullable", missing))
    rules += [Rule(f"{name}:greater_than(0)", v[name] <= 0) for name in PRICE_COLUMNS]
    rules.append(Rule("volume:greater_than_or_equal_to(0)", v["volume"] < 0))
    rules.append(Rule(f"ticker:str_matches('{TICKER_PATTERN}')", ~v["ticker"].rlike(TICKER_PATTERN)))

    complete = F.lit(True)
    for name in BAR_COLUMNS:
        complete = complete & v[name].isNotNull()
    top = F.greatest(v["open"], v["close"], v["low"])
    bottom = F.least(v["open"], v["close"])
    rules += [
        Rule(
            "high must be >= open, close and low",
            complete & (v["high"] * (1 + PRICE_TOLERANCE) < top),
        ),
        Rule("low must be <= open and close", complete & (v["low"] * (1 - PRICE_TOLERANCE) > bottom)),
        Rule("not_in_future", complete & (v["date"] > F.date_add(F.lit(as_of), 1))),
    ]
    return rules


def session_key() -> Column:
    """The day of a bar as a key: two stamps on one day are one session, values that are no date stay apart."""
    return F.coalesce(_coerced("date").cast("string"), F.col("date").cast("string"))


def flag_bars(
    df: DataFrame, as_of: date, keys_unique: bool = False, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """All input columns plus the reason.

    Every copy of a repeated (date, ticker) is rejected. Repeated keys are found by a partial-aggregated
    count and written down; up to a checked number of them they are broadcast, so the bars themselves are
    not shuffled at all. Beyond that it is a shuffle join, whose hot keys AQE splits. Callers that have
    just reduced to one row per key pass ``keys_unique`` and skip both steps. Without it, the count of
    repeated keys runs when this is called.
    """
    check_structure(df)
    rules = bar_rules(as_of, df.schema)
    if keys_unique:
        return df.withColumn(REASON, reason_column(rules))
    repeated = materialise(
        df.groupBy(session_key().alias("_d"), _typed("ticker").alias("_t"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1"),
        "repeated-keys",
    )
    if repeated.count() <= broadcast_keys:
        repeated = F.broadcast(repeated)
    same_key = session_key().eqNullSafe(F.col("_d")) & _typed("ticker").eqNullSafe(F.col("_t"))
    rules.append(Rule("key:not_unique", F.col("_copies").isNotNull()))
    return (
        df.join(repeated, same_key, "left")
        .withColumn(REASON, reason_column(rules))
        .drop("_d", "_t", "_copies")
    )


def valid_rows(flagged: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Clean rows, coerced to the bar schema; columns outside it are dropped unless named."""
    bars = [_typed(name).alias(name) for name in BAR_COLUMNS]
    return flagged.where(F.col(REASON) == "").select(*bars, *extra)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(REASON) != "")


def split_bars(
    df: DataFrame, as_of: date, keys_unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    flagged = flag_bars(df, as_of, keys_unique)
    return valid_rows(flagged), rejected_rows(flagged)


def feature_vector_rules() -> list[Rule]:
    """Limits on an ad-hoc feature vector before it may be scored."""
    positive = ["rv_5d", "rv_21d", "rv_63d", "market_rv_21d", "relative_rv_21d"]
    not_negative = ["parkinson_5d", "parkinson_21d", "abs_return_1d"]
    free = ["log_return", "overnight_gap", "momentum_21d", "volume_z_21d"]
    rules = []
    for name in positive + not_negative + free:
        value = known(F.col(name).cast("double"))
        rules.append(Rule(f"{name}:not_nullable", value.isNull()))
        if name in positive:
            rules.append(Rule(f"{name}:greater_than(0)", value <= 0))
        elif name in not_negative:
            rules.append(Rule(f"{name}:greater_than_or_equal_to(0)", value < 0))
    day = F.col("day_of_week")
    rules.append(Rule("day_of_week:not_nullable", day.isNull()))
    rules.append(Rule("day_of_week:in_range(1, 7)", ~day.between(1, 7)))
    return rules


def split_feature_vectors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    flagged = df.withColumn(REASON, reason_column(feature_vector_rules()))
    return flagged.where(F.col(REASON) == "").drop(REASON), rejected_rows(flagged)
