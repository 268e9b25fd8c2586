"""Declarative row rules: count and list every failure in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.schemas import HOUR_TS, MAX_ZONE, PICKUP, ZONE


@dataclass(frozen=True)
class Rule:
    column: str
    name: str
    holds: Callable[[Column], Column]
    nullable: bool = False

    def broken(self) -> Column:
        """True where the rule fails; a null fails unless the column may be null."""
        col = F.col(self.column)
        ok = F.coalesce(self.holds(col), F.lit(False))
        return ~((ok | col.isNull()) if self.nullable else ok)


def between(column: str, low: float, high: float, **kw) -> Rule:
    return Rule(column, f"in_range({low}, {high})", lambda c: c.between(low, high), **kw)


def at_least(column: str, low: float, **kw) -> Rule:
    return Rule(column, f"at_least({low})", lambda c: (c >= low) & ~F.isnan(c.cast("double")), **kw)


def above(column: str, low: float, **kw) -> Rule:
    return Rule(column, f"above({low})", lambda c: (c > low) & ~F.isnan(c.cast("double")), **kw)


def one_of(column: str, *values: int, **kw) -> Rule:
    return Rule(column, f"one_of({', '.join(map(str, values))})", lambda c: c.isin(*values), **kw)


def present(column: str) -> Rule:
    return Rule(column, "present", lambda c: c.isNotNull())


TRIP_RULES = [
    present(PICKUP), above("trip_distance", 0), above("fare_amount", 0), between(ZONE, 1, MAX_ZONE),
]
DEMAND_RULES = [
    between(ZONE, 1, MAX_ZONE), present(HOUR_TS), at_least("trip_count", 0),
    between("pickup_hour", 0, 23), between("pickup_dow", 0, 6), between("pickup_week", 1, 53),
    at_least("precipitation", 0, nullable=True), at_least("snowfall", 0, nullable=True),
    one_of("is_holiday", 0, 1),
]
# Columns that must exist without a condition on their values.
DEMAND_COLUMNS = ["temperature_2m"]
REQUEST_RULES = [
    between("zone_id", 1, MAX_ZONE), between("hour", 0, 23), between("day_of_week", 0, 6),
    between("week", 1, 53), one_of("is_holiday", 0, 1), at_least("snowfall", 0),
    at_least("lag_24h", 0), at_least("lag_168h", 0), one_of("is_nyc_event", 0, 1),
]
# Optional request fields take 0 when they are missing.
REQUEST_DEFAULTS = ["is_holiday", "snowfall", "lag_24h", "lag_168h", "is_nyc_event"]


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}, found {df.columns}")
    return df


def failure_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(column, rule, n_failed) for every rule, from a single aggregate over the rows."""
    require_columns(df, [r.column for r in rules])
    wide = df.agg(*[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(r.column).alias("column"), F.lit(r.name).alias("rule"),
                 F.col(f"r{i}").alias("n_failed"))
        for i, r in enumerate(rules)
    ])
    return wide.select(F.inline(rows))


def failures(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = ()) -> DataFrame:
    """One row per failed rule and input row, with the offending value as text."""
    require_columns(df, [r.column for r in rules])
    marks = F.array(*[
        F.struct(r.broken().alias("bad"), F.lit(r.column).alias("column"),
                 F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value"))
        for r in rules
    ])
    return (
        df.select(*keys, F.inline(F.filter(marks, lambda m: m["bad"])))
        .drop("bad")
    )


def with_outcome(df: DataFrame, rules: Sequence[Rule], name: str = "outcome") -> DataFrame:
    """``valid`` or ``rejected`` per row."""
    bad = F.lit(False)
    for r in rules:
        bad = bad | r.broken()
    return df.withColumn(name, F.when(bad, "rejected").otherwise("valid"))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    marked = with_outcome(df, rules, "_outcome")
    return tuple(
        marked.where(F.col("_outcome") == part).drop("_outcome") for part in ("valid", "rejected")
    )


def with_request_defaults(requests: DataFrame) -> DataFrame:
    return requests.na.fill(0, subset=[c for c in REQUEST_DEFAULTS if c in requests.columns])


def check(df: DataFrame, rules: Sequence[Rule], name: str = "table") -> DataFrame:
    """The frame itself, or an error naming every broken rule. Brings one row per rule to the driver."""
    broken = failure_counts(df, rules).where("n_failed > 0").collect()
    if broken:
        listing = "; ".join(f"{r['column']} {r['rule']}: {r['n_failed']} rows" for r in broken)
        raise ValueError(f"{name} failed validation: {listing}")
    return df


def check_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> DataFrame:
    """The frame itself, or an error if a key occurs more than once."""
    repeated = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{name} repeats {dict(zip(keys, repeated[0]))}")
    return df


def feature_matrix(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Feature columns and the target, after checking that they exist."""
    require_columns(df, [*features, target])
    return df.select(*features, target)
