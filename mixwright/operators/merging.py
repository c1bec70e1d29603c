"""One row a key: how each further column is put together follows from its name and type."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
# Names of columns that may be added up, and of rates, which may not; in any letter case.
ADDITIVE = (".*_spend$", ".*_revenue$", ".*_clicks$", ".*_impressions$", ".*_conversions$")
RATES = (".*_cpm$", ".*_cpc$", ".*_ctr$", ".*_cvr$")


@dataclass(frozen=True)
class Policy:
    """How rows of one key are merged. ``numbers``: sum, mean, max or latest; ``strings``: latest, first or mode."""

    numbers: str = "sum"
    strings: str = "latest"
    timestamp: str = "ingestion_ts"
    additive: tuple[str, ...] = ADDITIVE
    rates: tuple[str, ...] = RATES
    also_additive: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.numbers not in ("sum", "mean", "max", "latest") or self.strings not in ("latest", "first", "mode"):
            raise ValueError("numbers are merged by sum, mean, max or latest, strings by latest, first or mode")

    @classmethod
    def of(cls, given: dict) -> Policy:
        """From the settings section on duplicates; unknown ways of numbers are a sum, of strings the commonest value."""
        name = {"latest_timestamp": "latest"}
        numbers, strings = (name.get(given.get(k, d), given.get(k, d)) for k, d in (("numeric_aggregation", "sum"), ("string_aggregation", "latest_timestamp")))
        return cls(
            numbers if numbers in ("sum", "mean", "max", "latest") else "sum", strings if strings in ("latest", "first") else "mode", given.get("timestamp_column", "ingestion_ts"),
            tuple(given.get("additive_columns", ADDITIVE)), tuple(given.get("non_additive_columns", RATES)),
        )


def plan(df: DataFrame, keys: list[str], policy: Policy) -> dict[str, str]:
    """Column -> sum, mean, max, latest, mode or first, in the order of the table."""
    timed = policy.timestamp in df.columns
    fits = lambda c, patterns: any(re.match(p, c, re.I) for p in patterns)

    def way(name: str, kind: str) -> str:
        number = kind in NUMBERS or kind.startswith("decimal")
        if fits(name, policy.additive) or name in policy.also_additive:
            return (policy.numbers if policy.numbers != "latest" or timed else "sum") if number else "first"
        if fits(name, policy.rates):
            return "mean" if number else "first"
        if kind == "string":
            return policy.strings if policy.strings != "latest" or timed else "mode"
        return "max" if "time" in name.lower() or name == policy.timestamp or kind.startswith("timestamp") else "first"

    return {c: way(c, t) for c, t in df.dtypes if c not in keys}


def merged(df: DataFrame, keys: list[str], policy: Policy | None = None) -> DataFrame:
    """One row a key. Rows without a key are left out. Nulls take no part; a sum of nulls alone is null. ``first`` and ``latest``
    go by the timestamp, and among equal times, or without one, by the value, so that the order of rows doesn't matter."""
    policy = policy or Policy()
    timed = policy.timestamp in df.columns
    order = lambda c: F.struct(policy.timestamp, c) if timed and c != policy.timestamp else F.col(c)
    present = lambda c: F.when(F.col(c).isNotNull(), order(c))
    ways = {
        "sum": F.sum, "mean": lambda c: F.avg(c), "max": F.max, "mode": lambda c: F.mode(c, True), "latest": lambda c: F.max_by(c, present(c)), "first": lambda c: F.min_by(c, present(c)),
    }
    chosen = plan(df, keys, policy)
    kept = df.where(_all_present(keys)).groupBy(*keys).agg(*(ways[how](c).alias(c) for c, how in chosen.items()), F.count("*").alias("_rows"))
    return kept.select(*(c for c in df.columns), "_rows")


def _all_present(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def report(df: DataFrame) -> DataFrame:
    """Of a merged table: rows before and after, keys that several rows had."""
    return df.agg(F.sum("_rows").alias("rows_before"), F.count("*").alias("rows_after"), F.count_if(F.col("_rows") > 1).alias("merged_keys"), F.max("_rows").alias("most_rows"))
