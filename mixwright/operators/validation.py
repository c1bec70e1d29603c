"""All checks of a raw table as one report: a row a check, with what it costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.operators import audit, matrix, quality
from mixwright.sources.shared import drop, written

REPORT = ("check", "status", "penalty", "figure")
# What a failed check and a warning cost.
PENALTIES = {
    "schema": (0.15, 0.05), "rules": (0.0, 0.0), "missing": (0.15, 0.05), "duplicate_rows": (0.05, 0.0), "empty_columns": (0.1, 0.0), "digital_quality": (0.1, 0.0), "anomalies": (0.0, 0.0), "business_rules": (0.0, 0.0),
    "completeness": (0.1, 0.05), "coverage": (0.2, 0.05), "identifiability": (0.2, 0.1), "value_sanity": (0.15, 0.05), "keys": (0.1, 0.0),
}


def _row(name: str, failed: Column, warned: Column, figure: Column) -> list[Column]:
    """The columns of a check's row over a table of one row."""
    bad, fair = PENALTIES[name]
    failed, warned = F.coalesce(failed, F.lit(False)), F.coalesce(warned, F.lit(False))
    return [F.lit(name).alias("check"), F.when(failed, "failed").when(warned, "warning").otherwise("passed").alias("status"), F.when(failed, bad).when(warned, fair).otherwise(0.0).alias("penalty"), figure.cast("double").alias("figure")]


def report(df: DataFrame, day: str, by: list[str], revenue: str, spend: list[str], clicks: list[str] = (), impressions: list[str] = (), min_weeks: int = 52, preferred_weeks: int = 104, limits: dict | None = None, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` (by, day, revenue, spend, clicks, impressions) -> check, status, penalty, figure. Each check is an aggregate of the
    table; counts of rows that share one pass are taken together. The table is written first, so that what it is computed from is
    read once."""
    df = written(df)
    given = {"missing": 20.0, "empty_columns": 5, "digital_quality": 75.0, "zero_pct": 10.0, "correlation": 0.9, "orders": 3.0, "weeks_missing_pct": 2.0} | (limits or {})
    no = F.lit(False)
    columns, metrics = df.columns, [*clicks, *impressions]
    lacking = [c for c in (day, revenue, *spend) if c not in columns]
    types = dict(df.dtypes)
    odd = [c for c in (revenue, *spend) if c in columns and types[c] in ("string", "boolean", "date", "timestamp")]
    rules = rules or audit.rules_of(day, revenue, list(spend))
    broken = F.lit(False)
    for rule in rules.values():
        broken = broken | ~F.coalesce(rule, F.lit(False))
    negative = lambda names: F.count_if(F.coalesce(F.greatest(*(F.col(c) < 0 for c in names)) if len(names) > 1 else F.col(names[0]) < 0, F.lit(False))) if names else F.lit(0)
    shares = [(100 * F.avg(F.col(c).isNull().cast("int"))).alias(f"null_{c}") for c in columns]
    means = [F.avg(c).alias(f"mean_{c}") for c in spend]
    one = df.agg(*shares, *means, F.count_if(broken).alias("broken"), negative([revenue]).alias("neg_revenue"), negative(list(spend)).alias("neg_spend"), negative(list(clicks)).alias("neg_clicks"), F.min(day).alias("first"), F.max(day).alias("last"), F.count_distinct(day).alias("days"))
    nulls = F.array(*(F.col(f"null_{c}") for c in columns))
    all_null, empty = F.aggregate(nulls, F.lit(0.0), lambda a, x: a + x) / len(columns), F.size(F.filter(nulls, lambda x: x > 50))
    orders = F.array(*(F.when(F.col(f"mean_{c}") > 0, F.log10(f"mean_{c}")).otherwise(0.0) for c in spend))
    spread = F.array_max(orders) - F.array_min(orders) if spend else F.lit(0.0)
    negatives = F.col("neg_revenue") + F.col("neg_spend") + F.col("neg_clicks")
    full = 100 * F.col("days") / (F.datediff("last", "first") + 1)
    rows = F.array(
        *(
            F.struct(*_row(*row))
            for row in (
                ("schema", F.lit(bool(lacking)), F.lit(bool(odd)), F.lit(len(lacking) + len(odd))), ("rules", F.col("broken") > 0, no, F.col("broken")), ("missing", all_null > given["missing"], all_null > given["missing"] / 2, all_null),
                ("empty_columns", empty > given["empty_columns"], no, empty), ("business_rules", F.col("neg_revenue") > 0, no, F.col("neg_revenue")), ("completeness", full < 80, full < 90, full),
                ("value_sanity", negatives > 0, spread > given["orders"], negatives),
            )
        )
    )
    flat = one.select(F.explode(rows).alias("r")).select("r.*")
    keys = quality.duplicates(df, [day, *by])
    repeated = 100 * F.col("surplus") / F.col("n_rows")
    flat = flat.unionByName(keys.select(*_row("duplicate_rows", repeated > 5, no, repeated))).unionByName(keys.select(*_row("keys", F.col("in_groups") > 0, no, F.col("in_groups"))))
    digital = quality.digital_quality(df, metrics).agg(F.avg("quality").alias("q")) if metrics else df.limit(0).agg(F.lit(100.0).alias("q"))
    flat = flat.unionByName(digital.select(*_row("digital_quality", F.col("q") < given["digital_quality"], no, F.col("q"))))
    weeks = df.groupBy(*by).agg(F.count_distinct(F.date_trunc("week", day)).alias("weeks")) if by else df.agg(F.count_distinct(F.date_trunc("week", day)).alias("weeks"))
    span = df.agg(F.count_distinct(F.date_trunc("week", day)).alias("all"))
    held = weeks.join(F.broadcast(span), how="cross").agg(  # one row
        F.count_if(F.col("weeks") < min_weeks).alias("short"), F.count_if((F.col("weeks") >= min_weeks) & (F.col("weeks") < preferred_weeks)).alias("fair"), F.count_if(100 * F.col("weeks") / F.col("all") < 100 - given["weeks_missing_pct"]).alias("gaps"), F.count("*").alias("n")
    )
    flat = flat.unionByName(held.select(*_row("coverage", (F.col("short") > 0) | (F.col("gaps") > 0.1 * F.col("n")), F.col("fair") > 0, F.col("short"))))
    if spend:
        told = quality.identifiability(df, list(spend))
        rare = told.agg(F.count_if(F.col("zero_pct") < given["zero_pct"] / 2).alias("never"), F.count_if(F.col("zero_pct") < given["zero_pct"]).alias("always_on"))
        near = quality.correlated_pairs(df, list(spend)).agg(F.count_if(F.abs("corr") > given["correlation"]).alias("near")) if len(spend) > 1 else df.limit(0).agg(F.lit(0).alias("near"))
        both = rare.join(F.broadcast(near), how="cross")  # one row each
        flat = flat.unionByName(both.select(*_row("identifiability", (F.col("never") > 0) | (F.col("near") > 0), F.col("always_on") > 0, F.col("always_on"))))
    out = written(flat.orderBy("check").coalesce(1))
    drop(df)
    return out


def scored(rows: DataFrame) -> DataFrame:
    """Score and status of a report."""
    return matrix.score(rows.select("check", (F.col("penalty") > 0).alias("failed"), "penalty"))
