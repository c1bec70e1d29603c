"""Column roles, schema checks and the feature matrix."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of features tell their category, in this order, whatever the letter case.
CATEGORIES = {
    "media_spend": (r".*_spend$", r".*_investment$", r".*_cost$"),
    "media_clicks": (r".*_clicks$", r".*_sessions$"),
    "media_impressions": (r".*_impressions$", r".*_views$"),
    "adstock": (r"adstock_.*", r".*_adstocked$"),
    "saturation": (r".*_saturated$", r"saturated_.*"),
    "seasonality": (r"sin_.*", r"cos_.*", r"trend", r".*_seasonal$"),
    "baseline": (r"external_.*", r"baseline_.*", r".*_baseline$"),
    "holidays": (r".*_day$", r".*_before$", r".*_after$"),
    "creative": (r"creative_.*", r".*_creative$"),
    "competitors": (r"competitor_.*", r".*_competitor$"),
    "adjustments": (r".*_ADJUSTMENTS$", r".*_RETURNS$", r".*_adjustments$", r".*_returns$"),
}


@dataclass(frozen=True)
class Roles:
    """Which columns of a table say what. Names are compared in lower case."""

    day: str = "date"
    brand: str | None = "brand"
    region: str | None = "region"
    revenue: str = "revenue"
    channels: tuple[tuple[str, str], ...] = ()

    def resolve(self, df: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
        """The table with trimmed lower-case names, and its columns by role; a missing key is an error."""
        df = df.toDF(*(c.strip().lower() for c in df.columns))
        keys = {"day": self.day, "brand": self.brand, "region": self.region}
        for role, name in keys.items():
            if name and name.lower() not in df.columns:
                raise KeyError(f"the {role} column {name!r} isn't in the table")
        roles = {role: [name.lower()] for role, name in (keys | {"revenue": self.revenue}).items() if name}
        roles["spend"] = [c.lower() for _, c in self.channels if c.lower() in df.columns]
        for part in ("impression", "click"):
            roles[part] = [c for c in df.columns if part in c]
        return df, roles


def spend_columns(df: DataFrame, channels: dict[str, str] | None = None) -> list[str]:
    """Columns that the map of channels names, else those that end in _spend."""
    named = [c for c in (channels or {}).values() if c in df.columns]
    return named or [c for c in df.columns if c.lower().endswith("_spend")]


def category(feature: str) -> str:
    """The first category whose pattern fits, else control."""
    return next((name for name, patterns in CATEGORIES.items() if any(re.match(p, feature, re.I) for p in patterns)), "control")


def as_rows(spark: SparkSession, roles: dict[str, list[str]]) -> DataFrame:
    return spark.createDataFrame([(role, c) for role, names in roles.items() for c in names], "role string, `column` string")


def schema_differences(df: DataFrame, wanted: dict[str, str]) -> list[tuple[str, str, str | None, str]]:
    """(column, wanted type, type found, missing or type) of each wanted column that isn't there as such."""
    found = dict(df.dtypes)
    return [(c, t, found.get(c), "missing" if c not in found else "type") for c, t in wanted.items() if found.get(c) != t]


def broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, broken): rows for which a condition doesn't hold, all counted in one pass; null doesn't hold."""
    one = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    return one.unpivot([], list(rules), "rule", "broken")


def cadence(df: DataFrame, day: str) -> DataFrame:
    """The commonest gap between the table's days, whether that is weekly or daily, and rows of a window that fits."""
    from pyspark.sql import Window

    gap = F.datediff(day, F.lag(day).over(Window.partitionBy().orderBy(day)))  # a row a day
    counted = df.select(day).distinct().select(gap.alias("gap")).where("gap is not null").groupBy("gap").agg(F.count("*").alias("n"))
    top = counted.agg(F.max_by("gap", F.struct("n", -F.col("gap"))).alias("gap"))
    daily = F.col("gap").between(1, 2)
    return top.select("gap", F.when(daily, "daily").otherwise("weekly").alias("cadence"), F.when(daily, 7).otherwise(4).alias("window"))


def frequency(df: DataFrame, day: str) -> DataFrame:
    """daily, weekly, monthly or a number of days, by the median gap between days."""
    from pyspark.sql import Window

    gap = F.datediff(day, F.lag(day).over(Window.partitionBy().orderBy(day)))
    middle = df.select(day).distinct().select(gap.alias("gap")).agg(F.percentile("gap", 0.5).alias("median_gap"))
    label = F.when(F.col("median_gap") == 1, "daily").when(F.col("median_gap") == 7, "weekly").when(F.col("median_gap").between(28, 31), "monthly").otherwise(F.concat(F.col("median_gap").cast("int").cast("string"), F.lit("D")))
    return middle.select("median_gap", label.alias("frequency"))


def missing_days(df: DataFrame, day: str) -> DataFrame:
    """Days between the first and the last that the table lacks."""
    ends = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    calendar = ends.select(F.explode(F.sequence("a", "b")).alias(day))
    return calendar.join(df.select(day).distinct(), day, "left_anti")


def score(checks: DataFrame) -> DataFrame:
    """``checks`` (check, failed, penalty): a row a check -> score from 1 down by the penalties of failed ones, and status."""
    total = checks.agg(F.greatest(1.0 - F.coalesce(F.sum(F.when(F.col("failed"), F.col("penalty"))), F.lit(0.0)), F.lit(0.0)).alias("score"))
    return total.withColumn("status", F.when(F.round("score", 6) < 0.8, "failed").when(F.round("score", 6) < 0.9, "warning").otherwise("passed"))
