"""Cleaning steps: each takes a table and returns it with the step's columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixwright.functions.windows import Series, change, rolling


def hinted_days(hint: str) -> int | None:
    """Days of last_<n>_days, last_<n>_weeks or last_<n>_months (of 30 days); None for any other hint, which cuts nothing."""
    found = re.fullmatch(r"last_(\d+)_(days|weeks|months)", hint)
    return int(found[1]) * {"days": 1, "weeks": 7, "months": 30}[found[2]] if found else None


def latest(df: DataFrame, day: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days of the table, the border included. The last day is read first, so that the filter reaches
    the scan as a literal."""
    end = df.agg(F.max(day)).first()[0]
    return df.where("false") if end is None else df.where(F.col(day) >= F.date_sub(F.lit(end), days))


def negatives(df: DataFrame, column: str, apart: str, flag: str) -> DataFrame:
    """Negative values moved to a column of their own. Null stays null."""
    x = F.col(column)
    below = F.coalesce(x < 0, F.lit(False))
    return df.withColumns({apart: F.when(x.isNotNull(), F.when(below, x).otherwise(0.0)), flag: below.cast("int"), column: F.when(below, 0.0).otherwise(x)})


def exempt(df: DataFrame, s: Series, column: str, promo: str | None = None, multiple: float = 3.0) -> DataFrame:
    """Rows that a cap leaves alone: promotions, and spend over ``multiple`` times the mean of four rows."""
    jump = F.col(column) > multiple * rolling("mean", F.col(column), s, 4, 1)
    return df.withColumn("exempt", (F.coalesce(F.col(promo) == 1, F.lit(False)) if promo else F.lit(False)) | F.coalesce(jump, F.lit(False)))


def winsorized(df: DataFrame, by: list[str], column: str, share: float = 0.99) -> DataFrame:
    """Values over the percentile of the group's rows that aren't exempt, brought down to it."""
    cap = F.percentile(F.when(~F.col("exempt"), F.col(column)), share).over(Window.partitionBy(*by))
    return df.withColumn("cap", cap).withColumn("capped", F.when(~F.col("exempt") & (F.col(column) > F.col("cap")), F.col("cap")).otherwise(F.col(column)))


def glitches(df: DataFrame, s: Series, spend: str, impressions: str, multiple: float = 5.0) -> DataFrame:
    return df.withColumns({"no_delivery": ((F.col(spend) > 0) & (F.coalesce(impressions, F.lit(0)) == 0)).cast("int"), "jump": F.coalesce(change(F.col(spend), s) > multiple, F.lit(False)).cast("int")})


def deduplicated(df: DataFrame, keys: list[str], added: list[str], averaged: list[str], latest_by: str, latest: list[str]) -> DataFrame:
    """One row a key: sums, means, and what the last row says. Null keys are dropped."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.where(present).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in added), *(F.avg(c).alias(c) for c in averaged), *(F.max_by(c, F.struct(latest_by, c)).alias(c) for c in latest), F.count("*").alias("n_rows"))


def paused(df: DataFrame, spend: str, impressions: str, value: float = 0.0) -> DataFrame:
    """Null spend without delivery is a pause; other null spend is 0 and flagged."""
    pause = F.col(spend).isNull() & (F.coalesce(impressions, F.lit(0)) == 0)
    return df.withColumns({"is_pause": pause.cast("int"), "is_gap": (F.col(spend).isNull() & ~pause).cast("int"), "filled": F.coalesce(F.col(spend), F.when(pause, F.lit(value)), F.lit(0.0))})


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows, and a number that no order of rows changes: the sum of a digest of each."""
    row = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns))
    return df.agg(F.count("*").alias("n_rows"), F.sum(F.conv(F.substring(F.md5(row.cast("binary")), 1, 8), 16, 10).cast("bigint")).alias("fingerprint"))


def clipped(df: DataFrame, columns: list[str]) -> DataFrame:
    """Telemetry (clicks, impressions, views) is never negative: such values count as 0 and are flagged."""
    return df.withColumns({f"had_negative_{c}": (F.coalesce(c, F.lit(0)) < 0).cast("int") for c in columns} | {c: F.when(F.col(c) < 0, F.lit(0)).otherwise(F.col(c)) for c in columns})


def with_outcome(df: DataFrame, column: str) -> DataFrame:
    """Rows whose outcome is known: it is never filled in."""
    return df.where(F.col(column).isNotNull())
