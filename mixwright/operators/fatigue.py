"""Creative fatigue: refreshes, and how spend wears off between them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.functions.windows import Series, change, rolling

EPSILON = 1e-12


def worn(day: Column, refreshed: Column, s: Series, half_life: float = 14.0, floor: float = 0.2) -> Column:
    """The share of effect left since the last refresh, or since the first day."""
    since = F.coalesce(F.last(F.when(refreshed, day), ignorenulls=True).over(s.so_far()), F.min(day).over(s.whole()))
    return F.greatest(F.exp(F.datediff(day, since) * (math.log(0.5) / half_life)), F.lit(floor))


def periodic(day: Column, s: Series, days: int = 30) -> Column:
    return F.pmod(F.datediff(day, F.min(day).over(s.whole())), F.lit(days)) == 0


def debounced(df: DataFrame, s: Series, candidate: Column, gap: int) -> DataFrame:
    """Candidate days of each series at least ``gap`` days after the last accepted one, taken greedily: a fold along each
    series' candidates, which are few."""
    days = df.where(candidate).groupBy(*s.by).agg(F.array_sort(F.collect_list(s.order)).alias("days"))
    start = F.array().cast("array<date>")
    step = lambda a, d: F.when((F.size(a) == 0) | (F.datediff(d, F.element_at(a, F.greatest(F.size(a), F.lit(1)))) >= gap), F.concat(a, F.array(d))).otherwise(a)
    guard = lambda a, d: F.when(F.size(a) == 0, F.array(d)).otherwise(step(a, d))
    return days.select(*s.by, F.explode(F.aggregate("days", start, guard)).alias(s.order))


def debounced_rows(df: DataFrame, s: Series, candidate: Column, gap: int) -> DataFrame:
    """As ``debounced``, with the gap counted in rows of the series: its keys and the accepted row numbers."""
    rows = df.withColumn("_hit", candidate).withColumn("place", s.number()).where("_hit").groupBy(*s.by).agg(F.array_sort(F.collect_list("place")).alias("places"))
    step = lambda a, p: F.when(F.size(a) == 0, F.array(p)).when(p - F.element_at(a, F.greatest(F.size(a), F.lit(1))) >= gap, F.concat(a, F.array(p))).otherwise(a)
    return rows.select(*s.by, F.explode(F.aggregate("places", F.array().cast("array<int>"), step)).alias("place"))


def guarded(refreshed: Column, s: Series, most: float = 0.4) -> Column:
    """Refreshes, or where they are more than half as many again as ``most`` of the rows, the first and last row and evenly
    spaced ones."""
    n, number = F.count("*").over(s.whole()), s.number() - 1
    rate = F.avg(refreshed.cast("int")).over(s.whole())
    slots = F.floor(n * most) - 2
    step = F.when(slots > 0, F.floor(n / F.greatest(slots, F.lit(1))))
    even = F.coalesce((F.pmod(number, step) == 0) & (number >= step) & (number < n - step), F.lit(False))
    return F.when(rate > 1.5 * most, (number == 0) | (number == n - 1) | even).otherwise(refreshed)


def wears_off(df: DataFrame, s: Series, factor: str) -> DataFrame:
    """Of the stretches between refreshes (both included, over two rows) the share that end no higher than they start; a series
    is consistent from 0.7 on, or without any."""
    fresh = df.where(F.col(factor) == 1).withColumns({"place": F.col("_place")}) if "_place" in df.columns else df.withColumn("place", s.number()).where(F.col(factor) == 1)
    stretch = fresh.withColumns({"after": F.lead("place").over(s.ordered()), "end": F.lead(factor).over(s.ordered())}).where("after - place >= 2")
    return stretch.groupBy(*s.by).agg(F.count("*").alias("stretches"), F.avg((F.col("end") <= F.col(factor)).cast("int")).alias("share")).withColumn("consistent", F.col("share") >= 0.7)


def weekly_level(spend: Column, s: Series, width: int = 7) -> Column:
    """The mean of a week, a little above 0 everywhere, so that a start from nothing is a change."""
    return rolling("mean", spend + EPSILON, s, width, 1)


def spend_jumps(level: Column, s: Series, least: float = 0.5) -> Column:
    """Whether the weekly level (a column made before) moved by more than ``least`` of itself."""
    return F.coalesce(F.abs(change(level, s)) > least, F.lit(False))


def launches(spend: Column, s: Series, threshold: float) -> Column:
    return F.coalesce((F.lag(spend).over(s.ordered()) <= threshold) & (spend > threshold), F.lit(False))


def opened(df: DataFrame, s: Series, spend: str, threshold: float = 0.0) -> DataFrame:
    """Series whose first row already has spend above ``threshold``, with its day as the order column and 1 as place: such a row is
    a refresh, whatever follows."""
    first = df.groupBy(*s.by).agg(F.min_by(F.struct(s.order, spend), s.order).alias("_f"))
    return first.where(F.col(f"_f.{spend}") > threshold).select(*s.by, F.col(f"_f.{s.order}").alias(s.order), F.lit(1).alias("place"))


def refreshes(df: DataFrame, s: Series, spend: str, method: str, **how) -> DataFrame:
    """``df`` with a column ``refreshed``: by spend_change, campaign_launch or periodic detection, first rows with spend included."""
    if method == "periodic":
        return df.withColumn("refreshed", periodic(F.col(s.order), s, how.get("days", 30)))
    if method == "spend_change":
        level = df.withColumn("_level", weekly_level(F.col(spend), s, how.get("window", 7)))
        found = debounced(level.withColumn("_hit", spend_jumps(F.col("_level"), s, how.get("least", 0.5))), s, F.col("_hit"), how.get("gap", 7)).unionByName(opened(df, s, spend, EPSILON).drop("place"))
        return df.join(found.distinct().withColumn("refreshed", F.lit(True)), [*s.by, s.order], "left").withColumn("refreshed", F.coalesce("refreshed", F.lit(False)))
    if method == "campaign_launch":
        threshold = how.get("threshold", 0.1)
        found = debounced_rows(df, s, launches(F.col(spend), s, threshold), how.get("gap", 7)).unionByName(opened(df, s, spend, threshold).drop(s.order))
        numbered = df.withColumn("place", s.number())
        return numbered.join(found.distinct().withColumn("refreshed", F.lit(True)), [*s.by, "place"], "left").withColumn("refreshed", F.coalesce("refreshed", F.lit(False))).drop("place")
    raise ValueError("a method is periodic, spend_change or campaign_launch")


def nearest(days: DataFrame, refreshes: DataFrame, day: str, tolerance: int = 5) -> DataFrame:
    """For each refresh the nearest day within ``tolerance`` (the earlier of two). Each refresh asks for the few days around it."""
    asked = refreshes.withColumn(day, F.explode(F.sequence(F.date_sub("refresh_date", tolerance), F.date_add("refresh_date", tolerance))))
    met = asked.join(days.select(day).distinct(), day).withColumn("gap", F.abs(F.datediff(day, "refresh_date")))
    best = F.row_number().over(Window.partitionBy("refresh_date").orderBy("gap", day))
    return met.withColumn("_n", best).where("_n = 1").select("refresh_date", day, "gap")


def wear(df: DataFrame, by: list[str], spend: str, factor: str, floor: float = 0.2, refreshed: str | None = None) -> DataFrame:
    """How much spend loses, spread of the factor, days at either end; with a column of refreshes also their number and the mean
    days between them, null for fewer than two."""
    counts = [] if refreshed is None else [F.count_if(F.col(refreshed)).alias("refreshes"), F.try_divide(F.datediff(F.max(F.when(F.col(refreshed), F.col("date_day"))), F.min(F.when(F.col(refreshed), F.col("date_day")))).cast("double"), F.when(F.count_if(F.col(refreshed)) > 1, F.count_if(F.col(refreshed)) - 1)).alias("mean_gap_days")]
    return df.groupBy(*by).agg((100 * (1 - F.try_divide(F.sum(F.col(spend) * F.col(factor)), F.sum(spend)))).alias("impact_pct"), F.min(factor).alias("least"), F.stddev_samp(factor).alias("spread"), F.count_if(F.col(factor) == 1).alias("fresh_days"), F.count_if(F.col(factor) <= floor).alias("floor_days"), *counts)


__all__ = ["worn", "periodic", "debounced", "spend_jumps", "launches", "nearest", "refreshes", "wear", "rolling"]
