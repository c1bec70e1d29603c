"""Baseline controls: as-of joins, events, quality of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_day: str, right_day: str, value: str, lag_days: int = 0) -> DataFrame:
    """``left`` with the last ``value`` of ``right`` known ``lag_days`` later on or before its day.

    Both sides are laid into one series by ``by`` and the value carried on: one shuffle and no join. Without ``by`` the series
    has a row for each different day, which the calendar bounds, and its values are joined to ``left`` by day.
    """
    known = right.select(*by, F.date_add(right_day, lag_days).alias("_at"), F.col(value).cast("double").alias("_v"), F.lit(0).alias("_side"))
    asked = left.select("*", F.col(left_day).alias("_at"), F.lit(1).alias("_side")) if by else left.select(left_day).distinct().select(left_day, F.col(left_day).alias("_at"), F.lit(1).alias("_side"))
    carried = F.last("_v", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0))
    both = asked.unionByName(known, allowMissingColumns=True).withColumn(value, carried).where("_side = 1").drop("_at", "_v", "_side")
    return both if by else left.join(both, left_day)


def daily(days: DataFrame, known: DataFrame, day: str, value: str) -> DataFrame:
    """``days`` (different days) with ``value`` of ``known`` laid over them: straight lines between known days, carried on
    behind the last, carried back before the first. A row a day, so one window."""
    joined = days.select(F.col(day).alias("_d")).join(known.select(F.col(day).alias("_d"), F.col(value).cast("double").alias("_v")), "_d", "full")
    order = Window.partitionBy().orderBy("_d")
    past, rest = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("_v").isNotNull(), F.col("_d"))
    ends = joined.withColumns({"a": F.last("_v", ignorenulls=True).over(past), "b": F.first("_v", ignorenulls=True).over(rest), "at": F.last(at, ignorenulls=True).over(past), "bt": F.first(at, ignorenulls=True).over(rest)})
    line = F.col("a") + (F.col("b") - F.col("a")) * F.try_divide(F.datediff("_d", "at").cast("double"), F.datediff("bt", "at"))
    filled = ends.select(F.col("_d").alias(day), F.coalesce("_v", line, "a", "b").alias(value))
    return days.join(filled, day)


def standardized(x: Column, training: Column, by: list[str]) -> Column:
    """Less the mean, over the deviation, both of the rows of ``training`` alone."""
    w = Window.partitionBy(*by)
    known = F.when(training, x)
    return F.try_divide(x - F.avg(known).over(w), F.when(F.stddev_pop(known).over(w) > 0, F.stddev_pop(known).over(w)))


def event(d: Column, name: str, start: str, end: str, kind: str = "step") -> dict[str, Column]:
    """Whether a day lies in an event's interval, and for a ramp_up or ramp_down a second column that rises or falls across it."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    on = (d >= first) & (d <= last)
    share = F.least(F.greatest(F.datediff(d, first) / (F.datediff(last, first) + 1e-9), F.lit(0.0)), F.lit(1.0))
    ramps = {"ramp_up": share, "ramp_down": 1 - share}
    return {f"external_{name}": on.cast("int")} | ({f"external_{name}_ramp": F.when(on, ramps[kind]).otherwise(0.0)} if kind in ramps else {})


def spread(df: DataFrame, columns: list[str], least: float = 1e-6) -> DataFrame:
    """The sample variance of each column and whether it is worth keeping."""
    one = df.agg(*(F.var_samp(c).alias(c) for c in columns))
    return one.unpivot([], columns, "column", "variance").withColumn("keep", F.coalesce(F.col("variance") >= least, F.lit(False)))


def most_varied(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    return spread(df, columns).orderBy(F.desc("variance"), "column").limit(k).select("column", "variance")


def correlated(df: DataFrame, columns: list[str], most: float = 0.95) -> DataFrame:
    """Pairs of columns that say nearly the same; of each the first is to go."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("dropped"), F.split("pair", r"\|")[1].alias("kept"), "corr").where(F.abs("corr") > most)


def first_of_day(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the first by ``order``."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", first).where("_n = 1").drop("_n")
