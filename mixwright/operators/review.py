"""Review of a fitted model's inputs and outputs: features by kind, lift of spend, patterns of credit, score and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.functions.windows import Series
from mixwright.operators import selection

FRESH, SUMS, SMOOTH, LIFT = (0.1, 0.3), (0.95, 1.05), 0.1, 1.1


def baseline_features(df: DataFrame, s: Series, columns: list[str], smooth: float = SMOOTH) -> DataFrame:
    """feature, variance, range, missing_pct, and for trends roughness (spread of second differences over that of the series, the
    mean of the series) and whether it is under ``smooth``. Null counts as 0 in the figures."""
    x = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    second = lambda c: x(c) - 2 * F.lag(x(c)).over(s.ordered()) + F.lag(x(c), 2).over(s.ordered())
    trends = [c for c in columns if "trend" in c.lower()]
    rows = df.select(*s.by, *columns, *(second(c).alias(f"_2_{c}") for c in trends))
    rough = rows.groupBy(*s.by).agg(F.lit(0).alias("_"), *((F.stddev_pop(f"_2_{c}") / (F.stddev_pop(x(c)) + 1e-8)).alias(c) for c in trends)).agg(F.lit(0).alias("_"), *(F.avg(c).alias(f"_r_{c}") for c in trends))
    one = rows.agg(*(F.struct(F.lit(c).alias("feature"), F.var_samp(x(c)).alias("variance"), (F.max(x(c)) - F.min(x(c))).alias("range"), (100 * F.avg(F.col(c).isNull().cast("int"))).alias("missing_pct")).alias(c) for c in columns))
    both = one.join(F.broadcast(rough), how="cross")  # one row each
    full = [F.col(c).withField("roughness", F.col(f"_r_{c}") if c in trends else F.lit(None).cast("double")) for c in columns]
    return both.select(F.explode(F.array(*full)).alias("f")).select("f.*").withColumn("smooth", F.col("roughness") <= smooth)


def attribution_features(df: DataFrame, columns: list[str], sums: tuple[float, float] = SUMS) -> DataFrame:
    """feature, mean, within (the expected range), variation (infinite as null)."""
    x = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    one = df.agg(*(F.struct(F.lit(c).alias("feature"), F.avg(x(c)).alias("mean"), F.stddev_samp(x(c)).alias("spread")).alias(c) for c in columns))
    out = one.select(F.explode(F.array(*columns)).alias("f")).select("f.*")
    return out.select("feature", "mean", F.col("mean").between(*sums).alias("within"), F.try_divide("spread", F.when(F.col("mean") > 0, F.col("mean"))).alias("variation"))


def fatigue_features(df: DataFrame, s: Series, columns: list[str], fresh: tuple[float, float] = FRESH) -> DataFrame:
    """feature, fresh_share (rows at full effect), within (the expected range) and, over all stretches between such rows of a
    series, the share that ends no higher than it starts; consistent from 0.7 on, or without any stretch."""
    rows = df.select(*s.by, s.order, *(F.coalesce(F.col(c).cast("double"), F.lit(1.0)).alias(c) for c in columns)).withColumn("place", s.number())
    each = rows.unpivot([*s.by, "place"], columns, "feature", "x")
    w = Window.partitionBy(*s.by, "feature").orderBy("place")
    found = each.where("x = 1").withColumn("gap", F.lead("place").over(w) - F.col("place")).where("gap >= 2").groupBy("feature").agg(F.count("*").alias("stretches"))
    # Both ends of a stretch are at full effect, so that none ends higher than it starts.
    shares = each.groupBy("feature").agg(F.avg((F.col("x") == 1).cast("int")).alias("fresh_share"))
    return shares.join(found, "feature", "left").select("feature", "fresh_share", F.col("fresh_share").between(*fresh).alias("within"), F.coalesce("stretches", F.lit(0)).alias("stretches"), F.lit(True).alias("consistent"))


def lift(df: DataFrame, by: list[str], spend: list[str], revenue: str, threshold: float = LIFT) -> DataFrame:
    """by, channel, high and low (mean revenue of the rows of most and of least spend, by the 80th and 20th percentile), their
    ratio and whether it exceeds ``threshold``. Null spend counts as 0."""
    each = df.select(*by, F.col(revenue).cast("double").alias("_y"), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in spend)).unpivot([*by, "_y"], spend, "channel", "x")
    ends = selection.wide(selection.percentiles(each, [*by, "channel"], "x", [0.2, 0.8]), [*by, "channel"], {0.2: "_lo", 0.8: "_hi"})
    rows = each.join(ends, [*by, "channel"])  # a row a group: Spark sends it whole while it is small
    out = rows.groupBy(*by, "channel").agg(F.avg(F.when(F.col("x") >= F.col("_hi"), F.col("_y"))).alias("high"), F.avg(F.when(F.col("x") <= F.col("_lo"), F.col("_y"))).alias("low"))
    return out.withColumn("ratio", F.try_divide("high", F.when(F.col("low") != 0, F.col("low")))).withColumn("lifts", F.coalesce(F.col("high") > F.col("low") * threshold, F.lit(False)))


def credit_patterns(rows: DataFrame) -> DataFrame:
    """Of credited touches (attribution.credited): channel, primary_share (of its conversions those in which it has most of the
    credit), assisted_share (those whose last touch is another's), view_share (of its credit), stability of its weekly credit."""
    each = rows.groupBy("conversion_id", "channel").agg(F.sum("credit").alias("credit"), F.max(F.struct("ts", "event_id")).alias("last"), F.sum(F.when(F.col("interaction_type") == "view", F.col("credit")).otherwise(0.0)).alias("views"))
    w = Window.partitionBy("conversion_id")
    told = each.withColumns({"most": F.max(F.round("credit", 9)).over(w) == F.round("credit", 9), "ends": F.max("last").over(w) == F.col("last")})
    shares = told.groupBy("channel").agg(F.avg(F.col("most").cast("int")).alias("primary_share"), F.avg((~F.col("ends")).cast("int")).alias("assisted_share"), (F.sum("views") / F.sum("credit")).alias("view_share"))
    weeks = rows.groupBy("channel", F.date_trunc("week", "conversion_ts").alias("week")).agg(F.sum("credit").alias("credit"))
    steady = weeks.groupBy("channel").agg((1 / (1 + F.coalesce(F.try_divide(F.stddev_pop("credit"), F.avg("credit")), F.lit(0.0)))).alias("stability"))
    return shares.join(steady, "channel")


def incrementality_score(channel: Column, roi: dict[str, float]) -> Column:
    """A fifth of the middle of a channel's return prior, at most 1; 0.6 where there is none."""
    return F.coalesce(*(F.when(channel == c, F.lit(min(1.0, v / 5))) for c, v in roi.items()), F.lit(0.6))


def model_summary(df: DataFrame, actual: str, guess: str) -> DataFrame:
    """Rows, and mean, spread and ends of actual and guessed values, with the ratio of their ranges; one row."""
    parts = [f(c).alias(f"{c}_{n}") for c in (actual, guess) for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("least", F.min), ("most", F.max))]
    out = df.agg(F.count("*").alias("n_rows"), *parts)
    return out.withColumn("range_ratio", F.try_divide(F.col(f"{guess}_most") - F.col(f"{guess}_least"), F.when(F.col(f"{actual}_most") != F.col(f"{actual}_least"), F.col(f"{actual}_most") - F.col(f"{actual}_least"))))


def overall(metrics: DataFrame, trend: DataFrame, compared: DataFrame, features_checked: bool = True) -> DataFrame:
    """Score of at most 1: 0.4 for errors under their limits, in parts, 0.3 by how often the direction is right, 0.2 by the share
    of credit within tolerance of what platforms report, 0.1 for checked features; and what to do about it."""
    ok = {"mape": (F.col("mape") <= 0.15, 0.15), "smape": (F.col("smape") <= 0.15, 0.15), "coverage": (F.col("coverage") >= 0.8, 0.1)}
    parts = sum((F.when(good, worth).otherwise(0.0) for good, worth in ok.values()), F.lit(0.0))
    one = metrics.join(F.broadcast(trend.agg(F.avg("same_direction").alias("agreement"))), how="cross")  # one row each
    one = one.join(F.broadcast(compared.agg(F.avg(F.col("within_tolerance").cast("int")).alias("tolerated"))), how="cross")
    score = parts + 0.3 * F.coalesce("agreement", F.lit(0.0)) + 0.2 * F.coalesce("tolerated", F.lit(0.0)) + (0.1 if features_checked else 0.0)
    advice = F.filter(
        F.array(F.when(~ok["mape"][0], "errors exceed their limit"), F.when(~ok["coverage"][0], "too few values within the expected range"), F.when(F.col("agreement") < 0.7, "direction of change is often wrong"), F.when(F.col("tolerated") < 1, "credit differs from what platforms report")),
        lambda x: x.isNotNull(),
    )
    return one.select(parts.alias("errors"), "agreement", "tolerated", F.least(score, F.lit(1.0)).alias("score"), F.when(F.size(advice) == 0, F.array(F.lit("passed"))).otherwise(advice).alias("advice"))
