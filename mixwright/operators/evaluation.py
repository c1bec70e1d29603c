"""Model matrix, ridge fit, error metrics, stability and allocation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.functions.windows import Series, rolling
from mixwright.operators import selection


def target_stats(df: DataFrame, y: str) -> DataFrame:
    q = selection.wide(selection.percentiles(df, [], y, [0.25, 0.5, 0.75]), [], {0.25: "q25", 0.5: "median", 0.75: "q75"})
    one = df.agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.min(y).alias("least"), F.max(y).alias("most"), F.count_if(F.col(y) == 0).alias("zeros"), F.count_if(F.col(y).isNull()).alias("nulls"))
    return one.join(F.broadcast(q), how="cross")  # one row each


def ridge(df: DataFrame, features: list[str], y: str, prior: float = 1.0, prior0: float = 2.0) -> dict[str, float]:
    """MAP of a linear predictor for log y with normal priors (not posterior sampling). One aggregate of cross products; the
    driver solves a system as large as the number of features. Returns coefficients, intercept and sigma."""
    cols = ["_one", *features]
    rows = df.select(F.lit(1.0).alias("_one"), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features), F.ln(F.greatest(F.col(y), F.lit(1e-6))).alias("_y"))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = rows.agg(*(F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a, b in pairs), *(F.sum(F.col(a) * F.col("_y")).alias(f"{a}*_y") for a in cols), F.sum(F.col("_y") * F.col("_y")).alias("_yy"), F.count("*").alias("_n")).first()
    gram = np.array([[one[f"{a}*{b}"] if f"{a}*{b}" in one else one[f"{b}*{a}"] for b in cols] for a in cols], float)
    moment = np.array([one[f"{a}*_y"] for a in cols], float)
    sigma2 = 1.0
    for _ in range(20):
        w = np.linalg.solve(gram + sigma2 * np.diag([1 / prior0**2, *[1 / prior**2] * len(features)]), moment)
        sigma2 = max((one["_yy"] - 2 * w @ moment + w @ gram @ w) / max(one["_n"], 1), 1e-12)
    return dict(zip(["intercept", *features], map(float, w), strict=True)) | {"sigma": float(sigma2**0.5)}


def predicted(features: list[str], model: dict[str, float]) -> Column:
    eta = F.lit(model["intercept"])
    for f in features:
        eta = eta + model[f] * F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    return F.exp(eta + model["sigma"] ** 2 / 2)


def core_metrics(df: DataFrame, actual: str, guess: str) -> DataFrame:
    a, p = F.col(actual), F.col(guess)
    mean = df.agg(F.avg(actual).alias("_m"), F.stddev_pop(a - p).alias("_s"))
    return df.join(F.broadcast(mean)).agg(
        F.avg(F.abs(a - p) / F.greatest(F.abs(a), F.lit(1e-8))).alias("mape"), F.sqrt(F.avg(F.pow(a - p, 2))).alias("rmse"), (1 - F.try_divide(F.sum(F.pow(a - p, 2)), F.sum(F.pow(a - F.col("_m"), 2)))).alias("r2"),
        F.avg(2 * F.abs(p - a) / F.greatest(F.abs(a) + F.abs(p), F.lit(1e-8))).alias("smape"), F.avg((F.abs(a - p) <= 1.28 * F.col("_s")).cast("int")).alias("coverage"),
    )


def holdout(df: DataFrame, s: Series, share: float = 0.8) -> DataFrame:
    n = F.count("*").over(s.whole())
    return df.withColumn("part", F.when(s.number() <= F.floor(n * share), "train").otherwise("test"))


def trend_consistency(df: DataFrame, s: Series, actual: str, guess: str) -> DataFrame:
    step = lambda c: F.col(c) - F.lag(c).over(s.ordered())
    rows = df.select(*s.by, step(actual).alias("a"), step(guess).alias("p")).where("a is not null")
    return rows.groupBy(*s.by).agg(F.avg((F.signum("a") == F.signum("p")).cast("int")).alias("same_direction"), F.corr("a", "p").alias("corr"))


def drift(df: DataFrame, s: Series, actual: str, guess: str) -> DataFrame:
    """Largest sum of errors (guess less actual) so far, their trend and spread; high where that sum exceeds the target's spread."""
    error = F.col(guess) - F.col(actual)
    rows = df.select(*s.by, error.alias("e"), F.col(actual).alias("a"), F.sum(error).over(s.so_far()).alias("c"), s.number().alias("n"))
    out = rows.groupBy(*s.by).agg(F.max(F.abs("c")).alias("worst"), F.coalesce(F.regr_slope("e", "n"), F.lit(0.0)).alias("slope"), F.stddev_pop("e").alias("spread"), F.stddev_pop("a").alias("_of"))
    return out.withColumn("severity", F.when(F.col("worst") > F.col("_of"), "high").otherwise("low")).drop("_of")


def seasonal(df: DataFrame, by: list[str], day: str, actual: str, guess: str) -> DataFrame:
    months = df.groupBy(*by, F.month(day).alias("month")).agg(F.avg(F.abs(F.col(actual) - F.col(guess)) / F.greatest(F.abs(actual), F.lit(1e-8))).alias("mape"))
    return months.groupBy(*by).agg(F.avg("mape").alias("mean_mape"), F.stddev_pop("mape").alias("spread"), F.max("mape").alias("worst"))


def stability(df: DataFrame, s: Series, spend: str) -> DataFrame:
    rows = df.select(*s.by, rolling("std", F.col(spend), s, 4).alias("d"), rolling("mean", F.col(spend), s, 4).alias("m"))
    return rows.groupBy(*s.by).agg((1 / (1 + F.try_divide(F.avg("d"), F.avg("m")))).alias("stability"))


def incrementality(df: DataFrame, by: list[str], spend: str, revenue: str) -> DataFrame:
    """Mean revenue of the days of most and of least spend."""
    w = Window.partitionBy(*by)
    rows = df.withColumn("hi", F.percentile(spend, 0.8).over(w)).withColumn("lo", F.percentile(spend, 0.2).over(w))
    return rows.groupBy(*by).agg(F.avg(F.when(F.col(spend) >= F.col("hi"), F.col(revenue))).alias("high"), F.avg(F.when(F.col(spend) <= F.col("lo"), F.col(revenue))).alias("low"))


def part_metrics(df: DataFrame, by: list[str], actual: str, guess: str) -> DataFrame:
    a, p = F.col(actual), F.col(guess)
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.avg(F.abs(a - p) / F.greatest(F.abs(a), F.lit(1e-8))).alias("mape"), F.sqrt(F.avg(F.pow(a - p, 2))).alias("rmse"))


def contributions(df: DataFrame, s: Series, spend: str) -> DataFrame:
    """Share of all spend, variation and share of days without any, by series."""
    rows = df.groupBy(*s.by).agg(F.sum(spend).alias("spend"), F.when(F.avg(spend) > 0, F.stddev_samp(spend) / F.avg(spend)).otherwise(0.0).alias("variation"), F.avg((F.col(spend) == 0).cast("int")).alias("zero_share"))
    return rows.join(F.broadcast(rows.agg(F.sum("spend").alias("all"))), how="cross").select(*s.by, (F.col("spend") / F.col("all")).alias("share"), "variation", "zero_share")  # one row


def smoothness(df: DataFrame, s: Series, x: str) -> DataFrame:
    """Spread of the second differences over that of the series."""
    before = F.lag(x).over(s.ordered())
    second = F.col(x) - 2 * before + F.lag(x, 2).over(s.ordered())
    return df.select(*s.by, F.col(x).alias("x"), second.alias("second")).groupBy(*s.by).agg((F.stddev_pop("second") / (F.stddev_pop("x") + 1e-8)).alias("roughness"))


def overall(metrics: DataFrame, trend: DataFrame) -> DataFrame:
    """Score of up to 0.7: 0.4 for errors under their limits, in parts, and 0.3 by how often the direction is right."""
    ok = {"mape": (F.col("mape") <= 0.15, 0.15), "smape": (F.col("smape") <= 0.15, 0.15), "coverage": (F.col("coverage") >= 0.8, 0.1)}
    parts = sum((F.when(good, worth).otherwise(0.0) for good, worth in ok.values()), F.lit(0.0))
    return metrics.join(F.broadcast(trend.agg(F.avg("same_direction").alias("agreement"))), how="cross").select(parts.alias("errors"), "agreement", F.least(parts + 0.3 * F.col("agreement"), F.lit(1.0)).alias("score"))  # one row each


def contribution_shares(model: dict[str, float], channels: dict[str, list[str]]) -> list[tuple[str, float, float]]:
    """(channel, sum of absolute coefficients of its features, percent of all)."""
    sums = {c: sum(abs(model.get(f, 0.0)) for f in features) for c, features in channels.items()}
    whole = sum(sums.values()) or 1.0
    return [(c, v, 100 * v / whole) for c, v in sums.items()]


# Half and power of the saturation curve, and carry-over, by channel.
SATURATION = {"search": (0.3, 1.2), "shopping": (0.3, 1.2)}
CARRY = {"search": 0.3, "display": 0.8, "video": 0.8}


def multiplier(channel: str, roi: float = 2.0) -> float:
    """Return of a channel's money once spend is full: saturation there is constant, so returns are linear in spend."""
    half, power = SATURATION.get(channel, (0.5, 1.0))
    return roi * max(1 / (half**power + 1), 0.1) * (1 + CARRY.get(channel, 0.6))


def effect(spend: Column, channel: Column) -> Column:
    """How much of its return money still has: spend over 1000 counts as full; never under 0.1."""
    full = spend / F.greatest(spend, F.lit(1000.0))
    half, power = (F.coalesce(*(F.when(channel == c, F.lit(v[i])) for c, v in SATURATION.items()), F.lit((0.5, 1.0)[i])) for i in (0, 1))
    return F.greatest(F.pow(full, power) / (F.pow(half, power) + F.pow(full, power)), F.lit(0.1))


def carry(channel: Column) -> Column:
    return 1 + F.coalesce(*(F.when(channel == c, F.lit(v)) for c, v in CARRY.items()), F.lit(0.6))


def curves(channels: DataFrame, budgets: list[float], roi: float = 2.0) -> DataFrame:
    """``channels`` (channel) -> channel, budget, revenue: what each of ``budgets`` brings."""
    rows = channels.withColumn("budget", F.explode(F.array(*map(F.lit, budgets))))
    return rows.withColumn("revenue", F.col("budget") * roi * effect(F.col("budget"), F.col("channel")) * carry(F.col("channel")))


def latest_spend(daily: DataFrame, day: str, columns: list[str], rows: int = 4) -> DataFrame:
    """(channel, current): mean spend of the last days."""
    last = daily.groupBy(day).agg(*(F.sum(c).alias(c) for c in columns)).orderBy(F.desc(day)).limit(rows)
    return last.agg(*(F.avg(c).alias(c.removesuffix("_spend")) for c in columns)).unpivot([], [c.removesuffix("_spend") for c in columns], "channel", "current")


def proportional(current: DataFrame, budget: float) -> DataFrame:
    """``budget`` dealt as money is spent now, in equal parts where none is."""
    whole = Window.partitionBy()  # a row a channel
    total = F.sum("current").over(whole)
    return current.select("channel", "current", (budget * F.when(total > 0, F.col("current") / F.when(total > 0, total)).otherwise(1 / F.count("*").over(whole))).alias("allocated"))


def reallocation(plan: DataFrame) -> DataFrame:
    """By scenario: channels with over 15 % more or less, with under 5 % of change, and the mean change."""
    c = F.col("pct_change")
    return plan.groupBy("scenario").agg(F.count_if(c > 15).alias("increases"), F.count_if(c < -15).alias("decreases"), F.count_if(F.abs(c) < 5).alias("stable"), F.avg(F.abs(c)).alias("mean_change"))


def priorities(plan: DataFrame) -> DataFrame:
    """Channels that several scenarios raise, by over 10 % in the mean."""
    return plan.groupBy("channel").agg(F.count("pct_change").alias("scenarios"), F.avg("pct_change").alias("mean_change")).where("scenarios > 1 and mean_change > 10")


def best_scenarios(sums: DataFrame) -> DataFrame:
    """The scenario of the best return, and that of the largest gain over the present one."""
    gain = F.col("roas_best") - F.col("roas_now")
    return sums.agg(F.max_by("scenario", F.struct(F.round("roas_best", 6), "scenario")).alias("best_roas"), F.max_by("scenario", F.struct(F.round(gain, 6), "scenario")).alias("best_gain"), F.max("roas_best").alias("roas"))


def allocation(current: DataFrame, scenarios: DataFrame, channels: list[str], least: float = 0.05, most: float = 0.4) -> DataFrame:
    """``current`` (channel, current) and ``scenarios`` (scenario, budget_multiplier) -> scenario, channel, current, optimised,
    change, pct_change. Returns are linear at full spend, so the optimum gives every channel its least share and fills up the
    rest by return. Both tables are of a few rows."""
    if len(channels) * most < 1 or len(channels) * least > 1:
        raise ValueError("the bounds leave no allocation")
    rates = F.create_map(*(F.lit(x) for c in channels for x in (c, multiplier(c))))
    pairs = current.withColumn("rate", rates[F.col("channel")]).join(F.broadcast(scenarios))
    order = Window.partitionBy("scenario").orderBy(F.desc("rate"), "channel")
    ranked = pairs.withColumn("place", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(Window.partitionBy("scenario"))).withColumn("total", F.sum("current").over(Window.partitionBy("scenario")) * F.col("budget_multiplier"))
    free = 1 - F.col("n") * least
    share = least + F.greatest(F.least(free - F.col("place") * (most - least), F.lit(most - least)), F.lit(0.0))
    out = ranked.withColumn("optimised", F.col("total") * share)
    return out.select("scenario", "channel", "current", "optimised", (F.col("optimised") - F.col("current")).alias("change"), (100 * F.try_divide(F.col("optimised") - F.col("current"), F.when(F.col("current") != 0, F.col("current")))).alias("pct_change"), "rate")


def returns(plan: DataFrame) -> DataFrame:
    return plan.groupBy("scenario").agg(F.try_divide(F.sum(F.col("current") * F.col("rate")), F.sum("current")).alias("roas_now"), F.try_divide(F.sum(F.col("optimised") * F.col("rate")), F.sum("optimised")).alias("roas_best"))


def top_moves(plan: DataFrame, k: int = 5, least: float = 5.0) -> DataFrame:
    """The largest changes; moves of at most ``least`` percent are none."""
    return plan.where(F.abs("pct_change") > least).orderBy(F.desc(F.round(F.abs("change"), 4)), "scenario", "channel").limit(k).select("scenario", "channel", "change", F.when(F.abs("pct_change") > 20, "major").otherwise("minor").alias("size"))
