"""Allocation of a budget over concave response curves, under bounds by channel, in one fold for each group and scenario.

A channel that gets x brings rate * half * x / (half + x): the first money brings ``rate``, and at ``half`` half of all that can
be had is reached. At the optimum all channels that are on neither bound bring the same for their last money; that common value
falls as the budget grows, so it is found by bisection. All groups and scenarios are solved at once: an array of a channel's
figures a row, however many rows there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.operators.evaluation import CARRY, SATURATION

STEPS = 80
#: Limits of any channel's share, whatever the settings allow.
LEAST, MOST = 0.01, 0.6
#: Spread of the noise on returns, and the least that is left of one.
NOISE, LEFT = 0.1, 0.1


def response_curves(spend: DataFrame, by: list[str], roi: dict[str, float] | None = None, default: float = 2.0) -> DataFrame:
    """``spend`` (by, channel, spend: a row a day) -> by, channel, current, rate, half. ``current`` is the mean day; ``half`` is the
    channel's share of its largest day at which it is half saturated; the middle of the return's prior and the carry-over make
    the rate."""
    of = lambda values, name, rest: F.coalesce(*(F.when(F.col("channel") == c, F.lit(v)) for c, v in values.items()), F.lit(rest)).alias(name) if values else F.lit(rest).alias(name)
    rows = spend.groupBy(*by, "channel").agg(F.avg("spend").alias("current"), F.max("spend").alias("peak"))
    factors = rows.select("*", of(roi or {}, "roi", default), of(CARRY, "carry", 0.6), of({c: v[0] for c, v in SATURATION.items()}, "k", 0.5))
    return factors.select(*by, "channel", "current", (F.col("roi") * (1 + F.col("carry"))).alias("rate"), F.greatest(F.col("k") * F.col("peak"), F.lit(1.0)).alias("half"))


def bounded(curves: DataFrame, bounds: dict[str, tuple[float, float]], default: tuple[float, float] = (0.05, 0.4)) -> DataFrame:
    """``curves`` with each channel's least and largest share of the budget, within the limits of any channel."""
    side = lambda i: F.coalesce(*(F.when(F.col("channel") == c, F.lit(float(b[i]))) for c, b in bounds.items()), F.lit(float(default[i]))) if bounds else F.lit(float(default[i]))
    return curves.withColumns({"least": F.greatest(side(0), F.lit(LEAST)), "most": F.least(side(1), F.lit(MOST))})


def spent(items: Column, price: Column) -> Column:
    """What all channels get if their last money is to bring ``price``."""
    return F.aggregate(items, F.lit(0.0), lambda total, c: total + at_price(c, price))


def at_price(c: Column, price: Column) -> Column:
    return F.least(F.greatest(c["half"] * (F.sqrt(c["rate"] / price) - 1), c["low"]), c["high"])


def revenue(x: Column, rate: Column, half: Column) -> Column:
    return rate * half * x / (half + x)


def allocate(curves: DataFrame, scenarios: DataFrame, by: list[str], adjustments: DataFrame | None = None) -> DataFrame:
    """``curves`` (by, channel, current, rate, half, least, most) and ``scenarios`` (scenario, budget_multiplier; a few rows) ->
    by, scenario, channel, current, optimised, change, pct_change, revenue_now, revenue_best, status.

    ``adjustments`` (scenario, channel, factor) move present spend between channels first, the total kept. Where the bounds leave
    no allocation the budget is dealt as money is spent now, in equal parts where none is, and the status is ``fallback``.
    """
    rows = curves.join(F.broadcast(scenarios))  # a few scenarios
    if adjustments is not None:
        rows = rows.join(F.broadcast(adjustments), ["scenario", "channel"], "left").withColumn("start", F.col("current") * F.coalesce("factor", F.lit(1.0)))
    else:
        rows = rows.withColumn("start", F.col("current"))
    item = F.struct("channel", "current", "start", "rate", "half", "least", "most")
    one = rows.groupBy(*by, "scenario", "budget_multiplier").agg(F.sort_array(F.collect_list(item)).alias("c"), F.sum("current").alias("now"), F.sum("start").alias("started"))  # a row a channel
    one = one.withColumn("budget", F.col("now") * F.col("budget_multiplier")).withColumn(
        "c", F.transform("c", lambda c: F.struct(c["channel"].alias("channel"), F.when(F.col("started") > 0, c["start"] * F.col("now") / F.col("started")).otherwise(c["current"]).alias("current"), c["rate"].alias("rate"), c["half"].alias("half"), (c["least"] * F.col("budget")).alias("low"), (c["most"] * F.col("budget")).alias("high")))
    )
    total = lambda f: F.aggregate("c", F.lit(0.0), lambda t, c: t + f(c))
    slack = 1e-9 * F.col("budget")
    one = one.withColumn("solvable", (F.col("budget") > 0) & (total(lambda c: c["low"]) <= F.col("budget") + slack) & (total(lambda c: c["high"]) >= F.col("budget") - slack))
    # Prices between the first money of the best channel and the last of the worst: at the one all are low, at the other all high.
    top = F.array_max(F.transform("c", lambda c: c["rate"]))
    bottom = F.array_min(F.transform("c", lambda c: c["rate"] * F.pow(c["half"] / (c["half"] + c["high"]), 2)))
    step = lambda s, _: F.when(spent(F.col("c"), F.sqrt(s["a"] * s["b"])) > F.col("budget"), F.struct(F.sqrt(s["a"] * s["b"]).alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), F.sqrt(s["a"] * s["b"]).alias("b")))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(bottom.alias("a"), top.alias("b")), step)
    one = one.withColumn("price", F.when(F.col("solvable"), found["b"]))
    each = one.select(*by, "scenario", "budget", "now", "price", F.size("c").alias("n"), F.explode("c").alias("c"))
    share = F.when(F.col("now") > 0, F.col("c.current") / F.col("now")).otherwise(1 / F.col("n"))
    best = F.when(F.col("price").isNotNull(), at_price(F.col("c"), F.col("price"))).otherwise(F.col("budget") * share)
    out = each.select(*by, "scenario", "c.channel", "c.current", best.alias("optimised"), F.col("c.rate").alias("rate"), F.col("c.half").alias("half"), F.when(F.col("price").isNotNull(), "optimal").otherwise("fallback").alias("status"))
    return out.select(
        *by, "scenario", "channel", "current", "optimised", (F.col("optimised") - F.col("current")).alias("change"), (100 * F.try_divide(F.col("optimised") - F.col("current"), F.when(F.col("current") != 0, F.col("current")))).alias("pct_change"),
        revenue(F.col("current"), F.col("rate"), F.col("half")).alias("revenue_now"), revenue(F.col("optimised"), F.col("rate"), F.col("half")).alias("revenue_best"), "status",
    )


def uniform(*parts: Column) -> Column:
    """A number between 0 and 1 that only depends on ``parts``: draws come out alike however the rows are dealt to tasks."""
    digest = F.md5(F.concat_ws("/", *(p.cast("string") for p in parts)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(2**32)


def normal(*parts: Column) -> Column:
    return F.sqrt(-2 * F.ln(uniform(*parts, F.lit("a")))) * F.cos(2 * math.pi * uniform(*parts, F.lit("b")))


def noisy(rows: DataFrame, draws: int, seed: int = 0, spread: float = NOISE) -> DataFrame:
    """``rows`` (scenario, channel, ...) once for each draw, with the factor that the draw puts on the channel's return."""
    drawn = rows.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    return drawn.withColumn("noise", F.greatest(1 + spread * normal(F.lit(seed), F.col("scenario"), F.col("channel"), F.col("draw")), F.lit(LEFT)))


def robust(curves: DataFrame, scenarios: DataFrame, by: list[str], draws: int = 100, adjustments: DataFrame | None = None) -> DataFrame:
    """Allocation for the mean of the draws -> by, scenario, mean, std, low and high (5th and 95th percentile) of the return on
    spend, and the return without noise."""
    names = scenarios.select("scenario").join(curves.select("channel").distinct())  # a row a scenario and channel
    mean = noisy(names, draws).groupBy("scenario", "channel").agg(F.avg("noise").alias("mean_noise"))
    plans = allocate_each(curves, scenarios, by, mean, adjustments)
    drawn = noisy(plans, draws).groupBy(*by, "scenario", "draw").agg((F.sum(F.col("noise") * F.col("revenue")) / F.sum("optimised")).alias("roas"), (F.sum("revenue") / F.sum("optimised")).alias("plain"))
    return drawn.groupBy(*by, "scenario").agg(F.avg("roas").alias("mean"), F.stddev_samp("roas").alias("std"), F.percentile("roas", 0.05).alias("low"), F.percentile("roas", 0.95).alias("high"), F.max("plain").alias("plain"))


def allocate_each(curves: DataFrame, scenarios: DataFrame, by: list[str], mean: DataFrame, adjustments: DataFrame | None) -> DataFrame:
    """by, scenario, channel, optimised and revenue without noise, where a scenario's rates are those of its draws' mean."""
    names = [r.scenario for r in scenarios.select("scenario").collect()]  # a few
    out = None
    for name in names:
        own = curves.join(F.broadcast(mean.where(F.col("scenario") == name).drop("scenario")), "channel").withColumn("rate", F.col("rate") * F.col("mean_noise")).drop("mean_noise")
        plan = allocate(own, scenarios.where(F.col("scenario") == name), by, adjustments)
        out = plan if out is None else out.unionByName(plan)
    plain = curves.select(*by, "channel", "rate", "half")
    return out.select(*by, "scenario", "channel", "optimised").join(plain, [*by, "channel"]).withColumn("revenue", revenue(F.col("optimised"), F.col("rate"), F.col("half"))).drop("rate", "half")
