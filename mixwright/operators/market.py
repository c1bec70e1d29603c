"""Competition, market, economy and business terms along a series."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.functions.windows import Series, change, rolling, slope

TINY = 1e-8


def efficiency(revenue: Column, spend: Column) -> Column:
    return revenue / (spend + TINY)


def response(eff: Column, number: Column, s: Series) -> dict[str, Column]:
    """How fast efficiency falls over two weeks, and by what part of its monthly median it lies under that."""
    usual = rolling("median", eff, s, 30, 1)
    return {"decline": F.greatest(-F.coalesce(slope(eff, number, s, 14), F.lit(0.0)), F.lit(0.0)), "gap": F.greatest((usual - eff) / (usual + TINY), F.lit(0.0))}


def price_war(order_value: Column, volume: Column, s: Series) -> Column:
    return (F.coalesce((change(order_value, s, 7) < -0.05) & (change(volume, s, 7) > 0.05), F.lit(False))).cast("int")


def timing(d: Column) -> dict[str, Column]:
    first, last = F.month(d).isin(1, 4, 7, 10), F.month(d).isin(3, 6, 9, 12)
    flag = lambda c: c.cast("int")
    return {"month_start": flag(F.day(d) <= 7), "quarter_start": flag(first & (F.day(d) <= 14)), "month_end": flag(F.day(d) >= 25), "quarter_end": flag(last & (F.day(d) >= 20)), "season": season(d)}


def season(d: Column) -> Column:
    """Weight of the shopping season: highest for a week from Thanksgiving, the first Thursday from 22 November on."""
    # Weights and days.
    m, day = F.month(d), F.day(d)
    thursday = F.next_day(F.make_date(F.year(d), F.lit(11), F.lit(21)), "Thu")
    near = F.datediff(d, thursday).between(0, 6)
    return F.when(near, 1.0).when((m == 12) & (day >= 15), 0.8).when((m == 2) & day.between(10, 16), 0.6).when((m == 5) & day.between(8, 14), 0.6).when((m == 8) | ((m == 9) & (day <= 15)), 0.5).when((m == 5) & (day >= 25), 0.4).otherwise(0.0)


def indices(columns: list[str]) -> dict[str, Column]:
    """Concentration, entropy (nats) and the largest share of a row's spend."""
    values = [F.coalesce(F.col(c), F.lit(0.0)) for c in columns]
    total = reduce(Column.__add__, values)
    shares = [F.try_divide(v, F.when(total > 0, total)) for v in values]
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return {
        "total": total, "hhi": zero(reduce(Column.__add__, [x * x for x in shares])),
        "entropy": zero(reduce(Column.__add__, [F.when(x > 0, -x * F.ln(x)).otherwise(0.0) for x in shares])), "top_share": zero(F.greatest(*shares)),
    }


def share_of_voice(own: Column, rivals: Column) -> Column:
    return own / (own + rivals + TINY)


def lifecycle(d: Column, s: Series) -> dict[str, Column]:
    years = F.datediff(d, F.min(d).over(s.whole())) / 365.25
    return {"years": years, "young": (years <= 1).cast("int"), "growing": ((years > 1) & (years <= 3)).cast("int"), "mature": (years > 3).cast("int")}


def wear_out(eff: Column, number: Column, s: Series) -> Column:
    """How fast efficiency falls over a month."""
    return F.greatest(-F.coalesce(slope(eff, number, s, 30), F.lit(0.0)), F.lit(0.0))


def mean_correlations(df: DataFrame, columns: list[str], s: Series, width: int = 30) -> DataFrame:
    """The keys and for each column the mean of its correlations with the others over ``width`` rows; 0 where there is none.

    Sums over the frame are taken once for each column, square and product; all correlations come from them. Values are taken
    less their series' mean first, so that sums of squares lose no digits.
    """
    frame = s.rows(-(width - 1), 0)
    near = df.select(*s.by, s.order, *((F.col(c).cast("double") - F.avg(c).over(s.whole())).alias(c) for c in columns))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = near.select(*s.by, s.order, F.count("*").over(frame).alias("_n"), *(F.sum(c).over(frame).alias(f"_{c}") for c in columns), *(F.sum(F.col(a) * F.col(b)).over(frame).alias(f"_{a}*{b}") for a, b in pairs))
    spread = lambda a, b: F.col(f"_{a}*{b}") - F.col(f"_{a}") * F.col(f"_{b}") / F.col("_n")
    # Variances that rounding leaves where a column is constant in the frame count as none.
    known = lambda a: spread(a, a) > 1e-12 * F.col(f"_{a}*{a}")

    def corr(a: str, b: str) -> Column:
        a, b = (a, b) if (a, b) in pairs else (b, a)
        return F.coalesce(F.when((F.col("_n") >= width) & known(a) & known(b), F.try_divide(spread(a, b), F.sqrt(spread(a, a)) * F.sqrt(spread(b, b)))), F.lit(0.0))

    return sums.select(*s.by, s.order, *((reduce(Column.__add__, [corr(c, o) for o in columns if o != c]) / (len(columns) - 1)).alias(c) for c in columns))


def confidence(order_value: Column, volume: Column, spend: Column, number: Column, s: Series) -> dict[str, Column]:
    """Trend of volume, swing of order value, steadiness of spend."""
    return {"volume_trend": slope(volume, number, s, 30), "value_swing": rolling("std", order_value, s, 14), "steadiness": 1 / (rolling("std", spend, s, 14) + TINY)}


def background(d: Column, spend: Column, s: Series) -> dict[str, Column]:
    """A wave of the year, slow growth, and all spend of two weeks before, 0 where there is none."""
    years = F.datediff(d, F.min(d).over(s.whole())) / 365.25
    return {"wave": (F.sin(F.dayofyear(d) * (2 * math.pi) / 365.25) + 1) / 2, "growth": 1 + 0.02 * years, "earlier": F.coalesce(F.lag(spend, 14).over(s.ordered()), F.lit(0.0))}


def scaled(x: Column, training: Column, s: Series) -> Column:
    """``x`` over its largest value of the training rows, where that is above 0."""
    top = F.max(F.when(training, x)).over(s.whole())
    return x / F.when(top > 0, top).otherwise(1.0)


def constrained(columns: dict[str, Column], s: Series, sign: str = "positive", training: Column | None = None) -> dict[str, Column]:
    """Promotion columns kept to one sign (positive, negative or none). Those with intensity in their name are put over their
    largest value of the training rows, or without any are kept between 0 and 1; others keep their scale."""
    keep = {"positive": lambda c: F.greatest(c, F.lit(0.0)), "negative": lambda c: F.least(c, F.lit(0.0)), "none": lambda c: c}[sign]
    out = {n: keep(c) if n.startswith("promo_") else c for n, c in columns.items()}
    unit = lambda c: scaled(c, training, s) if training is not None else F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return {n: unit(c) if "intensity" in n else c for n, c in out.items()}


def stages(x: Column, s: Series) -> dict[str, Column]:
    """Growth, maturity or decline by the change over 30 rows."""
    c = F.coalesce(change(x, s, 30), F.lit(0.0))
    return {"growth": ((c > 0.05) & (c < 0.3)).cast("int"), "maturity": ((c >= -0.02) & (c <= 0.05)).cast("int"), "decline": (c < -0.02).cast("int")}


def shocks(days: DataFrame, day: str, events: DataFrame) -> DataFrame:
    """Events (event_date, magnitude, duration_days) laid over their days, wearing off exponentially. Events turn to days, so
    the join is one of equal days."""
    spread = events.withColumn(day, F.explode(F.sequence("event_date", F.date_add("event_date", F.col("duration_days")))))
    effect = F.col("magnitude") * F.exp(-F.datediff(day, "event_date") / (F.col("duration_days") / 3))
    return days.join(spread.select(day, effect.alias("effect")), day, "left").groupBy(*days.columns).agg(F.coalesce(F.sum("effect"), F.lit(0.0)).alias("shock"))


def over_usual(x: Column, s: Series) -> Column:
    """``x`` over the median of the 14 rows before, null until seven of them hold a value."""
    return x / (rolling("median", x, s, 14, 7, before=True) + TINY)


def promotions(revenue: Column, spend: Column, s: Series, threshold: float = 1.3, push: float = 1.5, training: Column | None = None) -> dict[str, Column]:
    """Spikes of revenue over what is usual, told apart by whether all spend rose with them; their height on every row, at most 2
    or over the largest of the training rows."""
    ratio, paid = over_usual(revenue, s), over_usual(spend, s)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    height = F.when(ratio.isNotNull(), F.greatest(ratio - 1, F.lit(0.0)))
    return {"spike": flag(ratio > threshold), "intensity": F.when(height.isNotNull(), F.least(height, F.lit(2.0))) if training is None else scaled(height, training, s), "price_promo": flag((ratio > threshold) & (paid < 1.2)), "media_push": flag((ratio > threshold) & (paid > push))}


def promotion_intensity(revenue: Column, s: Series, training: Column | None = None) -> dict[str, Column]:
    """Growth over a week, height of a spike, swing of the week before. Without training rows all are kept between 0 and 1; with
    them spike and swing are put over their largest value there."""
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    fit = (lambda c: scaled(c, training, s)) if training is not None else unit
    spike = F.greatest(F.coalesce(over_usual(revenue, s), F.lit(1.0)) - 1, F.lit(0.0))
    swing = F.coalesce(rolling("std", revenue, s, 7, 3, before=True), F.lit(0.0))
    return {"growth": unit(F.coalesce(change(revenue, s, 7), F.lit(0.0))), "spike": fit(spike), "swing": fit(swing)}


def ramp(d: Column, start: str, end: str, up: int = 3, down: int = 3) -> Column:
    """Within a campaign: rising over its first days and falling over its last; 0 outside."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = F.least(F.datediff(d, first) / float(max(up, 1)), F.datediff(last, d) / float(max(down, 1)), F.lit(1.0))
    return F.when((d >= first) & (d <= last), F.greatest(inside, F.lit(0.0))).otherwise(0.0)


def campaign(d: Column, name: str, start: str, end: str, discount: float | None = None, budget: float | None = None) -> dict[str, Column]:
    """Whether a campaign runs, its discount and budget where they are known, and its ramp."""
    on = (d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date"))
    name = f"promo_{name.replace(' ', '_').lower()}"
    given = {f"{name}_{part}": F.when(on, float(v)).otherwise(0.0) for part, v in (("intensity", discount), ("budget", budget)) if v is not None}
    return {name: on.cast("int"), **given, f"{name}_ramp": ramp(d, start, end)}


def price_terms(order_value: Column, volume: Column, s: Series) -> dict[str, Column]:
    """Order value against its monthly median, and the elasticity of volume."""
    middle = rolling("median", order_value, s, 30, 1)
    position = F.try_divide(order_value - middle, F.when(middle != 0, middle))
    dv, dp = F.coalesce(change(volume, s), F.lit(0.0)), F.coalesce(change(order_value, s), F.lit(0.0))
    return {"premium": F.greatest(position, F.lit(0.0)), "discount": F.greatest(-position, F.lit(0.0)), "elasticity": F.when(F.abs(dp) > 0.01, F.least(F.greatest(-dv / dp, F.lit(-10.0)), F.lit(10.0))).otherwise(0.0)}


def inventory(weekly_efficiency: Column, d: Column, s: Series) -> dict[str, Column]:
    """Falls and recoveries of a week's mean of volume over spend (a column made before), and the weeks of heavy stock."""
    c = F.coalesce(change(weekly_efficiency, s), F.lit(0.0))
    return {"stockout": F.greatest(-c, F.lit(0.0)), "recovery": F.greatest(c, F.lit(0.0)), "heavy": ((F.month(d) == 11) | ((F.month(d) == 12) & (F.day(d) <= 15))).cast("int")}
