"""Carry-over (adstock) and saturation of media spend."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from mixwright.functions.windows import Series

#: Where a geometric weight is dropped; shorter cuts show in the fourth decimal.
VANISHING = 1e-18


def geometric(x: Column, s: Series, decay: float) -> Column:
    """y[t] = x[t] + decay * y[t-1], as a fold over the rows that still weigh."""
    if not 0 <= decay < 1:
        raise ValueError("decay must be at least 0 and under 1")
    if decay == 0:
        return F.coalesce(x, F.lit(0.0))
    lags = math.ceil(math.log(VANISHING) / math.log(decay))
    held = F.collect_list(F.coalesce(x, F.lit(0.0))).over(s.rows(-lags, 0))
    return F.aggregate(held, F.lit(0.0), lambda a, v: a * decay + v)


def weibull_kernel(shape: float, scale: float, lags: int, kind: str = "pdf") -> list[float]:
    """1 at lag 0, then Weibull weights of lags 1 to ``lags`` that sum to 1."""
    if shape <= 0 or scale <= 0 or lags < 0:
        raise ValueError("shape and scale must be over 0, lags at least 0")
    below = lambda t: 1 - math.exp(-((t / scale) ** shape))
    density = lambda t: shape / scale * (t / scale) ** (shape - 1) * math.exp(-((t / scale) ** shape))
    weights = [density(t) if kind == "pdf" else below(t) - below(t - 1) for t in range(1, lags + 1)]
    total = sum(weights) or 1.0
    return [1.0, *(w / total for w in weights)]


def weibull(x: Column, s: Series, kernel: list[float], alignment: str = "centered") -> Column:
    """Weighted sum of shifted rows. ``centered`` looks ahead by half the kernel, ``causal`` never does."""
    ahead = (len(kernel) - 1) // 2 if alignment == "centered" else 0
    value = F.coalesce(x, F.lit(0.0))
    return sum((w * F.coalesce(F.lag(value, j - ahead).over(s.ordered()), F.lit(0.0)) for j, w in enumerate(kernel)), F.lit(0.0))


def rescaled(y: Column, x: Column, s: Series, to: str = "sum") -> Column:
    """The carried-over series with the sum, mean or max of the original."""
    if to == "none":
        return y
    of = {"sum": F.sum, "mean": F.avg, "max": F.max}[to]
    mine, theirs = of(y).over(s.whole()), of(x).over(s.whole())
    return F.when(mine == 0, y if to == "max" else x).otherwise(y * F.try_divide(theirs, mine))


def scale(x: Column, s: Series, how: str = "max") -> Column:
    """What a saturation curve takes for full spend: the largest value, or the 95th percentile of those over 0."""
    if how in ("none", "k_in_units"):
        return F.lit(1.0)
    top = F.percentile(F.when(x > 0, x), 0.95) if how == "p95" else F.max(x)
    value = top.over(s.whole())
    return F.when(value > 0, value).otherwise(1.0)


def hill(x: Column, s: Series, k: float, power: float, how: str = "max") -> Column:
    """x^s / (k^s + x^s) on the scaled series. k is scaled too, unless ``k_in_units`` says that it is in units of spend."""
    size = scale(x, s, how)
    v = F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)) / size
    half = F.abs(F.lit(float(k)) / size)
    y = F.pow(v, power) / (F.pow(half, power) + F.pow(v, power) + 1e-12)
    return F.when(F.max(F.abs(x)).over(s.whole()) > 0, F.when(F.isnan(y), 0.0).otherwise(y)).otherwise(0.0)


def logistic(x: Column, s: Series, k: float, x0: float, how: str = "max") -> Column:
    z = F.greatest(F.least(F.lit(float(k)) * (x / scale(x, s, how) - x0), F.lit(60.0)), F.lit(-60.0))
    return F.when(F.max(F.abs(x)).over(s.whole()) > 0, 1.0 / (1.0 + F.exp(-z))).otherwise(0.0)


def adstock_hill(y: Column, alpha: float = 0.5, gamma: float = 1.0) -> Column:
    return F.pow(y, alpha) / (F.pow(F.lit(gamma), alpha) + F.pow(y, alpha))
