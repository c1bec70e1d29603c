"""Budgets over concave curves: bounds by channel, scenarios that move spend, returns under noise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.operators import budget
from mixwright.operators.evaluation import CARRY, SATURATION
from mixwright.operators.quality import long
from mixwright.plans.feature_queries import sql
from mixwright.plans.model_queries import SCENARIOS, values
from mixwright.plans.registry import Registry, r, rounded
from mixwright.sources.panel import CHANNELS, SPEND, brand_daily

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
#: Shares by channel; the rest has the default ones.
BOUNDS = {"search": (0.10, 0.35), "shopping": (0.08, 0.30), "display": (0.03, 0.25), "tiktok": (0.02, 0.15)}
DEFAULT = (0.05, 0.4)
ROI = {"search": 3.0, "shopping": 2.5, "tiktok": 1.5}
#: Of the aggressive scenario: money moves from search to tiktok before the plan is compared with it.
MOVES = [("aggressive", "search", 0.9), ("aggressive", "tiktok", 1.5)]
TIGHT = {c: (0.01, 0.15) for c in CHANNELS}
DRAWS = 60


def _curves(spark, sf_dir, bounds=BOUNDS, default=DEFAULT) -> DataFrame:
    rows = long(brand_daily(spark, sf_dir), ["brand"], SPEND, value="spend").withColumn("channel", F.regexp_replace("channel", "_spend$", ""))
    return budget.bounded(budget.response_curves(rows, ["brand"], ROI), bounds, default)


def _scenarios(spark) -> DataFrame:
    return spark.createDataFrame(SCENARIOS, "scenario string, budget_multiplier double")


def _moves(spark) -> DataFrame:
    return spark.createDataFrame(MOVES, "scenario string, channel string, factor double")


def _case(of: dict, rest: float, at=lambda v: v) -> str:
    return "case channel " + " ".join(f"when '{c}' then {at(v)!r}::double" for c, v in of.items()) + f" else {rest!r}::double end"


def _curves_sql(bounds: dict, default: tuple, noise: str = "1.0::double") -> str:
    """Curves and scenarios; the optimum from the exact solution between two break points, where some channels are on a bound
    and the others share one price."""
    long_ = " union all ".join(f"select brand, '{c}' channel, {c}_spend spend from daily" for c in CHANNELS)
    return f"""l as ({long_}), cu as (select brand, channel, avg(spend) cur, {_case(ROI, 2.0)} * (1 + {_case(CARRY, 0.6)}) rate, greatest({_case(SATURATION, 0.5, lambda v: v[0])} * max(spend), 1) half from l group by brand, channel),
mv as ({values(MOVES, "scenario, channel, factor")}), sc as ({values(SCENARIOS, "scenario, m")}),
c0 as (select brand, scenario, m, channel, cur, cur * coalesce(factor, 1) st, rate, half, greatest({_case(bounds, default[0], lambda v: v[0])}, 0.01) lo, least({_case(bounds, default[1], lambda v: v[1])}, 0.6) hi from cu cross join sc left join mv using (scenario, channel)),
c1 as (select *, sum(cur) over g now, sum(cur) over g * m budget, case when sum(st) over g > 0 then st * sum(cur) over g / sum(st) over g else cur end moved from c0 window g as (partition by brand, scenario)),
c as (select brand, scenario, channel, moved, now, budget, rate * {noise} rate, rate plain, half, lo * budget lo, hi * budget hi, count(*) over (partition by brand, scenario) n from c1),
bp as (select distinct brand, scenario, unnest([rate * pow(half / (half + lo), 2), rate * pow(half / (half + hi), 2)]) p from c),
tot as (select brand, scenario, p, any_value(budget) budget, sum(least(greatest(half * (sqrt(rate / p) - 1), lo), hi)) t from bp join c using (brand, scenario) group by 1, 2, 3),
piece as (select brand, scenario, max(case when t >= budget - 1e-9 * budget then p end) a, min(case when t <= budget + 1e-9 * budget then p end) b from tot group by 1, 2),
mid as (select c.*, a, b, case when half * (sqrt(rate / ((a + b) / 2)) - 1) <= lo then 'l' when half * (sqrt(rate / ((a + b) / 2)) - 1) >= hi then 'h' else 'f' end side from c join piece using (brand, scenario)),
pr as (select brand, scenario, case when sum(lo) > any_value(budget) * (1 + 1e-9) or sum(hi) < any_value(budget) * (1 - 1e-9) or any_value(budget) <= 0 then null
   else (any_value(budget) - sum(case side when 'l' then lo when 'h' then hi else -half end)) / nullif(sum(case side when 'f' then half * sqrt(rate) end), 0) end y,
   sum(lo) > any_value(budget) * (1 + 1e-9) or sum(hi) < any_value(budget) * (1 - 1e-9) or any_value(budget) <= 0 bad from mid group by 1, 2),
plan as (select brand, scenario, channel, moved cur, case when bad then budget * case when now > 0 then moved / now else 1.0::double / n end when side = 'l' then lo when side = 'h' then hi else half * (sqrt(rate) * y - 1) end opt, plain rate, half, case when bad then 'fallback' else 'optimal' end status from mid join pr using (brand, scenario))"""


_PLAN = f"select brand, scenario, channel, {r('cur', chr(34) + 'current' + chr(34), 3)}, {r('opt', 'optimised', 3)}, {r('opt - cur', 'change', 3)}, {r('100 * (opt - cur) / nullif(cur, 0)', 'pct_change', 3)}, {r('rate * half * cur / (half + cur)', 'revenue_now', 3)}, {r('rate * half * opt / (half + opt)', 'revenue_best', 3)}, status from plan"


@register(sql(_curves_sql(BOUNDS, DEFAULT), _PLAN))
def budget_concave(spark, sf_dir):
    return rounded(budget.allocate(_curves(spark, sf_dir), _scenarios(spark), ["brand"], _moves(spark)), 3)


@register(sql(_curves_sql(TIGHT, (0.01, 0.15)), _PLAN))
def budget_concave_fallback(spark, sf_dir):
    """Bounds that leave no allocation: five channels of at most 15 %."""
    return rounded(budget.allocate(_curves(spark, sf_dir, TIGHT), _scenarios(spark), ["brand"], _moves(spark)), 3)


def _uniform_sql(side: str) -> str:
    return f"((('0x' || substr(md5('0/' || scenario || '/' || channel || '/' || draw || '/{side}'), 1, 8))::bigint + 0.5) / 4294967296::double)"


_NOISE = f"greatest(1 + 0.1::double * sqrt(-2 * ln({_uniform_sql('a')})) * cos(2 * pi() * {_uniform_sql('b')}), 0.1)"
_DRAWS = f"dr as (select scenario, channel, draw, {_NOISE} noise from (select unnest([{', '.join(f"'{s}'" for s, _ in SCENARIOS)}]) scenario) cross join (select unnest([{', '.join(f"'{c}'" for c in CHANNELS)}]) channel) cross join (select unnest(range({DRAWS})) draw)), mn as (select scenario, channel, avg(noise) mean_noise from dr group by 1, 2)"
_ROBUST = _curves_sql(BOUNDS, DEFAULT, "(select mean_noise from mn where mn.scenario = c1.scenario and mn.channel = c1.channel)")


@register(sql(f"{_DRAWS}, {_ROBUST}, ro as (select brand, scenario, draw, sum(noise * rate * half * opt / (half + opt)) / sum(opt) roas, sum(rate * half * opt / (half + opt)) / sum(opt) plain from plan join dr using (scenario, channel) group by 1, 2, 3)", f"select brand, scenario, {r('avg(roas)', 'mean')}, {r('stddev_samp(roas)', 'std')}, {r('quantile_cont(roas, 0.05)', 'low')}, {r('quantile_cont(roas, 0.95)', 'high')}, {r('max(plain)', 'plain')} from ro group by 1, 2"))
def budget_robust(spark, sf_dir):
    return rounded(budget.robust(_curves(spark, sf_dir), _scenarios(spark), ["brand"], DRAWS, _moves(spark)))


@register(sql(_DRAWS, f"select scenario, channel, {r('avg(noise)', 'mean', 6)}, {r('stddev_samp(noise)', 'std', 6)}, {r('min(noise)', 'least', 6)}, {r('max(noise)', 'most', 6)} from dr group by 1, 2"))
def budget_noise(spark, sf_dir):
    """The draws on each channel of the brands' curves."""
    channels = _curves(spark, sf_dir).select("channel").distinct()
    rows = budget.noisy(_scenarios(spark).join(channels).select("scenario", "channel"), DRAWS)
    return rounded(rows.groupBy("scenario", "channel").agg(F.avg("noise").alias("mean"), F.stddev_samp("noise").alias("std"), F.min("noise").alias("least"), F.max("noise").alias("most")), 6)
