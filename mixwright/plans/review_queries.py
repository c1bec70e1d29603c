"""Reviews of features, lift, credit and score."""

from __future__ import annotations

from pyspark.sql import functions as F

from mixwright.operators import attribution, evaluation, review
from mixwright.plans import model_queries, report_queries
from mixwright.plans.feature_queries import _WORN, TOTAL, _worn, sql
from mixwright.plans.media_queries import ALL, KEYS, ORD, S
from mixwright.plans.registry import Registry, r, rounded
from mixwright.plans.table_queries import _CREDIT, _attribution_sql, _credits
from mixwright.sources.panel import SPEND, brand_daily

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
D = "date_day"

_LONG = " union all ".join(f"select brand, '{c}' channel, revenue y, {c} x from daily" for c in SPEND)


@register(sql(f"l as ({_LONG}), b as (select *, quantile_cont(x, 0.8) over (partition by brand, channel) hi, quantile_cont(x, 0.2) over (partition by brand, channel) lo from l), m as (select brand, channel, avg(case when x >= hi then y end) high, avg(case when x <= lo then y end) low from b group by 1, 2)", f"select brand, channel, {r('high', 'high', 2)}, {r('low', 'low', 2)}, {r('high / nullif(low, 0)', 'ratio')}, coalesce(high > low * 1.1, false) lifts from m"))
def eval_lift(spark, sf_dir):
    """Whether days of much spend bring more, for every channel of every brand."""
    out = review.lift(brand_daily(spark, sf_dir), ["brand"], SPEND, "revenue")
    return out.select("brand", "channel", (F.round("high", 2) + 0.0).alias("high"), (F.round("low", 2) + 0.0).alias("low"), (F.round("ratio", 4) + 0.0).alias("ratio"), "lifts")


_BASE = f"bf as (select *, date_diff('day', min({D}) over {ALL}, {D}) + revenue / 1e6 trend_made, sin(dayofyear({D}) * 2 * pi() / 365.25) seasonal_wave, case when month({D}) = 12 then 1.0::double end holiday_month from daily)"
_SECOND = f"sd as (select brand, trend_made x, trend_made - 2 * lag(trend_made) over {ORD} + lag(trend_made, 2) over {ORD} d from bf), ro as (select avg(q) q from (select stddev_pop(d) / (stddev_pop(x) + 1e-8) q from sd group by brand))"


def _base_row(c: str, rough: str = "null::double") -> str:
    return f"select '{c}' feature, {r(f'var_samp(coalesce({c}, 0))', 'variance')}, {r(f'max(coalesce({c}, 0)) - min(coalesce({c}, 0))', chr(34) + 'range' + chr(34))}, {r(f'100 * avg(({c} is null)::int)', 'missing_pct')}, {r(rough, 'roughness')}, {rough} <= 0.1 smooth from bf"


@register(sql(f"{_BASE}, {_SECOND}", " union all ".join((_base_row("trend_made", "(select q from ro)"), _base_row("seasonal_wave"), _base_row("holiday_month")))))
def eval_baseline_features(spark, sf_dir):
    d = F.col(D)
    rows = brand_daily(spark, sf_dir).select(*KEYS, (F.datediff(d, F.min(d).over(S.whole())) + F.col("revenue") / 1e6).alias("trend_made"), F.sin(F.dayofyear(d) * 2 * F.pi() / 365.25).alias("seasonal_wave"), F.when(F.month(d) == 12, 1.0).alias("holiday_month"))
    return rounded(review.baseline_features(rows, S, ["trend_made", "seasonal_wave", "holiday_month"]))


@register(sql(_WORN + f", n as (select brand, factor, row_number() over {ORD} place from w), g as (select lead(place) over (partition by brand order by place) - place gap from n where factor = 1)", f"select 'factor' feature, {r('avg((factor = 1)::int)', 'fresh_share')}, avg((factor = 1)::int) between 0.1 and 0.3 as \"within\", (select count(*) from g where gap >= 2) stretches, true consistent from n"))
def eval_fatigue_features(spark, sf_dir):
    return rounded(review.fatigue_features(_worn(spark, sf_dir), S, ["factor"]))


@register(sql("sh as (select " + ", ".join(f"{c} / nullif({TOTAL}, 0) {c}_attribution" for c in SPEND) + f", ({TOTAL}) / nullif({TOTAL}, 0) whole_attribution from daily)", " union all ".join(f"select '{c}_attribution' feature, {r(f'avg(coalesce({c}_attribution, 0))', 'mean')}, avg(coalesce({c}_attribution, 0)) between 0.95 and 1.05 as \"within\", {r(f'stddev_samp(coalesce({c}_attribution, 0)) / nullif(avg(coalesce({c}_attribution, 0)), 0)', 'variation')} from sh" for c in (*SPEND, "whole"))))
def eval_attribution_features(spark, sf_dir):
    total = sum((F.col(c) for c in SPEND[1:]), F.col(SPEND[0]))
    rows = brand_daily(spark, sf_dir).withColumn("_t", total).select(*(F.try_divide(F.col(c), F.when(F.col("_t") != 0, F.col("_t"))).alias(f"{n}_attribution") for n, c in (*((c, c) for c in SPEND), ("whole", "_t"))))
    return rounded(review.attribution_features(rows, rows.columns))


@register(
    _attribution_sql("1.0::double", 0.3)
    + f", {_CREDIT}, e as (select conversion_id, channel, sum(credit) credit, max((ts, event_id)) last, sum(case when interaction_type = 'view' then credit else 0 end) views from x group by 1, 2), t as (select *, max(round(credit, 9)) over (partition by conversion_id) = round(credit, 9) most, max(last) over (partition by conversion_id) = last ends from e),"
    f" wk as (select channel, date_trunc('week', cts) wk, sum(credit) c from x group by 1, 2), st as (select channel, 1 / (1 + coalesce(stddev_pop(c) / nullif(avg(c), 0), 0)) stability from wk group by 1) select channel, {r('avg(most::int)', 'primary_share')}, {r('avg((not ends)::int)', 'assisted_share')}, {r('sum(views) / sum(credit)', 'view_share')}, {r('any_value(stability)', 'stability')} from t join st using (channel) group by 1"
)
def report_credit_patterns(spark, sf_dir):
    return rounded(review.credit_patterns(_credits(spark, sf_dir, "linear", view_weight=0.3)))


@register(sql(model_queries._E, f"select count(*) n_rows, {r('avg(a)', 'a_mean', 2)}, {r('stddev_pop(a)', 'a_std', 2)}, {r('min(a)', 'a_least', 2)}, {r('max(a)', 'a_most', 2)}, {r('avg(p)', 'p_mean', 2)}, {r('stddev_pop(p)', 'p_std', 2)}, {r('min(p)', 'p_least', 2)}, {r('max(p)', 'p_most', 2)}, {r('(max(p) - min(p)) / nullif(max(a) - min(a), 0)', 'range_ratio', 2)} from e"))
def eval_model_summary(spark, sf_dir):
    return rounded(review.model_summary(model_queries._guessed(spark, sf_dir), "a", "p"), 2)


_COMPARED = report_queries.ORACLE["eval_platform_compare"]


@register(
    sql(f"{model_queries._CORES}, {model_queries._STEPS}, cmp as ({_COMPARED}), parts as (select (case when mape <= 0.15 then 0.15 else 0 end + case when smape <= 0.15 then 0.15 else 0 end + case when coverage >= 0.8 then 0.1 else 0 end)::double errors, mape, coverage, (select avg(same_direction) from tr) agreement, (select avg(within_tolerance::int) from cmp) tolerated from core)",
        f"select {r('errors', 'errors')}, {r('agreement', 'agreement')}, {r('tolerated', 'tolerated')}, {r('least(errors + 0.3::double * agreement + 0.2::double * coalesce(tolerated, 0) + 0.1::double, 1)', 'score')}, concat_ws('; ', case when mape > 0.15 then 'errors exceed their limit' end, case when coverage < 0.8 then 'too few values within the expected range' end, case when agreement < 0.7 then 'direction of change is often wrong' end, case when tolerated < 1 then 'credit differs from what platforms report' end) advice from parts")
)
def eval_full_score(spark, sf_dir):
    rows = model_queries._guessed(spark, sf_dir)
    month = F.to_date(F.date_trunc("month", "conversion_ts")).alias("month")
    last = _credits(spark, sf_dir, "last").where(F.col("n") % 3 != 0).select("channel", month, "credit")
    compared = attribution.reconciled(last, report_queries._credits_without(spark, sf_dir).select("channel", month, "credit"), ["channel", "month"])
    out = review.overall(evaluation.core_metrics(rows, "a", "p"), evaluation.trend_consistency(rows, S, "a", "p"), compared)
    return rounded(out.withColumn("advice", F.array_join("advice", "; ")))
