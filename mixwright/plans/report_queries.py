"""Reports as nested documents, read back from the folder they are published in; credit of two sources reconciled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.operators import attribution, budget, reporting
from mixwright.operators.quality import long
from mixwright.plans.budget_queries import BOUNDS, DEFAULT, ROI, _curves, _curves_sql, _moves, _scenarios
from mixwright.plans.feature_queries import sql
from mixwright.plans.registry import Registry, r, rounded
from mixwright.plans.table_queries import _attribution_sql, _credits
from mixwright.sources.panel import CHANNELS, SPEND, brand_daily, conversions, touches
from mixwright.sources.shared import remove, shared_folder

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
D = "date_day"


def _documents(spark, sf_dir) -> DataFrame:
    """A document a brand, from one reading of the daily table."""
    daily = brand_daily(spark, sf_dir)
    spend = long(daily, ["brand"], SPEND, value="spend").withColumn("channel", F.regexp_replace("channel", "_spend$", ""))
    guess = 2 * sum((F.col(c) for c in SPEND[1:]), F.col(SPEND[0]))
    a = F.col("revenue")
    facts = daily.groupBy("brand").agg(
        F.min(D).alias("first_day"), F.max(D).alias("last_day"), F.sum("revenue").alias("revenue"), F.sum(guess / 2).alias("spend"), F.avg(F.abs(a - guess) / F.greatest(F.abs(a), F.lit(1e-8))).alias("mape"),
        (1 - F.sum(F.pow(a - guess, 2)) / (F.var_pop("revenue") * F.count("*"))).alias("r2"), F.lit(0.9).alias("coverage"),
    )
    credit = spend.select("brand", "channel", F.col("spend").alias("credit"))
    insights = reporting.channel_insights(spend, ["brand"], credit, ROI)
    plan = budget.allocate(_curves(spark, sf_dir), _scenarios(spark), ["brand"], _moves(spark))
    return reporting.executive(facts, ["brand"], insights, reporting.moves(plan, ["brand"]), 0.85)


def _published(spark, sf_dir, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` as they come back from their published folder."""
    folder = f"{shared_folder(spark)}/reports-{spark.sparkContext.applicationId}"
    path = reporting.publish(spark, {name: rows}, folder, name)
    back = spark.read.schema(rows.schema).json(f"{path}/{name}")
    out = spark.createDataFrame(back.collect(), rows.schema)  # a document a brand
    remove(spark, path)
    return out


_LONG = " union all ".join(f"select brand, '{c}' channel, {c}_spend spend from daily" for c in CHANNELS)
_ROI = "case channel " + " ".join(f"when '{c}' then {v}::double" for c, v in ROI.items()) + " else 2.0::double end"
_INSIGHT = f"lg as ({_LONG}), ins as (select brand, channel, {_ROI} roi, avg(spend / (spend + 1000)) sat, sum(spend) / sum(sum(spend)) over (partition by brand) share from lg group by 1, 2), lev as (select *, case when sat < 0.33 then 'low' when sat < 0.66 then 'medium' else 'high' end level from ins)"
_MOVED = f"{_curves_sql(BOUNDS, DEFAULT)}, ga as (select brand, scenario, 100 * ((sum(rate * half * opt / (half + opt)) / sum(opt)) / (sum(rate * half * cur / (half + cur)) / sum(cur)) - 1) gain from plan group by 1, 2), be as (select brand, arg_max(scenario, (round(gain, 6), scenario)) scenario, arg_max(gain, (round(gain, 6), scenario)) gain from ga group by 1), pc as (select plan.brand, plan.scenario, channel, 100 * (opt - cur) / cur pct, row_number() over (partition by plan.brand order by -abs(100 * (opt - cur) / cur), channel) place from plan join be using (brand, scenario)), mo as (select * from pc where place <= 5 and abs(pct) > 5)"


@register(sql(f"{_INSIGHT}, {_MOVED}", f"select lev.brand, lev.channel, {r('roi', 'roi')}, {r('share', 'share')}, level saturation_level, case when coalesce(pct, 0) > 0 then 'increase' when pct < 0 then 'decrease' else 'keep' end recommendation, {r('pct', 'pct_change', 3)} from lev left join mo on mo.brand = lev.brand and mo.channel = lev.channel"))
def report_dashboard_channels(spark, sf_dir):
    document = _published(spark, sf_dir, "dashboard", reporting.dashboard(_documents(spark, sf_dir), ["brand"], "run"))
    rows = document.select("brand", F.explode("channel_data").alias("c"), F.col("optimization_data.budget_changes").alias("changes"))
    return rounded(rows.select("brand", "c.channel", F.col("c.roi_estimate").alias("roi"), F.col("c.attribution_share").alias("share"), "c.saturation_level", "c.recommendation", F.round(F.element_at("changes", F.col("c.channel")), 3).alias("pct_change")))


_FACTS = f"fa as (select brand, min({D}) first_day, max({D}) last_day, sum(revenue) revenue, sum({' + '.join(SPEND)}) spend, avg(abs(revenue - 2 * ({' + '.join(SPEND)})) / greatest(abs(revenue), 1e-8)) mape, 1 - sum(pow(revenue - 2 * ({' + '.join(SPEND)}), 2)) / (var_pop(revenue) * count(*)) r2 from daily group by 1)"


@register(sql(f"{_INSIGHT}, {_MOVED}, {_FACTS}, hi as (select brand, string_agg(channel, ', ' order by channel) names from lev where roi > 4 group by 1)", f"select brand, first_day, last_day, {r('revenue', 'revenue', 2)}, {r('revenue / spend', 'roi')}, {r('mape', 'mape')}, {r('r2', 'r2')}, mape <= 0.15 and r2 >= 0.7 passes, scenario best_scenario, {r('gain', 'gain_pct', 3)}, (select count(*) from mo where mo.brand = fa.brand) n_moves, concat_ws('; ', case when mape > 0.15 then 'errors exceed their limit' end, case when r2 < 0.7 then 'little of the variation is explained' end, 'high returns: ' || names, case when gain > 10 then 'reallocation pays' end) advice from fa join be using (brand) left join hi using (brand)"))
def report_executive(spark, sf_dir):
    """The executive document of each brand, as published."""
    d = _published(spark, sf_dir, "executive", _documents(spark, sf_dir))
    k = "key_performance_metrics"
    return rounded(
        d.select(
            "brand", "overview.first_day", "overview.last_day", F.round(f"{k}.revenue", 2).alias("revenue"), f"{k}.roi", f"{k}.model_accuracy.mape", f"{k}.model_accuracy.r2", f"{k}.passes", "optimization_insights.best_scenario", F.round("optimization_insights.gain_pct", 3).alias("gain_pct"),
            F.size("optimization_insights.reallocations").cast("long").alias("n_moves"), F.array_join("recommendations", "; ").alias("advice"),
        )
    )


@register(sql("", f"select count(*) n_observations, 5 n_features, 'flat_spend' constant_features, 'control:other_number;media_clicks:search_clicks;media_spend:search_spend;seasonality:trend' features, count(distinct {D}) periods, {r('avg(revenue)', 'mean')}, {r('quantile_cont(revenue, 0.5)', 'median')} from daily"))
def model_metadata(spark, sf_dir):
    rows = brand_daily(spark, sf_dir)
    table = rows.select(D, "revenue", "search_spend", "search_clicks", F.datediff(F.col(D), F.lit("1990-01-01")).alias("trend"), F.lit(1.0).alias("flat_spend"), F.col("volume").alias("other_number"), F.col("brand").alias("promo_note"))
    document = _published(spark, sf_dir, "metadata", reporting.metadata(table, "revenue", D, "run"))
    kinds = F.array_join(F.transform(F.array_sort(F.map_keys("features")), lambda k: F.concat(k, F.lit(":"), F.array_join(F.element_at("features", k), ","))), ";")
    return rounded(document.select("n_observations", "n_features", F.array_join("constant_features", ",").alias("constant_features"), kinds.alias("features"), "date_range.periods", "target_stats.mean", "target_stats.median"))


# Credit as a platform counts it, its last touches, against shares of all touches.
_LAST_TOUCH = "pl as (select channel, cast(date_trunc('month', cts) as date) as month, sum(conversion_value) platform from w where place = n and n % 3 <> 0 group by 1, 2)"
_SHARES = "x as (select *, conversion_value * w / sum(w) over (partition by conversion_id) credit from w where conversion_value > 0 and channel <> 'ch4'), mo as (select channel, cast(date_trunc('month', cts) as date) as month, sum(credit) model from x group by 1, 2)"


@register(_attribution_sql("1.0::double") + f", {_LAST_TOUCH}, {_SHARES}, bo as (select channel, month, coalesce(platform, 0) platform, coalesce(model, 0) model, case when platform is null then 'model only' when model is null then 'platform only' else 'both' end side from pl full join mo using (channel, month)) select channel, month, {r('platform', 'platform')}, {r('model', 'model')}, {r('model - platform', 'difference')}, {r('(model - platform) / nullif(platform, 0)', 'difference_pct')}, side, coalesce(abs((model - platform) / nullif(platform, 0)) < 0.3, platform = 0 and model = 0) within_tolerance from bo")
def eval_platform_compare(spark, sf_dir):
    month = F.to_date(F.date_trunc("month", "conversion_ts")).alias("month")
    last = _credits(spark, sf_dir, "last").where(F.col("n") % 3 != 0).select("channel", month, "credit")
    shares = _credits_without(spark, sf_dir).select("channel", month, "credit")
    return rounded(attribution.reconciled(last, shares, ["channel", "month"]))


def _credits_without(spark, sf_dir) -> DataFrame:
    """Shares of all touches but those of a channel that the model doesn't know."""
    rows = attribution.eligible(touches(spark, sf_dir), conversions(spark, sf_dir))
    return attribution.credited(rows.where("channel <> 'ch4'"), "linear")


@register(_attribution_sql("1.0::double") + "select conversion_id, event_id, channel, round(conversion_value * w / sum(w) over (partition by conversion_id) * case when n > 1 then greatest(exp(-0.4::double * (n - 1)), 0.1) else 1 end, 6) credit from w where conversion_value > 0")
def attr_overlap_exponential(spark, sf_dir):
    return rounded(_credits(spark, sf_dir, "linear", overlap_penalty=0.4, penalty="exponential").select("conversion_id", "event_id", "channel", "credit"), 6)
