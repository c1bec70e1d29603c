"""Queries over panel and touch tables: sources, quality, cleaning, attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from mixwright.functions.windows import Series
from mixwright.operators import attribution, cleaning, quality, selection
from mixwright.plans.media_queries import ALL, KEYS, K, ORD, S, W, sql
from mixwright.plans.registry import OFF_TIES, Registry, r, rounded
from mixwright.sources.panel import CHANNELS, DAILY_SQL, MACRO_SQL, PANEL_SQL, SPEND, TOUCH_SQL, brand_daily, conversions, macro, panel, read, touches

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
NAMES = ["revenue", *SPEND]
LONG = "long as (select date_day, brand, region, unnest([" + ", ".join(f"'{c}'" for c in NAMES) + "]) \"column\", unnest([" + ", ".join(NAMES) + "]) v from panel)"


@register(f"with {PANEL_SQL} select date_day, brand, region, {r('revenue', 'revenue')}, volume, " + ", ".join(r(c, c) for c in SPEND) + " from panel")
def panel_brand_region(spark, sf_dir):
    return rounded(panel(spark, sf_dir).select("date_day", "brand", "region", "revenue", "volume", *SPEND))


@register(f"with {PANEL_SQL} select date_day, brand, region, {r('revenue', 'revenue')} from panel where date_day >= (select max(date_day) from panel) - 84")
def slice_last_12_weeks(spark, sf_dir):
    return rounded(cleaning.latest(panel(spark, sf_dir), "date_day", 84).select("date_day", "brand", "region", "revenue"))


@register(f"with {PANEL_SQL}, d as (select date_day, count(*) n, sum(revenue) rv, sum({' + '.join(SPEND)}) sp from panel group by 1) select sum(n)::bigint n_rows, min(date_day) first_day, max(date_day) last_day, {r('sum(rv)', 'revenue', 2)}, {r('avg(rv)', 'mean_day')}, {r('sum(sp)', 'spend', 2)} from d")
def data_summary(spark, sf_dir):
    return quality.summary(panel(spark, sf_dir), "date_day", "revenue", SPEND).withColumns({"revenue": F.round("revenue", 2), "mean_day": F.round("mean_day", 4), "spend": F.round("spend", 2)})


@register(f"with {MACRO_SQL} select * from macro")
def macro_monthly(spark, sf_dir):
    return macro(spark, sf_dir)


@register(f"with {PANEL_SQL}, {LONG} select \"column\", count(*) n_rows, {r('100.0 * avg(case when v is null then 1.0 else 0 end)', 'null_pct')}, {r('100.0 * avg(case when v is null then null when v = 0 then 1.0 else 0 end)', 'zero_pct')} from long group by 1")
def dq_missing(spark, sf_dir):
    return rounded(quality.missing(panel(spark, sf_dir), NAMES))


@register("with g as (select cast(o_orderdate as date) d, o_custkey, count(*) n from orders group by 1, 2) select sum(n)::bigint n_rows, sum(case when n > 1 then n else 0 end)::bigint in_groups, count(case when n > 1 then 1 end) n_groups, sum(n - 1)::bigint surplus from g")
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), "o_custkey"), ["d", "o_custkey"])


@register(f"with {PANEL_SQL}, {LONG}, b as (select \"column\", quantile_cont(v, 0.01) lo, quantile_cont(v, 0.99) hi from long group by 1) select \"column\", {r('any_value(lo)', 'low')}, {r('any_value(hi)', 'high')}, count(case when v < lo or v > hi then 1 end) outside from long join b using (\"column\") group by 1")
def dq_outliers(spark, sf_dir):
    return rounded(quality.outliers(panel(spark, sf_dir), NAMES))


_CHANGE = f"case when lag(search_spend) over {ORD} <> 0 then (search_spend - lag(search_spend) over {ORD}) / lag(search_spend) over {ORD} end"


@register(sql(f", f as (select {K}, revenue < quantile_cont(revenue, 0.1) over {ALL} outage, search_spend > 2 * quantile_cont(search_spend, 0.95) over {ALL} spike, coalesce({_CHANGE} > 2 and search_spend > 1.5 * (case when count(search_spend) over {W(-6)} >= 7 then avg(search_spend) over {W(-6)} end), false) launch from daily) select * from f where outage or spike or launch").replace(" , f as", ", f as"))
def dq_anomalies(spark, sf_dir):
    return quality.anomalies(brand_daily(spark, sf_dir), S, "revenue", "search_spend")


@register(f"with {PANEL_SQL} select brand, region, count(distinct date_day) as days, date_diff('day', min(date_day), max(date_day)) + 1 span, {r('count(distinct date_day)::double / (date_diff(' + chr(39) + 'day' + chr(39) + ', min(date_day), max(date_day)) + 1)', 'share')} from panel group by 1, 2")
def dq_completeness(spark, sf_dir):
    return rounded(quality.completeness(panel(spark, sf_dir), ["brand", "region"], "date_day"))


@register(f"with {PANEL_SQL}, w as (select brand, region, count(distinct date_trunc('week', date_day)) as weeks from panel group by 1, 2) select *, case when weeks >= 104 then 'good' when weeks >= 52 then 'enough' else 'poor' end status from w")
def dq_coverage_weeks(spark, sf_dir):
    return quality.coverage_weeks(panel(spark, sf_dir), ["brand", "region"], "date_day")


@register(f"with {PANEL_SQL}, {LONG}, z as (select \"column\", coalesce(v, 0) v from long), b as (select \"column\", quantile_cont(v, 0.05) q from z group by 1) select \"column\" channel, {r('100.0 * avg(case when v <= 1e-9 then 1.0 else 0 end)', 'zero_pct')}, {r('100.0 * avg(case when v <= q then 1.0 else 0 end)', 'near_zero_pct')}, {r('stddev_samp(v) / avg(v)', 'variation')}, {r('min(v)', 'least')}, {r('max(v)', 'most')}, {r('avg(v)', 'mean')} from z join b using (\"column\") where \"column\" <> 'revenue' group by 1")
def dq_identifiability(spark, sf_dir):
    return rounded(quality.identifiability(panel(spark, sf_dir), SPEND))


@register(f"with {PANEL_SQL} " + " union all ".join(f"select '{a}' a, '{b}' b, round(corr({a}, {b}), 6) + 0.0 as corr from panel" for i, a in enumerate(SPEND) for b in SPEND[i + 1 :]))
def dq_corr_pairs(spark, sf_dir):
    return rounded(quality.correlated_pairs(panel(spark, sf_dir), SPEND), 6)


_UNIT = " union all ".join(f"select '{c}' channel, {c}_spend s, {c}_impressions i, {c}_clicks k from panel" for c in CHANNELS)


@register(f"with {PANEL_SQL}, u as ({_UNIT}), t as (select channel, sum(s) / (sum(i) / 1000) cpm, sum(s) / sum(k) cpc from u group by 1) select channel, {r('any_value(cpm)', 'cpm', 2)}, {r('any_value(cpc)', 'cpc', 2)}, count(case when i > 0 and abs(s / (i / 1000) - cpm) > 0.15 * cpm then 1 end) off_days from u join t using (channel) group by 1")
def dq_value_sanity_cpm_cpc(spark, sf_dir):
    return rounded(quality.unit_costs(panel(spark, sf_dir), list(CHANNELS)), 2)


@register("with w as (select p, string_split_regex(lower(p), '[^a-z0-9]+') ws from (select distinct p_name || ' ' || p_type p from part)), j as (select x.p a, y.p b, len(list_intersect(x.ws, y.ws))::double / len(list_distinct(x.ws || y.ws)) jaccard from w x join w y on x.p < y.p) select a, b, round(jaccard, 4) jaccard from j where jaccard >= 0.5")
def dq_name_similarity(spark, sf_dir):
    return rounded(quality.similar_names(read(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("p")), "p", 0.5))


SHARES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


@register("with l as (select l_returnflag, l_linestatus, unnest(['price', 'quantity']) \"column\", unnest([l_extendedprice, l_quantity]) v from lineitem) " + " union all ".join(f"select l_returnflag, l_linestatus, \"column\", {s}::double share, {r(f'quantile_cont(v, {s})', 'value')} from l group by 1, 2, 3" for s in SHARES))
def dq_percentiles(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))
    return rounded(selection.percentiles(quality.long(rows, ["l_returnflag", "l_linestatus"], ["price", "quantity"], "column"), ["l_returnflag", "l_linestatus", "column"], "value", SHARES))


@register(f"with {PANEL_SQL}, d as (select date_day, sum(revenue) rv, sum({' + '.join(SPEND)}) s, count(case when revenue < 0 then 1 end) n from panel group by 1) select sum(n)::bigint negative_rows, count(case when rv = 0 then 1 end) zero_days, {r('min(rv)', 'least')}, {r('max(rv)', 'most')}, {r('sum(rv) / sum(s)', 'roi')} from d")
def dq_business_rules(spark, sf_dir):
    return rounded(quality.business_rules(panel(spark, sf_dir), "date_day", "revenue", SPEND))


@register("with l as (select unnest(['c_acctbal', 'c_nationkey']) \"column\", unnest([c_acctbal, c_nationkey::double]) v from customer) select \"column\", greatest(100 - 50.0::double * avg(case when v is null then 1.0 else 0 end) - case when count(case when v < 0 then 1 end) > 0 then 20 else 0 end - case when coalesce(var_samp(v), 0) = 0 then 30 else 0 end, 0)::double quality from l group by 1")
def dq_digital_quality(spark, sf_dir):
    return quality.digital_quality(read(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


@register("select c_custkey, least(c_acctbal, 0) returns, (c_acctbal < 0)::int has_returns, greatest(c_acctbal, 0) c_acctbal from customer")
def clean_negatives(spark, sf_dir):
    return cleaning.negatives(read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "returns", "has_returns")


_EXEMPT = f"coalesce(search_spend > 3 * avg(search_spend) over {W(-3)}, false)"
_CAPPED = f"e as (select {K}, search_spend, month(date_day) m, {_EXEMPT} exempt from daily), c as (select *, quantile_cont(case when not exempt then search_spend end, 0.99) over (partition by brand, m) cap from e)"


@register(sql(f", {_CAPPED} select {K}, exempt, {r('cap', 'cap')}, {r('case when not exempt and search_spend > cap then cap else search_spend end', 'capped')} from c").replace(" , e as", ", e as"))
def clean_winsorize_month(spark, sf_dir):
    rows = cleaning.exempt(brand_daily(spark, sf_dir).select(*KEYS, "search_spend", F.month("date_day").alias("m")), S, "search_spend")
    return rounded(cleaning.winsorized(rows, ["brand", "m"], "search_spend").select(*KEYS, "exempt", "cap", "capped"))


@register(sql(f"select {K}, (search_spend > 0 and search_impressions = 0)::int no_delivery, coalesce({_CHANGE} > 5, false)::int jump from daily"))
def clean_glitch_flags(spark, sf_dir):
    return cleaning.glitches(brand_daily(spark, sf_dir), S, "search_spend", "search_impressions").select(*KEYS, "no_delivery", "jump")


@register("select o_custkey, cast(o_orderdate as date) d, round(sum(o_totalprice), 2) o_totalprice, round(avg(o_orderkey), 4) o_orderkey, arg_max(o_orderpriority, (o_orderdate, o_orderpriority)) o_orderpriority, count(*) n_rows from orders group by 1, 2")
def clean_dedup(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    out = cleaning.deduplicated(rows, ["o_custkey", "d"], ["o_totalprice"], ["o_orderkey"], "o_orderdate", ["o_orderpriority"])
    return out.withColumns({"o_totalprice": F.round("o_totalprice", 2), "o_orderkey": F.round("o_orderkey", 4)})


@register(sql(f", g as (select {K}, nullif(search_spend, 0) s, search_impressions i, volume from daily), h as (select {K}, case when volume % 4 = 0 then null else s end s, i from g) select {K}, (s is null and coalesce(i, 0) = 0)::int is_pause, (s is null and coalesce(i, 0) <> 0)::int is_gap, {r('coalesce(s, 0)', 'filled')} from h").replace(" , g as", ", g as"))
def clean_pause_impute(spark, sf_dir):
    spend = F.when(F.col("volume") % 4 != 0, F.when(F.col("search_spend") != 0, F.col("search_spend")))
    return rounded(cleaning.paused(brand_daily(spark, sf_dir).withColumn("s", spend), "s", "search_impressions").select(*KEYS, "is_pause", "is_gap", "filled"))


def _attribution_sql(weight: str, seen: float = 1.0) -> str:
    return f"""with {TOUCH_SQL}, j as (select c.conversion_id, c.conversion_value, c.ts cts, t.* exclude (user_id) from conversions c join touches t on c.user_id = t.user_id and t.ts <= c.ts
 and epoch(c.ts) - epoch(t.ts) <= case t.interaction_type when 'click' then 7 * 86400 else 86400 end),
k as (select *, case when interaction_type = 'click' then 0 else 1 end rk from j), p as (select * from (select *, min(rk) over (partition by conversion_id, ts) best from k) where rk = best),
n as (select *, row_number() over (partition by conversion_id order by ts, event_id) place, count(*) over (partition by conversion_id) n, max(ts) over (partition by conversion_id) last_ts, case when interaction_type = 'view' then {seen}::double else 1.0::double end seen from p),
w as (select *, {weight} * seen w from n)"""


_ONE_OF = "select conversion_id, event_id, channel, round(conversion_value * w, 6) credit from w where conversion_value * w > 0"
_SHARED = "select conversion_id, event_id, channel, round(conversion_value * w / sum(w) over (partition by conversion_id), 6) credit from w where conversion_value * w > 0"
_DECAY = "exp(floor((epoch(last_ts) - epoch(ts)) / 86400) * (-0.6931471805599453::double / 7))"
_PLACE = "case when n <= 2 then 1.0::double when place = 1 or place = n then 0.4::double else 0.2::double / greatest(n - 2, 1) * 0.4::double end"


def _credits(spark, sf_dir, model, **settings):
    return attribution.credited(attribution.eligible(touches(spark, sf_dir), conversions(spark, sf_dir)), model, **settings)


def _shown(rows):
    return rounded(rows.select("conversion_id", "event_id", "channel", "credit"), 6)


@register(_attribution_sql("case when place = 1 then 1.0::double else 0 end") + _ONE_OF)
def attr_first(spark, sf_dir):
    return _shown(_credits(spark, sf_dir, "first"))


@register(_attribution_sql("case when place = n then 1.0::double else 0 end") + _ONE_OF)
def attr_last(spark, sf_dir):
    return _shown(_credits(spark, sf_dir, "last"))


@register(_attribution_sql("1.0::double", 0.3) + _SHARED)
def attr_linear(spark, sf_dir):
    return _shown(_credits(spark, sf_dir, "linear", view_weight=0.3))


@register(_attribution_sql(_DECAY) + _SHARED)
def attr_time_decay(spark, sf_dir):
    return _shown(_credits(spark, sf_dir, "time_decay"))


@register(_attribution_sql(_PLACE, 0.3) + _SHARED)
def attr_position(spark, sf_dir):
    return _shown(_credits(spark, sf_dir, "position", view_weight=0.3))


@register(_attribution_sql("1.0::double") + "select conversion_id, event_id, channel, round(conversion_value * w / sum(w) over (partition by conversion_id) * case when n > 1 then greatest(1 - 0.1::double * (n - 1), 0.1) else 1 end, 6) credit from w where conversion_value > 0")
def attr_overlap_penalty(spark, sf_dir):
    return _shown(_credits(spark, sf_dir, "linear", overlap_penalty=0.1))


_CREDIT = "x as (select *, conversion_value * w / sum(w) over (partition by conversion_id) credit from w where conversion_value > 0)"


@register(_attribution_sql("1.0::double") + f", {_CREDIT} select cast(cts as date) \"day\", channel, {r('sum(credit)', 'credit')}, count(*) touches, {r('avg(credit)', 'mean_credit')} from x group by 1, 2")
def attr_by_channel_day(spark, sf_dir):
    return rounded(attribution.by_channel_day(_credits(spark, sf_dir, "linear")))


@register(_attribution_sql("1.0::double") + f", {_CREDIT}, e as (select conversion_id, count(*) touches, sum(credit) credit from x group by 1) select count(*) conversions, count(touches) attributed, {r('avg(touches)', 'mean_touches')}, {r('quantile_cont(touches, 0.5)', 'median_touches')}, max(touches) max_touches, {r('avg(case when touches is null then null when touches = 1 then 1.0 else 0 end)', 'single_rate')}, {r('sum(credit) / sum(conversion_value)', 'value_ratio')} from conversions left join e using (conversion_id)")
def attr_metrics(spark, sf_dir):
    return rounded(attribution.metrics(_credits(spark, sf_dir, "linear"), conversions(spark, sf_dir)))


CH = [f"ch{i}" for i in range(5)]


@register(_attribution_sql("1.0::double") + f", {_CREDIT}, y as (select *, cast(date_trunc('week', cts) as date) as week from x), a as (select week, " + ", ".join(f"coalesce(sum(case when channel = '{c}' then credit::decimal(28, 8) end), 0)::double + {OFF_TIES}::double {c}_value" for c in CH) + f" from y group by 1), e as (select week, conversion_id, count(distinct channel) c, sum(credit::decimal(28, 8))::double s from y group by 1, 2), b as (select week, avg(c) mean_channels, max(c) max_channels, avg(s) + {OFF_TIES}::double mean_credit from e group by 1) select week, " + ", ".join(r(f"{c}_value", f"{c}_value") for c in CH) + f", {r('mean_channels', 'mean_channels')}, max_channels, {r('mean_credit', 'mean_credit')} from a full join b using (week)")
def attr_features_weekly(spark, sf_dir):
    out = attribution.weekly_features(_credits(spark, sf_dir, "linear"), CH)
    return rounded(out.withColumns({c: F.col(c) + OFF_TIES for c in (*(f"{c}_value" for c in CH), "mean_credit")}))


@register(_attribution_sql("1.0::double") + f", {_CREDIT} select {r('(select sum(credit) from x) / (select sum(conversion_value) from conversions)', 'conserved')}, {r('(select count(distinct conversion_id) from x)::double / (select count(*) from conversions)', 'covered')}, {r('(select max(c) from (select sum(credit) c from x group by channel)) / (select sum(credit) from x)', 'dominance')}")
def attr_conservation(spark, sf_dir):
    return rounded(attribution.conservation(_credits(spark, sf_dir, "linear"), conversions(spark, sf_dir)))


@register(sql("select date_day, brand, revenue conversion_value, 'conv_' || md5(date_day::varchar || '|' || brand) || '_1' conversion_id, md5(date_day::varchar || '|' || brand) || '_1' user_id, date_day ts from daily"))
def attr_conversion_columns(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select(*KEYS, "revenue")
    return attribution.conversion_columns(rows, list(KEYS)).drop("revenue")


@register(sql(f"select {K}, case when (select sum(search_clicks) from daily) > 0 then 'click' when (select sum(search_impressions) from daily) > 0 then 'impression' else 'unknown' end interaction_type from daily"))
def attr_interaction_type(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select(*KEYS, F.col("search_clicks").alias("clicks"), F.col("search_impressions").alias("impressions"))
    return attribution.interaction_type(rows).drop("clicks", "impressions")


def _fallback_sql(metric: str) -> str:
    return sql(" union all ".join(f"select {K}, '{c}' channel, round({c}_{metric}, 4) credit from daily where {c}_{metric} > 0" for c in CHANNELS))


@register(_fallback_sql("spend"))
def attr_spend_fallback(spark, sf_dir):
    return rounded(attribution.fallback(brand_daily(spark, sf_dir), {c: f"{c}_spend" for c in CHANNELS}, list(KEYS)))


@register(_fallback_sql("impressions"))
def attr_impression_fallback(spark, sf_dir):
    return rounded(attribution.fallback(brand_daily(spark, sf_dir), {c: f"{c}_impressions" for c in CHANNELS}, list(KEYS)))


__all__ = ["QUERIES", "ORACLE", "Series", "DAILY_SQL"]
