"""Merging by column roles, audited cleaning, rules that put rows aside, sanity of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.operators import audit, cleaning, merging, validation
from mixwright.plans.feature_queries import sql
from mixwright.plans.media_queries import KEYS, ORD, K, S
from mixwright.plans.registry import Registry, r, rounded
from mixwright.sources.panel import CHANNELS, PANEL_SQL, SPEND, brand_daily, panel, read
from mixwright.sources.shared import drop, shared_folder, written

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
D = "date_day"

# Deliveries of several shipments a day: spend to add, a rate, strings, a flag, a time.
_DELIVERIES = """deliveries as (select l_suppkey supplier, cast(date_trunc('week', l_shipdate) as date) ship_week, l_extendedprice * l_discount media_spend, l_quantity media_clicks, l_tax media_ctr, l_returnflag as mode, l_linenumber = 1 first_line,
 l_shipdate ingestion_ts, l_orderkey order_key from lineitem)"""


def _deliveries(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.to_date(F.date_trunc("week", "l_shipdate")).alias("ship_week"), (F.col("l_extendedprice") * F.col("l_discount")).alias("media_spend"), F.col("l_quantity").alias("media_clicks"), F.col("l_tax").alias("media_ctr"),
        F.col("l_returnflag").alias("mode"), (F.col("l_linenumber") == 1).alias("first_line"), F.col("l_shipdate").alias("ingestion_ts"), F.col("l_orderkey").alias("order_key"),
    )


@register(f"with {_DELIVERIES} select supplier, ship_week, {r('sum(media_spend)', 'media_spend')}, {r('sum(media_clicks)', 'media_clicks')}, {r('avg(media_ctr)', 'media_ctr', 6)}, arg_max(mode, (ingestion_ts, mode)) as mode, arg_min(first_line, (ingestion_ts, first_line)) first_line, max(ingestion_ts) ingestion_ts, arg_min(order_key, (ingestion_ts, order_key)) order_key, count(*) n_rows from deliveries group by 1, 2")
def clean_dedup_roles(spark, sf_dir):
    out = merging.merged(_deliveries(spark, sf_dir), ["supplier", "ship_week"]).withColumnRenamed("_rows", "n_rows")
    return rounded(out.withColumn("media_ctr", F.round("media_ctr", 6)), 6).withColumns({"media_spend": F.round("media_spend", 4), "media_clicks": F.round("media_clicks", 4)})


@register(f"with {_DELIVERIES}, n as (select supplier, ship_week, mode, count(*) n from deliveries group by 1, 2, 3), top as (select supplier, ship_week, arg_min(mode, (-n, mode)) as mode from n group by 1, 2) select supplier, ship_week, {r('max(media_spend)', 'media_spend')}, any_value(top.mode) as mode from deliveries join top using (supplier, ship_week) group by 1, 2")
def clean_dedup_mode(spark, sf_dir):
    """Without a time column: the commonest string, and the largest number by settings."""
    rows = _deliveries(spark, sf_dir).select("supplier", "ship_week", "media_spend", "mode")
    return rounded(merging.merged(rows, ["supplier", "ship_week"], merging.Policy("max", "mode")).drop("_rows"))


@register(f"with {_DELIVERIES}, k as (select count(*) n from deliveries group by supplier, ship_week) select sum(n)::bigint rows_before, count(*) rows_after, count(case when n > 1 then 1 end) merged_keys, max(n) most_rows from k")
def clean_dedup_report(spark, sf_dir):
    return merging.report(merging.merged(_deliveries(spark, sf_dir), ["supplier", "ship_week"]))


def _negative(spark, sf_dir) -> DataFrame:
    """Days with refunds: revenue less what accounts owe on the day's eighth part."""
    return brand_daily(spark, sf_dir).withColumn("revenue", F.when(F.col("volume") % 8 == 0, -F.col("revenue")).otherwise(F.col("revenue"))).withColumn("search_spend", F.when(F.col("volume") % 5 != 0, F.col("search_spend")))


_NEGATIVE = f"neg as (select {K}, volume, case when volume % 8 = 0 then -revenue else revenue end revenue, case when volume % 5 <> 0 then search_spend end spend, search_impressions from daily)"


@register(
    sql(
        f"{_NEGATIVE}, ex as (select *, coalesce(spend > 3 * avg(spend) over (partition by brand order by {D} rows between 3 preceding and current row), false) exempt from neg), ca as (select *, quantile_cont(case when not exempt then spend end, 0.95) over (partition by brand, month({D})) cap from ex)",
        "select * from (values "
        + ", ".join(
            f"({i}, '{action}', '{level}', '{metric}', (select {what})::double)"
            for i, action, level, metrics in (
                (1, "read", "standard", (("rows", "count(*) from neg"),)),
                (2, "negative revenue moved", "standard", (("rows", "count(*) from neg"), ("negative", "count(*) from neg where revenue < 0"))),
                (3, "exempt from caps", "detailed", (("rows", "count(*) from neg"), ("exempt", "count(*) from ex where exempt"))),
                (4, "capped", "standard", (("rows", "count(*) from neg"), ("capped", "count(*) from ca where not exempt and spend > cap"))),
                (5, "null spend filled", "standard", (("rows", "count(*) from neg"), ("pauses", "count(*) from neg where spend is null and coalesce(search_impressions, 0) = 0"), ("gaps", "count(*) from neg where spend is null and coalesce(search_impressions, 0) <> 0"))),
            )
            for metric, what in metrics
        )
        + ") t(step, action, level, metric, value)",
    )
)
def clean_audit(spark, sf_dir):
    """Counts of every cleaning step, from the one pass that writes the cleaned table."""
    log = audit.Audit()
    df = log.step(_negative(spark, sf_dir), "read")
    df = log.step(cleaning.negatives(df, "revenue", "returns", "has_returns"), "negative revenue moved", negative=F.sum("has_returns"))
    df = log.step(cleaning.exempt(df, S, "search_spend").withColumn("m", F.month(D)), "exempt from caps", "detailed", exempt=F.count_if("exempt"))
    df = cleaning.winsorized(df, ["brand", "m"], "search_spend", 0.95)
    df = log.step(df, "capped", capped=F.count_if(F.col("capped") != F.col("search_spend")))
    df = df.withColumn("search_spend", F.col("capped"))
    df = log.step(audit.pauses(df, S, "search_spend", "search_impressions"), "null spend filled", pauses=F.sum("is_pause_search_spend"), gaps=F.sum("adstock_continuity_search_spend"))
    drop(written(df))
    return log.rows(spark)


_RULES = [("day_present", f"{D} is not null"), ("day_not_future", f"{D} <= date '2030-01-01'"), ("revenue_not_negative", "revenue >= 0"), ("revenue_not_too_high", "revenue < 1000000"), ("search_spend_not_negative", "coalesce(spend, 0) >= 0")]
_BROKEN = f"{_NEGATIVE}, j as (select *, list_filter([" + ", ".join(f"case when not coalesce({c}, false) then '{n}' end" for n, c in _RULES) + "], lambda x: x is not null) broken from neg)"


def _routed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rules = audit.rules_of(D, "revenue", ["search_spend"], F.lit("2030-01-01").cast("date"), 1e6)
    path = f"{shared_folder(spark)}/routed-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"
    return audit.routed(_negative(spark, sf_dir).select(*KEYS, "revenue", "search_spend"), rules, path)


@register(sql(_BROKEN, f"select {K}, {r('revenue', 'revenue', 2)}, array_to_string(broken, ',') broken from j where len(broken) > 0"))
def dq_quarantine(spark, sf_dir):
    """Rows put aside, with the rules that each breaks."""
    _, bad = _routed(spark, sf_dir)
    return rounded(bad.select(*KEYS, "revenue", F.array_join("broken", ",").alias("broken")), 2)


@register(sql(_BROKEN, f"select unnest({[n for n, _ in _RULES]}) as rule, unnest([" + ", ".join(f"count(case when list_contains(broken, '{n}') then 1 end)" for n, _ in _RULES) + "]) broken, count(case when len(broken) = 0 then 1 end) n_good, count(*) n_rows from j"))
def dq_quarantine_counts(spark, sf_dir):
    good, bad = _routed(spark, sf_dir)
    sizes = good.agg(F.count("*").alias("n_good")).join(bad.agg(F.count("*").alias("n_bad")), how="cross")  # one row each
    return audit.broken_counts(bad, [n for n, _ in _RULES]).join(F.broadcast(sizes), how="cross").select("rule", "broken", "n_good", (F.col("n_good") + F.col("n_bad")).alias("n_rows"))


# Reported costs: those of the brand's month, against what each day implies.
_TOLD = "told as (select *, " + ", ".join(f"sum({c}_spend) over g / nullif(sum({c}_impressions) over g / 1000, 0) {c}_cpm, sum({c}_spend) over g / nullif(sum({c}_clicks) over g, 0) {c}_cpc" for c in CHANNELS) + f" from daily window g as (partition by brand, date_trunc('month', {D})))"
_KINDS = (("cpm", "impressions", 1000), ("cpc", "clicks", 1))


@register(
    sql(
        f"{_TOLD}, k as (" + " union all ".join(f"select '{c}' channel, '{kind}' kind, case when {c}_{unit} > 0 and {c}_spend > 0 then abs(({c}_spend / ({c}_{unit} / {per}::double) - {c}_{kind}) / {c}_{kind}) * 100 end off from told" for c in CHANNELS for kind, unit, per in _KINDS) + ")",
        f"select channel, kind, count(off) n_rows, count(case when off > 15 then 1 end) off_rows, {r('avg(off)', 'mean_off_pct')}, 100 * count(case when off > 15 then 1 end) > 10 * count(off) failed from k group by 1, 2",
    )
)
def dq_reported_costs(spark, sf_dir):
    from pyspark.sql import Window

    month = Window.partitionBy("brand", F.date_trunc("month", D))
    rows = brand_daily(spark, sf_dir)
    told = {f"{c}_{kind}": F.try_divide(F.sum(f"{c}_spend").over(month), F.sum(f"{c}_{unit}").over(month) / per) for c in CHANNELS for kind, unit, per in _KINDS}
    return rounded(audit.reported_costs(rows.withColumns(told), {c: {k: f"{c}_{k}" for k in ("spend", "impressions", "clicks", "cpm", "cpc")} for c in CHANNELS}))


@register(f"with {PANEL_SQL}, m as (" + " union all ".join(f"select '{c}' \"column\", avg({c}) mean from panel" for c in SPEND) + f"), o as (select *, case when mean > 0 then log10(mean) else 0 end magnitude from m) select \"column\", {r('mean', 'mean')}, {r('magnitude', 'magnitude')}, {r('max(magnitude) over () - min(magnitude) over ()', 'spread')}, max(magnitude) over () - min(magnitude) over () <= 3 consistent from o")
def dq_magnitudes(spark, sf_dir):
    return rounded(audit.magnitudes(panel(spark, sf_dir), SPEND))


_VALUES = ["revenue", *SPEND]


@register(
    f"with {PANEL_SQL}, l as (select {D}, brand, region, unnest([" + ", ".join(f"'{c}'" for c in _VALUES) + "]) \"column\", unnest([" + ", ".join(_VALUES) + f"]) v from panel), b as (select \"column\", quantile_cont(v, 0.99) q, count(v) n_rows from l group by 1), o as (select *, row_number() over (partition by \"column\" order by {D}, brand, region) place from l join b using (\"column\") where v > q),"
    f" s as (select \"column\", count(*) n_over, max(v) most, avg(v) mean, string_agg({D}::varchar || ' ' || brand || ' ' || region, '; ' order by place) filter (where place <= 10) first_ from o group by 1)"
    f" select \"column\", n_rows, {r('q', 'threshold')}, coalesce(n_over, 0) n_over, {r('most', 'most')}, {r('mean', 'mean')}, first_ as \"first\" from b left join s using (\"column\")"
)
def dq_outlier_profile(spark, sf_dir):
    out = audit.outlier_profile(panel(spark, sf_dir), [D, "brand", "region"], _VALUES)
    return rounded(out.withColumn("first", F.array_join("first", "; ")))


_METRICS = [f"{c}_{m}" for c in CHANNELS for m in ("clicks", "impressions")]
_CHECKED = f"""p as (select * exclude (search_spend), case when volume % 5 <> 0 then search_spend end search_spend, case when day({D}) = 13 then null else search_clicks end seen_clicks from panel),
q as ({" union all ".join(f"select greatest(100 - 50.0::double * avg(({c} is null)::int) - case when count(case when {c} < 0 then 1 end) > 0 then 20 else 0 end - case when coalesce(var_samp({c}), 0) = 0 then 30 else 0 end, 0) q from p" for c in (*_METRICS, "seen_clicks"))}),
w as (select brand, region, count(distinct date_trunc('week', {D})) n from p group by 1, 2), h as (select count(case when n < 52 then 1 end) short, count(case when n >= 52 and n < 104 then 1 end) fair, count(case when 100 * n / (select count(distinct date_trunc('week', {D})) from p)::double < 98 then 1 end) gaps, count(*) n from w),
z as ({" union all ".join(f"select 100.0::double * avg((coalesce({c}, 0) <= 1e-9)::int) z from p" for c in SPEND)}), c as ({" union all ".join(f"select corr({a}, {b}) c from p" for i, a in enumerate(SPEND) for b in SPEND[i + 1 :])}),
i as (select (select count(case when z < 5 then 1 end) from z) never, (select count(case when z < 10 then 1 end) from z) always_on, (select count(case when abs(c) > 0.9 then 1 end) from c) near),
o as (select max(m) - min(m) spread from ({" union all ".join(f"select case when avg({c}) > 0 then log10(avg({c})) else 0 end m from p" for c in SPEND)})),
n as (select {" + ".join(f"100.0::double * avg(({c} is null)::int)" for c in ("search_spend", "seen_clicks"))} s, 100 * count(distinct {D})::double / (date_diff('day', min({D}), max({D})) + 1) full_ from p),
rows_ as (select 'schema' as "check", false failed, false warned, 0.15 bad, 0.05 fair, 0::double figure union all select 'rules', false, false, 0, 0, 0 union all select 'missing', s / 21 > 20, s / 21 > 10, 0.15, 0.05, s / 21 from n
 union all select 'empty_columns', false, false, 0.1, 0, 0 union all select 'business_rules', false, false, 0, 0, 0 union all select 'completeness', full_ < 80, full_ < 90, 0.1, 0.05, full_ from n union all select 'value_sanity', false, spread > 3, 0.15, 0.05, 0 from o
 union all select 'duplicate_rows', false, false, 0.05, 0, 0 union all select 'keys', false, false, 0.1, 0, 0 union all select 'digital_quality', avg(q) < 75, false, 0.1, 0, avg(q) from q union all select 'coverage', short > 0 or gaps > 0.1 * n, fair > 0, 0.2, 0.05, short from h
 union all select 'identifiability', never > 0 or near > 0, always_on > 0, 0.2, 0.1, always_on from i)"""


@register(f"with {PANEL_SQL}, {_CHECKED} select \"check\", case when failed then 'failed' when warned then 'warning' else 'passed' end status, (case when failed then bad when warned then fair else 0 end)::double penalty, {r('figure', 'figure')} from rows_")
def dq_report(spark, sf_dir):
    """All checks of the panel, where some spend and clicks are missing."""
    rows = panel(spark, sf_dir)
    rows = rows.withColumns({"search_spend": F.when(F.col("volume") % 5 != 0, F.col("search_spend")), "seen_clicks": F.when(F.day(D) != 13, F.col("search_clicks"))})
    metrics = [c for c in _METRICS if c.endswith("clicks")]
    out = validation.report(rows, D, ["brand", "region"], "revenue", SPEND, [*metrics, "seen_clicks"], [c for c in _METRICS if c not in metrics])
    return rounded(out)
