"""Queries on the whole: column roles, checks, feature matrix, fit, evaluation, budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.functions import media
from mixwright.functions.windows import Series
from mixwright.operators import cleaning, evaluation, matrix, quality
from mixwright.plans.feature_queries import TOTAL, sql, total
from mixwright.plans.media_queries import DAYS, KEYS, ORD, ROWN, K, S, days, frame
from mixwright.plans.registry import Registry, r, rounded
from mixwright.sources.panel import CHANNELS, PANEL_SQL, SPEND, brand_daily, panel, read

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
D = "date_day"


def values(rows: list[tuple], names: str) -> str:
    cell = lambda v: "null" if v is None else repr(v) if isinstance(v, str) else f"{v}::double" if isinstance(v, float) else str(v)
    return "select * from (values " + ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows) + f") t({names})"


# Columns, checks, cleaning.
ROLES = matrix.Roles("DATE_DAY", "brand", "region", "Revenue", tuple((c, f"{c}_SPEND") for c in CHANNELS))
_FOUND = {"day": [D], "brand": ["brand"], "region": ["region"], "revenue": ["revenue"], "spend": SPEND, "impression": [f"{c}_impressions" for c in CHANNELS], "click": [f"{c}_clicks" for c in CHANNELS]}


@register(values([(k, c) for k, names in _FOUND.items() for c in names], 'role, "column"'))
def column_roles(spark, sf_dir):
    rows = panel(spark, sf_dir)
    return matrix.as_rows(spark, ROLES.resolve(rows.toDF(*(f" {c.upper()}" for c in rows.columns)))[1])


_FEATURES = ["search_spend", "search_clicks", "tiktok_impressions", "search_adstocked", "search_saturated", "sin_year_1", "trend", "external_strike", "labor_day", "creative_age", "competitor_price", "tiktok_adjustments", "price"]
_KINDS = ["media_spend", "media_clicks", "media_impressions", "adstock", "saturation", "seasonality", "seasonality", "baseline", "holidays", "creative", "competitors", "adjustments", "control"]


@register(values(list(zip(_FEATURES, _KINDS, strict=True)), "feature, category"))
def feature_categories(spark, sf_dir):
    return spark.createDataFrame([(f, matrix.category(f)) for f in _FEATURES], "feature string, category string")


_WANTED = {"o_orderkey": "bigint", "o_orderpriority": "string", "o_discount": "double", "o_totalprice": "string"}


@register(values([("o_discount", "double", None, "missing"), ("o_totalprice", "string", "double", "type")], '"column", wanted, found, difference'))
def dq_schema(spark, sf_dir):
    return spark.createDataFrame(matrix.schema_differences(read(spark, sf_dir, "orders"), _WANTED), "`column` string, wanted string, found string, difference string")


@register(sql("", f"select unnest(['day_known', 'revenue_in_range', 'spend_not_negative', 'clicks_with_spend']) as rule, unnest([count(case when not coalesce({D} <= date '2030-01-01', false) then 1 end), count(case when not coalesce(revenue >= 0 and revenue < 1e9, false) then 1 end), count(case when not coalesce({TOTAL} >= 0, false) then 1 end), count(case when not coalesce(search_clicks > 0 or search_spend = 0, false) then 1 end)]) broken from daily"))
def dq_rules(spark, sf_dir):
    x = F.col
    rules = {"day_known": x(D) <= F.lit("2030-01-01").cast("date"), "revenue_in_range": (x("revenue") >= 0) & (x("revenue") < 1e9), "spend_not_negative": total() >= 0, "clicks_with_spend": (x("search_clicks") > 0) | (x("search_spend") == 0)}
    return matrix.broken_rules(brand_daily(spark, sf_dir), rules)


_GAPS = f"{DAYS}, g as (select date_diff('day', lag(d) over (order by d), d) gap from days), c as (select gap, count(*) n from g where gap is not null group by 1)"


@register(f"with {_GAPS}, t as (select gap from c order by n desc, gap limit 1) select gap::int gap, case when gap between 1 and 2 then 'daily' else 'weekly' end cadence, case when gap between 1 and 2 then 7 else 4 end \"window\" from t")
def dq_cadence(spark, sf_dir):
    return matrix.cadence(days(spark, sf_dir), "d").withColumn("gap", F.col("gap").cast("int"))


@register(f"with {_GAPS}, m as (select quantile_cont(gap, 0.5) median_gap from g) select median_gap::double median_gap, case when median_gap = 1 then 'daily' when median_gap = 7 then 'weekly' when median_gap between 28 and 31 then 'monthly' else median_gap::int || 'D' end frequency from m")
def dq_frequency(spark, sf_dir):
    return matrix.frequency(days(spark, sf_dir), "d")


@register(f"with {DAYS}, c as (select unnest(generate_series(min(d), max(d), interval 1 day))::date d from days) select d from c anti join days using (d)")
def dq_missing_days(spark, sf_dir):
    return matrix.missing_days(days(spark, sf_dir), "d")


@register(
    f"""with {PANEL_SQL}, dup as (select sum(n - 1) * 100.0 / sum(n) x from (select o_custkey, cast(o_orderdate as date), count(*) n from orders group by 1, 2)),
com as (select 100.0 * count(distinct {D}) / (date_diff('day', min({D}), max({D})) + 1) x from panel), cov as (select avg((weeks < 52)::int) x from (select brand, region, count(distinct date_trunc('week', {D})) as weeks from panel group by 1, 2)),
allon as (select min(z) x from (select avg((search_spend <= 1e-9)::int) z from panel union all select avg((tiktok_spend <= 1e-9)::int) from panel)),
checks as (select 'duplicates' c, x > 5 failed, 0.05::double penalty from dup union all select 'completeness', x < 80, 0.1 from com union all select 'coverage', x > 0.1, 0.2 from cov union all select 'always_on', x = 0, 0.1 from allon),
s as (select greatest(1 - coalesce(sum(case when failed then penalty end), 0), 0) score from checks)
select {r('score', 'score')}, case when round(score, 6) < 0.8 then 'failed' when round(score, 6) < 0.9 then 'warning' else 'passed' end status from s"""
)
def dq_score(spark, sf_dir):
    rows = panel(spark, sf_dir)
    dup = quality.duplicates(read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), "o_custkey"), ["d", "o_custkey"])
    one = lambda df, name, failed, penalty: df.select(F.lit(name).alias("check"), failed.alias("failed"), F.lit(penalty).alias("penalty"))
    whole = rows.agg((100 * F.count_distinct(D) / (F.datediff(F.max(D), F.min(D)) + 1)).alias("x"))
    cover = quality.coverage_weeks(rows, ["brand", "region"], D).agg(F.avg((F.col("weeks") < 52).cast("int")).alias("x"))
    zero = quality.identifiability(rows, ["search_spend", "tiktok_spend"]).agg(F.min("zero_pct").alias("x"))
    checks = [one(dup, "duplicates", 100 * F.col("surplus") / F.col("n_rows") > 5, 0.05), one(whole, "completeness", F.col("x") < 80, 0.1), one(cover, "coverage", F.col("x") > 0.1, 0.2), one(zero, "always_on", F.col("x") == 0, 0.1)]
    return rounded(matrix.score(checks[0].unionByName(checks[1]).unionByName(checks[2]).unionByName(checks[3])))


@register("select c_custkey, greatest(c_acctbal, 0) c_acctbal, (c_acctbal < 0)::int had_negative_c_acctbal from customer")
def clean_telemetry(spark, sf_dir):
    return cleaning.clipped(read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


@register(sql("", f"select {K}, revenue from daily where volume % 5 <> 0"))
def clean_outcome_nulls(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select(*KEYS, F.when(F.col("volume") % 5 != 0, F.col("revenue")).alias("revenue"))
    return cleaning.with_outcome(rows, "revenue")


@register("select count(*) n_rows, sum(('0x' || substr(md5(concat_ws('|', o_orderkey::varchar, o_custkey::varchar, o_orderpriority)), 1, 8))::bigint)::bigint fingerprint from orders")
def clean_lineage(spark, sf_dir):
    return cleaning.fingerprint(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"))


# Feature matrix and fit.
_N = f"n as (select {K}, revenue, search_spend x, tiktok_spend z, {ROWN} rn from daily)"
_GEO = "geo as (select a.date_day, a.brand, a.revenue, sum(b.x * power(0.5::double, a.rn - b.rn)) y, sum(b.z * power(0.5::double, a.rn - b.rn)) w from n a join n b on a.brand = b.brand and b.rn between a.rn - 60 and a.rn group by all)"


@register(
    sql(
        f"{_N}, {_GEO}",
        f"select {K}, {r('revenue', 'y')}, {r('y / (y + 1000)', 'search_adstocked_saturated')}, {r('w / (w + 1000)', 'tiktok_adstocked_saturated')}, {r(f'sin(2 * pi() * dayofyear({D}) / 365.25)', 'sin_year_1')}, {r(f'cos(2 * pi() * dayofyear({D}) / 365.25)', 'cos_year_1')}, (isodow({D}) >= 6)::int is_weekend, date_diff('day', min({D}) over (partition by brand), {D})::int as trend from geo",
    )
)
def model_matrix(spark, sf_dir):
    return rounded(_matrix(spark, sf_dir))


def _matrix(spark, sf_dir) -> DataFrame:
    from mixwright.functions import calendar

    rows = brand_daily(spark, sf_dir).select(*KEYS, F.col("revenue").alias("y"), *(media.geometric(F.col(f"{c}_spend"), S, 0.5).alias(c) for c in ("search", "tiktok")))
    waves = calendar.fourier(F.col(D), 1)
    return rows.select(
        *KEYS, "y", *((F.col(c) / (F.col(c) + 1000)).alias(f"{c}_adstocked_saturated") for c in ("search", "tiktok")), waves["sin_year_1"].alias("sin_year_1"), waves["cos_year_1"].alias("cos_year_1"),
        (F.weekday(D) >= 5).cast("int").alias("is_weekend"), F.datediff(D, F.min(D).over(S.whole())).alias("trend"),
    )


@register(sql("", f"select count(*) n_days, {r('avg(revenue)', 'mean')}, {r('stddev_samp(revenue)', 'std', 2)}, min(revenue) least, max(revenue) most, {r('quantile_cont(revenue, 0.25)', 'q25')}, {r('quantile_cont(revenue, 0.5)', 'median')}, {r('quantile_cont(revenue, 0.75)', 'q75')}, count(case when revenue = 0 then 1 end) zeros, count(case when revenue is null then 1 end) nulls from daily"))
def model_target_stats(spark, sf_dir):
    rows = brand_daily(spark, sf_dir)
    return rounded(evaluation.target_stats(rows, "revenue").join(F.broadcast(rows.agg(F.count("*").alias("n_days"))), how="cross").withColumn("std", F.round("std", 2)))  # one row each


#: The posterior's mode of one coefficient, as the same fixed point in SQL.
_FIT = f"""rows_ as (select {K}, search_spend / 1000 x, ln(greatest(revenue, 1e-6)) y from daily), g as (select count(*)::double n, sum(x) sx, sum(x * x) sxx, sum(y) sy, sum(x * y) sxy, sum(y * y) syy from rows_),
it as (select 0 i, 1::double s2, 0::double w0, 0::double w1 union all
 select i + 1, greatest((syy - 2 * (v0 * sy + v1 * sxy) + v0 * v0 * n + 2 * v0 * v1 * sx + v1 * v1 * sxx) / n, 1e-12), v0, v1 from (select i, g.*, (sy * (sxx + s2) - sx * sxy) / ((n + s2 / 4) * (sxx + s2) - sx * sx) v0, ((n + s2 / 4) * sxy - sx * sy) / ((n + s2 / 4) * (sxx + s2) - sx * sx) v1 from it, g where i < 20)),
fit as (select sqrt(s2) sigma, w0, w1 from it where i = 20)"""


def _fitted(spark, sf_dir) -> tuple[DataFrame, dict[str, float]]:
    rows = brand_daily(spark, sf_dir).select(*KEYS, "revenue", (F.col("search_spend") / 1000).alias("search"))
    return rows, evaluation.ridge(rows, ["search"], "revenue")


@register(sql(_FIT, "select unnest(['intercept', 'search', 'sigma']) as term, unnest([round(w0, 6), round(w1, 6), round(sigma, 6)]) as value from fit", True))
def model_fit(spark, sf_dir):
    _, model = _fitted(spark, sf_dir)
    return rounded(spark.createDataFrame(list(model.items()), "term string, value double"), 6)


@register(sql(_FIT, f"select {K}, {r('exp(w0 + w1 * x + sigma * sigma / 2)', 'predicted', 2)} from rows_, fit", True))
def model_predict(spark, sf_dir):
    rows, model = _fitted(spark, sf_dir)
    return rounded(rows.select(*KEYS, evaluation.predicted(["search"], model).alias("predicted")), 2)


@register()
def model_contribution(spark, sf_dir):
    """Absolute coefficients of all channels and their shares; the system of five coefficients is tested against NumPy."""
    rows = brand_daily(spark, sf_dir).select("revenue", *((F.col(c) / 1000).alias(c) for c in SPEND))
    model = evaluation.ridge(rows, SPEND, "revenue")
    return rounded(spark.createDataFrame(evaluation.contribution_shares(model, {c: [f"{c}_spend"] for c in CHANNELS}), "channel string, contribution double, contribution_pct double"))


# Evaluation, of twice the spend as a guess at revenue.
_E = f"e as (select {K}, revenue a, 2 * {TOTAL} p, {ROWN} rn, count(*) over (partition by brand) n from daily)"


def _guessed(spark, sf_dir) -> DataFrame:
    return brand_daily(spark, sf_dir).select(*KEYS, F.col("revenue").alias("a"), (2 * total()).alias("p"))


_CORE = f"avg(abs(a - p) / greatest(abs(a), 1e-8)) mape, sqrt(avg(pow(a - p, 2))) rmse, 1 - sum(pow(a - p, 2)) / nullif(sum(pow(a - m, 2)), 0) r2, avg(2 * abs(p - a) / greatest(abs(a) + abs(p), 1e-8)) smape, avg((abs(a - p) <= 1.28 * s)::int) coverage"
_CORES = f"{_E}, m as (select avg(a) m, stddev_pop(a - p) s from e), core as (select {_CORE} from e, m)"


@register(sql(_CORES, f"select {r('mape', 'mape')}, {r('rmse', 'rmse', 2)}, {r('r2', 'r2')}, {r('smape', 'smape')}, {r('coverage', 'coverage')} from core"))
def eval_core_metrics(spark, sf_dir):
    return rounded(evaluation.core_metrics(_guessed(spark, sf_dir), "a", "p").withColumn("rmse", F.round("rmse", 2)))


@register(sql(_E, f"select case when rn <= floor(n * 0.8::double) then 'train' else 'test' end part, count(*) n_rows, {r('avg(abs(a - p) / greatest(abs(a), 1e-8))', 'mape')}, {r('sqrt(avg(pow(a - p, 2)))', 'rmse', 2)} from e group by 1"))
def eval_holdout(spark, sf_dir):
    return rounded(evaluation.part_metrics(evaluation.holdout(_guessed(spark, sf_dir), S), ["part"], "a", "p").withColumn("rmse", F.round("rmse", 2)))


_STEPS = f"st as (select brand, a - lag(a) over {ORD} a, p - lag(p) over {ORD} p from e), tr as (select brand, avg((sign(a) = sign(p))::int) same_direction, corr(a, p) corr from st where a is not null group by 1)"


@register(sql(f"{_E}, {_STEPS}", f"select brand, {r('same_direction', 'same_direction')}, {r('corr', 'corr')} from tr"))
def eval_trend(spark, sf_dir):
    return rounded(evaluation.trend_consistency(_guessed(spark, sf_dir), S, "a", "p"))


@register(sql(f"{_E}, c as (select brand, a, p - a e, sum(p - a) over {ORD} c, rn from e)", f"select brand, {r('max(abs(c))', 'worst', 2)}, {r('regr_slope(e, rn)', 'slope', 2)}, {r('stddev_pop(e)', 'spread', 2)}, case when max(abs(c)) > stddev_pop(a) then 'high' else 'low' end severity from c group by 1"))
def eval_drift(spark, sf_dir):
    return rounded(evaluation.drift(_guessed(spark, sf_dir), S, "a", "p"), 2)


@register(sql(f"{_E}, m as (select brand, month({D}) m, avg(abs(a - p) / greatest(abs(a), 1e-8)) x from e group by 1, 2)", f"select brand, {r('avg(x)', 'mean_mape')}, {r('stddev_pop(x)', 'spread')}, {r('max(x)', 'worst')} from m group by 1"))
def eval_seasonal(spark, sf_dir):
    return rounded(evaluation.seasonal(_guessed(spark, sf_dir), ["brand"], D, "a", "p"))


_U = "u as (" + " union all ".join(f"select {K}, '{c}' channel, {c}_spend v from daily" for c in CHANNELS) + ")"
LONG = Series(("channel", "brand"), D)


def _channels(spark, sf_dir) -> DataFrame:
    return quality.long(brand_daily(spark, sf_dir), list(KEYS), SPEND, value="v").withColumn("channel", F.regexp_replace("channel", "_spend$", ""))


@register(sql(_U, f"select channel, {r('sum(v) / (select sum(v) from u)', 'share')}, {r('case when avg(v) > 0 then stddev_samp(v) / avg(v) else 0 end', 'variation')}, {r('avg((v = 0)::int)', 'zero_share')} from u group by 1"))
def eval_contributions(spark, sf_dir):
    return rounded(evaluation.contributions(_channels(spark, sf_dir), Series(("channel",), D), "v"))


_FRAME = f"(partition by channel, brand order by {D} rows between 3 preceding and current row)"


@register(sql(f"{_U}, d as (select channel, brand, case when count(v) over {_FRAME} >= 4 then stddev_samp(v) over {_FRAME} end d, case when count(v) over {_FRAME} >= 4 then avg(v) over {_FRAME} end m from u)", f"select channel, brand, {r('1 / (1 + avg(d) / nullif(avg(m), 0))', 'stability')} from d group by 1, 2"))
def eval_stability(spark, sf_dir):
    return rounded(evaluation.stability(_channels(spark, sf_dir), LONG, "v"))


@register(sql("b as (select *, quantile_cont(search_spend, 0.8) over (partition by brand) hi, quantile_cont(search_spend, 0.2) over (partition by brand) lo from daily)", f"select brand, {r('avg(case when search_spend >= hi then revenue end)', 'high')}, {r('avg(case when search_spend <= lo then revenue end)', 'low')} from b group by 1"))
def eval_incrementality(spark, sf_dir):
    return rounded(evaluation.incrementality(brand_daily(spark, sf_dir), ["brand"], "search_spend", "revenue"))


@register(sql(f"x as (select brand, revenue x, revenue - 2 * lag(revenue) over {ORD} + lag(revenue, 2) over {ORD} d from daily)", f"select brand, {r('stddev_pop(d) / (stddev_pop(x) + 1e-8)', 'roughness')} from x group by 1"))
def eval_smoothness(spark, sf_dir):
    return rounded(evaluation.smoothness(brand_daily(spark, sf_dir), S, "revenue"))


@register(sql(f"{_CORES}, {_STEPS}, parts as (select (case when mape <= 0.15 then 0.15 else 0 end + case when smape <= 0.15 then 0.15 else 0 end + case when coverage >= 0.8 then 0.1 else 0 end)::double errors, (select avg(same_direction) from tr) agreement from core)", f"select {r('errors', 'errors')}, {r('agreement', 'agreement')}, {r('least(errors + 0.3::double * agreement, 1)', 'score')} from parts"))
def eval_score(spark, sf_dir):
    rows = _guessed(spark, sf_dir)
    return rounded(evaluation.overall(evaluation.core_metrics(rows, "a", "p"), evaluation.trend_consistency(rows, S, "a", "p")))


# Budget.
SCENARIOS = [("conservative", 0.8), ("current", 1.0), ("aggressive", 1.2)]
_LAST = f"t as (select {D}, " + ", ".join(f"sum({c}_spend) {c}" for c in CHANNELS) + f" from daily group by 1 order by 1 desc limit 4), cur as (select unnest([" + ", ".join(f"'{c}'" for c in CHANNELS) + "]) channel, unnest([" + ", ".join(f"avg({c})" for c in CHANNELS) + "]) \"current\" from t)"
_RATE = "case channel " + " ".join(f"when '{c}' then {evaluation.multiplier(c)!r}::double" for c in CHANNELS) + " end"
_PLAN = f"""{_LAST}, sc as ({values(SCENARIOS, "scenario, m")}), ra as (select scenario, channel, "current", {_RATE} rate, row_number() over (partition by scenario order by {_RATE} desc, channel) - 1 place, sum("current") over (partition by scenario) * m total from cur, sc),
al as (select scenario, channel, "current", rate, total * (0.05::double + greatest(least(0.75::double - place * 0.35::double, 0.35), 0)) optimised from ra), plan as (select *, optimised - "current" change, 100 * (optimised - "current") / nullif("current", 0) pct_change from al),
sums as (select scenario, sum("current" * rate) / nullif(sum("current"), 0) roas_now, sum(optimised * rate) / nullif(sum(optimised), 0) roas_best from plan group by 1)"""


def _current(spark, sf_dir) -> DataFrame:
    return evaluation.latest_spend(brand_daily(spark, sf_dir), D, SPEND)


def _plan(spark, sf_dir) -> DataFrame:
    return evaluation.allocation(_current(spark, sf_dir), spark.createDataFrame(SCENARIOS, "scenario string, budget_multiplier double"), list(CHANNELS))


@register(sql(_LAST, f"select channel, {r(chr(34) + 'current' + chr(34), chr(34) + 'current' + chr(34))} from cur"))
def budget_current(spark, sf_dir):
    return rounded(_current(spark, sf_dir))


@register(sql(_PLAN, "select scenario, channel, " + ", ".join(r(f'"{c}"', f'"{c}"', 3) for c in ("current", "optimised", "change", "pct_change")) + " from plan"))
def budget_scenarios(spark, sf_dir):
    return rounded(_plan(spark, sf_dir).drop("rate"), 3)


@register(sql(_PLAN, f"select scenario, {r('roas_now', 'roas_now')}, {r('roas_best', 'roas_best')} from sums"))
def budget_returns(spark, sf_dir):
    return rounded(evaluation.returns(_plan(spark, sf_dir)))


@register(sql(_PLAN, f"select arg_max(scenario, (round(roas_best, 6), scenario)) best_roas, arg_max(scenario, (round(roas_best - roas_now, 6), scenario)) best_gain, {r('max(roas_best)', 'roas')} from sums"))
def budget_best_scenario(spark, sf_dir):
    return rounded(evaluation.best_scenarios(evaluation.returns(_plan(spark, sf_dir))))


@register(sql(_PLAN, f"select scenario, channel, {r('change', 'change', 3)}, case when abs(pct_change) > 20 then 'major' else 'minor' end size from plan where abs(pct_change) > 5 order by round(abs(change), 4) desc, scenario, channel limit 5"))
def budget_top_moves(spark, sf_dir):
    return rounded(evaluation.top_moves(_plan(spark, sf_dir)), 3)


@register(sql(_PLAN, f"select scenario, count(case when pct_change > 15 then 1 end) increases, count(case when pct_change < -15 then 1 end) decreases, count(case when abs(pct_change) < 5 then 1 end) stable, {r('avg(abs(pct_change))', 'mean_change', 3)} from plan group by 1"))
def budget_reallocation(spark, sf_dir):
    return rounded(evaluation.reallocation(_plan(spark, sf_dir)), 3)


@register(sql(_PLAN, f"select channel, count(pct_change) scenarios, {r('avg(pct_change)', 'mean_change', 3)} from plan group by 1 having count(pct_change) > 1 and avg(pct_change) > 10"))
def budget_priorities(spark, sf_dir):
    return rounded(evaluation.priorities(_plan(spark, sf_dir)), 3)


@register(sql(_LAST, f"select channel, {r(chr(34) + 'current' + chr(34), chr(34) + 'current' + chr(34))}, {r('50000::double * case when (select sum(' + chr(34) + 'current' + chr(34) + ') from cur) > 0 then ' + chr(34) + 'current' + chr(34) + ' / (select sum(' + chr(34) + 'current' + chr(34) + ') from cur) else 0.2 end', 'allocated', 3)} from cur"))
def budget_proportional(spark, sf_dir):
    out = evaluation.proportional(_current(spark, sf_dir), 50_000.0)
    return rounded(out.withColumn("allocated", F.round("allocated", 3)))


BUDGETS = [500.0, 1000.0, 5000.0, 20000.0]
_HALF = "case when channel in ('search', 'shopping') then 0.3 else 0.5 end::double"
_POWER = "case when channel in ('search', 'shopping') then 1.2 else 1.0 end::double"
_CARRY = "case channel when 'search' then 1.3 when 'display' then 1.8 when 'video' then 1.8 else 1.6 end::double"


@register(f"with c as (select channel, unnest([{', '.join(f'{b}::double' for b in BUDGETS)}]) budget from ({values([(c,) for c in CHANNELS], 'channel')})), f as (select *, budget / greatest(budget, 1000) full_ from c) select channel, budget, {r(f'budget * 2 * greatest(pow(full_, {_POWER}) / (pow({_HALF}, {_POWER}) + pow(full_, {_POWER})), 0.1) * {_CARRY}', 'revenue', 3)} from f")
def model_return_curves(spark, sf_dir):
    return rounded(evaluation.curves(spark.createDataFrame([(c,) for c in CHANNELS], "channel string"), BUDGETS), 3)


# Reports.
DECAYS = [("search", 0.3), ("display", 0.8), ("facebook", 0.6)]


@register(f"select channel, decay, round(ln(0.5) / ln(decay), 4) + 0.0 half_life, round(decay / (1 - decay), 4) + 0.0 carried_over from ({values(DECAYS, 'channel, decay')})")
def report_adstock_effect(spark, sf_dir):
    """How long spend of a channel works on: the days until half is gone, and all that is carried over."""
    rows = spark.createDataFrame(DECAYS, "channel string, decay double")
    return rounded(rows.select("channel", "decay", (F.log(F.lit(0.5)) / F.log("decay")).alias("half_life"), (F.col("decay") / (1 - F.col("decay"))).alias("carried_over")))


@register(sql(f"{_U}, l as (select channel, avg(v / (v + 1000)) level from u group by 1)", f"select channel, {r('level', 'saturation')}, case when level < 0.33 then 'low' when level < 0.66 then 'medium' else 'high' end level from l"))
def report_saturation_level(spark, sf_dir):
    """Mean saturation of each channel, and the third it lies in."""
    rows = _channels(spark, sf_dir).groupBy("channel").agg(F.avg(F.col("v") / (F.col("v") + 1000)).alias("saturation"))
    return rounded(rows.withColumn("level", F.when(F.col("saturation") < 0.33, "low").when(F.col("saturation") < 0.66, "medium").otherwise("high")))


_BOTH = [(a, b) for i, a in enumerate(SPEND) for b in SPEND[i + 1 :]]


@register(sql("", " union all ".join(f"select '{a}' a, '{b}' b, round(corr({a}, {b}), 4) + 0.0 as corr, case when corr({a}, {b}) > 0.5 then 'synergy' when corr({a}, {b}) < -0.2 then 'cannibalisation' else 'none' end effect from daily" for a, b in _BOTH)))
def report_channel_effects(spark, sf_dir):
    """Which channels rise together, which at the cost of one another."""
    rows = quality.correlated_pairs(brand_daily(spark, sf_dir), SPEND)
    return rounded(rows.withColumn("effect", F.when(F.col("corr") > 0.5, "synergy").when(F.col("corr") < -0.2, "cannibalisation").otherwise("none")))


@register(sql(f"{_PLAN}, {_CORES.removeprefix('x')}, d as (select min({D}) first_day, max({D}) last_day, sum(revenue) revenue, sum({TOTAL}) spend from daily)", f"select first_day, last_day, {r('revenue', 'revenue', 2)}, {r('spend', 'spend', 2)}, {r('revenue / spend', 'roi')}, {r('mape', 'mape')}, (select arg_max(scenario, (round(roas_best, 6), scenario)) from sums) best_roas from d, core"))
def report_overview(spark, sf_dir):
    """The run in one row: period, money, error, best scenario."""
    rows = brand_daily(spark, sf_dir).withColumn("spend", total())
    whole = rows.agg(F.min(D).alias("first_day"), F.max(D).alias("last_day"), F.sum("revenue").alias("revenue"), F.sum("spend").alias("spend"))
    errors = evaluation.core_metrics(_guessed(spark, sf_dir), "a", "p").select("mape")
    best = evaluation.best_scenarios(evaluation.returns(_plan(spark, sf_dir))).select("best_roas")
    one = whole.join(F.broadcast(errors), how="cross").join(F.broadcast(best), how="cross")  # one row each
    return rounded(one.select("first_day", "last_day", F.round("revenue", 2).alias("revenue"), F.round("spend", 2).alias("spend"), (F.col("revenue") / F.col("spend")).alias("roi"), "mape", "best_roas"))


_SAT = f"case when max(abs(v)) over (partition by channel, brand) > 0 then pow(greatest(v, 0) / 1, 1.0) / (pow(3000::double, 1.0) + pow(greatest(v, 0), 1.0) + 1e-12) else 0 end"


@register(sql(f"{_U}, s as (select *, {_SAT} s from u), o as (select channel, brand, v, s, lag(s) over (partition by channel, brand order by v, {D}) before from s)", "select channel, count(*) points, count(case when s < before then 1 end) falls, count(case when s < 0 or s > 1 then 1 end) outside from o group by 1"))
def sat_curve_check(spark, sf_dir):
    """Whether a saturation curve only rises and stays between 0 and 1."""
    rows = _channels(spark, sf_dir).withColumn("s", media.hill(F.col("v"), LONG, 3000.0, 1.0, "k_in_units"))
    from pyspark.sql import Window

    before = F.lag("s").over(Window.partitionBy("channel", "brand").orderBy("v", D))
    return rows.withColumn("before", before).groupBy("channel").agg(F.count("*").alias("points"), F.count_if(F.col("s") < F.col("before")).alias("falls"), F.count_if((F.col("s") < 0) | (F.col("s") > 1)).alias("outside"))


__all__ = ["QUERIES", "ORACLE", "frame"]
