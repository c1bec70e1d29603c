"""Queries over series: creative fatigue, competition and market, business terms, baseline controls."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.functions.windows import interpolated, rolling, slope
from mixwright.operators import baseline, fatigue, market
from mixwright.plans.media_queries import ALL, DAYS, KEYS, ORD, ROWN, K, S, W, days, frame
from mixwright.plans.registry import OFF_TIES, Registry, r, rounded
from mixwright.sources.panel import CHANNELS, DAILY_SQL, MACRO_SQL, SPEND, brand_daily, macro, read

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
D = "date_day"
TOTAL = "(" + " + ".join(SPEND) + ")"
TRAINED = "2000-01-01"


def sql(parts: str, body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' * recursive}{DAILY_SQL}{', ' * bool(parts)}{parts} {body}"


def total():
    return sum((F.col(c) for c in SPEND[1:]), F.col(SPEND[0]))


def shown(rows: DataFrame, columns: dict, digits: int = 4) -> DataFrame:
    return rounded(rows.select(*KEYS, *(c.alias(n) for n, c in columns.items())), digits)


def change_sql(x: str, lag: int = 1) -> str:
    return f"case when lag({x}, {lag}) over {ORD} <> 0 then ({x} - lag({x}, {lag}) over {ORD}) / lag({x}, {lag}) over {ORD} end"


# Creative fatigue.
RATE = f"({math.log(0.5)!r}::double / 14)"
_WORN = f"""p as (select *, (date_diff('day', min({D}) over {ALL}, {D}) % 30 = 0) f from daily),
s as (select *, coalesce(max(case when f then {D} end) over {W("unbounded preceding", 0)}, min({D}) over {ALL}) since from p),
w as (select *, greatest(exp(date_diff('day', since, {D}) * {RATE}), 0.2::double) factor from s)"""


def _worn(spark, sf_dir) -> DataFrame:
    rows = brand_daily(spark, sf_dir).withColumn("f", fatigue.periodic(F.col(D), S))
    return rows.withColumn("factor", fatigue.worn(F.col(D), F.col("f"), S))


@register(sql(_WORN, f"select {K}, f::int as refreshed, {r('factor', 'factor', 6)}, " + ", ".join(r(f"{c}_spend * factor + {OFF_TIES}::double", f"{c}_fatigue_adjusted") for c in CHANNELS) + " from w"))
def fatigue_adjusted(spark, sf_dir):
    rows = _worn(spark, sf_dir)
    return rows.select(*KEYS, F.col("f").cast("int").alias("refreshed"), F.round("factor", 6).alias("factor"), *((F.round(F.col(f"{c}_spend") * F.col("factor") + OFF_TIES, 4) + 0.0).alias(f"{c}_fatigue_adjusted") for c in CHANNELS))


@register(sql(_WORN, f"select brand, {r('100 * (1 - sum(search_spend * factor) / nullif(sum(search_spend), 0))', 'impact_pct')}, {r('min(factor)', 'least')}, {r('stddev_samp(factor)', 'spread')}, count(case when factor = 1 then 1 end) fresh_days, count(case when factor <= 0.2 then 1 end) floor_days from w group by brand"))
def fatigue_metrics(spark, sf_dir):
    return rounded(fatigue.wear(_worn(spark, sf_dir), ["brand"], "search_spend", "factor"))


@register(sql(_WORN + f", n as (select brand, {D}, factor, {ROWN} place from w), fr as (select *, lead(place) over {ORD} after, lead(factor) over {ORD} fend from n where factor = 1)", f"select brand, count(*) stretches, {r('avg((fend <= factor)::int)', 'share')}, avg((fend <= factor)::int) >= 0.7 as consistent from fr where after - place >= 2 group by brand"))
def fatigue_consistency(spark, sf_dir):
    return rounded(fatigue.wears_off(_worn(spark, sf_dir), S, "factor"))


_JUMP = f"m as (select {K}, search_spend, {ROWN} place, avg(search_spend + 1e-12::double) over {W(-6)} m from daily), j as (select brand, {D} d from (select *, coalesce(abs({change_sql('m')}) > 0.5, false) hit from m) where hit)"


@register(sql(_JUMP + ", c as (select brand, min(d) d from j group by brand union all select c.brand, (select min(j.d) from j where j.brand = c.brand and date_diff('day', c.d, j.d) >= 7) d from c where c.d is not null)", f"select brand, d as {D} from c where d is not null union select brand, {D} from m where place = 1 and search_spend > 1e-12", True))
def fatigue_spend_jumps(spark, sf_dir):
    return fatigue.refreshes(brand_daily(spark, sf_dir), S, "search_spend", "spend_change").where("refreshed").select("brand", D)


_LAUNCH = f"n as (select brand, {D}, search_spend, {ROWN} place from daily), j as (select brand, place from (select brand, place, coalesce(lag(search_spend) over {ORD} <= 500 and search_spend > 500, false) hit from n) where hit)"


@register(sql(_LAUNCH + ", c as (select brand, min(place) place from j group by brand union all select c.brand, (select min(j.place) from j where j.brand = c.brand and j.place - c.place >= 7) place from c where c.place is not null)", f"select brand, {D} from n join (select brand, place from c where place is not null union select brand, place from n where place = 1 and search_spend > 500) using (brand, place)", True))
def fatigue_launches(spark, sf_dir):
    return fatigue.refreshes(brand_daily(spark, sf_dir), S, "search_spend", "campaign_launch", threshold=500.0).where("refreshed").select("brand", D)


_DETECTED = _LAUNCH + f""", c as (select brand, min(place) place from j group by brand union all select c.brand, (select min(j.place) from j where j.brand = c.brand and j.place - c.place >= 7) place from c where c.place is not null),
hit as (select brand, place from c where place is not null union select brand, place from n where place = 1 and search_spend > 500), p as (select n.*, hit.place is not null f from n left join hit using (brand, place)),
s as (select *, coalesce(max(case when f then {D} end) over {W("unbounded preceding", 0)}, min({D}) over {ALL}) since from p), w as (select *, greatest(exp(date_diff('day', since, {D}) * {RATE}), 0.2::double) factor from s)"""


def _detected(spark, sf_dir) -> DataFrame:
    rows = fatigue.refreshes(brand_daily(spark, sf_dir), S, "search_spend", "campaign_launch", threshold=500.0)
    return rows.withColumn("factor", fatigue.worn(F.col(D), F.col("refreshed"), S))


@register(sql(_DETECTED, f"select {K}, f::int refreshed, {r('factor', 'factor', 6)}, {r(f'search_spend * factor + {OFF_TIES}::double', 'adjusted')} from w", True))
def fatigue_detected(spark, sf_dir):
    """Wear since the launches that spend shows."""
    rows = _detected(spark, sf_dir)
    return rows.select(*KEYS, F.col("refreshed").cast("int").alias("refreshed"), (F.round("factor", 6) + 0.0).alias("factor"), (F.round(F.col("search_spend") * F.col("factor") + OFF_TIES, 4) + 0.0).alias("adjusted"))


@register(sql(_DETECTED, f"select brand, {r('100 * (1 - sum(search_spend * factor) / nullif(sum(search_spend), 0))', 'impact_pct')}, {r('min(factor)', 'least')}, {r('stddev_samp(factor)', 'spread')}, count(case when factor = 1 then 1 end) fresh_days, count(case when factor <= 0.2 then 1 end) floor_days, count(case when f then 1 end) refreshes, {r(f'date_diff(' + chr(39) + 'day' + chr(39) + f', min(case when f then {D} end), max(case when f then {D} end))::double / nullif(count(case when f then 1 end) - 1, 0)', 'mean_gap_days')} from w group by brand", True))
def fatigue_detected_metrics(spark, sf_dir):
    return rounded(fatigue.wear(_detected(spark, sf_dir), ["brand"], "search_spend", "factor", refreshed="refreshed"))


@register(f"with {DAYS}, x as (select distinct (date_trunc('quarter', d) + interval 3 day)::date refresh_date from days), k as (select d from days where day(d) % 6 = 0), m as (select refresh_date, d, abs(date_diff('day', refresh_date, d)) gap from x join k on d between refresh_date - 5 and refresh_date + 5) select refresh_date, d, gap::int as gap from (select *, row_number() over (partition by refresh_date order by gap, d) n from m) where n = 1")
def fatigue_external_refreshes(spark, sf_dir):
    table = days(spark, sf_dir)
    refreshes = table.select(F.date_add(F.to_date(F.date_trunc("quarter", "d")), 3).alias("refresh_date")).distinct()
    return fatigue.nearest(table.where(F.day("d") % 6 == 0), refreshes, "d").select("refresh_date", "d", F.col("gap").cast("int").alias("gap"))


@register(sql(f"f as (select brand, {D}, volume % 4 <> 0 hit, count(*) over {ALL} n, {ROWN} - 1 i from daily), a as (select *, avg(hit::int) over {ALL} rate, case when floor(n * 0.4::double) - 2 > 0 then floor(n / greatest(floor(n * 0.4::double) - 2, 1)) end step from f)", f"select {K}, (case when rate > 0.6 then i = 0 or i = n - 1 or coalesce(i % step = 0 and i >= step and i < n - step, false) else hit end)::int refreshed from a"))
def fatigue_guarded_refreshes(spark, sf_dir):
    return brand_daily(spark, sf_dir).select(*KEYS, fatigue.guarded(F.col("volume") % 4 != 0, S).cast("int").alias("refreshed"))


# Competition and market.
EFF = f"(revenue / ({TOTAL} + 1e-8::double))"
_RN = f"n as (select *, {ROWN} rn, {EFF} eff, revenue / volume aov from daily where {TOTAL} > 0)"


def _numbered(spark, sf_dir) -> DataFrame:
    """Days with spend, as efficiency without any says nothing."""
    return brand_daily(spark, sf_dir).where(total() > 0).withColumns({"rn": S.number(), "eff": market.efficiency(F.col("revenue"), total()), "aov": F.col("revenue") / F.col("volume")})


_MED30 = f"quantile_cont(eff, 0.5) over {W(-29)}"


@register(sql(_RN, f"select {K}, {r('eff', 'efficiency')}, {r('greatest(-coalesce(' + frame('regr_slope(eff, rn)', 'eff', 14) + ', 0), 0)', 'decline')}, {r(f'greatest(({_MED30} - eff) / ({_MED30} + 1e-8::double), 0)', 'gap')} from n"))
def competitor_response(spark, sf_dir):
    return shown(_numbered(spark, sf_dir), {"efficiency": F.col("eff"), **market.response(F.col("eff"), F.col("rn"), S)})


@register(sql(_RN, f"select {K}, coalesce({change_sql('aov', 7)} < -0.05 and {change_sql('volume::double', 7)} > 0.05, false)::int price_war from n"))
def competitor_price_war(spark, sf_dir):
    return shown(_numbered(spark, sf_dir), {"price_war": market.price_war(F.col("aov"), F.col("volume").cast("double"), S)})


_THANKS = "(make_date(year(d), 11, 22) + ((4 - isodow(make_date(year(d), 11, 22)) + 7) % 7)::int)"
_SEASON = f"case when d between {_THANKS} and {_THANKS} + 6 then 1.0 when month(d) = 12 and day(d) >= 15 then 0.8 when month(d) = 2 and day(d) between 10 and 16 then 0.6 when month(d) = 5 and day(d) between 8 and 14 then 0.6 when month(d) = 8 or (month(d) = 9 and day(d) <= 15) then 0.5 when month(d) = 5 and day(d) >= 25 then 0.4 else 0 end::double"


@register(f"with {DAYS} select d, (day(d) <= 7)::int month_start, (month(d) in (1, 4, 7, 10) and day(d) <= 14)::int quarter_start, (day(d) >= 25)::int month_end, (month(d) in (3, 6, 9, 12) and day(d) >= 20)::int quarter_end, {_SEASON} season from days")
def competitor_timing(spark, sf_dir):
    return days(spark, sf_dir).select("d", *(c.alias(n) for n, c in market.timing(F.col("d")).items()))


_SHARES = [f"({c} / nullif({TOTAL}, 0))" for c in SPEND]
_HHI = " + ".join(f"{x} * {x}" for x in _SHARES)
_ENTROPY = " + ".join(f"case when {x} > 0 then -{x} * ln({x}) else 0 end" for x in _SHARES)


@register(sql("", f"select {K}, {r(TOTAL, 'total')}, {r(f'coalesce({_HHI}, 0)', 'hhi')}, {r(f'coalesce({_ENTROPY}, 0)', 'entropy')}, {r('coalesce(greatest(' + ', '.join(_SHARES) + '), 0)', 'top_share')} from daily"))
def competitor_indices(spark, sf_dir):
    return shown(brand_daily(spark, sf_dir), market.indices(SPEND))


_RIVAL = "rival as (select cast(o_orderdate as date) d, cast(sum(cast(o_totalprice as decimal(18,2))) as double) / 100 v from orders where o_orderpriority = '5-LOW' and day(o_orderdate) <= 10 group by 1)"


@register(
    sql(
        f"""{_RIVAL}, g as (select {K}, {TOTAL} own, v x, {ROWN} n from daily left join rival on {D} = d),
f as (select *, last_value(x ignore nulls) over {W("unbounded preceding", 0)} l, first_value(x ignore nulls) over {W(0, "unbounded following")} f,
 last_value(case when x is not null then n end ignore nulls) over {W("unbounded preceding", 0)} a, first_value(case when x is not null then n end ignore nulls) over {W(0, "unbounded following")} b from g),
h as (select {K}, own, coalesce(x, l + (f - l) * ((n - a)::double / nullif(b - a, 0)), l, 0) rivals from f)""",
        f"select {K}, {r(f'rivals + {OFF_TIES}::double', 'rivals', 2)}, {r('own / (own + rivals + 1e-8::double)', 'share_of_voice')} from h",
    )
)
def competitor_spend(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").where((F.col("o_orderpriority") == "5-LOW") & (F.day("o_orderdate") <= 10))
    rival = orders.groupBy(F.to_date("o_orderdate").alias(D)).agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 100).alias("v"))
    rows = brand_daily(spark, sf_dir).join(rival, D, "left").select(*KEYS, total().alias("own"), "v").withColumn("n", S.number())
    rows = rows.withColumn("rivals", F.coalesce(interpolated(F.col("v"), S, F.col("n")), F.lit(0.0)))
    return shown(rows, {"rivals": F.round(F.col("rivals") + OFF_TIES, 2), "share_of_voice": market.share_of_voice(F.col("own"), F.col("rivals"))})


_YEARS = f"(date_diff('day', min({D}) over {ALL}, {D}) / 365.25::double)"


@register(sql("", f"select {K}, {r(_YEARS, 'years')}, ({_YEARS} <= 1)::int young, ({_YEARS} > 1 and {_YEARS} <= 3)::int growing, ({_YEARS} > 3)::int mature from daily"))
def market_lifecycle(spark, sf_dir):
    return shown(brand_daily(spark, sf_dir), market.lifecycle(F.col(D), S))


def _fall(x: str) -> str:
    return f"greatest(-coalesce({frame(f'regr_slope({x}, rn)', x, 30)}, 0), 0)"


@register(sql(f"{_RN}, e as (select * from n)", f"select {K}, {r(_fall('eff'), 'total')}, {r(_fall('revenue'), 'revenue_fall', 2)} from e"))
def market_saturation(spark, sf_dir):
    rows = _numbered(spark, sf_dir)
    out = rows.select(*KEYS, F.round(market.wear_out(F.col("eff"), F.col("rn"), S), 4).alias("total"), F.round(market.wear_out(F.col("revenue"), F.col("rn"), S), 2).alias("revenue_fall"))
    return out.withColumns({"total": F.col("total") + 0.0, "revenue_fall": F.col("revenue_fall") + 0.0})


_EVOLVED = "n as (select *, " + ROWN + " rn, " + ", ".join(f"coalesce({c} / nullif({TOTAL}, 0), 0) {c}_sh" for c in SPEND) + " from daily)"


@register(sql(_EVOLVED, " union all ".join(f"select {K}, '{c.removesuffix('_spend')}' channel, {r(f'{c}_sh', 'share')}, {r(frame(f'regr_slope({c}_sh, rn)', f'{c}_sh', 30), 'trend', 6)}, {r(frame(f'stddev_samp({c}_sh)', f'{c}_sh', 14), 'swing')} from n" for c in SPEND)))
def market_channel_evolution(spark, sf_dir):
    """Share of each channel, its trend over a month and its swing over two weeks."""
    rows = brand_daily(spark, sf_dir).withColumn("_all", total()).select(*KEYS, S.number().alias("rn"), *(F.coalesce(F.try_divide(F.col(c), F.when(F.col("_all") != 0, F.col("_all"))), F.lit(0.0)).alias(c) for c in SPEND))
    made = rows.select(*KEYS, *(F.struct(F.round(c, 4).alias("share"), F.round(slope(F.col(c), F.col("rn"), S, 30), 6).alias("trend"), F.round(rolling("std", F.col(c), S, 14), 4).alias("swing")).alias(c.removesuffix("_spend")) for c in SPEND))
    out = made.unpivot(list(KEYS), list(CHANNELS), "channel", "v")
    return out.select(*KEYS, "channel", *((F.col(f"v.{c}") + 0.0).alias(c) for c in ("share", "trend", "swing")))


def _corr(x: str, y: str) -> str:
    return f"coalesce(case when count({x}) over {W(-29)} >= 30 then covar_samp({x}, {y}) over {W(-29)} / nullif(stddev_samp({x}) over {W(-29)} * stddev_samp({y}) over {W(-29)}, 0) end, 0)"


@register(sql("", f"select {K}, " + ", ".join(r("(" + " + ".join(_corr(x, y) for y in SPEND if y != x) + ") / 4", x.removesuffix("_spend")) for x in SPEND) + " from daily"))
def market_channel_correlations(spark, sf_dir):
    rows = market.mean_correlations(brand_daily(spark, sf_dir), SPEND, S)
    return shown(rows, {x.removesuffix("_spend"): F.col(x) for x in SPEND})


@register(f"with {DAYS}, e as (select distinct date_trunc('month', d)::date event_date, month(d) / 10.0::double magnitude, 10 + month(d) duration_days from days) select d, round(coalesce(sum(magnitude * exp(-date_diff('day', event_date, d) / (duration_days / 3.0::double))), 0), 4) + 0.0 shock from days left join e on d between event_date and event_date + duration_days::int group by d")
def market_shocks(spark, sf_dir):
    table = days(spark, sf_dir)
    month = F.to_date(F.date_trunc("month", "d"))
    events = table.select(month.alias("event_date"), (F.month("d") / 10.0).alias("magnitude"), (F.month("d") + 10).alias("duration_days")).distinct()
    return rounded(market.shocks(table, "d", events))


_LAID = """laid as (select d, v, max(case when v is not null then d end) over (order by d rows between unbounded preceding and current row) t0,
 min(case when v is not null then d end) over (order by d rows between current row and unbounded following) t1 from (select coalesce(days.d, macro.date) d, price_index v from days full join macro on days.d = macro.date)),
line as (select x.d, coalesce(x.v, a.v + (b.v - a.v) * (date_diff('day', x.t0, x.d)::double / nullif(date_diff('day', x.t0, x.t1), 0)), a.v, b.v) v from laid x left join laid a on x.t0 = a.d left join laid b on x.t1 = b.d),
daily_index as (select days.d, v, row_number() over (order by days.d) rn from days join line using (d))"""


def _daily_index(spark, sf_dir) -> DataFrame:
    known = macro(spark, sf_dir).select(F.col("date").alias("d"), F.col("price_index").alias("v"))
    return baseline.daily(days(spark, sf_dir), known, "d", "v")


def _along(kind: str, width: int) -> str:
    over = f"(order by d rows between {width - 1} preceding and current row)"
    return f"case when count(v) over {over} >= {width} then {kind} over {over} end"


@register(f"with {DAYS}, {MACRO_SQL}, {_LAID} select d, {r(f'v + {OFF_TIES}::double', 'price_index')}, {r(_along('regr_slope(v, rn)', 30), 'trend')}, {r(_along('stddev_samp(v)', 14), 'swing')} from daily_index")
def economic_indicators(spark, sf_dir):
    """A series of one row a day: the whole calendar is one window."""
    one = type(S)((), "d")
    rows = _daily_index(spark, sf_dir).withColumn("rn", one.number())
    return rounded(rows.select("d", (F.col("v") + OFF_TIES).alias("price_index"), slope(F.col("v"), F.col("rn"), one, 30).alias("trend"), rolling("std", F.col("v"), one, 14).alias("swing")))


@register(sql(_RN, f"select {K}, {r(frame('regr_slope(volume, rn)', 'volume', 30), 'volume_trend')}, {r(frame('stddev_samp(aov)', 'aov', 14), 'value_swing', 2)}, {r('1 / (' + frame(f'stddev_samp({TOTAL})', TOTAL, 14) + ' + 1e-8::double)', 'steadiness', 6)} from n"))
def consumer_confidence(spark, sf_dir):
    rows = _numbered(spark, sf_dir).withColumn("spend", total())
    c = market.confidence(F.col("aov"), F.col("volume"), F.col("spend"), F.col("rn"), S)
    digits = {"volume_trend": 4, "value_swing": 2, "steadiness": 6}
    return rows.select(*KEYS, *((F.round(x, digits[n]) + 0.0).alias(n) for n, x in c.items()))


_C30 = f"coalesce({change_sql('revenue', 30)}, 0)"


@register(sql("", f"select {K}, ({_C30} > 0.05 and {_C30} < 0.3)::int growth, ({_C30} >= -0.02 and {_C30} <= 0.05)::int maturity, ({_C30} < -0.02)::int decline from daily"))
def market_stages(spark, sf_dir):
    return brand_daily(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in market.stages(F.col("revenue"), S).items()))


# Business terms.
def _base(x: str) -> str:
    w = W(-14, -1)
    return f"case when count({x}) over {w} >= 7 then quantile_cont({x}, 0.5) over {w} end"


_PROMO = f"b as (select *, revenue / ({_base('revenue')} + 1e-8::double) ratio, {TOTAL} / ({_base(TOTAL)} + 1e-8::double) paid from daily), h as (select *, case when ratio is not null then greatest(ratio - 1, 0) end height from b)"
_FLAGS = "coalesce(ratio > 1.3, false)::int spike, coalesce(ratio > 1.3 and paid < 1.2, false)::int price_promo, coalesce(ratio > 1.3 and paid > 1.5, false)::int media_push"


def _over_training(x: str) -> str:
    top = f"max(case when {D} <= date '{TRAINED}' then {x} end) over {ALL}"
    return f"{x} / case when {top} > 0 then {top} else 1 end"


@register(sql(_PROMO, f"select {K}, {_FLAGS}, {r('case when height is not null then least(height, 2) end', 'intensity')} from h"))
def promo_periods(spark, sf_dir):
    return shown(brand_daily(spark, sf_dir), market.promotions(F.col("revenue"), total(), S))


def _trained():
    return F.col(D) <= F.lit(TRAINED).cast("date")


@register(sql(_PROMO, f"select {K}, {_FLAGS}, {r(_over_training('height'), 'intensity')} from h"))
def promo_periods_trained(spark, sf_dir):
    """Heights over the largest of the days up to the end of training."""
    return shown(brand_daily(spark, sf_dir), market.promotions(F.col("revenue"), total(), S, training=_trained()))


_WEEKLY = f"coalesce({change_sql('revenue', 7)}, 0)"
_INTENSE = f"i as (select {K}, least(greatest({_WEEKLY}, 0), 1) growth, greatest(coalesce(revenue / ({_base('revenue')} + 1e-8::double), 1) - 1, 0) spike, coalesce(case when count(revenue) over {W(-7, -1)} >= 3 then stddev_samp(revenue) over {W(-7, -1)} end, 0) swing from daily)"


@register(sql(_INTENSE, f"select {K}, {r('growth', 'growth')}, {r(_over_training('spike'), 'spike')}, {r(_over_training('swing'), 'swing')} from i"))
def promo_intensity(spark, sf_dir):
    return shown(brand_daily(spark, sf_dir), market.promotion_intensity(F.col("revenue"), S, _trained()))


@register(sql(_INTENSE, f"select {K}, {r('growth', 'growth')}, {r('least(spike, 1)', 'spike')}, {r('least(swing, 1)', 'swing')} from i"))
def promo_intensity_clipped(spark, sf_dir):
    return shown(brand_daily(spark, sf_dir), market.promotion_intensity(F.col("revenue"), S))


#: Campaigns as a user gives them: name, first and last day, discount.
CAMPAIGNS = (("spring", "1996-03-10", "1996-03-24", 0.2, None), ("Winter Sale", "1997-12-01", "1997-12-20", 0.35, 12000.0), ("brief", "1998-05-04", "1998-05-07", None, 500.0))


def _campaign_sql(name: str, a: str, b: str, discount, money) -> str:
    on, name = f"d between date '{a}' and date '{b}'", f"promo_{name.replace(' ', '_').lower()}"
    ramp = f"case when {on} then greatest(least(date_diff('day', date '{a}', d) / 3.0::double, date_diff('day', d, date '{b}') / 3.0::double, 1), 0) else 0 end"
    given = [f"case when {on} then {v}::double else 0 end {name}_{part}" for part, v in (("intensity", discount), ("budget", money)) if v is not None]
    return ", ".join([f"({on})::int {name}", *given, r(ramp, f"{name}_ramp")])


@register(f"with {DAYS} select d, " + ", ".join(_campaign_sql(*c) for c in CAMPAIGNS) + " from days")
def promo_campaigns(spark, sf_dir):
    columns = {}
    for name, a, b, discount, money in CAMPAIGNS:
        columns |= market.campaign(F.col("d"), name, a, b, discount, money)
    return rounded(days(spark, sf_dir).select("d", *(c.alias(n) for n, c in columns.items())))


_SIGNED = f"g as (select {K}, {_WEEKLY} x from daily), h as (select *, greatest(x, 0) up, least(x, 0) down from g)"


@register(sql(_SIGNED, f"select {K}, {r(_over_training('up'), 'up_intensity')}, {r('up', 'up_plain')}, {r(_over_training('down'), 'down_intensity')}, {r('least(greatest(x, 0), 1)', 'clipped_intensity')}, {r('x', 'free_plain')} from h"))
def promo_constrained(spark, sf_dir):
    from mixwright.functions.windows import change

    rows = brand_daily(spark, sf_dir).withColumn("x", F.coalesce(change(F.col("revenue"), S, 7), F.lit(0.0)))
    both = {"promo_intensity": F.col("x"), "promo_plain": F.col("x")}
    up, down = market.constrained(both, S, "positive", _trained()), market.constrained(both, S, "negative", _trained())
    free = market.constrained(both, S, "none")
    return shown(rows, {"up_intensity": up["promo_intensity"], "up_plain": up["promo_plain"], "down_intensity": down["promo_intensity"], "clipped_intensity": free["promo_intensity"], "free_plain": free["promo_plain"]})


@register(sql("", f"select {K}, {r(f'(sin(dayofyear({D}) * (2 * pi()) / 365.25) + 1) / 2', 'wave')}, {r(f'1 + 0.02::double * {_YEARS}', 'growth')}, {r(f'coalesce(lag({TOTAL}, 14) over {ORD}, 0)', 'earlier')} from daily"))
def competitive_terms(spark, sf_dir):
    return shown(brand_daily(spark, sf_dir), market.background(F.col(D), total(), S))


_MID = f"quantile_cont(aov, 0.5) over {W(-29)}"
_DV, _DP = f"coalesce({change_sql('volume::double')}, 0)", f"coalesce({change_sql('aov')}, 0)"


@register(sql(f"{_RN}, t as (select *, (aov - {_MID}) / nullif({_MID}, 0) pos, {_DV} dv, {_DP} dp from n)", f"select {K}, {r('greatest(pos, 0)', 'premium')}, {r('greatest(-pos, 0)', 'discount')}, {r('case when abs(dp) > 0.01 then least(greatest(-dv / dp, -10), 10) else 0 end', 'elasticity')} from t"))
def price_terms(spark, sf_dir):
    return shown(_numbered(spark, sf_dir), market.price_terms(F.col("aov"), F.col("volume").cast("double"), S))


_WK = f"coalesce({change_sql('wk')}, 0)"


@register(sql(f"{_RN}, w as (select *, avg(volume / ({TOTAL} + 1e-8::double)) over {W(-6)} wk from n)", f"select {K}, {r(f'greatest(-{_WK}, 0)', 'stockout')}, {r(f'greatest({_WK}, 0)', 'recovery')}, (month({D}) = 11 or (month({D}) = 12 and day({D}) <= 15))::int heavy from w"))
def inventory_terms(spark, sf_dir):
    rows = _numbered(spark, sf_dir).withColumn("week", rolling("mean", market.efficiency(F.col("volume"), total()), S, 7, 1))
    return shown(rows, market.inventory(F.col("week"), F.col(D), S))


# Baseline controls.
@register(f"with {DAYS}, {MACRO_SQL} select d, round((select arg_max(price_index, date) from macro where date + 30 <= d), 4) + 0.0 price_index from days")
def macro_as_of(spark, sf_dir):
    """Each day with the last index published, 30 days after its month began."""
    return rounded(baseline.as_of(days(spark, sf_dir), macro(spark, sf_dir), [], "d", "date", "price_index", 30).select("d", "price_index"))


@register(sql("x as (select c_mktsegment brand, cast(o_orderdate as date) d, max(o_totalprice) v from orders join customer on o_custkey = c_custkey where day(o_orderdate) = 1 group by 1, 2)", f"select {K}, round((select arg_max(v, d) from x where x.brand = daily.brand and d <= {D}), 4) + 0.0 last_top from daily"))
def brand_as_of(spark, sf_dir):
    """Each day of a brand with the largest order of the last first of a month."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("brand"))
    known = read(spark, sf_dir, "orders").where(F.day("o_orderdate") == 1).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    known = known.groupBy("brand", F.to_date("o_orderdate").alias("d")).agg(F.max("o_totalprice").alias("last_top"))
    return shown(baseline.as_of(brand_daily(spark, sf_dir).select(*KEYS), known, ["brand"], D, "d", "last_top"), {"last_top": F.col("last_top")})


@register(f"with {DAYS}, {MACRO_SQL}, {_LAID}, t as (select avg(v) m, stddev_pop(v) s from daily_index where d <= date '{TRAINED}') select d, {r('(v - m) / nullif(s, 0)', 'z')} from daily_index, t")
def macro_standardized(spark, sf_dir):
    rows = _daily_index(spark, sf_dir)
    return rounded(rows.select("d", baseline.standardized(F.col("v"), F.col("d") <= F.lit(TRAINED).cast("date"), []).alias("z")))


#: External events as a user gives them: name, first and last day, shape.
EVENTS = (("strike", "1996-05-01", "1996-05-20", "step"), ("launch", "1997-01-10", "1997-03-10", "ramp_up"), ("exit", "1998-02-01", "1998-03-15", "ramp_down"))


def _event_sql(name: str, a: str, b: str, kind: str) -> str:
    on, share = f"d between date '{a}' and date '{b}'", f"least(greatest(date_diff('day', date '{a}', d) / (date_diff('day', date '{a}', date '{b}') + 1e-9), 0), 1)"
    ramps = {"ramp_up": share, "ramp_down": f"1 - {share}"}
    return f"({on})::int external_{name}" + (", " + r(f"case when {on} then {ramps[kind]} else 0 end", f"external_{name}_ramp") if kind in ramps else "")


@register(f"with {DAYS} select d, " + ", ".join(_event_sql(*e) for e in EVENTS) + " from days")
def external_events(spark, sf_dir):
    columns = {}
    for e in EVENTS:
        columns |= baseline.event(F.col("d"), *e)
    return rounded(days(spark, sf_dir).select("d", *(c.alias(n) for n, c in columns.items())))


_QC = ["revenue", *SPEND]
_LONG = "l as (select unnest([" + ", ".join(f"'{c}'" for c in _QC) + ", 'flat']) \"column\", unnest([" + ", ".join(_QC) + ", 1.0::double]) v from daily)"


@register(sql(_LONG, f"select \"column\", {r('var_samp(v)', 'variance', 1)}, coalesce(var_samp(v) >= 1e-6, false) keep from l group by 1"))
def baseline_variance(spark, sf_dir):
    out = baseline.spread(brand_daily(spark, sf_dir).withColumn("flat", F.lit(1.0)), [*_QC, "flat"])
    return rounded(out, 1)


_MADE = "m as (select *, revenue * 2 + volume rev2, search_spend + 1 s1 from daily)"
_PAIRS = [(a, b) for i, a in enumerate(["revenue", "rev2", "search_spend", "s1", "tiktok_spend"]) for b in ["revenue", "rev2", "search_spend", "s1", "tiktok_spend"][i + 1 :]]


@register(sql(_MADE, "select dropped, kept, round(corr, 6) + 0.0 corr from (" + " union all ".join(f"select '{a}' dropped, '{b}' kept, corr({a}, {b}) corr from m" for a, b in _PAIRS) + ") where abs(corr) > 0.95"))
def baseline_correlated(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).withColumns({"rev2": F.col("revenue") * 2 + F.col("volume"), "s1": F.col("search_spend") + 1})
    return rounded(baseline.correlated(rows, ["revenue", "rev2", "search_spend", "s1", "tiktok_spend"]), 6)


@register(sql(_LONG + ", t as (select \"column\" channel from l where \"column\" like '%_spend' group by 1 order by var_samp(v) desc, 1 limit 2), u as (" + " union all ".join(f"select {K}, '{c}' channel, {c} v from daily" for c in SPEND) + ")", f"select {K}, channel, " + ", ".join(r(f"v * (month({D}) = {m})::int", f"by_month_{m}") for m in (1, 2, 3, 4)) + " from u join t using (channel)"))
def baseline_interactions(spark, sf_dir):
    """The two channels that vary most, times the first four months."""
    daily = brand_daily(spark, sf_dir)
    top = baseline.most_varied(daily, SPEND, 2).select(F.col("column").alias("channel"))
    rows = daily.select(*KEYS, *SPEND).unpivot(list(KEYS), SPEND, "channel", "v").join(F.broadcast(top), "channel")  # two rows
    return rounded(rows.select(*KEYS, "channel", *((F.col("v") * (F.month(D) == m).cast("int")).alias(f"by_month_{m}") for m in (1, 2, 3, 4))))


@register(sql("e as (select brand, d, any_value(x) x from (select c_mktsegment brand, cast(o_orderdate as date) d, o_orderkey x, row_number() over (partition by c_mktsegment, cast(o_orderdate as date) order by o_orderkey) n from orders join customer on o_custkey = c_custkey) where n = 1 group by 1, 2)", f"select daily.{D}, daily.brand, {r('revenue', 'revenue')}, x as first_order from daily left join e on daily.brand = e.brand and {D} = d"))
def baseline_joined(spark, sf_dir):
    """Features joined by day, one row a day of theirs."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("brand"))
    rows = read(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("brand", F.to_date("o_orderdate").alias(D), F.col("o_orderkey").alias("first_order"))
    once = baseline.first_of_day(rows, ["brand", D], ["first_order"])
    return rounded(brand_daily(spark, sf_dir).select(*KEYS, "revenue").join(once, list(KEYS), "left"))
