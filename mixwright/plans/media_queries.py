"""Queries over one series a brand: frames, carry-over, saturation, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.functions import calendar, media
from mixwright.functions.windows import Series, change, interpolated, rolling, slope
from mixwright.plans.registry import Registry, r, rounded
from mixwright.sources.panel import DAILY_SQL, brand_daily

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
S = Series(("brand",), "date_day")
KEYS = ("date_day", "brand")
K = "date_day, brand"


def W(first: int | str = 0, last: int | str = 0) -> str:
    side = lambda n: "current row" if n == 0 else f"{abs(n)} preceding" if n < 0 else f"{n} following"
    return f"(partition by brand order by date_day rows between {first if isinstance(first, str) else side(first)} and {last if isinstance(last, str) else side(last)})"


ORD, ALL, ROWN = "(partition by brand order by date_day)", "(partition by brand)", "row_number() over (partition by brand order by date_day)"


def sql(body: str) -> str:
    return f"with {DAILY_SQL} {body}"


def frame(kind: str, x: str, width: int) -> str:
    return f"case when count({x}) over {W(1 - width)} >= {width} then {kind} over {W(1 - width)} end"


def one(spark, sf_dir, **columns) -> DataFrame:
    return rounded(brand_daily(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in columns.items())))


@register(sql(f"select {K}, {r(frame('avg(revenue)', 'revenue', 7), 'mean_7')} from daily"))
def rolling_mean_7(spark, sf_dir):
    return one(spark, sf_dir, mean_7=rolling("mean", F.col("revenue"), S, 7))


@register(sql(f"select {K}, {r(frame('quantile_cont(revenue, 0.5)', 'revenue', 14), 'median_14')} from daily"))
def rolling_median_14(spark, sf_dir):
    return one(spark, sf_dir, median_14=rolling("median", F.col("revenue"), S, 14))


@register(sql(f"select {K}, {r(frame('stddev_samp(revenue)', 'revenue', 14), 'std_14', 2)} from daily"))
def rolling_std_14(spark, sf_dir):
    return rounded(brand_daily(spark, sf_dir).select(*KEYS, rolling("std", F.col("revenue"), S, 14).alias("std_14")), 2)


@register(sql(f", n as (select *, {ROWN} rn from daily) select {K}, {r(frame('regr_slope(revenue, rn)', 'revenue', 30), 'slope_30', 2)} from n").replace(" , n as", ", n as"))
def rolling_slope_30(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).withColumn("rn", S.number())
    return rounded(rows.select(*KEYS, slope(F.col("revenue"), F.col("rn"), S, 30).alias("slope_30")), 2)


@register(sql(f"select {K}, {r(f'case when count(search_spend) over {W(-29)} >= 30 then covar_samp(search_spend, facebook_spend) over {W(-29)} / nullif(stddev_samp(search_spend) over {W(-29)} * stddev_samp(facebook_spend) over {W(-29)}, 0) end', 'corr_30')} from daily"))
def rolling_corr_30(spark, sf_dir):
    return one(spark, sf_dir, corr_30=rolling("corr", F.col("search_spend"), S, 30, y=F.col("facebook_spend")))


@register(sql(f"select {K}, {r(f'case when lag(revenue, 7) over {ORD} <> 0 then (revenue - lag(revenue, 7) over {ORD}) / lag(revenue, 7) over {ORD} end', 'change_7')} from daily"))
def pct_change_7(spark, sf_dir):
    return one(spark, sf_dir, change_7=change(F.col("revenue"), S, 7))


@register(
    f"""with {DAILY_SQL}, g as (select {K}, case when volume % 3 <> 0 then revenue end x, {ROWN} n from daily),
f as (select *, last_value(x ignore nulls) over {W('unbounded preceding', 0)} l, first_value(x ignore nulls) over {W(0, 'unbounded following')} f,
 last_value(case when x is not null then n end ignore nulls) over {W('unbounded preceding', 0)} a, first_value(case when x is not null then n end ignore nulls) over {W(0, 'unbounded following')} b from g)
select {K}, round(coalesce(x, l + (f - l) * ((n - a)::double / nullif(b - a, 0)), l), 4) + 0.0 filled from f"""
)
def linear_interpolation(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select(*KEYS, F.when(F.col("volume") % 3 != 0, F.col("revenue")).alias("x"), S.number().alias("n"))
    return rounded(rows.select(*KEYS, interpolated(F.col("x"), S, F.col("n")).alias("filled")))


def _geometric_sql(decay: float, lags: int) -> str:
    return f"n as (select {K}, search_spend x, {ROWN} rn from daily), geo as (select a.date_day, a.brand, a.x, sum(b.x * power({decay}::double, a.rn - b.rn)) y from n a join n b on a.brand = b.brand and b.rn between a.rn - {lags} and a.rn group by all)"


@register(sql(f", {_geometric_sql(0.7, 117)} select {K}, {r('y', 'adstocked')} from geo").replace(" , n as", ", n as"))
def adstock_geometric(spark, sf_dir):
    return one(spark, sf_dir, adstocked=media.geometric(F.col("search_spend"), S, 0.7))


@register(sql(f", {_geometric_sql(0.5, 60)} select {K}, {r('x', 'spend')}, {r(f'y * sum(x) over {ALL} / nullif(sum(y) over {ALL}, 0)', 'by_sum', 2)}, {r(f'y * max(x) over {ALL} / nullif(max(y) over {ALL}, 0)', 'by_max', 2)} from geo").replace(" , n as", ", n as"))
def adstock_normalized(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select(*KEYS, F.col("search_spend").alias("spend"), media.geometric(F.col("search_spend"), S, 0.5).alias("y"))
    y, x = F.col("y"), F.col("spend")
    return rounded(rows.select(*KEYS, F.round("spend", 4).alias("spend"), F.round(media.rescaled(y, x, S, "sum"), 2).alias("by_sum"), F.round(media.rescaled(y, x, S, "max"), 2).alias("by_max")))


@register(sql(f", {_geometric_sql(0.7, 117)} select {K}, {r('sqrt(y) / (sqrt(1000::double) + sqrt(y))', 'response')} from geo").replace(" , n as", ", n as"))
def adstock_hill(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select(*KEYS, media.geometric(F.col("search_spend"), S, 0.7).alias("y"))
    return rounded(rows.select(*KEYS, media.adstock_hill(F.col("y"), 0.5, 1000.0).alias("response")))


def _weibull_sql(kernel: list[float], ahead: int) -> str:
    return " + ".join(f"{w!r}::double * coalesce({'lag' if j >= ahead else 'lead'}(search_spend, {abs(j - ahead)}) over {ORD}, 0)" for j, w in enumerate(kernel))


PDF, CDF = media.weibull_kernel(2.0, 3.0, 8), media.weibull_kernel(1.5, 4.0, 8, "cdf")


@register(sql(f"select {K}, {r(_weibull_sql(PDF, 4), 'adstocked')} from daily"))
def adstock_weibull_pdf(spark, sf_dir):
    return one(spark, sf_dir, adstocked=media.weibull(F.col("search_spend"), S, PDF))


@register(sql(f"select {K}, {r(_weibull_sql(CDF, 4), 'adstocked')} from daily"))
def adstock_weibull_cdf(spark, sf_dir):
    return one(spark, sf_dir, adstocked=media.weibull(F.col("search_spend"), S, CDF))


@register(sql(f"select {K}, {r(_weibull_sql(PDF, 0), 'adstocked')} from daily"))
def adstock_weibull_causal(spark, sf_dir):
    return one(spark, sf_dir, adstocked=media.weibull(F.col("search_spend"), S, PDF, "causal"))


def _hill_sql(size: str, k: str, power: float) -> str:
    return f"case when max(abs(search_spend)) over {ALL} > 0 then power(greatest(search_spend, 0) / {size}, {power}) / (power({k} / {size}, {power}) + power(greatest(search_spend, 0) / {size}, {power}) + 1e-12) else 0 end"


_TOP = f"case when max(search_spend) over {ALL} > 0 then max(search_spend) over {ALL} else 1 end"
_P95 = f"coalesce(quantile_cont(case when search_spend > 0 then search_spend end, 0.95) over {ALL}, 1)"


@register(sql(f"select {K}, {r(_hill_sql(_TOP, '3000::double', 1.3), 'saturated')} from daily"))
def sat_hill_max(spark, sf_dir):
    return one(spark, sf_dir, saturated=media.hill(F.col("search_spend"), S, 3000.0, 1.3))


@register(sql(f"select {K}, {r(_hill_sql(_P95, '3000::double', 1.3), 'saturated')} from daily"))
def sat_hill_p95(spark, sf_dir):
    return one(spark, sf_dir, saturated=media.hill(F.col("search_spend"), S, 3000.0, 1.3, "p95"))


@register(sql(f"select {K}, {r(_hill_sql('1::double', '3000::double', 0.8), 'saturated')} from daily"))
def sat_hill_units(spark, sf_dir):
    return one(spark, sf_dir, saturated=media.hill(F.col("search_spend"), S, 3000.0, 0.8, "k_in_units"))


@register(sql(f"select {K}, {r(f'case when max(abs(search_spend)) over {ALL} > 0 then 1 / (1 + exp(-greatest(least(6::double * (search_spend / ({_TOP}) - 0.4), 60), -60))) else 0 end', 'saturated')} from daily"))
def sat_logistic(spark, sf_dir):
    return one(spark, sf_dir, saturated=media.logistic(F.col("search_spend"), S, 6.0, 0.4))


@register(sql(f"select brand, {r('quantile_cont(case when search_spend > 0 then search_spend end, 0.6)', 'k')}, count(case when search_spend > 0 then 1 end) n from daily group by brand"))
def sat_calibrate_p60(spark, sf_dir):
    x = F.when(F.col("search_spend") > 0, F.col("search_spend"))
    return rounded(brand_daily(spark, sf_dir).groupBy("brand").agg(F.percentile(x, 0.6).alias("k"), F.count(x).alias("n")))


@register(sql(f", {_geometric_sql(0.7, 117)}, sat as (select *, {_hill_sql('1::double', '3000::double', 1.0).replace('search_spend', 'y')} s from geo) select cast(date_trunc('month', date_day) as date) \"month\", brand, {r('sum(x)', 'spend', 4)}, {r('avg(s)', 'saturation')} from sat group by 1, 2").replace(" , n as", ", n as"))
def media_response_monthly(spark, sf_dir):
    """Carry-over, then saturation of daily spend, by month: the flagship."""
    rows = brand_daily(spark, sf_dir).select(*KEYS, F.col("search_spend").alias("x"), media.geometric(F.col("search_spend"), S, 0.7).alias("y"))
    rows = rows.withColumn("s", media.hill(F.col("y"), S, 3000.0, 1.0, "k_in_units"))
    months = rows.groupBy(F.to_date(F.date_trunc("month", "date_day")).alias("month"), "brand").agg(F.sum("x").alias("spend"), F.avg("s").alias("saturation"))
    return rounded(months)


flagship = media_response_monthly


# Calendar. The days of all series, one row a day.
DAYS = "days as (select distinct cast(o_orderdate as date) d from orders)"


def days(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("d")).distinct()


_PI = "pi()"
_FOURIER = ", ".join([f"round({f}(2 * pi() * {i} * dayofyear(d) / 365.25), 6) + 0.0 as {f}_year_{i}" for i in (1, 2) for f in ("sin", "cos")] + [f"round({f}(2 * pi() * {i} * (isodow(d) - 1) / 7), 6) + 0.0 as {f}_week_{i}" for i in (1, 2) for f in ("sin", "cos")])


@register(f"with {DAYS} select d, {_FOURIER} from days")
def calendar_fourier(spark, sf_dir):
    return rounded(days(spark, sf_dir).select("d", *(c.alias(n) for n, c in calendar.fourier(F.col("d")).items())), 6)


@register(f"with {DAYS} select d, " + ", ".join(f"(isodow(d) = {i + 1})::int as is_{n}" for i, n in enumerate(calendar.DAYS)) + ", (isodow(d) >= 6)::int as is_weekend from days")
def calendar_weekdays(spark, sf_dir):
    return days(spark, sf_dir).select("d", *(c.alias(n) for n, c in calendar.weekdays(F.col("d")).items()))


_CYCLIC = {"month": "month(d) / 12.0::double", "quarter": "quarter(d) / 4.0::double", "week": "weekofyear(d) / 52.0::double", "day": "day(d)::double / day(last_day(d))"}


@register(f"with {DAYS} select d, " + ", ".join(f"round({f}(2 * pi() * {x}), 6) + 0.0 as {f}_{n}" for n, x in _CYCLIC.items() for f in ("sin", "cos")) + " from days")
def calendar_cyclic(spark, sf_dir):
    return rounded(days(spark, sf_dir).select("d", *(c.alias(n) for n, c in calendar.cyclic(F.col("d")).items())), 6)


@register(f"with {DAYS}, m as (select min(d) lo, max(case when d <= date '2000-01-01' then d end) hi from days) select d, date_diff('day', lo, d) trend, round(date_diff('day', lo, d)::double / nullif(date_diff('day', lo, hi), 0), 6) + 0.0 trained from days, m")
def calendar_trend(spark, sf_dir):
    """Days since the first, and the same over the training window's last."""
    d = days(spark, sf_dir)
    ends = d.agg(F.min("d").alias("lo"), F.max(F.when(F.col("d") <= F.lit("2000-01-01").cast("date"), F.col("d"))).alias("hi"))
    trend = F.datediff("d", "lo").cast("bigint")
    return rounded(d.join(F.broadcast(ends)).select("d", trend.alias("trend"), F.try_divide(trend.cast("double"), F.datediff("hi", "lo")).alias("trained")), 6)


#: Years of the SQL; the query takes those of its days.
HOLIDAYS = calendar.holidays(1970, 2040)
_NAMES = sorted({n for _, n in HOLIDAYS})
_VALUES = "hol as (select * from (values " + ", ".join(f"(date '{d}', '{n}')" for d, n in HOLIDAYS) + ") t(h, n))"
_KEPT = "kept as (select * from (values " + ", ".join(f"(date '{calendar.observed(d)}', '{n}')" for d, n in HOLIDAYS) + ") t(h, n))"


def _near(spark, table: DataFrame) -> DataFrame:
    """Holidays of the years of ``table``, a row each."""
    years = table.agg(F.year(F.min("d")).alias("first"), F.year(F.max("d")).alias("last")).first()
    return calendar.holiday_table(spark, (years.first or 1970) - 1, (years.last or 1970) + 1)


_MARKS = "hd as (select h, n from hol join days on h = d)"


@register(f"with {DAYS}, {_VALUES}, {_MARKS} select d, " + ", ".join(f"coalesce(max(case when h = d {'+ 1' if e == 'before' else '- 1' if e == 'after' else ''} and n = '{n}' then 1 end), 0)::int as {n}{'_' + e if e else ''}" for n in _NAMES for e in ("", "before", "after")) + " from days left join hd on h between d - 1 and d + 1 group by d")
def calendar_holidays(spark, sf_dir):
    """Three columns for every holiday, whether it is among the days or not: the day, the one before and the one after. A
    holiday that isn't among the days marks none beside it."""
    table = days(spark, sf_dir)
    there = _near(spark, table).join(table.select(F.col("d").alias("holiday_date")), "holiday_date")
    near = there.withColumn("shift", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).withColumn("d", F.date_add("holiday_date", F.col("shift")))
    flag = lambda n, shift: F.coalesce(F.max(F.when((F.col("shift") == shift) & (F.col("holiday") == n), 1)), F.lit(0)).cast("int")
    return table.join(near, "d", "left").groupBy("d").agg(*(flag(n, shift).alias(f"{n}{end}") for n in _NAMES for shift, end in ((0, ""), (-1, "_before"), (1, "_after"))))


@register(f"with {DAYS}, {_KEPT} select d, " + ", ".join(f"coalesce(max(case when n in ({', '.join(repr(x) for x in names)}) then 1 end), 0)::int as holiday_group_{g}" for g, names in calendar.GROUPS.items()) + ", count(n) holidays from days left join kept on h = d group by d")
def calendar_holiday_groups(spark, sf_dir):
    """Holidays on the days they are kept on, by group."""
    table = days(spark, sf_dir)
    shift = F.when(F.dayofweek("holiday_date") == 7, -1).when(F.dayofweek("holiday_date") == 1, 1).otherwise(0)
    kept = _near(spark, table).withColumn("d", F.date_add("holiday_date", shift))
    flag = lambda names: F.coalesce(F.max(F.when(F.col("holiday").isin(*names), 1)), F.lit(0)).cast("int")
    return table.join(kept, "d", "left").groupBy("d").agg(*(flag(names).alias(f"holiday_group_{g}") for g, names in calendar.GROUPS.items()), F.count("holiday").alias("holidays"))
