"""Panel, touch, conversion and macro tables derived from order, line and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Channel -> order priority that stands for it.
CHANNELS = {"search": "1-URGENT", "shopping": "2-HIGH", "facebook": "3-MEDIUM", "display": "4-NOT SPECIFIED", "tiktok": "5-LOW"}
SPEND = [f"{c}_spend" for c in CHANNELS]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what their lines sum up to."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("date_day"), "o_totalprice", "o_orderpriority")
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum((F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")).alias("spend"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("impressions"), F.count("*").alias("clicks")
    )
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    of = lambda priority, c: F.sum(F.when(F.col("o_orderpriority") == priority, F.coalesce(c, F.lit(0))).otherwise(0)).cast("double")
    return rows.groupBy(*keys).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"), F.count("*").alias("volume"),
        *(of(p, F.col(m)).alias(f"{c}_{m}") for c, p in CHANNELS.items() for m in ("spend", "impressions", "clicks")),
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date_day, brand, region, revenue, volume and spend, impressions and clicks by channel. Money is summed as decimals, so
    that sums don't depend on the order of rows."""
    places = read(spark, sf_dir, "nation").join(F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")  # 25 rows
    customers = read(spark, sf_dir, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("c_mktsegment").alias("brand"), F.col("r_name").alias("region"))
    return _summed(_orders(spark, sf_dir).join(customers, F.col("o_custkey") == F.col("c_custkey")), "date_day", "brand", "region")


def brand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel over all regions: one series a brand, summed in one step."""
    brands = read(spark, sf_dir, "customer").where("c_nationkey is not null").select("c_custkey", F.col("c_mktsegment").alias("brand"))
    return _summed(_orders(spark, sf_dir).join(brands, F.col("o_custkey") == F.col("c_custkey")), "date_day", "brand")


def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    channel = F.concat(F.lit("ch"), F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(5)).cast("string"))
    return read(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view")).select("event_id", "user_id", "ts", F.col("event_type").alias("interaction_type"), channel.alias("channel"))


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("conversion_id"), "user_id", "ts", F.col("value").alias("conversion_value"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly price index by ship month."""
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    return read(spark, sf_dir, "lineitem").groupBy(month.alias("date")).agg(F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")), 4).alias("price_index"))


_LI = "li as (select l_orderkey, sum(cast(l_extendedprice*l_discount as decimal(18,4))) spend, sum(cast(l_quantity as decimal(18,2))) impressions, count(*) clicks from lineitem group by l_orderkey)"
_METRICS = ", ".join(f"cast(sum(case when o_orderpriority='{p}' then coalesce({m},0) else 0 end) as double) {c}_{m}" for c, p in CHANNELS.items() for m in ("spend", "impressions", "clicks"))
_NAMES = ["revenue", "volume", *(f"{c}_{m}" for c in CHANNELS for m in ("spend", "impressions", "clicks"))]
#: The same tables as named SQL parts, to be put after WITH.
PANEL_SQL = f"""{_LI}, panel as (select cast(o_orderdate as date) date_day, c_mktsegment brand, r_name region, cast(sum(cast(o_totalprice as decimal(18,2))) as double) revenue, count(*) volume, {_METRICS}
 from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey left join li on o_orderkey=l_orderkey group by 1,2,3)"""
DAILY_SQL = PANEL_SQL + ", daily as (select date_day, brand, " + ", ".join(f"cast(sum(cast({c} as decimal(28,4))) as {'double' if c != 'volume' else 'bigint'}) {c}" for c in _NAMES) + " from panel group by 1,2)"
TOUCH_SQL = """touches as (select event_id, user_id, ts, event_type interaction_type, 'ch' || (cast(json_extract_string(props,'$.k') as int) % 5) channel from events where event_type in ('click','view')),
conversions as (select event_id conversion_id, user_id, ts, value conversion_value from events where event_type = 'purchase')"""
MACRO_SQL = "macro as (select cast(date_trunc('month', l_shipdate) as date) date, round(avg(l_extendedprice / l_quantity), 4) price_index from lineitem group by 1)"
