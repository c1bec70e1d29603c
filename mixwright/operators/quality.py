"""Data-quality checks, each one aggregate over the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixwright.functions.windows import Series, change, rolling
from mixwright.operators import selection


def long(df: DataFrame, keys: list[str], columns: list[str], name: str = "channel", value: str = "value") -> DataFrame:
    return df.select(*keys, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(keys, columns, name, value)


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return long(df, [], columns, "column").groupBy("column").agg(F.count("*").alias("n_rows"), (100 * F.avg(F.col("value").isNull().cast("int"))).alias("null_pct"), (100 * F.avg((F.col("value") == 0).cast("int"))).alias("zero_pct"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in groups of several, such groups, and rows beyond the first of each."""
    sizes = df.groupBy(*keys).count()
    return sizes.agg(F.sum("count").alias("n_rows"), F.sum(F.when(F.col("count") > 1, F.col("count")).otherwise(0)).alias("in_groups"), F.count_if(F.col("count") > 1).alias("n_groups"), F.sum(F.col("count") - 1).alias("surplus"))


def outliers(df: DataFrame, columns: list[str], share: float = 0.99) -> DataFrame:
    """Values strictly outside the outer percentiles. The bounds, two a column, are literals of the second pass."""
    bounds = {r["column"]: r for r in selection.wide(selection.percentiles(long(df, [], columns, "column"), ["column"], "value", [1 - share, share]), ["column"], {1 - share: "low", share: "high"}).collect()}  # a row a column
    outside = lambda c: F.count_if((F.col(c) < bounds[c]["low"]) | (F.col(c) > bounds[c]["high"]))
    known = [c for c in columns if c in bounds]
    one = df.agg(*(outside(c).alias(c) for c in known)).unpivot([], known, "column", "outside")
    ends = F.create_map(*(x for c in known for x in (F.lit(c), F.struct(F.lit(bounds[c]["low"]).alias("low"), F.lit(bounds[c]["high"]).alias("high")))))
    return one.select("column", ends[F.col("column")]["low"].alias("low"), ends[F.col("column")]["high"].alias("high"), "outside")


def anomalies(daily: DataFrame, s: Series, revenue: str, spend: str) -> DataFrame:
    """Days of outage (revenue under the 10th percentile), spike (spend over twice the 95th) or launch (a jump over 200 % and
    1.5 times the mean of a week)."""
    whole = s.whole()
    low, high = F.percentile(F.col(revenue), 0.1).over(whole), F.percentile(F.col(spend), 0.95).over(whole)
    launch = (change(F.col(spend), s) > 2.0) & (F.col(spend) > 1.5 * rolling("mean", F.col(spend), s, 7))
    flags = daily.select(*s.by, s.order, (F.col(revenue) < low).alias("outage"), (F.col(spend) > 2 * high).alias("spike"), F.coalesce(launch, F.lit(False)).alias("launch"))
    return flags.where("outage or spike or launch")


def completeness(df: DataFrame, by: list[str], day: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct(day).alias("days"), (F.datediff(F.max(day), F.min(day)) + 1).cast("bigint").alias("span")).withColumn("share", F.col("days") / F.col("span"))


def coverage_weeks(df: DataFrame, by: list[str], day: str, least: int = 52, preferred: int = 104) -> DataFrame:
    weeks = df.groupBy(*by).agg(F.count_distinct(F.date_trunc("week", day)).alias("weeks"))
    return weeks.withColumn("status", F.when(F.col("weeks") >= preferred, "good").when(F.col("weeks") >= least, "enough").otherwise("poor"))


def identifiability(df: DataFrame, channels: list[str]) -> DataFrame:
    """Of each channel's spend, null taken as 0: shares of zeros and of values up to the 5th percentile, range, mean, variation."""
    filled = df.select(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in channels))
    low = {r["channel"]: r["value"] for r in selection.percentiles(long(filled, [], channels), ["channel"], "value", [0.05]).collect()}  # a row a channel
    parts = [
        F.struct(
            F.lit(c).alias("channel"), (100 * F.avg((F.col(c) <= 1e-9).cast("int"))).alias("zero_pct"), (100 * F.avg((F.col(c) <= F.lit(low.get(c))).cast("int"))).alias("near_zero_pct"),
            F.try_divide(F.stddev_samp(c), F.avg(c)).alias("variation"), F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean"),
        ).alias(c)
        for c in channels
    ]
    return filled.agg(*parts).select(F.explode(F.array(*channels)).alias("x")).select("x.*")


def correlated_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """The correlation of each pair of columns, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    return one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr").select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "corr")


def unit_costs(df: DataFrame, channels: list[str], tolerance: float = 0.15) -> DataFrame:
    """Cost per thousand impressions and per click by channel, with the spread of days around the mean."""
    parts = F.explode(F.array(*(F.struct(F.lit(c).alias("channel"), F.col(f"{c}_spend").alias("spend"), F.col(f"{c}_impressions").alias("imp"), F.col(f"{c}_clicks").alias("clicks")) for c in channels)))
    rows = df.select(parts.alias("p")).select("p.*").withColumn("cpm", F.try_divide(F.col("spend"), F.when(F.col("imp") > 0, F.col("imp") / 1000))).withColumn("cpc", F.try_divide(F.col("spend"), F.when(F.col("clicks") > 0, F.col("clicks"))))
    total = rows.groupBy("channel").agg(F.try_divide(F.sum("spend"), F.sum("imp") / 1000).alias("all_cpm"), F.try_divide(F.sum("spend"), F.sum("clicks")).alias("all_cpc"))
    off = F.count_if(F.abs(F.col("cpm") - F.col("all_cpm")) > tolerance * F.col("all_cpm"))
    return rows.join(F.broadcast(total), "channel").groupBy("channel").agg(F.first("all_cpm").alias("cpm"), F.first("all_cpc").alias("cpc"), off.alias("off_days"))


def similar_names(names: DataFrame, name: str, least: float = 0.5) -> DataFrame:
    """Pairs of different names whose sets of words agree. Names meet by one of their rarest words: of n words so many that
    two names of that likeness can't miss each other in them, which leaves common words out."""
    words = names.select(F.col(name).alias("name")).distinct().withColumn("words", F.array_distinct(F.split(F.lower("name"), r"[^a-z0-9]+")))
    each = words.withColumn("word", F.explode("words"))
    held = each.join(each.groupBy("word").agg(F.count("*").alias("names")), "word")
    place = F.row_number().over(Window.partitionBy("name").orderBy("names", "word"))
    n = F.size("words")
    each = held.withColumn("place", place).where(F.col("place") <= n - F.ceil(n * least - 1e-9) + 1).select("name", "words", "word")
    pairs = each.alias("x").join(each.alias("y"), (F.col("x.word") == F.col("y.word")) & (F.col("x.name") < F.col("y.name"))).select(F.col("x.name").alias("a"), F.col("y.name").alias("b"), F.col("x.words").alias("p"), F.col("y.words").alias("q")).distinct()
    return pairs.withColumn("jaccard", F.size(F.array_intersect("p", "q")) / F.size(F.array_union("p", "q"))).where(F.col("jaccard") >= least).select("a", "b", "jaccard")


def business_rules(df: DataFrame, day: str, revenue: str, spend: list[str]) -> DataFrame:
    days = df.groupBy(day).agg(F.sum(revenue).alias("r"), F.sum(sum((F.coalesce(c, F.lit(0.0)) for c in spend), F.lit(0.0))).alias("s"), F.count_if(F.col(revenue) < 0).alias("neg"))
    return days.agg(F.sum("neg").alias("negative_rows"), F.count_if(F.col("r") == 0).alias("zero_days"), F.min("r").alias("least"), F.max("r").alias("most"), F.try_divide(F.sum("r"), F.sum("s")).alias("roi"))


def digital_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    """100, less half the share of nulls in percent, 20 for negatives, 30 for a constant; 0 at least."""
    agg = long(df, [], columns, "column").groupBy("column").agg((100 * F.avg(F.col("value").isNull().cast("int"))).alias("n"), F.count_if(F.col("value") < 0).alias("neg"), F.var_samp("value").alias("var"))
    score = 100 - 0.5 * F.col("n") - F.when(F.col("neg") > 0, 20).otherwise(0) - F.when(F.coalesce("var", F.lit(0.0)) == 0, 30).otherwise(0)
    return agg.select("column", F.greatest(score, F.lit(0.0)).alias("quality"))


def summary(df: DataFrame, day: str, revenue: str, spend: list[str]) -> DataFrame:
    days = df.groupBy(day).agg(F.count("*").alias("n"), F.sum(revenue).alias("r"), F.sum(sum((F.coalesce(c, F.lit(0.0)) for c in spend), F.lit(0.0))).alias("s"))
    return days.agg(F.sum("n").alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.sum("r").alias("revenue"), F.avg("r").alias("mean_day"), F.sum("s").alias("spend"))
