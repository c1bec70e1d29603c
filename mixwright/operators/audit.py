"""What a run does to its rows: counts of each step, taken in the pass that writes, and rows that break rules put aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mixwright.functions.windows import Series, rolling
from mixwright.operators import selection

AUDIT = "step int, action string, level string, metric string, value double"


class Audit:
    """Counts by step. Each step's table is observed: its counts come out of whatever job writes the last one, not of a job of
    their own. Detailed steps are left out unless ``detailed``."""

    def __init__(self, detailed: bool = True):
        self.detailed, self.steps = detailed, []

    def step(self, df: DataFrame, action: str, level: str = "standard", **counts: Column) -> DataFrame:
        """``df``, with aggregates over it under ``action``; rows are always counted."""
        if level == "detailed" and not self.detailed:
            return df
        seen = Observation()
        self.steps.append((action, level, seen))
        return df.observe(seen, F.count("*").alias("rows"), *(c.alias(n) for n, c in counts.items()))

    def rows(self, spark: SparkSession) -> DataFrame:
        """A row a step and count, once the last table has been written."""
        found = [(i, action, level, metric, None if v is None else float(v)) for i, (action, level, seen) in enumerate(self.steps, 1) for metric, v in seen.get.items()]
        return spark.createDataFrame(found, AUDIT)


def rules_of(day: str, revenue: str, spend: list[str], today: Column | None = None, highest: float = 1e9) -> dict[str, Column]:
    """What a row must keep: a day that isn't in the future, a revenue from 0 to below ``highest``, no negative spend. Null
    breaks a rule on day or revenue, and none on spend."""
    rules = {
        "day_present": F.col(day).isNotNull(), "day_not_future": F.col(day) <= (F.current_date() if today is None else today), "revenue_not_negative": F.col(revenue) >= 0,
        "revenue_not_too_high": F.col(revenue) < highest,
    }
    return rules | {f"{c}_not_negative": F.coalesce(F.col(c), F.lit(0)) >= 0 for c in spend}


def judged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with the names of the rules that a row breaks; a rule that is null doesn't hold."""
    names = F.array(*(F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()))
    return df.withColumn("broken", F.filter(names, lambda n: n.isNotNull()))


def routed(df: DataFrame, rules: dict[str, Column], path: str, good: str = "good", bad: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """All rows written in one pass: whole ones under route=``good``, the rest, with what they break, under route=``bad``."""
    out = judged(df, rules).withColumn("route", F.when(F.size("broken") == 0, good).otherwise(bad))
    out.write.mode("overwrite").partitionBy("route").parquet(path)
    back = df.sparkSession.read.schema(out.schema).parquet(path)
    return back.where(F.col("route") == good).drop("route", "broken"), back.where(F.col("route") == bad).drop("route")


def broken_counts(bad: DataFrame, rules: list[str]) -> DataFrame:
    """(rule, broken) for every rule, 0 included."""
    one = bad.agg(*(F.count_if(F.array_contains("broken", n)).alias(n) for n in rules))
    return one.unpivot([], rules, "rule", "broken")


def reported_costs(df: DataFrame, channels: dict[str, dict[str, str]], tolerance: float = 15.0, most: float = 10.0) -> DataFrame:
    """Reported cost of a thousand impressions or of a click against what spend implies, by channel and kind.

    ``channels``: channel -> spend, impressions, clicks, cpm and cpc columns, as far as there are any. Rows with spend and
    delivery count. ``failed``: more than ``most`` percent of them are off by more than ``tolerance`` percent.
    """
    parts = []
    for channel, names in channels.items():
        for kind, unit, per in (("cpm", "impressions", 1000), ("cpc", "clicks", 1)):
            if unit in names and kind in names:
                spend, n, told = (F.col(names[k]).cast("double") for k in ("spend", unit, kind))
                both = (n > 0) & (spend > 0)
                off = F.when(both, F.abs(F.try_divide(spend / F.when(n > 0, n / per) - told, F.when(told != 0, told))) * 100)
                parts.append(F.struct(F.lit(channel).alias("channel"), F.lit(kind).alias("kind"), F.count_if(both).alias("n_rows"), F.count_if(off > tolerance).alias("off_rows"), F.avg(off).alias("mean_off_pct")))
    if not parts:
        return df.sparkSession.createDataFrame([], "channel string, kind string, n_rows long, off_rows long, mean_off_pct double, failed boolean")
    out = df.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return out.withColumn("failed", 100 * F.col("off_rows") > most * F.col("n_rows"))


def magnitudes(df: DataFrame, spend: list[str], most: float = 3.0) -> DataFrame:
    """Mean and order of magnitude of each spend column, and whether all of them lie within ``most`` orders."""
    one = df.agg(*(F.avg(c).alias(c) for c in spend)).unpivot([], spend, "column", "mean")
    order = F.when(F.col("mean") > 0, F.log10("mean")).otherwise(0.0)
    ends = df.agg(*(F.avg(c).alias(c) for c in spend)).select(F.array(*(F.when(F.col(c) > 0, F.log10(c)).otherwise(0.0) for c in spend)).alias("o")).select((F.array_max("o") - F.array_min("o")).alias("spread"))
    return one.withColumn("magnitude", order).join(F.broadcast(ends), how="cross").withColumn("consistent", F.col("spread") <= most)  # one row


def outlier_profile(df: DataFrame, keys: list[str], columns: list[str], share: float = 0.99, k: int = 10) -> DataFrame:
    """Values over the percentile of their column: how many, their largest and mean, and the keys of the first ``k``, in the order
    of ``keys``. Each task keeps its own first ``k`` of a column before they meet."""
    from mixwright.operators.quality import long

    found = selection.percentiles(long(df, [], columns, "column"), ["column"], "value", [share])
    bounds = {r["column"]: r["value"] for r in found.collect()}  # a row a column
    known = [c for c in columns if c in bounds]
    over = long(df, keys, known, "column").where(F.col("value") > F.element_at(F.create_map(*(F.lit(x) for c in known for x in (c, bounds[c]))), F.col("column")))
    from pyspark.sql import Window

    first = over.withColumn("place", F.row_number().over(Window.partitionBy("column").orderBy(*keys))).where(F.col("place") <= k)
    listed = first.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("place", *keys))).alias("l")).select("column", F.transform("l", lambda x: F.concat_ws(" ", *(x[c].cast("string") for c in keys))).alias("first"))
    counts = over.groupBy("column").agg(F.count("*").alias("n_over"), F.max("value").alias("most"), F.avg("value").alias("mean"))
    base = df.agg(*(F.count(c).alias(c) for c in known)).unpivot([], known, "column", "n_rows")
    limit = F.element_at(F.create_map(*(F.lit(x) for c in known for x in (c, bounds[c]))), F.col("column"))
    return base.withColumn("threshold", limit).join(counts, "column", "left").join(listed, "column", "left").withColumn("n_over", F.coalesce("n_over", F.lit(0)))


def pauses(df: DataFrame, s: Series, spend: str, impressions: str | None, method: str = "zero_impressions", value: float = 0.0, low: float | None = None) -> DataFrame:
    """Null spend filled: with ``value`` where it is a pause, else with 0 and a flag. A pause has no impressions, or by
    ``spend_pattern`` a mean of the last seven rows under ``low``, the tenth percentile of those means; by any other method each
    null is one."""
    missing = F.col(spend).isNull()
    if method == "zero_impressions" and impressions:
        pause = missing & (F.coalesce(F.col(impressions), F.lit(0)) == 0)
    elif method == "spend_pattern" and low is not None:
        pause = missing & F.coalesce(rolling("mean", F.col(spend), s, 7, 1) < low, F.lit(False))
    elif impressions:
        pause = missing
    else:
        pause = F.lit(False)
    return df.withColumns({f"is_pause_{spend}": pause.cast("int"), f"adstock_continuity_{spend}": (missing & ~pause).cast("int"), spend: F.coalesce(F.col(spend), F.when(pause, F.lit(value)), F.lit(0.0))})
