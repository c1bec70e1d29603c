"""Multi-touch attribution: credit for conversions to the touches before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODELS = ("first", "last", "linear", "time_decay", "position")


def eligible(touches: DataFrame, conversions: DataFrame, click_days: int = 7, view_days: int = 1, click_first: bool = True) -> DataFrame:
    """Touches of the same user in the window of their type before a conversion, both ends included. Of touches at the same
    time only those of the type that goes first stay. They are joined by user and day: a conversion asks for each day of its
    window, so that a busy user's touches are dealt by day. Ages are exact: a part of a second beyond the window is outside."""
    window = F.when(F.col("t.interaction_type") == "click", F.make_dt_interval(F.lit(click_days))).when(F.col("t.interaction_type") == "view", F.make_dt_interval(F.lit(view_days)))
    age = F.col("c.ts") - F.col("t.ts")
    inside = (F.col("t.ts") <= F.col("c.ts")) & (age <= window)
    last = F.to_date(F.col("ts").cast("timestamp"))
    asked = conversions.withColumn("day", F.explode(F.sequence(F.date_sub(last, max(click_days, view_days)), last)))
    dealt = touches.withColumn("day", last)
    joined = asked.alias("c").join(dealt.alias("t"), (F.col("c.user_id") == F.col("t.user_id")) & (F.col("c.day") == F.col("t.day")) & inside)
    rows = joined.select("c.conversion_id", "c.conversion_value", F.col("c.ts").alias("conversion_ts"), "t.event_id", "t.ts", "t.channel", "t.interaction_type")
    rank = F.when((F.col("interaction_type") == "click") == F.lit(click_first), 0).otherwise(1)
    return rows.withColumn("_rank", rank).withColumn("_best", F.min("_rank").over(Window.partitionBy("conversion_id", "ts"))).where("_rank = _best").drop("_rank", "_best")


def credited(rows: DataFrame, model: str, view_weight: float = 1.0, half_life_days: float = 7.0, overlap_penalty: float = 0.0, least_kept: float = 0.1, penalty: str = "linear") -> DataFrame:
    """``rows`` of eligible touches with credit. first and last give all to one touch, the others share the whole value. Of several touches each loses: ``overlap_penalty`` a further touch, or by ``exponential`` that part of
    what is left."""
    if penalty not in ("linear", "exponential"):
        raise ValueError("a penalty is linear or exponential")
    if model not in MODELS:
        raise ValueError(f"model must be one of {MODELS}")
    of = Window.partitionBy("conversion_id")
    order = of.orderBy("ts", F.asc_nulls_last("event_id"))
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn("n", F.count("*").over(of)).withColumn("last_ts", F.max("ts").over(of))
    seen = F.when(F.col("interaction_type") == "view", view_weight).otherwise(1.0)
    value = F.col("conversion_value")
    if model in ("first", "last"):
        credit = F.when(F.col("place") == (1 if model == "first" else F.col("n")), value * seen).otherwise(0.0)
    else:
        rows = rows.withColumn("weight", _weight(model, half_life_days) * seen)
        # Weights by place are summed by place, others least first, which errs least: shares don't depend on the order of rows.
        whole = (order if model == "position" else of.orderBy("weight")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        credit = F.try_divide(value * F.col("weight"), F.sum("weight").over(whole))
    rows = rows.withColumn("credit", credit)
    if overlap_penalty:
        further = overlap_penalty * (F.col("n") - 1)
        left = 1 - further if penalty == "linear" else F.exp(-further)
        rows = rows.withColumn("credit", F.when(F.col("n") > 1, F.col("credit") * F.greatest(left, F.lit(least_kept))).otherwise(F.col("credit")))
    return rows.where("credit > 0").select("conversion_id", "conversion_value", "conversion_ts", "event_id", "ts", "channel", "interaction_type", "n", "credit")


def _weight(model: str, half_life_days: float) -> Column:
    if model == "linear":
        return F.lit(1.0)
    if model == "time_decay":
        days = F.date_part(F.lit("days"), F.col("last_ts") - F.col("ts"))  # whole ones
        return F.exp(days * (-0.6931471805599453 / half_life_days))
    n, place = F.col("n"), F.col("place")
    # Shares of the first, the last and the middle touches.
    middle = 0.2 / F.greatest(n - 2, F.lit(1)) * 0.4
    return F.when(n <= 2, 1.0).when((place == 1) | (place == n), 0.4).otherwise(middle)


def by_channel_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.to_date("conversion_ts").alias("day"), "channel").agg(F.sum("credit").alias("credit"), F.count("*").alias("touches"), F.avg("credit").alias("mean_credit"))


def metrics(rows: DataFrame, conversions: DataFrame) -> DataFrame:
    """Coverage and touches per conversion, one row."""
    each = rows.groupBy("conversion_id").agg(F.count("*").alias("touches"), F.sum("credit").alias("credit"))
    joined = conversions.join(each, "conversion_id", "left")
    return joined.agg(
        F.count("*").alias("conversions"), F.count("touches").alias("attributed"), F.avg("touches").alias("mean_touches"), F.percentile("touches", 0.5).alias("median_touches"), F.max("touches").alias("max_touches"),
        F.avg((F.col("touches") == 1).cast("int")).alias("single_rate"), F.try_divide(F.sum("credit"), F.sum("conversion_value")).alias("value_ratio"),
    )


def weekly_features(rows: DataFrame, channels: list[str]) -> DataFrame:
    """Credit, summed as decimals, by channel, a column each, and how many channels a conversion meets, by week; 0 where there is nothing."""
    week = F.to_date(F.date_trunc("week", "conversion_ts"))
    rows = rows.withColumn("week", week)
    wide = rows.groupBy("week").pivot("channel", channels).agg(F.sum(F.col("credit").cast("decimal(28,8)")).cast("double"))
    wide = wide.select("week", *(F.col(c).alias(f"{c}_value") for c in channels))
    each = rows.groupBy("week", "conversion_id").agg(F.count_distinct("channel").alias("channels"), F.sum(F.col("credit").cast("decimal(28,8)")).cast("double").alias("credit"))
    cross = each.groupBy("week").agg(F.avg("channels").alias("mean_channels"), F.max("channels").alias("max_channels"), F.avg("credit").alias("mean_credit"))
    return wide.join(cross, "week", "full").fillna(0)


def fallback(panel: DataFrame, columns: dict[str, str], keys: list[str]) -> DataFrame:
    """Spend or impressions as credit, a row for each channel with any."""
    renamed = panel.select(*keys, *(F.col(c).cast("double").alias(name) for name, c in columns.items()))
    return renamed.unpivot(keys, list(columns), "channel", "credit").where("credit > 0")


def conversion_columns(df: DataFrame, keys: list[str], value: float = 100.0) -> DataFrame:
    """Conversions under their common names: the first of conversion_value, revenue and sales that is there, else a constant;
    conversion_id and user_id, where missing, from a digest of ``keys`` and a number among rows alike in them, which takes no
    order of the whole table."""
    names = {c.lower(): c for c in df.columns}
    worth = [F.col(names[c]) for c in ("conversion_value", "revenue", "sales") if c in names]
    day = next((names[c] for c in ("ts", "timestamp", "date", "date_day") if c in names), None)
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys)).cast("binary"))
    number = F.concat(digest, F.lit("_"), F.row_number().over(Window.partitionBy(digest).orderBy(*df.columns)).cast("string"))
    made = {"conversion_value": F.coalesce(*worth, F.lit(value)).cast("double")}
    if "conversion_id" not in names:
        made["conversion_id"] = F.concat(F.lit("conv_"), number)
    if "user_id" not in names:
        made["user_id"] = number
    if day and day != "ts":
        made["ts"] = F.col(day)
    return df.withColumns(made)


def interaction_type(df: DataFrame, metrics: tuple[str, ...] = ("clicks", "impressions", "views")) -> DataFrame:
    """Rows with one interaction_type for all: that of the first metric with anything in it."""
    sums = df.agg(*(F.sum(c).alias(c) for c in metrics if c in df.columns))
    kind = F.coalesce(*(F.when(F.col(f"_s.{c}") > 0, F.lit(c.removesuffix("s"))) for c in metrics if c in df.columns), F.lit("unknown"))
    return df.join(F.broadcast(sums.select(F.struct("*").alias("_s"))), how="cross").withColumn("interaction_type", kind).drop("_s")  # one row


def conservation(rows: DataFrame, conversions: DataFrame) -> DataFrame:
    """Credit over the value of all conversions, share of conversions with credit, largest share of a channel; one row."""
    every = conversions.agg(F.sum("conversion_value").alias("value"), F.count("*").alias("n"))
    given = rows.agg(F.sum("credit").alias("credit"), F.count_distinct("conversion_id").alias("attributed"))
    top = rows.groupBy("channel").agg(F.sum("credit").alias("c")).agg(F.max("c").alias("most"))
    one = every.join(F.broadcast(given), how="cross").join(F.broadcast(top), how="cross")
    return one.select(F.try_divide("credit", "value").alias("conserved"), F.try_divide(F.col("attributed").cast("double"), F.col("n")).alias("covered"), F.try_divide("most", "credit").alias("dominance"))


def reconciled(platform: DataFrame, model: DataFrame, keys: list[str], tolerance: float = 0.3) -> DataFrame:
    """Credit as two sources have it (``keys``, credit), side by side -> keys, platform, model, difference, difference_pct, side,
    within_tolerance. What one side lacks is kept, as 0, and named; nothing is within tolerance of a reported 0 but 0."""
    sums = lambda df, name: df.groupBy(*keys).agg(F.sum("credit").alias(name))
    both = sums(platform, "platform").join(sums(model, "model"), keys, "full")
    side = F.when(F.col("platform").isNull(), "model only").when(F.col("model").isNull(), "platform only").otherwise("both")
    rows = both.withColumn("side", side).fillna(0.0, ["platform", "model"]).withColumn("difference", F.col("model") - F.col("platform"))
    pct = F.try_divide("difference", F.when(F.col("platform") != 0, F.col("platform")))
    return rows.withColumn("difference_pct", pct).withColumn("within_tolerance", F.coalesce(F.abs("difference_pct") < tolerance, (F.col("platform") == 0) & (F.col("model") == 0)))
