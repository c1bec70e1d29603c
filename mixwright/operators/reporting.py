"""Nested report documents, published whole: one folder a run, renamed into place when all of it is written."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.operators import evaluation, matrix
from mixwright.sources.shared import exists, move, remove


def publish(spark: SparkSession, documents: dict[str, DataFrame], folder: str, run_id: str) -> str:
    """Each document (rows of nested columns) as JSON lines under ``folder``/``run_id``. All are written to a folder beside it
    first: a run that breaks off leaves nothing under its name, and a rerun takes the place of the whole earlier one."""
    if not run_id or "/" in run_id or run_id.startswith("_"):
        raise ValueError(f"no run id: {run_id!r}")
    target, staged, old = f"{folder}/{run_id}", f"{folder}/_writing-{uuid.uuid4().hex}", f"{folder}/_old-{uuid.uuid4().hex}"
    try:
        for name, rows in documents.items():
            rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{staged}/{name}")
        replaced = exists(spark, target)
        if replaced:
            move(spark, target, old)
        move(spark, staged, target)
    except BaseException:
        remove(spark, staged)
        if exists(spark, old) and not exists(spark, target):
            move(spark, old, target)
        raise
    remove(spark, old)
    return target


def channel_insights(spend: DataFrame, by: list[str], credit: DataFrame, roi: dict[str, float], default: float = 2.0, half: float = 1000.0) -> DataFrame:
    """``spend`` (by, channel, spend: a row a day), ``credit`` (by, channel, credit) -> by, channel, estimated_roi, saturation,
    saturation_level, attribution_share."""
    level = F.when(F.col("saturation") < 0.33, "low").when(F.col("saturation") < 0.66, "medium").otherwise("high")
    rows = spend.groupBy(*by, "channel").agg(F.avg(F.col("spend") / (F.col("spend") + half)).alias("saturation"))
    sums = credit.groupBy(*by, "channel").agg(F.sum("credit").alias("credit"))
    whole = sums.groupBy(*by).agg(F.sum("credit").alias("all_credit")) if by else sums.agg(F.sum("credit").alias("all_credit"))
    shares = (sums.join(whole, by) if by else sums.join(F.broadcast(whole), how="cross")).select(*by, "channel", F.try_divide("credit", "all_credit").alias("attribution_share"))  # one row if by is empty
    estimate = F.coalesce(*(F.when(F.col("channel") == c, F.lit(float(v))) for c, v in roi.items()), F.lit(default)) if roi else F.lit(default)
    return rows.join(shares, [*by, "channel"], "left").select(*by, "channel", estimate.alias("estimated_roi"), "saturation", level.alias("saturation_level"), F.coalesce("attribution_share", F.lit(0.0)).alias("attribution_share"))


def channel_advice(channel: Column) -> Column:
    """What to do about a channel, from its insights."""
    return F.filter(
        F.array(
            F.when((channel["estimated_roi"] > 4.0) & (channel["saturation_level"] != "high"), "raise: high return, not saturated"),
            F.when(channel["saturation_level"] == "high", "hold: saturated"),
            F.when(channel["estimated_roi"] < 1.5, "lower: low return"),
            F.when(channel["attribution_share"] > 0.3, "watch: much of the credit"),
        ),
        lambda x: x.isNotNull(),
    )


def moves(plan: DataFrame, by: list[str], k: int = 5, least: float = 5.0) -> DataFrame:
    """Of each group's best scenario the ``k`` largest relative changes of over ``least`` percent, largest first -> by, scenario,
    gain_pct, moves (array of channel, pct_change, recommendation, magnitude)."""
    sums = plan.groupBy(*by, "scenario").agg(F.sum("revenue_now").alias("now"), F.sum("revenue_best").alias("best"), F.sum("current").alias("c"), F.sum("optimised").alias("o"), F.collect_list(F.struct((-F.abs("pct_change")).alias("size"), "channel", "pct_change")).alias("all"), F.min("status").alias("status"))
    # Return on spend of the plan over that of the present split.
    gain = 100 * (F.try_divide(F.col("best") / F.col("o"), F.col("now") / F.col("c")) - 1)
    solved = sums.where((F.col("status") == "optimal") & (F.col("o") > 0) & (F.col("c") > 0)).withColumn("gain", gain)
    top = solved.groupBy(*by).agg(F.max_by(F.struct("scenario", "gain", "all"), F.struct(F.round("gain", 6), "scenario")).alias("b"))
    listed = F.filter(F.slice(F.array_sort(F.col("b.all")), 1, k), lambda x: F.abs(x["pct_change"]) > least)
    item = lambda x: F.struct(x["channel"].alias("channel"), x["pct_change"].alias("pct_change"), F.when(x["pct_change"] > 0, "increase").otherwise("decrease").alias("recommendation"), F.when(F.abs(x["pct_change"]) > 20, "major").otherwise("minor").alias("magnitude"))
    return top.select(*by, F.col("b.scenario").alias("scenario"), F.col("b.gain").alias("gain_pct"), F.transform(listed, item).alias("moves"))


def executive_advice(quality: Column, mape: Column, r2: Column, insights: Column, gain: Column, limits: dict[str, float] | None = None) -> Column:
    given = {"quality": 0.8, "mape": 0.15, "r2": 0.7, "roi": 4.0, "gain": 10.0} | (limits or {})
    high = F.transform(F.filter(insights, lambda c: c["estimated_roi"] > given["roi"]), lambda c: c["channel"])
    return F.filter(
        F.array(
            F.when(quality < given["quality"], "data quality is under its limit"), F.when(mape > given["mape"], "errors exceed their limit"), F.when(r2 < given["r2"], "little of the variation is explained"),
            F.when(F.size(high) > 0, F.concat(F.lit("high returns: "), F.array_join(high, ", "))), F.when(gain > given["gain"], "reallocation pays"),
        ),
        lambda x: x.isNotNull(),
    )


def executive(summary: DataFrame, by: list[str], insights: DataFrame, best: DataFrame, score: float | None = None) -> DataFrame:
    """A document a group: overview, key figures, channels, moves of budget, advice. ``summary`` has by, first_day, last_day,
    revenue, spend, mape, r2, coverage."""
    listed = insights.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("channel", "estimated_roi", "saturation", "saturation_level", "attribution_share"))).alias("channels"))  # a row a channel
    rows = summary.join(listed, by, "left").join(best, by, "left") if by else summary.join(F.broadcast(listed), how="cross").join(F.broadcast(best), how="cross")
    quality = F.lit(score).cast("double")
    return rows.select(
        *by, F.struct("first_day", "last_day", F.transform("channels", lambda c: c["channel"]).alias("channels_analyzed"), quality.alias("data_quality_score")).alias("overview"),
        F.struct("revenue", "spend", F.try_divide("revenue", "spend").alias("roi"), F.struct("mape", "r2", "coverage").alias("model_accuracy"), ((F.col("mape") <= 0.15) & (F.col("r2") >= 0.7) & (F.col("coverage") >= 0.8)).alias("passes")).alias("key_performance_metrics"),
        F.transform("channels", lambda c: c.withField("recommendations", channel_advice(c))).alias("channel_insights"), F.struct(F.col("scenario").alias("best_scenario"), "gain_pct", F.col("moves").alias("reallocations")).alias("optimization_insights"),
        executive_advice(quality, F.col("mape"), F.col("r2"), F.col("channels"), F.col("gain_pct")).alias("recommendations"),
    )


def dashboard(document: DataFrame, by: list[str], run_id: str) -> DataFrame:
    """What a dashboard reads, flat where it can be: summary figures, a row of figures a channel, the recommended plan."""
    c = F.col("channel_insights")
    changes = F.map_from_entries(F.transform(F.coalesce("optimization_insights.reallocations", F.array()), lambda m: F.struct(m["channel"], m["pct_change"])))
    advice = lambda x: F.when(F.coalesce(F.element_at(changes, x["channel"]), F.lit(0.0)) > 0, "increase").when(F.element_at(changes, x["channel"]) < 0, "decrease").otherwise("keep")
    return document.select(
        *by, F.lit(run_id).alias("run_id"),
        F.struct(F.col("key_performance_metrics.model_accuracy.r2").alias("model_accuracy"), F.col("overview.data_quality_score").alias("validation_score"), F.size(c).alias("total_channels"), F.ceil((F.datediff("overview.last_day", "overview.first_day") + 1) / 7).alias("analysis_period_weeks")).alias("summary_metrics"),
        F.transform(c, lambda x: F.struct(x["channel"].alias("channel"), x["estimated_roi"].alias("roi_estimate"), x["attribution_share"].alias("attribution_share"), x["saturation_level"].alias("saturation_level"), advice(x).alias("recommendation"))).alias("channel_data"),
        F.struct(F.col("optimization_insights.best_scenario").alias("recommended_scenario"), F.col("optimization_insights.gain_pct").alias("potential_improvement"), changes.alias("budget_changes")).alias("optimization_data"),
        F.struct(F.col("key_performance_metrics.passes").alias("evaluation_passed")).alias("metadata"),
    )


def metadata(df: DataFrame, target: str, day: str, run_id: str, backend: str = "pymc", config: dict[str, str] | None = None) -> DataFrame:
    """One document on a table that a model is fitted on: size, features by category without constant ones, statistics of the
    target, the calendar."""
    keys = {target, day}
    numbers = [c for c, t in df.dtypes if c not in keys and (t in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or t.startswith("decimal"))]
    variance = df.agg(*(F.var_samp(F.col(c).cast("double")).alias(c) for c in numbers)).first()
    flat = [c for c in numbers if variance[c] is None or variance[c] < 1e-12]
    kinds: dict[str, list[str]] = {}
    for c in numbers:
        if c not in flat:
            kinds.setdefault(matrix.category(c), []).append(c)
    strings = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    span = df.agg(F.count("*").alias("n_observations"), F.min(day).alias("first"), F.max(day).alias("last"), F.count_distinct(day).alias("periods"))
    parts = evaluation.target_stats(df, target).select(F.struct("*").alias("target_stats"))
    gaps = matrix.frequency(df, day)
    one = span.join(F.broadcast(parts), how="cross").join(F.broadcast(gaps), how="cross")  # one row each
    return one.select(
        F.lit(run_id).alias("run_id"), F.lit(backend).alias("backend"), "n_observations", F.lit(len(numbers)).alias("n_features"), strings(numbers).alias("feature_names"), F.lit(target).alias("target_name"), "target_stats",
        F.struct(F.col("first").alias("start"), F.col("last").alias("end"), "periods", "frequency").alias("date_range"), strings(flat).alias("constant_features"),
        F.map_from_arrays(strings(sorted(kinds)), F.array(*(strings(kinds[k]) for k in sorted(kinds)))).alias("features") if kinds else F.create_map().cast("map<string,array<string>>").alias("features"),
        (F.create_map(*(F.lit(x) for kv in (config or {}).items() for x in kv)) if config else F.create_map()).cast("map<string,string>").alias("model_config"),
    )


def metadata_errors(document: dict) -> list[str]:
    """What a metadata document lacks or contradicts."""
    missing = [f"missing: {k}" for k in ("n_observations", "n_features", "feature_names", "target_name", "backend") if document.get(k) is None]
    names, n = document.get("feature_names"), document.get("n_features")
    return missing + ([f"{len(names)} names for {n} features"] if names is not None and n is not None and len(names) != n else [])
