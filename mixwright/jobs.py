"""The stages of a measurement run: each reads the tables of the one before and writes its own, as Parquet and JSON lines.

A stage that fails raises; none is left out in silence. All tables go through Spark, whatever their size; what the driver
holds is a row a channel or a check.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.functions import calendar, media
from mixwright.functions.windows import Series
from mixwright.operators import audit, baseline, budget, cleaning, evaluation, fatigue, fitting, market, matrix, merging, quality, reporting, validation
from mixwright.settings import Settings, load, problems
from mixwright.sources import files


def _resolved(df: DataFrame, settings: Settings) -> tuple[DataFrame, dict[str, list[str]]]:
    d = settings.data
    return matrix.Roles(d.date_col, d.brand_key, d.region_key, d.revenue_col, tuple(d.channel_map.items())).resolve(df)


def _series(roles: dict[str, list[str]]) -> Series:
    return Series((*roles["brand"], *roles["region"]), roles["day"][0])


def _at(settings: Settings, folder: str, name: str) -> str:
    return f"{getattr(settings.paths, folder)}/{name}"


def ingest(spark: SparkSession, settings: Settings, schema: str | None = None, days: int | None = None, slice_hint: str | None = None) -> DataFrame:
    """The raw table (CSV by ``schema``, else Parquet), cut to the last ``days`` or by a hint such as last_12_weeks. A table that
    lacks its day, keys, revenue or all spend columns is refused."""
    source = settings.paths.raw
    df = files.read_csv(spark, source, schema) if schema else spark.read.parquet(source)
    named, roles = _resolved(df, settings)
    missing = [c for c in roles["revenue"] if c not in named.columns] + ([] if roles["spend"] else ["any spend column"])
    if missing:
        raise KeyError(f"the raw table lacks {', '.join(missing)}")
    days = days or (cleaning.hinted_days(slice_hint) if slice_hint else None)
    if days:
        df = cleaning.latest(df, settings.data.date_col, days)
    files.write_features(df, _at(settings, "interim", "ingested"))
    return spark.read.parquet(_at(settings, "interim", "ingested"))


def validate(spark: SparkSession, settings: Settings) -> DataFrame:
    """A row a check with its penalty, and the score beside it. Rows that break a rule are written apart, with what they break."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "interim", "ingested")), settings)
    day, keys, revenue = roles["day"][0], [*roles["brand"], *roles["region"]], roles["revenue"][0]
    limits = {"missing": 100 * settings.validation.data_quality.get("missing_data_threshold", 0.2)}
    rules = audit.rules_of(day, revenue, roles["spend"])
    _, bad = audit.routed(df, rules, _at(settings, "interim", "routed"))
    files.write_json(audit.broken_counts(bad, list(rules)), _at(settings, "reports", "broken_rules"))
    checks = validation.report(df, day, keys, revenue, roles["spend"], roles["click"], roles["impression"], settings.validation.min_weeks_per_market, limits=limits, rules=rules)
    files.write_features(checks, _at(settings, "reports", "checks"))
    report = spark.read.parquet(_at(settings, "reports", "checks"))
    files.write_json(validation.scored(report), _at(settings, "reports", "score"))
    return report


def transform(spark: SparkSession, settings: Settings) -> DataFrame:
    """Cleaned rows: negative revenue apart, caps by month that leave promotions and launches alone, one row a key by the roles of
    columns, pauses filled, known outcomes; with the counts of every step, taken while it is written, and the lineage."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "interim", "ingested")), settings)
    given = settings.validation.rest.get("enhanced_cleaning") or {}
    part = lambda name: given.get(name) or {}
    s, revenue = _series(roles), roles["revenue"][0]
    log = audit.Audit(part("documentation").get("document_all_changes", True))
    df = log.step(df, "read")
    df = cleaning.negatives(df, revenue, f"{revenue}_returns", f"has_{revenue}_returns")
    for c in roles["spend"]:
        df = cleaning.negatives(df, c, f"{c}_adjustments", f"has_{c}_adjustments")
    df = cleaning.clipped(df, roles["impression"] + roles["click"])
    df = log.step(df, "negatives moved apart", revenue=F.sum(f"has_{revenue}_returns"), **{c: F.sum(f"has_{c}_adjustments") for c in roles["spend"]})
    policy = merging.Policy.of(part("duplicates"))
    policy = replace(policy, also_additive=(revenue, *roles["spend"], *roles["impression"], *roles["click"], f"{revenue}_returns", *(f"{c}_adjustments" for c in roles["spend"])))
    df = log.step(merging.merged(df, [*s.by, s.order], policy), "one row a key", merged=F.count_if(F.col("_rows") > 1)).drop("_rows")
    promo = next((c for c in df.columns if "promo" in c), None)
    for c in roles["spend"]:
        df = cleaning.exempt(df.withColumn("_month", F.month(s.order)), s, c, promo)
        df = log.step(df, f"{c}: exempt from caps", "detailed", exempt=F.count_if("exempt"))
        df = cleaning.winsorized(df, [*s.by, "_month"], c, settings.validation.outlier_threshold)
        df = log.step(df, f"{c}: capped", capped=F.count_if(F.col("capped") != F.col(c))).withColumn(c, F.col("capped")).drop("capped", "cap", "exempt", "_month")
    missing = part("missing_data")
    for c in roles["spend"]:
        seen = next((i for i in roles["impression"] if i.startswith(c.removesuffix("_spend"))), None)
        df = audit.pauses(df, s, c, seen, missing.get("pause_detection_method", "zero_impressions"), missing.get("paused_spend_value", 0.0))
    df = log.step(df, "null spend filled", **{f"{kind}_{c}": F.sum(f"{name}_{c}") for c in roles["spend"] for kind, name in (("pauses", "is_pause"), ("gaps", "adstock_continuity"))})
    df = log.step(cleaning.with_outcome(df, revenue), "known outcomes")
    files.write_features(df, _at(settings, "interim", "cleaned"))
    files.write_json(log.rows(spark).coalesce(1), _at(settings, "reports", "cleaning"))
    df = spark.read.parquet(_at(settings, "interim", "cleaned"))
    files.write_json(cleaning.fingerprint(df.select(*s.by, s.order)), _at(settings, "reports", "lineage"))
    return df


def _response(x: Column, s: Series, carry: dict, curve: dict) -> tuple[Column, Callable[[Column], Column]]:
    kind = carry.get("type", "geometric")
    y = media.weibull(x, s, media.weibull_kernel(carry["shape"], carry["scale"], carry.get("lags", 8))) if kind == "weibull" else media.geometric(x, s, carry.get("decay", carry.get("lambda", 0.5)))
    if curve.get("type") == "logistic":
        return y, lambda c: media.logistic(c, s, curve.get("k", 6.0), curve.get("x0", 0.5))
    return y, lambda c: media.hill(c, s, curve.get("k", 0.5), curve.get("s", 1.0))


def features(spark: SparkSession, settings: Settings) -> DataFrame:
    """Wear of creatives where settings ask for it, carry-over and saturation of each channel, waves, weekdays, holidays and trend,
    external events and campaigns, and the terms of competition and promotion, of each series."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "interim", "cleaned")), settings)
    s, names, f = _series(roles), {c.lower(): n for n, c in settings.data.channel_map.items()}, settings.features
    day, revenue, spend = F.col(s.order), F.col(roles["revenue"][0]).cast("double"), roles["spend"]
    (wear, _), seasonal = f.wear(), f.seasonal()
    own = {"least": wear["least"], "window": wear["window"], "gap": wear["gap"]} if wear["method"] == "spend_change" else {"threshold": wear["threshold"], "gap": wear["gap"]} if wear["method"] == "campaign_launch" else {}
    for c in spend if wear["enabled"] else ():
        df = fatigue.refreshes(df, s, c, wear["method"], **own)
        df = df.withColumn(f"creative_fatigue_{c}", fatigue.worn(day, F.col("refreshed"), s, wear["half_life"], wear["floor"])).drop("refreshed")
    worn = lambda x, c, stage: x * F.col(f"creative_fatigue_{c}") if wear["enabled"] and wear["stage"] == stage else x
    made = [(c, *_response(worn(F.col(c), c, "raw"), s, f.carry_over(names[c]), f.response(names[c]))) for c in spend]
    df = df.select("*", *(y.alias(f"{c}_adstocked") for c, y, _ in made))
    df = df.withColumns({f"{c}_adstocked": worn(F.col(f"{c}_adstocked"), c, "adstocked") for c in spend})
    df = df.select("*", *(curve(F.col(f"{c}_adstocked")).alias(f"{c}_adstocked_saturated") for c, _, curve in made))
    columns = calendar.fourier(day, seasonal["fourier_terms"]) | {f"dow_{n}": (F.weekday(day) == n).cast("int") for n in range(6)} | {"is_weekend": (F.weekday(day) >= 5).cast("int"), "trend": F.datediff(day, F.min(day).over(s.whole())) / 365.25}
    for e in f.baseline.get("external_events") or []:
        columns |= baseline.event(day, e["name"], str(e["start"]), str(e["end"]), e.get("impact_type", "step"))
    for c in f.custom_terms.get("campaigns") or []:
        columns |= market.campaign(day, str(c["campaign_name"]), str(c["start_date"]), str(c["end_date"]), c.get("discount_pct"), c.get("budget"))
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in spend[1:]), F.coalesce(F.col(spend[0]), F.lit(0.0)))
    if (f.custom_terms.get("promo_flag") or {}).get("enabled"):
        until = (settings.training.get("train_end") or None) and (day <= F.lit(str(settings.training["train_end"])).cast("date"))
        found = market.promotions(revenue, total, s, training=until if until is not None else None)
        columns |= {f"detected_{n}": F.coalesce(c, F.lit(0)) for n, c in found.items()}  # made from the target: no columns of the model
    if f.competitors.get("enabled"):
        indices = market.indices(spend)
        columns |= {f"competitor_{n}": c for n, c in (*indices.items(), *market.background(day, total, s).items())}
    df = df.withColumns(columns)
    years = df.agg(F.year(F.min(day)).alias("a"), F.year(F.max(day)).alias("b")).first()
    if seasonal["holiday_calendar"] == "US" and years.a:
        shifts = {"": 0} | {f"_{e}": {"before": -1, "after": 1}[e] for e in seasonal["holiday_effects"] or []}
        near = calendar.holiday_table(spark, years.a, years.b).withColumn("end", F.explode(F.array(*map(F.lit, shifts))))
        shift = F.coalesce(*(F.when(F.col("end") == e, F.lit(n)) for e, n in shifts.items()))
        kinds = sorted({n for _, n in calendar.holidays(years.a, years.a)})
        flags = near.groupBy(F.date_add("holiday_date", shift).alias(s.order)).agg(*(F.max(((F.col("holiday") == n) & (F.col("end") == e)).cast("int")).alias(f"holiday_{n}{e}") for n in kinds for e in shifts))
        df = df.join(F.broadcast(flags), s.order, "left").fillna(0, [c for c in flags.columns if c != s.order])  # some forty days a year
    files.write_features(df, _at(settings, "features", "features"))
    return spark.read.parquet(_at(settings, "features", "features"))


def _chosen(df: DataFrame, roles: dict[str, list[str]], settings: Settings) -> fitting.Selection:
    return fitting.select(df, roles["revenue"][0], roles["spend"], settings.model.backend_params.get("allow_target_derived", False))


def train(spark: SparkSession, settings: Settings) -> DataFrame:
    """(position, term, value): the coefficients of the likelihood that settings name, without constant columns; and the model
    itself beside them."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "features", "features")), settings)
    chosen = _chosen(df, roles, settings)
    constant = fitting.check_inputs(df, chosen)["constant"]
    model = fitting.Estimator(settings.model.likelihood).fit(df, [c for c in chosen.features if c not in constant], chosen.target, chosen.channels)
    model.save(spark, _at(settings, "models", "model"))
    return spark.read.parquet(_at(settings, "models", "model") + "/coefficients")


def evaluate(spark: SparkSession, settings: Settings) -> DataFrame:
    """Errors of the fitted rows, by series and all together; of the last fifth of each series; trend, drift and months; score."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "features", "features")), settings)
    model = fitting.Fitted.load(spark, _at(settings, "models", "model"))
    revenue, s = roles["revenue"][0], _series(roles)
    rows = df.select(*s.by, s.order, F.col(revenue).cast("double").alias("actual"), model.predicted(df).alias("guess"))
    files.write_features(rows, _at(settings, "interim", "predictions"))
    rows = spark.read.parquet(_at(settings, "interim", "predictions"))
    out = evaluation.core_metrics(rows, "actual", "guess")
    trend = evaluation.trend_consistency(rows, s, "actual", "guess")
    files.write_json(out, _at(settings, "reports", "metrics"))
    files.write_json(evaluation.part_metrics(rows, list(s.by), "actual", "guess"), _at(settings, "reports", "metrics_by_series"))
    files.write_json(evaluation.part_metrics(evaluation.holdout(rows, s), ["part"], "actual", "guess"), _at(settings, "reports", "holdout"))
    files.write_json(trend, _at(settings, "reports", "trend"))
    files.write_json(evaluation.drift(rows, s, "actual", "guess"), _at(settings, "reports", "drift"))
    files.write_json(evaluation.seasonal(rows, list(s.by), s.order, "actual", "guess"), _at(settings, "reports", "seasonal"))
    files.write_json(evaluation.overall(spark.read.json(_at(settings, "reports", "metrics")), spark.read.json(_at(settings, "reports", "trend"))), _at(settings, "reports", "model_score"))
    return spark.read.json(_at(settings, "reports", "metrics"))


def _by_channel(df: DataFrame, roles: dict[str, list[str]]) -> DataFrame:
    """(channel, spend): a row a day and channel, over all series."""
    daily = df.groupBy(roles["day"][0]).agg(*(F.sum(c).alias(c.removesuffix("_spend")) for c in roles["spend"]))
    return quality.long(daily, [], [c.removesuffix("_spend") for c in roles["spend"]], value="spend")


def _roi(settings: Settings) -> dict[str, float]:
    """The middle of each channel's prior, by the name of its spend column."""
    names = {n: c.lower().removesuffix("_spend") for n, c in settings.data.channel_map.items()}
    return {names.get(n, n): sum(b) / 2 for n, b in (settings.model.priors.get("roi_bounds") or {}).items()}


def optimize(spark: SparkSession, settings: Settings) -> DataFrame:
    """Budgets by scenario and channel, within each channel's bounds, after the scenario's moves; and returns under noise."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "interim", "cleaned")), settings)
    names = {n: c.lower().removesuffix("_spend") for n, c in settings.data.channel_map.items()}
    o = settings.optimization
    shares, rest = o.shares()
    curves = budget.bounded(budget.response_curves(_by_channel(df, roles), [], _roi(settings)), {names.get(n, n): b for n, b in shares.items()}, rest)
    scenarios = spark.createDataFrame(o.multipliers(), "scenario string, budget_multiplier double")
    moves = [(a, names.get(c, c), x) for a, c, x in o.adjustments()]
    moved = spark.createDataFrame(moves, "scenario string, channel string, factor double") if moves else None
    files.write_features(budget.allocate(curves, scenarios, [], moved).coalesce(1), _at(settings, "reports", "plan"))
    files.write_json(budget.robust(curves, scenarios, [], 100, moved).coalesce(1), _at(settings, "reports", "returns"))
    return spark.read.parquet(_at(settings, "reports", "plan"))


def report(spark: SparkSession, settings: Settings, run_id: str | None = None) -> DataFrame:
    """Executive, dashboard, channel and diagnostic documents of the run, published whole under its id."""
    df, roles = _resolved(spark.read.parquet(_at(settings, "interim", "cleaned")), settings)
    plan, run_id = spark.read.parquet(_at(settings, "reports", "plan")), run_id or spark.sparkContext.applicationId
    read = lambda name: spark.read.json(_at(settings, "reports", name))
    spend = _by_channel(df, roles)
    whole = quality.summary(df, roles["day"][0], roles["revenue"][0], roles["spend"])
    facts = whole.join(F.broadcast(read("metrics")), how="cross")  # one row each
    credit = spend.select("channel", F.col("spend").alias("credit"))
    insights = reporting.channel_insights(spend, [], credit, _roi(settings))
    score = read("score").first().score
    executive = reporting.executive(facts, [], insights, reporting.moves(plan, []), float(score))
    model = fitting.Fitted.load(spark, _at(settings, "models", "model"))
    diagnostics = read("metrics").select(F.struct("*").alias("metrics"), F.to_json(F.create_map(*(F.lit(str(x)) for kv in model.summary().items() for x in kv))).alias("fit"))
    documents = {
        "executive": executive, "dashboard": reporting.dashboard(executive, [], run_id), "diagnostics": diagnostics, "moves": evaluation.top_moves(plan), "reallocation": evaluation.reallocation(plan),
        "contributions": spark.createDataFrame(model.contributions() or [], "channel string, contribution double, share_pct double"),
    }
    path = reporting.publish(spark, documents, _at(settings, "reports", "runs"), run_id)
    return spark.read.json(f"{path}/dashboard")


STAGES = {f.__name__: f for f in (ingest, validate, transform, features, train, evaluate, optimize, report)}


def run(spark: SparkSession, settings: Settings, run_id: str | None = None, **of_ingest) -> DataFrame:
    ingest(spark, settings, **of_ingest)
    for name in ("validate", "transform", "features", "train", "evaluate", "optimize"):
        STAGES[name](spark, settings)
    return report(spark, settings, run_id)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="mixwright", description=__doc__)
    parser.add_argument("stage", choices=[*STAGES, "run", "config-check"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--profile")
    parser.add_argument("--schema", help="columns of a raw CSV file, as 'name type, ...'")
    parser.add_argument("--days", type=int)
    parser.add_argument("--slice", help="such as last_12_weeks, last_6_months or last_90_days")
    parser.add_argument("--run-id", help="the name that reports are published under")
    given = parser.parse_args(arguments)
    settings = load(given.config, given.profile)
    if given.stage == "config-check":
        found = problems(settings)
        print("\n".join(found) or "no problem found")
        if found:
            raise SystemExit(1)
        return
    spark = SparkSession.builder.appName(f"mixwright {given.stage}").config("spark.sql.session.timeZone", settings.data.timezone).getOrCreate()
    extra = {"schema": given.schema, "days": given.days, "slice_hint": given.slice} if given.stage in ("ingest", "run") else {}
    extra |= {"run_id": given.run_id} if given.stage in ("report", "run") else {}
    out = run(spark, settings, **extra) if given.stage == "run" else STAGES[given.stage](spark, settings, **extra)
    out.show(truncate=False)


if __name__ == "__main__":
    main()
