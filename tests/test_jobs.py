"""A whole run on a small table, and settings."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from mixwright import jobs, settings
from mixwright.operators import cleaning, fitting
from mixwright.sources.panel import panel

CONFIG = """
paths: {{raw: "{0}/raw", interim: "{0}/interim", models: "{0}/models", features: "{0}/features", reports: "{0}/reports"}}
data: {{date_col: DATE_DAY, brand_key: brand, region_key: region, revenue_col: revenue, channel_map: {{search: SEARCH_SPEND, tiktok: tiktok_spend, display: display_spend, facebook: facebook_spend}}}}
features: {{adstock: {{platform_overrides: {{tiktok: {{type: weibull, shape: 2.0, scale: 3.0}}}}}}, saturation: {{platform_overrides: {{display: {{type: logistic, k: 5.0}}}}}}, seasonality: {{fourier_terms: 2}}, creative_fatigue: {{enabled: true, refresh_signal: campaign_launch}}, baseline: {{external_events: [{{name: strike, start: 1996-05-01, end: 1996-05-20}}]}}, custom_terms: {{promo_flag: {{enabled: true}}, campaigns: [{{campaign_name: spring, start_date: 1996-03-10, end_date: 1996-03-24, discount_pct: 0.2}}]}}, competitors: {{enabled: true}}}}
model: {{likelihood: student_t, priors: {{roi_bounds: {{search: [1, 5]}}}}}}
optimization: {{platform_constraints: {{default_max_spend_pct: 0.5, platform_specific: {{display: {{min_spend_pct: 0.3, max_spend_pct: 0.5}}}}}}, scenario_presets: {{low: 0.8, high: {{budget_multiplier: 1.2, platform_adjustments: {{tiktok: 2.0}}}}}}}}
reports: {{}}
"""


def test_a_run_from_raw_table_to_report(spark, sf_dir, tmp_path):
    (tmp_path / "profiles").mkdir()
    (tmp_path / "main.yaml").write_text(CONFIG.format(tmp_path))
    (tmp_path / "profiles" / "small.yaml").write_text("validation: {min_weeks_per_market: 10}\n")
    config = settings.load(tmp_path / "main.yaml", "small")
    assert config.validation.min_weeks_per_market == 10 and config.features.carry_over("search") == {"type": "geometric", "decay": 0.5}
    raw = panel(spark, sf_dir).withColumn("ingestion_ts", F.current_timestamp()).withColumn("is_live", F.lit(True)).withColumn("note", F.lit("n")).withColumn("search_ctr", F.lit(0.25))
    again = raw.limit(20).withColumn("note", F.lit("later")).withColumn("ingestion_ts", F.current_timestamp() + F.expr("interval 1 day"))
    paused = raw.withColumn("tiktok_spend", F.when(F.dayofmonth("date_day") % 7 != 0, F.col("tiktok_spend")))
    paused.unionByName(again).write.parquet(config.paths.raw)
    row = jobs.run(spark, config, "first run").first()
    assert row.optimization_data.recommended_scenario in ("current", "low", "high") and 0 <= row.summary_metrics.validation_score <= 1 and row.run_id == "first run"
    plan = spark.read.parquet(f"{config.paths.reports}/plan").collect()
    assert {r.scenario for r in plan} == {"current", "low", "high"} and {r.channel for r in plan} == {"search", "tiktok", "display", "facebook"}
    for scenario, factor in (("current", 1.0), ("low", 0.8), ("high", 1.2)):
        mine = {r.channel: r for r in plan if r.scenario == scenario}
        total = sum(r.optimised for r in mine.values())
        assert total == pytest.approx(factor * sum(r.current for r in mine.values()))
        assert 0.3 - 1e-9 <= mine["display"].optimised / total <= 0.5 + 1e-9, "settings give display 30 to 50 percent"
        assert {r.status for r in mine.values()} == {"optimal"}
    moved = {s: {r.channel: r.current for r in plan if r.scenario == s} for s in ("current", "high")}
    assert moved["high"]["tiktok"] > moved["current"]["tiktok"] and sum(moved["high"].values()) == pytest.approx(sum(moved["current"].values()))
    made = spark.read.parquet(f"{config.paths.features}/features")
    assert {"search_spend_adstocked_saturated", "holiday_christmas", "external_strike", "promo_spring_ramp", "dow_0", "competitor_hhi", "creative_fatigue_search_spend", "holiday_easter_after", "sin_year_2"} <= set(made.columns)
    cleaned = spark.read.parquet(f"{config.paths.interim}/cleaned")
    assert cleaned.count() == raw.count() and dict(cleaned.dtypes)["ingestion_ts"] == "timestamp" and dict(cleaned.dtypes)["is_live"] == "boolean"
    assert cleaned.agg(F.max("search_ctr"), F.count_if(F.col("note") == "later")).first() == (0.25, 20), "rates are averaged, strings are the latest"
    log = {(r.action, r.metric): r.value for r in spark.read.json(f"{config.paths.reports}/cleaning").collect()}
    assert log["read", "rows"] == raw.count() + 20 and log["one row a key", "merged"] == 20 and log["one row a key", "rows"] == raw.count()
    filled = paused.unionByName(again).groupBy("date_day", "brand", "region").agg(F.sum("tiktok_spend").alias("x")).where("x is null").count()
    assert log["null spend filled", "pauses_tiktok_spend"] + log["null spend filled", "gaps_tiktok_spend"] == filled > 0
    checks = {r.check: r.status for r in spark.read.parquet(f"{config.paths.reports}/checks").collect()}
    assert len(checks) == 12 and checks["keys"] == "failed" and checks["schema"] == "passed"
    assert spark.read.parquet(f"{config.paths.interim}/routed").count() == raw.count() + 20
    model = fitting.Fitted.load(spark, f"{config.paths.models}/model")
    assert model.likelihood == "student_t" and "search_spend_adstocked_saturated" in model.features and len(model.contributions()) == 4
    jobs.report(spark, config, "second run")
    assert {p.name for p in (tmp_path / "reports" / "runs").iterdir() if not p.name.startswith(".")} == {"first run", "second run"}


def test_raw_tables_are_refused_without_their_columns(spark, sf_dir, tmp_path):
    (tmp_path / "main.yaml").write_text(CONFIG.format(tmp_path))
    config = settings.load(tmp_path / "main.yaml")
    panel(spark, sf_dir).drop("revenue").write.parquet(config.paths.raw)
    with pytest.raises(KeyError):
        jobs.ingest(spark, config)
    assert [cleaning.hinted_days(h) for h in ("last_12_weeks", "last_6_months", "last_90_days", "all")] == [84, 180, 90, None]


def test_settings_are_checked():
    made = lambda section, given: settings.bound(settings.Settings, {section: given})
    for section, given in (
        ("model", {"backend": "other"}), ("model", {"priors": {"roi_bounds": {"tv": [2, 1]}}}), ("optimization", {"scenario_presets": {"a": 0}}), ("optimization", {"scenario_presets": {"a": {"x": 1}}}),
        ("optimization", {"scenario_presets": {"a": {"budget_multiplier": 1, "platform_adjustments": {"tv": -1}}}}), ("features", {"adstock": {"platform_overrides": {"tv": {"type": "weibull", "shape": 1}}}}),
        ("features", {"adstock": {"platform_overrides": {"tv": {}}}}), ("data", {"digital_specific": {"platform_metrics": {"clicks": "c"}}}), ("model", {"likelihood": "poisson"}),
        ("optimization", {"objective": "clicks"}), ("optimization", {"platform_constraints": {"platform_specific": {"tv": {"min_spend_pct": 0.5, "max_spend_pct": 0.2}}}}),
    ):
        with pytest.raises(ValueError):
            made(section, given)
    with pytest.raises(ValueError):
        settings.require_channels(settings.Settings())
    kept = made("validation", {"seasonal": 1, "min_weeks_per_market": 4})
    assert kept.validation.rest == {"seasonal": 1} and kept.validation.min_weeks_per_market == 4
    assert settings.merged({"a": {"b": 1, "c": [1]}, "d": 2}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}, "d": 2}


def test_wear_and_seasons_are_checked():
    features = lambda **given: settings.bound(settings.Settings, {"features": given}).features
    wear, warned = features(creative_fatigue={"half_life": -3, "fatigue_floor": 1.5, "refresh_signal": "weekly_creative_change", "refresh_detection": {"min_gap_days": 0, "spend_change_threshold": 9}}).wear()
    assert (wear["half_life"], wear["floor"], wear["gap"], wear["least"], wear["method"], wear["enabled"]) == (14, 0.2, 7, 0.5, "spend_change", False) and len(warned) == 4
    assert features(creative_fatigue={"half_life": 30, "enabled": True}).wear() == ({**features(creative_fatigue={"enabled": True}).wear()[0], "half_life": 30}, [])
    assert features().seasonal()["fourier_terms"] == 4
    for bad in ({"fourier_terms": 0}, {"fourier_terms": 2.5}, {"holiday_effects": ["during"]}):
        with pytest.raises(ValueError):
            features(seasonality=bad).seasonal()
    with pytest.raises(ValueError):
        features(creative_fatigue={"apply_to_stage": "later"}).wear()


def test_problems_are_all_named(tmp_path):
    given = settings.bound(settings.Settings, {
        "data": {"channel_map": {"a": "a_spend", "b": "b_spend"}}, "features": {"adstock": {"default": {"decay": 1.5}}, "saturation": {"platform_overrides": {"b": {"k": -1}}}},
        "optimization": {"platform_constraints": {"platform_specific": {"tv": {"min_spend_pct": 0.1}}}, "scenario_presets": {"x": {"budget_multiplier": 1, "platform_adjustments": {"radio": 2}}}},
    })
    found = settings.problems(given)
    assert [any(w in f for f in found) for w in ("adstock of a", "adstock of b", "saturation of b", "no allocation", "tv isn't", "radio isn't")] == [True] * 6
    assert given.features.response("b") == {"type": "hill", "k": -1, "s": 1.0}, "an override replaces what it names"
    assert settings.resolved(given, "/base").paths.raw == "/base/data/raw" and settings.resolved(settings.bound(settings.Settings, {"paths": {"raw": "s3://x/y", "models": "/m"}}), "/base").paths.raw == "s3://x/y"
    (tmp_path / "main.yaml").write_text("data: {channel_map: {}}\n")
    with pytest.raises(SystemExit):
        jobs.main(["config-check", "--config", str(tmp_path / "main.yaml")])
