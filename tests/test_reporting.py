"""Reports appear whole under their run, or not at all."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from mixwright.operators import attribution, reporting
from mixwright.sources.panel import brand_daily


def runs(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith("."))


def test_a_run_is_published_whole(spark, tmp_path):
    folder = f"{tmp_path}/reports"
    one = spark.range(1).select(F.struct(F.lit(1.5).alias("x"), F.array(F.lit("a")).alias("names"), F.lit(None).cast("int").alias("none")).alias("part"))
    reporting.publish(spark, {"summary": one, "other": one}, folder, "run1")
    assert runs(folder) == ["run1"] and sorted(os.listdir(f"{folder}/run1")) == ["other", "summary"]
    assert [r.value for r in spark.read.text(f"{folder}/run1/summary").collect()] == ['{"part":{"x":1.5,"names":["a"],"none":null}}']
    two = one.select(F.struct(F.lit(2.5).alias("x")).alias("part"))
    reporting.publish(spark, {"summary": two}, folder, "run1")  # takes the place of the whole run
    assert runs(folder) == ["run1"] and os.listdir(f"{folder}/run1") == ["summary"]
    assert spark.read.json(f"{folder}/run1/summary").first().part.x == 2.5


def test_a_run_that_breaks_off_leaves_the_earlier_one(spark, tmp_path):
    folder = f"{tmp_path}/reports"
    good = spark.range(1).select(F.lit(1).alias("x"))
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        reporting.publish(spark, {"a": good, "b": bad}, folder, "run1")
    assert runs(folder) == []
    reporting.publish(spark, {"a": good}, folder, "run1")
    with pytest.raises(Exception, match="broken"):
        reporting.publish(spark, {"a": good.select(F.lit(2).alias("x")), "b": bad}, folder, "run1")
    assert runs(folder) == ["run1"] and spark.read.json(f"{folder}/run1/a").first().x == 1
    for name in ("", "a/b", "_x"):
        with pytest.raises(ValueError):
            reporting.publish(spark, {"a": good}, folder, name)


def test_metadata_documents_are_checked(spark, sf_dir):
    document = reporting.metadata(brand_daily(spark, sf_dir).select("date_day", "revenue", "search_spend"), "revenue", "date_day", "run", config={"likelihood": "normal"}).first().asDict()
    assert reporting.metadata_errors(document) == [] and document["model_config"] == {"likelihood": "normal"} and document["features"] == {"media_spend": ["search_spend"]}
    assert reporting.metadata_errors(document | {"n_features": 3, "backend": None}) == ["missing: backend", "1 names for 3 features"]


def test_sides_of_a_reconciliation(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "channel string, credit double")
    found = {r.channel: r for r in attribution.reconciled(rows(("a", 10.0), ("a", 5.0), ("b", 1.0), ("z", 0.0), ("y", 0.0)), rows(("a", 13.0), ("c", 2.0), ("z", 0.0), ("y", 1.0)), ["channel"]).collect()}
    assert {c: (r.side, r.within_tolerance) for c, r in found.items()} == {"a": ("both", True), "b": ("platform only", False), "c": ("model only", False), "z": ("both", True), "y": ("both", False)}
    assert found["a"].difference_pct == pytest.approx(-2 / 15) and found["c"].difference_pct is None and found["b"].model == 0.0


def test_advice(spark):
    c = spark.createDataFrame([("a", 5.0, "low", 0.1), ("b", 5.0, "high", 0.4), ("c", 1.0, "medium", 0.1), ("d", 2.0, "low", 0.1)], "channel string, estimated_roi double, saturation_level string, attribution_share double")
    advice = {r.channel: [a.split(":")[0] for a in r.advice] for r in c.select("channel", reporting.channel_advice(F.struct("*")).alias("advice")).collect()}
    assert advice == {"a": ["raise"], "b": ["hold", "watch"], "c": ["lower"], "d": []}
