"""Merging by roles, audit, routing and pauses on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mixwright.functions.windows import Series
from mixwright.operators import audit, merging

ROWS = [
    # day, brand, SEARCH_SPEND, SEARCH_CTR, note, flag, ingestion_ts, other, seen_time
    ("d1", "a", 1.0, 0.1, "x", True, 2, 7, "t1"), ("d1", "a", 2.0, 0.3, "y", False, 3, 8, "t9"), ("d1", "a", None, None, None, None, 9, None, None), ("d2", "a", None, 0.5, "z", None, 1, 1, "t2"),
    (None, "a", 5.0, 0.5, "n", True, 1, 1, "t"), ("d1", None, 5.0, 0.5, "n", True, 1, 1, "t"),
]
SCHEMA = "day string, brand string, SEARCH_SPEND double, SEARCH_CTR double, note string, flag boolean, ingestion_ts int, other int, seen_time string"


def test_merging_by_roles(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert merging.plan(df, ["day", "brand"], merging.Policy()) == {"SEARCH_SPEND": "sum", "SEARCH_CTR": "mean", "note": "latest", "flag": "first", "ingestion_ts": "max", "other": "first", "seen_time": "latest"}
    found = {r.day: r.asDict() for r in merging.merged(df, ["day", "brand"]).collect()}
    assert set(found) == {"d1", "d2"}
    assert found["d1"] == {"day": "d1", "brand": "a", "SEARCH_SPEND": 3.0, "SEARCH_CTR": 0.2, "note": "y", "flag": True, "ingestion_ts": 9, "other": 7, "seen_time": "t9", "_rows": 3}
    assert found["d2"]["SEARCH_SPEND"] is None and found["d2"]["_rows"] == 1
    untimed = df.drop("ingestion_ts")
    ways = merging.plan(untimed, ["day", "brand"], merging.Policy.of({"numeric_aggregation": "max", "additive_columns": [".*spend$"], "non_additive_columns": []}))
    assert ways == {"SEARCH_SPEND": "max", "SEARCH_CTR": "first", "note": "mode", "flag": "first", "other": "first", "seen_time": "mode"}
    assert merging.merged(untimed.where("false"), ["day"]).count() == 0
    with pytest.raises(ValueError):
        merging.Policy("median")


def test_audit_counts_in_the_pass_that_writes(spark, tmp_path):
    for detailed, steps in ((True, {1, 2}), (False, {1})):
        log = audit.Audit(detailed)
        df = log.step(spark.range(10), "read", odd=F.count_if(F.col("id") % 2 == 1))
        df = log.step(df.where("id > 3"), "cut", "detailed", least=F.min("id"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        df.write.parquet(f"{tmp_path}/{detailed}")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs == 1
        rows = log.rows(spark).collect()
        assert {r.step for r in rows} == steps
        assert {(r.action, r.metric): r.value for r in rows}.items() >= {("read", "rows"): 10.0, ("read", "odd"): 5.0}.items()
    assert {(r.action, r.metric): r.value for r in rows} == {("read", "rows"): 10.0, ("read", "odd"): 5.0}


def test_rows_are_routed_whole(spark, tmp_path):
    today = dt.date(2024, 1, 5)
    rows = [(dt.date(2024, 1, 1), 5.0, 1.0), (None, 5.0, 1.0), (dt.date(2024, 1, 9), -5.0, -1.0), (dt.date(2024, 1, 5), None, None), (dt.date(2024, 1, 2), 2e9, 0.0)]
    df = spark.createDataFrame(rows, "day date, revenue double, s_spend double")
    rules = audit.rules_of("day", "revenue", ["s_spend"], F.lit(today))
    good, bad = audit.routed(df, rules, f"{tmp_path}/out")
    assert [tuple(r) for r in good.collect()] == rows[:1] and good.columns == df.columns
    broken = {(r.day, r.revenue): r.broken for r in bad.collect()}
    assert broken == {
        (None, 5.0): ["day_present", "day_not_future"], (dt.date(2024, 1, 9), -5.0): ["day_not_future", "revenue_not_negative", "s_spend_not_negative"],
        (dt.date(2024, 1, 5), None): ["revenue_not_negative", "revenue_not_too_high"], (dt.date(2024, 1, 2), 2e9): ["revenue_not_too_high"],
    }
    assert {r.rule: r.broken for r in audit.broken_counts(bad, list(rules)).collect()} == {"day_present": 1, "day_not_future": 2, "revenue_not_negative": 2, "revenue_not_too_high": 2, "s_spend_not_negative": 1}


def test_pauses(spark):
    rows = [(i, "a", s, n) for i, (s, n) in enumerate([(4.0, 9), (None, 0), (None, 5), (None, None), (2.0, 1)])]
    df, s = spark.createDataFrame(rows, "d int, b string, x double, n int"), Series(("b",), "d")
    got = lambda **more: [(r.is_pause_x, r.adstock_continuity_x, r.x) for r in audit.pauses(df, s, "x", "n", **more).orderBy("d").collect()]
    assert got() == [(0, 0, 4.0), (1, 0, 0.0), (0, 1, 0.0), (1, 0, 0.0), (0, 0, 2.0)]
    assert [p for p, _, _ in got(method="any", value=0.5)] == [0, 1, 1, 1, 0]
    assert [p for p, _, _ in got(method="spend_pattern", low=3.9)] == [0, 0, 0, 0, 0] and [p for p, _, _ in got(method="spend_pattern", low=4.1)] == [0, 1, 1, 1, 0]
    assert [(r.is_pause_x, r.adstock_continuity_x) for r in audit.pauses(df, s, "x", None).orderBy("d").collect()] == [(0, 0), (0, 1), (0, 1), (0, 1), (0, 0)]
