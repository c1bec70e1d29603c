"""Operators against plain Python where no SQL does, sources and sinks."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixwright.functions import calendar
from mixwright.functions.windows import Series
from mixwright.operators import baseline, evaluation, fatigue, matrix, quality
from mixwright.sources import files

S = Series(("k",), "d")


def test_ridge_is_the_mode_of_the_posterior(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 2, (80, 3))
    y = np.exp(1.5 + x @ [0.4, 0.0, -0.3] + rng.normal(0, 0.1, 80))
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, c double, y double")
    model = evaluation.ridge(df, ["a", "b", "c"], "y")
    design, target, s2 = np.column_stack([np.ones(80), x]), np.log(y), 1.0
    for _ in range(20):
        w = np.linalg.solve(design.T @ design + s2 * np.diag([0.25, 1, 1, 1]), design.T @ target)
        s2 = np.mean((target - design @ w) ** 2)
    assert np.allclose([model[k] for k in ("intercept", "a", "b", "c")], w, atol=1e-8) and abs(model["sigma"] - s2**0.5) < 1e-8
    shares = evaluation.contribution_shares(model, {"one": ["a", "b"], "two": ["c"], "none": ["zzz"]})
    assert abs(sum(p for *_, p in shares) - 100) < 1e-9 and shares[2][1] == 0


def test_column_roles_and_categories(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "` Day ` int, `Rev` double, `TV_Spend` double")
    named, roles = matrix.Roles("DAY", None, None, "rev", (("tv", "TV_SPEND"), ("x", "x_spend"))).resolve(df)
    assert named.columns == ["day", "rev", "tv_spend"] and roles["spend"] == ["tv_spend"] and roles["day"] == ["day"]
    with pytest.raises(KeyError):
        matrix.Roles("date").resolve(df)
    assert matrix.spend_columns(df) == ["TV_Spend"] and matrix.spend_columns(df, {"r": "Rev"}) == ["Rev"]
    assert [matrix.category(c) for c in ("TV_SPEND", "x_returns", "other")] == ["media_spend", "adjustments", "control"]
    assert matrix.schema_differences(named, {"day": "int", "rev": "int", "no": "string"}) == [("rev", "int", "double", "type"), ("no", "string", None, "missing")]


def test_score_and_rules(spark):
    checks = spark.createDataFrame([("a", True, 0.2), ("b", False, 0.5), ("c", None, 0.3)], "check string, failed boolean, penalty double")
    row = matrix.score(checks).first()
    assert abs(row.score - 0.8) < 1e-9 and row.status == "warning"
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    assert {r.rule: r.broken for r in matrix.broken_rules(df, {"positive": F.col("x") > 0, "known": F.col("x").isNotNull()}).collect()} == {"positive": 2, "known": 1}


def _days(spark, values, start=dt.date(2020, 1, 1)):
    return spark.createDataFrame([("s", start + dt.timedelta(i), v) for i, v in values], "k string, d date, x double")


def test_debounced_takes_greedily(spark):
    df = _days(spark, [(i, 1.0) for i in (0, 3, 7, 8, 13, 14, 30)])
    got = [r.d.day for r in fatigue.debounced(df, S, F.col("x") > 0, 7).orderBy("d").collect()]
    assert got == [1, 8, 15, 31]
    rows = [r.place for r in fatigue.debounced_rows(df, S, F.col("x") > 0, 3).orderBy("place").collect()]
    assert rows == [1, 4, 7]


def test_as_of_and_daily_lines(spark):
    left = _days(spark, [(0, 0.0), (4, 0.0), (9, 0.0)]).drop("x")
    right = spark.createDataFrame([("s", dt.date(2020, 1, 2), 5.0), ("s", dt.date(2020, 1, 9), 7.0)], "k string, at date, v double")
    assert [r.v for r in baseline.as_of(left, right, ["k"], "d", "at", "v").orderBy("d").collect()] == [None, 5.0, 7.0]
    assert [r.v for r in baseline.as_of(left, right.drop("k"), [], "d", "at", "v", 2).orderBy("d").collect()] == [None, 5.0, 5.0]
    known = right.select(F.col("at").alias("d"), "v")
    assert [r.v for r in baseline.daily(left.select("d"), known, "d", "v").orderBy("d").collect()] == [5.0, pytest.approx(5 + 2 * 3 / 7), 7.0]


def test_observed_days_and_easter():
    assert calendar.observed(dt.date(2021, 7, 4)) == dt.date(2021, 7, 5) and calendar.observed(dt.date(2020, 7, 4)) == dt.date(2020, 7, 3)
    assert [calendar.easter(y) for y in (1961, 2000, 2019, 2038)] == [dt.date(1961, 4, 2), dt.date(2000, 4, 23), dt.date(2019, 4, 21), dt.date(2038, 4, 25)]


def test_similar_names_match_all_pairs(spark):
    names = ["red big box", "big box", "box", "red box", "blue thin pen", "thin pen blue", "pen", "a b c d", "a b c e"]
    got = {(r.a, r.b) for r in quality.similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", 0.5).collect()}
    sets = {n: set(n.split()) for n in names}
    assert got == {(a, b) for a in names for b in names if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}


def test_csv_source_and_sinks(spark, tmp_path):
    (tmp_path / "in.csv").write_text("day,channel,spend\n2020-01-01,tv,1.5\n2020-01-02,,\n")
    df = files.read_csv(spark, str(tmp_path / "in.csv"), "day date, channel string, spend double")
    assert [tuple(r) for r in df.orderBy("day").collect()] == [(dt.date(2020, 1, 1), "tv", 1.5), (dt.date(2020, 1, 2), None, None)]
    files.write_json(df, str(tmp_path / "out.json"))
    assert spark.read.json(str(tmp_path / "out.json")).count() == 2
    files.write_features(df, str(tmp_path / "out.parquet"), by="day")
    assert spark.read.parquet(str(tmp_path / "out.parquet")).where("day = '2020-01-01'").first().channel == "tv"
    (tmp_path / "bad.csv").write_text("day,channel,spend\n2020-01-01,tv,much\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), "day date, channel string, spend double").collect()
