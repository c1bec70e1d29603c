"""Fits against NumPy, feature selection, and models that are written and read."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixwright.operators import evaluation, fitting, validation
from mixwright.plans.catalog import QUERIES
from mixwright.sources.panel import CHANNELS, SPEND, brand_daily

NAMES = ["a_adstocked_saturated", "b_adstocked_saturated"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (400, 2))
    y = 2 + x @ [1.5, -0.5] + 0.1 * rng.standard_normal(400)
    y[:30] += 40  # rows that a normal likelihood can't take
    return x, y, spark.createDataFrame([(float(a), float(b), float(v)) for (a, b), v in zip(x, y, strict=True)], f"{NAMES[0]} double, {NAMES[1]} double, revenue double")


def mode(x, y, freedom=None, rounds=60):
    full = np.column_stack([np.ones(len(y)), x])
    prior = np.diag([1 / 4] + [1.0] * x.shape[1])
    w, s2 = np.ones(len(y)), y.var() if freedom else 1.0
    for _ in range(rounds):
        beta = np.linalg.solve(full.T @ (w[:, None] * full) + s2 * prior, full.T @ (w * y))
        rest = y - full @ beta
        s2 = (w * rest**2).sum() / len(y)
        if freedom:
            w = (freedom + 1) / (freedom + rest**2 / s2)
    return beta, s2**0.5


@pytest.mark.parametrize("likelihood", fitting.LIKELIHOODS)
def test_fits(data, likelihood):
    x, y, df = data
    model = fitting.Estimator(likelihood, rounds=60).fit(df, NAMES, "revenue", ["a", "b"])
    beta, sigma = mode(x, np.log(y) if likelihood == "lognormal" else y, 4.0 if likelihood == "student_t" else None)
    assert [model.intercept, *model.coefficients] == pytest.approx(beta.tolist(), rel=1e-6) and model.sigma == pytest.approx(sigma, rel=1e-6)
    if likelihood == "student_t":  # the thirty far rows hardly count
        assert abs(model.coefficients[0] - 1.5) < 0.2 and model.diagnostics["converged"]
    eta = beta[0] + x @ beta[1:]
    expected = np.exp(eta + sigma**2 / 2) if likelihood == "lognormal" else eta
    found = [r.p for r in df.select(model.predicted(df).alias("p")).collect()]
    assert sorted(found) == pytest.approx(sorted(expected.tolist()), rel=1e-6)


def test_a_model_is_read_as_it_was_written(spark, data, tmp_path):
    _, _, df = data
    model = fitting.Estimator("student_t").fit(df, NAMES, "revenue", ["a", "b"])
    model.save(spark, f"{tmp_path}/m")
    again = fitting.Fitted.load(spark, f"{tmp_path}/m")
    assert again == model and [r.term for r in spark.read.parquet(f"{tmp_path}/m/coefficients").orderBy("position").collect()] == ["intercept", *NAMES, "sigma"]
    other = df.select(F.lit(9).alias("new"), F.col(NAMES[1]), F.col(NAMES[0]))  # another order
    assert [r[0] for r in other.select(again.predicted(other)).collect()] == [r[0] for r in df.select(model.predicted(df)).collect()]
    lacking = df.select(NAMES[1])
    zero = df.withColumn(NAMES[0], F.lit(0.0))
    assert [r[0] for r in lacking.select(again.predicted(lacking)).collect()] == [r[0] for r in zero.select(model.predicted(zero)).collect()]
    assert again.summary()["n_parameters"] == 4 and sum(p for _, _, p in again.contributions()) == pytest.approx(100)
    with pytest.raises(ValueError):
        fitting.Fitted("poisson", [], [], 0.0, 1.0)
    with pytest.raises(ValueError):
        fitting.Estimator().fit(df.where("false"), NAMES, "revenue")


def test_columns_are_selected_and_checked(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 1.0, 1, 2.0, None), (2.0, 4.0, 5.0, 1.0, 2, 2.5, 1.0)], "revenue double, s_spend_adstocked_saturated double, fourier_1 double, trend double, promo_flag int, macro_x double, external_y double")
    chosen = fitting.select(df, "revenue", ["s_spend"])
    assert chosen.features == ["s_spend_adstocked_saturated", "fourier_1", "trend", "macro_x", "external_y", "promo_flag"] and chosen.channels == ["s_spend"]
    with pytest.raises(ValueError, match="external_y"):
        fitting.check_inputs(df, chosen)
    warned = fitting.check_inputs(df.drop("external_y"), fitting.select(df.drop("external_y"), "revenue"))
    assert warned["constant"] == ["trend"] and ("s_spend_adstocked_saturated", "fourier_1") in warned["correlated"]
    for table, target, spend in ((df, "sales", []), (df, "revenue", ["t_spend"]), (df.withColumn("promo_revenue_spike", F.lit(1.0)), "revenue", [])):
        with pytest.raises(ValueError):
            fitting.select(table, target, spend)
    assert "promo_revenue_spike" in fitting.select(df.withColumn("promo_revenue_spike", F.lit(1.0)), "revenue", allow_from_target=True).features


def test_contributions_of_all_channels(spark, sf_dir):
    rows = brand_daily(spark, sf_dir).select("revenue", *SPEND).toPandas()
    x, y = rows[SPEND].to_numpy() / 1000, np.log(np.maximum(rows["revenue"].to_numpy(), 1e-6))
    beta, _ = mode(x, y, rounds=20)
    shares = {r.channel: (r.contribution, r.contribution_pct) for r in QUERIES["model_contribution"](spark, sf_dir).collect()}
    for c, b in zip(CHANNELS, beta[1:], strict=True):
        assert shares[c] == pytest.approx((abs(b), 100 * abs(b) / np.abs(beta[1:]).sum()), abs=2e-4)
    assert evaluation.contribution_shares({"x": -2.0}, {"c": ["x"], "d": ["z"]}) == [("c", 2.0, 100.0), ("d", 0.0, 0.0)]


def test_rounds_read_what_the_data_are_computed_from_once(spark, data):
    """The heavy-tailed fit has many rounds; the rows are computed in one of them."""
    x, y, df = data
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    model = fitting.Estimator("student_t").fit(df.mapInArrow(counted, df.schema), NAMES, "revenue")
    assert model.diagnostics["rounds"] > 2 and seen.value == len(y)


def test_the_report_computes_its_table_once(spark):
    """Every check reads what was written."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), "b", float(i), float(i % 7), float(i % 5)) for i in range(60)], "date_day date, brand string, revenue double, x_spend double, y_spend double")
    out = validation.report(rows.mapInArrow(counted, rows.schema), "date_day", ["brand"], "revenue", ["x_spend", "y_spend"], min_weeks=4, preferred_weeks=8)
    assert out.count() == 12 and seen.value == 60
