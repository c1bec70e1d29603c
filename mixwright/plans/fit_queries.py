"""Fits by likelihood, and predictions of a model that was written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.operators import fitting
from mixwright.plans.feature_queries import sql
from mixwright.plans.media_queries import KEYS, K
from mixwright.plans.registry import Registry, r, rounded
from mixwright.sources.panel import brand_daily
from mixwright.sources.shared import remove, shared_folder

register = Registry()
QUERIES, ORACLE = register.queries, register.oracle
D = "date_day"
#: Rounds of the heavy-tailed fit: as many as the SQL writes out.
ROUNDS = 10


def _rows(spark, sf_dir) -> DataFrame:
    return brand_daily(spark, sf_dir).select(*KEYS, (F.col("revenue") / 1e6).alias("revenue"), (F.col("search_spend") / 1e5).alias("search_adstocked_saturated"))


_ROWS = f"rows_ as (select {K}, search_spend / 100000 x, revenue / 1000000 y from daily)"
_SOLVE = "(b0 * (a11 + s2) - a01 * b1) / ((a00 + s2 / 4) * (a11 + s2) - a01 * a01) w0, ((a00 + s2 / 4) * b1 - a01 * b0) / ((a00 + s2 / 4) * (a11 + s2) - a01 * a01) w1"
_SPREAD = "greatest((yy - 2 * (w0 * b0 + w1 * b1) + w0 * w0 * a00 + 2 * w0 * w1 * a01 + w1 * w1 * a11) / n, 1e-12)"
_NORMAL = f"""{_ROWS}, g as (select count(*)::double n, count(*)::double a00, sum(x) a01, sum(x * x) a11, sum(y) b0, sum(x * y) b1, sum(y * y) yy from rows_),
it as (select 0 i, 1::double s2, 0::double w0, 0::double w1 union all select i + 1, {_SPREAD}, w0, w1 from (select i, g.*, {_SOLVE} from it, g where i < 20)), fit as (select w0, w1, sqrt(s2) sigma from it where i = 20)"""


def _heavy_sql() -> str:
    parts = [_ROWS, "s0 as (select 0::double w0, 0::double w1, var_pop(y) s2 from rows_)"]
    for k in range(1, ROUNDS + 1):
        weight = "1::double" if k == 1 else f"(5 / (4 + pow(y - w0 - w1 * x, 2) / s2))"
        parts.append(f"g{k} as (select any_value(s2) s2, count(*)::double n, sum(w) a00, sum(w * x) a01, sum(w * x * x) a11, sum(w * y) b0, sum(w * x * y) b1, sum(w * y * y) yy from (select x, y, s2, {weight} w from rows_, s{k - 1}))")
        parts.append(f"s{k} as (select w0, w1, {_SPREAD} s2 from (select g{k}.*, {_SOLVE} from g{k}))")
    return ", ".join(parts) + f", fit as (select w0, w1, sqrt(s2) sigma from s{ROUNDS})"


_TERMS = "select unnest(['intercept', 'search', 'sigma']) as term, unnest([round(w0, 6), round(w1, 6), round(sigma, 6)]) as value from fit"


def _terms(spark, model: fitting.Fitted) -> DataFrame:
    rows = [(t.removesuffix("_adstocked_saturated"), v) for t, v in model.terms.items()]
    return rounded(spark.createDataFrame(rows, "term string, value double"), 6)


def _fit(spark, sf_dir, **how) -> tuple[DataFrame, fitting.Fitted]:
    rows = _rows(spark, sf_dir)
    chosen = fitting.select(rows, "revenue", ["search"])
    return rows, fitting.Estimator(**how).fit(rows, chosen.features, "revenue", chosen.channels)


@register(sql(_NORMAL, _TERMS, True))
def model_fit_normal(spark, sf_dir):
    return _terms(spark, _fit(spark, sf_dir, likelihood="normal")[1])


@register(sql(_heavy_sql(), _TERMS))
def model_fit_student_t(spark, sf_dir):
    """Rounds of weights, each one aggregate over all rows."""
    return _terms(spark, _fit(spark, sf_dir, likelihood="student_t", rounds=ROUNDS, tolerance=0.0)[1])


@register(sql(_heavy_sql(), f"select {K}, {r('w0 + w1 * x', 'predicted', 6)} from rows_, fit"))
def model_saved_predict(spark, sf_dir):
    """Predictions of the model as it is read from its folder."""
    rows, model = _fit(spark, sf_dir, likelihood="student_t", rounds=ROUNDS, tolerance=0.0)
    path = f"{shared_folder(spark)}/model-{spark.sparkContext.applicationId}"
    model.save(spark, path)
    again = fitting.Fitted.load(spark, path)
    remove(spark, path)
    return rounded(rows.select(*KEYS, again.predicted(rows).alias("predicted")), 6)
