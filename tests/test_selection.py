"""Percentiles against NumPy, in rounds that leave few rows to sort."""

from __future__ import annotations

import numpy as np
import pytest

from mixwright.operators import selection

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("few", [4, 4096])
def test_percentiles(spark, few):
    rng = np.random.default_rng(2)
    groups = {
        "even": rng.uniform(-1, 1, 700), "heavy": rng.standard_cauchy(500), "ties": np.repeat([3.0, 3.0, 7.0], 200), "far": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, 1.0] * 9), "one": np.array([4.5]),
        None: np.arange(50.0), "zeros": np.array([-0.0, 0.0, 0.0, 1.0]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("even", None), ("even", float("nan")), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    found = {(r.g, r.share): r.value for r in selection.percentiles(df, ["g"], "x", SHARES, buckets=8, few=few).collect()}
    assert set(found) == {(g, s) for g in groups for s in SHARES}
    for (g, s), v in found.items():
        x = np.sort(groups[g])
        p = s * (len(x) - 1)
        a, part = int(p), p - int(p)
        assert v == pytest.approx(x[a] if part == 0 else x[a] * (1 - part) + x[a + 1] * part, rel=1e-12), (g, s)
    whole = selection.percentiles(df, [], "x", [0.5], buckets=8, few=few).collect()
    assert [r.value for r in whole] == [pytest.approx(np.percentile(np.concatenate(list(groups.values())), 50))]
    assert selection.percentiles(df.where("false"), ["g"], "x", [0.5]).collect() == []
