"""Feature selection, fits by likelihood, and a model that is written and read again.

A fit is the mode of the posterior, coefficients with normal priors. The data are read once a round, for one aggregate of
(weighted) cross products; the driver solves a system as large as the number of features. Where there are several rounds the
columns are written first, so that what the data are computed from is read once.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.sources.shared import drop, written

LIKELIHOODS = ("lognormal", "normal", "student_t")
# Which columns a model is fitted on, and which of them are made from the target.
SELECTED = {
    "media": (r".*_adstocked_saturated$",), "seasonality": (r"^fourier_", r"^dow_", r"^holiday_", r"^trend$", r"^sin_", r"^cos_", r"^is_weekend$"), "baseline": (r"^macro_", r"^external_"), "custom": (r"^promo_",),
}
FROM_TARGET = (r"promo_.*revenue.*", r"promo_.*sales.*", r"promo_.*purchases.*")
NOT_FEATURES = ("date", "time", "date_day", "ordinal_date")
#: Degrees of freedom of the heavy-tailed likelihood, and most rounds of weights.
FREEDOM, ROUNDS = 4.0, 50


@dataclass(frozen=True)
class Selection:
    """The columns of a model by kind, in training order."""

    target: str
    groups: dict[str, list[str]]
    channels: list[str]
    left_out: list[str] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return list(dict.fromkeys(c for names in self.groups.values() for c in names))


def select(df: DataFrame, target: str, spend: list[str] = (), allow_from_target: bool = False) -> Selection:
    """The model's columns by the patterns of their names. A missing target, a spend column without its response, and promotion
    columns made from the target (unless allowed) are errors."""
    if target not in df.columns:
        raise ValueError(f"the target {target!r} isn't in the table")
    fits = lambda c, patterns: any(re.search(p, c, re.I) for p in patterns)
    groups = {kind: [c for p in patterns for c in df.columns if re.search(p, c) and c != target and c.lower() not in NOT_FEATURES] for kind, patterns in SELECTED.items()}
    derived = [c for c in groups["custom"] if fits(c, FROM_TARGET)]
    if derived and not allow_from_target:
        raise ValueError(f"made from the target: {', '.join(derived)}")
    missing = [c for c in spend if f"{c}_adstocked_saturated" not in groups["media"]]
    if missing:
        raise ValueError(f"no response columns for {', '.join(missing)}")
    return Selection(target, groups, [c.removesuffix("_adstocked_saturated") for c in groups["media"]])


def check_inputs(df: DataFrame, chosen: Selection, closest: float = 0.99) -> dict[str, list]:
    """Nulls in features or target are an error, all of them named; constant features and pairs over ``closest`` correlation are
    returned. One aggregate for nulls, one for cross products."""
    names = [*chosen.features, chosen.target]
    x = df.select(*(F.col(c).cast("double").alias(c) for c in names))
    one = x.agg(*(F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in names), *(F.var_samp(c).alias(f"var_{c}") for c in chosen.features), *(F.avg(c).alias(f"mean_{c}") for c in chosen.features)).first()
    nulls = {c: one[c] for c in names if one[c]}
    if nulls:
        raise ValueError("nulls in " + ", ".join(f"{c} ({n})" for c, n in nulls.items()))
    flat = [c for c in chosen.features if one[f"var_{c}"] is None or one[f"var_{c}"] < 1e-8]
    rest = [c for c in chosen.features if c not in flat]
    # Less their means first, so that cross products lose no digits.
    near = x.select(*((F.col(c) - F.lit(one[f"mean_{c}"])).alias(c) for c in rest), chosen.target)
    gram = _moments(near, rest, F.col(chosen.target))[0][1:, 1:] if len(rest) > 1 else np.eye(len(rest))
    length = np.sqrt(np.diag(gram))
    alike = [(a, b) for i, a in enumerate(rest) for j, b in enumerate(rest[i + 1 :], i + 1) if abs(gram[i, j]) > closest * length[i] * length[j]]
    return {"constant": flat, "correlated": alike}


def _aligned(df: DataFrame, features: list[str]) -> list[Column]:
    """The training columns in their order; absent ones, and nulls, are 0."""
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in features]


def _moments(df: DataFrame, features: list[str], y: Column, weight=None) -> tuple[np.ndarray, np.ndarray, float, int, float]:
    """Weighted cross products of the columns and a leading one: of each other, with the target, of the target; rows and the sum
    of weights. A task sums up its own rows as matrices and gives one row; what meets is as large as the features squared.
    ``weight`` takes a matrix of rows and their targets."""
    n = len(features) + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n + n + 3)
        for b in batches:
            x, t = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n), b.column(1).to_numpy(zero_copy_only=False)
            w = np.ones(len(t)) if weight is None else weight(x, t)
            total += np.concatenate([(x.T @ (w[:, None] * x)).ravel(), x.T @ (w * t), [(w * t * t).sum(), len(t), w.sum()]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    rows = df.select(F.array(F.lit(1.0), *_aligned(df, features)).alias("x"), y.alias("y")).where(F.col("y").isNotNull())
    cells = rows.mapInArrow(summed, "s array<double>").select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    one = np.zeros(n * n + n + 3)
    for r in cells:
        one[r.i] = r.v
    if not one[-2]:
        raise ValueError("no row has a target")
    return one[: n * n].reshape(n, n), one[n * n : n * n + n], float(one[-3]), int(one[-2]), float(one[-1])


def _solved(gram, moment, sigma2: float, prior: float, prior0: float) -> np.ndarray:
    return np.linalg.solve(gram + sigma2 * np.diag([1 / prior0**2, *[1 / prior**2] * (len(moment) - 1)]), moment)


@dataclass
class Fitted:
    """A fitted model: all that prediction needs, and how the fit went."""

    likelihood: str
    features: list[str]
    coefficients: list[float]
    intercept: float
    sigma: float
    target: str = ""
    channels: list[str] = field(default_factory=list)
    diagnostics: dict = field(default_factory=dict)
    fit_seconds: float = 0.0

    def __post_init__(self):
        if self.likelihood not in LIKELIHOODS:
            raise ValueError(f"likelihood: one of {LIKELIHOODS} is needed, not {self.likelihood!r}")
        if len(self.features) != len(self.coefficients):
            raise ValueError("a coefficient for each feature is needed")

    @property
    def terms(self) -> dict[str, float]:
        return {"intercept": self.intercept, **dict(zip(self.features, self.coefficients, strict=True)), "sigma": self.sigma}

    def predicted(self, df: DataFrame) -> Column:
        """The expected target of a row; columns that the table lacks count as 0."""
        eta = F.lit(self.intercept)
        for x, w in zip(_aligned(df, self.features), self.coefficients, strict=True):
            eta = eta + F.lit(w) * x
        return F.exp(eta + self.sigma**2 / 2) if self.likelihood == "lognormal" else eta

    def contributions(self) -> list[tuple[str, float, float]]:
        """(channel, sum of absolute coefficients of its features, percent of all channels)."""
        sums = {c: sum(abs(w) for f, w in zip(self.features, self.coefficients, strict=True) if f.startswith(c)) for c in self.channels}
        whole = sum(sums.values()) or 1.0
        return [(c, v, 100 * v / whole) for c, v in sums.items()]

    def summary(self) -> dict:
        return {"likelihood": self.likelihood, "fit_seconds": self.fit_seconds, "n_parameters": len(self.features) + 2, "converged": self.diagnostics.get("converged", False), "rounds": self.diagnostics.get("rounds"), "n_rows": self.diagnostics.get("n_rows")}

    def save(self, spark: SparkSession, path: str) -> None:
        """Coefficients by term as a table, and the whole model as one line of JSON, which load() reads."""
        terms = [(i, t, v) for i, (t, v) in enumerate(self.terms.items())]
        spark.createDataFrame(terms, "position int, term string, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted:
        return cls(**json.loads(spark.read.text(f"{path}/model").first().value))


@dataclass(frozen=True)
class Estimator:
    """How to fit: the likelihood, spreads of the priors, degrees of freedom and most rounds of the heavy-tailed one."""

    likelihood: str = "lognormal"
    prior: float = 1.0
    prior0: float = 2.0
    freedom: float = FREEDOM
    rounds: int = ROUNDS
    tolerance: float = 1e-10

    def __post_init__(self):
        if self.likelihood not in LIKELIHOODS:
            raise ValueError(f"likelihood: one of {LIKELIHOODS} is needed, not {self.likelihood!r}")

    def fit(self, df: DataFrame, features: list[str], target: str, channels: list[str] = ()) -> Fitted:
        """Rows without a target are left out; nulls of features count as 0."""
        start = time.monotonic()
        y = F.col(target).cast("double")
        if self.likelihood == "lognormal":
            y = F.ln(F.greatest(y, F.lit(1e-6)))
        heavy = self.likelihood == "student_t"
        df = written(df.select(*dict.fromkeys(c for c in [*features, target] if c in df.columns))) if heavy else df
        gram, moment, yy, n, _ = _moments(df, features, y)
        if heavy:
            w, sigma2, rounds, converged = self._heavy(df, features, y, gram, moment, yy, n)
            drop(df)
        else:
            w, sigma2, rounds, converged = None, 1.0, 0, False
            while rounds < 20:  # on the sums alone
                w = _solved(gram, moment, sigma2, self.prior, self.prior0)
                before, sigma2 = sigma2, max((yy - 2 * w @ moment + w @ gram @ w) / n, 1e-12)
                rounds += 1
                converged = abs(sigma2 - before) <= 1e-9 * before
        diagnostics = {"n_rows": n, "rounds": rounds, "converged": bool(converged), "condition": float(np.linalg.cond(gram)), "likelihood": self.likelihood}
        return Fitted(self.likelihood, list(features), [float(v) for v in w[1:]], float(w[0]), float(sigma2**0.5), target, list(channels), diagnostics, time.monotonic() - start)

    def _heavy(self, df, features, y, gram, moment, yy, n):
        """Rows far from the fit count less: by (freedom + 1) / (freedom + squared distance in sigmas), until nothing moves."""
        mean = moment[0] / n
        sigma2 = max(yy / n - mean**2, 1e-12)
        w, rounds, converged = np.zeros(len(moment)), 0, False
        weight = None
        while rounds < self.rounds and not converged:
            if weight is not None:
                gram, moment, yy, n, _ = _moments(df, features, y, weight)
            last, w = w, _solved(gram, moment, sigma2, self.prior, self.prior0)
            sigma2 = max((yy - 2 * w @ moment + w @ gram @ w) / n, 1e-12)
            rounds += 1
            converged = bool(np.abs(w - last).max() <= self.tolerance * max(1.0, np.abs(w).max()))
            now, s2, freedom = w.copy(), sigma2, self.freedom
            weight = lambda x, t, now=now, s2=s2: (freedom + 1) / (freedom + (t - x @ now) ** 2 / s2)

        return w, sigma2, rounds, converged
