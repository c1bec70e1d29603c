"""Settings of a run: sections of a YAML file, bound to frozen records and checked before any job starts."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

# Names of sections and keys, and their defaults, as existing settings files have them.
BACKENDS = ("meridian", "pymc")
LIKELIHOODS = ("lognormal", "normal", "student_t")


def _dict(name: str = ""):
    return field(default_factory=dict, metadata={"about": name})


@dataclass(frozen=True)
class Paths:
    """Folders that Spark reads and writes; any file system of the cluster."""

    raw: str = "data/raw"
    interim: str = "data/interim"
    models: str = "data/models"
    features: str = "data/features"
    artifacts: str = "artifacts"
    reports: str = "reports"


@dataclass(frozen=True)
class Data:
    frequency: str = "daily"
    timezone: str = "UTC"
    brand_key: str = "ORGANISATION_ID"
    region_key: str = "TERRITORY_NAME"
    date_col: str = "DATE_DAY"
    revenue_col: str = "ALL_PURCHASES_ORIGINAL_PRICE"
    volume_col: str = "ALL_PURCHASES"
    channel_map: dict[str, str] = _dict("channel -> spend column")
    digital_specific: dict[str, Any] = _dict()

    def __post_init__(self):
        for kind, columns in (self.digital_specific.get("platform_metrics") or {}).items():
            if kind in ("clicks", "impressions", "organic_traffic") and not isinstance(columns, list):
                raise ValueError(f"data.digital_specific.platform_metrics.{kind}: a list of columns is needed")


@dataclass(frozen=True)
class Validation:
    """Every documented part is kept: none is dropped for not being known here."""

    schema_ref: str = ""
    min_weeks_per_market: int = 52
    outlier_threshold: float = 0.99
    anomalies: dict[str, Any] = _dict()
    data_quality: dict[str, Any] = _dict()
    rest: dict[str, Any] = _dict()


@dataclass(frozen=True)
class Features:
    adstock: dict[str, Any] = _dict()
    saturation: dict[str, Any] = _dict()
    attribution: dict[str, Any] = _dict()
    creative_fatigue: dict[str, Any] = _dict()
    seasonality: dict[str, Any] = _dict()
    baseline: dict[str, Any] = _dict()
    competitors: dict[str, Any] = _dict()
    custom_terms: dict[str, Any] = _dict()

    #: Parameters that a kind of carry-over can't do without: one of each group.
    NEEDED = {"geometric": (("decay", "lambda"),), "weibull": (("shape",), ("scale",))}

    def __post_init__(self):
        for channel, given in (self.adstock.get("platform_overrides") or {}).items():
            if not isinstance(given, dict):
                raise ValueError(f"features.adstock.platform_overrides.{channel}: a mapping is needed")
            kind = given.get("type", "geometric")
            for names in self.NEEDED.get(kind, ()):
                if not set(names) & set(given):
                    raise ValueError(f"features.adstock.platform_overrides.{channel}: {kind} needs {' or '.join(names)}")

    def carry_over(self, channel: str) -> dict[str, Any]:
        """The channel's own parameters, else the default ones."""
        own = (self.adstock.get("platform_overrides") or {}).get(channel)
        return own or self.adstock.get("default") or {"type": "geometric", "decay": 0.5}

    def response(self, channel: str) -> dict[str, Any]:
        """The default parameters, with what the channel has of its own laid over them."""
        own = (self.saturation.get("platform_overrides") or {}).get(channel) or {}
        return {**(self.saturation.get("default") or {"type": "hill", "k": 0.5, "s": 1.0}), **own}


    def wear(self) -> tuple[dict[str, Any], list[str]]:
        """How creatives wear out, as far as settings say, and what of that was out of range and is taken as usual instead."""
        given, warned = self.creative_fatigue, []
        found = given.get("refresh_detection") or {}

        def number(of: dict, key: str, usual: float, fits) -> float:
            x = of.get(key, usual)
            if isinstance(x, bool) or not isinstance(x, int | float) or not fits(x):
                warned.append(f"features.creative_fatigue.{key}: {x!r} is out of range, {usual} is taken")
                return usual
            return x

        signal = given.get("refresh_signal", "periodic")
        out = {
            "half_life": number(given, "half_life", 14, lambda x: x > 0), "floor": number(given, "fatigue_floor", 0.2, lambda x: 0 <= x < 1), "gap": int(number(found, "min_gap_days", 7, lambda x: x >= 1)),
            "least": number(found, "spend_change_threshold", 0.5, lambda x: 0 < x <= 5), "window": int(number(found, "rolling_window_days", 7, lambda x: x >= 1)), "threshold": number(found, "campaign_launch_threshold", 0.1, lambda x: x >= 0),
            "method": {"weekly_creative_change": "spend_change", "campaign_launch": "campaign_launch"}.get(signal, "periodic"), "stage": given.get("apply_to_stage", "adstocked"), "enabled": bool(given.get("enabled")),
        }
        if out["half_life"] > 365:
            warned.append("features.creative_fatigue.half_life is over a year")
        if out["stage"] not in ("raw", "adstocked"):
            raise ValueError("features.creative_fatigue.apply_to_stage: raw or adstocked is needed")
        return out, warned

    def seasonal(self) -> dict[str, Any]:
        """Terms of the waves, effects of holidays and patterns, with the usual ones where settings say nothing."""
        given = {"fourier_terms": 4, "yearly_trend": True, "weekly_patterns": True, "monthly_patterns": True, "holiday_calendar": "US", "holiday_effects": ["before", "after"], **self.seasonality}
        if isinstance(given["fourier_terms"], bool) or not isinstance(given["fourier_terms"], int) or not 1 <= given["fourier_terms"] <= 20:
            raise ValueError("features.seasonality.fourier_terms: a whole number from 1 to 20 is needed")
        if not set(given["holiday_effects"] or []) <= {"before", "after"}:
            raise ValueError("features.seasonality.holiday_effects: before and after are known")
        return given


@dataclass(frozen=True)
class Model:
    backend: str = "meridian"
    likelihood: str = "lognormal"
    priors: dict[str, Any] = _dict()
    backend_params: dict[str, Any] = _dict()

    def __post_init__(self):
        if self.backend not in BACKENDS:
            raise ValueError(f"model.backend: one of {BACKENDS} is needed, not {self.backend!r}")
        if self.likelihood not in LIKELIHOODS:
            raise ValueError(f"model.likelihood: one of {LIKELIHOODS} is needed, not {self.likelihood!r}")
        for channel, bounds in (self.priors.get("roi_bounds") or {}).items():
            if len(bounds) != 2 or not bounds[0] < bounds[1]:
                raise ValueError(f"model.priors.roi_bounds.{channel}: a lower and a higher number are needed")


@dataclass(frozen=True)
class Optimization:
    objective: str = "roas"
    platform_constraints: dict[str, Any] = _dict()
    scenario_presets: dict[str, Any] = _dict("scenario -> multiplier, or a mapping with budget_multiplier")

    def __post_init__(self):
        for name, preset in self.scenario_presets.items():
            factors = {"budget_multiplier": preset} if not isinstance(preset, dict) else {"budget_multiplier": preset.get("budget_multiplier"), **(preset.get("platform_adjustments") or {})}
            for what, x in factors.items():
                if isinstance(x, bool) or not isinstance(x, int | float) or x <= 0:
                    raise ValueError(f"optimization.scenario_presets.{name}.{what}: a positive number is needed")

        for name, channel in (self.platform_constraints.get("platform_specific") or {}).items():
            low, high = self._shares(channel or {})
            if not 0 <= low <= high <= 1:
                raise ValueError(f"optimization.platform_constraints.platform_specific.{name}: shares from 0 to 1 are needed, the least first")
        if self.objective not in ("roas", "revenue"):
            raise ValueError("optimization.objective: roas or revenue is needed; of one budget both have the same optimum")

    def _shares(self, own: dict[str, Any]) -> tuple[float, float]:
        given = self.platform_constraints
        pick = lambda side, rest: float(own.get(f"{side}_spend_pct", given.get(f"{side}_spend_pct", given.get(f"default_{side}_spend_pct", rest))))
        return pick("min", 0.05), pick("max", 0.4)

    def shares(self) -> tuple[dict[str, tuple[float, float]], tuple[float, float]]:
        """Least and largest share of the budget by channel, and those of the others."""
        return {n: self._shares(c or {}) for n, c in (self.platform_constraints.get("platform_specific") or {}).items()}, self._shares({})

    def adjustments(self) -> list[tuple[str, str, float]]:
        """(scenario, channel, factor): how a scenario moves present spend between channels."""
        return [(n, c, float(x)) for n, p in self.scenario_presets.items() if isinstance(p, dict) for c, x in (p.get("platform_adjustments") or {}).items()]

    def multipliers(self) -> list[tuple[str, float]]:
        """(scenario, factor of the budget); the present budget is always among them."""
        given = {n: float(p["budget_multiplier"] if isinstance(p, dict) else p) for n, p in self.scenario_presets.items()}
        return list(({"current": 1.0} | given).items())


@dataclass(frozen=True)
class Settings:
    paths: Paths = field(default_factory=Paths)
    data: Data = field(default_factory=Data)
    validation: Validation = field(default_factory=Validation)
    features: Features = field(default_factory=Features)
    model: Model = field(default_factory=Model)
    optimization: Optimization = field(default_factory=Optimization)
    evaluation: dict[str, Any] = _dict()
    training: dict[str, Any] = _dict()
    rest: dict[str, Any] = _dict("sections that no job reads")


def bound(kind: type, given: dict[str, Any]):
    """A record of ``kind`` from a mapping; records in records likewise. Keys it has no field for go to its rest."""
    known = {f.name: f for f in fields(kind)}
    values = {k: v for k, v in given.items() if k in known and k != "rest" and v is not None}
    for name, f in known.items():
        inner = f.default_factory
        if isinstance(inner, type) and is_dataclass(inner) and name in values:
            values[name] = bound(inner, values[name])
    if "rest" in known:
        values["rest"] = {k: v for k, v in given.items() if k not in known}
    return kind(**values)


def merged(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    """``base`` with what ``over`` says instead, mapping by mapping; lists are replaced whole."""
    both = lambda k: isinstance(base.get(k), dict) and isinstance(over[k], dict)
    return {**base, **{k: merged(base[k], over[k]) if both(k) else over[k] for k in over}}


def read_yaml(path: str | Path) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def load(path: str | Path, profile: str | None = None) -> Settings:
    """Settings of a file, with those of profiles/<profile>.yaml beside it laid over them."""
    given = read_yaml(path)
    if profile:
        given = merged(given, read_yaml(Path(path).parent / "profiles" / f"{profile}.yaml"))
    return bound(Settings, given)


def problems(settings: Settings) -> list[str]:
    """What a run would stumble over, all of it: channels without a column, response and carry-over out of range, bounds that
    leave no allocation, presets for channels that aren't there."""
    found = []
    channels = set(settings.data.channel_map)
    if not channels:
        found.append("data.channel_map is empty")
    for channel in sorted(channels):
        carry, curve = settings.features.carry_over(channel), settings.features.response(channel)
        decay = carry.get("decay", carry.get("lambda"))
        if carry.get("type", "geometric") == "geometric" and not (isinstance(decay, int | float) and 0 <= decay < 1):
            found.append(f"features.adstock of {channel}: a decay from 0 to below 1 is needed, not {decay!r}")
        if carry.get("type") == "weibull" and not all(isinstance(carry.get(k), int | float) and carry[k] > 0 for k in ("shape", "scale")):
            found.append(f"features.adstock of {channel}: shape and scale above 0 are needed")
        if not all(isinstance(curve.get(k, 1.0), int | float) and curve.get(k, 1.0) > 0 for k in ("k", "s")):
            found.append(f"features.saturation of {channel}: k and s above 0 are needed")
    found += settings.features.wear()[1]
    shares, rest = settings.optimization.shares()
    sides = [shares.get(c, rest) for c in sorted(channels)]
    if channels and (sum(a for a, _ in sides) > 1 or sum(b for _, b in sides) < 1):
        found.append("optimization.platform_constraints leave no allocation: budgets fall back to present shares")
    known = channels or {c for _, c, _ in settings.optimization.adjustments()}
    found += [f"optimization: {c} isn't in data.channel_map" for c in sorted({*shares, *(c for _, c, _ in settings.optimization.adjustments())} - known)]
    return found


def resolved(settings: Settings, base: str | Path) -> Settings:
    """Settings whose relative folders start at ``base``; absolute ones and those with a scheme stay."""
    from dataclasses import replace

    own = lambda p: p if "://" in p or Path(p).is_absolute() else str(Path(base) / p)
    return replace(settings, paths=Paths(**{f.name: own(getattr(settings.paths, f.name)) for f in fields(Paths)}))


def require_channels(settings: Settings, channels: tuple[str, ...] = ("google_search", "meta_facebook")) -> None:
    missing = [c for c in channels if c not in settings.data.channel_map]
    if missing:
        raise ValueError(f"data.channel_map lacks {', '.join(missing)}")
