"""Every threshold, bound and constant of the engine in one place.

All operators take these as parameters; the defaults below are the published
values of the analysis and are therefore fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: labels ---------------------------------------------------

CLEAR = "clear"
LIGHT_RAIN = "light_rain"
MODERATE_RAIN = "moderate_rain"
HEAVY_RAIN = "heavy_rain"
SNOW = "snow"

#: Display order of the conditions.
CONDITION_ORDER = (CLEAR, LIGHT_RAIN, MODERATE_RAIN, HEAVY_RAIN, SNOW)

BASELINE_LABEL = "baseline"
HIGH_LABEL = "high_weather_sensitive"
MEDIUM_LABEL = "medium_weather_sensitive"
LOW_LABEL = "low_weather_sensitive"

DAY_NAMES = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)


# --- parameters with their published defaults -------------------------------


@dataclass(frozen=True)
class CleaningLimits:
    """Validity limits for a trip; pairs are (low, high)."""

    passengers: tuple[float, float] = (0, 6)  # low exclusive, high inclusive
    distance: tuple[float, float] = (0, 100)  # low exclusive, high inclusive
    minutes: tuple[int, int] = (0, 360)  # low exclusive, high inclusive
    zones: tuple[int, int] = (1, 263)  # both inclusive


@dataclass(frozen=True)
class ConditionThresholds:
    """Hourly intensity limits in millimetres."""

    moderate_from: float = 2.5
    heavy_above: float = 10.0


@dataclass(frozen=True)
class SensitivityThresholds:
    high_lift: float = 25.0
    high_minutes: float = 5.0
    medium_lift: float = 10.0
    medium_minutes: float = 2.0


@dataclass(frozen=True)
class ProfileThresholds:
    """Limits that name a group of zones after its mean reaction."""

    high_lift: float = 15.0
    low_lift: float = -5.0
    slow_minutes: float = 2.0
    fast_minutes: float = -2.0
    high_total: float = 50_000.0
    high_per_zone: float = 3_000.0
    low_total: float = 10_000.0
    low_per_zone: float = 500.0


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 60
    max_depth: int = 18
    min_leaf: int = 5
    seed: int = 42
    max_bins: int = 512
    # Into how many parts the training rows are dealt follows from their number, which
    # belongs to the model's definition, and never from the machine: parts of ``few``
    # rows up to ``spread`` parts, then of ``many`` rows.
    few: int = 2_500
    many: int = 50_000
    spread: int = 64

    def parts(self, rows: int) -> int:
        return max(1, min(self.spread, -(-rows // self.few)), -(-rows // self.many))


@dataclass(frozen=True)
class ClusterSettings:
    seed: int = 42
    starts: int = 20
    most: int = 4
    least: int = 2
    zones_per_cluster: int = 20
    clip: tuple[float, float] = (0.01, 0.99)
    max_iter: int = 300
    tolerance: float = 1e-4
    parallel_fits: int = 8
    partitions: int = 4


@dataclass(frozen=True)
class Settings:
    """One run of the whole chain."""

    months: tuple[str, ...] = ("2025-01", "2025-02", "2025-03")
    fleet: str = "yellow"
    limits: CleaningLimits = field(default_factory=CleaningLimits)
    conditions: ConditionThresholds = field(default_factory=ConditionThresholds)
    sensitivity: SensitivityThresholds = field(default_factory=SensitivityThresholds)
    profiles: ProfileThresholds = field(default_factory=ProfileThresholds)
    forest: ForestSettings = field(default_factory=ForestSettings)
    clusters: ClusterSettings = field(default_factory=ClusterSettings)
    min_route_trips: int = 50
    min_zone_trips: int = 100
    split_date: str = "2025-03-01"
