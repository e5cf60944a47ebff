"""Classification of hours, zones and groups of zones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fareweather.config import (
    BASELINE_LABEL,
    CLEAR,
    CONDITION_ORDER,
    HEAVY_RAIN,
    HIGH_LABEL,
    LIGHT_RAIN,
    LOW_LABEL,
    MEDIUM_LABEL,
    MODERATE_RAIN,
    SNOW,
    ConditionThresholds,
    ProfileThresholds,
    SensitivityThresholds,
)

# The names given to groups of zones.
PROFILE_HIGH_VOLUME_LIFT = "High-volume high demand lift zones"
PROFILE_LIFT = "High demand lift zones"
PROFILE_HIGH_VOLUME_SLOW = "High-volume duration-sensitive zones"
PROFILE_SLOW = "Duration-sensitive zones"
PROFILE_HIGH_VOLUME_FAST = "High-volume lower demand & faster trip zones"
PROFILE_LOW_VOLUME_FAST = "Low-volume lower demand & faster trip zones"
PROFILE_FAST = "Lower demand & faster trip zones"
PROFILE_HIGH_VOLUME_LOWER = "High-volume lower demand under weather zones"
PROFILE_LOWER = "Lower demand under weather zones"
PROFILE_STABLE = "Stable weather response zones"


def _zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds; an unknown rule does not hold."""
    chain = F
    for holds, label in rules:
        chain = chain.when(holds, F.lit(label))
    return chain.otherwise(F.lit(default))


def classify_condition(
    snowfall: Column,
    rain: Column,
    precipitation: Column,
    limits: ConditionThresholds = ConditionThresholds(),
) -> Column:
    wet = F.greatest(_zero(rain), _zero(precipitation))
    return first_match(
        [
            (_zero(snowfall) > 0, SNOW),
            (wet > limits.heavy_above, HEAVY_RAIN),
            (wet >= limits.moderate_from, MODERATE_RAIN),
            (wet > 0, LIGHT_RAIN),
        ],
        CLEAR,
    )


def condition_rank(condition: Column) -> Column:
    """Position in the display order; unknown conditions come last."""
    position = F.array_position(F.array(*[F.lit(c) for c in CONDITION_ORDER]), condition)
    return F.when(position > 0, position).otherwise(F.lit(99))


def sensitivity_label(
    condition: Column,
    lift: Column,
    minutes: Column,
    limits: SensitivityThresholds = SensitivityThresholds(),
    baseline: str = CLEAR,
) -> Column:
    return first_match(
        [
            (condition == baseline, BASELINE_LABEL),
            ((lift >= limits.high_lift) | (minutes >= limits.high_minutes), HIGH_LABEL),
            ((lift >= limits.medium_lift) | (minutes >= limits.medium_minutes), MEDIUM_LABEL),
        ],
        LOW_LABEL,
    )


def group_profile(
    lift: Column,
    minutes: Column,
    minutes_per_mile: Column,
    trips: Column,
    zones: Column,
    limits: ProfileThresholds = ProfileThresholds(),
) -> Column:
    """Name a group of zones after its mean reaction and its volume."""
    lift, minutes, pace, trips = (
        _zero(c.cast("double")) for c in (lift, minutes, minutes_per_mile, trips)
    )
    per_zone = trips / F.greatest(F.coalesce(zones, F.lit(0)), F.lit(1))
    busy = (trips >= limits.high_total) | (per_zone >= limits.high_per_zone)
    quiet = (trips < limits.low_total) | (per_zone < limits.low_per_zone)
    lifted = lift >= limits.high_lift
    slowed = (minutes >= limits.slow_minutes) | (pace >= limits.slow_minutes)
    lower = lift <= limits.low_lift
    faster = lower & (minutes <= limits.fast_minutes)
    return first_match(
        [
            (lifted & busy, PROFILE_HIGH_VOLUME_LIFT),
            (lifted, PROFILE_LIFT),
            (slowed & busy, PROFILE_HIGH_VOLUME_SLOW),
            (slowed, PROFILE_SLOW),
            (faster & busy, PROFILE_HIGH_VOLUME_FAST),
            (faster & quiet, PROFILE_LOW_VOLUME_FAST),
            (faster, PROFILE_FAST),
            (lower & busy, PROFILE_HIGH_VOLUME_LOWER),
            (lower, PROFILE_LOWER),
        ],
        PROFILE_STABLE,
    )
