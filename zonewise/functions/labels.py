"""Classes, statuses, names and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.numeric import bucketize, lookup, round_exact

_BOROUGH_BY_UPPER = {name.upper(): prefix for prefix, name in dims.BOROUGH_NAMES.items()}
_BOROUGH_BY_NAME = {name: prefix for prefix, name in dims.BOROUGH_NAMES.items()}


def borough_lenient(raw: Column) -> Column:
    """Borough prefix after trimming and upper-casing; blank or unknown becomes MN."""
    return lookup(F.upper(F.trim(raw)), _BOROUGH_BY_UPPER, "MN")


def borough_strict(raw: Column) -> Column:
    """Borough prefix by exact name; null when unknown, for the caller to drop."""
    return lookup(raw, _BOROUGH_BY_NAME)


def zone_score(speed: Column, aqi: Column, inverted: bool = False) -> Column:
    """Equal parts of speed against the baseline and of the AQI term, 0..1.

    The AQI term rises with the AQI, min(1, aqi/100). `inverted` falls with it: 1 - min(1, aqi/200).
    """
    flow = F.least(F.lit(1.0), speed / F.lit(dims.BASELINE_SPEED))
    if inverted:
        air = F.lit(1.0) - F.least(F.lit(1.0), aqi / F.lit(200.0))
    else:
        air = F.least(F.lit(1.0), aqi / F.lit(100.0))
    return flow * F.lit(0.5) + air * F.lit(0.5)


def event_class(
    speed: Column,
    aqi: Column,
    congestion_below: float = dims.BASELINE_SPEED * 0.85,
    pollution_above: float = 38.0,
) -> Column:
    congested = speed < F.lit(congestion_below)
    polluted = aqi > F.lit(pollution_above)
    return (
        F.when(congested & polluted, "COMPOUND_EVENT")
        .when(congested, "CONGESTION_EVENT")
        .when(polluted, "POLLUTION_ALERT")
        .otherwise("NORMAL")
    )


def event_class_name(raw: Column) -> Column:
    """Full class name for a short alias; null or unknown is NORMAL."""
    aliases = {"CONGESTION": "CONGESTION_EVENT", "POLLUTION": "POLLUTION_ALERT", "COMPOUND": "COMPOUND_EVENT"}
    return lookup(raw, {**{c: c for c in dims.EVENT_CLASSES}, **aliases}, "NORMAL")


def exposure_status(hours: Column, profile: dims.ExposureProfile) -> Column:
    return bucketize(hours, [(profile.critical_hours, "CRITICAL"), (profile.warn_hours, "WARNING")], "SAFE")


def status_rank(status: Column) -> Column:
    """0 for the most urgent status; unknown counts as SAFE."""
    return lookup(status, {"CRITICAL": 0, "WARNING": 1, "SAFE": 2}, 2)


def weather_condition(temperature: Column, humidity: Column, windspeed: Column) -> Column:
    """The most decisive condition: heat, cold, wind, humidity, else clear."""
    return (
        F.when(temperature > 30, "Hot")
        .when(temperature < 5, "Cold")
        .when(windspeed > 30, "Windy")
        .when(humidity > 80, "Humid")
        .otherwise("Clear")
    )


def score_bucket(score: Column) -> Column:
    return bucketize(score, [(0.7, "Good"), (0.4, "Moderate")], "Poor")


def rank_bucket(score: Column) -> Column:
    return bucketize(score, [(0.5, "high"), (0.25, "medium")], "low")


def city_score_bucket(score: Column) -> Column:
    return bucketize(score, [(0.6, "good"), (0.4, "fair")], "bad")


def city_aqi_bucket(aqi: Column) -> Column:
    return bucketize(aqi, [(100, "bad"), (50, "fair")], "good")


def lag_bucket(lag_ms: Column) -> Column:
    return bucketize(lag_ms, [(800, "bad"), (400, "fair")], "good")


def model_phase(n_batches: Column, inertia: Column) -> Column:
    """How settled the online model is; an infinite or missing inertia counts as 0."""
    finite = F.when(F.isnan(inertia) | (F.abs(inertia) == F.lit(float("inf"))), 0.0).otherwise(inertia)
    usable = F.coalesce(finite, F.lit(0.0))
    return (
        F.when((n_batches > 3) & (usable > 0), "Converging")
        .when(n_batches > 10, "Stable")
        .otherwise("Initialising")
    )


def recommendation_reason(status: Column, hours: Column, score: Column) -> Column:
    # rounding first makes the text independent of the formatter's rule for ties
    hours_text = F.format_string("%.1f", round_exact(hours, 1))
    score_text = F.format_string("%.2f", round_exact(score, 2))
    return (
        F.when(status == "CRITICAL", F.concat(F.lit("Near limit ("), hours_text, F.lit("h) → Safe Corridor")))
        .when(status == "WARNING",
              F.concat(F.lit("Approaching limit ("), hours_text, F.lit("h) → avoiding hazardous")))
        .otherwise(F.concat(F.lit("Best available zone (score "), score_text, F.lit(")")))
    )


def shorten(text: Column, length: int = 55) -> Column:
    return F.substring(text, 1, length)


def marker_radius(workers: Column) -> Column:
    return F.lit(500) + workers * F.lit(80)


def iso_seconds(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def five_minute_slot(time: Column) -> Column:
    return F.floor(F.unix_timestamp(time) / F.lit(300)).cast("bigint")
