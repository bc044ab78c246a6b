"""Exposure of workers to bad air."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.geo import zone_at, zone_ordinal
from zonewise.functions.labels import exposure_status, five_minute_slot
from zonewise.functions.numeric import fixed_point, percent_of, stable_hash
from zonewise.operators.ordered import as_of, running_totals

UNKNOWN_ZONE_AQI = 75.0
AQI_DIGITS = 4  # leaves a worker's running sum room for 10**12 readings
_AQI_UNITS = float(10 ** AQI_DIGITS)


def with_known_air(
    workers: DataFrame, pollution: DataFrame, order: str, aqi: str = "aqi", strict: bool = False,
) -> DataFrame:
    """Each worker position with the latest AQI known for its zone at that moment, 75 before any."""
    return as_of(workers, pollution, ["zone_id"], order, aqi, UNKNOWN_ZONE_AQI, strict)


def valid_zone(zone_id: Column, worker_id: Column, time: Column) -> Column:
    """The zone if the dimension has it, else one fixed by worker and 5-minute slot."""
    fallback = zone_at(stable_hash(worker_id, five_minute_slot(time).cast("string")))
    return F.when(zone_ordinal(zone_id).isNotNull(), zone_id).otherwise(fallback)


def _measures(aqi: Column, profile: dims.ExposureProfile) -> dict[str, Column]:
    return {
        "count": F.lit(1),
        "n_high": F.when(aqi > profile.high_aqi, 1).otherwise(0),
        "aqi_units": fixed_point(aqi, AQI_DIGITS),
    }


def exposure_columns(profile: dims.ExposureProfile) -> dict[str, Column]:
    """Hours, mean AQI and status from the whole-number counts, which stay exact however they are added."""
    high_minutes = F.col("n_high").cast("double") * F.lit(profile.minutes_per_reading)
    hours = high_minutes / F.lit(60.0)
    return {
        "high_aqi_minutes": high_minutes,
        "total_minutes": F.col("count").cast("double") * F.lit(profile.minutes_per_reading),
        "aqi_sum": F.col("aqi_units").cast("double") / F.lit(_AQI_UNITS),
        "hours_in_high_aqi": hours,
        "daily_avg_aqi": F.col("aqi_units").cast("double") / (F.col("count").cast("double") * F.lit(_AQI_UNITS)),
        "exposure_status": exposure_status(hours, profile),
        "who_pct": percent_of(hours, profile.daily_limit_hours),
    }


def running_exposure(
    readings: DataFrame, order: Column, profile: dims.ExposureProfile = dims.PER_READING,
    keys: list[str] | None = None, aqi: str = "aqi",
) -> DataFrame:
    """Exposure of the worker after every reading. Add a day to `keys` to start anew each day."""
    totals = running_totals(readings, keys or ["worker_id"], order, _measures(F.col(aqi), profile))
    return totals.withColumns(exposure_columns(profile)).drop("aqi_units")


def partial_exposure(
    readings: DataFrame, order: Column, profile: dims.ExposureProfile = dims.PER_READING,
    keys: list[str] | None = None, aqi: str = "aqi",
) -> DataFrame:
    """Counts per worker and zone that can be added up, also when computed per micro-batch.

    A row per zone keeps the zone's text, whatever zones there are, out of the buffers: those are plain numbers.
    """
    measures = _measures(F.col(aqi), profile)
    return readings.groupBy(*(keys or ["worker_id"]), "zone_id").agg(
        *[F.sum(c).alias(n) for n, c in measures.items()], F.max(order).alias("last_order"))


def added_parts(parts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Several partial rows per key and zone as one, still addable."""
    return parts.groupBy(*(keys or ["worker_id"]), "zone_id").agg(
        *[F.sum(n).alias(n) for n in ("count", "n_high", "aqi_units")], F.max("last_order").alias("last_order"))


def last_zones(parts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The zone of each worker's last reading."""
    return parts.groupBy(*(keys or ["worker_id"])).agg(F.max_by("zone_id", "last_order").alias("zone_id"))


def combined_exposure(
    parts: DataFrame, profile: dims.ExposureProfile = dims.PER_READING, keys: list[str] | None = None
) -> DataFrame:
    """Add partial rows up, a few per worker, and derive the last zone, hours, mean and status."""
    few = added_parts(parts, keys)
    totals = few.groupBy(*(keys or ["worker_id"])).agg(
        *[F.sum(n).alias(n) for n in ("count", "n_high", "aqi_units")], F.max_by("zone_id", "last_order").alias("zone_id"))
    return totals.withColumns(exposure_columns(profile)).drop("aqi_units")


def exposure_totals(
    readings: DataFrame, order: Column, profile: dims.ExposureProfile = dims.PER_READING,
    keys: list[str] | None = None, aqi: str = "aqi",
) -> DataFrame:
    """Exposure per worker over all readings."""
    return combined_exposure(partial_exposure(readings, order, profile, keys, aqi), profile, keys)


def protective_aqi(current: Column, forecast: Column) -> Column:
    return F.greatest(current, forecast)
