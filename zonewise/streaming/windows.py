"""Native streaming aggregations: state lives in the checkpointed state store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.operators.exposure import AQI_DIGITS, exposure_columns
from zonewise.operators.zones import fused_means, scored
from zonewise.functions.numeric import fixed_point

WATERMARK = "2 minutes"


def windowed_zone_scores(
    readings: DataFrame, width: str = "30 seconds", watermark: str = WATERMARK
) -> DataFrame:
    """Zone scores per event-time window, from a stream of traffic and pollution rows.

    Each window holds the rows of its own time span, whichever batch they arrive in, so a replay gives the
    same result. Rows later than the watermark are dropped and counted in the query progress.
    """
    windowed = readings.withWatermark("event_time", watermark).withColumn("window", F.window("event_time", width))
    return scored(fused_means(windowed, ["window"]))


def exposure_stream(
    readings: DataFrame, profile: dims.ExposureProfile = dims.PER_READING, daily: bool = False,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Running exposure per worker from a stream of (worker_id, aqi, event_time); use update mode.

    `daily` starts anew each day and lets finished days leave the state.
    """
    aqi = F.col("aqi")
    keys = ["worker_id"]
    if daily:
        readings = readings.withWatermark("event_time", watermark) \
            .withColumn("day", F.window("event_time", "1 day"))
        keys.append("day")
    totals = readings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.when(aqi > profile.high_aqi, 1).otherwise(0)).alias("n_high"),
        F.sum(fixed_point(aqi, AQI_DIGITS)).alias("aqi_units"),
    )
    return totals.withColumns(exposure_columns(profile)).drop("aqi_units")
