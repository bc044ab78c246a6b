"""Inputs that several registered queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions.numeric import bucketize
from zonewise.operators import zones
from zonewise.plans import sql
from zonewise.session import checkpointed
from zonewise.sources import feeds


def scored_zones(spark: SparkSession, sf_dir: str, by: list[str] | None = None) -> DataFrame:
    scored = zones.scored(zones.fused_means(feeds.readings(feeds.events(spark, sf_dir)), by))
    return feeds.day_text(scored) if by and "day" in by else scored


def stored_zones(spark: SparkSession, sf_dir: str, by: list[str] | None = None) -> DataFrame:
    """The same state written once to the shared folder, for queries that use it more than once: a few rows
    per zone instead of another pass over the readings."""
    return checkpointed(scored_zones(spark, sf_dir, by), "zones")


# Labels for queries that only need some: by hazard (AQI above speed) and by PM2.5.
LIVE_STEPS = [(68, "Permanently Hazardous"), (64, "Peak Hour Hazardous"), (60, "Weather Sensitive")]
OFFLINE_STEPS = [(52, "Permanently Hazardous"), (48, "Peak Hour Hazardous"), (45, "Weather Sensitive")]


def live_label() -> Column:
    return bucketize(F.col("avg_aqi") - F.col("avg_speed"), LIVE_STEPS, "Safe Corridor")


def offline_label() -> Column:
    return bucketize(F.col("avg_pm25"), OFFLINE_STEPS, "Safe Corridor")


def _steps_sql(expr: str, steps: list) -> str:
    arms = " ".join(f"WHEN {expr} > {sql.num(t)} THEN '{name}'" for t, name in steps)
    return f"CASE {arms} ELSE 'Safe Corridor' END"


LIVE_LABEL_SQL = _steps_sql("(avg_aqi - avg_speed)", LIVE_STEPS)
OFFLINE_LABEL_SQL = _steps_sql("avg_pm25", OFFLINE_STEPS)


def placed(events_: DataFrame) -> DataFrame:
    """The events with a place in the city: latitude from k, longitude from the user. The place is a projection
    of its own, so what uses it many times does not parse k again."""
    return events_.withColumns({
        "lat": F.lit(40.48) + feeds.props_k().cast("double") * F.lit(0.0044),
        "lon": F.lit(-74.26) + F.pmod("user_id", F.lit(560)).cast("double") * F.lit(0.001),
    })


LAT_SQL = "(40.48e0 + CAST(k AS DOUBLE) * 0.0044e0)"
LON_SQL = "(-74.26e0 + CAST(user_id % 560 AS DOUBLE) * 0.001e0)"


def segment_latitude() -> Column:
    return F.lit(40.48) + F.pmod(F.col("event_id") * 7919, F.lit(44000)).cast("double") / F.lit(100000.0)


SEGMENT_LAT_SQL = "(40.48e0 + CAST((event_id * 7919) % 44000 AS DOUBLE) / 100000e0)"
