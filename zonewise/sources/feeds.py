"""The four sensor feeds derived from the `events` table.

    traffic    click, view       speed = value
    pollution  error, purchase   PM2.5 = value, NO2 = props.k, AQI = the worse of both indexes
    worker     signup            worker W-nn from the user, zone from the event
    weather    every event       temperature = value - 10, humidity = props.k, wind = value / 2
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise import schemas
from zonewise.functions.air import aqi_combined
from zonewise.functions.geo import zone_at
from zonewise.functions.numeric import order_key

TRAFFIC_TYPES = ["click", "view"]
POLLUTION_TYPES = ["error", "purchase"]
WORKER_TYPES = ["signup"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_time(spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The same table as a file stream. The pattern matches just this name; as a pattern it may be a single
    file as well as a folder, which a plain stream path may not."""
    stream = spark.readStream.schema(schemas.EVENTS).options(**options)
    return with_time(stream.parquet(f"{sf_dir}/events.parque[t]"))


def with_time(rows: DataFrame) -> DataFrame:
    """Event time as a timestamp (watermarks need one) in place of the zone-less `ts`."""
    return rows.withColumn("event_time", F.col("ts").cast("timestamp")).drop("ts")


def props_k() -> Column:
    """The one number of the flat `props` object; a pattern reads it four times faster than a JSON parser."""
    return F.regexp_extract("props", r'"k"\s*:\s*(-?\d+)', 1).try_cast("int")


def _no2() -> Column:
    return props_k().cast("double")


def traffic(events_: DataFrame) -> DataFrame:
    return events_.filter(F.col("event_type").isin(TRAFFIC_TYPES)).select(
        "event_id", F.concat(F.lit("SEG-"), F.col("event_id").cast("string")).alias("segment_id"),
        zone_at(F.col("user_id")).alias("zone_id"), F.col("value").alias("speed_kmh"), "event_time",
    )


def pollution(events_: DataFrame) -> DataFrame:
    # the JSON field gets a projection of its own: inside the index it would be parsed once per segment
    rows = events_.filter(F.col("event_type").isin(POLLUTION_TYPES)).withColumn("no2", _no2())
    return rows.select(
        "event_id", F.concat(F.lit("ST-"), F.col("user_id").cast("string")).alias("station_id"),
        zone_at(F.col("user_id")).alias("zone_id"), F.col("value").alias("pm25"), "no2",
        aqi_combined(F.col("value"), F.col("no2")).alias("aqi"), "event_time",
    )


def readings(events_: DataFrame) -> DataFrame:
    """Traffic and pollution rows in one frame, from a single scan; the other kind's measures are null."""
    is_traffic = F.col("event_type").isin(TRAFFIC_TYPES)
    rows = events_.filter(F.col("event_type").isin(TRAFFIC_TYPES + POLLUTION_TYPES)).select(
        "event_id", zone_at(F.col("user_id")).alias("zone_id"), "event_time", day(),
        F.when(is_traffic, F.col("value")).alias("speed_kmh"), F.when(~is_traffic, F.col("value")).alias("pm25"),
        F.when(~is_traffic, _no2()).alias("no2"),
    )
    return rows.withColumn("aqi", aqi_combined(F.col("pm25"), F.col("no2")))


def workers(events_: DataFrame, keep: list[str] | None = None) -> DataFrame:
    number = F.lpad((F.pmod("user_id", F.lit(50)) + 1).cast("string"), 2, "0")
    return events_.filter(F.col("event_type").isin(WORKER_TYPES)).select(
        "event_id", F.concat(F.lit("W-"), number).alias("worker_id"),
        zone_at(F.col("event_id")).alias("zone_id"), "event_time", *(keep or []),
    )


def weather(events_: DataFrame) -> DataFrame:
    return events_.withColumn("humidity", _no2()).select(
        "event_id", (F.col("value") - F.lit(10.0)).alias("temperature"), "humidity",
        (F.col("value") / F.lit(2.0)).alias("windspeed"), "event_time",
    )


def day(name: str = "day") -> Column:
    """The calendar day as a date, which groups faster than text."""
    return F.to_date("event_time").alias(name)


def day_text(rows: DataFrame) -> DataFrame:
    """The same rows with `day` as text, for results."""
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def order() -> Column:
    """Unique order of the events: time, then id."""
    return order_key(F.col("event_time"), F.col("event_id"))
