"""The zone feature matrix used for offline clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.air import aqi_proxy
from zonewise.functions.geo import borough_id, density, nearest_zone
from zonewise.functions.numeric import exact_mean, exact_stddev_pop, exact_stddev_samp, lookup
from zonewise.operators.quantiles import SALTS, exact_quantiles
from zonewise.session import checkpointed

# Percent positions of the latitude breaks inside a borough.
LATITUDE_PERCENTS = [0, 16.7, 33.3, 50, 66.7, 83.3, 100]
SLOW_MPH = 20.0


def latitude_breaks(traffic: DataFrame) -> DataFrame:
    """borough_id, the seven break latitudes in ascending order, and the number of rows: a stored table of a row per
    borough, so that traffic is joined with a table of known size."""
    quantiles = exact_quantiles(traffic, ["borough_id"], "lat", [p / 100 for p in LATITUDE_PERCENTS])
    return checkpointed(quantiles.groupBy("borough_id").agg(
        F.array_sort(F.collect_list(F.struct("probability", "quantile"))).alias("_b"), F.first("n").alias("n")
    ).select("borough_id", F.col("_b.quantile").alias("breaks"), "n"), "breaks")


def latitude_zones(traffic: DataFrame, breaks: DataFrame) -> DataFrame:
    """Add `zone_id` by half-open latitude bin [b_i, b_i+1). The row on the top break and the rows of a
    borough with a single row fall in no bin (null)."""
    passed = sum(
        (F.when(F.col("lat") >= F.get("breaks", F.lit(i)), 1).otherwise(0) for i in range(len(LATITUDE_PERCENTS))),
        F.lit(0),
    )
    in_bin = (F.col("n") > 1) & (F.col("_bin") < F.lit(len(LATITUDE_PERCENTS)))
    zone = F.concat("borough_id", F.lit("-0"), F.col("_bin").cast("string"))
    # salted, as a few boroughs share all rows
    salted = traffic.withColumn("_salt", F.pmod(F.xxhash64("lat", "speed"), F.lit(SALTS)).cast("int"))
    every_salt = breaks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(every_salt, ["borough_id", "_salt"]).withColumn("_bin", passed) \
        .withColumn("zone_id", F.when(in_bin, zone)).drop("_bin", "breaks", "n", "_salt")


def _speed_stats(rows: DataFrame, key: str, prefix: str = "") -> DataFrame:
    return rows.groupBy(key).agg(
        exact_mean(F.col("speed")).alias(f"{prefix}avg_speed"),
        exact_stddev_pop(F.col("speed")).alias(f"{prefix}std_speed"),
        exact_mean((F.col("speed") < SLOW_MPH).cast("double")).alias(f"{prefix}pct_slow"),
    )


def traffic_features(zones: DataFrame, traffic: DataFrame) -> DataFrame:
    """avg_speed, std_speed and pct_slow per zone, from (borough_id, lat, speed) rows.

    An empty bin takes the values of the whole borough, a borough without rows its default speed.
    """
    binned = latitude_zones(traffic, latitude_breaks(traffic))
    by_zone = _speed_stats(binned.filter(F.col("zone_id").isNotNull()), "zone_id")
    by_borough = _speed_stats(traffic, "borough_id", "b_")
    default_speed = lookup(F.col("borough_id"), dims.BOROUGH_DEFAULT_SPEED, 30.0)
    joined = zones.select("zone_id", borough_id(F.col("zone_id")).alias("borough_id")) \
        .join(by_zone, "zone_id", "left").join(by_borough, "borough_id", "left")
    return joined.select(
        "zone_id",
        F.coalesce("avg_speed", "b_avg_speed", default_speed).alias("avg_speed"),
        F.coalesce("std_speed", "b_std_speed", F.lit(0.0)).alias("std_speed"),
        F.coalesce("pct_slow", "b_pct_slow", (default_speed < SLOW_MPH).cast("double")).alias("pct_slow"),
    )


def pollution_features(pollution: DataFrame) -> DataFrame:
    """avg, max and sample std of PM2.5 per nearest zone, from (latitude, longitude, value) rows."""
    placed = pollution.withColumn("zone_id", nearest_zone(F.col("latitude"), F.col("longitude")))
    return placed.groupBy("zone_id").agg(
        exact_mean(F.col("value")).alias("avg_pm25"),
        F.max("value").alias("max_pm25"),
        F.coalesce(exact_stddev_samp(F.col("value")), F.lit(0.0)).alias("std_pm25"),
    )


def zone_features(zones: DataFrame, traffic: DataFrame, pollution: DataFrame) -> DataFrame:
    """The full matrix: one row per zone of the dimension."""
    joined = traffic_features(zones, traffic).join(pollution_features(pollution), "zone_id", "left") \
        .fillna(0.0, ["avg_pm25", "max_pm25", "std_pm25"])
    return joined.withColumns({
        "density": density(F.col("zone_id")),
        "avg_aqi_proxy": aqi_proxy(F.col("avg_pm25")),
    })


def live_features(rows: DataFrame, std_speed: float = 5.0) -> DataFrame:
    """The seven model inputs of a live (zone_id, avg_speed, avg_pm25) row."""
    speed, pm25 = F.col("avg_speed"), F.col("avg_pm25")
    given_std = F.col("std_speed") if "std_speed" in rows.columns else F.lit(std_speed)
    return rows.withColumns({
        "std_speed": given_std,
        "pct_slow": (speed < SLOW_MPH).cast("double"),
        "std_pm25": F.lit(0.0),
        "avg_aqi_proxy": aqi_proxy(pm25),
        "density": density(F.col("zone_id")),
    })
