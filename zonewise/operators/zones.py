"""Zone state: means per zone, fusion of traffic and pollution, scores, event classes, anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewise.functions.geo import zone_ordinal
from zonewise.functions.labels import event_class, zone_score
from zonewise.functions.numeric import default_if_falsy, exact_mean, joined_sum, not_nan, sum_parts

AQI_DIGITS = 6

# What stands in for a missing or zero measure, and for a side without data.
READING_DEFAULTS = {"zone_id": "MN-01", "speed_kmh": 30.0, "borough": "", "aqi": 50.0, "pm25": 10.0, "no2": 20.0}
FUSION_DEFAULTS = {"avg_speed": 40.0, "borough": "", "avg_aqi": 50.0, "avg_pm25": 10.0, "avg_no2": 20.0}
CLUSTER_DEFAULTS = {"avg_speed": 30.0, "avg_aqi": 50.0, "avg_pm25": 10.0}


def with_reading_defaults(readings: DataFrame, null_only: bool = False) -> DataFrame:
    """Fill the measures a reading lacks; by default a zero counts as missing."""
    return readings.withColumns({
        name: default_if_falsy(F.col(name), value, null_only)
        for name, value in READING_DEFAULTS.items()
        if name in readings.columns
    })


def traffic_means(traffic: DataFrame, order: Column, by: list[str] | None = None) -> DataFrame:
    """Mean speed per zone; the borough is that of the zone's first row.

    A text column inside `min_by` cannot use hash aggregation, so rows are first reduced to one per
    (zone, borough), and only that small result is asked for its first borough.
    """
    by = by or []
    reduced = traffic.groupBy("zone_id", *by, "borough").agg(
        *[F.sum(part).alias(f"_part{i}") for i, part in enumerate(sum_parts(F.col("speed_kmh")))],
        F.count(not_nan(F.col("speed_kmh"))).alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
        F.min(order).alias("_first"),
    )
    return reduced.groupBy("zone_id", *by).agg(
        (joined_sum(*[F.sum(f"_part{i}") for i in range(3)]) / F.nullif(F.sum("_n"), F.lit(0)).cast("double")).alias("avg_speed"),
        F.min_by("borough", "_first").alias("borough"),
        F.sum("_rows").alias("n_rows"),
    )


def pollution_means(pollution: DataFrame, by: list[str] | None = None) -> DataFrame:
    return pollution.groupBy("zone_id", *(by or [])).agg(
        exact_mean(F.col("aqi")).alias("avg_aqi"),
        exact_mean(F.col("pm25")).alias("avg_pm25"),
        exact_mean(F.col("no2")).alias("avg_no2"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def fused_means(readings: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Both means from one frame that holds traffic and pollution rows: one scan and one shuffle.

    A measure is null in the rows of the other kind, so each mean sees its own rows, and a zone with one
    kind only still gets its row, as with a full outer join.
    """
    return readings.groupBy("zone_id", *(by or [])).agg(
        exact_mean(F.col("speed_kmh")).alias("avg_speed"),
        exact_mean(F.col("aqi")).alias("avg_aqi"),
        exact_mean(F.col("pm25")).alias("avg_pm25"),
        exact_mean(F.col("no2")).alias("avg_no2"),
    )


def fuse(traffic: DataFrame, pollution: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Full outer join of the two mean tables by zone. Both come out of aggregates on the same keys, so the
    join adds no shuffle."""
    keys = ["zone_id", *(by or [])]
    return traffic.drop("n_rows").join(pollution.drop("n_rows"), keys, "full_outer")


def with_defaults(state: DataFrame, defaults: dict) -> DataFrame:
    return state.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items() if name in state.columns
    })


def scored(state: DataFrame, inverted: bool = False, **thresholds: float) -> DataFrame:
    """Fill missing sides, then add `zone_score` and `event_type`."""
    filled = with_defaults(state, FUSION_DEFAULTS)
    return filled.withColumns({
        "zone_score": zone_score(F.col("avg_speed"), F.col("avg_aqi"), inverted),
        "event_type": event_class(F.col("avg_speed"), F.col("avg_aqi"), **thresholds),
    })


def cluster_inputs(zones: DataFrame, state: DataFrame, min_zones: int = 4) -> DataFrame:
    """Every zone of the dimension with the clustering defaults; no rows while fewer than `min_zones` have
    data."""
    live = state.agg(F.countDistinct("zone_id")).scalar()
    joined = zones.join(state.select("zone_id", *CLUSTER_DEFAULTS), "zone_id", "left")
    return with_defaults(joined, CLUSTER_DEFAULTS).filter(live >= F.lit(min_zones))


def anomaly_summary(scores: DataFrame, by: list[str], shown: int = 5) -> DataFrame:
    """Per group: how many zones are not NORMAL, and the first few as text, in zone order.

    The limited row number is applied before the shuffle, so a task holds a few rows per group.
    """
    unusual = scores.filter(F.col("event_type") != "NORMAL")
    counts = unusual.groupBy(*by).agg(F.count(F.lit(1)).alias("n_anomalies"))
    along = Window.partitionBy(*by).orderBy(zone_ordinal(F.col("zone_id")).asc_nulls_last(), "zone_id")
    first = unusual.withColumn("_nth", F.row_number().over(along)).filter(F.col("_nth") <= shown)
    texts = first.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("_nth", F.concat_ws(":", "zone_id", "event_type").alias("text"))))
        .alias("_texts")
    ).select(*by, F.array_join("_texts.text", ", ").alias("examples"))
    return counts.join(texts, by)
