"""Final zone scores, ranking, the status policy and the recommendation of every worker."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.geo import zone_ordinal
from zonewise.functions.labels import recommendation_reason
from zonewise.functions.numeric import lookup, percent_of

_DEFAULT_LABEL = dims.CLUSTER_NAMES[-1]


def final_scores(scores: DataFrame, labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Zone score times the weight of its cluster (1.0 for an unknown or missing cluster)."""
    keys = ["zone_id", *[b for b in (by or []) if b in labels.columns]]
    joined = scores.join(labels.select(*keys, "cluster"), keys, "left")
    weight = F.coalesce(lookup(F.col("cluster"), dims.CLUSTER_WEIGHTS), F.lit(1.0))
    return joined.withColumn("final_score", F.col("zone_score") * weight)


def ranked(final: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Position by score, best first; equal scores keep the zone order. One row per zone goes in."""
    order = Window.partitionBy(*(by or [])).orderBy(
        F.desc("final_score"), zone_ordinal(F.col("zone_id")).asc_nulls_last(), "zone_id"
    )
    return final.withColumn("position", F.row_number().over(order))


def policy(final: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The zone to recommend per worker status: (status, rec_zone, rec_label, rec_score).

    CRITICAL: best safe corridor. WARNING: best zone that is not permanently hazardous. SAFE: best of all.
    Without a candidate the best of all is used. One aggregate finds the three winners.
    """
    by = by or []
    zone = F.struct(F.col("zone_id").alias("rec_zone"), F.col("cluster").alias("rec_label"),
                    F.col("final_score").alias("rec_score"))
    quality = F.struct("final_score", -F.coalesce(zone_ordinal(F.col("zone_id")), F.lit(2 ** 30)))
    hazardous = F.col("cluster") == dims.CLUSTER_NAMES[0]
    winners = final.groupBy(*by).agg(
        F.max_by(zone, quality).alias("best"),
        F.max_by(zone, F.when(F.col("cluster") == _DEFAULT_LABEL, quality)).alias("safe"),
        F.max_by(zone, F.when(F.coalesce(~hazardous, F.lit(True)), quality)).alias("fair"),
    )
    rows = F.array(
        F.struct(F.lit("CRITICAL").alias("status"), F.coalesce("safe", "best").alias("z")),
        F.struct(F.lit("WARNING").alias("status"), F.coalesce("fair", "best").alias("z")),
        F.struct(F.lit("SAFE").alias("status"), F.col("best").alias("z")),
    )
    return winners.select(*by, F.explode(rows).alias("r")).select(*by, "r.status", "r.z.*") \
        .withColumn("rec_label", F.coalesce("rec_label", F.lit("")))


def recommendations(
    exposure: DataFrame, policies: DataFrame, daily_limit_hours: float = 8.0, by: list[str] | None = None
) -> DataFrame:
    """One recommendation per worker row."""
    hours = F.col("hours_in_high_aqi")
    keys = ["status", *(by or [])]
    return exposure.withColumn("status", F.col("exposure_status")).join(policies, keys, "left").select(
        "worker_id", *(by or []), "zone_id", F.col("zone_id").alias("current_zone"), "rec_zone", "rec_label",
        "rec_score", "status", "exposure_status",
        recommendation_reason(F.col("status"), hours, F.col("rec_score")).alias("reason"),
        "hours_in_high_aqi", F.coalesce("daily_avg_aqi", F.lit(50.0)).alias("daily_avg_aqi"),
        percent_of(hours, daily_limit_hours).alias("who_pct"),
    )


def label_precedence(
    zones: DataFrame, streaming: DataFrame, offline: DataFrame, fallback: DataFrame | None = None
) -> DataFrame:
    """Streaming label, else offline, else a fallback table, per zone of the dimension."""
    joined = zones.select("zone_id") \
        .join(streaming.select("zone_id", F.col("cluster").alias("_live")), "zone_id", "left") \
        .join(offline.select("zone_id", F.col("cluster").alias("_offline")), "zone_id", "left")
    if fallback is None:
        joined = joined.withColumn("_fallback", F.lit(None).cast("string"))
    else:
        joined = joined.join(fallback.select("zone_id", F.col("cluster").alias("_fallback")), "zone_id", "left")
    return joined.select("zone_id", F.coalesce("_live", "_offline", "_fallback").alias("cluster"))


def gated_labels(zones: DataFrame, streaming: DataFrame, offline: DataFrame, needed: int = 4) -> DataFrame:
    """Streaming labels only while at least `needed` different names are live; otherwise offline, then
    streaming, then Safe Corridor."""
    live_names = streaming.agg(F.countDistinct("cluster")).scalar()
    joined = zones.select("zone_id") \
        .join(streaming.select("zone_id", F.col("cluster").alias("_live")), "zone_id", "left") \
        .join(offline.select("zone_id", F.col("cluster").alias("_offline")), "zone_id", "left")
    blended = F.coalesce("_offline", "_live", F.lit(_DEFAULT_LABEL))
    return joined.select(
        "zone_id", F.when(live_names >= needed, F.col("_live")).otherwise(blended).alias("cluster")
    )


def overlaid(exposure: DataFrame, recommendation: DataFrame, key: str = "worker_id") -> DataFrame:
    """Exposure rows with the recommendation's fields on top; either side may be absent."""
    shared = [c for c in exposure.columns if c in recommendation.columns and c != key]
    left_only = [c for c in exposure.columns if c not in recommendation.columns]
    right_only = [c for c in recommendation.columns if c not in exposure.columns]
    e, r = exposure.alias("e"), recommendation.alias("r")
    return e.join(r, F.col(f"e.{key}") == F.col(f"r.{key}"), "full_outer").select(
        F.coalesce(f"e.{key}", f"r.{key}").alias(key),
        *[F.coalesce(f"r.{c}", f"e.{c}").alias(c) for c in shared],
        *[F.col(f"e.{c}") for c in left_only], *[F.col(f"r.{c}") for c in right_only],
    )
