"""Reporting: counts, KPIs, rankings, cross-tabs, histograms, summaries, histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.geo import borough_name, zone_ordinal
from zonewise.functions.labels import event_class_name, marker_radius, score_bucket, status_rank
from zonewise.functions.numeric import exact_mean, exact_stddev_samp
from zonewise.operators.ordered import latest_rows
from zonewise.operators.quantiles import exact_quantiles

#: Rows that each task may keep for a limit.
FEW = 10_000


def zero_filled_counts(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Count per name, 0 for the names that do not occur."""
    dimension = dims.names_frame(rows.sparkSession, column, names).select(column)
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(counts, column, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def event_counts(scores: DataFrame, column: str = "event_type") -> DataFrame:
    return zero_filled_counts(
        scores.select(event_class_name(F.col(column)).alias(column)), column, dims.EVENT_CLASSES
    )


def status_counts(exposure: DataFrame) -> DataFrame:
    return zero_filled_counts(exposure, "exposure_status", dims.EXPOSURE_STATUSES)


def city_kpis(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean score, mean AQI, active and compound events."""
    return scores.groupBy(*(by or [])).agg(
        exact_mean(F.col("zone_score")).alias("avg_zone_score"),
        exact_mean(F.col("avg_aqi")).alias("avg_city_aqi"),
        F.count_if(F.col("event_type") != "NORMAL").alias("active_events"),
        F.count_if(F.col("event_type") == "COMPOUND_EVENT").alias("compound_events"),
    )


def mean_exposure(exposure: DataFrame) -> DataFrame:
    return exposure.agg(
        exact_mean(F.col("hours_in_high_aqi")).alias("avg_hours"), F.count(F.lit(1)).alias("n_workers")
    )


def workers_per_zone(positions: DataFrame) -> DataFrame:
    return positions.groupBy("zone_id").agg(F.count(F.lit(1)).alias("workers"))


def busiest_zones(counts: DataFrame, n: int = 3) -> DataFrame:
    return counts.orderBy(F.desc("workers"), zone_ordinal(F.col("zone_id")).asc_nulls_last()).limit(n)


def zone_map(zones: DataFrame, scores: DataFrame, labels: DataFrame, workers: DataFrame) -> DataFrame:
    """Every zone with its score, label, worker count, status and marker size."""
    joined = zones.select("zone_id", "lat", "lon").join(scores, "zone_id", "left") \
        .join(labels.select("zone_id", "cluster"), "zone_id", "left").join(workers, "zone_id", "left")
    return joined.withColumn("workers", F.coalesce("workers", F.lit(0))).withColumns({
        "borough": borough_name(F.col("zone_id")),
        "status": score_bucket(F.col("zone_score")),
        "radius": marker_radius(F.col("workers")),
        "cluster": F.coalesce("cluster", F.lit("")),
    })


def cluster_cards(labelled: DataFrame) -> DataFrame:
    """Per cluster name: zones, mean AQI, mean speed and weight; an empty cluster shows 0."""
    dimension = dims.names_frame(labelled.sparkSession, "cluster", dims.CLUSTER_NAMES)
    stats = labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_zones"),
        exact_mean(F.col("avg_aqi")).alias("mean_aqi"),
        exact_mean(F.col("avg_speed")).alias("mean_speed"),
    )
    weight = F.create_map(*[F.lit(x) for pair in dims.CLUSTER_WEIGHTS.items() for x in pair])
    return dimension.join(stats, "cluster", "left").select(
        "cluster", weight[F.col("cluster")].alias("weight"),
        F.coalesce("n_zones", F.lit(0)).alias("n_zones"),
        F.coalesce("mean_aqi", F.lit(0.0)).alias("mean_aqi"),
        F.coalesce("mean_speed", F.lit(0.0)).alias("mean_speed"),
    )


def cluster_members(labelled: DataFrame) -> DataFrame:
    """All zones of every cluster as sorted rows, which suits any number of zones."""
    return labelled.select("cluster", "zone_id").orderBy("cluster", "zone_id")


def cluster_composition(labelled: DataFrame, shown: int = 4) -> DataFrame:
    """Per cluster: number of zones and the first few by name, with an ellipsis if there are more."""
    counts = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_zones"))
    along = Window.partitionBy("cluster").orderBy("zone_id")
    first = labelled.withColumn("_nth", F.row_number().over(along)).filter(F.col("_nth") <= shown) \
        .groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_list("zone_id")), ", ").alias("_zones"))
    more = F.when(F.col("n_zones") > shown, "…").otherwise("")
    return counts.join(first, "cluster").select(
        "cluster", "n_zones", F.concat("_zones", more).alias("zones")
    )


def borough_cluster_crosstab(labelled: DataFrame) -> DataFrame:
    """Zones per borough and cluster, all four cluster columns in hazard order."""
    return labelled.select(borough_name(F.col("zone_id")).alias("borough"), "cluster") \
        .groupBy("borough").pivot("cluster", dims.CLUSTER_NAMES).count().fillna(0)


def by_risk(workers: DataFrame, n: int | None = None) -> DataFrame:
    """Most urgent status first, then most hours."""
    hours = F.coalesce("hours_in_high_aqi", F.lit(0.0))
    ordered = workers.orderBy(status_rank(F.col("exposure_status")), hours.desc(), "worker_id")
    return ordered if n is None else ordered.limit(n)


def top_zones(final: DataFrame, n: int = 15) -> DataFrame:
    return final.orderBy(F.desc("final_score"), zone_ordinal(F.col("zone_id")).asc_nulls_last()).limit(n)


def most_recent(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The latest n rows by a time and then other columns. A few are kept by each task; for many, the time of the n-th is
    found by counting (`latest_rows`)."""
    latest_first = [c.desc() for c in order]
    if n <= FEW:
        return rows.orderBy(*latest_first).limit(n)
    return latest_rows(rows, F.unix_micros(order[0]), latest_first, n)


def recent_history(rows: DataFrame, order: str, n: int = 15) -> DataFrame:
    """The latest n points in ascending order."""
    return most_recent(rows, [F.col(order)], n).orderBy(order)


def distinct_counts(rows: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return rows.agg(*[count(F.col(c)).alias(f"n_{c}") for c in columns])


def column_summary(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, q1, median, q3, max) with exact quartiles, one row per column."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = rows.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter(F.col("value").isNotNull())
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"), exact_mean(F.col("value")).alias("mean"),
        exact_stddev_samp(F.col("value")).alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75]).groupBy("column").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    ])
    return stats.join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def histogram(rows: DataFrame, column: str, bins: int = 8) -> DataFrame:
    """(bin, low, high, n, mean) over equal-width bins from min to max, the last one closed; empty bins show 0.

    A constant column gets the unit range around its value.
    """
    value = F.col(column).cast("double")
    edge = rows.agg(F.struct(
        F.min(value).alias("lo"), F.max(value).alias("hi"), exact_mean(value).alias("mean")
    ).alias("e")).scalar()
    flat = F.col("_e.lo") == F.col("_e.hi")
    lo = F.when(flat, F.col("_e.lo") - 0.5).otherwise(F.col("_e.lo"))
    hi = F.when(flat, F.col("_e.hi") + 0.5).otherwise(F.col("_e.hi"))
    slot = F.least(F.floor((value - lo) / (hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    counts = rows.filter(value.isNotNull()).withColumn("_e", edge).groupBy(slot.alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    all_bins = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return all_bins.join(counts, "bin", "left").withColumn("_e", edge).select(
        "bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"), F.col("_e.mean").alias("mean"),
    )


def throughput(rows: DataFrame, time: str = "event_time", width: str = "5 seconds", seconds: float = 5.0) -> DataFrame:
    """Rows per second in every window that has rows."""
    return rows.groupBy(F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("window_start"), "n", (F.col("n") / F.lit(seconds)).alias("rows_per_sec"))


def silhouette_profile(rows: DataFrame) -> DataFrame:
    """Silhouettes sorted inside their cluster, with cluster size and overall mean.

    The order comes from a range-partitioned sort, so a large cluster is not gathered in one task.
    """
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n_in_label"))
    mean = rows.agg(exact_mean(F.col("silhouette"))).scalar()
    return rows.join(sizes, "label").withColumn("mean_silhouette", mean).orderBy("label", "silhouette", "zone_id")
