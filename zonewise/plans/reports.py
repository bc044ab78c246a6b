"""Reports: cluster tables, cross-tabs, summaries, histograms, throughput, histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.geo import borough_name
from zonewise.functions.numeric import exact_mean, exact_stddev_pop
from zonewise.operators import report
from zonewise.operators.ordered import latest_rows
from zonewise.plans import Registry, common, sql
from zonewise.sinks.tables import bounded_history
from zonewise.sources import feeds

registry = Registry()

_LABELLED = f"labelled AS (SELECT *, {common.LIVE_LABEL_SQL} AS cluster FROM scored)"
_NAMES = ", ".join(f"('{n}', {sql.num(dims.CLUSTER_WEIGHTS[n])})" for n in dims.CLUSTER_NAMES)


def labelled(spark, sf_dir, by=None):
    return common.scored_zones(spark, sf_dir, by).withColumn("cluster", common.live_label())


@registry.add(sql.query(
    "SELECT n.cluster, n.weight, coalesce(n_zones, 0) AS n_zones, coalesce(mean_aqi, 0e0) AS mean_aqi, "
    f"coalesce(mean_speed, 0e0) AS mean_speed FROM (VALUES {_NAMES}) n(cluster, weight) LEFT JOIN "
    f"(SELECT cluster, count(*) AS n_zones, {sql.mean('avg_aqi')} AS mean_aqi, {sql.mean('avg_speed')} AS mean_speed "
    "FROM labelled GROUP BY cluster) USING (cluster)",
    sql.state(), _LABELLED,
))
def cluster_cards(spark, sf_dir):
    return report.cluster_cards(labelled(spark, sf_dir))


@registry.add(sql.query("SELECT cluster, zone_id FROM labelled", sql.state(), _LABELLED))
def cluster_members(spark, sf_dir):
    return report.cluster_members(labelled(spark, sf_dir))


@registry.add(sql.query(
    "SELECT cluster, count(*) AS n_zones, string_agg(CASE WHEN nth <= 4 THEN zone_id END, ', ' ORDER BY zone_id) "
    "|| CASE WHEN count(*) > 4 THEN '…' ELSE '' END AS zones FROM (SELECT cluster, zone_id, row_number() OVER "
    "(PARTITION BY cluster ORDER BY zone_id) AS nth FROM labelled) GROUP BY cluster",
    sql.state(), _LABELLED,
))
def cluster_composition(spark, sf_dir):
    stored = common.stored_zones(spark, sf_dir).withColumn("cluster", common.live_label())
    return report.cluster_composition(stored)


_PIVOT = ", ".join(
    f"CAST(sum(CASE WHEN cluster = '{n}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{n}\"" for n in dims.CLUSTER_NAMES
)


@registry.add(sql.query(
    f"SELECT {sql.borough('zone_id')} AS borough, {_PIVOT} FROM labelled GROUP BY 1", sql.state("day"), _LABELLED,
))
def borough_cluster_crosstab(spark, sf_dir):
    return report.borough_cluster_crosstab(labelled(spark, sf_dir, ["day"]))


def _quantile_sql(p: float) -> str:
    """Linear interpolation between the two neighbour rows, measured from the nearer one."""
    rank = f"({sql.num(p)} * CAST(max(n) - 1 AS DOUBLE))"
    low = f"max(CASE WHEN rn = CAST(floor({sql.num(p)} * CAST(n - 1 AS DOUBLE)) AS BIGINT) THEN v END)"
    high = f"max(CASE WHEN rn = CAST(ceil({sql.num(p)} * CAST(n - 1 AS DOUBLE)) AS BIGINT) THEN v END)"
    frac = f"({rank} - floor({rank}))"
    return (f"CASE WHEN {frac} >= 0.5e0 THEN {high} - ({high} - {low}) * (1e0 - {frac}) "
            f"ELSE {low} + ({high} - {low}) * {frac} END")


def summary_sql(source: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count(v) AS count, {sql.mean('v')} AS mean, "
        f"{sql.stddev_samp('v')} AS std, min(v) AS min, {_quantile_sql(0.25)} AS q1, "
        f"{_quantile_sql(0.5)} AS median, {_quantile_sql(0.75)} AS q3, max(v) AS max FROM (SELECT {column} AS v, "
        f"row_number() OVER (ORDER BY {column}) - 1 AS rn, count(*) OVER () AS n FROM {source})"
    )


@registry.add(sql.query(" UNION ALL ".join(summary_sql("pollution", c) for c in ("pm25", "no2"))))
def column_summary(spark, sf_dir):
    return report.column_summary(feeds.pollution(feeds.events(spark, sf_dir)), ["pm25", "no2"])


@registry.add(sql.query(
    "SELECT CAST(b.bin AS INTEGER) AS bin, lo + b.bin * ((hi - lo) / 8e0) AS low, lo + (b.bin + 1) * ((hi - lo) / 8e0) AS high, "
    "coalesce(n, 0) AS n, mean FROM range(8) b(bin), "
    f"(SELECT min(speed_kmh) AS lo, max(speed_kmh) AS hi, {sql.mean('speed_kmh')} AS mean FROM traffic) e "
    "LEFT JOIN (SELECT least(floor((speed_kmh - lo) / (hi - lo) * 8e0), 7e0) AS slot, count(*) AS n FROM traffic, "
    "(SELECT min(speed_kmh) AS lo, max(speed_kmh) AS hi FROM traffic) GROUP BY 1) c ON c.slot = b.bin"
))
def feature_histogram(spark, sf_dir):
    return report.histogram(feeds.traffic(feeds.events(spark, sf_dir)), "speed_kmh")


@registry.add(sql.query(
    "SELECT count(DISTINCT station_id) AS n_station_id, count(DISTINCT zone_id) AS n_zone_id FROM pollution"
))
def distinct_counts(spark, sf_dir):
    return report.distinct_counts(feeds.pollution(feeds.events(spark, sf_dir)), ["station_id", "zone_id"])


_HOURLY = ("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, "
           "CAST(count(*) AS DOUBLE) / 3600e0 AS rows_per_sec FROM traffic GROUP BY 1")


def _hourly(spark, sf_dir):
    rows = report.throughput(feeds.traffic(feeds.events(spark, sf_dir)), "event_time", "1 hour", 3600.0)
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@registry.add(sql.query(_HOURLY))
def throughput_window(spark, sf_dir):
    return _hourly(spark, sf_dir)


@registry.add(sql.query(f"SELECT * FROM ({_HOURLY}) ORDER BY window_start DESC LIMIT 15"))
def recent_history(spark, sf_dir):
    """The last 15 of the 20 points a bounded history keeps."""
    return report.recent_history(bounded_history(_hourly(spark, sf_dir), "window_start", 20), "window_start")


@registry.add(sql.query("SELECT event_id, segment_id, speed_kmh FROM traffic ORDER BY ts DESC, event_id DESC LIMIT 300"))
def latest_by_counts(spark, sf_dir):
    """The most recent 300 traffic rows, the 300th found by counting stretches of time until one holds 10 rows."""
    rows = feeds.traffic(feeds.events(spark, sf_dir))
    return latest_rows(rows, F.unix_micros("event_time"), [F.col("event_id").desc()], 300, at_once=10) \
        .select("event_id", "segment_id", "speed_kmh")


@registry.add(sql.query("SELECT event_id, segment_id, speed_kmh FROM traffic ORDER BY ts DESC, event_id DESC LIMIT 50000"))
def recent_rows(spark, sf_dir):
    """The most recent 50,000 traffic rows."""
    rows = feeds.traffic(feeds.events(spark, sf_dir))
    return report.most_recent(rows, [F.col("event_time"), F.col("event_id")], 50_000) \
        .select("event_id", "segment_id", "speed_kmh")


@registry.add(sql.query(
    f"SELECT zone_id, {sql.borough('zone_id')} AS borough, cluster, avg_aqi, avg_speed FROM labelled",
    sql.state(), _LABELLED,
))
def assignment_table(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return rows.select("zone_id", borough_name(F.col("zone_id")).alias("borough"), "cluster", "avg_aqi", "avg_speed") \
        .orderBy("cluster", "zone_id")


@registry.add(sql.query(
    f"SELECT zone_id, count(*) AS n, {sql.mean('speed_kmh / 7e0')} AS mean_seventh, {sql.stddev_pop('speed_kmh / 7e0')} AS std_seventh, "
    f"{sql.mean('-speed_kmh / 700000e0')} AS mean_small FROM traffic GROUP BY zone_id"
))
def long_decimal_means(spark, sf_dir):
    """Means and deviations of values whose decimals don't end."""
    seventh, small = F.col("speed_kmh") / F.lit(7.0), -F.col("speed_kmh") / F.lit(700000.0)
    return feeds.traffic(feeds.events(spark, sf_dir)).groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("n"), exact_mean(seventh).alias("mean_seventh"), exact_stddev_pop(seventh).alias("std_seventh"),
        exact_mean(small).alias("mean_small"))
