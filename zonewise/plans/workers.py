"""Worker exposure, recommendation, overlays."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions import air, labels
from zonewise.functions.numeric import percent_of
from zonewise.operators import exposure, recommend, report
from zonewise.plans import Registry, common, sql
from zonewise.session import checkpointed
from zonewise.sources import feeds

registry = Registry()


def _ordered(rows):
    return rows.withColumn("seq", feeds.order())


def workers_with_air(spark, sf_dir):
    """Worker positions with the AQI last known for their zone."""
    events = feeds.events(spark, sf_dir)
    workers, pollution = _ordered(feeds.workers(events)), _ordered(feeds.pollution(events))
    return exposure.with_known_air(workers, pollution.select("zone_id", "seq", "event_time", "aqi"), "seq")


AS_OF_SQL = """
sides AS (SELECT event_id, worker_id, zone_id, ts, day, NULL::DOUBLE AS known, 1 AS side FROM worker
  UNION ALL SELECT event_id, NULL, zone_id, ts, day, aqi, 0 FROM pollution),
aired AS (SELECT event_id, worker_id, zone_id, ts, day, aqi FROM (
  SELECT *, coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY zone_id ORDER BY ts, event_id, side
    ROWS UNBOUNDED PRECEDING), 75e0) AS aqi FROM sides) WHERE side = 1)"""


@registry.add(sql.query("SELECT event_id, worker_id, zone_id, aqi FROM aired", AS_OF_SQL))
def worker_asof_aqi(spark, sf_dir):
    return workers_with_air(spark, sf_dir).select("event_id", "worker_id", "zone_id", "aqi")


_RUNNING_WINDOW = "WINDOW w AS (PARTITION BY worker_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


@registry.add(sql.query(
    "SELECT event_id, worker_id, n AS count, n_high, CAST(n_high AS DOUBLE) / 60e0 AS hours_in_high_aqi, "
    "CAST(units AS DOUBLE) / (CAST(n AS DOUBLE) * 1e4) AS daily_avg_aqi, "
    f"{sql.status('CAST(n_high AS DOUBLE) / 60e0')} AS exposure_status FROM (SELECT event_id, worker_id, "
    "count(*) OVER w AS n, CAST(sum(CASE WHEN aqi > 100 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_high, "
    f"CAST(sum({sql.units('aqi', 4)}) OVER w AS BIGINT) AS units FROM aired {_RUNNING_WINDOW})",
    AS_OF_SQL,
))
def worker_exposure_running(spark, sf_dir):
    rows = exposure.running_exposure(workers_with_air(spark, sf_dir), F.col("seq"))
    return rows.select(
        "event_id", "worker_id", "count", "n_high", "hours_in_high_aqi", "daily_avg_aqi", "exposure_status"
    )


def _totals_sql(high: float = 100.0, minutes: float = 1.0) -> str:
    hours = f"(CAST(n_high AS DOUBLE) * {sql.num(minutes)} / 60e0)"
    return f"""
sums AS (SELECT worker_id, count(*) AS count, CAST(sum(CASE WHEN aqi > {sql.num(high)} THEN 1 ELSE 0 END) AS BIGINT) AS n_high,
    CAST(sum({sql.units('aqi', 4)}) AS BIGINT) AS units, arg_max(zone_id, event_id) AS zone_id FROM aired GROUP BY worker_id),
totals AS (SELECT worker_id, zone_id, count, n_high, CAST(n_high AS DOUBLE) * {sql.num(minutes)} AS high_aqi_minutes,
    CAST(count AS DOUBLE) * {sql.num(minutes)} AS total_minutes, {hours} AS hours_in_high_aqi,
    CAST(units AS DOUBLE) / 1e4 AS aqi_sum, CAST(units AS DOUBLE) / (CAST(count AS DOUBLE) * 1e4) AS daily_avg_aqi,
    {sql.status(hours)} AS exposure_status, least(100e0, {hours} / 8e0 * 100e0) AS who_pct FROM sums)"""


# a limit of 40 and 5 minutes per reading spread the workers over all three statuses
_PROFILE = dims.ExposureProfile(high_aqi=40.0, minutes_per_reading=5.0)
TOTALS_SQL = _totals_sql(40.0, 5.0)


def worker_totals(spark, sf_dir):
    return exposure.exposure_totals(workers_with_air(spark, sf_dir), F.col("seq"), _PROFILE)


@registry.add(sql.query(
    "SELECT *, least(100e0, hours_in_high_aqi / 3e0 * 100e0) AS pct_of_3h, "
    "least(100e0, hours_in_high_aqi / 4.5e0 * 100e0) AS bar_pct FROM totals",
    AS_OF_SQL, TOTALS_SQL,
))
def worker_exposure_status(spark, sf_dir):
    hours = F.col("hours_in_high_aqi")
    return worker_totals(spark, sf_dir).withColumns({
        "pct_of_3h": percent_of(hours, 3.0), "bar_pct": percent_of(hours, 4.5),
    })


_DAILY_KEYS = "worker_id, day"


@registry.add(sql.query(
    f"SELECT worker_id, day, count(*) AS count, CAST(sum(CASE WHEN aqi > 100 THEN 1 ELSE 0 END) AS BIGINT) AS n_high, "
    f"CAST(sum({sql.units('aqi', 4)}) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * 1e4) AS daily_avg_aqi "
    f"FROM aired GROUP BY {_DAILY_KEYS}",
    AS_OF_SQL,
))
def worker_exposure_daily(spark, sf_dir):
    """The same totals with a fresh start every day."""
    rows = workers_with_air(spark, sf_dir).withColumn("day", feeds.day())
    totals = exposure.exposure_totals(rows, F.col("seq"), keys=["worker_id", "day"])
    return feeds.day_text(totals).select("worker_id", "day", "count", "n_high", "daily_avg_aqi")


_CYCLE_AQI = f"greatest({sql.index('pm25', dims.PM25_BREAKPOINTS)}, {sql.index('no2', dims.NO2_BREAKPOINTS)})"


@registry.add(sql.query(
    "SELECT event_id, worker_id, n AS n_cycles, CAST(n_high AS DOUBLE) * 2.5e0 AS high_aqi_minutes, "
    "CAST(n AS DOUBLE) * 2.5e0 AS total_minutes, CAST(units AS DOUBLE) / 1e4 AS aqi_sum, "
    f"{sql.status('CAST(n_high AS DOUBLE) * 2.5e0 / 60e0')} AS exposure_status, "
    "least(100e0, CAST(n_high AS DOUBLE) * 2.5e0 / 60e0 / 8e0 * 100e0) AS who_pct "
    "FROM (SELECT event_id, worker_id, count(*) OVER w AS n, "
    "CAST(sum(CASE WHEN aqi > 40 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_high, "
    f"CAST(sum({sql.units('aqi', 4)}) OVER w AS BIGINT) AS units FROM (SELECT event_id, station_id AS worker_id, ts, "
    f"{_CYCLE_AQI} AS aqi FROM pollution) {_RUNNING_WINDOW})"
))
def exposure_cycles(spark, sf_dir):
    """2.5 minutes per cycle above the limit of 40, on the higher of current index and forecast.

    Each station stands for a worker, its PM2.5 index for the current AQI and its NO2 index for the forecast.
    """
    rows = feeds.pollution(feeds.events(spark, sf_dir)).select(
        "event_id", F.col("station_id").alias("worker_id"), "event_time",
        exposure.protective_aqi(
            air.aqi_from_breakpoints(F.col("pm25"), dims.PM25_BREAKPOINTS),
            air.aqi_from_breakpoints(F.col("no2"), dims.NO2_BREAKPOINTS),
        ).alias("aqi"),
    )
    running = exposure.running_exposure(
        rows, feeds.order(), dims.PER_CYCLE
    )
    return running.select(
        "event_id", "worker_id", F.col("count").alias("n_cycles"), "high_aqi_minutes", "total_minutes", "aqi_sum",
        "exposure_status", "who_pct",
    )


_SLOT = "CAST(floor(epoch(date_trunc('second', ts)) / 300) AS BIGINT)"
_FALLBACK = sql.zone(
    f"CAST('0x' || substr(md5(worker_id || '|' || CAST({_SLOT} AS VARCHAR)), 1, 8) AS BIGINT)"
)


@registry.add(sql.query(
    f"SELECT event_id, worker_id, CASE WHEN k > 60 THEN {_FALLBACK} ELSE zone_id END AS zone_id FROM worker"
))
def valid_zones(spark, sf_dir):
    """Unknown zones replaced by one that is fixed by worker and 5-minute slot."""
    events = feeds.events(spark, sf_dir)
    rows = feeds.workers(events.withColumn("k", feeds.props_k()), keep=["k"])
    reported = F.when(F.col("k") > 60, F.concat(F.lit("XX-"), F.col("k").cast("string"))).otherwise(F.col("zone_id"))
    return rows.select(
        "event_id", "worker_id",
        exposure.valid_zone(reported, F.col("worker_id"), F.col("event_time")).alias("zone_id"),
    )


@registry.add(sql.query(
    "SELECT s.exposure_status, coalesce(n, 0) AS n FROM (VALUES ('SAFE'), ('WARNING'), ('CRITICAL')) s(exposure_status) "
    "LEFT JOIN (SELECT exposure_status, count(*) AS n FROM totals GROUP BY 1) USING (exposure_status)",
    AS_OF_SQL, TOTALS_SQL,
))
def status_counts(spark, sf_dir):
    return report.status_counts(worker_totals(spark, sf_dir))


@registry.add(sql.query(
    f"SELECT {sql.mean('hours_in_high_aqi')} AS avg_hours, count(*) AS n_workers FROM totals", AS_OF_SQL, TOTALS_SQL,
))
def mean_exposure(spark, sf_dir):
    return report.mean_exposure(worker_totals(spark, sf_dir))


@registry.add(sql.query("SELECT zone_id, count(*) AS workers FROM worker GROUP BY zone_id"))
def workers_per_zone(spark, sf_dir):
    return report.workers_per_zone(feeds.workers(feeds.events(spark, sf_dir)))


@registry.add(sql.query(
    f"SELECT zone_id, count(*) AS workers FROM worker GROUP BY zone_id ORDER BY 2 DESC, {sql.zone_ord('zone_id')} LIMIT 3"
))
def busiest_zones(spark, sf_dir):
    return report.busiest_zones(report.workers_per_zone(feeds.workers(feeds.events(spark, sf_dir))))


_RISK = "CASE exposure_status WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 ELSE 2 END"


@registry.add(sql.query(
    f"SELECT worker_id, exposure_status, hours_in_high_aqi FROM totals ORDER BY {_RISK}, hours_in_high_aqi DESC, "
    "worker_id LIMIT 20",
    AS_OF_SQL, TOTALS_SQL,
))
def worker_risk_order(spark, sf_dir):
    return report.by_risk(worker_totals(spark, sf_dir), 20).select("worker_id", "exposure_status", "hours_in_high_aqi")


# --- ranking and recommendation -----------------------------------------------------------------------

FINAL_SQL = f"""
final AS (SELECT *, zone_score * {sql.weight('cluster')} AS final_score FROM (
  SELECT *, {common.LIVE_LABEL_SQL} AS cluster FROM scored))"""


def final_daily(spark, sf_dir, by):
    scores = common.stored_zones(spark, sf_dir, by)
    named = scores.select("zone_id", *(by or []), common.live_label().alias("cluster"))
    return recommend.final_scores(scores, named, by)


@registry.add(sql.query(
    "SELECT day, zone_id, cluster, final_score, row_number() OVER (PARTITION BY day ORDER BY final_score DESC, "
    f"{sql.zone_ord('zone_id')}) AS position, CASE WHEN final_score > 0.5e0 THEN 'high' WHEN final_score > 0.25e0 "
    "THEN 'medium' ELSE 'low' END AS grade FROM final",
    sql.state("day"), FINAL_SQL,
))
def final_score_rank(spark, sf_dir):
    ranked = recommend.ranked(final_daily(spark, sf_dir, ["day"]), ["day"])
    return ranked.select("day", "zone_id", "cluster", "final_score", "position",
                         labels.rank_bucket(F.col("final_score")).alias("grade"))


@registry.add(sql.query(
    f"SELECT zone_id, final_score FROM final ORDER BY final_score DESC, {sql.zone_ord('zone_id')} LIMIT 15",
    sql.state(), FINAL_SQL,
))
def top_zones(spark, sf_dir):
    return report.top_zones(final_daily(spark, sf_dir, None)).select("zone_id", "final_score")


_BEST = f"ORDER BY final_score DESC, {sql.zone_ord('zone_id')} LIMIT 1"
_CANDIDATES = {
    "CRITICAL": "cluster = 'Safe Corridor'", "WARNING": "cluster <> 'Permanently Hazardous'", "SAFE": "true",
}
_POLICY = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{s}' AS status, zone_id AS rec_zone, cluster AS rec_label, final_score AS rec_score "
    f"FROM final WHERE {rule} OR NOT EXISTS (SELECT 1 FROM final WHERE {rule}) {_BEST})"
    for s, rule in _CANDIDATES.items()
)
_REASON = (
    "CASE exposure_status WHEN 'CRITICAL' THEN 'Near limit (' || printf('%.1f', hours_in_high_aqi) || "
    "'h) → Safe Corridor' WHEN 'WARNING' THEN 'Approaching limit (' || printf('%.1f', hours_in_high_aqi) || "
    "'h) → avoiding hazardous' ELSE 'Best available zone (score ' || printf('%.2f', rec_score) || ')' END"
)
RECOMMEND_SQL = f"""
policy AS ({_POLICY}),
rec AS (SELECT t.worker_id, t.zone_id, t.zone_id AS current_zone, p.rec_zone, p.rec_label, p.rec_score, p.status,
    t.exposure_status, {_REASON} AS reason, t.hours_in_high_aqi, t.daily_avg_aqi, t.who_pct
  FROM totals t JOIN policy p ON p.status = t.exposure_status)"""


@registry.add(sql.query(
    "SELECT *, substr(reason, 1, 55) AS short_reason FROM rec",
    sql.state(), FINAL_SQL, AS_OF_SQL, TOTALS_SQL, RECOMMEND_SQL,
))
def recommend_policy(spark, sf_dir):
    policies = recommend.policy(final_daily(spark, sf_dir, None))
    return recommend.recommendations(worker_totals(spark, sf_dir), policies) \
        .withColumn("short_reason", labels.shorten(F.col("reason")))


@registry.add(sql.query(
    "SELECT coalesce(r.worker_id, e.worker_id) AS worker_id, coalesce(r.zone_id, e.zone_id) AS zone_id, "
    "coalesce(r.exposure_status, e.exposure_status) AS exposure_status, e.count AS count, r.rec_zone "
    "FROM totals e FULL OUTER JOIN rec r ON e.worker_id = r.worker_id",
    sql.state(), FINAL_SQL, AS_OF_SQL, TOTALS_SQL, RECOMMEND_SQL,
))
def exposure_overlay(spark, sf_dir):
    """Exposure with recommendations on top."""
    totals = checkpointed(worker_totals(spark, sf_dir))
    own = totals.select("worker_id", "zone_id", "exposure_status", "count")
    policies = recommend.policy(final_daily(spark, sf_dir, None))
    rec = recommend.recommendations(totals, policies).select("worker_id", "zone_id", "exposure_status", "rec_zone")
    return recommend.overlaid(own, rec)


_LABELS = f"""
live AS (SELECT zone_id, {common.LIVE_LABEL_SQL} AS cluster FROM fused),
offline AS (SELECT zone_id, {common.OFFLINE_LABEL_SQL} AS cluster FROM fused)"""


def _label_tables(spark, sf_dir):
    state = common.stored_zones(spark, sf_dir)
    live = state.select("zone_id", common.live_label().alias("cluster"))
    offline = state.select("zone_id", common.offline_label().alias("cluster"))
    return live, offline


@registry.add(sql.query(
    "SELECT z.zone_id, coalesce(l.cluster, o.cluster, 'Safe Corridor') AS cluster FROM zones z "
    "LEFT JOIN live l USING (zone_id) LEFT JOIN offline o USING (zone_id)",
    sql.state(), sql.ZONES, _LABELS,
))
def label_precedence(spark, sf_dir):
    live, offline = _label_tables(spark, sf_dir)
    zones = dims.zones_frame(spark)
    fallback = zones.select("zone_id", F.lit("Safe Corridor").alias("cluster"))
    return recommend.label_precedence(zones, live, offline, fallback)


@registry.add(sql.query(
    "SELECT z.zone_id, CASE WHEN (SELECT count(DISTINCT cluster) FROM live) >= 4 THEN l.cluster "
    "ELSE coalesce(o.cluster, l.cluster, 'Safe Corridor') END AS cluster FROM zones z "
    "LEFT JOIN live l USING (zone_id) LEFT JOIN offline o USING (zone_id)",
    sql.state(), sql.ZONES, _LABELS,
))
def gated_labels(spark, sf_dir):
    live, offline = _label_tables(spark, sf_dir)
    return recommend.gated_labels(dims.zones_frame(spark), live, offline)
