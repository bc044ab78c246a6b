"""Streaming jobs run over the whole events table as a file stream, with the equivalent batch result in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.geo import borough_name
from zonewise.plans import Registry, common, sql
from zonewise.plans.workers import _totals_sql
from zonewise.session import checkpointed, scratch_path
from zonewise.sinks.tables import Snapshots
from zonewise.sources import feeds
from zonewise.streaming import city, cycle, metrics, state, windows

registry = Registry()

ONCE = {"availableNow": True}
LONG_TTL = 30 * 86_400


def _run(town, streams: dict, queries: tuple[str, ...]) -> dict:
    """Run the city's queries on the streams side by side, each to its end."""
    started = city.start_city(town, streams, ONCE, queries)
    for query in started.values():
        query.awaitTermination()
    return started


def _new_city(spark, clustering=False):
    return city.City(spark, scratch_path(spark, "city"), clustering=clustering, score_ttl=LONG_TTL, label_ttl=LONG_TTL)


def _streams(spark, sf_dir) -> dict:
    events = feeds.event_stream(spark, sf_dir)
    return {
        "traffic": feeds.traffic(events).withColumn("borough", borough_name(F.col("zone_id"))), "pollution": feeds.pollution(events),
        "workers": feeds.workers(events), "weather": feeds.weather(events).withColumn("condition", F.lit(None).cast("string")),
    }


@registry.add(sql.query("SELECT zone_id, day, avg_speed, avg_aqi, zone_score, event_type FROM scored", sql.state("day")))
def stream_zone_scores(spark, sf_dir):
    """Zone scores per day window by a native streaming aggregate, whose whole result each batch writes anew."""
    scores = windows.windowed_zone_scores(feeds.readings(feeds.event_stream(spark, sf_dir)), "1 day")
    flat = scores.select("zone_id", F.date_format("window.start", "yyyy-MM-dd").alias("day"), "avg_speed", "avg_aqi",
                         "zone_score", "event_type")
    root = scratch_path(spark, "windows")
    table = Snapshots(spark, f"{root}/scores")
    query = flat.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE) \
        .foreachBatch(table.write).start()
    query.awaitTermination()
    return table.newest(flat.schema)


_STREAM_DEFAULTS = """
t_full AS (SELECT * REPLACE (CASE WHEN speed_kmh = 0 THEN 30e0 ELSE speed_kmh END AS speed_kmh) FROM traffic),
p_full AS (SELECT * REPLACE (CASE WHEN pm25 = 0 THEN 10e0 ELSE pm25 END AS pm25,
  CASE WHEN no2 = 0 THEN 20e0 ELSE no2 END AS no2, CASE WHEN aqi = 0 THEN 50e0 ELSE aqi END AS aqi) FROM pollution)"""
_STREAM_STATE = sql.state().replace("FROM traffic", "FROM t_full").replace("FROM pollution", "FROM p_full")


@registry.add(sql.query(
    "SELECT zone_id, avg_speed, avg_aqi, avg_pm25, zone_score, event_type, "
    f"{sql.borough('zone_id')} AS borough FROM scored",
    _STREAM_DEFAULTS, _STREAM_STATE,
))
def stream_city_scores(spark, sf_dir):
    """Zone scores that the zones query keeps in its state."""
    town = _new_city(spark)
    _run(town, _streams(spark, sf_dir), ("zones",))
    return town.zone_scores()


_STREAM_AIR = (
    "aired AS (SELECT w.event_id, w.worker_id, w.zone_id, coalesce(m.aqi, 75e0) AS aqi FROM worker w LEFT JOIN "
    f"(SELECT zone_id, {sql.mean('aqi')} AS aqi FROM p_full GROUP BY zone_id) m USING (zone_id))"
)


@registry.add(sql.query(
    "SELECT worker_id, zone_id, count, n_high, hours_in_high_aqi, daily_avg_aqi, exposure_status FROM totals",
    _STREAM_DEFAULTS, _STREAM_AIR, _totals_sql(),
))
def stream_exposure(spark, sf_dir):
    """Worker exposure against the zone means, in the state of the workers query."""
    town = _new_city(spark)
    _run(town, _streams(spark, sf_dir), ("workers",))
    return town.exposure().select(
        "worker_id", "zone_id", "count", "n_high", "hours_in_high_aqi", "daily_avg_aqi", "exposure_status"
    )


@registry.add(sql.query(
    "SELECT 'traffic' AS writer, count(*) AS n_rows FROM traffic UNION ALL SELECT 'pollution', count(*) FROM pollution"
))
def stream_row_totals(spark, sf_dir):
    """Rows by kind, counted in the zones' state."""
    town = _new_city(spark)
    _run(town, _streams(spark, sf_dir), ("zones",))
    return town.total_rows()


@registry.add(sql.query(
    "SELECT CASE WHEN temperature = 0 THEN 0e0 ELSE temperature END AS temperature, humidity, windspeed, 'Clear' AS condition "
    "FROM weather ORDER BY ts DESC, event_id DESC LIMIT 1"
))
def stream_weather(spark, sf_dir):
    """The current weather; the feed has no condition, so the default shows."""
    town = _new_city(spark)
    _run(town, _streams(spark, sf_dir), ("weather",))
    return town.weather().select("temperature", "humidity", "windspeed", "condition")


#: Five cycles of 40 minutes: three with each worker in its last zone, two in its first one.
_CYCLES = dims.ExposureProfile(high_aqi=40.0, minutes_per_reading=40.0)
_CYCLE = f"""
first_last AS (SELECT worker_id, arg_max(zone_id, event_id) AS zone_id, arg_min(zone_id, event_id) AS zone_0 FROM worker GROUP BY worker_id),
named AS (SELECT s.zone_id, s.zone_score * {sql.weight(common.OFFLINE_LABEL_SQL)} AS final_score,
    {common.OFFLINE_LABEL_SQL} AS cluster FROM scored s),
order_of AS (SELECT *, row_number() OVER (ORDER BY final_score DESC, {sql.zone_ord('zone_id')}) AS place FROM named),
picks AS (
  SELECT 'SAFE' AS status, * FROM order_of WHERE place = 1
  UNION ALL (SELECT 'WARNING', * FROM order_of WHERE cluster <> 'Permanently Hazardous' ORDER BY place LIMIT 1)
  UNION ALL (SELECT 'CRITICAL', * FROM order_of WHERE cluster = 'Safe Corridor' ORDER BY place LIMIT 1)),
spent AS (
  SELECT worker_id, w.zone_0 AS zone_id, 40 * (3 * CAST(coalesce(l.avg_aqi, 50e0) > 40 AS INT) + 2 * CAST(coalesce(f.avg_aqi, 50e0) > 40 AS INT)) AS minutes,
    3 * {sql.units('coalesce(l.avg_aqi, 50e0)', 4)} + 2 * {sql.units('coalesce(f.avg_aqi, 50e0)', 4)} AS units
  FROM first_last w LEFT JOIN scored l ON l.zone_id = w.zone_id LEFT JOIN scored f ON f.zone_id = w.zone_0)"""


@registry.add(sql.query(
    "SELECT worker_id, s.zone_id, p.zone_id AS rec_zone, p.cluster AS rec_label, p.final_score AS rec_score, "
    "CAST(minutes AS DOUBLE) / 60e0 AS hours_in_high_aqi, CAST(units AS DOUBLE) / (5e0 * 1e4) AS daily_avg_aqi, p.status "
    f"FROM spent s JOIN picks p ON p.status = {sql.status('CAST(minutes AS DOUBLE) / 60e0')}",
    _STREAM_DEFAULTS, _STREAM_STATE, _CYCLE,
))
def stream_recommendations(spark, sf_dir):
    """Five recommendation cycles on the state the queries have left; from the fourth on they forecast, and workers
    come to all three statuses."""
    town = _new_city(spark)
    _run(town, _streams(spark, sf_dir), ("zones", "workers"))
    scores = checkpointed(town.zone_scores(), "scores")
    offline = scores.select("zone_id", common.offline_label().alias("cluster"))
    seen = feeds.workers(feeds.events(spark, sf_dir)).groupBy("worker_id").agg(
        F.min_by("zone_id", "event_id").alias("first"), F.max_by("zone_id", "event_id").alias("last"))
    job = cycle.RecommendationCycle(spark, f"{town.root}/cycle", town, offline, _CYCLES)
    for n in range(5):
        job.run(n, scores=scores, workers=seen.select("worker_id", F.col("last" if n < 3 else "first").alias("zone_id")))
    return job.recommendations().select(
        "worker_id", "zone_id", "rec_zone", "rec_label", "rec_score", "hours_in_high_aqi", "daily_avg_aqi", "status"
    )


@registry.add()
def stream_labels(spark, sf_dir):
    """Zone labels from the online model that the zones query advances."""
    town = _new_city(spark, clustering=True)
    _run(town, _streams(spark, sf_dir), ("zones",))
    return town.labels()


def _reported(spark, sf_dir, **options):
    """The reports of the zones query, and of a windowed one that drops late rows, over many micro-batches."""
    town = _new_city(spark)
    reports = metrics.Reports(spark, f"{town.root}/metrics").start()
    try:
        started = city.start_city(town, _streams(spark, sf_dir), ONCE, ("zones", "workers"))
        for name, query in started.items():
            reports.called(query, name)
        for query in started.values():
            reports.wait(query)
    finally:
        reports.stop()
    return reports.read()


@registry.add()
def stream_metrics(spark, sf_dir):
    """Measured rows per second and duration of every micro-batch of two queries that run side by side."""
    return _reported(spark, sf_dir).select("name", "batch", "input_rows", "rows_per_sec", "duration_ms", "lag_class")


@registry.add(sql.query(
    "SELECT name, CAST(2 * count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS late_rows "
    "FROM ev, (VALUES ('zones'), ('workers')) q(name) GROUP BY name"
))
def stream_input_rows(spark, sf_dir):
    """Rows that two queries read, from two streams each, and rows that came too late, added up over all reports."""
    return _reported(spark, sf_dir).groupBy("name").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


#: The file that each event is in: four, the last of which goes back to the days of the first.
_LATE_FILE = "CASE WHEN event_id % 17 = 0 THEN 3 ELSE least(2, (event_id * 3) // (max(event_id) OVER () + 1)) END"


@registry.add(sql.query(
    "SELECT strftime(day_start, '%Y-%m-%d') AS day, count(*) AS n_rows, CAST(sum(k) AS BIGINT) AS total "
    "FROM (SELECT date_trunc('day', ts) AS day_start, CAST(json_extract(props, '$.k') AS BIGINT) AS k, file, "
    "max(CASE WHEN file < 2 THEN ts END) OVER () AS seen_before_2, max(CASE WHEN file < 3 THEN ts END) OVER () AS seen_before_3 "
    f"FROM (SELECT *, {_LATE_FILE} AS file FROM ev)) "
    "WHERE file < 3 OR day_start + INTERVAL 1 DAY > seen_before_2 - INTERVAL 2 DAY GROUP BY day_start"
))
def stream_late_rows(spark, sf_dir):
    """Rows per day of a stream in four micro-batches, the last of which holds rows from all days: those whose window
    has ended before the watermark are dropped."""
    events = feeds.events(spark, sf_dir).withColumn("k", feeds.props_k())
    most = events.agg(F.max("event_id")).first()[0] or 0
    part = F.when(F.col("event_id") % 17 == 0, 3).otherwise(F.least(F.lit(2), F.floor(F.col("event_id") * 3 / (most + 1)).cast("int")))
    root = scratch_path(spark, "late")
    for n in range(4):
        events.filter(part == n).select("event_time", "k").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("event_time timestamp, k int").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    days = stream.withWatermark("event_time", "2 days").groupBy(F.window("event_time", "1 day")).agg(
        F.count("*").alias("n_rows"), F.sum("k").alias("total")).select(F.col("window.start").alias("start"), "n_rows", "total")
    query = days.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE) \
        .foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{root}/days/batch={n}")).start()
    query.awaitTermination()
    newest = spark.read.parquet(f"{root}/days").groupBy("start").agg(F.max_by(F.struct("n_rows", "total"), "batch").alias("r"))
    return newest.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "r.*")


@registry.add(sql.query(
    "SELECT station_id, event_id, pm25 FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS place, "
    "max(ts) OVER () AS seen FROM pollution) WHERE place = 1 AND epoch_ms(ts) + 172800000 > epoch_ms(seen)"
))
def stream_expiring_rows(spark, sf_dir):
    """The newest row of each station that has sent within the last two days, in the state store: those of older
    stations have left it."""
    root = scratch_path(spark, "expiring")
    rows = feeds.pollution(feeds.event_stream(spark, sf_dir)).select("station_id", "event_id", "pm25", "event_time")
    query = state.newest_rows(rows, ["station_id"], "event_time", F.col("event_id"), 2 * 86_400) \
        .writeStream.outputMode("update").format("noop").option("checkpointLocation", root).trigger(**ONCE).start()
    query.awaitTermination()
    return state.stored(spark, root, "newest").select("station_id", "event_id", "pm25")
