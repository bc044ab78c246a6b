"""Round trips through the file formats: Spark writes the feed as the format, and the reader reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewise import dims, schemas
from zonewise.functions.numeric import exact_mean
from zonewise.operators.ordered import row_positions
from zonewise.plans import Registry, common, sql
from zonewise.plans.zones import NEAREST_SQL
from zonewise.session import scratch_path
from zonewise.sinks import files as sink
from zonewise.sinks.tables import write_snapshot
from zonewise.streaming.state import newest_rows, stored
from zonewise.sources import feeds, files

registry = Registry()


def _round(expr: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {expr}) AS DOUBLE)"


def _traffic_csv(spark, sf_dir) -> str:
    """Traffic as CSV with untidy headers; every ninth k has no speed, every eleventh an unreadable one."""
    rows = feeds.events(spark, sf_dir).filter(F.col("event_type").isin(feeds.TRAFFIC_TYPES)).withColumn("k", feeds.props_k())
    speed = F.when(F.col("k") % 9 == 0, "").when(F.col("k") % 11 == 0, "n/a").otherwise(F.col("value").cast("string"))
    names = F.array(*[F.lit(n) for n in dims.BOROUGH_NAMES.values()])
    path = scratch_path(spark, "traffic-csv")
    rows.select(
        speed.alias(" Speed "), F.col("event_id").cast("string").alias("link_id"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("Data_As_Of"),
        F.get(names, F.pmod("k", F.lit(5))).alias("borough"),
        F.concat(common.segment_latitude().cast("string"), F.lit(", -73.9 40.7, -73.8")).alias("link_points"),
        F.lit("").alias("unused"),
    ).write.option("header", True).csv(path)
    return path


_CSV_BOROUGH = "substr('MNBKQNBXSI', CAST(2 * (k % 5) + 1 AS INTEGER), 2)"
_CSV_SPEED = "CASE WHEN k % 9 = 0 THEN 30e0 ELSE speed_kmh END"


@registry.add(sql.query(
    f"SELECT segment_id, {_round('speed * 1.60934e0', 2)} AS speed_kmh, {_round('speed', 2)} AS speed_mph, "
    f"{sql.case('b', dims.BOROUGH_NAMES, 'NULL')} AS borough, b || '-0' || CAST(position % 6 + 1 AS VARCHAR) AS zone_id "
    f"FROM (SELECT CAST(event_id AS VARCHAR) AS segment_id, {_CSV_SPEED} AS speed, {_CSV_BOROUGH} AS b, k, "
    "row_number() OVER (ORDER BY event_id) - 1 AS position FROM traffic) WHERE k % 9 = 0 OR k % 11 <> 0"
))
def traffic_csv_messages(spark, sf_dir):
    raw = files.read_traffic(spark, _traffic_csv(spark, sf_dir)).withColumn("id", F.col("LINK_ID").cast("bigint"))
    placed = row_positions(raw, F.col("id"))
    return files.traffic_messages(placed, F.col("position")) \
        .select("segment_id", "speed_kmh", "speed_mph", "borough", "zone_id")


@registry.add(sql.query(
    f"SELECT {_CSV_BOROUGH} AS borough_id, count(*) AS n, {sql.mean('speed_kmh')} AS avg_speed, "
    f"min({common.SEGMENT_LAT_SQL}) AS lat_min, max({common.SEGMENT_LAT_SQL}) AS lat_max "
    "FROM traffic WHERE k % 9 <> 0 AND k % 11 <> 0 AND speed_kmh > 0 GROUP BY 1"
))
def traffic_csv_segments(spark, sf_dir):
    segments = files.traffic_segments(files.read_traffic(spark, _traffic_csv(spark, sf_dir)))
    return segments.groupBy("borough_id").agg(
        F.count(F.lit(1)).alias("n"), exact_mean(F.col("speed")).alias("avg_speed"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
    )


@registry.add(sql.query(
    "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS \"DATA_AS_OF\", speed_kmh AS \"SPEED\", segment_id AS \"LINK_ID\" "
    "FROM traffic ORDER BY ts DESC, event_id DESC LIMIT 50000"
))
def latest_extract(spark, sf_dir):
    """The most recent 50,000 rows under the CSV's column names."""
    rows = feeds.traffic(feeds.events(spark, sf_dir)).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("data_as_of"),
        F.col("speed_kmh").alias("speed"), F.col("segment_id").alias("link_id"),
        *[F.lit("").alias(c) for c in ("borough", "link_points", "travel_time", "status")],
    )
    return files.latest_traffic_extract(rows).select("DATA_AS_OF", "SPEED", "LINK_ID")


def _pollution_csv(spark, sf_dir) -> str:
    parameter = F.when(F.col("event_type") == "error", "PM25").when(F.col("event_type") == "purchase", " no2 ") \
        .otherwise("o3")
    path = scratch_path(spark, "pollution-csv")
    rows = common.placed(feeds.events(spark, sf_dir)).select(
        F.concat(F.lit("ST-"), F.col("user_id").cast("string")).alias("location"), parameter.alias("parameter"),
        F.col("value"), F.col("event_id").cast("string").alias("unit"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date_utc"),
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.lit("left out").alias("extra"),
    )
    sink.write_csv(rows, path, schemas.POLLUTION_CSV.fieldNames())
    return path


@registry.add(sql.query(
    f"SELECT f.event_id, f.station_id, n.zone_id, {_round('f.pm25', 2)} AS pm25, {_round('f.no2', 2)} AS no2, "
    f"{_round(sql.combined_index('f.pm25', 'f.no2'), 1)} AS aqi FROM (SELECT event_id, station_id, "
    "coalesce(last_value(CASE WHEN event_type = 'error' THEN pm25 END IGNORE NULLS) OVER w, 0e0) AS pm25, "
    "coalesce(last_value(CASE WHEN event_type = 'purchase' THEN pm25 END IGNORE NULLS) OVER w, 0e0) AS no2 "
    "FROM pollution WINDOW w AS (PARTITION BY station_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) f "
    "JOIN nearest n USING (event_id)",
    NEAREST_SQL,
))
def pollution_csv_messages(spark, sf_dir):
    """Messages from the CSV: filled stations, nearest zones, combined index; other parameters drop out."""
    rows = files.read_pollution(spark, _pollution_csv(spark, sf_dir)).withColumn("id", F.col("unit").cast("bigint"))
    messages = files.pollution_messages(rows, F.col("id"), keep=["id"])
    return messages.select(F.col("id").alias("event_id"), "station_id", "zone_id", "pm25", "no2", "aqi")


@registry.add(sql.query(
    "SELECT count(*) AS n, count(DISTINCT station_id) AS n_stations FROM (SELECT 'ST-' || user_id AS station_id "
    "FROM ev WHERE event_type = 'error' AND value > 0)"
))
def pollution_csv_pm25(spark, sf_dir):
    """Positive PM2.5 rows and their stations; the parameter must be spelled exactly."""
    rows = files.read_pollution(spark, _pollution_csv(spark, sf_dir)).withColumn("parameter", F.lower("parameter"))
    return files.pm25_readings(rows).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("location").alias("n_stations")
    )


_CONDITION = (
    "CASE WHEN temperature > 30 THEN 'Hot' WHEN temperature < 5 THEN 'Cold' WHEN windspeed > 30 THEN 'Windy' "
    "WHEN humidity > 80 THEN 'Humid' ELSE 'Clear' END"
)


@registry.add(sql.query(
    f"SELECT source_ts, {_round('temperature', 1)} AS temperature, {_round('humidity', 1)} AS humidity, "
    f"{_round('windspeed', 1)} AS windspeed, {_CONDITION} AS condition FROM (SELECT "
    "CAST(event_id AS VARCHAR) AS source_ts, temperature, CASE WHEN humidity < 90 THEN humidity END AS humidity, windspeed "
    "FROM weather WHERE humidity <> 13)"
))
def weather_csv_messages(spark, sf_dir):
    """One file per day, with metadata lines above the header and columns in an order of its own."""
    rows = feeds.day_text(feeds.weather(feeds.events(spark, sf_dir)).withColumn("day", feeds.day()))
    temperature = F.when(F.col("humidity") == 13, "").otherwise(F.col("temperature").cast("string"))
    humidity = F.when(F.col("humidity") < 90, F.col("humidity").cast("string")).otherwise("")
    data = rows.select(
        "day", F.lit(3).alias("rank"), "event_id",
        F.concat_ws(",", F.col("windspeed").cast("string"), F.col("event_id").cast("string"), temperature, humidity)
        .alias("line"),
    )
    above = rows.select("day").distinct().select(
        "day", F.posexplode(F.array(
            F.lit("place,elevation"), F.lit("city,10"),
            F.lit("windspeed_10m (km/h),time,temperature_2m (°C),relativehumidity_2m (%)"),
        )).alias("rank", "line"),
    ).withColumn("event_id", F.lit(0).cast("bigint")).select("day", "rank", "event_id", "line")
    path = scratch_path(spark, "weather-csv")
    above.union(data).repartition("day").sortWithinPartitions("day", "rank", "event_id") \
        .select("day", "line").write.partitionBy("day").text(path)
    return files.weather_messages(files.read_weather(spark, path)) \
        .select("source_ts", "temperature", "humidity", "windspeed", "condition")


@registry.add(sql.query(
    "SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS time, temperature AS temperature_2m, humidity AS relativehumidity_2m, "
    "windspeed AS windspeed_10m FROM weather"
))
def hourly_weather(spark, sf_dir):
    """Documents with parallel arrays, one per event here, opened into rows."""
    path = scratch_path(spark, "hourly-json")
    feeds.weather(feeds.events(spark, sf_dir)).select(F.struct(
        F.array(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.array("temperature").alias("temperature_2m"), F.array("humidity").alias("relativehumidity_2m"),
        F.array("windspeed").alias("windspeed_10m"),
    ).alias("hourly")).write.json(path)
    return files.read_hourly_weather(spark, path, multi_line=False)


_DOC_PM25 = "CASE WHEN event_type = 'signup' OR value = 0 THEN 8e0 ELSE value END"
_DOC_NO2 = "CASE WHEN k = 0 THEN 15e0 ELSE CAST(k AS DOUBLE) END"


@registry.add(sql.query(
    f"SELECT 'OAQ-' || CAST(event_id AS VARCHAR) AS station_id, n.zone_id, {_round('pm25', 2)} AS pm25, "
    f"{_round('no2', 2)} AS no2, {_round(sql.index('pm25', dims.PM25_BREAKPOINTS, 'least(500e0, pm25 * 2.1e0)'), 1)} AS aqi "
    f"FROM (SELECT event_id, {_DOC_PM25} AS pm25, {_DOC_NO2} AS no2 FROM ev WHERE event_type <> 'view') "
    "JOIN nearest n USING (event_id)",
    NEAREST_SQL,
))
def station_documents(spark, sf_dir):
    """Nested sensor documents: the last value per parameter, defaults, and stations without a place left out."""
    k = feeds.props_k().cast("double")

    def sensor(name, value):
        return F.struct(F.struct(F.lit(name).alias("name")).alias("parameter"),
                        F.struct(value.cast("double").alias("value")).alias("latest"))

    value = F.when(F.col("event_type") != "signup", F.col("value"))
    location = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.when(F.col("event_type") == "view", 0.0).otherwise(F.col("lat")).alias("latitude"),
                 F.col("lon").alias("longitude"))
        .alias("coordinates"),
        F.array(sensor("no2", F.lit(1.0)), sensor("PM25", value), sensor("no2", k), sensor("pm25", F.lit(None)))
        .alias("sensors"),
    )
    path = scratch_path(spark, "stations-json")
    common.placed(feeds.events(spark, sf_dir)).select(F.array(location).alias("results")).write.json(path)
    documents = files.read_sensor_locations(spark, path, multi_line=False)
    return files.station_messages(documents).select("station_id", "zone_id", "pm25", "no2", "aqi")


@registry.add(sql.query(
    "SELECT station_id AS location, CASE event_type WHEN 'error' THEN 'pm25' ELSE 'no2' END AS parameter, pm25 AS value, "
    "'µg/m³' AS unit, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS date_utc, "
    "CASE WHEN event_id % 2 = 0 THEN 40.7128e0 ELSE 40.5e0 END AS latitude, -74.006e0 AS longitude FROM pollution"
))
def measurement_pages(spark, sf_dir):
    """Pages of both parameters; the time stands in either of two places, coordinates may be missing."""
    rows = feeds.events(spark, sf_dir)
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    odd = F.col("event_id") % 2 == 1
    paths = {}
    for parameter, kind in (("pm25", "error"), ("no2", "purchase")):
        paths[parameter] = scratch_path(spark, f"pages-{parameter}")
        result = F.struct(
            F.struct(
                F.concat(F.lit("ST-"), F.col("user_id").cast("string")).alias("name"),
                F.when(odd, F.struct(F.lit(40.5).alias("latitude"))).alias("coordinates"),
            ).alias("location"),
            "value",
            F.when(odd, F.struct(F.struct(time.alias("utc")).alias("datetimeFrom"))).alias("period"),
            F.struct(time.alias("utc")).alias("date"),
        )
        rows.filter(F.col("event_type") == kind).select(F.array(result).alias("results")).write.json(paths[parameter])
    return files.read_pollution_pages(spark, paths, multi_line=False)


@registry.add(sql.query(
    "SELECT 'ST-' || CAST(event_id AS VARCHAR) AS location, CASE event_type WHEN 'error' THEN 'pm25' ELSE 'no2' END "
    "AS parameter, CASE WHEN k = 0 THEN 10e0 ELSE value END AS value, 'µg/m³' AS unit, '2023-06-15T' || "
    "lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00Z' AS date_utc FROM ev, range(24) r(h) "
    "WHERE event_type IN ('error', 'purchase') AND k % 2 = 0"
))
def monitor_summary(spark, sf_dir):
    """Annual means of the wanted state and parameters, each spread over 24 hours; a blank mean becomes 10."""
    k = feeds.props_k()
    name = F.when(F.col("event_type") == "error", "PM2.5 - Local Conditions") \
        .when(F.col("event_type") == "purchase", "Nitrogen dioxide (NO2)").otherwise("Ozone")
    path = scratch_path(spark, "monitor-csv")
    feeds.events(spark, sf_dir).select(
        F.when(k % 2 == 0, "36").otherwise("34").alias("State Code"), name.alias("Parameter Name"),
        F.concat(F.lit("ST-"), F.col("event_id").cast("string")).alias("Site Num"), F.lit("").alias("Local Site Name"),
        F.when(k == 0, "").otherwise(F.col("value").cast("string")).alias("Arithmetic Mean"),
        F.lit("40.7").alias("Latitude"), F.lit("-74.0").alias("Longitude"),
    ).write.option("header", True).csv(path)
    return files.read_monitor_summary(spark, path).select("location", "parameter", "value", "unit", "date_utc")


@registry.add(sql.query(
    f"SELECT zone_id, {common.OFFLINE_LABEL_SQL} AS cluster FROM fused", sql.state(),
))
def label_document(spark, sf_dir):
    """Labels written as one metadata document and read back as rows."""
    state = common.scored_zones(spark, sf_dir)
    labels = state.select("zone_id", common.offline_label().alias("cluster"))
    document = sink.label_metadata(labels, dict(enumerate(dims.CLUSTER_NAMES)), dims.FEATURE_COLUMNS, 0.5)
    path = scratch_path(spark, "labels-json")
    sink.write_label_metadata(document, path)
    return files.read_zone_labels(spark, path)


@registry.add(sql.query(
    "SELECT segment_id AS key, zone_id, speed_kmh FROM traffic"
))
def keyed_messages(spark, sf_dir):
    """Messages published as (key, JSON) files and parsed back."""
    rows = feeds.traffic(feeds.events(spark, sf_dir)).select("segment_id", "zone_id", "speed_kmh")
    path = scratch_path(spark, "messages")
    sink.publish(sink.keyed_messages(rows, "segment_id"), "parquet", path)
    stored = spark.read.schema("key string, value string").parquet(path)
    return stored.select("key", F.from_json("value", schemas.TRAFFIC).alias("d")) \
        .select("key", "d.zone_id", "d.speed_kmh")


_FAST = f"(SELECT zone_id, {sql.mean('speed_kmh')} AS avg_speed FROM traffic WHERE speed_kmh > 150 GROUP BY zone_id)"
_ALL_SPEEDS = f"(SELECT zone_id, {sql.mean('speed_kmh')} AS avg_speed FROM traffic GROUP BY zone_id)"


@registry.add(sql.query(
    f"SELECT a.zone_id, coalesce(f.avg_speed, a.avg_speed) AS avg_speed FROM {_ALL_SPEEDS} a "
    f"LEFT JOIN {_FAST} f USING (zone_id)"
))
def latest_table(spark, sf_dir):
    """Two batches of zone means: the second only has fast zones, the others keep their first value."""
    traffic = feeds.traffic(feeds.events(spark, sf_dir))
    root = scratch_path(spark, "latest")

    def send(rows, time):
        means = rows.groupBy("zone_id").agg(exact_mean(F.col("speed_kmh")).alias("avg_speed"))
        means.select("*", F.lit(time).cast("timestamp").alias("at")).coalesce(1).write.mode("append").parquet(f"{root}/in")

    send(traffic, "2024-01-01 00:00:00")
    send(traffic.filter(F.col("speed_kmh") > 150), "2024-01-01 00:00:30")
    stream = spark.readStream.schema("zone_id string, avg_speed double, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    newest_rows(stream, ["zone_id"], "at", ttl_seconds=300).writeStream.outputMode("update").format("noop") \
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stored(spark, f"{root}/checkpoint", "newest").select("zone_id", "avg_speed")


@registry.add(sql.query("SELECT zone_id, day, zone_score FROM scored", sql.state("day")))
def score_snapshots(spark, sf_dir):
    """Snapshots per query and batch; a batch that runs twice is there once."""
    scores = common.scored_zones(spark, sf_dir, ["day"]).select("zone_id", "day", "zone_score")
    path = scratch_path(spark, "snapshots")
    for batch_id in (0, 0):
        write_snapshot(scores, path, "daily", batch_id)
    return spark.read.schema(scores.schema).parquet(path).select("zone_id", "day", "zone_score")
