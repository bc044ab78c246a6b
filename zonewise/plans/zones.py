"""Zone state, scores, classes, geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions import air, geo, labels
from zonewise.functions.numeric import exact_mean, lookup
from zonewise.operators import report, zones
from zonewise.operators.ordered import row_positions
from zonewise.plans import Registry, common, sql
from zonewise.sources import feeds

registry = Registry()

_PREFIX_BOROUGH = sql.borough("zone_id")


@registry.add(sql.query(
    f"SELECT zone_id, {sql.mean('speed_kmh')} AS avg_speed, {_PREFIX_BOROUGH} AS borough, count(*) AS n_rows "
    "FROM traffic GROUP BY zone_id"
))
def zone_traffic_mean(spark, sf_dir):
    rows = feeds.traffic(feeds.events(spark, sf_dir)).withColumn("borough", geo.borough_name(F.col("zone_id")))
    return zones.traffic_means(rows, feeds.order())


@registry.add(sql.query(
    f"SELECT zone_id, {sql.mean('aqi')} AS avg_aqi, {sql.mean('pm25')} AS avg_pm25, {sql.mean('no2')} AS avg_no2, "
    "count(*) AS n_rows FROM pollution GROUP BY zone_id"
))
def zone_pollution_mean(spark, sf_dir):
    return zones.pollution_means(feeds.pollution(feeds.events(spark, sf_dir)))


_SCORE_COLUMNS = "zone_id, day, avg_speed, avg_aqi, avg_pm25, avg_no2, zone_score, event_type"


@registry.add(sql.query(f"SELECT {_SCORE_COLUMNS} FROM scored", sql.state("day")))
def zone_score_daily(spark, sf_dir):
    return common.scored_zones(spark, sf_dir, ["day"])


@registry.add(sql.query(
    "SELECT zone_id, day, least(1e0, avg_speed / 40e0) * 0.5e0 + (1e0 - least(1e0, avg_aqi / 200e0)) * 0.5e0 "
    f"AS zone_score, {sql.event_class('avg_speed', 'avg_aqi', 25.0, 100.0)} AS event_type FROM fused",
    sql.state("day"),
))
def zone_score_inverted(spark, sf_dir):
    state = zones.fused_means(feeds.readings(feeds.events(spark, sf_dir)), ["day"])
    scored = zones.scored(state, inverted=True, congestion_below=25.0, pollution_above=100.0)
    return feeds.day_text(scored).select("zone_id", "day", "zone_score", "event_type")


@registry.add(sql.query(
    f"SELECT zone_id, avg_speed, borough, avg_aqi, avg_pm25, avg_no2, {sql.score('avg_speed', 'avg_aqi')} AS zone_score,"
    f" {sql.event_class('avg_speed', 'avg_aqi')} AS event_type FROM (SELECT zone_id, "
    "coalesce(t.avg_speed, 40e0) AS avg_speed, coalesce(t.borough, '') AS borough, coalesce(p.avg_aqi, 50e0) AS avg_aqi,"
    " coalesce(p.avg_pm25, 10e0) AS avg_pm25, coalesce(p.avg_no2, 20e0) AS avg_no2 "
    f"FROM (SELECT zone_id, {sql.mean('speed_kmh')} AS avg_speed, {_PREFIX_BOROUGH} AS borough FROM traffic "
    "GROUP BY zone_id) t FULL OUTER JOIN "
    f"(SELECT zone_id, {sql.mean('aqi')} AS avg_aqi, {sql.mean('pm25')} AS avg_pm25, {sql.mean('no2')} AS avg_no2 "
    "FROM pollution GROUP BY zone_id) p USING (zone_id))"
))
def zone_fusion(spark, sf_dir):
    """Two separate feeds joined by zone."""
    events = feeds.events(spark, sf_dir)
    traffic = feeds.traffic(events).withColumn("borough", geo.borough_name(F.col("zone_id")))
    pollution = feeds.pollution(events)
    return zones.scored(zones.fuse(zones.traffic_means(traffic, feeds.order()), zones.pollution_means(pollution)))


@registry.add(sql.query(
    "SELECT z.zone_id, coalesce(t.avg_speed, 30e0) AS avg_speed, coalesce(p.avg_aqi, 50e0) AS avg_aqi, "
    f"coalesce(p.avg_pm25, 10e0) AS avg_pm25, {sql.density('z.zone_id')} AS density FROM zones z "
    f"LEFT JOIN (SELECT zone_id, {sql.mean('speed_kmh')} AS avg_speed FROM traffic GROUP BY 1) t "
    f"USING (zone_id) LEFT JOIN (SELECT zone_id, {sql.mean('aqi')} AS avg_aqi, {sql.mean('pm25')} AS avg_pm25 "
    "FROM pollution GROUP BY 1) p USING (zone_id) "
    "WHERE (SELECT count(DISTINCT zone_id) FROM (SELECT zone_id FROM traffic "
    "UNION ALL SELECT zone_id FROM pollution)) >= 4",
    sql.ZONES,
))
def cluster_inputs(spark, sf_dir):
    """All zones with the clustering defaults where a feed has no rows."""
    readings = feeds.readings(feeds.events(spark, sf_dir))
    inputs = zones.cluster_inputs(dims.zones_frame(spark), zones.fused_means(readings))
    return inputs.select("zone_id", "avg_speed", "avg_aqi", "avg_pm25", "density")


@registry.add(sql.query(
    "SELECT event_type, count(*) AS n FROM scored GROUP BY event_type UNION ALL "
    "SELECT name, 0 FROM (VALUES ('NORMAL'), ('CONGESTION_EVENT'), ('POLLUTION_ALERT'), ('COMPOUND_EVENT')) v(name) "
    "WHERE name NOT IN (SELECT event_type FROM scored)",
    sql.state("day"),
))
def event_counts(spark, sf_dir):
    return report.event_counts(common.scored_zones(spark, sf_dir, ["day"]))


_ALIASES = {"click": "CONGESTION", "view": "NORMAL", "error": "POLLUTION", "purchase": "COMPOUND"}


@registry.add(sql.query(
    "SELECT CASE event_type WHEN 'click' THEN 'CONGESTION_EVENT' WHEN 'error' THEN 'POLLUTION_ALERT' "
    "WHEN 'purchase' THEN 'COMPOUND_EVENT' ELSE 'NORMAL' END AS event_type, count(*) AS n FROM ev GROUP BY 1"
))
def event_names(spark, sf_dir):
    """Short aliases and missing names brought to the four classes."""
    raw = feeds.events(spark, sf_dir).select(lookup(F.col("event_type"), _ALIASES).alias("event_type"))
    return report.event_counts(raw)


@registry.add(sql.query(
    "SELECT day, count(*) AS n_anomalies, string_agg(CASE WHEN nth <= 5 THEN zone_id || ':' || event_type END, ', ' "
    "ORDER BY nth) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY "
    f"{sql.zone_ord('zone_id')}) AS nth FROM scored WHERE event_type <> 'NORMAL') GROUP BY day",
    sql.state("day"),
))
def anomaly_zones(spark, sf_dir):
    return zones.anomaly_summary(common.stored_zones(spark, sf_dir, ["day"]), ["day"])


@registry.add(sql.query(
    "SELECT *, CASE WHEN avg_zone_score > 0.6e0 THEN 'good' WHEN avg_zone_score > 0.4e0 THEN 'fair' ELSE 'bad' END "
    "AS score_class, CASE WHEN avg_city_aqi > 100e0 THEN 'bad' WHEN avg_city_aqi > 50e0 THEN 'fair' ELSE 'good' END "
    f"AS aqi_class FROM (SELECT day, {sql.mean('zone_score')} AS avg_zone_score, {sql.mean('avg_aqi')} AS "
    "avg_city_aqi, CAST(sum(CASE WHEN event_type <> 'NORMAL' THEN 1 ELSE 0 END) AS BIGINT) AS active_events, "
    "CAST(sum(CASE WHEN event_type = 'COMPOUND_EVENT' THEN 1 ELSE 0 END) AS BIGINT) AS compound_events "
    "FROM scored GROUP BY day)",
    sql.state("day"),
))
def city_kpis(spark, sf_dir):
    return report.city_kpis(common.scored_zones(spark, sf_dir, ["day"]), ["day"]).withColumns({
        "score_class": labels.city_score_bucket(F.col("avg_zone_score")),
        "aqi_class": labels.city_aqi_bucket(F.col("avg_city_aqi")),
    })


@registry.add(sql.query(
    "SELECT zone_id, substr(zone_id, 1, 2) AS borough_id FROM (SELECT zone_id FROM traffic "
    "UNION SELECT zone_id FROM pollution)"
))
def key_union(spark, sf_dir):
    """Zones that appear in either feed."""
    events = feeds.events(spark, sf_dir)
    seen = feeds.traffic(events).select("zone_id").union(feeds.pollution(events).select("zone_id")).distinct()
    return seen.select("zone_id", geo.borough_id(F.col("zone_id")).alias("borough_id"))


_MAP_STATUS = "CASE WHEN zone_score > 0.7e0 THEN 'Good' WHEN zone_score > 0.4e0 THEN 'Moderate' ELSE 'Poor' END"


@registry.add(sql.query(
    f"SELECT z.zone_id, {sql.borough('z.zone_id')} AS borough, zone_score, avg_aqi, avg_speed, s.event_type, "
    f"CASE WHEN s.zone_id IS NULL THEN '' ELSE {common.LIVE_LABEL_SQL} END AS cluster, "
    f"coalesce(workers, 0) AS workers, {_MAP_STATUS} AS status, "
    "500 + coalesce(workers, 0) * 80 AS radius FROM zones z LEFT JOIN scored s USING (zone_id) "
    "LEFT JOIN (SELECT zone_id, count(*) AS workers FROM worker GROUP BY zone_id) USING (zone_id)",
    sql.state(), sql.ZONES,
))
def zone_map(spark, sf_dir):
    scores = common.stored_zones(spark, sf_dir)
    shown = scores.select("zone_id", "zone_score", "avg_aqi", "avg_speed", "event_type")
    clusters = scores.select("zone_id", common.live_label().alias("cluster"))
    workers = report.workers_per_zone(feeds.workers(feeds.events(spark, sf_dir)))
    return report.zone_map(dims.zones_frame(spark), shown, clusters, workers).drop("lat", "lon")


# --- air-quality index --------------------------------------------------------------------------------

@registry.add(sql.query(f"SELECT event_id, {sql.index('pm25', dims.PM25_BREAKPOINTS)} AS aqi FROM pollution"))
def aqi_pm25(spark, sf_dir):
    rows = feeds.pollution(feeds.events(spark, sf_dir))
    return rows.select("event_id", air.aqi_from_breakpoints(F.col("pm25"), dims.PM25_BREAKPOINTS).alias("aqi"))


@registry.add(sql.query("SELECT event_id, aqi FROM pollution"))
def aqi_combined(spark, sf_dir):
    return feeds.pollution(feeds.events(spark, sf_dir)).select("event_id", "aqi")


@registry.add(sql.query(
    f"SELECT event_id, {sql.index('pm25', dims.PM25_BREAKPOINTS, 'least(500e0, pm25 * 2.1e0)')} AS aqi FROM pollution"
))
def aqi_pm25_only(spark, sf_dir):
    rows = feeds.pollution(feeds.events(spark, sf_dir))
    return rows.select("event_id", air.aqi_pm25_only(F.col("pm25")).alias("aqi"))


@registry.add(sql.query(
    "SELECT event_id, " + sql.index("conc", dims.PM25_BREAKPOINTS)
    + " AS aqi FROM (SELECT event_id, floor(pm25 * 10e0) / 10e0 AS conc FROM pollution)"
))
def aqi_without_gaps(spark, sf_dir):
    """The concentration cut to the table's one decimal first."""
    rows = feeds.pollution(feeds.events(spark, sf_dir))
    index = air.aqi_from_breakpoints(F.col("pm25"), dims.PM25_BREAKPOINTS, truncate_digits=1)
    return rows.select("event_id", index.alias("aqi"))


@registry.add(sql.query(f"SELECT event_id, {sql.index('pm25', dims.PM25_BREAKPOINTS)} AS aqi FROM pollution"))
def aqi_range_join(spark, sf_dir):
    """The breakpoint table as data: each segment is listed under every whole number it touches, so the range
    join is an equality join on floor(concentration) against some 500 rows."""
    segments = spark.createDataFrame(
        [(float(lo), float(hi), float(ilo), air.slope(lo, hi, ilo, ihi)) for lo, hi, ilo, ihi in dims.PM25_BREAKPOINTS],
        "lo double, hi double, index_lo double, slope double",
    ).withColumn("cell", F.explode(F.sequence(F.floor("lo"), F.floor("hi"))))
    rows = feeds.pollution(feeds.events(spark, sf_dir)).select("event_id", "pm25", F.floor("pm25").alias("cell"))
    within = (rows["cell"] == segments["cell"]) & rows["pm25"].between(segments["lo"], segments["hi"])
    index = segments["slope"] * (rows["pm25"] - segments["lo"]) + segments["index_lo"]
    return rows.join(F.broadcast(segments), within, "left") \
        .select("event_id", F.coalesce(index, F.lit(air.INDEX_CEILING)).alias("aqi"))


# --- geography ----------------------------------------------------------------------------------------

def _box(i: int) -> str:
    return "(" + sql.case("substr(zone_id, 1, 2)", {b: dims.BOROUGH_BOUNDS[b][i] for b in dims.BOROUGHS}, "NULL") + ")"


_CELL = "(CAST(substr(zone_id, 4, 2) AS INTEGER) - 1)"


@registry.add(sql.query(
    f"SELECT zone_id, {_box(0)} + (CAST({_CELL} // 2 AS DOUBLE) + 0.5e0) * ({_box(1)} - {_box(0)}) / 3e0 AS lat, "
    f"{_box(2)} + (CAST({_CELL} % 2 AS DOUBLE) + 0.5e0) * ({_box(3)} - {_box(2)}) / 2e0 AS lon, n_rows "
    "FROM (SELECT zone_id, count(*) AS n_rows FROM traffic GROUP BY zone_id)"
))
def zone_grid(spark, sf_dir):
    """Zones with traffic, with the midpoint of their grid cell."""
    counts = feeds.traffic(feeds.events(spark, sf_dir)).groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_rows"))
    lat, lon = geo.grid_midpoint(F.col("zone_id"))
    return counts.select("zone_id", lat.alias("lat"), lon.alias("lon"), "n_rows")


_CENTROIDS = ", ".join(
    f"('{z}', {i}, {sql.num(lat)}, {sql.num(lon)})" for i, (z, lat, lon) in enumerate(dims.zone_centroids())
)
NEAREST_SQL = f"""
placed AS (SELECT event_id, value, event_type, {common.LAT_SQL} AS lat, {common.LON_SQL} AS lon FROM ev),
centroids(zone_id, ord, z_lat, z_lon) AS (VALUES {_CENTROIDS}),
nearest AS (SELECT event_id, value, event_type, zone_id FROM (
  SELECT p.event_id, p.value, p.event_type, c.zone_id, row_number() OVER (PARTITION BY p.event_id ORDER BY
    (lat - z_lat) * (lat - z_lat) + (lon - z_lon) * (lon - z_lon), ord) AS nth
  FROM placed p, centroids c) WHERE nth = 1)"""


@registry.add(sql.query("SELECT event_id, zone_id FROM nearest", NEAREST_SQL))
def nearest_zone(spark, sf_dir):
    events = common.placed(feeds.events(spark, sf_dir))
    return events.select("event_id", geo.nearest_zone(F.col("lat"), F.col("lon")).alias("zone_id"))


_BOXES = " ".join(
    f"WHEN {common.LAT_SQL} BETWEEN {sql.num(a)} AND {sql.num(b)} AND {common.LON_SQL} BETWEEN {sql.num(c)} AND "
    f"{sql.num(d)} THEN '{p}'" for p, (a, b, c, d) in dims.BOROUGH_BOUNDS.items()
)


@registry.add(sql.query(
    f"SELECT event_id, CASE {_BOXES} ELSE 'MN' END || '-0' || CAST(event_id % 6 + 1 AS VARCHAR) AS zone_id FROM ev"
))
def bbox_zone(spark, sf_dir):
    zone = geo.bounding_box_zone(F.col("lat"), F.col("lon"), F.col("event_id"))
    return common.placed(feeds.events(spark, sf_dir)).select("event_id", zone.alias("zone_id"))


_ADJACENT = sql.case("substr(a.zone_id, 1, 2)", dims.ADJACENT_BOROUGH, "NULL")


@registry.add(sql.query(
    "SELECT a.zone_id, b.zone_id AS neighbour, s.avg_speed FROM zones a, zones b "
    f"LEFT JOIN (SELECT zone_id, {sql.mean('speed_kmh')} AS avg_speed FROM traffic GROUP BY zone_id) s "
    "ON s.zone_id = b.zone_id WHERE a.zone_id IN (SELECT zone_id FROM traffic) AND a.zone_id <> b.zone_id AND "
    "(substr(a.zone_id, 1, 2) = substr(b.zone_id, 1, 2) OR (substr(b.zone_id, 1, 2) = "
    f"{_ADJACENT} AND substr(b.zone_id, 4, 2) IN ('01', '02')))",
    sql.ZONES,
))
def zone_neighbors(spark, sf_dir):
    """Mean speed in every zone next to a zone with traffic."""
    means = feeds.traffic(feeds.events(spark, sf_dir)).groupBy("zone_id") \
        .agg(exact_mean(F.col("speed_kmh")).alias("avg_speed"))
    near = means.select("zone_id", F.explode(geo.neighbours(F.col("zone_id"))).alias("neighbour"))
    return near.join(means.withColumnRenamed("zone_id", "neighbour"), "neighbour", "left") \
        .select("zone_id", "neighbour", "avg_speed")


_BOROUGH_K = "substr('MNBKQNBXSI', CAST(2 * (k % 5) + 1 AS INTEGER), 2)"


@registry.add(sql.query(
    f"SELECT event_id, position, {_BOROUGH_K} || '-0' || CAST(position % 6 + 1 AS VARCHAR) AS zone_id "
    "FROM (SELECT event_id, k, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM traffic)"
))
def round_robin_zone(spark, sf_dir):
    """Zones of a borough dealt out in turn by the row's position in the feed."""
    events = feeds.events(spark, sf_dir)
    borough = F.get(F.array(*[F.lit(b) for b in dims.BOROUGHS]), F.pmod(feeds.props_k(), F.lit(5)))
    rows = events.filter(F.col("event_type").isin(feeds.TRAFFIC_TYPES)).select("event_id", "event_time", borough.alias("b"))
    placed = row_positions(rows, feeds.order())
    return placed.select("event_id", "position", geo.nth_zone_of(F.col("b"), F.col("position")).alias("zone_id"))


_OFFSET = "CAST(CAST('0x' || substr(md5(segment_id), 1, 8) AS BIGINT) % 1000 AS DOUBLE) / 100000e0"


@registry.add(sql.query(
    f"SELECT segment_id, {sql.case('substr(zone_id, 1, 2)', {b: c[0] for b, c in dims.BOROUGH_CENTROIDS.items()}, 'NULL')}"
    f" + {_OFFSET} AS lat, "
    f"{sql.case('substr(zone_id, 1, 2)', {b: c[1] for b, c in dims.BOROUGH_CENTROIDS.items()}, 'NULL')} + {_OFFSET} AS lon "
    "FROM traffic"
))
def segment_locations(spark, sf_dir):
    rows = feeds.traffic(feeds.events(spark, sf_dir))
    lat, lon = geo.segment_location(geo.borough_id(F.col("zone_id")), F.col("segment_id"))
    return rows.select("segment_id", lat.alias("lat"), lon.alias("lon"))
