"""Feature engineering and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions import geo
from zonewise.functions.air import aqi_proxy
from zonewise.functions.numeric import exact_mean, lookup
from zonewise.operators import cluster, features, online_kmeans, report, silhouette, zones
from zonewise.plans import Registry, common, sql
from zonewise.plans.zones import NEAREST_SQL
from zonewise.session import checkpointed
from zonewise.sources import feeds

registry = Registry()

# --- offline features ---------------------------------------------------------------------------------

_POSITIONS = [p / 100 for p in features.LATITUDE_PERCENTS]


def segments(spark, sf_dir):
    """(borough_id, lat, speed) rows as the feature matrix takes them."""
    rows = feeds.events(spark, sf_dir).filter(F.col("event_type").isin(feeds.TRAFFIC_TYPES) & (F.col("value") > 0))
    return rows.select(
        geo.borough_id(feeds.zone_at(F.col("user_id"))).alias("borough_id"),
        common.segment_latitude().alias("lat"), F.col("value").alias("speed"),
    )


def stations(spark, sf_dir):
    """(latitude, longitude, value) rows of the PM2.5 feed."""
    rows = feeds.events(spark, sf_dir).filter(F.col("event_type").isin(feeds.POLLUTION_TYPES) & (F.col("value") > 0))
    return common.placed(rows).select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "value")


def _pick(i: int, p: float) -> str:
    rank = f"({sql.num(p)} * CAST(n - 1 AS DOUBLE))"
    low = f"max(CASE WHEN rn = CAST(floor({rank}) AS BIGINT) THEN lat END)"
    high = f"max(CASE WHEN rn = CAST(ceil({rank}) AS BIGINT) THEN lat END)"
    frac = f"(any_value({rank}) - floor(any_value({rank})))"
    return (f"CASE WHEN {frac} >= 0.5e0 THEN {high} - ({high} - {low}) * (1e0 - {frac}) "
            f"ELSE {low} + ({high} - {low}) * {frac} END AS b{i}")


_BREAK_COLUMNS = ", ".join(_pick(i, p) for i, p in enumerate(_POSITIONS))
SEGMENT_SQL = f"""
segment AS (SELECT substr(zone_id, 1, 2) AS borough_id, {common.SEGMENT_LAT_SQL} AS lat, speed_kmh AS speed
  FROM traffic WHERE speed_kmh > 0),
breaks AS (SELECT borough_id, any_value(n) AS n, {_BREAK_COLUMNS} FROM (
  SELECT borough_id, lat, row_number() OVER (PARTITION BY borough_id ORDER BY lat) - 1 AS rn,
         count(*) OVER (PARTITION BY borough_id) AS n FROM segment) GROUP BY borough_id),
binned AS (SELECT s.*, CASE WHEN n > 1 AND lat < b6 THEN s.borough_id || '-0' || CAST(
  (CASE WHEN lat >= b5 THEN 6 WHEN lat >= b4 THEN 5 WHEN lat >= b3 THEN 4 WHEN lat >= b2 THEN 3 WHEN lat >= b1 THEN 2
   ELSE 1 END) AS VARCHAR) END AS zone_id FROM segment s JOIN breaks USING (borough_id))"""

_SPEED_STATS = (f"{sql.mean('speed')} AS avg_speed, {sql.stddev_pop('speed')} AS std_speed, "
                f"{sql.mean('CASE WHEN speed < 20 THEN 1e0 ELSE 0e0 END')} AS pct_slow")
_DEFAULT = sql.case("substr(z.zone_id, 1, 2)", dims.BOROUGH_DEFAULT_SPEED, "30e0")
FEATURE_SQL = f"""
by_zone AS (SELECT zone_id, {_SPEED_STATS} FROM binned WHERE zone_id IS NOT NULL GROUP BY zone_id),
by_borough AS (SELECT borough_id, {_SPEED_STATS} FROM segment GROUP BY borough_id),
t_feat AS (SELECT z.zone_id, coalesce(a.avg_speed, b.avg_speed, {_DEFAULT}) AS avg_speed,
    coalesce(a.std_speed, b.std_speed, 0e0) AS std_speed,
    coalesce(a.pct_slow, b.pct_slow, CASE WHEN {_DEFAULT} < 20 THEN 1e0 ELSE 0e0 END) AS pct_slow
  FROM zones z LEFT JOIN by_zone a USING (zone_id) LEFT JOIN by_borough b ON b.borough_id = substr(z.zone_id, 1, 2)),
p_feat AS (SELECT zone_id, {sql.mean('value')} AS avg_pm25, max(value) AS max_pm25,
    coalesce({sql.stddev_samp('value')}, 0e0) AS std_pm25
  FROM nearest WHERE event_type IN ('error', 'purchase') AND value > 0 GROUP BY zone_id),
features AS (SELECT t.*, coalesce(avg_pm25, 0e0) AS avg_pm25, coalesce(max_pm25, 0e0) AS max_pm25,
    coalesce(std_pm25, 0e0) AS std_pm25, {sql.density('t.zone_id')} AS density,
    coalesce(avg_pm25, 0e0) * 4e0 AS avg_aqi_proxy FROM t_feat t LEFT JOIN p_feat USING (zone_id))"""
_ALL_FEATURES = (sql.ZONES, SEGMENT_SQL, NEAREST_SQL, FEATURE_SQL)


def feature_matrix(spark, sf_dir):
    return features.zone_features(dims.zones_frame(spark), segments(spark, sf_dir), stations(spark, sf_dir))


@registry.add(sql.query("SELECT borough_id, zone_id, count(*) AS n FROM binned GROUP BY ALL", SEGMENT_SQL))
def latitude_bins(spark, sf_dir):
    """Rows per latitude bin; the row on the top break is in none."""
    rows = segments(spark, sf_dir)
    return features.latitude_zones(rows, features.latitude_breaks(rows)) \
        .groupBy("borough_id", "zone_id").agg(F.count(F.lit(1)).alias("n"))


@registry.add(sql.query("SELECT * FROM t_feat", *_ALL_FEATURES))
def traffic_features(spark, sf_dir):
    return features.traffic_features(dims.zones_frame(spark), segments(spark, sf_dir))


@registry.add(sql.query("SELECT * FROM p_feat", *_ALL_FEATURES))
def pollution_features(spark, sf_dir):
    return features.pollution_features(stations(spark, sf_dir))


@registry.add(sql.query("SELECT * FROM features", *_ALL_FEATURES))
def zone_features(spark, sf_dir):
    return feature_matrix(spark, sf_dir)


_LIVE = ["avg_speed", "avg_aqi", "avg_pm25"]


def _standard_sql(columns: list[str]) -> str:
    parts = ", ".join(
        f"coalesce(({c} - m_{c}) / nullif(s_{c}, 0e0), 0e0) AS {c}" for c in columns
    )
    stats = ", ".join(f"{sql.mean(c)} AS m_{c}, {sql.stddev_pop(c)} AS s_{c}" for c in columns)
    return f"SELECT zone_id, day, {parts} FROM scored, (SELECT {stats} FROM scored)"


@registry.add(sql.query(_standard_sql(_LIVE), sql.state("day")))
def standardised_features(spark, sf_dir):
    rows = common.stored_zones(spark, sf_dir, ["day"]).select("zone_id", "day", *_LIVE)
    return cluster.standardised(rows, _LIVE)


# --- silhouette ---------------------------------------------------------------------------------------

_POINTS = f"""
std AS ({_standard_sql(_LIVE)}),
points AS (SELECT s.zone_id || '/' || s.day AS point, s.avg_speed, s.avg_aqi, s.avg_pm25,
    CASE {common.LIVE_LABEL_SQL} WHEN 'Permanently Hazardous' THEN 0 WHEN 'Peak Hour Hazardous' THEN 1
      WHEN 'Weather Sensitive' THEN 2 ELSE 3 END AS label
  FROM std s JOIN (SELECT zone_id, day, avg_aqi, avg_speed FROM scored) r USING (zone_id, day))"""
_POINTS = _POINTS.replace("(avg_aqi - avg_speed)", "(r.avg_aqi - r.avg_speed)")
_DISTANCE = " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in _LIVE)
SILHOUETTE_SQL = f"""
pairs AS (SELECT x.point, x.label, y.label AS other, CAST(sum(CAST(sqrt({_DISTANCE}) * 1e9 AS BIGINT)) AS BIGINT) AS total,
    count(*) AS n FROM points x, points y GROUP BY ALL),
ab AS (SELECT point, label, max(CASE WHEN other = label THEN n END) AS n_in_cluster,
    max(CASE WHEN other = label THEN CAST(total AS DOUBLE) / (CAST(nullif(n - 1, 0) AS DOUBLE) * 1e9) END) AS a,
    min(CASE WHEN other <> label THEN CAST(total AS DOUBLE) / (CAST(n AS DOUBLE) * 1e9) END) AS b FROM pairs GROUP BY ALL),
sil AS (SELECT *, CASE WHEN n_in_cluster > 1 THEN coalesce((b - a) / nullif(greatest(a, b), 0e0), 0e0) ELSE 0e0 END
  AS silhouette FROM ab)"""


def _labelled_points(spark, sf_dir):
    rows = common.stored_zones(spark, sf_dir, ["day"])
    number = {n: i for i, n in enumerate(dims.CLUSTER_NAMES)}
    named = rows.withColumn("label", lookup(common.live_label(), number)) \
        .withColumn("point", F.concat_ws("/", "zone_id", "day"))
    return cluster.standardised(named.select("point", "label", *_LIVE), _LIVE)


@registry.add(sql.query("SELECT * FROM sil", sql.state("day"), _POINTS, SILHOUETTE_SQL))
def silhouette_values(spark, sf_dir):
    """Euclidean silhouette of every zone and day under the hazard labels."""
    return silhouette.silhouette_rows(_labelled_points(spark, sf_dir), _LIVE, key="point")


@registry.add(sql.query(
    "SELECT point AS zone_id, label, silhouette, count(*) OVER (PARTITION BY label) AS n_in_label, "
    f"(SELECT {sql.mean('silhouette')} FROM sil) AS mean_silhouette FROM sil",
    sql.state("day"), _POINTS, SILHOUETTE_SQL,
))
def silhouette_profile(spark, sf_dir):
    rows = silhouette.silhouette_rows(_labelled_points(spark, sf_dir), _LIVE, key="point")
    return report.silhouette_profile(rows.select(F.col("point").alias("zone_id"), "label", "silhouette"))


# --- online k-means -----------------------------------------------------------------------------------

_ONLINE = online_kmeans.FEATURES
_ONLINE_SQL = f"online AS (SELECT zone_id, day, avg_speed, avg_aqi, avg_pm25, {sql.density('zone_id')} AS density FROM scored)"


def _online_rows(spark, sf_dir):
    return common.scored_zones(spark, sf_dir, ["day"]).select(
        "zone_id", "day", *_ONLINE[:3], geo.density(F.col("zone_id")).alias("density")
    )


_RANGES = ", ".join(
    f"least({sql.num(lo)}, min({c})) AS {c}_lo, greatest({sql.num(hi)}, max({c})) AS {c}_hi"
    for c, (lo, hi) in zip(_ONLINE, dims.ONLINE_RANGES)
)


@registry.add(sql.query(f"SELECT {_RANGES} FROM online", sql.state("day"), _ONLINE_SQL))
def feature_range(spark, sf_dir):
    return online_kmeans.feature_ranges(_online_rows(spark, sf_dir), _ONLINE, dims.ONLINE_RANGES)


def _scaled_sql() -> str:
    columns = ", ".join(f"({c} - {sql.num(lo)}) / {sql.num(max(1e-9, hi - lo))} AS {c}"
                        for c, (lo, hi) in zip(_ONLINE, dims.ONLINE_RANGES))
    return f"scaled AS (SELECT zone_id, day, {columns} FROM online)"


def _scaled(spark, sf_dir):
    return _online_rows(spark, sf_dir).select("zone_id", "day", *[
        online_kmeans.normalised(F.col(c), lo, hi).alias(c) for c, (lo, hi) in zip(_ONLINE, dims.ONLINE_RANGES)
    ])


@registry.add(sql.query("SELECT * FROM scaled", sql.state("day"), _ONLINE_SQL, _scaled_sql()))
def minmax_normalise(spark, sf_dir):
    return _scaled(spark, sf_dir)


# a model with three past batches, to take one more step from
_CENTROIDS = ((0.3, 0.7, 0.9, 1.0), (0.5, 0.6, 0.8, 0.6), (0.7, 0.5, 0.6, 0.5), (0.9, 0.4, 0.5, 0.3))
_COUNTS = (40, 10, 25, 15)


def _squared_sql(centroid) -> str:
    return "(" + " + ".join(f"({c} - {sql.num(p)}) * ({c} - {sql.num(p)})" for c, p in zip(_ONLINE, centroid)) + ")"


_DISTANCES = [_squared_sql(c) for c in _CENTROIDS]
_NEAREST_LABEL = (
    f"CASE least({', '.join(_DISTANCES)}) " + " ".join(f"WHEN {d} THEN {i}" for i, d in enumerate(_DISTANCES)) + " END"
)
_ASSIGNED_SQL = f"assigned AS (SELECT *, {_NEAREST_LABEL} AS label FROM scaled)"
_MODEL_SQL = "model(label, n0, " + ", ".join(f"m_{c}" for c in _ONLINE) + ") AS (VALUES " + ", ".join(
    f"({i}, {n}, {', '.join(sql.num(v) for v in c)})" for i, (c, n) in enumerate(zip(_CENTROIDS, _COUNTS))
) + ")"
_STEP = f"""
batch AS (SELECT label, count(*) AS n, {', '.join(f"{sql.mean(c)} AS b_{c}" for c in _ONLINE)} FROM assigned GROUP BY label),
step AS (SELECT label, n0 + n AS count, {', '.join(
    f"(1e0 - CAST(n AS DOUBLE) / CAST(n0 + n AS DOUBLE)) * m_{c} + CAST(n AS DOUBLE) / CAST(n0 + n AS DOUBLE) * b_{c} AS {c}"
    for c in _ONLINE)} FROM batch JOIN model USING (label))"""
_MODEL_CTES = (sql.state("day"), _ONLINE_SQL, _scaled_sql(), _ASSIGNED_SQL, _MODEL_SQL, _STEP)


def _assigned(spark, sf_dir):
    label = online_kmeans.nearest_centroid([F.col(c) for c in _ONLINE], _CENTROIDS)
    return _scaled(spark, sf_dir).withColumn("label", label)


@registry.add(sql.query("SELECT zone_id, day, label FROM assigned", *_MODEL_CTES))
def assign_centroids(spark, sf_dir):
    return _assigned(spark, sf_dir).select("zone_id", "day", "label")


@registry.add(sql.query("SELECT * FROM step", *_MODEL_CTES))
def centroid_update(spark, sf_dir):
    return online_kmeans.updated_centroids(_assigned(spark, sf_dir), _ONLINE, _CENTROIDS, _COUNTS)


_INERTIA = "(" + " + ".join(f"(a.{c} - s.{c}) * (a.{c} - s.{c})" for c in _ONLINE) + ")"


@registry.add(sql.query(
    f"SELECT CAST(sum({sql.units(_INERTIA, 9)}) AS DOUBLE) / 1e9 AS inertia FROM assigned a JOIN step s USING (label)",
    *_MODEL_CTES
))
def batch_inertia(spark, sf_dir):
    """Squared distances to the updated centroids of the labels that the rows had before the update."""
    assigned = _assigned(spark, sf_dir)
    moved = {r["label"]: r for r in online_kmeans.updated_centroids(assigned, _ONLINE, _CENTROIDS, _COUNTS).collect()}  # k rows
    updated = [tuple(moved[j][c] for c in _ONLINE) if j in moved else old for j, old in enumerate(_CENTROIDS)]
    return assigned.agg(online_kmeans.batch_inertia(_ONLINE, updated).alias("inertia"))


_GROUPS = (f"groups AS (SELECT CAST(substr(day, 9, 2) AS INTEGER) % 5 AS cluster_id, {sql.mean('avg_aqi')} AS avg_aqi, "
           f"{sql.mean('avg_speed')} AS avg_speed, {sql.mean('avg_pm25')} * 4e0 AS avg_aqi_proxy FROM scored GROUP BY 1)")
_NAME_LIST = "[" + ", ".join(f"'{n}'" for n in dims.CLUSTER_NAMES) + "]"


@registry.add(sql.query(
    "SELECT cluster_id, hazard, CAST(r AS INTEGER) AS hazard_rank, CASE WHEN r < 4 THEN "
    f"{_NAME_LIST}[r + 1] ELSE 'Cluster ' || CAST(r AS VARCHAR) END AS cluster FROM (SELECT *, "
    "row_number() OVER (ORDER BY hazard DESC, cluster_id) - 1 AS r FROM (SELECT cluster_id, "
    "avg_aqi_proxy / (max(avg_aqi_proxy) OVER () + 1e-9) - avg_speed / (max(avg_speed) OVER () + 1e-9) AS hazard FROM groups))",
    sql.state("day"), _GROUPS,
))
def hazard_rank(spark, sf_dir):
    """Five groups of days named by hazard; the fifth has no name of its own."""
    groups = common.scored_zones(spark, sf_dir, ["day"]) \
        .groupBy(F.pmod(F.substring("day", 9, 2).cast("int"), F.lit(5)).alias("cluster_id")) \
        .agg(exact_mean(F.col("avg_aqi")).alias("avg_aqi"), exact_mean(F.col("avg_speed")).alias("avg_speed"),
             aqi_proxy(exact_mean(F.col("avg_pm25"))).alias("avg_aqi_proxy"))
    return cluster.hazard_names(groups).select("cluster_id", "hazard", "hazard_rank", "cluster")


@registry.add(sql.query(
    "SELECT cluster_id, hazard, CAST(r AS INTEGER) AS hazard_rank, "
    f"{_NAME_LIST}[least(r, 3) + 1] AS cluster FROM (SELECT *, row_number() OVER (ORDER BY hazard DESC, cluster_id) - 1 AS r "
    "FROM (SELECT cluster_id, avg_aqi - avg_speed AS hazard FROM groups))",
    sql.state("day"), _GROUPS,
))
def hazard_rank_online(spark, sf_dir):
    groups = common.scored_zones(spark, sf_dir, ["day"]) \
        .groupBy(F.pmod(F.substring("day", 9, 2).cast("int"), F.lit(5)).alias("cluster_id")) \
        .agg(exact_mean(F.col("avg_aqi")).alias("avg_aqi"), exact_mean(F.col("avg_speed")).alias("avg_speed"))
    return cluster.hazard_names(groups, online=True).select("cluster_id", "hazard", "hazard_rank", "cluster")


# --- models (compared with brute force in the tests) ---------------------------------------------------

@registry.add()
def kmeans_offline(spark, sf_dir):
    """Zone names from a k-means fit on the feature matrix, with features and silhouettes."""
    matrix = checkpointed(feature_matrix(spark, sf_dir))
    model = cluster.train(matrix)
    return cluster.assignment_table(cluster.assigned(matrix, model), matrix, cluster.silhouettes(matrix, model))


@registry.add()
def kmeans_sweep(spark, sf_dir):
    """Inertia and silhouette for k = 2..6."""
    return cluster.sweep(checkpointed(feature_matrix(spark, sf_dir)))


@registry.add()
def principal_components(spark, sf_dir):
    matrix = checkpointed(feature_matrix(spark, sf_dir))
    points, _, _ = cluster.project(matrix, cluster.train(matrix))
    return points


@registry.add()
def predict_zones(spark, sf_dir):
    """A name for every zone and day from the model fitted on the whole feature matrix."""
    model = cluster.train(checkpointed(feature_matrix(spark, sf_dir)))
    live = common.scored_zones(spark, sf_dir, ["day"]).select("zone_id", "day", "avg_speed", "avg_pm25")
    return cluster.predict_zones(live, model).select("zone_id", "day", "avg_speed", "avg_pm25", "cluster")


@registry.add()
def kmeans_online(spark, sf_dir):
    """One update per ten days of zone states, then names for all zones and days."""
    rows = checkpointed(_online_rows(spark, sf_dir).withColumn("point", F.concat_ws("/", "zone_id", "day")))
    model = online_kmeans.OnlineModel.empty()
    for third in range(4):
        batch = rows.filter(F.floor(F.substring("day", 9, 2).cast("int") / F.lit(10)) == third)
        _, model = online_kmeans.partial_fit(batch, model, key="point")
    labels, _ = online_kmeans.partial_fit(rows, model, key="point")
    return online_kmeans.named_labels(labels, model).select("zone_id", "day", "label", "cluster")
