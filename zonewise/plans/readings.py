"""Cleaning, parsing, filling and summarising of readings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise import dims
from zonewise.functions import labels
from zonewise.functions.numeric import (
    default_if_falsy, exact_mean, first_number, first_text, fixed_point, lookup, round_exact,
)
from zonewise.operators import forecast
from zonewise.plans import Registry, sql
from zonewise.sources import feeds, files, streams

registry = Registry()

_RAW_BOROUGH = (
    "CASE user_id % 7 WHEN 0 THEN ' manhattan ' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'QUEENS' WHEN 3 THEN 'Bronx' "
    "WHEN 4 THEN 'Staten Island' WHEN 5 THEN 'Jersey City' ELSE '' END"
)


@registry.add(sql.query(
    "SELECT raw, lenient, strict, "
    f"{sql.case('lenient', dims.BOROUGH_NAMES, 'NULL')} AS name, count(*) AS n FROM (SELECT raw, "
    "CASE upper(trim(raw)) WHEN 'MANHATTAN' THEN 'MN' WHEN 'BROOKLYN' THEN 'BK' WHEN 'QUEENS' THEN 'QN' "
    "WHEN 'BRONX' THEN 'BX' WHEN 'STATEN ISLAND' THEN 'SI' ELSE 'MN' END AS lenient, "
    "CASE raw WHEN 'Manhattan' THEN 'MN' WHEN 'Brooklyn' THEN 'BK' WHEN 'Queens' THEN 'QN' WHEN 'Bronx' THEN 'BX' "
    f"WHEN 'Staten Island' THEN 'SI' END AS strict FROM (SELECT {_RAW_BOROUGH} AS raw FROM ev)) GROUP BY ALL"
))
def borough_clean(spark, sf_dir):
    """Both name policies over messy borough texts."""
    raw = feeds.events(spark, sf_dir).select(F.expr(_RAW_BOROUGH).alias("raw"))
    named = raw.select(
        "raw", labels.borough_lenient(F.col("raw")).alias("lenient"), labels.borough_strict(F.col("raw")).alias("strict")
    )
    return named.withColumn("name", lookup(F.col("lenient"), dims.BOROUGH_NAMES)) \
        .groupBy("raw", "lenient", "strict", "name").agg(F.count(F.lit(1)).alias("n"))


@registry.add(sql.query(
    "SELECT event_id, CASE WHEN floor(value) = 0 THEN 30e0 ELSE floor(value) END AS speed, "
    "CASE WHEN k = 0 THEN 20e0 ELSE CAST(k AS DOUBLE) END AS no2, floor(value) AS speed_null_only, "
    "CASE WHEN event_type = 'signup' THEN 'MN-01' ELSE 'BK-01' END AS zone_id FROM ev"
))
def falsy_defaults(spark, sf_dir):
    """Zero and empty count as missing; with `null_only` they do not."""
    value = F.floor("value").cast("double")
    zone = F.when(F.col("event_type") == "signup", "").otherwise("BK-01")
    return feeds.events(spark, sf_dir).select(
        "event_id", default_if_falsy(value, 30.0).alias("speed"),
        default_if_falsy(feeds.props_k().cast("double"), 20.0).alias("no2"),
        default_if_falsy(value, 30.0, null_only=True).alias("speed_null_only"),
        default_if_falsy(zone, "MN-01").alias("zone_id"),
    )


@registry.add(sql.query(
    "SELECT event_id, CASE WHEN k % 10 = 0 THEN NULL ELSE zone_id END AS zone_id, "
    "CASE WHEN k % 10 IN (0, 1) THEN NULL ELSE speed_kmh END AS speed_kmh, "
    "CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END AS malformed FROM traffic"
))
def json_parse(spark, sf_dir):
    """JSON messages, some cut off (kept as null rows), some with one unreadable field."""
    rows = feeds.events(spark, sf_dir).filter(F.col("event_type").isin(feeds.TRAFFIC_TYPES))
    k = F.pmod(feeds.props_k(), F.lit(10))
    good = F.to_json(F.struct(feeds.zone_at(F.col("user_id")).alias("zone_id"), F.col("value").alias("speed_kmh")))
    bad_field = F.to_json(F.struct(feeds.zone_at(F.col("user_id")).alias("zone_id"), F.lit("fast").alias("speed_kmh")))
    text = F.when(k == 0, F.substring(good, 1, 12)).when(k == 1, bad_field).otherwise(good)
    schema = T.StructType.fromDDL("zone_id string, speed_kmh double, timestamp string")
    raw = rows.select(F.struct("event_id", "event_time").alias("ingest"), text.alias("value"))
    parsed = streams.parse_json(
        raw.select("value", F.col("ingest.event_time").alias("ingest_ts"), F.col("ingest.event_id").alias("event_id")),
        schema, keep=["event_id"],
    )
    return parsed.select("event_id", "zone_id", "speed_kmh", F.col("_is_malformed").cast("int").alias("malformed"))


@registry.add(sql.query(
    "SELECT event_id, CASE WHEN k < 50 THEN strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') "
    "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_time FROM ev"
))
def event_time_fallback(spark, sf_dir):
    """The payload's own time, or the arrival time where it does not parse."""
    payload = F.when(
        feeds.props_k() < 50, F.date_format(F.col("event_time") - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss")
    ).otherwise("oops")
    time = F.coalesce(F.try_to_timestamp(payload), F.col("event_time"))
    return feeds.events(spark, sf_dir).select(
        "event_id", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("event_time")
    )


_CONDITION = (
    "CASE WHEN temperature > 30 THEN 'Hot' WHEN temperature < 5 THEN 'Cold' WHEN windspeed > 30 THEN 'Windy' "
    "WHEN humidity > 80 THEN 'Humid' ELSE 'Clear' END"
)


@registry.add(sql.query(
    f"SELECT day, {_CONDITION} AS condition, count(*) AS n, {sql.mean('temperature')} AS avg_temperature "
    "FROM weather GROUP BY ALL"
))
def weather_conditions(spark, sf_dir):
    condition = labels.weather_condition(F.col("temperature"), F.col("humidity"), F.col("windspeed"))
    return feeds.day_text(
        feeds.weather(feeds.events(spark, sf_dir)).groupBy(feeds.day(), condition.alias("condition"))
        .agg(F.count(F.lit(1)).alias("n"), exact_mean(F.col("temperature")).alias("avg_temperature"))
    )


@registry.add(sql.query(
    "SELECT day, temperature, humidity, windspeed FROM (SELECT *, row_number() OVER "
    "(PARTITION BY day ORDER BY ts DESC, event_id DESC) AS nth FROM weather) WHERE nth = 1"
))
def weather_latest(spark, sf_dir):
    """The last reading of each day; all buffers are numbers, so this stays in hash aggregation."""
    order = feeds.order()
    return feeds.day_text(feeds.weather(feeds.events(spark, sf_dir)).groupBy(feeds.day()).agg(
        *[F.max_by(c, order).alias(c) for c in ("temperature", "humidity", "windspeed")]
    ))


def _round_sql(expr: str, digits: int) -> str:
    """Exact rounding through text: enough digits to hold the double, then a decimal comparison."""
    return f"CAST(printf('%.{digits}f', {expr}) AS DOUBLE)"


@registry.add(sql.query(
    f"SELECT event_id, {_round_sql('value * 1.60934e0', 2)} AS speed_kmh, {_round_sql('value / 7e0', 1)} AS seventh, "
    f"{_round_sql('value / 2e0', 2)} AS half FROM ev"
))
def exact_rounding(spark, sf_dir):
    """Unit conversion and divisions rounded on the exact binary value."""
    value = F.col("value")
    raw = feeds.events(spark, sf_dir).select(
        "event_id", (value * F.lit(dims.MPH_TO_KMH)).alias("speed_kmh"), (value / F.lit(7.0)).alias("seventh"),
        (value / F.lit(2.0)).alias("half"),
    )
    return raw.withColumns({
        name: round_exact(F.col(name), digits) for name, digits in (("speed_kmh", 2), ("seventh", 1), ("half", 2))
    })


@registry.add(sql.query(
    "SELECT event_id, CASE WHEN k % 2 = 0 THEN value END AS strict, value AS tolerant FROM ev"
))
def point_list_latitude(spark, sf_dir):
    """The first latitude of a point list; without a space after the comma only the tolerant rule reads it."""
    number = F.col("value").cast("string")
    even = F.pmod(feeds.props_k(), F.lit(2)) == 0
    points = F.concat(number, F.when(even, ", -73.9 40.7, -73.8").otherwise(",-73.9 40.7,-73.8"))
    return feeds.events(spark, sf_dir).select(
        "event_id", files.first_latitude(points).alias("strict"),
        files.first_latitude(points, tolerant=True).alias("tolerant"),
    )


@registry.add(sql.query(
    "SELECT event_id, CASE k % 3 WHEN 0 THEN value WHEN 1 THEN CAST(k AS DOUBLE) END AS temperature, "
    "CASE WHEN k % 3 = 2 THEN '' ELSE 'at-' || CAST(k AS VARCHAR) END AS source_ts FROM ev"
))
def alias_columns(spark, sf_dir):
    """The first alias column that holds a readable value."""
    k = feeds.props_k()
    which = F.pmod(k, F.lit(3))
    return feeds.events(spark, sf_dir).select(
        "event_id",
        F.when(which == 0, F.concat(F.lit(" "), F.col("value").cast("string"))).otherwise("n/a").alias("temperature_2m"),
        F.when(which == 1, k.cast("string")).otherwise("").alias("temp"),
        F.when(which == 2, "").otherwise(F.concat(F.lit("at-"), k.cast("string"))).alias("time"),
    ).select(
        "event_id", first_number([F.col("temperature_2m"), F.col("temp")]).alias("temperature"),
        first_text([F.col("time")]).alias("source_ts"),
    )


@registry.add(sql.query(
    "SELECT event_id, station_id, "
    "coalesce(last_value(CASE WHEN event_type = 'error' THEN pm25 END IGNORE NULLS) OVER w, 0e0) AS pm25, "
    "coalesce(last_value(CASE WHEN event_type = 'purchase' THEN pm25 END IGNORE NULLS) OVER w, 0e0) AS no2 "
    "FROM pollution WINDOW w AS (PARTITION BY station_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
))
def station_fill(spark, sf_dir):
    """Per reading the last PM2.5 and NO2 of its station; errors stand for PM2.5, purchases for NO2."""
    parameter = F.when(F.col("event_type") == "error", "pm25").otherwise("no2")
    readings = feeds.events(spark, sf_dir).filter(F.col("event_type").isin(feeds.POLLUTION_TYPES)).select(
        "event_id", F.concat(F.lit("ST-"), F.col("user_id").cast("string")).alias("station_id"),
        parameter.alias("parameter"), "value", "event_time",
    )
    return files.filled_stations(readings, feeds.order()) \
        .select("event_id", "station_id", "pm25", "no2")


def _histories(spark, sf_dir):
    rows = feeds.pollution(feeds.events(spark, sf_dir)).select("event_id", "zone_id", "aqi", "event_time")
    return forecast.with_history(rows, feeds.order())


_HISTORY = (
    "SELECT event_id, zone_id, count(*) OVER w AS n, first_value(aqi) OVER w AS oldest, "
    "CAST(sum(CAST(aqi * 1e6 AS BIGINT)) OVER w AS BIGINT) AS units "
    "FROM pollution WINDOW w AS (PARTITION BY zone_id ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
)


@registry.add(sql.query(_HISTORY))
def aqi_history(spark, sf_dir):
    """The last 12 readings of the zone at every reading: how many, the oldest, and their sum in millionths."""
    rows = _histories(spark, sf_dir)
    total = F.aggregate("history", F.lit(0).cast("bigint"), lambda acc, x: acc + fixed_point(x, 6))
    return rows.select(
        "event_id", "zone_id", F.size("history").cast("bigint").alias("n"), F.get("history", F.lit(0)).alias("oldest"),
        total.alias("units"),
    )


#: Normal equations of the three lags (a symmetric matrix, m) and their solution: with three rows or more by the inverse,
#: with two or one by the smallest weights that fit.
_FORECAST = """
h AS (SELECT event_id, zone_id, aqi, list(aqi) OVER w AS h FROM pollution
  WINDOW w AS (PARTITION BY zone_id ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
x AS (SELECT *, len(h) AS n, h[1:len(h) - 3] AS x, h[2:len(h) - 2] AS y, h[3:len(h) - 1] AS z, h[4:] AS t FROM h WHERE len(h) > 3),
m AS (SELECT event_id, n, h[n - 2] AS p, h[n - 1] AS q, h[n] AS r, list_inner_product(x, x) AS xx, list_inner_product(x, y) AS xy,
    list_inner_product(x, z) AS xz, list_inner_product(y, y) AS yy, list_inner_product(y, z) AS yz, list_inner_product(z, z) AS zz,
    list_inner_product(x, t) AS xt, list_inner_product(y, t) AS yt, list_inner_product(z, t) AS zt FROM x),
c AS (SELECT *, yy * zz - yz * yz AS cxx, xz * yz - xy * zz AS cxy, xy * yz - xz * yy AS cxz, xx * zz - xz * xz AS cyy,
    xy * xz - xx * yz AS cyz, xx * yy - xy * xy AS czz, xx + yy + zz AS trace FROM m),
f AS (SELECT event_id, CASE
    WHEN n > 5 THEN (p * (cxx * xt + cxy * yt + cxz * zt) + q * (cxy * xt + cyy * yt + cyz * zt) + r * (cxz * xt + cyz * yt + czz * zt))
      / (xx * cxx + xy * cxy + xz * cxz)
    WHEN n = 5 THEN (p * (trace * xt - xx * xt - xy * yt - xz * zt) + q * (trace * yt - xy * xt - yy * yt - yz * zt)
      + r * (trace * zt - xz * xt - yz * yt - zz * zt)) / (cxx + cyy + czz)
    ELSE (p * xt + q * yt + r * zt) / trace END AS step FROM c)"""


@registry.add(sql.query(
    "SELECT h.event_id, zone_id, aqi, round(CASE WHEN step IS NULL THEN aqi ELSE greatest(0e0, least(500e0, step)) END, 1) AS forecast_aqi FROM h LEFT JOIN f USING (event_id)",
    _FORECAST,
))
def aqi_forecast(spark, sf_dir):
    """AR(3) forecast at every reading, to a decimal."""
    rows = _histories(spark, sf_dir)
    return rows.select("event_id", "zone_id", "aqi", F.round(forecast.forecast_aqi(F.col("history")), 1).alias("forecast_aqi"))
