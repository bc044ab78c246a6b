"""Explicit schemas of the stream messages, files and stored tables. Nothing is inferred."""

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def struct(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns."""
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


# stream messages
TRAFFIC = struct(segment_id=_S, speed_kmh=_D, borough=_S, zone_id=_S, timestamp=_S, lat=_D, lon=_D)
POLLUTION = struct(station_id=_S, zone_id=_S, pm25=_D, no2=_D, aqi=_D, timestamp=_S, lat=_D, lon=_D)
WEATHER = struct(temperature=_D, humidity=_D, windspeed=_D, condition=_S, timestamp=_S)
WORKER = struct(worker_id=_S, zone_id=_S, borough=_S, timestamp=_S, mobility_type=_S)
TOPICS = {
    "traffic_stream": TRAFFIC,
    "pollution_stream": POLLUTION,
    "weather_stream": WEATHER,
    "worker_stream": WORKER,
}

# CSV files
TRAFFIC_CSV_COLUMNS = ["SPEED", "LINK_ID", "DATA_AS_OF", "BOROUGH", "LINK_POINTS", "TRAVEL_TIME", "STATUS"]
POLLUTION_CSV = struct(location=_S, parameter=_S, value=_D, unit=_S, date_utc=_S, latitude=_D, longitude=_D)

# nested JSON documents
_COORDINATES = struct(latitude=_D, longitude=_D)
SENSOR_LOCATIONS = struct(results=T.ArrayType(struct(
    id=_L,
    coordinates=_COORDINATES,
    sensors=T.ArrayType(struct(parameter=struct(name=_S), latest=struct(value=_D))),
)))
MEASUREMENT_PAGE = struct(results=T.ArrayType(struct(
    location=struct(name=_S, coordinates=_COORDINATES),
    value=_D,
    parameter=struct(units=_S),
    period=struct(datetimeFrom=struct(utc=_S)),
    date=struct(utc=_S),
)))
HOURLY_WEATHER = struct(hourly=struct(
    time=T.ArrayType(_S),
    temperature_2m=T.ArrayType(_D),
    relativehumidity_2m=T.ArrayType(_D),
    windspeed_10m=T.ArrayType(_D),
))
LABEL_METADATA = struct(
    zone_labels=T.MapType(_S, _S),
    cluster_name_map=T.MapType(_S, _S),
    feature_cols=T.ArrayType(_S),
    silhouette_score=_D,
    n_clusters=_I,
    inertia=_D,
)

# stored tables
EVENTS = T.StructType([
    T.StructField("event_id", _L),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", _L),
    T.StructField("event_type", _S),
    T.StructField("value", _D),
    T.StructField("props", _S),
])

# results and state of the streaming queries
ZONE_SCORE = struct(zone_id=_S, avg_speed=_D, avg_aqi=_D, avg_pm25=_D, zone_score=_D, event_type=_S, borough=_S)
ZONE_LABEL = struct(zone_id=_S, cluster=_S)
KEPT_LABEL = struct(zone_id=_S, cluster=_S, updated_at=T.TimestampType())
EXPOSURE_PART = struct(
    worker_id=_S, count=_L, n_high=_L, aqi_units=_L, zone_id=_S, last_order=T.DecimalType(38, 0)
)
CYCLE_PART = struct(
    worker_id=_S, count=_L, n_high=_L, aqi_units=_L, zone_id=_S, last_order=T.DecimalType(38, 0), seen_at=T.TimestampType()
)
MODEL_STATE = struct(
    n_batches=_I, idx=_I, k=_I, centroid=T.ArrayType(_D), count=_L, lows=T.ArrayType(_D), highs=T.ArrayType(_D), inertia=_D
)
WORKER_ZONE = struct(worker_id=_S, zone_id=_S)
ZONE_SERIES = struct(zone_id=_S, series=T.ArrayType(struct(cycle=_L, aqi=_D)))
ZONE_RANKING = struct(position=_I, zone_id=_S, cluster=_S, final_score=_D)
RECOMMENDATION = struct(
    worker_id=_S, zone_id=_S, current_zone=_S, rec_zone=_S, rec_label=_S, rec_score=_D, status=_S, exposure_status=_S,
    reason=_S, hours_in_high_aqi=_D, daily_avg_aqi=_D, who_pct=_D,
)
STATUS_COUNT = struct(exposure_status=_S, n=_L)
PROGRESS = struct(
    name=_S, batch=_L, ts=_S, input_rows=_L, rows_per_sec=_D, duration_ms=_L, late_rows=_L
)
