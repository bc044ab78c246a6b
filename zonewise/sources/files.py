"""Files: traffic, pollution and weather CSV, landed JSON documents, label metadata."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise import dims, schemas
from zonewise.functions.air import aqi_combined, aqi_pm25_only
from zonewise.functions.geo import nearest_zone, nth_zone_of, segment_location
from zonewise.functions.labels import borough_lenient, borough_strict, weather_condition
from zonewise.functions.numeric import (
    clamp, default_if_falsy, first_number, first_text, lookup, not_nan, number, round_exact,
)
from zonewise.operators.ordered import forward_fill, latest_rows

CITY_LAT, CITY_LON = 40.7128, -74.006

# Column aliases of weather files and the state / parameters of monitor summaries.
TEMPERATURE_NAMES = ["temperature_2m", "temperature_2m (°C)", "temperature", "temp"]
HUMIDITY_NAMES = ["relativehumidity_2m", "relativehumidity_2m (%)", "humidity", "relative_humidity"]
WIND_NAMES = ["windspeed_10m", "windspeed_10m (km/h)", "windspeed", "wind_speed"]
TIME_NAMES = ["time", "date", "datetime", "timestamp"]
SUMMARY_STATE = "36"
SUMMARY_PARAMETERS = {"PM2.5 - Local Conditions": "pm25", "Nitrogen dioxide (NO2)": "no2"}
EXTRACT_COLUMNS = {
    "speed": "SPEED", "link_id": "LINK_ID", "data_as_of": "DATA_AS_OF", "borough": "BOROUGH",
    "link_points": "LINK_POINTS", "travel_time": "TRAVEL_TIME", "status": "STATUS",
}


def _text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text under their header names; only headers are read to plan it."""
    return spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE") \
        .option("ignoreLeadingWhiteSpace", True).csv(path)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


# --- traffic ----------------------------------------------------------------------------------------

def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """Traffic CSV as text under trimmed, upper-cased column names."""
    raw = _text_csv(spark, path)
    named = raw.toDF(*[c.strip().upper() for c in raw.columns])
    present = [c for c in schemas.TRAFFIC_CSV_COLUMNS if c in named.columns]
    return named.select(*present)


def first_latitude(points: Column, tolerant: bool = False) -> Column:
    """Latitude from the first token of a point list. Strict: the token without its trailing comma must be
    a number, so "lat,lon" without a space is null. Tolerant: the first number in the text."""
    if tolerant:
        return F.nullif(F.regexp_extract(points, r"[-+]?\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")
    return F.regexp_replace(F.get(F.split(F.trim(points), r"\s+"), F.lit(0)), ",+$", "").try_cast("double")


def traffic_segments(traffic: DataFrame, tolerant: bool = False) -> DataFrame:
    """Rows for the feature matrix: positive speed that is a number, known borough, readable latitude."""
    return traffic.select(
        borough_strict(F.col("BOROUGH")).alias("borough_id"), F.col("BOROUGH").alias("borough"),
        first_latitude(F.col("LINK_POINTS"), tolerant).alias("lat"), not_nan(number(F.col("SPEED"))).alias("speed"),
    ).filter((F.col("speed") > 0) & F.col("borough_id").isNotNull() & F.col("lat").isNotNull())


def traffic_messages(traffic: DataFrame, position: Column, now: Column | None = None) -> DataFrame:
    """Cleaned stream messages, keyed by segment. `position` is the row's place in file order (see
    `row_positions`); it picks the zone of the borough in turn. A blank speed is 30; text is dropped."""
    text = F.nullif(F.trim("SPEED"), F.lit(""))
    speed = F.when(text.isNull(), F.lit(30.0)).otherwise(text.try_cast("double"))
    borough = borough_lenient(F.coalesce(F.nullif(F.col("BOROUGH"), F.lit("")), F.lit("MANHATTAN")))
    segment = F.coalesce(
        F.nullif(F.col("LINK_ID"), F.lit("")),
        F.concat(F.lit("SEG-"), F.lpad(position.cast("string"), 6, "0")),
    )
    lat, lon = segment_location(borough, F.coalesce(F.col("LINK_ID"), position.cast("string")))
    return traffic.select(
        segment.alias("segment_id"),
        round_exact(speed * F.lit(dims.MPH_TO_KMH), 2).alias("speed_kmh"),
        round_exact(speed, 2).alias("speed_mph"),
        lookup(borough, dims.BOROUGH_NAMES).alias("borough"),
        nth_zone_of(borough, position).alias("zone_id"),
        _iso(now).alias("timestamp"),
        round_exact(lat, 6).alias("lat"), round_exact(lon, 6).alias("lon"),
    ).filter(F.col("speed_kmh").isNotNull())


def latest_traffic_extract(rows: DataFrame, n: int = 50_000) -> DataFrame:
    """The most recent n rows of an open-data extract, under the CSV's column names; of rows of one moment those that come
    first by their other columns."""
    others = [c for c in EXTRACT_COLUMNS if c != "data_as_of"]
    found = latest_rows(rows, F.unix_micros(F.col("data_as_of").try_cast("timestamp")), [F.col("data_as_of").desc(), *map(F.col, others)], n)
    return found.withColumnsRenamed(EXTRACT_COLUMNS).select(*EXTRACT_COLUMNS.values())


# --- pollution --------------------------------------------------------------------------------------

def read_pollution(spark: SparkSession, path: str) -> DataFrame:
    """Pollution CSV. Bytes that are not UTF-8 become replacement characters, unreadable numbers null."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("encoding", "UTF-8") \
        .schema(schemas.POLLUTION_CSV).csv(path)


def pm25_readings(pollution: DataFrame) -> DataFrame:
    return pollution.filter((not_nan(F.col("value")) > 0) & (F.col("parameter") == "pm25"))


def filled_stations(
    readings: DataFrame, order: Column, station: str = "station_id"
) -> DataFrame:
    """Per reading the last PM2.5 and NO2 its station has sent so far, 0 before the first, never negative.

    Rows of other parameters are dropped.
    """
    parameter = F.lower(F.trim("parameter"))
    is_pm25 = parameter.contains("pm25")
    is_no2 = ~is_pm25 & parameter.contains("no2")
    filled = forward_fill(readings.filter(is_pm25 | is_no2), [station], order, {
        "pm25": F.when(is_pm25, clamp(F.col("value"), 0)), "no2": F.when(is_no2, clamp(F.col("value"), 0)),
    })
    return filled.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("pm25", "no2")})


def pollution_messages(
    pollution: DataFrame, position: Column, now: Column | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Cleaned stream messages, one per PM2.5 or NO2 reading, keyed by station."""
    named = F.trim(F.coalesce(
        F.nullif(F.col("location"), F.lit("")),
        F.concat(F.lit("NYC-"), F.lpad(F.pmod(position, F.lit(30)).cast("string"), 3, "0")),
    ))
    readings = pollution.select(
        named.alias("station_id"), "parameter", F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce("latitude", F.lit(CITY_LAT)).alias("lat"), F.coalesce("longitude", F.lit(CITY_LON)).alias("lon"),
        position.alias("_position"), *(keep or []),
    )
    filled = filled_stations(readings, F.col("_position"))
    return filled.select(
        "station_id", nearest_zone(F.col("lat"), F.col("lon")).alias("zone_id"),
        round_exact(F.col("pm25"), 2).alias("pm25"), round_exact(F.col("no2"), 2).alias("no2"),
        round_exact(aqi_combined(F.col("pm25"), F.col("no2")), 1).alias("aqi"), _iso(now).alias("timestamp"),
        round_exact(F.col("lat"), 6).alias("lat"), round_exact(F.col("lon"), 6).alias("lon"),
        F.lit("csv_replay").alias("source"), *(keep or []),
    )


def read_sensor_locations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Documents as the API returns them, one per file; without `multi_line` one per line."""
    return spark.read.schema(schemas.SENSOR_LOCATIONS).option("multiLine", multi_line).json(path)


def station_messages(documents: DataFrame, now: Column | None = None) -> DataFrame:
    """One message per station of a sensor-location document, keyed by zone.

    The last non-null value of a parameter counts. Null or zero readings get 8.0 and 15.0, and stations
    without a latitude are dropped. Sensors are picked inside the row's array, so nothing is shuffled.
    """
    station = documents.select(F.explode("results").alias("r")).select(
        F.coalesce(F.col("r.id").cast("string"), F.lit("")).alias("id"),
        F.coalesce("r.coordinates.latitude", F.lit(0.0)).alias("lat"),
        F.coalesce("r.coordinates.longitude", F.lit(0.0)).alias("lon"),
        F.coalesce("r.sensors", F.array().cast(schemas.SENSOR_LOCATIONS["results"].dataType.elementType["sensors"].dataType))
        .alias("sensors"),
    ).filter(F.col("lat") != 0)

    def last_value(parameter: str) -> Column:
        matching = F.filter("sensors", lambda s: (F.lower(s["parameter"]["name"]) == parameter)
                            & s["latest"]["value"].isNotNull())
        return F.try_element_at(matching, F.lit(-1))["latest"]["value"]

    filled = station.select(
        "id", "lat", "lon", default_if_falsy(last_value("pm25"), 8.0).alias("pm25"),
        default_if_falsy(last_value("no2"), 15.0).alias("no2"),
    )
    return filled.select(
        F.concat(F.lit("OAQ-"), "id").alias("station_id"), nearest_zone(F.col("lat"), F.col("lon")).alias("zone_id"),
        round_exact(F.col("pm25"), 2).alias("pm25"), round_exact(F.col("no2"), 2).alias("no2"),
        round_exact(aqi_pm25_only(F.col("pm25")), 1).alias("aqi"), _iso(now).alias("timestamp"), "lat", "lon",
        F.lit("openaq_live").alias("source"),
    )


def read_measurement_pages(spark: SparkSession, path: str, parameter: str, multi_line: bool = True) -> DataFrame:
    """Paged measurement documents of one parameter as pollution rows."""
    pages = spark.read.schema(schemas.MEASUREMENT_PAGE).option("multiLine", multi_line).json(path)
    return pages.select(F.explode("results").alias("r")).select(
        F.coalesce("r.location.name", F.lit("")).alias("location"), F.lit(parameter).alias("parameter"),
        F.col("r.value").alias("value"), F.coalesce("r.parameter.units", F.lit("µg/m³")).alias("unit"),
        first_text([F.col("r.period.datetimeFrom.utc"), F.col("r.date.utc")]).alias("date_utc"),
        F.coalesce("r.location.coordinates.latitude", F.lit(CITY_LAT)).alias("latitude"),
        F.coalesce("r.location.coordinates.longitude", F.lit(CITY_LON)).alias("longitude"),
    )


def read_pollution_pages(spark: SparkSession, paths: dict[str, str], multi_line: bool = True) -> DataFrame:
    """The pages of all parameters in one frame."""
    frames = [read_measurement_pages(spark, path, parameter, multi_line) for parameter, path in paths.items()]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def read_monitor_summary(spark: SparkSession, path: str, day: str = "2023-06-15") -> DataFrame:
    """Annual monitor means of one state, each spread over the 24 hours of a day; a blank mean is 10."""
    raw = _text_csv(spark, path)
    parameter = lookup(_quoted("Parameter Name"), SUMMARY_PARAMETERS)
    site = F.coalesce(F.nullif(_quoted("Local Site Name"), F.lit("")), _quoted("Site Num"), F.lit("NYC-EPA"))
    mean = F.coalesce(number(_quoted("Arithmetic Mean")), F.lit(10.0))
    return raw.filter((_quoted("State Code") == SUMMARY_STATE) & parameter.isNotNull()).select(
        site.alias("location"), parameter.alias("parameter"), clamp(mean, 0).alias("value"),
        F.lit("µg/m³").alias("unit"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"),
        F.coalesce(number(_quoted("Latitude")), F.lit(CITY_LAT)).alias("latitude"),
        F.coalesce(number(_quoted("Longitude")), F.lit(CITY_LON)).alias("longitude"),
    ).select(
        "location", "parameter", "value", "unit",
        F.format_string(f"{day}T%02d:00:00Z", "h").alias("date_utc"), "latitude", "longitude",
    )


# --- weather ----------------------------------------------------------------------------------------

def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather CSV files with metadata lines above the header: (temperature, humidity, windspeed, source_ts).

    Every file may name and order its columns differently. Its header is the first line that mentions time
    or temperature, else its first line. A line's place is the start of its file split and its number
    there, so large files still split over many tasks.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"),
    ).withColumn("at", _line_place(F.col("block"), F.col("id"))).drop("block", "id")
    low = F.lower("line")
    mentions = low.contains("time") | low.contains("temperature")
    places = lines.groupBy("file").agg(
        F.coalesce(F.min(F.when(mentions, F.col("at"))), F.min("at")).alias("header_at")
    )
    headers = lines.join(places, "file").filter(F.col("at") == F.col("header_at")) \
        .select("file", "header_at", F.col("line").alias("header"))
    body = lines.join(headers, "file").filter((F.col("at") > F.col("header_at")) & (F.trim("line") != ""))
    names = F.transform(F.split("header", ","), lambda n: F.trim(n))
    cells = F.transform(F.split("line", ","), lambda c: F.trim(c))

    def cell(name: str) -> Column:
        return F.get("cells", F.array_position("names", name).cast("int") - F.lit(1))

    return body.select(names.alias("names"), cells.alias("cells")).select(
        first_number([cell(n) for n in TEMPERATURE_NAMES]).alias("temperature"),
        first_number([cell(n) for n in HUMIDITY_NAMES]).alias("humidity"),
        first_number([cell(n) for n in WIND_NAMES]).alias("windspeed"),
        first_text([cell(n) for n in TIME_NAMES]).alias("source_ts"),
    )


def _line_place(block: Column, line_id: Column) -> Column:
    within = line_id.bitwiseAND(F.lit(2 ** 33 - 1))  # the generated id counts rows in its lower 33 bits
    return (block.cast("decimal(20,0)") * F.lit(Decimal(10 ** 10)) + within.cast("decimal(10,0)")).cast("decimal(38,0)")


def read_hourly_weather(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Hourly weather documents with parallel arrays, one row per hour, in the columns of the CSV."""
    documents = spark.read.schema(schemas.HOURLY_WEATHER).option("multiLine", multi_line).json(path)
    hour = F.arrays_zip(*[f"hourly.{c}" for c in ("time", "temperature_2m", "relativehumidity_2m", "windspeed_10m")])
    return documents.select(F.explode(hour).alias("h")).select("h.*")


def weather_messages(weather: DataFrame, now: Column | None = None) -> DataFrame:
    """Cleaned stream messages; rows without a temperature are dropped."""
    measures = [F.col(c) for c in ("temperature", "humidity", "windspeed")]
    return weather.filter(F.col("temperature").isNotNull()).select(
        *[round_exact(c, 1).alias(n) for c, n in zip(measures, ("temperature", "humidity", "windspeed"))],
        weather_condition(*measures).alias("condition"), _iso(now).alias("timestamp"), "source_ts",
        F.lit(CITY_LAT).alias("lat"), F.lit(CITY_LON).alias("lon"),
    )


# --- labels -----------------------------------------------------------------------------------------

def read_zone_labels(spark: SparkSession, path: str) -> DataFrame:
    """(zone_id, cluster) from a label metadata document; no rows if there is no file."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "zone_id string, cluster string")
    metadata = spark.read.schema(schemas.LABEL_METADATA).option("multiLine", True).json(path)
    return metadata.select(F.explode("zone_labels").alias("zone_id", "cluster"))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    return [entry.getPath().getName() for entry in entries]


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _iso(now: Column | None) -> Column:
    return F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
