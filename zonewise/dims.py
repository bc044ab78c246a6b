"""City dimensions and thresholds.

Everything here is a small constant. Code that works on zones takes the zone list as an argument with
these values as the default, so another city only needs another set of dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------------------------------

BOROUGH_NAMES = {
    "MN": "Manhattan",
    "BK": "Brooklyn",
    "QN": "Queens",
    "BX": "Bronx",
    "SI": "Staten Island",
}

ZONES_PER_BOROUGH = 6

# lat_lo, lat_hi, lon_lo, lon_hi
BOROUGH_BOUNDS = {
    "MN": (40.70, 40.88, -74.02, -73.91),
    "BK": (40.57, 40.74, -74.04, -73.84),
    "QN": (40.54, 40.80, -73.97, -73.70),
    "BX": (40.80, 40.92, -73.94, -73.74),
    "SI": (40.48, 40.65, -74.26, -74.03),
}

BOROUGH_CENTROIDS = {
    "MN": (40.7831, -73.9712),
    "BK": (40.6782, -73.9442),
    "QN": (40.7282, -73.7949),
    "BX": (40.8448, -73.8648),
    "SI": (40.5795, -74.1502),
}

BOROUGH_DENSITY = {"MN": 1.0, "BK": 0.75, "QN": 0.60, "BX": 0.55, "SI": 0.30}
DEFAULT_DENSITY = 0.5

# mph, used when a borough has no traffic rows at all
BOROUGH_DEFAULT_SPEED = {"MN": 22.0, "BK": 30.0, "QN": 35.0, "BX": 28.0, "SI": 40.0}

# the borough whose first two zones count as neighbours
ADJACENT_BOROUGH = {"MN": "BK", "BK": "MN", "QN": "MN", "BX": "MN", "SI": "BK"}

# conc_lo, conc_hi, index_lo, index_hi
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]
NO2_BREAKPOINTS = [
    (0, 53, 0, 50),
    (54, 100, 51, 100),
    (101, 360, 101, 150),
    (361, 649, 151, 200),
    (650, 1249, 201, 300),
    (1250, 1649, 301, 400),
    (1650, 2049, 401, 500),
]

# worst to best
CLUSTER_NAMES = ["Permanently Hazardous", "Peak Hour Hazardous", "Weather Sensitive", "Safe Corridor"]
CLUSTER_WEIGHTS = {
    "Permanently Hazardous": 0.1,
    "Peak Hour Hazardous": 0.5,
    "Weather Sensitive": 0.7,
    "Safe Corridor": 1.0,
}

EVENT_CLASSES = ["NORMAL", "CONGESTION_EVENT", "POLLUTION_ALERT", "COMPOUND_EVENT"]
EXPOSURE_STATUSES = ["SAFE", "WARNING", "CRITICAL"]

FEATURE_COLUMNS = ["avg_speed", "std_speed", "pct_slow", "avg_pm25", "std_pm25", "avg_aqi_proxy", "density"]

# initial feature ranges of the online model: speed, aqi, pm25, density
ONLINE_RANGES = [(0.0, 80.0), (0.0, 200.0), (0.0, 60.0), (0.0, 1.0)]

BASELINE_SPEED = 40.0
MPH_TO_KMH = 1.60934

# --- Derived from the fixed values ------------------------------------------------------------------

BOROUGHS = list(BOROUGH_NAMES)
ZONES = [f"{prefix}-{i:02d}" for prefix in BOROUGHS for i in range(1, ZONES_PER_BOROUGH + 1)]


@dataclass(frozen=True)
class ExposureProfile:
    """Limits that turn air-quality readings into an exposure status."""

    high_aqi: float
    warn_hours: float = 1.5
    critical_hours: float = 3.0
    minutes_per_reading: float = 1.0
    daily_limit_hours: float = 8.0


# the continuous per-reading profile and the profile of the 30-second recommendation cycle (x5 speed-up)
PER_READING = ExposureProfile(high_aqi=100.0)
PER_CYCLE = ExposureProfile(high_aqi=40.0, minutes_per_reading=2.5)


def zone_centroids(decimals: int = 5) -> list[tuple[str, float, float]]:
    """(zone_id, lat, lon) of every zone: cell midpoints of a 3-row, 2-column grid per borough box."""
    cells = []
    for zone in ZONES:
        lat_lo, lat_hi, lon_lo, lon_hi = BOROUGH_BOUNDS[zone[:2]]
        row, column = divmod(int(zone[3:]) - 1, 2)
        cells.append((
            zone,
            round(lat_lo + (row + 0.5) * (lat_hi - lat_lo) / 3, decimals),
            round(lon_lo + (column + 0.5) * (lon_hi - lon_lo) / 2, decimals),
        ))
    return cells


def zones_frame(spark: SparkSession) -> DataFrame:
    """The zone dimension, one row per zone; `zone_ord` is the tie-break order used everywhere."""
    schema = T.StructType([
        T.StructField("zone_id", T.StringType(), False),
        T.StructField("zone_ord", T.IntegerType(), False),
        T.StructField("borough_id", T.StringType(), False),
        T.StructField("borough", T.StringType(), False),
        T.StructField("density", T.DoubleType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
    ])
    rows = [
        (zone, i, zone[:2], BOROUGH_NAMES[zone[:2]], BOROUGH_DENSITY[zone[:2]], lat, lon)
        for i, (zone, lat, lon) in enumerate(zone_centroids())
    ]
    return spark.createDataFrame(rows, schema)


def names_frame(spark: SparkSession, column: str, names: list[str]) -> DataFrame:
    """A one-column dimension with its position, used to zero-fill counts."""
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"{column} string, {column}_ord int")
