"""Column functions against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions import air, geo, labels
from zonewise.functions import numeric as num


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def apply(spark, values, function, kind="double"):
    rows = column(spark, values, kind).select("i", function(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def test_zones_cover_all_boroughs():
    assert len(dims.ZONES) == 30
    assert {z[:2] for z in dims.ZONES} == set(dims.BOROUGH_NAMES)
    for _, lat, lon in dims.zone_centroids():
        assert 40.4 < lat < 41.0 and -74.3 < lon < -73.6


def nearest(lat, lon):
    return min(dims.zone_centroids(), key=lambda z: (lat - z[1]) ** 2 + (lon - z[2]) ** 2)[0]


def test_nearest_zone_and_box(spark):
    rng = random.Random(1)
    points = [(40.754, -73.990), (40.579, -74.151)]
    points += [(rng.uniform(40.4, 41.0), rng.uniform(-74.3, -73.6)) for _ in range(500)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    rows = frame.select("i", geo.nearest_zone(lat, lon).alias("z"), geo.bounding_box_zone(lat, lon, F.col("i")).alias("b"))
    for r in rows.collect():
        assert r["z"] == nearest(*points[r["i"]])
        inside = [b for b, (a, z, c, d) in dims.BOROUGH_BOUNDS.items()
                  if a <= points[r["i"]][0] <= z and c <= points[r["i"]][1] <= d]
        assert r["b"] == f"{inside[0] if inside else 'MN'}-{r['i'] % 6 + 1:02d}"


def test_zone_expressions(spark):
    frame = spark.createDataFrame([(z,) for z in [*dims.ZONES, "XX-01", "MN-07", "MN-1", None]], "z string")
    lat, lon = geo.grid_midpoint(F.col("z"))
    rows = {r["z"]: r for r in frame.select(
        "z", geo.zone_ordinal(F.col("z")).alias("o"), lat.alias("lat"), lon.alias("lon"),
        geo.neighbours(F.col("z")).alias("n"), geo.density(F.col("z")).alias("d"),
    ).collect()}
    for i, (zone, lat, lon) in enumerate(dims.zone_centroids()):
        assert rows[zone]["o"] == i
        assert rows[zone]["lat"] == pytest.approx(lat, abs=1e-5) and rows[zone]["lon"] == pytest.approx(lon, abs=1e-5)
        same = [z for z in dims.ZONES if z[:2] == zone[:2] and z != zone]
        assert rows[zone]["n"] == same + [f"{dims.ADJACENT_BOROUGH[zone[:2]]}-{j:02d}" for j in (1, 2)]
    assert all(rows[z]["o"] is None for z in ("XX-01", "MN-07", "MN-1", None))
    assert rows["XX-01"]["d"] == 0.5


def index(conc, table):
    for lo, hi, ilo, ihi in table:
        if lo <= conc <= hi:
            return (ihi - ilo) / (hi - lo) * (conc - lo) + ilo
    return 500.0


def test_air_quality_index(spark):
    values = [0.0, 6.0, 12.0, 12.05, 12.1, 35.4, 35.45, 100.0, 500.4, 501.0, -1.0, 53.5, 54.0]
    assert apply(spark, values, lambda c: air.aqi_from_breakpoints(c, dims.PM25_BREAKPOINTS)) == \
        [index(v, dims.PM25_BREAKPOINTS) for v in values]
    assert apply(spark, values, lambda c: air.aqi_combined(F.lit(0.0), c)) == \
        [index(v, dims.NO2_BREAKPOINTS) for v in values]
    only = apply(spark, values, air.aqi_pm25_only)
    assert only[3] == 12.05 * 2.1 and only[9] == 500.0
    closed = apply(spark, values, lambda c: air.aqi_from_breakpoints(c, dims.PM25_BREAKPOINTS, truncate_digits=1))
    assert closed[3] == 50.0
    assert apply(spark, [None], air.aqi_pm25_only) == [None]


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 6])
def test_rounding_is_that_of_the_binary_value(spark, digits):
    rng = random.Random(digits)
    values = [2.675, 0.125, 0.375, 2.5, 3.5, -2.675, -0.5, 1.005, 1e9 + 0.05, 0.0, 99.99999999]
    values += [rng.randint(-10 ** 6, 10 ** 6) / 8 / 10 ** digits for _ in range(300)]
    values += [round(rng.uniform(0, 500), digits + 1) for _ in range(2000)]
    assert apply(spark, values, lambda c: num.round_exact(c, digits)) == [round(v, digits) for v in values]


def test_defaults_and_casts(spark):
    assert apply(spark, [None, 0.0, 7.0], lambda c: num.default_if_falsy(c, 30.0)) == [30.0, 30.0, 7.0]
    assert apply(spark, [None, 0.0], lambda c: num.default_if_falsy(c, 30.0, null_only=True)) == [30.0, 0.0]
    assert apply(spark, [None, "", "BK"], lambda c: num.default_if_falsy(c, "MN"), "string") == ["MN", "MN", "BK"]
    assert apply(spark, [" 1.5 ", "x", "", None], num.number, "string") == [1.5, None, None, None]


def test_exact_aggregates(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(0, 500), 2) for _ in range(1000)]
    frame = column(spark, values).select(
        (F.col("i") % 2).alias("g"), "x"
    ).groupBy("g").agg(num.exact_mean(F.col("x")).alias("m"), num.exact_stddev_pop(F.col("x")).alias("p"),
                       num.exact_stddev_samp(F.col("x")).alias("s"))
    for r in frame.collect():
        part = values[r["g"]::2]
        mean = math.fsum(part) / len(part)
        var = math.fsum((v - mean) ** 2 for v in part)
        assert r["m"] == pytest.approx(mean, rel=1e-14)
        assert r["p"] == pytest.approx(math.sqrt(var / len(part)), rel=1e-12)
        assert r["s"] == pytest.approx(math.sqrt(var / (len(part) - 1)), rel=1e-12)
    one = column(spark, [3.1]).agg(num.exact_stddev_pop(F.col("x")), num.exact_stddev_samp(F.col("x"))).first()
    assert one[0] == 0.0 and one[1] is None


@pytest.mark.parametrize("speed, aqi", [(0.0, 0.0), (40.0, 0.0), (80.0, 200.0), (10.0, 150.0)])
def test_zone_score_range(spark, speed, aqi):
    for inverted in (False, True):
        score = spark.range(1).select(labels.zone_score(F.lit(speed), F.lit(aqi), inverted)).first()[0]
        assert 0.0 <= score <= 1.0


def test_classes(spark):
    rows = spark.createDataFrame(
        [(33.9, 39.0), (33.9, 38.0), (34.0, 38.1), (34.0, 38.0)], "speed double, aqi double"
    ).select(labels.event_class(F.col("speed"), F.col("aqi")).alias("c")).collect()
    assert [r["c"] for r in rows] == ["COMPOUND_EVENT", "CONGESTION_EVENT", "POLLUTION_ALERT", "NORMAL"]
    assert apply(spark, [1.5, 1.51, 3.0, 3.01], lambda c: labels.exposure_status(c, dims.PER_READING)) == \
        ["SAFE", "WARNING", "WARNING", "CRITICAL"]
    phases = spark.createDataFrame(
        [(3, 1.0), (4, 1.0), (11, 0.0), (11, float("inf")), (4, None)], "n int, inertia double"
    ).select(labels.model_phase(F.col("n"), F.col("inertia")).alias("p")).collect()
    assert [r["p"] for r in phases] == ["Initialising", "Converging", "Stable", "Stable", "Initialising"]
    assert apply(spark, ["COMPOUND", "NORMAL", None, "x"], labels.event_class_name, "string") == \
        ["COMPOUND_EVENT", "NORMAL", "NORMAL", "NORMAL"]
    weather = spark.createDataFrame(
        [(31.0, 99.0, 99.0), (4.0, 99.0, 99.0), (20.0, 99.0, 31.0), (20.0, 81.0, 0.0), (20.0, None, None)],
        "t double, h double, w double",
    ).select(labels.weather_condition(F.col("t"), F.col("h"), F.col("w")).alias("c")).collect()
    assert [r["c"] for r in weather] == ["Hot", "Cold", "Windy", "Humid", "Clear"]


def test_means_keep_all_digits_and_skip_nan(spark):
    rng = np.random.default_rng(11)
    groups = {"small": [0.001, 0.002, 0.003], "close": [8.004, 8.004, 8.001], "same": [0.1] * 7, "negative": [-0.3, -1e-7, 5.0],
              "bad": [float("nan"), 1.5, None, 2.5], "nothing": [float("nan"), None], "long": (rng.uniform(-1e3, 1e3, 500) / 7).tolist()}
    for digits in (3, 7, 15):
        groups[f"d{digits}"] = [round(float(x), digits) for x in rng.uniform(0, 60, 200)]
    rows = [(k, v) for k, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g string, v double")
    seen = set()
    for parts in (1, 7):  # the order of rows and partial sums doesn't matter
        got = frame.repartition(parts).groupBy("g").agg(
            num.exact_mean(F.col("v")).alias("m"), num.exact_stddev_pop(F.col("v")).alias("p"), num.exact_stddev_samp(F.col("v")).alias("s"))
        got = {r["g"]: (r["m"], r["p"], r["s"]) for r in got.collect()}
        seen.add(tuple(sorted(got.items(), key=str)))
    assert len(seen) == 1
    for g, values in groups.items():
        x = np.array([v for v in values if v is not None and not math.isnan(v)])
        if not len(x):
            assert got[g] == (None, None, None)
            continue
        assert got[g][0] == pytest.approx(math.fsum(x) / len(x), rel=1e-14, abs=1e-15)
        assert got[g][1] == pytest.approx(x.std(), abs=2e-6) and got[g][2] == pytest.approx(x.std(ddof=1), abs=2e-6)
    assert got["same"][1] == 0.0 and got["close"][1] > 0.001
