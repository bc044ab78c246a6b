"""Ranking, policy, overlays and label precedence on hand-made rows."""

from pyspark.sql import functions as F

from zonewise import dims
from zonewise.operators import exposure, recommend, report, zones


def final(spark, rows):
    return spark.createDataFrame(rows, "zone_id string, cluster string, final_score double")


def worker(spark, status, hours):
    return spark.createDataFrame(
        [("W-01", "MN-01", status, hours, 120.0)],
        "worker_id string, zone_id string, exposure_status string, hours_in_high_aqi double, daily_avg_aqi double",
    )


def recommended(spark, rows, status, hours=0.7):
    return recommend.recommendations(worker(spark, status, hours), recommend.policy(final(spark, rows))).first()


def test_critical_goes_to_the_best_safe_corridor(spark):
    rows = [("MN-01", "Permanently Hazardous", 0.9), ("SI-01", "Safe Corridor", 0.5), ("SI-02", "Safe Corridor", 0.6)]
    rec = recommended(spark, rows, "CRITICAL")
    assert (rec["rec_zone"], rec["rec_label"], rec["status"]) == ("SI-02", "Safe Corridor", "CRITICAL")
    assert rec["reason"] == "Near limit (0.7h) → Safe Corridor"
    assert recommended(spark, rows, "WARNING", 0.25)["reason"] == "Approaching limit (0.2h) → avoiding hazardous"
    assert recommended(spark, rows, "WARNING")["rec_zone"] == "SI-02"
    assert recommended(spark, rows[:1], "CRITICAL")["rec_zone"] == "MN-01"  # nothing else to offer


def test_safe_goes_to_the_highest_score_and_ties_keep_zone_order(spark):
    rows = [("QN-01", "Safe Corridor", 0.9), ("MN-02", "Safe Corridor", 0.8), ("BK-01", "Weather Sensitive", 0.9)]
    rec = recommended(spark, rows, "SAFE")
    assert rec["rec_zone"] == "BK-01" and rec["reason"] == "Best available zone (score 0.90)"
    order = [r["zone_id"] for r in recommend.ranked(final(spark, rows)).orderBy("position").collect()]
    assert order == ["BK-01", "QN-01", "MN-02"]
    assert [r["zone_id"] for r in report.top_zones(final(spark, rows), 2).collect()] == ["BK-01", "QN-01"]


def test_weights(spark):
    scores = spark.createDataFrame([(z, 0.5) for z in ("MN-01", "MN-02", "MN-03")], "zone_id string, zone_score double")
    labels = spark.createDataFrame([("MN-01", "Permanently Hazardous"), ("MN-02", "unheard of")], "zone_id string, cluster string")
    got = {r["zone_id"]: r["final_score"] for r in recommend.final_scores(scores, labels).collect()}
    assert got == {"MN-01": 0.05, "MN-02": 0.5, "MN-03": 0.5}


def test_label_gate(spark):
    zone_dim = dims.zones_frame(spark)
    def table(rows):
        return spark.createDataFrame(rows, "zone_id string, cluster string")
    offline = table([("MN-01", "Weather Sensitive"), ("MN-02", "Safe Corridor")])
    few = table([("MN-01", "Peak Hour Hazardous"), ("MN-03", "Peak Hour Hazardous")])
    got = {r["zone_id"]: r["cluster"] for r in recommend.gated_labels(zone_dim, few, offline).collect()}
    assert (got["MN-01"], got["MN-02"], got["MN-03"], got["SI-06"]) == \
        ("Weather Sensitive", "Safe Corridor", "Peak Hour Hazardous", "Safe Corridor")
    all_names = table([(z, n) for z, n in zip(dims.ZONES, dims.CLUSTER_NAMES)])
    live = {r["zone_id"]: r["cluster"] for r in recommend.gated_labels(zone_dim, all_names, offline).collect()}
    assert live["MN-01"] == "Permanently Hazardous" and live["SI-06"] is None
    plain = {r["zone_id"]: r["cluster"] for r in recommend.label_precedence(zone_dim, few, offline).collect()}
    assert (plain["MN-01"], plain["MN-02"], plain["SI-06"]) == ("Peak Hour Hazardous", "Safe Corridor", None)


def test_fusion_sides_and_guard(spark):
    traffic = spark.createDataFrame([("MN-01", 20.0, "Manhattan", 1)], "zone_id string, avg_speed double, borough string, n_rows long")
    pollution = spark.createDataFrame(
        [("BK-01", 39.0, 8.0, 9.0, 1)], "zone_id string, avg_aqi double, avg_pm25 double, avg_no2 double, n_rows long"
    )
    rows = {r["zone_id"]: r for r in zones.scored(zones.fuse(traffic, pollution)).collect()}
    assert rows["MN-01"]["event_type"] == "COMPOUND_EVENT" and rows["MN-01"]["avg_aqi"] == 50.0
    assert rows["BK-01"]["event_type"] == "POLLUTION_ALERT" and rows["BK-01"]["avg_speed"] == 40.0
    assert rows["BK-01"]["borough"] == "" and rows["BK-01"]["zone_score"] == 0.5 + 0.39 * 0.5
    state = zones.fuse(traffic, pollution)
    assert zones.cluster_inputs(dims.zones_frame(spark), state).count() == 0  # two zones are too few
    assert zones.cluster_inputs(dims.zones_frame(spark), state, 2).count() == 30


def test_first_borough_of_a_zone(spark):
    rows = spark.createDataFrame(
        [(3, "MN-01", 10.0, "late"), (1, "MN-01", 20.0, "first"), (2, "MN-01", 30.0, "late")],
        "i long, zone_id string, speed_kmh double, borough string",
    )
    row = zones.traffic_means(rows, F.col("i")).first()
    assert (row["avg_speed"], row["borough"], row["n_rows"]) == (20.0, "first", 3)


def test_exposure_limits(spark):
    rows = [(i, "W-01", "MN-01" if i < 185 else "SI-06", 101.0) for i in range(190)] + [(500, "W-02", "MN-01", 100.0)]
    frame = spark.createDataFrame(rows, "i long, worker_id string, zone_id string, aqi double")
    running = {(r["worker_id"], r["count"]): r["exposure_status"]
               for r in exposure.running_exposure(frame, F.col("i")).collect()}
    assert running["W-01", 90] == "SAFE" and running["W-01", 91] == "WARNING"
    assert running["W-01", 180] == "WARNING" and running["W-01", 181] == "CRITICAL"
    totals = {r["worker_id"]: r for r in exposure.exposure_totals(frame, F.col("i")).collect()}
    assert totals["W-01"]["n_high"] == 190 and totals["W-01"]["zone_id"] == "SI-06"
    assert totals["W-02"]["n_high"] == 0 and totals["W-02"]["exposure_status"] == "SAFE"
    risk = report.by_risk(exposure.exposure_totals(frame, F.col("i"))).collect()
    assert [r["worker_id"] for r in risk] == ["W-01", "W-02"]
    assert {r["exposure_status"]: r["n"] for r in report.status_counts(exposure.exposure_totals(frame, F.col("i"))).collect()} \
        == {"SAFE": 1, "WARNING": 0, "CRITICAL": 1}


def test_histogram_edges(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 7.9, 8, 8)], "x double")
    assert [r["n"] for r in report.histogram(frame, "x").orderBy("bin").collect()] == [1, 1, 0, 0, 0, 0, 0, 3]
    flat = report.histogram(frame.filter("x = 8"), "x").orderBy("bin").collect()
    assert [r["n"] for r in flat] == [0, 0, 0, 0, 2, 0, 0, 0] and flat[0]["low"] == 7.5


def test_sides_without_rows(spark):
    traffic = spark.createDataFrame([("MN-01", 20.0, "Manhattan", 3)], "zone_id string, avg_speed double, borough string, n_rows bigint")
    pollution = spark.createDataFrame([("BK-02", 80.0, 30.0, 15.0, 2)], "zone_id string, avg_aqi double, avg_pm25 double, avg_no2 double, n_rows bigint")
    fused = {r["zone_id"]: r for r in zones.scored(zones.fuse(traffic, pollution)).collect()}
    assert (fused["MN-01"]["avg_aqi"], fused["MN-01"]["avg_pm25"]) == (50.0, 10.0)
    assert (fused["BK-02"]["avg_speed"], fused["BK-02"]["borough"]) == (40.0, "")
    state = zones.fuse(traffic, pollution)
    assert zones.cluster_inputs(dims.zones_frame(spark), state).count() in (0, 30)
    own = spark.createDataFrame([("W-02", "MN-01", "SAFE", 4)], "worker_id string, zone_id string, exposure_status string, count bigint")
    rec = spark.createDataFrame([("W-01", "BK-02", "WARNING", "BK-03")], "worker_id string, zone_id string, exposure_status string, rec_zone string")
    assert {r["worker_id"] for r in recommend.overlaid(own, rec).collect()} == {"W-01", "W-02"}


def test_a_zone_outside_the_dimension_survives_exposure(spark):
    rows = spark.createDataFrame([("W-01", "MN-01", 1, 60.0), ("W-01", "XX-99", 2, 60.0), ("W-02", None, 1, 10.0)],
                                 "worker_id string, zone_id string, i bigint, aqi double")
    found = {r["worker_id"]: r for r in exposure.exposure_totals(rows, F.col("i").cast("decimal(38,0)")).collect()}
    assert found["W-01"]["zone_id"] == "XX-99" and found["W-01"]["count"] == 2 and found["W-02"]["zone_id"] is None
