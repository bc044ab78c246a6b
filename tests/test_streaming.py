"""Streams over files: malformed and late rows, restarts, replays, expiry."""

import json
import os

import pytest
from pyspark.sql import functions as F

from zonewise import schemas
from zonewise.sinks.files import keyed_messages, publish, write_csv
from zonewise.sinks.tables import Snapshots, bounded_history, write_snapshot
from zonewise.sources.streams import read_topic
from zonewise.streaming import city, cycle, metrics, state, windows

ONCE = {"availableNow": True}


def message(**fields):
    return json.dumps(fields)


class Topic:
    """A folder that takes one file of messages at a time."""

    def __init__(self, folder):
        self.folder, self.n = folder, 0
        folder.mkdir(exist_ok=True)

    def send(self, *lines):
        path = self.folder / f"{self.n:04d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + self.n,) * 2)  # files are read in order of their age
        self.n += 1

    def stream(self, spark, schema, **options):
        return read_topic(spark, schema, source="text", path=str(self.folder), **options)


def traffic(zone, speed, time, borough="Manhattan"):
    return message(segment_id="s", zone_id=zone, speed_kmh=speed, borough=borough, timestamp=time)


def pollution(zone, aqi, time, pm25=12.0):
    return message(station_id="p", zone_id=zone, aqi=aqi, pm25=pm25, no2=3.0, timestamp=time)


@pytest.fixture
def town(spark, tmp_path):
    return city.City(spark, str(tmp_path / "city"), snapshot_format="json")


def run(town, **streams):
    for query in city.start_city(town, streams, ONCE).values():
        query.awaitTermination()


def test_messages_are_parsed_and_kept(spark, tmp_path):
    topic = Topic(tmp_path / "t")
    topic.send(
        traffic("MN-01", 20.5, "2024-01-01T00:00:00"), '{"zone_id": "MN-0', '{"zone_id": "BK-01", "speed_kmh": "fast"}',
        '{"other": 1}', message(zone_id=None, speed_kmh=None, timestamp="oops"),
    )
    rows = topic.stream(spark, schemas.TRAFFIC).writeStream.format("memory").queryName("parsed").trigger(**ONCE) \
        .option("checkpointLocation", str(tmp_path / "c")).start()
    rows.awaitTermination()
    got = {(r["zone_id"], r["speed_kmh"], r["_is_malformed"]): r for r in spark.table("parsed").collect()}
    assert len(spark.table("parsed").collect()) == 5
    assert str(got["MN-01", 20.5, False]["event_time"]) == "2024-01-01 00:00:00"
    assert got["BK-01", None, False]["event_time"] is not None  # falls back to the arrival time
    assert (None, None, True) in got and (None, None, False) in got


def test_state_survives_restarts_and_replays(spark, tmp_path, town):
    t, p, w = (Topic(tmp_path / n) for n in "tpw")
    zones = [f"MN-0{i}" for i in range(1, 6)]
    p.send(*[pollution(z, 120.0, "2024-01-01T00:00:00") for z in zones])
    t.send(*[traffic(z, 10.0 * i, "2024-01-01T00:00:00") for i, z in enumerate(zones)], "not json")
    w.send(message(worker_id="W-01", zone_id="MN-01", timestamp="2024-01-01T00:00:10"))

    def go(of=town):
        run(of, pollution=p.stream(spark, schemas.POLLUTION), traffic=t.stream(spark, schemas.TRAFFIC), workers=w.stream(spark, schemas.WORKER))

    go()
    scores = {r["zone_id"]: r for r in town.zone_scores().collect()}
    # zero speed and the unreadable row (zone MN-01) both count as 30
    assert scores["MN-01"]["avg_speed"] == 30.0 and scores["MN-01"]["event_type"] == "COMPOUND_EVENT"
    assert scores["MN-05"]["event_type"] == "POLLUTION_ALERT" and scores["MN-05"]["zone_score"] == 1.0
    assert town.labels().count() == 30 and town.model().n_batches == 1
    assert {r["exposure_status"] for r in town.exposure().collect()} == {"SAFE"}
    go()  # nothing new
    assert town.model().n_batches == 1

    p.send(pollution("MN-01", 10.0, "2023-12-31T00:00:00"))  # late, yet it is the newest batch of its zone
    t.send(traffic("SI-01", 50.0, "2024-01-01T00:01:00", "Staten Island"))
    w.send(message(worker_id="W-01", zone_id="MN-02", timestamp="2024-01-01T00:00:20"),
           message(worker_id="W-02", zone_id="SI-06", timestamp="2024-01-01T00:00:20"),
           message(worker_id="W-03", zone_id="XX-99", timestamp="2024-01-01T00:00:20"))
    again = city.City(spark, town.root, snapshot_format="json")  # another driver
    go(again)
    scores = {r["zone_id"]: r for r in again.zone_scores().collect()}
    assert scores["MN-01"]["avg_aqi"] == 10.0 and scores["MN-02"]["avg_aqi"] == 120.0
    assert scores["SI-01"]["borough"] == "Staten Island" and scores["SI-01"]["avg_aqi"] == 50.0
    exposure = {r["worker_id"]: r for r in again.exposure().collect()}
    assert (exposure["W-01"]["count"], exposure["W-01"]["n_high"], exposure["W-01"]["zone_id"]) == (2, 2, "MN-02")
    assert exposure["W-02"]["daily_avg_aqi"] == 75.0  # no pollution known there
    assert exposure["W-03"]["zone_id"] in set(zone_ids())  # an unknown zone gets one that is there
    assert {r["writer"]: r["n_rows"] for r in again.total_rows().collect()} == {"traffic": 7, "pollution": 6}
    assert again.model().n_batches == 2 and len(list((tmp_path / "city" / "models").glob("n=*"))) == 2

    # a batch that runs again changes neither the model nor the snapshots
    model, files = again.model(), spark.read.json(f"{town.root}/snapshots").count()
    changes = again.zone_state().filter("zone_id IN ('MN-01', 'SI-01')")
    last = max(again.models.versions())
    again.on_zones(changes, last)
    assert again.model() == model and spark.read.json(f"{town.root}/snapshots").count() == files
    again.on_zones(changes.limit(0), last + 1)  # an empty batch writes nothing
    assert again.model() == model and again.models.versions()[-1] == last


def zone_ids():
    from zonewise import dims
    return dims.ZONES


def test_weather_keeps_the_newest_row(spark, tmp_path, town):
    topic = Topic(tmp_path / "weather")
    topic.send(message(temperature=0, humidity=50.0, windspeed=None, condition="", timestamp="2024-01-01T02:00:00"),
               message(temperature=9.0, humidity=1.0, windspeed=1.0, condition="Hot", timestamp="2024-01-01T01:00:00"))
    run(town, weather=topic.stream(spark, schemas.WEATHER))
    row = town.weather().first()
    assert (row["temperature"], row["humidity"], row["windspeed"], row["condition"]) == (0.0, 50.0, 0.0, "Clear")


def test_zones_and_workers_expire(spark, tmp_path):
    """What no row has touched for its time to live leaves the state store when the watermark has passed."""
    t, p, w = (Topic(tmp_path / n) for n in "tpw")
    town = city.City(spark, str(tmp_path / "city"), clustering=False, score_ttl=300, exposure_ttl=300, watermark="0 seconds")

    def go():
        run(town, pollution=p.stream(spark, schemas.POLLUTION), traffic=t.stream(spark, schemas.TRAFFIC), workers=w.stream(spark, schemas.WORKER))
        return {r["zone_id"] for r in town.zone_scores().collect()}, {r["worker_id"]: r["count"] for r in town.exposure().collect()}

    def position(worker, time, zone="BK-01"):
        return message(worker_id=worker, zone_id=zone, timestamp=time)

    t.send(traffic("MN-01", 10.0, "2024-01-01T00:00:00"), traffic("MN-02", 10.0, "2024-01-01T00:00:00"))
    p.send(pollution("BK-01", 120.0, "2024-01-01T00:00:00"))
    w.send(position("W-01", "2024-01-01T00:00:00"), position("W-02", "2024-01-01T00:00:00", "QN-01"))
    assert go() == ({"MN-01", "MN-02", "BK-01"}, {"W-01": 1, "W-02": 1})
    for sent, topic in ((traffic("MN-01", 20.0, "2024-01-01T00:04:00"), t), (pollution("BK-02", 20.0, "2024-01-01T00:04:00"), p),
                        (position("W-01", "2024-01-01T00:04:00"), w)):
        topic.send(sent)
    assert go() == ({"MN-01", "MN-02", "BK-01", "BK-02"}, {"W-01": 2, "W-02": 1})
    for sent, topic in ((traffic("SI-01", 20.0, "2024-01-01T00:05:30"), t), (pollution("BK-02", 20.0, "2024-01-01T00:05:30"), p),
                        (position("W-01", "2024-01-01T00:05:30"), w)):
        topic.send(sent)
    assert go() == ({"MN-01", "BK-02", "SI-01"}, {"W-01": 3})
    assert {r["writer"]: r["n_rows"] for r in town.total_rows().collect()} == {"traffic": 4, "pollution": 3}


def test_windows_drop_late_rows_and_do_not_depend_on_batches(spark, tmp_path):
    topic = Topic(tmp_path / "t")
    for lines in (
        [traffic("MN-01", 20.0, "2024-01-01T00:00:01"), traffic("MN-01", 40.0, "2024-01-01T00:00:29")],
        [traffic("MN-01", 90.0, "2024-01-01T00:00:15"), traffic("MN-01", 10.0, "2024-01-01T00:10:00")],
        [traffic("MN-01", 11.0, "2024-01-01T00:10:01")],  # a batch drops by the watermark of the one before it
        [traffic("MN-01", 999.0, "2024-01-01T00:00:02")],  # ten minutes behind a two-minute watermark
        [traffic("MN-01", 10.0, "2024-01-01T01:00:00")],
    ):
        topic.send(*lines)
    stream = topic.stream(spark, schemas.TRAFFIC, maxFilesPerTrigger=1).select(
        "zone_id", "event_time", "speed_kmh", *[F.lit(None).cast("double").alias(c) for c in ("aqi", "pm25", "no2")]
    )
    query = windows.windowed_zone_scores(stream, "30 seconds").writeStream.outputMode("append").format("memory") \
        .queryName("windowed").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start()
    query.awaitTermination()
    got = {str(r["window"]["start"]): r for r in spark.table("windowed").collect()}
    assert got["2024-01-01 00:00:00"]["avg_speed"] == 50.0
    assert got["2024-01-01 00:00:00"]["avg_aqi"] == 50.0  # no pollution: the default
    assert "2024-01-01 01:00:00" not in got  # still open
    reports = [(r["numInputRows"], sum(o["numRowsDroppedByWatermark"] for o in r["stateOperators"])) for r in query.recentProgress]
    assert sum(late for _, late in reports) == 1 and sum(n for n, _ in reports) == 7


def test_native_exposure_continues_after_a_restart(spark, tmp_path):
    topic = Topic(tmp_path / "w")
    schema = schemas.struct(worker_id=schemas._S, aqi=schemas._D, timestamp=schemas._S)
    def go():
        stream = windows.exposure_stream(topic.stream(spark, schema))
        stream.writeStream.outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE) \
            .foreachBatch(Snapshots(spark, str(tmp_path / "totals")).write).start().awaitTermination()

    topic.send(*[message(worker_id="W-01", aqi=150.0, timestamp="2024-01-01T00:00:00")] * 3)
    go()
    topic.send(message(worker_id="W-01", aqi=50.0, timestamp="2024-01-01T00:00:30"),
               message(worker_id="W-02", aqi=50.0, timestamp="2024-01-01T00:00:30"))
    go()
    got = {r["worker_id"]: (r["count"], r["n_high"], r["daily_avg_aqi"]) for r in Snapshots(spark, str(tmp_path / "totals")).newest(
        schemas.struct(worker_id=schemas._S, count=schemas._L, n_high=schemas._L, daily_avg_aqi=schemas._D)).collect()}
    assert got == {"W-01": (4, 3, 125.0), "W-02": (1, 0, 50.0)}


def moment(text):
    return F.to_timestamp(F.lit(text))


def test_newest_rows_expire_and_survive_restarts(spark, tmp_path):
    """Keys leave the store at their time to live; a restart goes on from the state, and a replayed batch changes nothing."""
    topic, root = Topic(tmp_path / "in"), str(tmp_path / "c")
    schema = schemas.struct(key=schemas._S, value=schemas._D, timestamp=schemas._S)

    def go():
        rows = topic.stream(spark, schema, maxFilesPerTrigger=1).select("key", "value", "event_time")
        state.newest_rows(rows, ["key"], "event_time", ttl_seconds=300).writeStream.outputMode("update").format("noop") \
            .option("checkpointLocation", root).trigger(**ONCE).start().awaitTermination()
        return {r["key"]: r["value"] for r in state.stored(spark, root, "newest").collect()}

    def row(key, value, time):
        return message(key=key, value=value, timestamp=f"2024-01-01T00:{time}")

    topic.send(row("a", 1.0, "00:00"), row("b", 2.0, "00:00"), row("b", 1.5, "00:00"), row("a", 0.0, "00:00"))
    assert go() == {"a": 1.0, "b": 2.0}
    topic.send(row("a", 3.0, "04:00"), row("a", 9.0, "03:00"))
    topic.send(row("c", 4.0, "04:10"))
    assert go() == {"a": 3.0, "b": 2.0, "c": 4.0}
    topic.send(row("c", 5.0, "06:00"), row(None, 7.0, "06:00"))
    assert go() == {"a": 3.0, "c": 5.0, None: 7.0}
    assert go() == {"a": 3.0, "c": 5.0, None: 7.0}
    before = state.stored(spark, root, "newest", batchId=0)
    assert {r["key"]: r["value"] for r in before.collect()} == {"a": 1.0, "b": 2.0}
    # the last batch runs again, as after a crash before its commit
    commits = sorted(int(f.name) for f in (tmp_path / "c" / "commits").iterdir() if f.name.isdigit())
    (tmp_path / "c" / "commits" / str(commits[-1])).unlink()
    (tmp_path / "c" / "commits" / f".{commits[-1]}.crc").unlink(missing_ok=True)
    assert go() == {"a": 3.0, "c": 5.0, None: 7.0}
    topic.send(row("d", 1.0, "59:00"))
    topic.send(row("e", 1.0, "01:00"))  # by the watermark it has expired
    assert go() == {"d": 1.0}


def test_warm_start_labels(spark, tmp_path, town):
    assert town.labels().count() == 0
    town.warm_start(spark.createDataFrame([("MN-01", "Safe Corridor")], "zone_id string, cluster string"))
    hour = F.current_timestamp() + F.expr("INTERVAL 59 MINUTES")
    assert town.labels(hour).count() == 1
    assert town.labels(hour + F.expr("INTERVAL 2 MINUTES")).count() == 0


def test_history_versions_and_snapshots(spark, tmp_path):
    schema = schemas.struct(ts=schemas._S, rps=schemas._D)
    rows = spark.createDataFrame([(f"2024-01-01 00:{i:02d}:00", float(i)) for i in range(25)], schema)
    newest = [r["rps"] for r in bounded_history(rows, "ts", 20).collect()]
    assert newest == [float(i) for i in range(24, 4, -1)]
    young = rows.withColumn("ts", F.to_timestamp("ts"))
    assert bounded_history(young, "ts", 20, 600, F.to_timestamp(F.lit("2024-01-01 00:30:00"))).count() == 4
    table = Snapshots(spark, str(tmp_path / "versions"))
    assert table.newest(schema) is None and not table.has(0)
    for n in (0, 1, 2, 2, 3):
        table.write(rows.limit(n + 1), n)
    assert table.newest(schema).count() == 4 and table.newest(schema, 3).count() == 3
    assert table.versions() == [2, 3]
    ranked = spark.createDataFrame([("MN-01", 1), ("BK-01", 2)], "zone_id string, position int")
    for query in ("traffic", "pollution", "traffic"):
        write_snapshot(ranked, str(tmp_path / "snap"), query, 0, "json")
    assert spark.read.schema("zone_id string, position int").json(str(tmp_path / "snap")).count() == 4


def test_published_messages_come_back_as_a_topic(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "MN-01", 20.0), ("s2", "BK-01", 30.0)], "segment_id string, zone_id string, speed_kmh double")
    publish(keyed_messages(rows, "segment_id").select("value"), "text", str(tmp_path / "topic"))
    query = read_topic(spark, schemas.TRAFFIC, source="text", path=str(tmp_path / "topic")).writeStream.format("memory") \
        .queryName("published").trigger(**ONCE).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert {(r["segment_id"], r["speed_kmh"]) for r in spark.table("published").collect()} == {("s1", 20.0), ("s2", 30.0)}
    write_csv(rows, str(tmp_path / "csv"), ["speed_kmh", "segment_id"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["speed_kmh", "segment_id"]


def test_recommendation_cycles(spark, tmp_path, town):
    zones = ["MN-01", "MN-02", "SI-01"]
    workers = spark.createDataFrame([("W-01", "MN-01"), ("W-02", "SI-01"), ("W-03", "QN-01")], schemas.WORKER_ZONE)
    offline = spark.createDataFrame([("MN-01", "Permanently Hazardous"), ("SI-01", "Safe Corridor")], schemas.ZONE_LABEL)
    job = cycle.RecommendationCycle(spark, str(tmp_path / "cycle"), town, offline)
    series = {"MN-01": [80.0, 82.0, 85.0, 90.0, 96.0], "MN-02": [60.0] * 5, "SI-01": [20.0, 10.0, 30.0, 20.0, 25.0]}
    for i in range(5):
        rows = [(z, 30.0, series[z][i], 5.0, 0.9 if z == "MN-01" else 0.6, "NORMAL", "") for z in zones]
        scores = spark.createDataFrame(rows, schemas.ZONE_SCORE)
        job.run(i, scores=scores, workers=workers)
    job.run(4, scores=scores, workers=workers)  # the same cycle again

    import numpy as np
    got = {r["zone_id"]: r for r in job.forecasts().collect()}
    for zone in zones:
        x = series[zone]  # five readings: two equations
        weights = np.linalg.lstsq(np.array([x[:3], x[1:4]]), np.array(x[3:]), rcond=None)[0]
        expected = float(np.clip(weights @ x[2:], 0, 500))
        assert got[zone]["current_aqi"] == series[zone][4]
        assert got[zone]["forecast_aqi"] == pytest.approx(expected)
    exposure = {r["worker_id"]: r for r in job.exposure().collect()}
    assert (exposure["W-01"]["count"], exposure["W-01"]["high_aqi_minutes"]) == (5, 12.5)
    assert exposure["W-02"]["total_minutes"] == 12.5 and exposure["W-03"]["daily_avg_aqi"] == 50.0
    ranking = [(r["zone_id"], r["final_score"]) for r in job.ranking().orderBy("position").collect()]
    assert [z for z, _ in ranking] == ["MN-02", "SI-01", "MN-01"] and ranking[2][1] == 0.9 * 0.1
    advice = {r["worker_id"]: r["rec_zone"] for r in job.recommendations().collect()}
    assert advice == {"W-01": "MN-02", "W-02": "MN-02", "W-03": "MN-02"}
    counts = {r["exposure_status"]: r["n"] for r in job.status_counts().collect()}
    assert counts == {"SAFE": 3, "WARNING": 0, "CRITICAL": 0}


    # a day later nobody's exposure is left
    day = F.current_timestamp() + F.expr("INTERVAL 25 HOURS")
    job.run(5, now=day, scores=scores, workers=workers.limit(1))
    assert {r["worker_id"]: r["count"] for r in job.exposure().collect()} == {"W-01": 6}
    assert len(job.exposures.versions()) <= 2


def test_every_report_is_kept(spark, tmp_path):
    """More micro-batches than Spark keeps reports of: each has its row, and the rows add up to the table's."""
    rows = spark.range(150).select(F.timestamp_seconds(F.col("id")).alias("event_time"), F.lit("MN-01").alias("zone_id"))
    rows.repartitionByRange(150, "event_time").write.parquet(str(tmp_path / "in"))
    files = len(list((tmp_path / "in").glob("part-*")))
    reports = metrics.Reports(spark, str(tmp_path / "metrics")).start()
    try:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = stream.writeStream.format("noop").trigger(**ONCE).option("checkpointLocation", str(tmp_path / "c")).start()
        reports.called(query, "rows")
        reports.wait(query)
    finally:
        reports.stop()
    kept = reports.read()
    assert files > 100 and kept.count() == files and kept.agg(F.sum("input_rows")).first()[0] == 150
    assert {r["name"] for r in kept.collect()} == {"rows"} and kept.select("batch").distinct().count() == files
    points = metrics.history(kept, 2).collect()
    assert [r["batch"] for r in points] == [files - 2, files - 1]
    assert metrics.Reports(spark, str(tmp_path / "none")).read().count() == 0


def test_city_queries_stop_together(spark, tmp_path):
    town = city.City(spark, str(tmp_path / "city"))
    topics = {name: Topic(tmp_path / name) for name in ("traffic", "pollution")}
    topics["traffic"].send(traffic("MN-01", 12.0, "2024-01-01T00:00:00Z"))
    topics["pollution"].send(pollution("MN-01", 80.0, "2024-01-01T00:00:00Z"))
    streams = {"traffic": topics["traffic"].stream(spark, schemas.TRAFFIC), "pollution": topics["pollution"].stream(spark, schemas.POLLUTION)}
    before = set(q.id for q in spark.streams.active)
    city.run_city(town, streams, ONCE)
    assert {q.id for q in spark.streams.active} == before
