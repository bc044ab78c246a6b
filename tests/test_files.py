"""File readers on hand-made files."""

import json

from pyspark.sql import functions as F

from zonewise.sources import files


def write(folder, name, text, mode="w"):
    path = folder / name
    path.write_bytes(text) if isinstance(text, bytes) else path.write_text(text)
    return str(path)


def test_traffic_csv(spark, tmp_path):
    path = write(tmp_path, "t.csv", (
        " Speed ,LINK_ID,BOROUGH,link_points,other\n"
        "20.5,a,Manhattan,\"40.7, -73.9 40.8, -73.8\",x\n"
        "30,b,queens,\"40.7,-73.9 40.8,-73.8\",x\n"
        ",c,Queens,\"40.6, -73.9\",x\n"
        "fast,d,Bronx,\"40.8, -73.9\",x\n"
        "-1,e,Brooklyn,\"40.6, -73.9\",x\n"
        "15,f,Atlantis,\"40.6, -73.9\",x\n"
        "16,g,Bronx,\"40.8,-73.9\",x\n"
    ))
    raw = files.read_traffic(spark, path)
    assert raw.columns == ["SPEED", "LINK_ID", "BOROUGH", "LINK_POINTS"]
    strict = [tuple(r) for r in files.traffic_segments(raw).select("borough_id", "lat", "speed").collect()]
    assert strict == [("MN", 40.7, 20.5)]
    tolerant = [tuple(r) for r in files.traffic_segments(raw, tolerant=True).select("borough_id", "lat", "speed").collect()]
    assert tolerant == [("MN", 40.7, 20.5), ("BX", 40.8, 16.0)]
    order = {c: i for i, c in enumerate("abcdefg")}
    position = F.ascii("LINK_ID") - F.lit(97)
    rows = {r["segment_id"]: r for r in files.traffic_messages(raw, position).collect()}
    assert set(rows) == set(order) - {"d"}  # an unreadable speed drops the row, a blank one is 30
    assert rows["c"]["speed_mph"] == 30.0 and rows["c"]["speed_kmh"] == round(30 * 1.60934, 2)
    assert rows["b"]["borough"] == "Queens" and rows["b"]["zone_id"] == "QN-02"
    assert rows["f"]["borough"] == "Manhattan" and rows["f"]["zone_id"] == "MN-06"
    assert abs(rows["a"]["lat"] - 40.7831) <= 0.01


def test_pollution_csv(spark, tmp_path):
    path = write(tmp_path, "p.csv", (
        b"location,parameter,value,unit,date_utc,latitude,longitude\n"
        b"A\xff,pm25,10,u,2024,40.75,-73.99\nA\xff, NO2 ,30,u,2024,40.75,-73.99\nA\xff,o3,99,u,2024,40.75,-73.99\n"
        b"A\xff,pm25,-5,u,2024,40.75,-73.99\n,pm25,x,u,2024,,\n"
    ))
    raw = files.read_pollution(spark, path)
    assert files.pm25_readings(raw).count() == 1
    numbered = raw.withColumn("n", F.monotonically_increasing_id())
    rows = files.pollution_messages(numbered, F.col("n"), keep=["n"]).orderBy("n").collect()
    assert [(r["pm25"], r["no2"]) for r in rows] == [(10.0, 0.0), (10.0, 30.0), (0.0, 30.0), (0.0, 0.0)]
    assert rows[0]["station_id"] == "A�" and rows[3]["station_id"] == "NYC-004"
    assert rows[0]["aqi"] == round(50 / 12 * 10, 1) and rows[3]["lat"] == 40.7128


def test_weather_csv_with_metadata(spark, tmp_path):
    folder = tmp_path / "weather"
    folder.mkdir()
    write(folder, "a.csv", "latitude,40.7\nelevation,10\ntime,temperature_2m (°C),relativehumidity_2m (%),windspeed_10m (km/h)\n"
                           "2024-01-01T00:00,31.25,50,10\n2024-01-01T01:00,,50,10\n")
    write(folder, "b.csv", "windspeed,humidity,temp,temperature\n5,85,x,12.5\n40,,4,\n")
    write(folder, "c.csv", "date,temp\n2024-02-01,7\n")
    rows = files.read_weather(spark, str(folder)).collect()
    assert len(rows) == 5
    got = {(r["temperature"], r["humidity"], r["windspeed"], r["condition"], r["source_ts"])
           for r in files.weather_messages(files.read_weather(spark, str(folder))).collect()}
    assert got == {
        (31.2, 50.0, 10.0, "Hot", "2024-01-01T00:00"), (12.5, 85.0, 5.0, "Humid", ""), (4.0, None, 40.0, "Cold", ""),
        (7.0, None, None, "Clear", "2024-02-01"),
    }


def test_json_documents(spark, tmp_path):
    stations = {"results": [
        {"id": 1, "coordinates": {"latitude": 40.75, "longitude": -73.99}, "sensors": [
            {"parameter": {"name": "PM25"}, "latest": {"value": 5}}, {"parameter": {"name": "pm25"}, "latest": {"value": 20}},
            {"parameter": {"name": "pm25"}, "latest": None}, {"parameter": {"name": "no2"}, "latest": {"value": 0}}]},
        {"id": 2, "coordinates": {"latitude": 40.6, "longitude": -74.1}},
        {"id": 3, "coordinates": {"latitude": 0, "longitude": -74.1}, "sensors": []},
        {"id": 4},
    ]}
    path = write(tmp_path, "stations.json", json.dumps(stations, indent=1))
    rows = {r["station_id"]: r for r in files.station_messages(files.read_sensor_locations(spark, path)).collect()}
    assert set(rows) == {"OAQ-1", "OAQ-2"}
    assert (rows["OAQ-1"]["pm25"], rows["OAQ-1"]["no2"]) == (20.0, 15.0)
    assert (rows["OAQ-2"]["pm25"], rows["OAQ-2"]["no2"], rows["OAQ-2"]["zone_id"][:2]) == (8.0, 15.0, "SI")

    page = {"results": [
        {"location": {"name": "A", "coordinates": {"latitude": 40.1, "longitude": -74.2}}, "value": 3,
         "parameter": {"units": "ppm"}, "period": {"datetimeFrom": {"utc": "t1"}}, "date": {"utc": "t2"}},
        {"location": {"name": "B"}, "value": 4, "date": {"utc": "t2"}},
    ]}
    path = write(tmp_path, "page.json", json.dumps(page))
    got = [tuple(r) for r in files.read_pollution_pages(spark, {"pm25": path, "no2": path}).orderBy("parameter", "location").collect()]
    assert got[2:] == [("A", "pm25", 3.0, "ppm", "t1", 40.1, -74.2), ("B", "pm25", 4.0, "µg/m³", "t2", 40.7128, -74.006)]
    assert len(got) == 4 and got[0][1] == "no2"

    hourly = {"hourly": {"time": ["t0", "t1"], "temperature_2m": [1.0, 2.0], "relativehumidity_2m": [3.0, None],
                         "windspeed_10m": [5.0, 6.0]}}
    path = write(tmp_path, "hourly.json", json.dumps(hourly))
    assert [tuple(r) for r in files.read_hourly_weather(spark, path).collect()] == [("t0", 1.0, 3.0, 5.0), ("t1", 2.0, None, 6.0)]


def test_monitor_summary(spark, tmp_path):
    path = write(tmp_path, "m.csv", (
        "State Code,Site Num,Parameter Name,Arithmetic Mean,Local Site Name,Latitude,Longitude\n"
        "36,0001,PM2.5 - Local Conditions,8.5,Park,40.8,-73.9\n36,0002,Nitrogen dioxide (NO2),,,40.8,-73.9\n"
        "36,0003,Ozone,1,,40.8,-73.9\n34,0004,PM2.5 - Local Conditions,1,,40.8,-73.9\n"
    ))
    rows = files.read_monitor_summary(spark, path).collect()
    assert len(rows) == 48
    assert {(r["location"], r["parameter"], r["value"]) for r in rows} == {("Park", "pm25", 8.5), ("0002", "no2", 10.0)}
    assert {r["date_utc"] for r in rows} == {f"2023-06-15T{h:02d}:00:00Z" for h in range(24)}
