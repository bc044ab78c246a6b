"""Features, offline and online clustering against numpy."""

import math

import numpy as np
import pytest

from zonewise import dims
from zonewise.operators import cluster, features, online_kmeans, silhouette
from zonewise.sinks import files as sink
from zonewise.sources import files as source

FEATURES = online_kmeans.FEATURES
LOWS, HIGHS = [5, 20, 5, 0.3], [70, 200, 60, 1.0]


def test_traffic_features(spark):
    """Hand-made segments: six latitudes that each fill a bin of their own, a borough with one segment, one whose equal
    latitudes leave bins without segments, and boroughs without any."""
    segments = [("MN", 40.70 + 0.01 * k, speed) for k, pair in enumerate([(10, 30), (12, 16), (50, 50), (19, 21), (8, 8), (25, 35)]) for speed in pair]
    segments += [("BK", 40.6, 17.0)]
    segments += [("QN", 40.6, 10.0), ("QN", 40.6, 30.0), ("QN", 40.6, 50.0)]
    frame = spark.createDataFrame([(b, lat, float(s)) for b, lat, s in segments], "borough_id string, lat double, speed double")
    rows = {r["zone_id"]: (r["avg_speed"], r["std_speed"], r["pct_slow"]) for r in features.traffic_features(dims.zones_frame(spark), frame).collect()}
    assert len(rows) == 30
    assert rows["MN-01"] == pytest.approx((20.0, 10.0, 0.5))
    assert rows["MN-02"] == pytest.approx((14.0, 2.0, 1.0))
    assert rows["MN-03"] == pytest.approx((50.0, 0.0, 0.0))
    assert rows["MN-04"] == pytest.approx((20.0, 1.0, 0.5))
    assert rows["MN-05"] == pytest.approx((8.0, 0.0, 1.0))
    for i in range(1, 7):
        assert rows[f"BK-0{i}"] == pytest.approx((17.0, 0.0, 1.0))
        assert rows[f"QN-0{i}"] == pytest.approx((30.0, math.sqrt(800 / 3), 1 / 3))
        for borough in ("SI", "BX"):
            default = dims.BOROUGH_DEFAULT_SPEED[borough]
            assert rows[f"{borough}-0{i}"] == pytest.approx((default, 0.0, float(default < 20)))


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i, zone in enumerate(dims.ZONES):
        center = [(15, 45), (25, 30), (35, 15), (50, 5)][i % 4]
        speed, pm = center[0] + rng.normal(0, 1), center[1] + rng.normal(0, 1)
        rows.append((zone, float(speed), float(abs(rng.normal(3, 1))), float(speed < 20), float(pm), float(abs(rng.normal(2, .5))),
                     float(pm * 4), dims.BOROUGH_DENSITY[zone[:2]]))
    schema = "zone_id string, " + ", ".join(f"{c} double" for c in dims.FEATURE_COLUMNS)
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def model(matrix):
    return cluster.train(matrix, restarts=3)


def distances(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))


def expected_silhouette(x, labels):
    d, out = distances(x), []
    for i, own in enumerate(labels):
        mates = [j for j, l in enumerate(labels) if l == own and j != i]
        if not mates:
            out.append(0.0)
            continue
        a = d[i, mates].mean()
        b = min(d[i, [j for j, l in enumerate(labels) if l == other]].mean() for other in set(labels) if other != own)
        out.append((b - a) / max(a, b))
    return out


def test_offline_model(spark, matrix, model, tmp_path):
    pdf = matrix.toPandas().set_index("zone_id")
    x = pdf[dims.FEATURE_COLUMNS].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    labelled = cluster.assigned(matrix, model).toPandas().set_index("zone_id").loc[pdf.index]
    labels = labelled["label"].to_numpy()
    centers = np.array([x[labels == j].mean(0) for j in range(4)])
    assert model.inertia == pytest.approx(((x - centers[labels]) ** 2).sum(), rel=1e-6)
    assert set(labelled["cluster"]) == set(dims.CLUSTER_NAMES)
    hazard = {r["cluster"]: r["hazard"] for r in model.centroids.collect()}
    assert [hazard[n] for n in dims.CLUSTER_NAMES] == sorted(hazard.values(), reverse=True)

    values = cluster.silhouettes(matrix, model).toPandas().set_index("zone_id").loc[pdf.index]["silhouette"]
    assert np.allclose(values, expected_silhouette(x, labels), atol=1e-8)

    points, centroids, shares = cluster.project(matrix, model)
    singular = np.linalg.svd(x, compute_uv=False) ** 2
    assert shares == pytest.approx(list(singular[:2] / singular.sum()), rel=1e-9)
    assert points.count() == 30 and centroids.count() == 4

    table = cluster.sweep(matrix, [2, 4], restarts=2).collect()
    assert table[0]["inertia"] > table[1]["inertia"] and table[1]["chosen"] and not table[0]["chosen"]
    assert [r["best"] for r in table] == [r["silhouette"] == max(t["silhouette"] for t in table) for r in table]

    path = str(tmp_path / "model")
    sink.save_model(model.pipeline, path)
    again = sink.load_model(spark, path)
    reloaded = cluster.ZoneModel(again, model.names, model.columns, model.inertia, model.centroids)
    assert reloaded.k == 4 and sink.load_model(spark, path + "-none") is None
    live = spark.createDataFrame([("MN-01", 15.0, 35.0), ("XX-01", 60.0, 3.0)], "zone_id string, avg_speed double, avg_pm25 double")
    names = [r["cluster"] for r in cluster.predict_zones(live, reloaded).collect()]
    assert set(names) <= set(dims.CLUSTER_NAMES)
    assert {r["cluster"] for r in cluster.predict_zones(live, None).collect()} == {"Safe Corridor"}

    document = sink.label_metadata(cluster.assigned(matrix, model), model.names, model.columns, float(values.mean()),
                                   model.inertia, model.centroids)
    sink.write_label_metadata(document, path + "-labels")
    row = spark.read.schema("zone_labels map<string,string>, silhouette_score double, feature_cols array<string>, "
                            "n_clusters int").json(path + "-labels").first()
    assert len(row["zone_labels"]) == 30 and 0 < row["silhouette_score"] < 1 and len(row["feature_cols"]) == 7
    assert source.read_zone_labels(spark, path + "-labels").count() == 30
    assert source.read_zone_labels(spark, path + "-missing").count() == 0


def test_silhouette_blocks_and_singletons(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3))
    labels = [0] * 120 + [1] * 79 + [2]  # one cluster holds most rows, one holds a single row
    frame = spark.createDataFrame(
        [(i, l, *map(float, p)) for i, (l, p) in enumerate(zip(labels, x))], "zone_id int, label int, a double, b double, c double"
    )
    expected = expected_silhouette(x, labels)
    for block_rows in (17, 1024):
        rows = silhouette.silhouette_rows(frame, ["a", "b", "c"], block_rows=block_rows).collect()
        assert len(rows) == 200
        for r in rows:
            assert r["silhouette"] == pytest.approx(expected[r["zone_id"]], abs=1e-7)
    assert -1 <= silhouette.silhouette_squared(frame, ["a", "b", "c"]) <= 1


def batch(spark, rng, n=30):
    x = rng.uniform(LOWS, HIGHS, size=(n, 4))
    frame = spark.createDataFrame(
        [(dims.ZONES[i], *map(float, row)) for i, row in enumerate(x)], "zone_id string, " + ", ".join(f"{c} double" for c in FEATURES)
    )
    return x, frame


def test_online_updates(spark):
    rng = np.random.default_rng(42)
    model = online_kmeans.OnlineModel.empty()
    inertias = []
    for step in range(20):
        x, frame = batch(spark, rng)
        before = model
        labels, model = online_kmeans.partial_fit(frame, before)
        inertias.append(model.inertia)
        assert model.n_batches == step + 1 and math.isfinite(model.inertia)
        if before.centroids is None or step > 4:
            continue
        low, high = np.array(model.lows), np.array(model.highs)
        assert (low <= x.min(0)).all() and (high >= x.max(0)).all()
        scaled = (x - low) / (high - low)
        old = np.array(before.centroids)
        own = ((scaled[:, None, :] - old[None]) ** 2).sum(-1).argmin(1)
        got = {r["zone_id"]: r["label"] for r in labels.collect()}
        assert [got[dims.ZONES[i]] for i in range(30)] == list(own)
        new, total = old.copy(), 0.0
        for j in range(4):
            n = int((own == j).sum())
            assert model.counts[j] == before.counts[j] + n
            if n:
                rate = n / model.counts[j]
                new[j] = (1 - rate) * old[j] + rate * scaled[own == j].mean(0)
        total = ((scaled - new[own]) ** 2).sum()
        assert np.allclose(model.centroids, new, atol=1e-8)
        assert model.inertia == pytest.approx(total, abs=1e-6)
    assert sum(inertias[-3:]) <= 1.5 * sum(inertias[:3])


def test_online_seeding_names_and_few_rows(spark):
    x, frame = batch(spark, np.random.default_rng(7), 12)
    labels, model = online_kmeans.partial_fit(frame, online_kmeans.OnlineModel.empty())
    again = online_kmeans.partial_fit(frame.repartition(5), online_kmeans.OnlineModel.empty())[1]
    assert again == model  # the same draw whatever the partitioning
    named = online_kmeans.named_labels(labels, model).collect()
    assert len(named) == 12 and {r["cluster"] for r in named} <= set(dims.CLUSTER_NAMES)
    raw = [c[1] * (hi1 - lo1) + lo1 - (c[0] * (hi0 - lo0) + lo0) for c in model.centroids
           for lo0, hi0, lo1, hi1 in [(model.lows[0], model.highs[0], model.lows[1], model.highs[1])]]
    worst = max(range(4), key=lambda j: raw[j])
    assert {r["cluster"] for r in named if r["label"] == worst} == {dims.CLUSTER_NAMES[0]}
    restored = online_kmeans.model_from_rows(online_kmeans.model_frame(spark, model).collect())
    assert restored == model

    few, unchanged = online_kmeans.partial_fit(frame.limit(3), model)
    assert sorted(r["label"] for r in few.collect()) == [0, 1, 2] and unchanged == model
    first, empty = online_kmeans.partial_fit(frame.limit(3), online_kmeans.OnlineModel.empty())
    assert {r["cluster"] for r in online_kmeans.named_labels(first, empty).collect()} == {"Safe Corridor"}
    same = spark.createDataFrame([(z, 1.0, 1.0, 1.0, 1.0) for z in dims.ZONES], frame.schema)
    _, flat = online_kmeans.partial_fit(same, online_kmeans.OnlineModel.empty())
    assert flat.inertia == 0.0 and sum(flat.counts) == 30
