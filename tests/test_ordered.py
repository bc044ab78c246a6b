"""Bucketed scans, quantiles and forecasts against brute force, with one key holding most of the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewise.operators import forecast, ordered, quantiles
from zonewise.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def events():
    rng = random.Random(5)
    rows = []
    for i in range(600):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randint(0, 9)}"
        rows.append((i, key, rng.choice([None, round(rng.uniform(0, 100), 2)]), rng.randint(0, 9)))
    return rows


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, "i bigint, key string, x double, n int").repartition(7)


@pytest.fixture(params=[(1, 10_000), (7, 3), (40, 1)])
def cuts(request, spark):
    """Tasks and rows of an Arrow batch that a scan is cut into."""
    confs = {"spark.sql.shuffle.partitions": request.param[0], "spark.sql.execution.arrow.maxRecordsPerBatch": request.param[1],
             "spark.sql.adaptive.coalescePartitions.enabled": False}
    before = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, str(v).lower())
    yield request.param
    for c, v in before.items():
        spark.conf.set(c, v)


def by_key(events):
    grouped = {}
    for row in events:
        grouped.setdefault(row[1], []).append(row)
    return grouped


def test_forward_fill(cuts, frame, events):
    got = {r["i"]: (r["last"], r["text"]) for r in ordered.forward_fill(
        frame, ["key"], F.col("i"), {"last": F.col("x"), "text": F.when(F.col("n") > 6, F.col("n").cast("string"))}).collect()}
    assert len(got) == len(events)
    for rows in by_key(events).values():
        last = text = None
        for i, _, x, n in rows:
            last = x if x is not None else last
            text = str(n) if n > 6 else text
            assert got[i] == (last, text)


def test_running_totals_and_positions(cuts, frame, events):
    got = {r["i"]: (r["total"], r["seen"]) for r in ordered.running_totals(
        frame, ["key"], F.col("i"), {"total": F.col("n"), "seen": F.lit(1)}).collect()}
    for rows in by_key(events).values():
        for j, row in enumerate(rows):
            assert got[row[0]] == (sum(r[3] for r in rows[: j + 1]), j + 1)
    places = ordered.row_positions(frame, F.col("i")).collect()
    assert all(r["position"] == r["i"] for r in places)


def test_a_hot_key_lies_in_many_tasks(spark, cuts, monkeypatch):
    """One key with most of the rows, one-row keys and a null key: no task holds the hot key as a whole."""
    seen = {}
    kept = ordered.checkpointed
    monkeypatch.setattr(ordered, "checkpointed", lambda df, label: seen.setdefault("local", kept(df, label)))
    rows = [("hot", k, k % 7) for k in range(3000)] + [("one", 3, 5), (None, 9, 1), (None, 10, 4), ("zero", 1, 1)]
    frame = spark.createDataFrame(rows, "key string, i bigint, v int").repartition(5)
    found = ordered.running_totals(frame, ["key"], F.col("i"), {"t": F.col("v")})
    got = {(r["key"], r["i"]): r["t"] for r in found.collect()}
    total = {}
    for key, i, v in rows:
        total[key] = total.get(key, 0) + v
        assert got[key, i] == total[key]
    sizes = [r["count"] for r in seen["local"].groupBy("_task").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 3 * len(rows) / cuts[0] + 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan


def test_scans_of_little(spark, cuts):
    frame = spark.createDataFrame([("a", 1, 5)], "key string, i bigint, v int")
    assert ordered.running_totals(frame, ["key"], F.col("i"), {"t": F.lit(1)}).first()["t"] == 1
    assert ordered.running_totals(frame.limit(0), ["key"], F.col("i"), {"t": F.lit(1)}).count() == 0
    assert ordered.forward_fill(frame.limit(0), [], F.col("i"), {"t": F.col("v")}).columns == ["key", "i", "v", "t"]
    large = frame.select("key", "i", F.lit(1 << 62).alias("v")).union(frame.select("key", F.lit(2), F.lit(1 << 62)))
    with pytest.raises(Exception, match="64 bits"):
        ordered.running_totals(large, ["key"], F.col("i"), {"t": F.col("v")}).collect()


def test_trailing_values(cuts, frame, events):
    got = {r["i"]: (list(r["history"])) for r in ordered.trailing_values(frame, ["key"], F.col("i"), F.col("n"), 4).collect()}
    present = {r["i"]: list(r["history"]) for r in ordered.trailing_values(frame, ["key"], F.col("i"), F.col("x"), 4).collect()}
    assert len(got) == len(events)
    for rows in by_key(events).values():
        for j, row in enumerate(rows):
            assert got[row[0]] == [r[3] for r in rows[max(0, j - 3): j + 1]]
            assert present[row[0]] == [r[2] for r in rows[max(0, j - 3): j + 1] if r[2] is not None]


@pytest.mark.parametrize("strict", [False, True])
def test_as_of(cuts, spark, events, strict):
    left = [(i, k) for i, k, x, n in events if n < 4]
    right = [(i, k, x) for i, k, x, n in events if n >= 3 and x is not None]
    joined = ordered.as_of(
        spark.createDataFrame(left, "i bigint, key string"), spark.createDataFrame(right, "i bigint, key string, x double"),
        ["key"], "i", "x", default=75.0, strict=strict,
    )
    got = {r["i"]: r["x"] for r in joined.collect()}
    assert len(got) == len(left)
    for i, k in left:
        known = [x for j, kk, x in right if kk == k and (j < i if strict else j <= i)]
        assert got[i] == (known[-1] if known else 75.0)


def test_bits_have_the_order_of_doubles(spark):
    import struct
    rng = np.random.default_rng(3)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), -float("inf"), 1.0, 2.0, 4.0, 0.5]
    values += [float(x) for x in rng.normal(0, 1, 200) * 10.0 ** rng.integers(-300, 300, 200)] + [np.nextafter(2.0 ** k, d) for k in range(-1030, 1020, 37) for d in (0, 9e307)]
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    for r in frame.select("i", quantiles.ordered_bits(F.col("v")).alias("k")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(values[r["i"]])))[0]
        assert r["k"] == (-bits if values[r["i"]] < 0 else bits), values[r["i"]]


@pytest.mark.parametrize("ranked, few", [(1, 100_000), (20, 0), (1 << 16, 100_000)])
def test_exact_quantiles(spark, monkeypatch, ranked, few):
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", few)
    rng = np.random.default_rng(2)
    data = {"hot": np.round(rng.normal(0, 1, 4000), 2), "few": rng.uniform(0, 1, 3), "one": np.array([4.2]),
            "same": np.full(500, 7.0), "wide": rng.normal(0, 1, 200) * 10.0 ** rng.integers(-200, 200, 200), None: np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, values in data.items() for v in values]
    frame = spark.createDataFrame(rows, "key string, v double").repartition(5)
    probabilities = [0.0, 0.167, 0.333, 0.5, 0.667, 0.833, 1.0]
    for r in exact_quantiles(frame, ["key"], "v", probabilities, ranked).collect():
        values = data[r["key"]]
        assert r["n"] == len(values)
        assert r["quantile"] == pytest.approx(np.percentile(values, r["probability"] * 100), rel=1e-12, abs=1e-12)
    everything = np.array([v for _, v in rows])
    for r in exact_quantiles(frame, [], "v", probabilities, ranked).collect():
        assert r["quantile"] == pytest.approx(np.percentile(everything, r["probability"] * 100), rel=1e-12, abs=1e-12)
    assert exact_quantiles(frame.limit(0), ["key"], "v", [0.5]).count() == 0
    nan = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("a", None)], "key string, v double")
    assert [(r["quantile"], r["n"]) for r in exact_quantiles(nan, ["key"], "v", [0.5]).collect()] == [(1.0, 1)]


def test_a_rank_is_picked_in_one_pass_over_its_range(spark):
    """Spark moves what a column holds into a lambda that uses it: a search inside another took the square of the values."""
    values = np.random.default_rng(3).permutation(5_000) / 7
    found = exact_quantiles(spark.createDataFrame([(float(v),) for v in values], "v double"), [], "v", [0.1, 0.5])
    assert "filter(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["quantile"] for r in found.collect()) == pytest.approx(np.quantile(values, [0.1, 0.5]).tolist(), rel=1e-12)


#: Worked by hand: an exact recurrence goes on by its own rule, a short history keeps its last value, results stay in 0 to 500.
FORECASTS = [
    ([42.0], 42.0), ([55.0, 60.0, 58.0], 58.0), ([50.0] * 12, 50.0), ([0.0] * 5, 0.0),
    ([1.0, 1.0, 2.0, 3.0, 5.0, 8.0, 13.0, 21.0, 34.0], 55.0),  # each the sum of the two before
    ([1.0, 2.0, 1.0, 4.0, 2.0, 5.0, 8.0, 9.0, 13.0, 21.0], None),
    ([10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0], 90.0),  # a straight line
    ([1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 256.0], 500.0),  # doubles to 512
    ([256.0, 128.0, 64.0, 32.0, 16.0, 8.0, 4.0, 2.0], 1.0),
]


def test_forecast(spark):
    frame = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(FORECASTS)], "i int, h array<double>")
    for r in frame.select("i", forecast.forecast_aqi(F.col("h")).alias("f")).collect():
        want = FORECASTS[r["i"]][1]
        assert 0.0 <= r["f"] <= 500.0
        assert want is None or r["f"] == pytest.approx(want, abs=1e-6)


def least_squares(h):
    """The next value by numpy's least squares of smallest norm."""
    lags = np.stack([h[k:len(h) - 3 + k] for k in range(3)], 1)
    return np.linalg.lstsq(lags, h[3:], rcond=None)[0] @ h[-3:]


def test_forecast_is_the_least_squares_fit(spark):
    rng = np.random.default_rng(1)
    histories = []
    for n in range(4, 13):
        k = np.arange(n)
        for _ in range(20):
            histories += [rng.uniform(0, 300, n), np.round(55 + rng.normal(0, 3, n), 1), rng.integers(20, 120, n).astype(float),
                          55 + rng.normal(0, 0.05, n), rng.integers(0, 2, n) * 40.0]
        # constant, zero, straight, alternating, doubling, halving, a single spike, periodic
        histories += [np.full(n, 50.0), np.zeros(n), 10.0 * k + 20, 50 + 0.1 * k, np.where(k % 2, 40.0, 60.0), 2.0 ** k, 100 * 0.5 ** k,
                      30.0 * (k == 2), 30.0 * (k == n - 1), np.array([10.0, 20.0, 30.0] * 4)[:n], 100 + 10 * np.sin(k)]
    frame = spark.createDataFrame([(i, h.tolist()) for i, h in enumerate(histories)], "i int, h array<double>")
    plan = frame.select(forecast.forecast_aqi(F.col("h")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    for r in frame.select("i", forecast.autoregressive_step(F.col("h")).alias("f")).collect():
        assert r["f"] == pytest.approx(least_squares(histories[r["i"]]), rel=1e-6, abs=1e-6), histories[r["i"]]


def test_forecast_of_odd_histories(spark):
    frame = spark.createDataFrame([(0, []), (1, None), (2, [1.0, 2.0, float("nan"), 4.0, 5.0]), (3, [7.0])], "i int, h array<double>")
    got = {r["i"]: r["f"] for r in frame.select("i", forecast.forecast_aqi(F.col("h")).alias("f")).collect()}
    assert got == {0: None, 1: None, 2: 5.0, 3: 7.0}


@pytest.mark.parametrize("n", [0, 1, 7, 100, 399, 400, 1000])
@pytest.mark.parametrize("at_once", [1, 50])
def test_latest_rows(spark, n, at_once):
    rng = random.Random(9)
    times = [rng.choice([None, 5, 5, 5, 10**15, 10**15 + 7, rng.randrange(10**16), -rng.randrange(10**6)]) for _ in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t bigint").repartition(4)
    got = ordered.latest_rows(frame, F.col("t"), [F.col("i")], n, at_once).collect()
    want = sorted(enumerate(times), key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))[:n]
    assert sorted(map(tuple, got)) == sorted(want)
    assert ordered.latest_rows(frame.limit(0), F.col("t"), [], 5).count() == 0
