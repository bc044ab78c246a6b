"""Keyed state with expiry: processors whose values live in the checkpointed state store of their query.

A value leaves the store when its time to live is over; nothing is kept beside it, so neither files nor listings grow
with the number of batches. A micro-batch that runs again starts from the state before it. `stored` reads the
state that a query has committed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from zonewise.functions.numeric import PART

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_GONE, _AT, _TIE = "gone", "_at", "_tie"
TRAFFIC_VALUE = "avg_speed double, borough string"
POLLUTION_VALUE = "avg_aqi double, avg_pm25 double, avg_no2 double"
_ZONE = Row("zone_id", "avg_speed", "borough", "avg_aqi", "avg_pm25", "avg_no2")
_EXPOSED = Row("zone_id", "worker_id", "count", "n_high", "aqi_units", "last_order")
EXPOSURE_VALUE = "count bigint, n_high bigint, aqi_units bigint, last_order decimal(38,0)"

# executors need not have this package installed: its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def use_state_store(spark: SparkSession) -> None:
    """Expiring state needs the RocksDB store; a store that the session names itself stays."""
    if not spark.conf.get(_PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)


def stored(spark: SparkSession, checkpoint: str, name: str, **options) -> DataFrame:
    """The committed values of a state variable: its key's columns and the value's."""
    rows = spark.read.format("statestore").options(stateVarName=name, **options).load(checkpoint)
    fields = rows.schema.names
    if "value" not in fields:  # a map state: one row for each entry
        rows = rows.withColumnsRenamed({"user_map_key": "entry", "user_map_value": "value"})
    return rows.select("key.*", *(["entry.*"] if "entry" in rows.columns else []), "value.*")


def summed(rows: DataFrame, keys: list[str], sums: list[str], mins: list[str] = (), maxs: list[str] = ()) -> DataFrame:
    """`rows` added up per key inside each task's Arrow batches, so that few rows reach the state. Sums are whole numbers."""
    names = [*keys, *sums, *mins, *maxs]

    def one(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                table = pa.Table.from_batches([b]).group_by(list(keys)).aggregate(
                    [*((c, "sum") for c in sums), *((c, "min") for c in mins), *((c, "max") for c in maxs)])
                renamed = [*keys, *(f"{c}_sum" for c in sums), *(f"{c}_min" for c in mins), *(f"{c}_max" for c in maxs)]
                found = table.select(renamed).rename_columns(names).cast(pa.schema([b.schema.field(n) for n in names]))
                yield from found.combine_chunks().to_batches()

    chosen = rows.select(*names)
    return chosen.mapInArrow(one, chosen.schema)


class Newest(StatefulProcessor):
    """The newest row of each key, by the whole number `_at` and then by the row's values; it goes `ttl_ms` after its
    event time, when the watermark has passed that, or never."""

    def __init__(self, keys: list[str], payload: StructType, ttl_ms: int | None) -> None:
        self.payload, self.ttl_ms, self.out = payload, ttl_ms, Row(*keys, *payload.names, _GONE)

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", StructType([*self.payload.fields]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.payload.names
        best = tuple(self.newest.get()) if self.newest.exists() else None
        changed = False
        for r in rows:
            row = tuple(r[n] for n in names)  # its time and its tie-break come first
            if best is None or (row[:2], repr(row)) > (best[:2], repr(best)):
                best, changed = row, True
        if not changed:
            return
        limit = best[0] // 1000 + self.ttl_ms if self.ttl_ms is not None else None
        if limit is not None and limit <= timerValues.getCurrentWatermarkInMs():
            return  # it comes too late to be kept
        self.newest.update(best)
        if limit is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(limit)
        yield self.out(*key, *best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        best = tuple(self.newest.get())
        self.newest.clear()
        yield self.out(*key, *best, True)

    def close(self) -> None:
        pass


def newest_rows(rows: DataFrame, keys: list[str], time: str, tie: Column | None = None, ttl_seconds: int | None = None,
                watermark: str = "0 seconds") -> DataFrame:
    """A stream of changes of the newest row per key: its columns, and `gone` where a row has expired.

    A row expires `ttl_seconds` after its event time, once the watermark has passed that; its key then leaves the store.
    A row that would have expired by the watermark is not taken up. Of rows of one moment that with the larger whole
    number `tie` counts. Rows without a key are one key's; rows without a time take no part. Use update mode.
    """
    use_state_store(rows.sparkSession)
    payload = [c for c in rows.columns if c not in keys and c != time]
    staged = rows.filter(F.col(time).isNotNull()).withWatermark(time, watermark).select(
        *keys, time, F.unix_micros(time).alias(_AT), F.coalesce(tie if tie is not None else F.lit(0), F.lit(0)).cast("bigint").alias(_TIE), *payload)
    kept = StructType([f for f in staged.schema.fields if f.name not in keys and f.name != time])
    out = StructType([*[staged.schema[k] for k in keys], *kept.fields]).add(_GONE, "boolean")
    return staged.groupBy(*keys).transformWithState(
        Newest(keys, kept, None if ttl_seconds is None else 1000 * ttl_seconds), out, "Update", "None" if ttl_seconds is None else "EventTime")


class _Expiring(StatefulProcessor):
    """State that goes `ttl_ms` after the event time of the newest row, when the watermark has passed that; or never.
    A row that would have gone by the watermark is still taken up, and goes with the next batch."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def _touch(self, seen: int | None, rows: list[Row]) -> int:
        """The newest event time of a value, in ms, with a timer at its end."""
        newest = max([*([] if seen is None else [seen]), *(int(r.newest) // 1000 for r in rows)])
        if self.ttl_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(newest + self.ttl_ms)
        return newest

    def close(self) -> None:
        pass


class ZoneMeans(_Expiring):
    """The means of a zone's newest batch of traffic and of pollution, and its rows so far.

    Input are `summed` rows; the means expire, the counts don't.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.means = handle.getValueState("means", f"{TRAFFIC_VALUE}, {POLLUTION_VALUE}, newest bigint")
        self.rows = handle.getValueState("rows", "traffic bigint, pollution bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)  # a few for each task, not one for each reading
        traffic, pollution = ([r for r in rows if r.is_traffic == x] for x in (True, False))
        speed, borough, *air, newest = tuple(self.means.get()) if self.means.exists() else (None,) * 6
        if traffic:
            speed, borough = _mean(traffic, "speed_kmh"), min(traffic, key=lambda r: r.first).borough
        if pollution:
            air = [_mean(pollution, c) for c in ("aqi", "pm25", "no2")]
        self.means.update((speed, borough, *air, self._touch(newest, rows)))
        seen = self.rows.get() if self.rows.exists() else (0, 0)
        self.rows.update((seen[0] + sum(r.n_rows for r in traffic), seen[1] + sum(r.n_rows for r in pollution)))
        yield _ZONE(*key, speed, borough, *air)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.means.clear()
        return iter(())


class ZoneExposure(_Expiring):
    """The exposure of workers to a zone's air: counts per worker, and the zone's newest mean index.

    Input are `summed` rows of pollution and of worker positions, the key a zone and a share of its workers. What
    workers have gathered there expires when none of them has sent a position for so long.
    """

    def __init__(self, ttl_ms: int | None, high: float, units: float, unknown: float) -> None:
        super().__init__(ttl_ms)
        self.high, self.units, self.unknown = high, units, unknown

    def init(self, handle) -> None:
        self.handle = handle
        self.air = handle.getValueState("air", "aqi double")
        self.newest = handle.getValueState("position", "newest bigint")
        self.workers = handle.getMapState("workers", "worker_id string", EXPOSURE_VALUE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)  # a few for each task and worker
        pollution, positions = ([r for r in rows if (r.worker_id is None) == x] for x in (True, False))
        if pollution:
            self.air.update((_mean(pollution, "aqi"),))
        aqi = self.air.get()[0] if self.air.exists() else None
        aqi = self.unknown if aqi is None else aqi
        if positions:
            self.newest.update((self._touch(self.newest.get()[0] if self.newest.exists() else None, positions),))
        for r in positions:
            entry = (r.worker_id,)
            count, n_high, total, last = self.workers.getValue(entry) if self.workers.containsKey(entry) else (0, 0, 0, r.last)
            now = (count + r.n_rows, n_high + r.n_rows * (aqi > self.high), total + r.n_rows * round(aqi * self.units), max(last, r.last))
            self.workers.updateValue(entry, now)
            yield _EXPOSED(key[0], r.worker_id, *now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.workers.clear()
        self.newest.clear()
        return iter(())


def _mean(rows: list[Row], name: str) -> float | None:
    """The mean whose sum was taken apart into whole numbers (`sum_parts`)."""
    n = sum(r[f"{name}_n"] for r in rows)
    whole, middle, low = (sum(r[f"{name}_{k}"] for r in rows) for k in range(3))
    return (float(whole) + (float(middle) + float(low) / PART) / PART) / n if n else None
