"""The city's streaming queries.

    zones     traffic and pollution: the newest means of each zone, its score, snapshots, labels
    workers   pollution and positions: exposure per worker and zone
    weather   the current weather
    metrics   a row for each report of the others (`metrics.Reports`)

Every query keeps its state in the checkpointed state store (`state`), where values expire; `City` reads what
they have committed. A batch is distributed from source to state; only the online model (k x d numbers) reaches the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonewise import dims, schemas
from zonewise.functions.numeric import default_if_falsy, not_nan, order_key, sum_parts
from zonewise.operators import exposure, online_kmeans, zones
from zonewise.sinks.tables import TTL_SECONDS, Snapshots, write_snapshot
from zonewise.streaming import state

FOREVER = 100 * 365 * 86_400
#: Shares of a zone's workers that different tasks may hold.
SHARES = 16
_SUMS = ["n_rows", *(f"{c}_{k}" for c in ("speed_kmh", "aqi", "pm25", "no2") for k in (0, 1, 2, "n"))]


@dataclass
class City:
    """What the queries under `root` know."""

    spark: SparkSession
    root: str
    profile: dims.ExposureProfile = dims.PER_READING
    k: int = 4
    seed: int = 42
    clustering: bool = True
    snapshot_format: str | None = None
    score_ttl: int = TTL_SECONDS["zone_score"]
    label_ttl: int = TTL_SECONDS["cluster_label"]
    exposure_ttl: int = FOREVER
    watermark: str = "2 minutes"
    checkpoints: str = field(default="")

    def __post_init__(self) -> None:
        state.use_state_store(self.spark)
        self.checkpoints = self.checkpoints or f"{self.root}/checkpoints"
        self.models = Snapshots(self.spark, f"{self.root}/models")
        self.labels_kept = Snapshots(self.spark, f"{self.root}/labels")

    # --- queries ------------------------------------------------------------------------------------

    def zone_changes(self, traffic: DataFrame | None, pollution: DataFrame | None) -> DataFrame:
        """A stream of zones whose means have changed: zone_id and the means of either kind."""
        sides = [_parts(x, is_traffic, self.watermark) for x, is_traffic in ((traffic, True), (pollution, False)) if x is not None]
        rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        few = state.summed(rows, ["zone_id", "is_traffic", "borough"], _SUMS, ["first"], ["newest"])
        return few.groupBy("zone_id").transformWithState(
            state.ZoneMeans(1000 * self.score_ttl), f"zone_id string, {state.TRAFFIC_VALUE}, {state.POLLUTION_VALUE}", "Update", "EventTime")

    def exposure_changes(self, workers: DataFrame, pollution: DataFrame | None) -> DataFrame:
        """A stream of changed exposure counts per worker and zone."""
        positions = zones.with_reading_defaults(workers.withWatermark("event_time", self.watermark))
        positions = positions.select(
            exposure.valid_zone(F.col("zone_id"), F.col("worker_id"), F.col("event_time")).alias("zone_id"),
            F.pmod(F.xxhash64("worker_id"), F.lit(SHARES)).cast("int").alias("share"), "worker_id", F.lit(1).cast("bigint").alias("n_rows"),
            arrival(positions).cast("decimal(38,0)").alias("last"), F.unix_micros("event_time").alias("newest"), *[F.lit(0).cast("bigint").alias(f"aqi_{k}") for k in (0, 1, 2, "n")])
        rows = positions.filter(F.col("worker_id").isNotNull())
        if pollution is not None:
            air = _parts(pollution, False, self.watermark)
            air = state.summed(air, ["zone_id"], _SUMS, maxs=["newest"]).select(
                "zone_id", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"), F.lit(None).cast("string").alias("worker_id"),
                "n_rows", F.lit(0).cast("decimal(38,0)").alias("last"), "newest", *[f"aqi_{k}" for k in (0, 1, 2, "n")])
            rows = rows.unionByName(air)
        few = state.summed(rows, ["zone_id", "share", "worker_id"], ["n_rows", *(f"aqi_{k}" for k in (0, 1, 2, "n"))], maxs=["last", "newest"])
        processor = state.ZoneExposure(1000 * self.exposure_ttl, self.profile.high_aqi, float(10 ** exposure.AQI_DIGITS), exposure.UNKNOWN_ZONE_AQI)
        return few.groupBy("zone_id", "share").transformWithState(
            processor, f"zone_id string, worker_id string, {state.EXPOSURE_VALUE}", "Update", "EventTime")

    def weather_changes(self, weather: DataFrame) -> DataFrame:
        """A stream of the current weather, by event time."""
        measures = {n: default_if_falsy(F.col(n), 0.0) for n in ("temperature", "humidity", "windspeed")}
        rows = weather.withColumns({**measures, "condition": default_if_falsy(F.col("condition"), "Clear")})
        return state.newest_rows(
            rows.select(F.lit("city").alias("place"), "event_time", _tie(weather).alias("tie"), "temperature", "humidity", "windspeed", "condition"),
            ["place"], "event_time", F.col("tie"))

    def on_zones(self, changes: DataFrame, batch_id: int) -> None:
        """Snapshot of the changed scores, and a step of the online model on all zones."""
        changes = changes.persist()  # one row per zone
        try:
            if not changes.count():  # the state of all zones is written, so all of them are asked for
                return
            if self.snapshot_format:
                scores = zones.scored(changes).select(*schemas.ZONE_SCORE.fieldNames())
                write_snapshot(scores, f"{self.root}/snapshots", "zones", batch_id, self.snapshot_format)
            if self.clustering and not self.models.has(batch_id):
                before = self.zone_state() if batch_id else changes.limit(0)
                rest = before.join(changes.select("zone_id"), "zone_id", "left_anti").select(*changes.columns)
                self._recluster(changes.unionByName(rest), batch_id)
        finally:
            changes.unpersist()

    def _recluster(self, known: DataFrame, batch_id: int) -> None:
        rows = zones.cluster_inputs(dims.zones_frame(self.spark), zones.with_defaults(known, zones.FUSION_DEFAULTS), self.k)
        rows = online_kmeans.zone_inputs(rows).persist()
        try:
            labels, model = online_kmeans.partial_fit(rows, self.model(), seed=self.seed)
            if model.centroids is None:
                return  # too few zones have data
            named = online_kmeans.named_labels(labels, model).withColumn("updated_at", F.current_timestamp())
            self.labels_kept.write(named.coalesce(1), batch_id)
            self.models.write(online_kmeans.model_frame(self.spark, model).coalesce(1), batch_id)
        finally:
            rows.unpersist()

    # --- reads --------------------------------------------------------------------------------------

    def zone_state(self) -> DataFrame:
        """The means of each zone that haven't expired."""
        return state.stored(self.spark, f"{self.checkpoints}/zones", "means").drop("newest")

    def zone_scores(self) -> DataFrame:
        return zones.scored(self.zone_state()).select(*schemas.ZONE_SCORE.fieldNames())

    def total_rows(self) -> DataFrame:
        """Rows that the zones have received, by kind."""
        sums = state.stored(self.spark, f"{self.checkpoints}/zones", "rows").agg(*[F.sum(c).alias(c) for c in ("traffic", "pollution")])
        return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("writer"), F.col(c).alias("n_rows")) for c in ("traffic", "pollution")]))
                           .alias("x")).select("x.*").filter("n_rows > 0")

    def exposure_parts(self) -> DataFrame:
        """Exposure counts per worker and zone."""
        return state.stored(self.spark, f"{self.checkpoints}/workers", "workers").drop("share")

    def exposure(self) -> DataFrame:
        """Exposure per worker over all batches so far."""
        return exposure.combined_exposure(self.exposure_parts(), self.profile)

    def worker_zones(self) -> DataFrame:
        return exposure.last_zones(self.exposure_parts())

    def weather(self) -> DataFrame:
        return state.stored(self.spark, f"{self.checkpoints}/weather", "newest").drop("_at", "_tie", "tie")

    def model(self) -> online_kmeans.OnlineModel:
        """The newest stored model, or an unfitted one."""
        rows = self.models.newest(schemas.MODEL_STATE)
        return online_kmeans.OnlineModel.empty(self.k) if rows is None else online_kmeans.model_from_rows(rows.collect())  # k rows

    def labels(self, now: Column | None = None) -> DataFrame:
        """The newest label of each zone that hasn't expired."""
        kept = self.labels_kept.newest(schemas.KEPT_LABEL)
        if kept is None:
            return self.spark.createDataFrame([], schemas.ZONE_LABEL)
        limit = F.col("updated_at") + F.make_dt_interval(secs=F.lit(self.label_ttl))
        return kept.filter(limit > (F.current_timestamp() if now is None else now)).select("zone_id", "cluster")

    def warm_start(self, labels: DataFrame) -> None:
        """Serve offline labels until the first batch has been clustered."""
        stamp = F.current_timestamp() + F.make_dt_interval(secs=F.lit(TTL_SECONDS["warm_start_label"] - self.label_ttl))
        self.labels_kept.write(labels.select("zone_id", "cluster", stamp.alias("updated_at")).coalesce(1), -1)


def _parts(readings: DataFrame, is_traffic: bool, watermark: str) -> DataFrame:
    """Readings as whole numbers that can be added up: three parts of each measure (`sum_parts`) and its count."""
    rows = zones.with_reading_defaults(readings.withWatermark("event_time", watermark))
    own = ("speed_kmh",) if is_traffic else ("aqi", "pm25", "no2")
    numbers = {}
    for c in ("speed_kmh", "aqi", "pm25", "no2"):
        value = F.col(c) if c in own else F.lit(None).cast("double")
        parts = [F.coalesce(x.cast("bigint"), F.lit(0)) for x in sum_parts(value)]
        numbers |= {f"{c}_{k}": x for k, x in enumerate(parts)} | {f"{c}_n": F.when(not_nan(value).isNotNull(), 1).otherwise(0).cast("bigint")}
    return rows.select(
        "zone_id", F.lit(is_traffic).alias("is_traffic"), (F.col("borough") if is_traffic else F.lit(None).cast("string")).alias("borough"),
        arrival(rows).cast("decimal(38,0)").alias("first"), F.unix_micros("event_time").alias("newest"), F.lit(1).cast("bigint").alias("n_rows"), *[x.alias(n) for n, x in numbers.items()])


def _tie(rows: DataFrame) -> Column:
    return F.col("event_id") if "event_id" in rows.columns else F.xxhash64(*rows.columns).bitwiseAND(F.lit((1 << 62) - 1))


def arrival(rows: DataFrame) -> Column:
    """Order inside a batch: event time, then an id if the stream has one, else a hash of the row, so that rows of
    one moment have the same order whenever the batch runs."""
    return order_key(F.col("event_time"), _tie(rows))


def start_city(
    city: City, streams: dict[str, DataFrame], trigger: dict | None = None, queries: tuple[str, ...] = ("zones", "workers", "weather"),
) -> dict[str, StreamingQuery]:
    """Start the `queries` that the given streams (traffic, pollution, weather, workers) allow, side by side, each
    with its checkpoint."""
    traffic, pollution = streams.get("traffic"), streams.get("pollution")
    found = {}
    if "zones" in queries and (traffic is not None or pollution is not None):
        found["zones"] = city.zone_changes(traffic, pollution).writeStream.foreachBatch(city.on_zones)
    if "workers" in queries and "workers" in streams:
        found["workers"] = city.exposure_changes(streams["workers"], pollution).writeStream.format("noop")
    if "weather" in queries and "weather" in streams:
        found["weather"] = city.weather_changes(streams["weather"]).writeStream.format("noop")
    return {
        name: writer.outputMode("update").queryName(f"{name}-{city.root.rsplit('/', 1)[-1]}")
        .option("checkpointLocation", f"{city.checkpoints}/{name}").trigger(**(trigger or {"processingTime": "30 seconds"})).start()
        for name, writer in found.items()
    }


def run_city(city: City, streams: dict[str, DataFrame], trigger: dict | None = None) -> None:
    """Start the queries side by side, wait until one of them ends, and stop the others."""
    queries = start_city(city, streams, trigger)
    try:
        city.spark.streams.awaitAnyTermination()
    finally:
        for query in queries.values():
            query.stop()
