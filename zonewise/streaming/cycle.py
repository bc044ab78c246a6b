"""The recommendation cycle: forecast the zones, add a cycle of exposure, rank the zones, advise the workers.

One call of `run` is one cycle; a scheduler or a streaming trigger decides when. What cycles remember (12 readings a
zone, the exposure of each worker) is a version that a cycle writes from the one before it, so a cycle that
runs again replaces what it wrote, and what has expired is in no later version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise import dims, schemas
from zonewise.operators import exposure, forecast, recommend, report
from zonewise.sinks.tables import TTL_SECONDS, Snapshots
from zonewise.streaming.city import City

DEFAULT_AQI = 50.0


@dataclass
class RecommendationCycle:
    spark: SparkSession
    root: str
    city: City
    offline_labels: DataFrame
    profile: dims.ExposureProfile = dims.PER_CYCLE

    def __post_init__(self) -> None:
        self.readings, self.exposures, self.counts, self.advice, self.rankings = (
            Snapshots(self.spark, f"{self.root}/{name}") for name in ("readings", "exposure", "status_counts", "recommendations", "ranking"))

    def run(self, cycle: int, now: Column | None = None, scores: DataFrame | None = None, workers: DataFrame | None = None) -> None:
        """One cycle on the city's zone scores and worker zones, or on those given."""
        moment = F.current_timestamp() if now is None else now
        scores = (self.city.zone_scores() if scores is None else scores).persist()  # one row per zone
        try:
            self._remember(cycle, scores)
            self._expose(cycle, moment, self.city.worker_zones() if workers is None else workers)
            final = self._rank(cycle, scores, now)
            worker_state = self.exposure()
            advice = recommend.recommendations(worker_state, recommend.policy(final), self.profile.daily_limit_hours)
            self.advice.write(advice.withColumn("updated_at", moment), cycle)
            self.counts.write(report.status_counts(worker_state), cycle)
        finally:
            scores.unpersist()

    def _remember(self, cycle: int, scores: DataFrame) -> None:
        """The zones' readings of the last 12 cycles, one for each."""
        point = scores.select("zone_id", F.struct(F.lit(cycle).cast("bigint").alias("cycle"), F.col("avg_aqi").alias("aqi")).alias("p"))
        before = self.readings.newest(schemas.ZONE_SERIES, cycle)
        points = point if before is None else point.union(before.select("zone_id", F.explode("series")))
        recent = points.filter(F.col("p.cycle") > cycle - forecast.HISTORY)
        self.readings.write(recent.groupBy("zone_id").agg(F.array_sort(F.collect_list("p")).alias("series")).coalesce(1), cycle)

    def forecasts(self) -> DataFrame:
        """(zone_id, current_aqi, forecast_aqi) from the newest version of the readings."""
        series = self.readings.newest(schemas.ZONE_SERIES)
        return series.select("zone_id", F.element_at("series", -1)["aqi"].alias("current_aqi"),
                             forecast.forecast_aqi(F.col("series.aqi")).alias("forecast_aqi"))

    def _expose(self, cycle: int, moment: Column, workers: DataFrame) -> None:
        """One more cycle for every worker, at the zone it was last in. Counts that no cycle has added to for a day
        (`cycle_exposure`) go."""
        zone = exposure.valid_zone(F.col("zone_id"), F.col("worker_id"), moment)
        air = self.forecasts().select(
            "zone_id", exposure.protective_aqi(F.col("current_aqi"), F.col("forecast_aqi")).alias("aqi")
        )
        rows = workers.select("worker_id", zone.alias("zone_id")).join(air, "zone_id", "left") \
            .withColumn("aqi", F.coalesce("aqi", F.lit(DEFAULT_AQI)))
        parts = exposure.partial_exposure(rows, F.lit(cycle).cast("decimal(38,0)"), self.profile).withColumn("seen_at", moment)
        before = self.exposures.newest(schemas.CYCLE_PART, cycle)
        if before is not None:
            parts = parts.unionByName(before)
        added = exposure.added_parts(parts).join(parts.groupBy("worker_id").agg(F.max("seen_at").alias("seen_at")), "worker_id")
        live = F.col("seen_at") + F.make_dt_interval(secs=F.lit(TTL_SECONDS["cycle_exposure"])) > moment
        self.exposures.write(added.filter(live).select(*schemas.CYCLE_PART.fieldNames()), cycle)

    def _rank(self, cycle: int, scores: DataFrame, now: Column | None) -> DataFrame:
        zone_dim = dims.zones_frame(self.spark)
        live = self.city.labels(now)
        labels = recommend.label_precedence(zone_dim, live, self.offline_labels)
        final = recommend.final_scores(scores, labels)
        ranked = recommend.ranked(final).select("position", "zone_id", "cluster", "final_score")
        self.rankings.write(ranked, cycle)
        return self.ranking()

    def ranking(self) -> DataFrame:
        return self.rankings.newest(schemas.ZONE_RANKING)

    def exposure(self) -> DataFrame:
        """Exposure per worker over all cycles."""
        return exposure.combined_exposure(self.exposures.newest(schemas.CYCLE_PART).drop("seen_at"), self.profile)

    def recommendations(self, now: Column | None = None) -> DataFrame:
        """The newest cycle's advice, while it lives."""
        stored = schemas.struct(**{f.name: f.dataType for f in schemas.RECOMMENDATION.fields}, updated_at=schemas.T.TimestampType())
        limit = F.col("updated_at") + F.make_dt_interval(secs=F.lit(TTL_SECONDS["recommendation"]))
        return self.advice.newest(stored).filter(limit > (F.current_timestamp() if now is None else now)).drop("updated_at")

    def status_counts(self) -> DataFrame:
        return self.counts.newest(schemas.STATUS_COUNT)
