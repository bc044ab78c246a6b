"""Offline zone clustering with Spark ML: scale, sweep k, fit, name by hazard, predict, project."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.geo import borough_name
from zonewise.functions.numeric import exact_mean, exact_stddev_pop
from zonewise.operators.features import live_features
from zonewise.operators.silhouette import silhouette_mean, silhouette_rows

DIGITS = 6


def standardised(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean and unit population deviation per column; a constant column becomes 0."""
    stats = rows.agg(F.struct(*[
        s
        for c in columns
        for s in (exact_mean(F.col(c)).alias(f"{c}_m"), exact_stddev_pop(F.col(c)).alias(f"{c}_s"))
    ]).alias("s")).scalar()
    return rows.withColumn("_s", stats).withColumns({
        c: F.coalesce(
            (F.col(c) - F.col(f"_s.{c}_m")) / F.nullif(F.col(f"_s.{c}_s"), F.lit(0.0)), F.lit(0.0)
        )
        for c in columns
    }).drop("_s")


def hazard_names(centroids: DataFrame, online: bool = False) -> DataFrame:
    """Add `hazard`, its rank (0 = worst) and the cluster name to k centroid rows.

    Offline: AQI proxy and speed, each relative to its largest centroid, and ranks past the last name
    become "Cluster n". Online: AQI minus speed in raw units, and later ranks share the last name.
    """
    names = F.array(*[F.lit(n) for n in dims.CLUSTER_NAMES])
    rank = F.col("hazard_rank")
    if online:
        hazard = F.col("avg_aqi") - F.col("avg_speed")
        name = F.get(names, F.least(rank, F.lit(len(dims.CLUSTER_NAMES) - 1)))
    else:
        everything = Window.partitionBy()  # k rows
        hazard = F.col("avg_aqi_proxy") / (F.max("avg_aqi_proxy").over(everything) + F.lit(1e-9)) \
            - F.col("avg_speed") / (F.max("avg_speed").over(everything) + F.lit(1e-9))
        name = F.coalesce(F.get(names, rank), F.concat(F.lit("Cluster "), rank.cast("string")))
    by_hazard = Window.orderBy(F.desc("hazard"), "cluster_id")
    return centroids.withColumn("hazard", hazard) \
        .withColumn("hazard_rank", F.row_number().over(by_hazard) - F.lit(1)).withColumn("cluster", name)


def _scaler(columns: list[str]) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ])


def _best_fit(scaled: DataFrame, k: int, restarts: int, seed: int) -> KMeansModel:
    """The best of several starts, some of which run side by side."""
    def fit(start: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + start, featuresCol="features").fit(scaled)

    with ThreadPool(min(restarts, 4)) as pool:
        return min(pool.map(fit, range(restarts)), key=lambda m: m.summary.trainingCost)


def _population_scale(n: int) -> float:
    """Spark scales by the sample deviation; this factor turns its cost into that of population scaling."""
    return n / (n - 1) if n > 1 else 1.0


def _scaled_columns(scaled: DataFrame, columns: list[str], key: str) -> DataFrame:
    values = vector_to_array("features")
    return scaled.select(key, "label", *[F.get(values, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def sweep(
    features: DataFrame, ks: range | list[int] = range(2, 7), columns: list[str] | None = None, key: str = "zone_id",
    restarts: int = 20, seed: int = 42, chosen: int = 4,
) -> DataFrame:
    """(k, inertia, silhouette, chosen, best) for every k."""
    columns = columns or dims.FEATURE_COLUMNS
    spark = features.sparkSession
    scaled = _scaler(columns).fit(features).transform(features).persist()
    n = scaled.count()
    rows = []
    for k in ks:
        model = _best_fit(scaled, k, restarts, seed)
        labelled = model.transform(scaled).withColumnRenamed("prediction", "label")
        # the ratio of distances does not change with a uniform scale
        mean = silhouette_mean(silhouette_rows(_scaled_columns(labelled, columns, key), columns, key)).first()[0]
        rows.append((k, float(model.summary.trainingCost) * _population_scale(n), float(mean), k == chosen))
    scaled.unpersist()
    best = max(rows, key=lambda r: r[2])[0]
    return spark.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, inertia double, silhouette double, chosen boolean, best boolean"
    )


@dataclass
class ZoneModel:
    """A fitted scaler + k-means pipeline with the names of its clusters."""

    pipeline: PipelineModel
    names: dict[int, str]
    columns: list[str]
    inertia: float
    centroids: DataFrame  # k rows in original units, with hazard and name

    @property
    def k(self) -> int:
        return self.pipeline.stages[-1].summary.k if self.pipeline.stages[-1].hasSummary else \
            len(self.pipeline.stages[-1].clusterCenters())


def train(
    features: DataFrame, k: int = 4, columns: list[str] | None = None, restarts: int = 20, seed: int = 42
) -> ZoneModel:
    columns = columns or dims.FEATURE_COLUMNS
    scaler = _scaler(columns).fit(features)
    scaled = scaler.transform(features).persist()
    n = scaled.count()
    model = _best_fit(scaled, k, restarts, seed)
    scaled.unpersist()
    pipeline = PipelineModel(stages=[*scaler.stages, model])
    centroids = hazard_names(centroid_frame(features.sparkSession, pipeline, columns))
    names = {r["cluster_id"]: r["cluster"] for r in centroids.select("cluster_id", "cluster").collect()}  # k rows
    return ZoneModel(pipeline, names, columns, float(model.summary.trainingCost) * _population_scale(n), centroids)


def centroid_frame(spark: SparkSession, pipeline: PipelineModel, columns: list[str]) -> DataFrame:
    """The k centroids in original units."""
    scaler, model = pipeline.stages[-2], pipeline.stages[-1]
    centers = np.array(model.clusterCenters()) * scaler.std.toArray() + scaler.mean.toArray()
    return spark.createDataFrame(
        [(i, *map(float, c)) for i, c in enumerate(centers)],
        "cluster_id int, " + ", ".join(f"{c} double" for c in columns),
    )


def name_of(cluster_id: Column, names: dict[int, str]) -> Column:
    chain = F
    for i, name in names.items():
        chain = chain.when(cluster_id == i, F.lit(name))
    return chain.otherwise(F.lit(dims.CLUSTER_NAMES[-1])) if names else F.lit(dims.CLUSTER_NAMES[-1])


def assigned(features: DataFrame, model: ZoneModel) -> DataFrame:
    """The feature rows with `label` and `cluster`."""
    return model.pipeline.transform(features).withColumnRenamed("prediction", "label") \
        .withColumn("cluster", name_of(F.col("label"), model.names)).drop("raw_features", "features")


def predict_zones(live: DataFrame, model: ZoneModel | None) -> DataFrame:
    """A cluster name for every live (zone_id, avg_speed, avg_pm25) row; without a model the safest name."""
    if model is None:
        return live.withColumn("cluster", F.lit(dims.CLUSTER_NAMES[-1]))
    return assigned(live_features(live), model)


def silhouettes(features: DataFrame, model: ZoneModel, key: str = "zone_id") -> DataFrame:
    """Silhouette of every row in the scaled space of the model."""
    labelled = model.pipeline.transform(features).withColumnRenamed("prediction", "label")
    return silhouette_rows(_scaled_columns(labelled, model.columns, key), model.columns, key)


def project(features: DataFrame, model: ZoneModel, key: str = "zone_id") -> tuple[DataFrame, DataFrame, list[float]]:
    """Two principal components of the scaled rows and of the centroids, and the explained variance shares."""
    scaled = model.pipeline.transform(features)
    pca = PCA(k=2, inputCol="features", outputCol="pc").fit(scaled)
    axes = vector_to_array("pc")
    centers = features.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(_vectors(model.pipeline.stages[-1]))], ["label", "features"]
    )

    def flat(frame: DataFrame, *keep: str) -> DataFrame:
        return pca.transform(frame).select(*keep, F.get(axes, F.lit(0)).alias("pc1"), F.get(axes, F.lit(1)).alias("pc2"))

    points = flat(scaled.withColumnRenamed("prediction", "label"), key, "label")
    return points, flat(centers, "label"), [float(v) for v in pca.explainedVariance.toArray()]


def _vectors(model: KMeansModel) -> list:
    return [Vectors.dense(c) for c in model.clusterCenters()]


def assignment_table(labels: DataFrame, features: DataFrame, silhouette: DataFrame) -> DataFrame:
    """Zone, cluster, borough, features and silhouette in one row, sorted by cluster and zone."""
    return (
        labels.select("zone_id", "cluster").join(features, "zone_id")
        .join(silhouette.select("zone_id", "silhouette"), "zone_id")
        .withColumn("borough", borough_name(F.col("zone_id"))).orderBy("cluster", "zone_id")
    )
