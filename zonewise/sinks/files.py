"""Messages, CSV, label metadata and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions.numeric import round_exact
from zonewise.sources.files import path_exists


def keyed_messages(rows: DataFrame, key: Column | str) -> DataFrame:
    """(key, value) rows, the value being the whole row as JSON."""
    key_column = F.col(key) if isinstance(key, str) else key
    return rows.select(key_column.cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def publish(messages: DataFrame, sink: str = "kafka", path: str | None = None, **options: str) -> None:
    """Write keyed messages to a topic, or to files with one message per line."""
    given = {key.replace("__", "."): str(value) for key, value in options.items()}
    if sink == "kafka":
        messages.write.format("kafka").options(**given).save()
    else:
        messages.write.mode("append").format(sink).options(**given).save(path)


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """The named columns in that order; others are left out."""
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def label_metadata(
    labels: DataFrame, names: dict[int, str], columns: list[str], silhouette: float, inertia: float | None = None,
    centroids: DataFrame | None = None,
) -> DataFrame:
    """One row: zone labels, cluster names, features, silhouette, k, inertia and the centroid records.

    The label map holds one entry per zone of the dimension.
    """
    zone_map = F.map_from_entries(F.array_sort(F.collect_list(F.struct("zone_id", "cluster"))))
    name_map = F.create_map(*[F.lit(x) for i, name in names.items() for x in (str(i), name)])
    document = labels.agg(zone_map.alias("zone_labels")).select(
        "zone_labels", name_map.alias("cluster_name_map"), F.array(*[F.lit(c) for c in columns]).alias("feature_cols"),
        round_exact(F.lit(float(silhouette)), 4).alias("silhouette_score"), F.lit(len(names)).alias("n_clusters"),
    )
    if inertia is not None:
        document = document.withColumn("inertia", round_exact(F.lit(float(inertia)), 4))
    if centroids is not None:
        record = F.struct("cluster", *columns, "hazard")
        table = centroids.agg(F.array_sort(F.collect_list(F.struct("hazard_rank", record.alias("r")))).alias("t"))
        document = document.withColumn("centroid_table", table.select(F.col("t.r")).scalar())
    return document


def write_label_metadata(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The saved pipeline, or nothing if there is none."""
    return PipelineModel.load(path) if path_exists(spark, path) else None
