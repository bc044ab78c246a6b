"""Silhouette with Euclidean distances.

The definition needs the distance of every row to every other row. Rows are hashed into blocks of bounded
size; every row visits every block, and a visit leaves only one sum per cluster, never the single
distances. Memory per task is one block, and the work spreads over blocks and rows. For row counts where
quadratic work is out of the question use `silhouette_squared`, which is another measure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = 1e9  # distances are added up in units of 1e-9, so the sums do not depend on their order


def silhouette_rows(
    points: DataFrame, columns: list[str], key: str = "zone_id", label: str = "label", block_rows: int = 1024
) -> DataFrame:
    """(key, label, n_in_cluster, a, b, silhouette) per row; 0 for the only row of a cluster."""
    base = points.select(key, F.col(label).alias("label"), *columns)
    n_blocks = base.agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).alias("n")).scalar()
    blocked = base.withColumn("_block", F.pmod(F.xxhash64(key), n_blocks))
    members = blocked.groupBy("_block", F.col("label").alias("other")).agg(
        F.collect_list(F.struct(*columns)).alias("_members")
    )
    visits = base.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks - F.lit(1))))

    def distance_units(member):
        squares = [(F.col(c) - member[c]) * (F.col(c) - member[c]) for c in columns]
        return F.rint(F.sqrt(reduce(lambda a, b: a + b, squares)) * F.lit(_UNITS)).cast("bigint")

    partial = visits.join(members, "_block").select(
        key, "label", "other", F.size("_members").cast("bigint").alias("_n"),
        F.aggregate("_members", F.lit(0).cast("bigint"), lambda acc, m: acc + distance_units(m)).alias("_sum"),
    )
    per_cluster = partial.groupBy(key, "label", "other").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    own = F.col("other") == F.col("label")
    mean_other = F.col("_sum").cast("double") / (F.col("_n").cast("double") * F.lit(_UNITS))
    # the distance to itself is 0, so only the count leaves the row out
    others_in_own = F.nullif(F.col("_n") - F.lit(1), F.lit(0)).cast("double")
    sides = per_cluster.groupBy(key, "label").agg(
        F.max(F.when(own, F.col("_n"))).alias("n_in_cluster"),
        F.max(F.when(own, F.col("_sum").cast("double") / (others_in_own * F.lit(_UNITS)))).alias("a"),
        F.min(F.when(~own, mean_other)).alias("b"),
    )
    larger = F.nullif(F.greatest("a", "b"), F.lit(0.0))
    value = F.coalesce((F.col("b") - F.col("a")) / larger, F.lit(0.0))
    return sides.withColumn("silhouette", F.when(F.col("n_in_cluster") > 1, value).otherwise(F.lit(0.0)))


def silhouette_mean(rows: DataFrame) -> DataFrame:
    return rows.agg(F.avg("silhouette").alias("silhouette"))


def silhouette_squared(points: DataFrame, columns: list[str], label: str = "label") -> float:
    """Silhouette with squared Euclidean distances, in one linear pass. Not comparable with the above."""
    assembled = VectorAssembler(inputCols=columns, outputCol="_features").transform(points)
    return ClusteringEvaluator(
        featuresCol="_features", predictionCol=label, metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(assembled)
