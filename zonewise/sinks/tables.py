"""Stored results in a shared folder: versions that replace each other, bounded history, batch snapshots.

Keyed state with expiry is not kept here but in the state store (`streaming.state`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.sources.files import list_folder, path_exists, remove_folder

# Seconds a stored value lives.
TTL_SECONDS = {
    "zone_score": 300, "cluster_label": 300, "warm_start_label": 3_600, "offline_label": 86_400,
    "exposure": 60, "worker_zone": 300, "weather": 300, "recommendation": 300, "cycle_exposure": 86_400,
    "model_state": 86_400, "history": 3_600, "zone_ranking": 300,
}


@dataclass(frozen=True)
class Snapshots:
    """A small table that each run writes anew under its number, from the version before.

    A run that is repeated replaces its own version. The version before stays for readers; older ones go, so no more
    than a few folders are ever listed.
    """

    spark: SparkSession
    path: str

    def _at(self, n: int) -> str:
        return f"{self.path}/n={n}"

    def write(self, rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(self._at(n))
        for old in [v for v in self.versions() if v < n][:-1]:
            remove_folder(self.spark, self._at(old))

    def has(self, n: int) -> bool:
        return path_exists(self.spark, f"{self._at(n)}/_SUCCESS")

    def versions(self) -> list[int]:
        return sorted(int(name.removeprefix("n=")) for name in list_folder(self.spark, self.path))

    def newest(self, schema: T.StructType, before: int | None = None) -> DataFrame | None:
        """The newest finished version, or the newest before a number."""
        for n in reversed(self.versions()):
            if (before is None or n < before) and self.has(n):
                return self.spark.read.schema(schema).parquet(self._at(n))
        return None


def bounded_history(rows: DataFrame, time: str = "ts", n: int = 20, max_age_seconds: int | None = None,
                    now: Column | None = None) -> DataFrame:
    """The newest n points that are young enough."""
    if max_age_seconds is not None:
        moment = F.current_timestamp() if now is None else now
        rows = rows.filter(F.col(time) > moment - F.make_dt_interval(secs=F.lit(max_age_seconds)))
    return rows.orderBy(F.desc(time)).limit(n)


def write_snapshot(rows: DataFrame, path: str, query: str, batch_id: int, file_format: str = "parquet") -> None:
    """The rows of one batch under (query, batch_id); running the batch again replaces them."""
    rows.write.mode("overwrite").format(file_format).save(f"{path}/query={query}/batch_id={batch_id}")
