"""Measured throughput and lag of running queries: a listener that keeps every report in a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from zonewise.functions.labels import lag_bucket
from zonewise.operators.report import recent_history
from zonewise.schemas import PROGRESS
from zonewise.sinks.tables import TTL_SECONDS, bounded_history

#: Reports that are written together.
HELD = 100


class Reports(StreamingQueryListener):
    """Appends every progress report of the session's queries to a table under `path`, until `stop`.

    It runs beside the queries, on the driver, and writes a file for HELD reports and at the end of each query. Spark
    itself keeps the last 100 reports of a query only.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._held: list[tuple] = []
        self._names: dict[str, str] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.RLock()

    def start(self) -> "Reports":
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def called(self, query: StreamingQuery, name: str) -> None:
        """Report a query under a name of its own."""
        with self._lock:
            self._names[str(query.runId)] = name

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        if not report["numInputRows"]:
            return
        late = sum(op.get("numRowsDroppedByWatermark", 0) for op in report["stateOperators"])
        row = (report["runId"], report["name"], report["batchId"], report["timestamp"], report["numInputRows"],
               float(report.get("processedRowsPerSecond") or 0), report["durationMs"].get("triggerExecution"), late)
        with self._lock:
            self._held.append(row)
            if len(self._held) >= HELD:
                self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # events come in order, so all reports of the run are there
        self.flush()
        self._end(str(event.runId)).set()

    def flush(self) -> None:
        with self._lock:
            if self._held:
                rows = [(self._names.get(run, name), *rest) for run, name, *rest in self._held]
                self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
                self._held = []

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until a query has ended and all its reports are in the table."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the query's last reports haven't come")

    def read(self) -> DataFrame:
        """One row per micro-batch that read data, with its lag class; of a batch that ran again the last report."""
        from zonewise.sources.files import path_exists
        if not path_exists(self.spark, self.path):
            rows = self.spark.createDataFrame([], PROGRESS)
        else:
            rows = self.spark.read.schema(PROGRESS).parquet(self.path)
        rest = [c for c in rows.columns if c not in ("name", "batch")]
        newest = rows.groupBy("name", "batch").agg(F.max_by(F.struct(*rest), "ts").alias("r")).select("name", "batch", "r.*")
        return newest.withColumn("lag_class", lag_bucket(F.col("duration_ms")))


def history(reports: DataFrame, shown: int = 15, kept: int = 20, now: Column | None = None) -> DataFrame:
    """The newest points, in order of time, out of a history that is bounded in length and age."""
    points = reports.withColumn("ts", F.to_timestamp("ts"))
    return recent_history(bounded_history(points, "ts", kept, TTL_SECONDS["history"], now), "ts", shown)
