"""JSON topic streams: any streaming source that delivers `value` (and optionally a broker timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Options to ask for by name: a rate limit and passing over lost data. Neither is on by default.
LIVE_ONLY = {"startingOffsets": "latest"}
RATE_LIMITED = {"maxOffsetsPerTrigger": "10000"}
SKIP_LOST_DATA = {"failOnDataLoss": "false"}


def parse_json(
    raw: DataFrame, schema: T.StructType, value: str = "value", arrival: str = "ingest_ts", keep: list[str] | None = None
) -> DataFrame:
    """The payload's columns, `event_time` and `_is_malformed`.

    A message that is not JSON becomes a row of nulls and is kept; one bad field is null by itself. Event
    time is the payload's timestamp, else the arrival time.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col(value).cast("string")
    parsed = raw.select(
        F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"), arrival, *(keep or [])
    )
    nothing_read = F.coalesce(*[F.col(f"d.{f.name}").cast("string") for f in schema.fields]).isNull()
    malformed = F.col("d._corrupt").isNotNull() & nothing_read
    return parsed.select(
        *[F.col(f"d.{f.name}") for f in schema.fields], arrival, *(keep or []), malformed.alias("_is_malformed")
    ).withColumn("event_time", F.coalesce(F.try_to_timestamp(F.col("timestamp")), F.col(arrival)))


def read_topic(
    spark: SparkSession, schema: T.StructType, source: str = "kafka", topic: str | None = None,
    path: str | None = None, **options: str,
) -> DataFrame:
    """A topic as a stream. `source` "kafka" needs the connector on the class path and
    `kafka__bootstrap__servers` (and, if wanted, `LIVE_ONLY`, `RATE_LIMITED`, `SKIP_LOST_DATA`); "text" reads files with one message per line, as the tests do."""
    given = {key.replace("__", "."): str(value) for key, value in options.items()}
    if source == "kafka":
        reader = spark.readStream.format("kafka").options(**given).option("subscribe", topic)
        return parse_json(reader.load().withColumnRenamed("timestamp", "ingest_ts"), schema)
    stream = spark.readStream.format(source).options(**given)
    lines = stream.load(path) if path else stream.load()
    return parse_json(lines.withColumn("ingest_ts", F.current_timestamp()), schema)
