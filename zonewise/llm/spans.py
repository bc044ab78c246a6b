"""Places inside documents: sent out with rows, and brought back to the texts they belong to."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG_BITS, AT_BITS = 20, 40


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, t): the text as bytes, and 20 bits of its hash, so that rows that share an id are told apart."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").bitwiseAND(F.lit((1 << _TAG_BITS) - 1)).alias("tag"), F.col("text").cast("binary").alias("t"))


def compressed(batches):
    for b in batches:
        texts = pa.array([zstandard.compress(t.as_py() or b"", 3) for t in b.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns[:2], texts], names=["doc_id", "tag", "t"])


def text_of(compressed: bytes) -> bytes:
    return zstandard.decompress(compressed)


def place(tag: int, at: int) -> int:
    return tag << AT_BITS | at


def with_marks(rows: DataFrame, marks: DataFrame, how: str = "left") -> DataFrame:
    """(doc_id, t, places, counts): each text, compressed, with its marks (doc_id, at, n), whose `at` was made by
    `place`.

    A document's marks are at most as many as its words or bytes, so they may meet in one row.
    """
    by_doc = marks.groupBy("doc_id", F.shiftright("at", AT_BITS).alias("tag")).agg(F.collect_list(F.struct("at", "n")).alias("m"))
    packed = rows.mapInArrow(compressed, rows.schema)
    return packed.join(by_doc, ["doc_id", "tag"], how).select(
        "doc_id", "t", F.col("m.at").alias("places"), F.col("m.n").alias("counts"))


def offsets(places: list[int]) -> np.ndarray:
    return np.array(places, np.int64) & ((1 << AT_BITS) - 1)
