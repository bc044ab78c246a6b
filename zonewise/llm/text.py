"""Small helpers for operators that look at whole texts inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession

#: Bytes of text that a task turns into words or arrays at a time.
PART_BYTES = 2 << 20
#: Rows of an Arrow batch of texts.
ROWS_PER_BATCH = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
WHITE = b"\t\n\x0b\x0c\r "

#: A-Z in lower case, every ASCII byte that is neither a letter nor a digit as a space.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def small_batches(spark: SparkSession) -> None:
    """Texts are long rows: Arrow hands a task ROWS_PER_BATCH at a time, unless the session asks for fewer."""
    if int(spark.conf.get(_BATCH_CONF)) > ROWS_PER_BATCH:
        spark.conf.set(_BATCH_CONF, str(ROWS_PER_BATCH))


def pieces(text: bytes, size: int = PART_BYTES) -> Iterator[bytes]:
    """The text in pieces of about `size` bytes, cut before white space, so that no word is cut."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        found = [text.find(bytes([c]), cut, cut + 4096) for c in WHITE]
        found = [f for f in found if f >= 0] or [f for c in WHITE if (f := text.find(bytes([c]), cut)) >= 0]
        if not found:
            break
        yield text[at:min(found)]
        at = min(found)
    yield text[at:] if at else text


def parts(sizes: list[int], size: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `size` bytes each, one row at least."""
    low = total = 0
    for at, n in enumerate(sizes):
        if at > low and total + n > size:
            yield low, at
            low, total = at, 0
        total += n
    if low < len(sizes):
        yield low, len(sizes)


def words_of(texts: list[bytes | None]) -> list[list[bytes]]:
    """Words between white space (x20, x09-x0D) of each text; a null has none."""
    return [text.split() if text else [] for text in texts]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def chain(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A number for each run of `length` consecutive hashes."""
    n = len(hashes) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for j in range(length):
            out = out * np.uint64(base) + hashes[j:j + n]
    return mix(out)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching intervals as one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return starts[first], reach[np.concatenate((first[1:] - 1, [len(reach) - 1]))]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
