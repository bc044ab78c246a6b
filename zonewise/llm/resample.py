"""Importance resampling: documents drawn as if they came from a target's distribution of hashed n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm import text as T
from zonewise.llm.order import numbered
from zonewise.session import checkpointed

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Text whose n-grams are interned together.
PART_BYTES = 1 << 20
_ROWS = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("buckets", pa.binary()),
                   ("of", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
_ROWS_DDL = "ids array<bigint>, sizes array<bigint>, buckets binary, of array<int>, counts array<bigint>"


class Interned:
    """The different n-grams among some occurrences, in an open-addressed table.

    A slot is found from an n-gram's xxhash64 and taken over by the first n-gram that finds it free; others of the
    same hash share it only if their bytes are equal, and go on to the next slot if not. Arrays by slot: `count`,
    `bucket`; by occurrence: `slot`.
    """

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, buckets: int) -> None:
        size = 1 << max(4, (2 * len(keys)).bit_length())
        owner = np.full(size, -1, np.int32)
        self.slot = np.zeros(len(keys), np.int32)
        lanes = np.lib.stride_tricks.as_strided(np.frombuffer(data + bytes(8), np.uint8), (len(data) + 1, 8), (1, 1))
        open_, at = np.arange(len(keys), dtype=np.int32), (keys & np.uint64(size - 1)).astype(np.int32)
        while len(open_):
            free = owner[at] < 0
            owner[at[free]] = open_[free]
            holder = owner[at]
            same = (holder == open_) | (keys[holder] == keys[open_])
            same[same] = self._equal(lanes, starts, ends, open_[same], holder[same])
            self.slot[open_[same]] = at[same]
            open_, at = open_[~same], (at[~same] + 1) & (size - 1)
        used = np.flatnonzero(owner >= 0)
        first = owner[used]
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.uint16)
        self.bucket[used] = np.array([zlib.crc32(data[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist())], np.int64) % buckets

    @staticmethod
    def _equal(lanes: np.ndarray, starts: np.ndarray, ends: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the bytes of occurrences `one` and `two` are equal, eight at a time."""
        size = ends[one] - starts[one]
        equal = size == ends[two] - starts[two]
        todo, at = np.flatnonzero(equal & (one != two)), 0
        while len(todo):
            left = np.minimum(size[todo] - at, 8)
            a, b = (np.ascontiguousarray(lanes[starts[x[todo]] + at]).view("<u8")[:, 0] for x in (one, two))
            off = (8 * (8 - left)).astype(np.uint64)
            equal[todo] = (a << off) == (b << off)
            at += 8
            todo = todo[equal[todo] & (size[todo] > at)]
        return equal


def _stretches(texts: list[bytes | None]) -> Iterator[list[tuple[int, list[bytes], int]]]:
    """Lists of (row, words, 1 if the first word only leads to the second), some MB of text each."""
    held, total = [], 0
    for row, text in enumerate(texts):
        last: list[bytes] = []
        for piece in T.pieces(text or b""):
            words = piece.translate(T.WORD_TABLE).split()
            if words:
                held.append((row, last + words, len(last)))
                last = words[-1:]
            total += len(piece)
            if total >= PART_BYTES:
                yield held
                held, total = [], 0
    yield held


def _features(stretch: list[tuple[int, list[bytes], int]], buckets: int) -> tuple[Interned, np.ndarray]:
    """The interned runs of one and two words, and the row of each occurrence."""
    words = [w for _, ws, _ in stretch for w in ws]
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words)]
    sizes = np.array([len(ws) for _, ws, _ in stretch], np.int64)
    rows = np.repeat(np.array([r for r, _, _ in stretch], np.int64), sizes)
    first = np.cumsum(sizes) - sizes
    leads = np.zeros(len(words), bool)
    leads[first[np.array([lead for _, _, lead in stretch], bool)]] = True
    begins = np.zeros(len(words), bool)
    begins[first] = True
    one, two = np.flatnonzero(~leads), np.flatnonzero(~begins)
    single = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[one]
    pairs = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(words, words[1:]))), np.uint64, max(len(words) - 1, 0))[two - 1]
    found = Interned(data, np.concatenate((starts[one], starts[two - 1])), np.concatenate((ends[one], ends[two])),
                     np.concatenate((single, pairs)), buckets)
    return found, np.concatenate((rows[one], rows[two]))


def hashed(docs: DataFrame, doc_id: str | None = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """The features of all texts, written as a table: for some documents at a time their ids, numbers of features and
    the bucket of every feature in two bytes; and a row of bucket counts for each task. A text is split here and
    nowhere else."""
    if buckets > 1 << 16:
        raise ValueError("a bucket takes two bytes")
    T.small_batches(docs.sparkSession)

    def one(batches):
        counts = np.zeros(buckets, np.int64)
        for b in batches:
            rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)]
            for stretch in _stretches(b.column(1).to_pylist()):
                if stretch:
                    interned, at = _features(stretch, buckets)
                    # counts are below 2^53, so sums in doubles are exact
                    counts += np.bincount(interned.bucket, interned.count, buckets).astype(np.int64)
                    rows.append(at)
                    found.append(interned.bucket[interned.slot])
            at, of = np.concatenate(rows), np.concatenate(found)
            order = np.argsort(at, kind="stable")
            yield T.batch(_ROWS, [b.column(0).to_pylist()], [np.bincount(at, minlength=b.num_rows)], [of[order].tobytes()], [None], [None])
        yield T.batch(_ROWS, [None], [None], [None], [np.flatnonzero(counts).astype(np.int32)], [counts[counts > 0]])

    id_column = F.col(doc_id) if doc_id else F.lit(None)
    rows = docs.select(id_column.cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    return checkpointed(rows.mapInArrow(one, _ROWS_DDL), "features")


def bucket_counts(features: DataFrame) -> dict[int, int]:
    """Occurrences by bucket of `hashed` features. The driver gets a number for each bucket."""
    rows = features.select(F.explode(F.arrays_zip("of", "counts")).alias("x")).groupBy("x.of").agg(F.sum("x.counts").alias("n"))
    return {r.of: r.n for r in rows.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """By bucket: a thousandfold the logarithm of how much more often the target has it, each bucket counted once more."""
    all_source, all_target = sum(source.values()) + buckets, sum(target.values()) + buckets
    return np.array([math.floor(1000 * math.log((target.get(k, 0) + 1) * all_source / ((source.get(k, 0) + 1) * all_target)))
                     for k in range(buckets)], np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the mean gain of a document's features, rounded down; 0 without any."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])

    def one(batches):
        for b in batches:
            for ids, sizes, buckets in zip(*b.columns):
                n, reach = np.array(sizes.as_py(), np.int64), np.frombuffer(buckets.as_py(), np.uint16)
                sums = np.concatenate(([0], np.cumsum(gain[reach])))
                ends = np.cumsum(n)
                total = sums[ends] - sums[ends - n]
                # features are words and the pairs between them
                yield T.batch(schema, ids.values, (n + 1) // 2, n, total // np.maximum(n, 1))

    return features.filter("buckets IS NOT NULL").select("ids", "sizes", "buckets").mapInArrow(
        one, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousandfold Gumbel variable, rounded down, that the seed and the id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of `docs` (doc_id, text).

    Features are runs of one and two words in lower case, hashed into BUCKETS. The score is the weight and a Gumbel
    variable, so the highest scores are a sample without replacement in proportion to exp(weight / 1000). Of the
    documents with at least `least` words, `percent` in a hundred, rounded down, are drawn and ranked from 1, ties by
    smaller doc_id; the others have no rank.

    Null and empty texts have no features, weight 0, and are not drawn. A row without an id counts like any other; its
    noise is that of an empty id. Repeated rows are rows of their own. Other columns are not read. An empty target
    or table is fine.
    """
    features = hashed(docs)
    gain = gains(bucket_counts(features), bucket_counts(hashed(target, None)))
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    rows = checkpointed(weighted(features, gain).withColumn("score", score), "weights")
    able = F.col("n_words") >= least
    quota = rows.filter(able).count() * percent // 100
    ranked = numbered(rows.filter(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    rank = F.when(F.col("place") < quota, F.col("place") + 1).cast("bigint")
    return ranked.withColumn("rank", rank).drop("place").union(rows.filter(~able).withColumn("rank", F.lit(None).cast("bigint")))
