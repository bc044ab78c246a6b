"""A classifier of graded ratings: cumulative-link (ordinal) regression on hashed text."""

from __future__ import annotations

import operator
import pickle
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm import text as T
from zonewise.session import checkpointed

BITS = 18
#: Labelled documents that the fit reads at most: an equal share of each grade, those with the smallest hash of their id.
SAMPLE = 8_000
#: Sampled documents that a task holds on average.
_PART_ROWS = 500
#: Steps of the fit at most, each a pass over the sample as a rule; the last ones that it remembers; and its decay.
STEPS, MEMORY, DECAY = 30, 8, 5e-4
#: The fit ends when no slope of the mean loss is larger.
_FLAT = 1e-6
#: Sampled documents that must share a feature for it to get a weight.
LEAST = 5
SELECT = 0.5
_GRID = float(1 << 34)
_DIGIT, _UPPER, _LOWER = (bytes(range(*r)) for r in ((48, 58), (65, 91), (97, 123)))
#: The kind of each byte: upper, lower, digit and beyond ASCII as one letter, punctuation as it is.
_KINDS = bytes(
    65 if b in _UPPER else 97 if b in _LOWER else 48 if b in _DIGIT else 122 if b >= 128 else b for b in range(256)
)


def grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null if a label is missing."""
    return F.when(toxic > 0, 0).when(quality.isNull() | toxic.isNull(), None).when(quality <= 0, 1).otherwise(2)


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values: each different word, and each beginning of 4 and 5 bytes, counts 1; each
    shape of a word (its kinds of bytes, shortened) and a repeat of the word before count their share of the words,
    times 8."""
    words, shapes, total, last = set(), {}, 0, None
    for piece in T.pieces(text or b""):
        words.update(piece.translate(T.WORD_TABLE).split())
        tokens = piece.split()
        total += len(tokens)
        kinds = piece.translate(_KINDS).split()
        for shape, n in Counter(k[:1] + k[-2:] if len(k) > 3 else k for k in kinds).items():
            shapes[shape] = shapes.get(shape, 0) + n
        again = sum(map(operator.eq, tokens, [last, *tokens[:-1]]))
        if again:
            shapes[b"again"] = shapes.get(b"again", 0) + again
        last = tokens[-1] if tokens else last
    begins = {b"\1" + w[:n] for w in words for n in (4, 5)}
    keys = [*words, *begins, *(b"\0" + s for s in shapes)]
    values = np.ones(len(keys))
    values[len(keys) - len(shapes):] = [8 * n / max(total, 1) for n in shapes.values()]
    return (T.word_hashes(keys) & np.uint64((1 << BITS) - 1)).astype(np.int64), values


@dataclass
class Ordinal:
    """Weights shared by all grades, and ordered thresholds: P(grade > k) = 1 / (1 + exp(thresholds[k] - score))."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """(rows, grades - 1): P(grade >= 1), P(grade >= 2), ... They never rise along a row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))

    def score(self, text: bytes | None) -> float:
        keys, values = features(text)
        return float(self.weights[keys] @ values)


def _part(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Rows (grade, keys, values, weight) as arrays: grades, weights, the row of each feature, keys, values."""
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[1]) for r in rows])
    keys = np.concatenate([np.zeros(0, np.int32), *(r[1] for r in rows)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.float32), *(r[2] for r in rows)]).astype(np.float32)
    return np.array([r[0] for r in rows], np.int32), np.array([r[3] for r in rows], float), row, keys, values


def _tally(parts: Iterable[tuple], grades: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that have each feature, the weight of each grade, and the number of rows."""
    having, weight, rows = np.zeros(1 << BITS, np.int32), np.zeros(grades), 0
    for y, w, _, keys, _ in parts:
        having += np.bincount(keys, minlength=1 << BITS).astype(np.int32)
        weight += np.bincount(y, w, grades)
        rows += len(y)
    return having, weight, rows


def _narrowed(part: tuple, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """A part with the common features only, numbered."""
    y, w, row, keys, values = part
    used, place = common[keys], (np.cumsum(common) - 1).astype(np.int32)
    return y, w, row[used], place[keys[used]], values[used]


def _thresholds(point: np.ndarray, n: int) -> np.ndarray:
    return point[n] + np.concatenate(([0.0], np.cumsum(np.exp(point[n + 1:]))))


def _losses(parts: Iterable[tuple], point: np.ndarray, n: int, grades: int) -> np.ndarray:
    """The loss and its slopes by weight and by threshold, summed over all rows of some narrowed parts.

    What is summed lies on a grid that is coarse enough for sums without rounding, so that their order does not matter.
    """
    theta = np.concatenate(([-np.inf], _thresholds(point, n), [np.inf]))
    out = np.zeros(1 + n + grades - 1)
    for y, w, row, at, values in parts:
        score = np.bincount(row, point[at] * values, len(y))
        upper, lower = (1 / (1 + np.exp(np.clip(score - theta[y + k], -500, 500))) for k in (1, 0))
        share = np.maximum(upper - lower, 1e-12)
        up, down = (np.rint(_GRID * w * x * (1 - x) / share) for x in (upper, lower))
        out[0] += np.rint(-_GRID * w * np.log(share)).sum()
        out[1:1 + n] += np.bincount(at, np.rint((up - down)[row] * values), n)
        out[1 + n:] += np.bincount(y, down, grades)[1:] - np.bincount(y, up, grades)[:-1]
    return out / _GRID


def _direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill, bent by what the last steps tell of the curvature (limited-memory BFGS)."""
    d, shares = -slope, []
    for s, y in reversed(steps):
        shares.append(s @ d / (s @ y))
        d = d - shares[-1] * y
    if steps:
        s, y = steps[-1]
        d = d * (s @ y / (y @ y))
    for (s, y), share in zip(steps, reversed(shares)):
        d = d + (share - y @ d / (s @ y)) * s
    return d


def _descended(losses: Callable[[np.ndarray], np.ndarray], keys: np.ndarray, weight: np.ndarray) -> Ordinal:
    """The most likely weights and thresholds, with a small decay of the weights, by a quasi-Newton descent;
    `losses` sums over all rows, once a step as a rule."""
    low = (np.cumsum(weight)[:-1] / weight.sum()).clip(1e-3, 1 - 1e-3)
    cuts, n = np.log(low / (1 - low)), len(keys)

    def seen(point):
        found = losses(point) / weight.sum()
        d_theta = found[1 + n:]
        slope = np.concatenate((
            found[1:1 + n] + DECAY * point[:n], [d_theta.sum()], np.exp(point[n + 1:]) * np.cumsum(d_theta[::-1])[::-1][1:]))
        return found[0] + DECAY / 2 * point[:n] @ point[:n], slope

    # the thresholds are the first cut and the logarithms of the gaps after it, so their order can't change
    point = np.concatenate((np.zeros(n), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))))
    loss, slope = seen(point)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        if np.abs(slope).max() <= _FLAT:
            break
        d = _direction(slope, steps)
        size = 1.0 if steps else 1 / max(np.abs(d).max(), 1.0)
        for _ in range(20):
            new, (new_loss, new_slope) = point + size * d, seen(point + size * d)
            if new_loss <= loss + 1e-4 * size * (slope @ d):
                break
            size /= 4
        else:
            break
        s, y = new - point, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-MEMORY:]
        point, loss, slope = new, new_loss, new_slope
    weights = np.zeros(1 << BITS)
    weights[keys] = point[:n]
    return Ordinal(weights, _thresholds(point, n))


def _highest(grades: int) -> Ordinal:
    """Without rows every document gets the highest grade."""
    return Ordinal(np.zeros(1 << BITS), np.linspace(-20, -10, grades - 1))


def fitted(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int = 3) -> Ordinal:
    """The fit of rows (grade, keys, values) that are at hand; `model` does the same where the rows are."""
    if not rows:
        return _highest(grades)
    part = _part([(*r, 1.0) for r in rows])
    having, weight, _ = _tally([part], grades)
    common = having >= min(LEAST, len(rows))
    part = _narrowed(part, common)
    keys = np.flatnonzero(common)
    return _descended(lambda point: _losses([part], point, len(keys), grades), keys, weight)


def _quotas(counts: dict[int, int], sample: int) -> dict[int, int]:
    """Rows of each grade in the sample: equal shares; what a rare grade leaves goes to the others."""
    out, left = {}, sample
    for k, (g, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[g] = min(n, left // (len(counts) - k))
        left -= out[g]
    return out


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, g, keys, values, weight): features of a bounded sample of the labelled documents, dealt out by id.

    Each grade gives its ids with the smallest hashes, up to its quota; weights make up for the grades' different
    shares, and are 1 on average.
    """
    graded = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), grade(F.col("quality"), F.col("toxic")).alias("g")) \
        .filter("doc_id IS NOT NULL AND g IS NOT NULL").groupBy("doc_id").agg(F.min("g").alias("g"))
    counts = {r.g: r.n for r in graded.groupBy("g").agg(F.count("*").alias("n")).collect()}
    quotas, total = _quotas(counts, sample), sum(counts.values())
    share = sum(quotas.values()) / max(total, 1)
    few = graded.limit(0).withColumn("weight", F.lit(0.0))
    for g, quota in sorted(quotas.items()):
        if quota:
            some = graded.filter(F.col("g") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(quota)
            few = few.union(some.withColumn("weight", F.lit(share * counts[g] / quota)))
    schema = pa.schema([("doc_id", pa.int64()), ("g", pa.int32()), ("weight", pa.float64()), ("keys", pa.list_(pa.int32())),
                        ("values", pa.list_(pa.float32()))])

    def one(batches):
        for b in batches:
            for low in range(0, b.num_rows, 500):
                part = b.slice(low, 500)
                found = [features(t.as_py()) for t in part.column(3)]
                yield T.batch(schema, *part.columns[:3], [k for k, _ in found], [v for _, v in found])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("t")) \
        .join(F.broadcast(few), "doc_id").select("doc_id", F.col("g").cast("int"), "weight", "t") \
        .mapInArrow(one, "doc_id bigint, g int, weight double, keys array<int>, values array<float>")
    # a repeated document counts once
    return rows.repartition(-(-sum(quotas.values()) // _PART_ROWS) or 1, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("g", "keys", "values", "weight")).alias("r")).select("doc_id", "r.*")


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The sample's rows (grade, keys, values) by id, for samples that fit the driver."""
    held = _sample(docs, labels, sample).toArrow().sort_by("doc_id")
    keys, values = (held.column(c).combine_chunks() for c in ("keys", "values"))
    return [(g, keys[k].values.to_numpy(), values[k].values.to_numpy()) for k, g in enumerate(held.column("g").to_pylist())]


def model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, grades: int = 3) -> Ordinal:
    """The fit of a bounded sample. Its rows stay with the tasks, which sum the slopes of each step; the driver holds
    a number for each feature."""
    T.small_batches(docs.sparkSession)
    schema = pa.schema([("part", pa.binary())])

    def pack(batches):
        for b in batches:
            g, keys, values, weight = b.columns
            rows = [(y, keys[k].values.to_numpy(), values[k].values.to_numpy(), w)
                    for k, (y, w) in enumerate(zip(g.to_pylist(), weight.to_pylist()))]
            if rows:
                yield T.batch(schema, [pickle.dumps(_part(rows))])

    packed = checkpointed(_sample(docs, labels, sample).sortWithinPartitions("doc_id").select("g", "keys", "values", "weight")
                          .mapInArrow(pack, "part binary"), "sample")
    parts = packed.rdd.map(lambda r: pickle.loads(r.part))

    def summed(rdd, of):
        """Each task's sums, added up."""
        return [sum(x[1:], x[0]) for x in zip(*rdd.mapPartitions(lambda it: [of(it)]).collect())]

    tallies = summed(parts, lambda it: _tally(it, grades))
    if not tallies or not tallies[2]:
        return _highest(grades)
    having, weight, rows = tallies
    common = having >= min(LEAST, rows)
    keys = np.flatnonzero(common)
    n = len(keys)
    narrowed = parts.map(lambda part: _narrowed(part, common)).persist()

    def losses(point):
        told = docs.sparkSession.sparkContext.broadcast(point)
        try:
            return summed(narrowed, lambda it: (_losses(it, told.value, n, grades),))[0]
        finally:
            told.destroy()

    try:
        return _descended(losses, keys, weight)
    finally:
        narrowed.unpersist()


def graded(docs: DataFrame, fit: Ordinal) -> DataFrame:
    """Per document: doc_id, score, expected_grade, tail_1 and tail_2 (P(grade >= 1), P(grade >= 2)), selected
    (tail_2 is SELECT or more).

    Null and empty texts have no features and a score of 0. Repeated rows give a row each; other columns are not
    read.
    """
    T.small_batches(docs.sparkSession)
    figures = ("score", "expected_grade", "tail_1", "tail_2")
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.float64()) for c in figures), ("selected", pa.bool_())])

    def one(batches):
        for b in batches:
            scores = np.array([fit.score(t.as_py()) for t in b.column(1)])
            if len(scores):
                tails = fit.tails(scores)
                yield T.batch(schema, b.column(0), scores, tails.sum(1), tails[:, 0], tails[:, -1], tails[:, -1] >= SELECT)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("t")).mapInArrow(
        one, "doc_id bigint, score double, expected_grade double, tail_1 double, tail_2 double, selected boolean")


def selected(docs: DataFrame, fit: Ordinal) -> DataFrame:
    """The documents that the classifier selects, as they are; one pass without a shuffle."""
    T.small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def one(batches):
        for b in batches:
            scores = np.array([fit.score(t.as_py()) for t in b.column(at).cast(pa.binary())])
            if len(scores):
                yield b.filter(pa.array(fit.tails(scores)[:, -1] >= SELECT))

    return docs.mapInArrow(one, docs.schema)
