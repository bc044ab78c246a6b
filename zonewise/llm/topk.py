"""Exact search for the k largest inner products, with an index of pivots and distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewise.llm import text as T
from zonewise.session import checkpointed

#: Vectors whose pivots are chosen, pivots, and rows of a block.
SAMPLE, PIVOTS, BLOCK = 4_096, 32, 2_048
_BLOCKS = pa.schema([
    ("block", pa.int64()), ("pivot", pa.int32()), ("near", pa.float64()), ("far", pa.float64()), ("ids", pa.binary()), ("data", pa.binary())])
_BLOCK_DDL = "block bigint, pivot int, near double, far double, ids binary, data binary"


def vectors(table: DataFrame, id_column: str, vector_column: str, scale: float = 64) -> DataFrame:
    """(id, v): floor(scale * x) of each component x. Vectors that are null or hold a null or non-finite component
    are left out, as are those without an id; repeated rows count once."""
    x = F.col(vector_column).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("double"))
    return table.select(F.col(id_column).cast("bigint").alias("id"), whole.alias("v"), sound.alias("ok")) \
        .filter("id IS NOT NULL AND ok").select("id", "v").distinct()


def pivots(rows: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Vectors far from each other, from the `sample` vectors with the smallest hashes. They bear on speed alone."""
    held = [r.v for r in rows.orderBy(F.xxhash64("id", "v"), "id").limit(sample).collect()]
    if not held:
        return np.zeros((1, 1))
    points = _matrix(held, max(map(len, held)))
    chosen, gap = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for at, r in enumerate(rows):
        out[at, :len(r)] = r
    return out


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((points ** 2).sum(1)[:, None] + (to ** 2).sum(1)[None, :] - 2 * points @ to.T, 0))


def _stored(points: np.ndarray) -> bytes:
    """Two bytes a component where they suffice, else eight; the size tells which."""
    small = np.abs(points).max(initial=0) < 1 << 15
    return points.astype(np.int16 if small else np.float64).tobytes()


def _loaded(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int16 if len(data) == 2 * rows * width else np.float64).reshape(rows, width).astype(float)


def indexed(rows: DataFrame, fixed: np.ndarray, by_pivot: bool = True, block: int = BLOCK) -> DataFrame:
    """Blocks of at most `block` vectors sorted by their nearest pivot and their distance from it; with `by_pivot` a
    block is an annulus of one pivot.

    Vectors are dealt out by ranges of (pivot, distance), so a pivot may have any number of them.
    """
    width = fixed.shape[1]
    keyed_ddl = "id bigint, pivot int, distance double, data binary"
    keyed_schema = pa.schema([("id", pa.int64()), ("pivot", pa.int32()), ("distance", pa.float64()), ("data", pa.binary())])

    def key(batches):
        for b in batches:
            if b.num_rows:
                points = _matrix([r.values.to_numpy(zero_copy_only=False) for r in b.column(1)], width)
                away = _distances(points, fixed)
                nearest = away.argmin(1)
                yield T.batch(keyed_schema, b.column(0), nearest, away[np.arange(len(points)), nearest], [p.tobytes() for p in points])

    def pack(batches):
        held, made = [], 0

        def out():
            points = np.frombuffer(b"".join(r[3] for r in held)).reshape(-1, width)
            return T.batch(
                _BLOCKS, [(held[0][4] << 40) + made], [held[0][1]], [held[0][2]], [held[-1][2]],
                [np.array([r[0] for r in held], np.int64).tobytes()], [_stored(points)])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (len(held) == block or by_pivot and row[1] != held[0][1]):
                    yield out()
                    held, made = [], made + 1
                held.append(row)
        if held:
            yield out()

    order = ["pivot", "distance", "id"]
    tasks = 1 + rows.count() // (4 * block)
    keyed = rows.mapInArrow(key, keyed_ddl).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return checkpointed(keyed.withColumn("task", F.spark_partition_id().cast("bigint")).mapInArrow(pack, _BLOCK_DDL), "index")


def _bounds(queries: np.ndarray, pivot: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """(queries, annuli): no vector x of an annulus around its pivot p has a larger product with q.

    d(q, x) >= max(d(q, p) - far, near - d(q, p)) by the triangle inequality, and q.x = q.p + q.(x - p) <= q.p + |q|
    far. The first bounds q.x = (|q|^2 + |x|^2 - d^2) / 2 with |x| <= |p| + far. Half a unit more allows for
    rounding: products are whole.
    """
    length, away = np.linalg.norm(queries, axis=1)[:, None], _distances(queries, pivot)
    gap = np.maximum(np.maximum(away - far[None, :], near[None, :] - away), 0)
    reach = np.linalg.norm(pivot, axis=1)[None, :] + far[None, :]
    bound = np.minimum(queries @ pivot.T + length * far[None, :], (length ** 2 + reach ** 2 - gap ** 2) / 2)
    return bound * (1 + 1e-9) + 0.5


def _products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Whole inner products, exact: in doubles where they fit, else in integers of any size."""
    if np.abs(queries).max(initial=0) * np.abs(points).max(initial=0) * queries.shape[1] < 2 ** 52:
        return (queries @ points.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in points], object).T
    return big.astype(np.int64)


def _routes(asked: DataFrame, index: DataFrame, fixed: np.ndarray) -> DataFrame:
    """(q, block, high, bound): for each block of queries and each annulus the bound of every query, and the
    highest.

    The annuli of a pivot come in lists, and a block of queries meets the lists of each pivot.
    """
    ddl = "q bigint, block bigint, high double, bound binary"
    schema = pa.schema([("q", pa.int64()), ("block", pa.int64()), ("high", pa.float64()), ("bound", pa.binary())])
    width = fixed.shape[1]

    def bounds(batches):
        for b in batches:
            for q, ids, data, pivot, annuli in zip(*(c.to_pylist() for c in b.columns)):
                queries = _loaded(data, len(ids) // 8, width)
                found = _bounds(queries, fixed[[pivot]], *(np.array([x[c] for x in annuli]) for c in ("near", "far")))
                yield T.batch(schema, [q] * len(annuli), [x["block"] for x in annuli], found.max(0), [c.tobytes() for c in found.T])

    lists = index.groupBy("pivot", F.pmod(F.xxhash64("block"), F.lit(256)).alias("part")).agg(
        F.collect_list(F.struct("block", "near", "far")).alias("annuli"))
    every = asked.select("q", "ids", "data", F.explode(F.sequence(F.lit(0), F.lit(len(fixed) - 1))).alias("pivot"))
    joined = every.join(lists, "pivot").select("q", "ids", "data", "pivot", "annuli")
    return checkpointed(joined.mapInArrow(bounds, ddl), "routes")


def _compared(pairs: DataFrame, asked: DataFrame, index: DataFrame, width: int, k: int, share: int) -> DataFrame:
    """(q, query_id, vec_id, score): the k best of each query in the annuli that its block is paired with (q, block,
    high, bound, floor).

    A block of queries goes through its annuli from the highest bound down, in runs of about `share` that each task
    takes one of, and skips those whose bounds are below the k-th score that its queries have already.
    """
    ddl = "q bigint, query_id bigint, vec_id bigint, score bigint"
    schema = pa.schema([(c, pa.int64()) for c in ("q", "query_id", "vec_id", "score")])
    lowest = -(1 << 63)

    def least(found, count, floor):
        """What each query still needs: its k-th score, or `floor`."""
        out = floor.copy()
        at, _, scores = found
        ends = np.searchsorted(at, np.arange(count), "right") - 1
        full = np.bincount(at, minlength=count) == k
        out[full] = np.maximum(out[full], scores[ends[full]])
        return out

    def compare(batches):
        key, found, ids, q = None, None, None, None

        def out():
            return T.batch(schema, np.full(len(found[0]), q), ids[found[0]], found[1], found[2])

        for b in batches:
            for q_, run, bound, floor, q_ids, q_data, v_ids, v_data in zip(*b.columns):
                if (q_.as_py(), run.as_py()) != key:
                    if key is not None and len(found[0]):
                        yield out()
                    key = q, _ = q_.as_py(), run.as_py()
                    ids = np.frombuffer(q_ids.as_py(), np.int64)
                    queries = _loaded(q_data.as_py(), len(ids), width)
                    start = np.frombuffer(floor.as_py(), np.int64) if floor.as_py() is not None else np.full(len(ids), lowest)
                    found = tuple(np.zeros(0, np.int64) for _ in range(3))
                need = least(found, len(ids), start)
                use = np.flatnonzero(np.frombuffer(bound.as_py()) >= need)
                if not len(use):
                    continue
                names = np.frombuffer(v_ids.as_py(), np.int64)
                scores = _products(queries[use], _loaded(v_data.as_py(), len(names), width))
                row, at = np.nonzero((scores >= need[use][:, None]) & (names[None, :] != ids[use][:, None]))
                found = tuple(np.concatenate(x) for x in zip(found, (use[row], names[at], scores[row, at])))
                order = np.lexsort((found[1], -found[2], found[0]))
                found = tuple(x[order] for x in found)
                rank = np.arange(len(order)) - np.searchsorted(found[0], found[0])
                found = tuple(x[rank < k] for x in found)
        if key is not None and len(found[0]):
            yield out()

    q_rows = asked.select("q", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    runs = 1 + index.count() // share
    dealt = pairs.withColumn("run", F.pmod(F.xxhash64("block"), F.lit(runs))).join(q_rows, "q").join(index, "block") \
        .repartition("q", "run").sortWithinPartitions("q", "run", F.desc("high"), "block")
    return dealt.select("q", "run", "bound", "floor", "q_ids", "q_data", "ids", "data").mapInArrow(compare, ddl)


def top_k(
    table: DataFrame, id_column: str, vector_column: str, is_query: str, k: int = 20, scale: float = 64, block: int = BLOCK,
    share: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `is_query` picks (a condition on `id`), the `k` largest
    inner products with vectors of other ids, ties to the smaller id; all, if there are fewer.

    Queries travel in blocks of near neighbours. Each block first looks into the annulus with the highest bound,
    which gives its queries a k-th score to begin with; then it goes through the annuli whose bound reaches that
    score for one of its queries, from the highest bound down, and stops looking where bounds fall below the k-th
    score. Every vector is indexed. Components beyond a vector's length count as 0, scores must fit a long, equal
    rows count once, and rows that share an id are candidates each. An empty table gives no rows.
    """
    rows = checkpointed(vectors(table, id_column, vector_column, scale), "vectors")
    width = max(rows.agg(F.max(F.size("v"))).first()[0] or 1, 1)
    fixed = pivots(rows)
    fixed = _matrix(fixed, width)
    index = indexed(rows, fixed, True, block)
    asked = indexed(rows.filter(is_query), fixed, False, block).withColumnRenamed("block", "q")
    routes = _routes(asked, index, fixed)
    first = routes.groupBy("q").agg(F.max_by("block", F.struct("high", "block")).alias("block"))
    none = F.lit(None).cast("binary").alias("floor")
    begun = _compared(routes.join(first, ["q", "block"]).select("*", none), asked, index, width, k, share)

    reached = begun.groupBy("q", "query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).filter(F.col("n") == k)
    known = checkpointed(reached.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "s"))).alias("known")), "floors")
    ddl = "q bigint, block bigint, high double, bound binary, floor binary"
    schema = pa.schema([("q", pa.int64()), ("block", pa.int64()), ("high", pa.float64()), ("bound", pa.binary()), ("floor", pa.binary())])

    def still_open(batches):
        for b in batches:
            for q, at, high, bound, ids, floors in zip(*b.columns):
                floors = dict(floors.as_py() or [])
                floor = np.array([floors.get(i, -(1 << 63)) for i in np.frombuffer(ids.as_py(), np.int64).tolist()], np.int64)
                if (np.frombuffer(bound.as_py()) >= floor).any():
                    yield T.batch(schema, [q.as_py()], [at.as_py()], [high.as_py()], [bound.as_py()], [floor.tobytes()])

    opened = routes.join(asked.select("q", "ids"), "q").join(known, "q", "left") \
        .select("q", "block", "high", "bound", "ids", "known").mapInArrow(still_open, ddl)
    pairs = _compared(opened, asked, index, width, k, share).select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
