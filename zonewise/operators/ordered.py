"""Ordered scans over keys of any size.

A window over `partitionBy(key)` puts the whole history of a key into one task, which fails once one
sensor or zone holds a large share of the rows. The functions here sort all rows by (key, order) across the
tasks instead, so that a key which holds most of them lies in many tasks, one after the other:

1. one exchange by ranges of (key, order), and a sort in each task,
2. each task goes once through its rows, Arrow batch by Arrow batch, and scans them as if nothing came before;
   the result is written to the shared folder,
3. of every task its first row and its last tell what the next one starts from: a few values a task, which the
   driver chains,
4. rows of the key that a task begins with take what was carried to them, row by row.

No join is needed, and no window, which would shuffle all rows again. `order` must be a unique number within its key
(see `order_key`).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from zonewise.session import checkpointed

_ORDER, _TASK, _HEAD, _EDGE = "_order", "_task", "_head", "_edge"
#: Marks of a row: the first of its task, the last, and the last of a task with a single key.
_FIRST, _LAST, _ONLY = 1, 2, 4
_MOST = float(1 << 62)

# executors need not have this package installed: its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Fill:
    """The last value that isn't null."""

    def __init__(self, length: int) -> None:
        self.before: pa.Scalar | None = None

    def scan(self, values: pa.Array, starts: np.ndarray) -> pa.Array:
        rows = np.arange(len(values))
        seen = np.maximum.accumulate(np.where(np.asarray(pc.is_valid(values)), rows, -1))
        found, outside = seen >= np.maximum(starts, 0), len(values)
        # rows of the key that goes on from the batch before take its value, which stands at the end
        carried = (starts < 0) & ~found
        before = pa.array([None if self.before is None else self.before.as_py()], values.type)
        source = pa.concat_arrays([values, before])
        out = source.take(pa.array(np.where(found, seen, outside), mask=~(found | carried)))
        self.before = out[len(out) - 1]
        return out

    @staticmethod
    def joined(before, value):
        return before if value is None else value

    @staticmethod
    def applied(local: Column, before: Column) -> Column:
        return F.coalesce(local, before)


class _Total:
    """The sum so far of whole numbers."""

    def __init__(self, length: int) -> None:
        self.before = 0

    def scan(self, values: pa.Array, starts: np.ndarray) -> pa.Array:
        numbers = np.asarray(pc.fill_null(values, 0)).astype(np.int64)
        if np.abs(numbers.astype(float)).sum() + abs(self.before) >= _MOST:
            raise OverflowError("a running total leaves 64 bits")
        sums = np.concatenate(([0], np.cumsum(numbers)))
        out = sums[1:] - sums[np.maximum(starts, 0)] + np.where(starts < 0, self.before, 0)
        self.before = int(out[-1])
        return pa.array(out)

    @staticmethod
    def joined(before, value):
        return (before or 0) + value

    @staticmethod
    def applied(local: Column, before: Column) -> Column:
        return local + F.coalesce(before, F.lit(0))


class _Trail:
    """The last values, oldest first."""

    def __init__(self, length: int) -> None:
        self.length, self.before = length, None

    def scan(self, values: pa.Array, starts: np.ndarray) -> pa.Array:
        held = self.before if self.before is not None else values.slice(0, 0)
        source, at = pa.concat_arrays([held, values]), np.arange(len(values)) + len(held)
        low = np.maximum(np.where(starts < 0, 0, starts + len(held)), at - self.length + 1)
        sizes = at - low + 1
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        flat = source.take(pa.array(np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], sizes)))
        out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
        self.before = out[len(out) - 1].values
        return out

    @staticmethod
    def joined(before, value):
        return [*(before or []), *value]

    @staticmethod
    def applied(local: Column, before: Column) -> Column:
        return F.concat(F.coalesce(before, F.filter(local, lambda x: F.lit(False))), local)


def _differs(column: pa.Array) -> np.ndarray:
    """Whether each row but the first differs from the one before; nulls are equal."""
    one, two = column.slice(0, len(column) - 1), column.slice(1)
    unlike = pc.fill_null(pc.not_equal(one, two), False)
    return np.asarray(pc.or_(unlike, pc.xor(pc.is_null(one), pc.is_null(two))))


def _scan(kind: Callable, length: int, keys: list[int], kept: list[int], inputs: list[int], names: list[str]):
    """A task's scan of its sorted rows. The last batch is held back until its last row is known to be the task's."""

    def one(batches) -> Iterator[pa.RecordBatch]:
        scans = [kind(length) for _ in inputs]
        task, last, single, held = TaskContext.get().partitionId(), None, True, None
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                new[1:] |= _differs(b.column(k))
            now = [b.column(k)[0].as_py() for k in keys]
            new[0] = last is not None and now != last
            starts = np.maximum.accumulate(np.where(new, np.arange(b.num_rows), -1))
            if last is None:
                starts = np.maximum(starts, 0)
            # rows before the first change of the key belong to the key that the task begins with
            head = single & (np.maximum.accumulate(new) == 0)
            edge = np.zeros(b.num_rows, np.int32)
            edge[0] = _FIRST if last is None else 0
            results = [s.scan(b.column(c), starts) for s, c in zip(scans, inputs)]
            single = bool(head[-1])
            if held is not None:
                yield held
            held = pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(np.full(b.num_rows, task, np.int32)), pa.array(head), pa.array(edge), *results], names)
            last = [b.column(k)[b.num_rows - 1].as_py() for k in keys]
        if held is not None:
            at = names.index(_EDGE)
            edge = np.array(held.column(at))
            edge[-1] |= _LAST | (_ONLY if single else 0)
            yield held.set_column(at, _EDGE, pa.array(edge))

    return one


def _carried(edges: list, keys: list[str], names: list[str], kind) -> dict[int, dict]:
    """By task: what its first key starts from, chained along the tasks."""
    firsts = {r[_TASK]: [r[k] for k in keys] for r in edges if r[_EDGE] & _FIRST}
    out, last, values = {}, None, None
    for r in sorted((r for r in edges if r[_EDGE] & _LAST), key=lambda r: r[_TASK]):
        goes_on = last is not None and firsts[r[_TASK]] == last
        if goes_on:
            out[r[_TASK]] = values
        own = {n: r[n] for n in names}
        # a task of one key hands on what it was given
        values = {n: kind.joined(values[n], own[n]) for n in names} if goes_on and r[_EDGE] & _ONLY else own
        last = [r[k] for k in keys]
    return out


def _scanned(rows: DataFrame, keys: list[str], order: list[Column], inputs: dict[str, Column], kind, length: int = 0,
             result: Callable[[S.DataType], S.DataType] = lambda t: t) -> DataFrame:
    """`rows` with a column for each of `inputs`, scanned along the order of each key."""
    lead = "_in_"
    staged = rows.select("*", *[c.alias(lead + n) for n, c in inputs.items()],
                         *[c.alias(f"{_ORDER}{k}") for k, c in enumerate(order)])
    sort = [*keys, *[f"{_ORDER}{k}" for k in range(len(order))]]
    ranged = staged.repartitionByRange(*sort).sortWithinPartitions(*sort)
    fields = [f for f in rows.schema.fields if f.name not in inputs]
    names = [f.name for f in fields]
    at = staged.columns.index
    schema = S.StructType([
        *fields, S.StructField(_TASK, S.IntegerType()), S.StructField(_HEAD, S.BooleanType()), S.StructField(_EDGE, S.IntegerType()),
        *[S.StructField(n, result(staged.schema[lead + n].dataType)) for n in inputs]])
    scan = _scan(kind, length, [at(k) for k in keys], [at(n) for n in names], [at(lead + n) for n in inputs], schema.names)
    local = checkpointed(ranged.mapInArrow(scan, schema), "scan")
    edges = local.filter(F.col(_EDGE) > 0).select(*keys, _TASK, _EDGE, *inputs).collect()  # two rows a task at most
    before = _carried(edges, keys, list(inputs), kind)
    tasks = max(before, default=-1) + 1

    def with_start(name: str) -> Column:
        if not tasks:
            return F.col(name)
        of_task = F.array(*[F.lit(before[t][name] if t in before else None).cast(schema[name].dataType) for t in range(tasks)])
        carried = F.when(F.col(_HEAD), F.get(of_task, F.col(_TASK)))
        return F.when(carried.isNotNull(), kind.applied(F.col(name), carried)).otherwise(F.col(name))

    return local.select(*names, *[with_start(n).alias(n) for n in inputs])


def forward_fill(rows: DataFrame, keys: list[str], order: Column | list[Column], fills: dict[str, Column]) -> DataFrame:
    """Add, per entry of `fills`, its last non-null value up to and including the row."""
    return _scanned(rows, keys, order if isinstance(order, list) else [order], fills, _Fill)


def running_totals(rows: DataFrame, keys: list[str], order: Column, sums: dict[str, Column]) -> DataFrame:
    """Add, per entry of `sums`, its running total up to and including the row, nulls left out.

    The inputs must be whole numbers (`fixed_point`): their totals do not depend on where tasks begin.
    """
    return _scanned(rows, keys, [order], {n: c.cast("bigint") for n, c in sums.items()}, _Total)


def row_positions(rows: DataFrame, order: Column, name: str = "position", keys: list[str] | None = None) -> DataFrame:
    """0-based position along the order, over all rows or per key."""
    counted = running_totals(rows, keys or [], order, {name: F.lit(1)})
    return counted.withColumn(name, F.col(name) - F.lit(1))


def trailing_values(
    rows: DataFrame, keys: list[str], order: Column, value: Column, length: int, name: str = "history",
) -> DataFrame:
    """Add the values of the last `length` rows up to the row, oldest first and nulls left out, as an array."""
    found = _scanned(rows, keys, [order], {name: value}, _Trail, length, lambda t: S.ArrayType(t))
    return found.withColumn(name, F.filter(F.slice(name, F.greatest(F.size(name) - length, F.lit(0)) + 1, length), lambda x: x.isNotNull()))


def as_of(
    left: DataFrame, right: DataFrame, keys: list[str], order: str, value: str, default=None, strict: bool = False,
) -> DataFrame:
    """Join each left row with the latest `value` of the right side known at its `order`.

    Both sides are stacked and the value is filled forward, so a key that holds most of the rows is still
    spread over tasks. `strict` looks only at right rows before the left row; otherwise a right row at the same
    moment counts.
    """
    left_columns = left.columns
    stacked = left.withColumn("_side", F.lit(0 if strict else 1)).withColumn("_known", F.lit(None).cast("double")) \
        .unionByName(
            right.select(*keys, order, F.lit(1 if strict else 0).alias("_side"), F.col(value).alias("_known")),
            allowMissingColumns=True,
        )
    filled = forward_fill(stacked, keys, [F.col(order), F.col("_side")], {value: F.col("_known")})
    found = filled.filter(F.col("_side") == F.lit(0 if strict else 1)).select(*left_columns, value)
    return found if default is None else found.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


#: Rows that one task may sort for a limit, and cells that a span is counted in.
_AT_ONCE, _CELLS = 10_000, 1024


def latest_rows(rows: DataFrame, time: Column, then: list[Column], n: int, at_once: int = _AT_ONCE) -> DataFrame:
    """The n rows with the largest whole number `time`, those without one last, ties by the sort columns `then`.

    Counts by stretches of the span, cut finer and finer where the n-th row lies, lead to a stretch with few rows or a
    single moment. All rows after it are in, and only its own rows are sorted for what is left, so no task holds n rows.
    """
    lowest = -(1 << 62)
    at = F.coalesce(time.cast("bigint"), F.lit(lowest))
    placed = rows.withColumn("_at", at)
    low, high = placed.agg(F.min("_at"), F.max("_at")).first()
    if low is None or n <= 0:
        return rows.limit(0)
    left = n
    while True:
        width = -(-(high - low + 1) // _CELLS)
        cell = F.floor((F.lit(high) - F.col("_at")) / F.lit(width)).cast("int") if width < 1 << 40 else F.shiftright(F.lit(high) - F.col("_at"), width.bit_length()).cast("int")
        width = width if width < 1 << 40 else 1 << width.bit_length()
        counts = sorted((r["_cell"], r["count"]) for r in placed.filter(F.col("_at").between(low, high)).groupBy(cell.alias("_cell")).count().collect())
        for number, count in counts:
            if count >= left:
                break
            left -= count
        else:
            return rows  # there are fewer
        high, low = high - number * width, max(high - (number + 1) * width + 1, low)
        if count == left or count <= at_once or low == high:
            break
    after = placed.filter(F.col("_at") > high)
    edge = placed.filter(F.col("_at").between(low, high)).orderBy(F.col("_at").desc(), *then).limit(left)
    return after.union(edge).drop("_at")
