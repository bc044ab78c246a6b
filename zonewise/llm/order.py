"""Consecutive numbers for the rows of a large table, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewise.session import checkpointed

_ROW_BITS = 33


def numbered(rows: DataFrame, order: list[Column], by: str | None = None, name: str = "place") -> DataFrame:
    """`rows` with their place (from 0) in `order`, within each value of the integer column `by` if it is given.

    One exchange by ranges of (by, order): a row's number is its place in its range plus the rows of the ranges
    before, of which there are no more than shuffle partitions and groups together. Rows that are equal in all of
    `order` are numbered in any order. `rows` is read twice, so it should be a table. Its columns must not be called
    _range, _first or _before.
    """
    group = F.col(by) if by else F.lit(0)
    keys = [group.asc(), *order] if by else order
    # a row's monotonic id is its task and its place there
    placed = checkpointed(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                          .withColumn("_range", F.monotonically_increasing_id()), "ranges")
    task = F.shiftright("_range", _ROW_BITS)
    ranges = placed.groupBy(task.alias("_task"), group.alias("_group")).agg(F.count("*").alias("_n"), F.min("_range").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_task", "_group", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(ranges), (task == F.col("_task")) & group.eqNullSafe(F.col("_group"))) \
        .withColumn(name, F.col("_range") - F.col("_first") + F.col("_before")).select(*rows.columns, name)
