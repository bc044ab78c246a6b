"""Conversations: cumulative snapshots collapse to the longest, which is rendered for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewise.session import checkpointed

#: Marks around a turn, and the role that a null role stands for.
START, END, NO_ROLE = "<|im_start|>", "<|im_end|>", "unknown"
_ORDER = ("turn", "role", "text")


def turns(logs: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): each different turn once, numbered from 1 within its conversation.

    The order is turn (nulls last), role, text. Rows are dealt out by ranges of (conv_id, turn, role, text), so a
    conversation that holds a third of all rows spans many tasks; each task numbers its own rows, and a small table
    says with what number a conversation goes on in the next task.
    """
    rows = logs.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit((1 << 63) - 1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NO_ROLE)).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL").distinct()
    parts = max(1, int(logs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = checkpointed(
        rows.repartitionByRange(parts, "conv_id", *_ORDER).withColumn("part", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*_ORDER))
    return dealt.withColumn("inside", inside).join(starts, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("start") + F.col("inside")).alias("place"), "role", "text")


def prefixes(numbered: DataFrame) -> DataFrame:
    """(conv_id, place, last, a, b): two rolling hashes of the turns up to `place`.

    A turn's hash includes its place, and a prefix's is the exclusive or of its turns', so it rolls on over any
    split: each part of a conversation starts from what the parts before it add up to.
    """
    hashed = numbered.select(
        "conv_id", "part", "place", F.xxhash64("place", "role", "text").alias("x"),
        F.xxhash64(F.lit("turn"), "text", "role", "place").alias("y"))
    sums = hashed.groupBy("conv_id", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("place").alias("m"))
    by_part = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "conv_id", "part", F.max("m").over(Window.partitionBy("conv_id")).alias("last"),
        *[F.coalesce(F.bit_xor(c).over(by_part), F.lit(0)).alias(f"{c}0") for c in "xy"])
    so_far = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.withColumns({c: F.bit_xor(c).over(so_far) for c in "xy"}).join(starts, ["conv_id", "part"]).select(
        "conv_id", "place", "last", F.col("x").bitwiseXOR(F.col("x0")).alias("a"), F.col("y").bitwiseXOR(F.col("y0")).alias("b"))


def maximal(prefix: DataFrame) -> DataFrame:
    """(conv_id, last): conversations that are no prefix of a longer one; of equal ones that with the smallest
    conv_id.

    Many snapshots share a prefix, so prefixes are counted per hash before they meet: one row per different prefix
    remains.
    """
    ends = prefix.filter("place = last").select("conv_id", "last", "a", "b")
    inner = prefix.filter("place < last").select("place", "a", "b").distinct()
    first = ends.groupBy("last", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    return first.join(inner, (first["last"] == inner.place) & (first.a == inner.a) & (first.b == inner.b), "left_anti") \
        .select("conv_id", "last")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def collapsed(logs: DataFrame) -> DataFrame:
    """The rendered turns of maximal conversations: conv_id, place (from 1), n_turns, rendered.

    A snapshot whose turns begin a longer conversation goes, and of equal conversations all but that with the
    smallest conv_id. A turn is its role and text; turn numbers give the order only. Repeated rows are one turn,
    rows with the same turn number but other contents are turns in the order of role and text, a null turn comes
    last, a null role is "unknown" and a null text is empty; rows without conv_id take no part. An empty table gives
    no rows. Other columns are not read.
    """
    numbered = checkpointed(turns(logs), "numbered")
    longest = maximal(prefixes(numbered))
    return numbered.join(longest, "conv_id").select(
        "conv_id", "place", F.col("last").alias("n_turns"), rendered(F.col("role"), F.col("text")).alias("rendered"))


def conversations(logs: DataFrame) -> DataFrame:
    """(conv_id, n_turns, chat): a row per maximal conversation with its whole text, which must fit a row."""
    return collapsed(logs).groupBy("conv_id", "n_turns").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "rendered"))), lambda x: x.rendered), "").alias("chat"))
