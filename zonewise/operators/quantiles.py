"""Exact quantiles without gathering a group in one place: radix selection.

`percentile` keeps every distinct value of a group in one aggregation buffer. Here a double becomes a whole number of the
same order (its sign, exponent and mantissa), and counts by its upper 16 bits tell for every wanted rank of every
group in which range of values it lies, and which rank it has there. Only ranges with many different values are cut
on, by the next 16 bits; four passes reach single values. What is left of a range is short, and is ranked as one array.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.functions.numeric import not_nan
from zonewise.session import checkpointed

SALTS = 64
DIGIT = 16
#: Different values of a range that are ranked as one array.
RANKED = 1 << DIGIT
#: Wanted ranks that are sent to every task; more are joined, salted.
BROADCAST_ROWS = 100_000


def interpolated(low: Column, high: Column, fraction: Column) -> Column:
    """Linear interpolation measured from the nearer end, which keeps the result inside [low, high]."""
    gap = high - low
    return F.when(fraction >= 0.5, high - gap * (F.lit(1.0) - fraction)).otherwise(low + gap * fraction)


def ordered_bits(value: Column) -> Column:
    """A whole number of 64 bits in the order of the doubles: a double's own bits, negative for negative values. Both
    zeros are 0."""
    size = F.abs(value)
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    # the logarithm may be off by one near a power of two
    guess = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size)).cast("int")))
    exponent = F.when(size < power(guess), guess - 1).when(size / power(guess) >= 2.0, guess + 1).otherwise(guess)
    mantissa = (size / power(exponent) - 1.0) * float(1 << 52)
    normal = F.shiftleft((exponent + 1023).cast("bigint"), 52) + mantissa.cast("bigint")
    tiny = (size * float(2.0 ** 537) * float(2.0 ** 537)).cast("bigint")
    bits = F.when(size < 2.0 ** -1022, tiny).when(size == float("inf"), F.lit(2047 << 52)).otherwise(normal)
    return F.when(value < 0, -bits).otherwise(bits)


def _picked(counts: Column, rank: Column) -> Column:
    """Of an array of (at, n, d, v) in order: the entry that holds the rank, and the rank inside it, in one pass."""
    def state(rank: Column, x: Column | None = None) -> Column:
        entry = [F.lit(None).cast(t) if x is None else x[c].cast(t) for c, t in (("at", "bigint"), ("d", "bigint"), ("v", "double"))]
        return F.struct(rank.alias("rank"), entry[0].alias("at"), entry[1].alias("d"), entry[2].alias("v"))

    return F.aggregate(counts, state(rank), lambda acc, x: F.when(acc["at"].isNotNull(), acc).when(
        acc["rank"] < x["n"], state(acc["rank"], x)).otherwise(state(acc["rank"] - x["n"])))


def _joined(rows: DataFrame, table: DataFrame, on: list[str], few: bool) -> DataFrame:
    """`rows` with the columns of a `table` of ranges; nulls are equal. No task gets all rows of a frequent range."""
    side = table.select(*[F.col(c).alias(f"_of_{c}") for c in on], *[c for c in table.columns if c not in on])
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(F.col(f"_of_{c}")) for c in on], F.lit(True))
    if few:
        return rows.join(F.broadcast(side), same)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_k"), F.lit(SALTS)).cast("int"))
    side = side.withColumn("_of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(side, same & (F.col("_salt") == F.col("_of_salt")))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, probabilities: list[float], ranked: int = RANKED) -> DataFrame:
    """One row per key and probability: (*keys, probability, quantile, n), linearly interpolated. Nulls and NaN are left
    out."""
    present = rows.select(*keys, not_nan(F.col(value)).alias("_v")).filter(F.col("_v").isNotNull())
    # different values with their counts carry the same information in fewer rows
    counted = checkpointed(present.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_k", ordered_bits(F.col("_v"))), "values")
    sizes = counted.groupBy(*keys).agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("_left"))
    place = lambda p: F.lit(float(p)) * (F.col("n") - F.lit(1)).cast("double")
    asks = [F.struct(F.lit(float(p)).alias("probability"), F.lit(upper).alias("upper"),
                     (F.ceil(place(p)) if upper else F.floor(place(p))).cast("bigint").alias("rank")) for p in probabilities for upper in (False, True)]
    wanted = sizes.select(*keys, "n", "_left", F.lit(0).cast("bigint").alias("_prefix"), F.explode(F.array(*asks)).alias("a")) \
        .select(*keys, "n", "_left", "_prefix", "a.*")
    shift, on = 64, [*keys, "_prefix"]

    def counts(at: Column) -> DataFrame:
        """Per range: what `at` tells apart inside it, in order, with the numbers of rows and of different values."""
        rows = counted.withColumn("_prefix", F.shiftright("_k", shift) if shift < 64 else F.lit(0).cast("bigint"))
        inside = _joined(rows, wanted.select(*on).distinct(), on, few) if shift < 64 else rows
        return inside.groupBy(*on, at.alias("_at")).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_value")) \
            .groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(
                F.col("_at").alias("at"), F.col("_n").alias("n"), F.col("_d").alias("d"), F.col("_value").alias("v")))).alias("_counts"))

    def ranged(table: DataFrame) -> DataFrame:
        """Every wanted rank with the entry of its range that holds it. Few ranks go to the ranges, which are not copied."""
        met = _joined(table, wanted, on, True) if few else _joined(wanted.withColumn("_k", F.col("rank")), table, on, False)
        return met.withColumn("_p", _picked(F.col("_counts"), F.col("rank")))

    wanted = checkpointed(wanted, "ranks")
    few = wanted.count() <= BROADCAST_ROWS
    while shift > 0 and (wanted.agg(F.max("_left")).first()[0] or 0) > ranked:
        table = counts(F.shiftright("_k", shift - DIGIT))
        shift -= DIGIT
        found = ranged(table)
        wanted = checkpointed(found.select(*keys, "n", F.col("_p.d").alias("_left"), F.col("_p.at").alias("_prefix"), "probability", "upper",
                                           F.col("_p.rank").alias("rank")), "ranks")
    values = ranged(counts(F.col("_k"))).withColumn("_value", F.col("_p.v"))
    picked = values.groupBy(*keys, "probability", "n").agg(
        F.max(F.when(~F.col("upper"), F.col("_value"))).alias("_low"), F.max(F.when(F.col("upper"), F.col("_value"))).alias("_high"))
    rank = F.col("probability") * (F.col("n") - F.lit(1)).cast("double")
    return picked.select(*keys, "probability", interpolated(F.col("_low"), F.col("_high"), rank - F.floor(rank)).cast("double").alias("quantile"), "n")
