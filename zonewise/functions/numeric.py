"""Defaults, tolerant casts, rounding, buckets, and aggregates that do not depend on row order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = int | float


def lookup(key: Column, mapping: dict, default=None) -> Column:
    """Map a key column through a small constant dictionary."""
    chain = None
    for name, value in mapping.items():
        chain = (F if chain is None else chain).when(key == F.lit(name), F.lit(value))
    return chain.otherwise(F.lit(default))


def default_if_falsy(col: Column, default: Number | str, null_only: bool = False) -> Column:
    """Replace null, and also 0 or the empty string unless `null_only`."""
    if null_only:
        return F.coalesce(col, F.lit(default))
    empty = F.lit("") if isinstance(default, str) else F.lit(0.0)
    return F.coalesce(F.nullif(col, empty), F.lit(default))


def number(col: Column) -> Column:
    """Text as a double; null when it does not parse."""
    return F.trim(col).try_cast("double")


def first_number(columns: list[Column]) -> Column:
    """The first of several alias columns that holds a parsable number."""
    return F.coalesce(*[number(c) for c in columns]) if columns else F.lit(None).cast("double")


def first_text(columns: list[Column]) -> Column:
    """The first of several alias columns that is not empty; empty text when none is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def clamp(col: Column, low: Number | None = None, high: Number | None = None) -> Column:
    if low is not None:
        col = F.greatest(col, F.lit(float(low)))
    if high is not None:
        col = F.least(col, F.lit(float(high)))
    return col


def bucketize(col: Column, steps: list[tuple[Number, str]], otherwise: str) -> Column:
    """The label of the first threshold that the value is strictly above."""
    chain = F
    for threshold, label in steps:
        chain = chain.when(col > F.lit(float(threshold)), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def percent_of(col: Column, limit: Number) -> Column:
    """Share of a limit in percent, at most 100."""
    return F.least(F.lit(100.0), col / F.lit(float(limit)) * F.lit(100.0))


def round_exact(col: Column, digits: int) -> Column:
    """Round the exact binary value to `digits` decimals (at most 11), ties to even.

    Spark's `round` and `bround` round the decimal text of a double, so 2.675 becomes 2.68 although the
    stored number is below it. Here the product with 10**digits is split into its rounded value and its
    rounding error, which decides on which side of the midpoint the number really lies.
    """
    if not 0 <= digits <= 11:
        raise ValueError("10**digits must fit into half of a double's mantissa")
    scale = F.lit(float(10 ** digits))
    product = col * scale
    shifted = col * F.lit(134217729.0)  # 2**27 + 1 cuts the mantissa in two halves
    high = shifted - (shifted - col)
    error = (high * scale - product) + (col - high) * scale
    whole = F.floor(product).cast("double")
    above = (product - whole - F.lit(0.5)) + error
    rounded = F.when(above > 0, whole + F.lit(1.0)).when(above < 0, whole).otherwise(F.rint(product))
    return rounded / scale


def fixed_point(col: Column, digits: int = 2) -> Column:
    """A measure as a whole number of 10**-digits units."""
    return F.rint(col * F.lit(float(10 ** digits))).cast("bigint")


def not_nan(col: Column) -> Column:
    """A measure as a double, null where it is not a number: one bad row must not spoil or stop an aggregate."""
    col = col.cast("double")
    return F.when(~F.isnan(col), col)


PART = float(2 ** 26)


def sum_parts(col: Column) -> list[Column]:
    """A measure as three whole numbers: what is before the binary point, 26 bits after it, and 26 more.

    Each is taken off without rounding, so nothing above 2**-52 is lost, and their sums do not depend on the order
    in which rows or partial sums meet.
    """
    col = not_nan(col)
    rest = (col - F.floor(col).cast("double")) * F.lit(PART)
    return [F.floor(col), F.floor(rest), F.floor((rest - F.floor(rest).cast("double")) * F.lit(PART))]


def joined_sum(whole: Column, middle: Column, low: Column) -> Column:
    """The sum whose parts were added up apart."""
    return whole.cast("double") + (middle.cast("double") + low.cast("double") / F.lit(PART)) / F.lit(PART)


def exact_mean(col: Column) -> Column:
    """Mean of all digits of a measure, NaN left out.

    A retried task, a replayed micro-batch and a batch job all give the same double. Sums have room for 10**12 rows
    of a million each.
    """
    total = joined_sum(*[F.sum(part) for part in sum_parts(col)])
    return total / F.nullif(F.count(not_nan(col)), F.lit(0)).cast("double")


#: Decimals of the values that a standard deviation is made of.
SPREAD_DIGITS = 6


def _spread(col: Column) -> tuple[Column, Column]:
    """n * sum(x^2) - sum(x)^2 in whole units, and n."""
    units = fixed_point(not_nan(col), SPREAD_DIGITS).cast("decimal(19,0)")
    n = F.count(units)
    total = F.sum(units).cast("decimal(38,0)")
    squares = F.sum((units * units).cast("decimal(38,0)")).cast("decimal(38,0)")
    return (n.cast("decimal(38,0)") * squares - total * total).cast("double"), n.cast("double")


def exact_stddev_pop(col: Column) -> Column:
    """Population standard deviation from exact sums of millionths; exactly 0 for a constant group."""
    spread, n = _spread(col)
    return F.sqrt(spread / F.nullif(n * n, F.lit(0.0))) / F.lit(float(10 ** SPREAD_DIGITS))


def exact_stddev_samp(col: Column) -> Column:
    """Sample standard deviation from exact sums of millionths; null for a single row."""
    spread, n = _spread(col)
    return F.sqrt(spread / F.nullif(n * (n - F.lit(1.0)), F.lit(0.0))) / F.lit(float(10 ** SPREAD_DIGITS))


def order_key(time: Column, tie: Column | None = None) -> Column:
    """One orderable number for (event time, tie-break id).

    A single number keeps `max_by` in hash aggregation; a struct or a string as the ordering would force a
    sort of the whole input before the partial aggregate.
    """
    micros = F.unix_micros(time)
    if tie is None:
        return micros
    shifted = micros.cast("decimal(18,0)") * F.lit(Decimal(10 ** 19))
    return (shifted + tie.cast("decimal(19,0)")).cast("decimal(38,0)")


def stable_hash(*cols: Column) -> Column:
    """A non-negative hash that any engine can reproduce: the first 32 bits of the MD5 of the joined text."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 8), 16, 10).cast("bigint")
