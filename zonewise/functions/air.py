"""Air-quality index from concentrations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewise.dims import NO2_BREAKPOINTS, PM25_BREAKPOINTS

INDEX_CEILING = 500.0


def slope(lo: float, hi: float, index_lo: float, index_hi: float) -> float:
    return (index_hi - index_lo) / (hi - lo)


def aqi_from_breakpoints(
    concentration: Column,
    breakpoints: list[tuple],
    beyond: Column | None = None,
    truncate_digits: int | None = None,
) -> Column:
    """Linear interpolation inside the closed breakpoint segments.

    A value in the gap between two segments, above the table or below zero gets `beyond` (default 500).
    `truncate_digits` cuts the concentration to the table's precision first, which closes the gaps.
    """
    conc = concentration
    if truncate_digits is not None:
        scale = F.lit(float(10 ** truncate_digits))
        conc = F.floor(conc * scale).cast("double") / scale
    chain = F
    for lo, hi, index_lo, index_hi in breakpoints:
        value = F.lit(slope(lo, hi, index_lo, index_hi)) * (conc - F.lit(float(lo))) + F.lit(float(index_lo))
        chain = chain.when(conc.between(F.lit(float(lo)), F.lit(float(hi))), value)
    outside = F.lit(INDEX_CEILING) if beyond is None else beyond
    return F.when(concentration.isNotNull(), chain.otherwise(outside))


def aqi_combined(pm25: Column, no2: Column) -> Column:
    """The worse of the two indexes."""
    return F.greatest(aqi_from_breakpoints(pm25, PM25_BREAKPOINTS), aqi_from_breakpoints(no2, NO2_BREAKPOINTS))


def aqi_pm25_only(pm25: Column) -> Column:
    """PM2.5 index whose gaps and overflow fall back to 2.1 times the concentration, at most 500."""
    outside = F.least(F.lit(INDEX_CEILING), pm25 * F.lit(2.1))
    return aqi_from_breakpoints(pm25, PM25_BREAKPOINTS, beyond=outside)


def aqi_proxy(avg_pm25: Column) -> Column:
    return avg_pm25 * F.lit(4.0)
