"""Zones as expressions: prefix lookups, grid midpoints, nearest zone, bounding boxes, neighbours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewise import dims
from zonewise.functions.numeric import lookup, stable_hash


def borough_id(zone_id: Column) -> Column:
    return F.substring(zone_id, 1, 2)


def borough_name(zone_id: Column, default: str | None = "") -> Column:
    return lookup(borough_id(zone_id), dims.BOROUGH_NAMES, default)


def density(zone_id: Column) -> Column:
    return lookup(borough_id(zone_id), dims.BOROUGH_DENSITY, dims.DEFAULT_DENSITY)


def zone_number(zone_id: Column) -> Column:
    return F.substring(zone_id, 4, 2).try_cast("int")


def zone_ordinal(zone_id: Column) -> Column:
    """Position of a zone in the dimension order, null for an unknown zone."""
    start = lookup(borough_id(zone_id), {b: i * dims.ZONES_PER_BOROUGH for i, b in enumerate(dims.BOROUGHS)})
    nth = zone_number(zone_id)
    known = nth.between(1, dims.ZONES_PER_BOROUGH) & (F.length(zone_id) == 5)
    return F.when(known, start + nth - F.lit(1)).cast("int")


def zone_at(position: Column) -> Column:
    """The zone at a 0-based position, wrapping around the dimension."""
    count = len(dims.ZONES)
    names = F.array(*[F.lit(z) for z in dims.ZONES])
    return F.get(names, F.pmod(position, F.lit(count)).cast("int"))


def nth_zone_of(borough: Column, position: Column) -> Column:
    """Round-robin over the zones of a borough by row position."""
    nth = F.pmod(position, F.lit(dims.ZONES_PER_BOROUGH)).cast("int") + F.lit(1)
    return F.concat(borough, F.lit("-0"), nth.cast("string"))


def grid_midpoint(zone_id: Column) -> tuple[Column, Column]:
    """(lat, lon) of the zone's cell in the 3 x 2 grid laid over its borough box, not rounded."""
    index = zone_number(zone_id) - F.lit(1)
    box = [lookup(borough_id(zone_id), {b: dims.BOROUGH_BOUNDS[b][i] for b in dims.BOROUGHS}) for i in range(4)]
    row = F.floor(index / F.lit(2)).cast("double")
    column = F.pmod(index, F.lit(2)).cast("double")
    half = F.lit(0.5)
    lat = box[0] + (row + half) * (box[1] - box[0]) / F.lit(3.0)
    lon = box[2] + (column + half) * (box[3] - box[2]) / F.lit(2.0)
    return lat, lon


def nearest_zone(lat: Column, lon: Column, centroids: list[tuple[str, float, float]] | None = None) -> Column:
    """Zone with the smallest squared distance; the first in zone order wins a tie.

    The centroids are constants, so the search unrolls into arithmetic inside generated code and needs no
    join. A missing coordinate gives the first zone.
    """
    centroids = centroids or dims.zone_centroids()
    distances = [
        (lat - F.lit(z_lat)) * (lat - F.lit(z_lat)) + (lon - F.lit(z_lon)) * (lon - F.lit(z_lon))
        for _, z_lat, z_lon in centroids
    ]
    first_smallest = F.array_position(F.array(*distances), F.least(*distances)).cast("int")
    names = F.array(*[F.lit(zone) for zone, _, _ in centroids])
    return F.coalesce(F.get(names, first_smallest - F.lit(1)), F.lit(centroids[0][0]))


def bounding_box_zone(lat: Column, lon: Column, position: Column) -> Column:
    """The first borough box (closed) that holds the point, then round-robin; outside all boxes: MN."""
    chain = F
    for borough, (lat_lo, lat_hi, lon_lo, lon_hi) in dims.BOROUGH_BOUNDS.items():
        inside = lat.between(lat_lo, lat_hi) & lon.between(lon_lo, lon_hi)
        chain = chain.when(inside, F.lit(borough))
    return nth_zone_of(chain.otherwise(F.lit("MN")), position)


def neighbours(zone_id: Column) -> Column:
    """Zones of the same borough but itself, then the first two of the adjacent borough."""
    own = borough_id(zone_id)
    same = [F.concat(own, F.lit(f"-{i:02d}")) for i in range(1, dims.ZONES_PER_BOROUGH + 1)]
    adjacent = lookup(own, dims.ADJACENT_BOROUGH)
    near = [F.concat(adjacent, F.lit(f"-{i:02d}")) for i in (1, 2)]
    return F.concat(F.array_remove(F.array(*same), zone_id), F.array(*near))


def segment_location(borough: Column, link_id: Column) -> tuple[Column, Column]:
    """Borough centroid moved by 0..0.00999 degrees that depend on the link id only."""
    offset = F.pmod(stable_hash(link_id), F.lit(1000)).cast("double") / F.lit(100000.0)
    lat = lookup(borough, {b: c[0] for b, c in dims.BOROUGH_CENTROIDS.items()}, 40.7128)
    lon = lookup(borough, {b: c[1] for b, c in dims.BOROUGH_CENTROIDS.items()}, -74.006)
    return lat + offset, lon + offset
