"""Great-circle distance and planar polygon tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_MILES = 3959.0  # fixed value: radius used for every published distance


def distance_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Straight-line (haversine) miles between two points in degrees."""
    phi1, phi2 = F.radians(lat1.cast("double")), F.radians(lat2.cast("double"))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = F.radians(lon2.cast("double") - lon1.cast("double")) / 2
    chord = F.sin(half_dphi) * F.sin(half_dphi) + (
        F.cos(phi1) * F.cos(phi2) * F.sin(half_dlambda) * F.sin(half_dlambda)
    )
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def _points(ring: Column) -> Column:
    return F.transform(
        F.split(ring, r"\s*,\s*"),
        lambda p: F.struct(
            F.split(F.trim(p), r"\s+").getItem(0).cast("double").alias("x"),
            F.split(F.trim(p), r"\s+").getItem(1).cast("double").alias("y"),
        ),
    )


def ring_points(wkt: Column) -> Column:
    """Outer ring of a ``POLYGON ((x y, ...))`` text as array<struct<x, y>>."""
    return _points(F.regexp_extract(wkt, r"\(\(([^()]*)\)", 1))


def all_rings(wkt: Column) -> Column:
    """Every ring of a ``POLYGON`` or ``MULTIPOLYGON`` text, holes too; empty for ``EMPTY`` and null texts."""
    rings = F.regexp_extract_all(F.coalesce(wkt, F.lit("")), F.lit(r"\(([^()]+)\)"), 1)
    return F.transform(F.filter(rings, lambda r: F.trim(r) != ""), _points)


def inside_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd test over all rings: parts count, their holes do not."""
    odd = F.filter(rings, lambda ring: inside_ring(x, y, ring))
    return F.size(odd) % 2 == 1


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test: does a ray to the right of (x, y) cross the ring an odd number of times?"""
    edges = F.arrays_zip(
        F.slice(ring, F.lit(1), F.size(ring) - 1).alias("a"),
        F.slice(ring, F.lit(2), F.size(ring) - 1).alias("b"),
    )

    def crosses(edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        at = F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"]
        return spans & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1
