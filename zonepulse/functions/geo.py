"""Grid cells, polygon centroids and distances as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonepulse.functions import fixed
from zonepulse.functions.scalars import as_col


def cell_id(lon, lat, resolution: int = fixed.CELL_RESOLUTION) -> Column:
    """Grid cell of a point, one thousandth of a degree wide."""
    return F.concat(
        F.lit(f"{fixed.CELL_TAG}{resolution}_"),
        _thousandths(lon),
        F.lit("_"),
        _thousandths(lat),
    )


def _thousandths(degrees) -> Column:
    return F.round(as_col(degrees) * 1000).cast("long").cast("string")


def cell_lon(cell, resolution: int = fixed.CELL_RESOLUTION) -> Column:
    return _coordinate(cell, 0, resolution)


def cell_lat(cell, resolution: int = fixed.CELL_RESOLUTION) -> Column:
    return _coordinate(cell, 1, resolution)


def _coordinate(cell, position: int, resolution: int) -> Column:
    """Degrees at a position of the id; NULL unless prefix, part count and numbers are right."""
    cell, prefix = as_col(cell), f"{fixed.CELL_TAG}{resolution}_"
    parts = F.split(F.substring(cell, len(prefix) + 1, 1000), "_")
    numbers = [F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1)]
    good = (
        cell.startswith(prefix)
        & (F.size(parts) == 2)
        & numbers[0].isNotNull()
        & numbers[1].isNotNull()
    )
    return F.when(good, numbers[position] / 1000.0)


def coarse_cell(cell, factor: int, resolution: int = fixed.CELL_RESOLUTION) -> Column:
    """Parent on a grid `factor` times as wide; ids of malformed cells are NULL."""

    def snap(degrees: Column) -> Column:
        steps = F.round(degrees * 1000).cast("long")
        return (F.floor(steps / F.lit(float(factor))) * factor).cast("string")

    return F.concat(
        F.lit(f"{fixed.CELL_TAG}{resolution}x{factor}_"),
        snap(cell_lon(cell, resolution)),
        F.lit("_"),
        snap(cell_lat(cell, resolution)),
    )


def centroid_x(ring) -> Column:
    return _centroid(ring, "x")


def centroid_y(ring) -> Column:
    return _centroid(ring, "y")


def _centroid(ring, axis: str) -> Column:
    """Area-weighted centre of a closed ring (planar, either direction).

    Works relative to the first corner to keep digits; a ring without area falls back to
    the mean of its corners.
    """
    ring = as_col(ring)
    origin = F.get(ring, F.lit(0))
    corners = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))

    def edge(a: Column, b: Column) -> Column:
        ax, ay = a["x"] - origin["x"], a["y"] - origin["y"]
        bx, by = b["x"] - origin["x"], b["y"] - origin["y"]
        cross = ax * by - bx * ay
        mid = (ax + bx) if axis == "x" else (ay + by)
        return F.struct(cross.alias("area2"), (mid * cross).alias("moment"))

    # An open tail pairs the last corner with NULL; the edge is then NULL and skipped.
    edges = F.filter(
        F.zip_with(corners, F.slice(ring, F.lit(2), F.greatest(F.size(ring), F.lit(1))), edge),
        lambda e: e["area2"].isNotNull(),
    )
    area2 = F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + e["area2"])
    moment = F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + e["moment"])
    mean = F.aggregate(corners, F.lit(0.0), lambda acc, p: acc + p[axis]) / F.size(corners)
    return F.when(F.abs(area2) < 1e-18, mean).otherwise(origin[axis] + moment / (area2 * 3.0))


# --- polygons of several rings ------------------------------------------------------------

def rings_of(text) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text, each with whether it is a hole.

    array<struct<hole boolean, points array<struct<x double, y double>>>>; the first ring of each
    polygon is its outline. NULL for other texts; a pair that is no number has NULL coordinates.
    """
    text = F.upper(F.trim(as_col(text)))
    body = F.regexp_replace(F.regexp_replace(text, r"^(MULTI)?POLYGON\s*(Z\b)?\s*", ""), r"\s*([(),])\s*", "$1")
    body = F.when(text.startswith("MULTIPOLYGON"), body).when(text.startswith("POLYGON"), F.concat(F.lit("("), body, F.lit(")")))
    inside = F.regexp_replace(F.regexp_replace(body, r"^\(\(\(", ""), r"\)\)\)$", "")

    def point(pair: Column) -> Column:
        parts = F.split(F.trim(pair), r"\s+")
        return F.struct(*[F.get(parts, F.lit(i)).try_cast("double").alias(axis) for i, axis in enumerate("xy")])

    def polygon(rings: Column) -> Column:
        return F.transform(
            F.split(rings, r"\),\("),
            lambda ring, n: F.struct((n > 0).alias("hole"), F.transform(F.split(ring, ","), point).alias("points")),
        )

    whole = F.regexp_like(body, F.lit(r"^\(\(\(.+\)\)\)$"))
    return F.when(whole, F.flatten(F.transform(F.split(inside, r"\)\),\(\("), polygon)))


def _moments(rings: Column, origin: Column) -> Column:
    """Twice the area and its first moments over all rings; holes count against the outlines,
    whichever way either runs."""

    def of_ring(ring: Column) -> Column:
        points = F.transform(ring["points"], lambda p: F.struct((p["x"] - origin["x"]).alias("x"), (p["y"] - origin["y"]).alias("y")))
        nexts = F.concat(F.slice(points, 2, 1_000_000_000), F.slice(points, 1, 1))
        edges = F.zip_with(
            points, nexts,
            lambda a, b: F.struct(
                (a["x"] * b["y"] - b["x"] * a["y"]).alias("a"), ((a["x"] + b["x"]) * (a["x"] * b["y"] - b["x"] * a["y"])).alias("x"),
                ((a["y"] + b["y"]) * (a["x"] * b["y"] - b["x"] * a["y"])).alias("y"),
            ),
        )
        sums = {c: _sum(edges, c) for c in ("a", "x", "y")}
        sign = F.when(ring["hole"], F.lit(-1.0)).otherwise(F.lit(1.0)) * F.signum(sums["a"])
        return F.struct(*[(sign * col).alias(c) for c, col in sums.items()])

    return F.transform(rings, of_ring)


def _sum(items: Column, field: str) -> Column:
    """Sum of a field over an array of structs; unknown ones do not count."""
    return F.aggregate(items, F.lit(0.0), lambda acc, item: acc + F.coalesce(item[field], F.lit(0.0)))


def _total(rings: Column, origin: Column, part: str) -> Column:
    return _sum(_moments(rings, origin), part)


def area_of(rings) -> Column:
    """Planar area inside the outlines and outside the holes, in square degrees."""
    rings = as_col(rings)
    return _total(rings, F.get(F.get(rings, F.lit(0))["points"], F.lit(0)), "a") / 2.0


def centre_of(rings) -> Column:
    """Area-weighted centre of rings as struct<x, y>; without area the mean of the first ring's corners."""
    rings = as_col(rings)
    first = F.get(rings, F.lit(0))["points"]
    origin = F.get(first, F.lit(0))
    area2 = _total(rings, origin, "a")
    axes = []
    for axis in "xy":
        mean = _sum(first, axis) / F.size(first)
        axes.append(F.when(F.abs(area2) < 1e-18, mean).otherwise(origin[axis] + _total(rings, origin, axis) / (area2 * 3.0)).alias(axis))
    return F.when(F.size(rings) > 0, F.struct(*axes))


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((lat2 - lat1) / 2.0), F.sin((lon2 - lon1) / 2.0)
    a = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    # Rounding can push `a` past 1 for antipodal points.
    a = F.least(a, F.lit(1.0))
    return F.lit(2.0 * fixed.EARTH_RADIUS_MILES) * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def est_seconds(miles, mph: float = fixed.CITY_SPEED_MPH) -> Column:
    return as_col(miles) / F.lit(float(mph)) * 3600.0


def rule_fare(miles, base: float = 3.0, per_mile: float = 2.5, floor: float = 5.0) -> Column:
    return F.greatest(F.lit(float(floor)), F.lit(float(base)) + F.lit(float(per_mile)) * as_col(miles))
