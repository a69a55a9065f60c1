"""Planar geometry as column expressions.

A polygon is ``array<array<struct<x: double, y: double>>>``: closed rings, the
first point repeated at the end. A path or multi-point is one such inner array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0
EARTH_DIAMETER = EARTH_RADIUS * 2 * math.pi

POINT_TYPE = "struct<x:double,y:double>"
RINGS_TYPE = f"array<array<{POINT_TYPE}>>"

# Geometry type labels by their upper-case text name.
GEOMETRY_TYPES = {
    "POINT": "Point",
    "POINT Z": "Point 2.5D",
    "LINESTRING": "LineString",
    "LINESTRING Z": "LineString 2.5D",
    "LINEARRING": "LinearRing",
    "POLYGON": "Polygon",
    "POLYGON Z": "Polygon 2.5D",
    "MULTIPOINT": "MultiPoint",
    "MULTIPOINT Z": "MultiPoint 2.5D",
    "MULTILINESTRING": "MultiLineString",
    "MULTILINESTRING Z": "MultiLineString 2.5D",
    "MULTIPOLYGON": "MultiPolygon",
    "MULTIPOLYGON Z": "MultiPolygon 2.5D",
    "GEOMETRYCOLLECTION": "GeometryCollection",
    "GEOMETRYCOLLECTION Z": "GeometryCollection 2.5D",
}


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Closed ring around a rectangle."""
    return F.array(
        point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin)
    )


def edges_of(path: Column) -> Column:
    """Pairs of neighbouring points."""
    starts = F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))
    return F.transform(
        starts, lambda p, i: F.struct(p.alias("p"), F.try_element_at(path, i + 2).alias("q"))
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda a, v: a + v)


def ring_moments(ring: Column) -> Column:
    """Twice the signed area and the matching first moments times six."""

    def add(total: Column, edge: Column) -> Column:
        p, q = edge["p"], edge["q"]
        cross = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct(
            (total["a"] + cross).alias("a"),
            (total["x"] + (p["x"] + q["x"]) * cross).alias("x"),
            (total["y"] + (p["y"] + q["y"]) * cross).alias("y"),
        )

    zero = F.lit(0.0).cast("double")
    start = F.struct(zero.alias("a"), zero.alias("x"), zero.alias("y"))
    return F.aggregate(edges_of(ring), start, add)


def polygon_area(rings: Column) -> Column:
    """Planar area: the first ring minus its holes."""
    sizes = F.transform(rings, lambda r, i: F.when(i == 0, 1.0).otherwise(-1.0) * F.abs(ring_moments(r)["a"]))
    return _sum(sizes) / 2


def envelope(rings: Column) -> Column:
    """struct(xmin, xmax, ymin, ymax) over all points."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_max(xs).alias("xmax"),
        F.array_min(ys).alias("ymin"), F.array_max(ys).alias("ymax"),
    )


def _envelope_middle(rings: Column) -> Column:
    e = envelope(rings)
    return point(e["xmin"] / 2 + e["xmax"] / 2, e["ymin"] / 2 + e["ymax"] / 2)


def polygon_centroid(rings: Column, by_orientation: bool = False) -> Column:
    """Area centroid; the middle of the envelope for a ring without area.

    Holes are the rings after the first, or with ``by_orientation`` the rings
    turning the other way (feature services may list several outer rings).
    """

    def signed(ring: Column, i: Column) -> Column:
        m = ring_moments(ring)
        if by_orientation:
            return m
        sign = F.when((i == 0) == (m["a"] > 0), 1.0).otherwise(-1.0)
        return F.struct(
            (m["a"] * sign).alias("a"), (m["x"] * sign).alias("x"), (m["y"] * sign).alias("y")
        )

    def add(total: Column, m: Column) -> Column:
        return F.struct(*[(total[k] + m[k]).alias(k) for k in ("a", "x", "y")])

    zero = F.lit(0.0).cast("double")
    start = F.struct(zero.alias("a"), zero.alias("x"), zero.alias("y"))
    # The final lambda reads the finished sums once.
    total = F.aggregate(
        F.transform(rings, signed), start, add,
        lambda t: F.when(t["a"] != 0, point(t["x"] / (t["a"] * 3), t["y"] / (t["a"] * 3))),
    )
    return F.coalesce(total, _envelope_middle(rings))


def path_centroid(paths: Column) -> Column:
    """Length-weighted middle of one or more polylines."""

    def add(total: Column, edge: Column) -> Column:
        p, q = edge["p"], edge["q"]
        length = F.hypot(q["x"] - p["x"], q["y"] - p["y"])
        return F.struct(
            (total["a"] + length).alias("a"),
            (total["x"] + (p["x"] + q["x"]) / 2 * length).alias("x"),
            (total["y"] + (p["y"] + q["y"]) / 2 * length).alias("y"),
        )

    zero = F.lit(0.0).cast("double")
    start = F.struct(zero.alias("a"), zero.alias("x"), zero.alias("y"))
    edges = F.flatten(F.transform(paths, edges_of))
    total = F.aggregate(
        edges, start, add,
        lambda t: F.when(t["a"] > 0, point(t["x"] / t["a"], t["y"] / t["a"])),
    )
    return F.coalesce(total, _envelope_middle(paths))


def points_centroid(points: Column) -> Column:
    """Mean of several points."""
    count = F.size(points)
    return F.when(
        count > 0,
        point(
            _sum(F.transform(points, lambda p: p["x"])) / count,
            _sum(F.transform(points, lambda p: p["y"])) / count,
        ),
    )


def clip_to_box(rings: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Rings cut to a rectangle, one half-plane after the other.

    Each step walks the edges of a ring and keeps inner points and crossings.
    Rings left without area are dropped. Exact for areas of convex and concave
    rings alike (parts joined along the border of the box carry no area).
    """

    def half_plane(rings: Column, axis: str, limit: Column, keep_above: bool) -> Column:
        other = "y" if axis == "x" else "x"

        def inside(p: Column) -> Column:
            return (p[axis] >= limit) if keep_above else (p[axis] <= limit)

        def step(edge: Column) -> Column:
            p, q = edge["p"], edge["q"]
            share = (limit - p[axis]) / (q[axis] - p[axis])
            across = p[other] + (q[other] - p[other]) * share
            crossing = point(limit, across) if axis == "x" else point(across, limit)
            none = F.array().cast(f"array<{POINT_TYPE}>")
            return F.concat(
                F.when(inside(p), F.array(p)).otherwise(none),
                F.when(inside(p) != inside(q), F.array(crossing)).otherwise(none),
            )

        def close(ring: Column) -> Column:
            return F.when(F.size(ring) > 0, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)

        cut = F.transform(rings, lambda ring: F.flatten(F.transform(edges_of(ring), step)))
        return F.transform(cut, close)

    for axis, limit, above in (("x", xmin, True), ("x", xmax, False), ("y", ymin, True), ("y", ymax, False)):
        rings = half_plane(rings, axis, limit.cast("double"), above)
    return F.filter(rings, lambda r: F.size(r) > 3)


def buffer_point(lon: Column, lat: Column, metres: float, corners: int = 32) -> Column:
    """Rings of a disc of the given radius around a geographic point."""
    degrees_lat = metres / EARTH_RADIUS * 180 / math.pi
    degrees_lon = F.lit(degrees_lat) / F.cos(F.radians(lat))
    angle = lambda i: i.cast("double") * (2 * math.pi / corners)
    ring = F.transform(
        F.sequence(F.lit(0), F.lit(corners)),
        lambda i: point(
            lon + degrees_lon * F.cos(angle(i % corners)), lat + degrees_lat * F.sin(angle(i % corners))
        ),
    )
    return F.array(ring)


def rings_from_text(wkt: Column) -> Column:
    """Rings of a POLYGON text; further ordinates of a point are ignored."""
    body = F.regexp_extract(wkt, r"(?i)^\s*POLYGON\s*Z?\s*\(\((.*)\)\)\s*$", 1)
    corner = lambda text: F.split(F.trim(text), r"\s+")
    rings = F.transform(
        F.split(body, r"\)\s*,\s*\("),
        lambda ring: F.transform(
            F.split(ring, ","),
            lambda text: point(
                F.try_element_at(corner(text), F.lit(1)).try_cast("double"),
                F.try_element_at(corner(text), F.lit(2)).try_cast("double"),
            ),
        ),
    )
    return F.when(body != "", rings)


def rings_to_text(rings: Column) -> Column:
    """POLYGON text of rings."""
    ring = lambda r: F.concat(
        F.lit("("),
        F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "),
        F.lit(")"),
    )
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, ring), ", "), F.lit(")"))


def geometry_type(wkt: Column) -> Column:
    """Type label of a geometry text; null for none."""
    pairs = [F.lit(x) for item in GEOMETRY_TYPES.items() for x in item]
    head = F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)(\s*[Zz]\b)?", 1))
    flat = F.regexp_extract(wkt, r"^\s*[A-Za-z]+\s*([Zz])\b", 1) != ""
    third = F.regexp_extract(wkt, r"\(\s*[-+0-9.eE]+\s+[-+0-9.eE]+\s+([-+0-9.eE]+)", 1) != ""
    return F.try_element_at(F.create_map(*pairs), F.concat(head, F.when(flat | third, " Z").otherwise("")))


def box_text(lon: Column, lat: Column, size: float) -> Column:
    """Text of a grid cell, one decimal per ordinate."""
    west, south = F.format_string("%.1f", lon), F.format_string("%.1f", lat)
    east, north = F.format_string("%.1f", lon + size), F.format_string("%.1f", lat + size)
    corners = [west, south, west, north, east, north, east, south, west, south]
    texts = [F.concat_ws(" ", corners[i], corners[i + 1]) for i in range(0, 10, 2)]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *texts), F.lit("))"))


# --- web Mercator and its tiles ---------------------------------------------


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * EARTH_RADIUS


def mercator_y(lat: Column) -> Column:
    """Null at and beyond the poles, where the projection has no value."""
    return F.when(
        F.abs(lat) < 90, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH_RADIUS
    )


def tile_y(lat: Column) -> Column:
    """Mercator y for tiles: latitudes at and beyond the poles count as just before them."""
    most = F.lit(89.9999999)
    return mercator_y(F.greatest(F.least(lat, most), -most))


def tile_column(x: Column, zoom: Column) -> Column:
    return F.floor((x + EARTH_DIAMETER / 2) / EARTH_DIAMETER * F.pow(F.lit(2.0), zoom)).cast("bigint")


def tile_row(y: Column, zoom: Column) -> Column:
    return F.floor((F.lit(EARTH_DIAMETER / 2) - y) / EARTH_DIAMETER * F.pow(F.lit(2.0), zoom)).cast("bigint")


def tile_bounds(row: Column, column: Column, zoom: Column) -> Column:
    """struct(ulx, uly, lrx, lry): Mercator corners of a tile."""
    side = F.pow(F.lit(2.0), zoom)
    return F.struct(
        ((column / side - 0.5) * EARTH_DIAMETER).alias("ulx"),
        ((F.lit(0.5) - row / side) * EARTH_DIAMETER).alias("uly"),
        (((column + 1) / side - 0.5) * EARTH_DIAMETER).alias("lrx"),
        ((F.lit(0.5) - (row + 1) / side) * EARTH_DIAMETER).alias("lry"),
    )


def flip_tile_row(row: Column, zoom: Column) -> Column:
    """Row counted from the other edge of the world."""
    return (F.pow(F.lit(2.0), zoom).cast("bigint") - 1 - row).cast("bigint")


def zoom_for_scale(scale: Column, resolution: float) -> Column:
    """Map zoom of a drawing scale (pixels per map unit)."""
    return F.log(scale / F.lit(resolution * 256 / EARTH_DIAMETER)) / math.log(2)
