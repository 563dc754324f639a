"""Plane and earth geometry as column expressions.

A polygon layer of a hole (its bunkers, its water, ...) is one struct: a bounding
box and the spans of its rings. Membership tests the box first, then counts edge
crossings ring by ring, all on the row that carries the point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swingframe.constants import METRES_PER_DEGREE, YARDS_PER_METRE


def ring_edges(ring: Column) -> Column:
    """Closed ring `array<array<double>>` to edges `array<struct<x0,y0,x1,y1>>`."""
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(
        p[0].alias("x0"), p[1].alias("y0"),
        F.get(ring, (i + 1) % n)[0].alias("x1"), F.get(ring, (i + 1) % n)[1].alias("y1")))


def ring_spans(ring: Column) -> Column:
    """The edges a horizontal line can cross, as `array<struct<low,high,lean,foot>>`: the
    edge covers low <= y < high and stands at x = lean * y + foot. Worked out once per
    hole, so that a point costs two comparisons for most edges."""
    def span(e: Column) -> Column:
        lean = (e["x1"] - e["x0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0))
        return F.struct(
            F.least(e["y0"], e["y1"]).alias("low"), F.greatest(e["y0"], e["y1"]).alias("high"),
            lean.alias("lean"), (e["x0"] - lean * e["y0"]).alias("foot"))

    return F.transform(F.filter(ring_edges(ring), lambda e: e["y0"] != e["y1"]), span)


def usable_rings(rings: Column) -> Column:
    return F.filter(F.coalesce(rings, F.array()), lambda r: F.size(r) >= 3)


def layer(rings: Column) -> Column:
    """Bounding box and spans of a list of rings; null when no ring has three points."""
    good = usable_rings(rings)
    points = F.flatten(good)
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.when(F.size(good) > 0, F.struct(
        F.array_min(xs).alias("min_x"), F.array_max(xs).alias("max_x"),
        F.array_min(ys).alias("min_y"), F.array_max(ys).alias("max_y"),
        F.transform(good, ring_spans).alias("spans")))


def inside_spans(spans: Column, x: Column, y: Column) -> Column:
    """Odd number of edges crossed going right from the point."""
    return F.size(F.filter(spans, lambda e: (y >= e["low"]) & (y < e["high"]) & (
        x < e["lean"] * y + e["foot"]))) % 2 == 1


def inside_layer(of: Column, x: Column, y: Column) -> Column:
    """Whether the point lies in any ring of the layer; false for an absent layer."""
    in_box = x.between(of["min_x"], of["max_x"]) & y.between(of["min_y"], of["max_y"])
    return F.when(of.isNull(), F.lit(False)).when(
        in_box, F.exists(of["spans"], lambda s: inside_spans(s, x, y))).otherwise(F.lit(False))


def edge_distance(ring: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the nearest edge of a ring."""
    def to_edge(e: Column) -> Column:
        dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]
        length = F.nullif(dx * dx + dy * dy, F.lit(0.0))
        along = F.coalesce(((x - e["x0"]) * dx + (y - e["y0"]) * dy) / length, F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        return F.hypot(x - e["x0"] - t * dx, y - e["y0"] - t * dy)

    return F.array_min(F.transform(ring_edges(ring), to_edge))


def area_centroid(ring: Column) -> Column:
    """Area centroid of a simple ring as a struct (x, y)."""
    start = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        cross = e["x0"] * e["y1"] - e["x1"] * e["y0"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (e["x0"] + e["x1"]) * cross).alias("x"),
            (acc["y"] + (e["y0"] + e["y1"]) * cross).alias("y"))

    total = F.aggregate(ring_edges(ring), start, add)
    area3 = F.nullif(3 * total["a"], F.lit(0.0))
    return F.struct((total["x"] / area3).alias("x"), (total["y"] / area3).alias("y"))


def metres(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Equirectangular distance."""
    north = (lat_a - lat_b) * METRES_PER_DEGREE
    east = (lon_a - lon_b) * METRES_PER_DEGREE * F.cos(F.radians(lat_a + lat_b) / 2)
    return F.hypot(north, east)


def axis(tee_lat: Column, tee_lon: Column, pin_lat: Column, pin_lon: Column) -> Column:
    """The tee-to-pin frame: unit vector (east, north), metres per degree of
    longitude, pin distance in yards and compass bearing."""
    metres_lon = METRES_PER_DEGREE * F.cos(F.radians(tee_lat))
    east = (pin_lon - tee_lon) * metres_lon
    north = (pin_lat - tee_lat) * METRES_PER_DEGREE
    length = F.hypot(east, north)
    return F.struct(
        tee_lat.alias("lat"), tee_lon.alias("lon"), metres_lon.alias("metres_lon"),
        (east / length).alias("east"), (north / length).alias("north"),
        (length * YARDS_PER_METRE).alias("pin_yards"),
        F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0)).alias("bearing"))


def project(frame: Column, lat: Column, lon: Column) -> Column:
    """`array(downrange, lateral)` yards in the frame, to 0.1; lateral is + to the right."""
    east = (lon - frame["lon"]) * frame["metres_lon"]
    north = (lat - frame["lat"]) * METRES_PER_DEGREE
    down = (east * frame["east"] + north * frame["north"]) * YARDS_PER_METRE
    right = (east * frame["north"] - north * frame["east"]) * YARDS_PER_METRE
    return F.array(F.round(down, 1), F.round(right, 1))
