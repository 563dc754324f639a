"""Spatial search over grid cells, for joins on place instead of on a shared key alone.

* `nearest` compares a place with the targets in the nine cells around it, and goes on with
  larger cells only for places whose nearest target could still lie outside.
* `inside_boxes` and `inside_rings` list boxes and the bands of rings under cells of a size that
  fits each of them, so a point meets the few that are near it.

No key's targets are gathered in one row or task; a key that owns many is cut by its cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe.constants import METRES_PER_DEGREE
from swingframe.functions import geometry as G
from swingframe.operators.joins import lookup
from swingframe.session import written

DEGREES = 0.004  # side of the first cells, some 400 m
WIDER = 4  # times as large are the next ones


def _cell(value: Column, size: float | Column) -> Column:
    return F.floor(value / size)


def reach(lat: Column, size: float) -> Column:
    """Metres within which a place's nine cells of `size` degrees hold every other place."""
    if size >= 360:
        return F.lit(float("inf"))
    east = F.cos(F.radians(F.least(F.abs(lat) + size, F.lit(90.0))))
    return size * METRES_PER_DEGREE * F.least(east, F.lit(1.0))


def around(places: DataFrame, size: float) -> DataFrame:
    """Each place once for every one of the nine cells `(_row, _column)` around it."""
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    return places.withColumn("_step", F.explode(steps)).withColumns({
        "_row": _cell(F.col("lat"), size) + F.col("_step.a"), "_column": _cell(F.col("lon"), size) + F.col("_step.b")}).drop("_step")


def close_pairs(places: DataFrame, targets: DataFrame, keys: list[str], size: float) -> DataFrame:
    """Places with the targets of equal keys in the nine cells around them, and their `metres`.

    Places have `lat` and `lon`; so have targets, which bring their other columns along."""
    listed = targets.select(
        *keys, *[c for c in targets.columns if c not in (*keys, "lat", "lon")], F.col("lat").alias("_lat"), F.col("lon").alias("_lon"),
        _cell(F.col("lat"), size).alias("_row"), _cell(F.col("lon"), size).alias("_column"))
    metres = G.metres(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
    return around(places, size).join(listed, [*keys, "_row", "_column"]).withColumn("metres", metres).drop(
        "_row", "_column", "_lat", "_lon")


def nearest(places: DataFrame, targets: DataFrame, keys: list[str], ids: list[str], rank: list[str], size: float = DEGREES) -> DataFrame:
    """`(ids, metres, rank...)`: for every place its nearest target of equal `keys`, by distance
    to 1e-6 m and then by `rank`. `ids` name a place and include the keys; a place without any
    target of its keys has no row.

    A place is done when its nearest target is closer than anything outside its nine cells can
    be; the others meet cells WIDER times as large. The driver sees a count each round."""
    fields = [c for c in ids if c not in ("lat", "lon")]
    left = written(places.select(*fields, "lat", "lon").join(targets.select(*keys).distinct(), keys, "left_semi"), "nearest-left")
    targets = written(targets.select(*keys, *[c for c in rank if c not in keys], "lat", "lon"), "nearest-targets")
    done: list[DataFrame] = []
    while True:
        best = F.min(F.struct(F.round("metres", 6).alias("metres"), *rank)).alias("_best")
        found = close_pairs(left, targets, keys, size).groupBy(*fields).agg(best)
        state = lookup(left, found, fields, null_safe=True)
        state = written(state.withColumn("_done", F.coalesce(F.col("_best.metres") < reach(F.col("lat"), size) - 1e-5, F.lit(False))), "nearest-state")
        done.append(state.where("_done"))
        left = state.where("NOT _done").select(*fields, "lat", "lon")
        if left.isEmpty():
            break
        size *= WIDER
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*fields, "_best.*")


# ---- boxes and rings around points ---------------------------------------
def _level(extent: Column, size: float) -> Column:
    """The number of doublings after which a cell is at least as large as `extent`."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(extent, F.lit(size)) / size))).cast("int")


def _levels(table: DataFrame) -> list[int]:
    """The levels in use: some sixty at most, as sizes double."""
    return sorted(r["_level"] for r in table.select("_level").distinct().collect())


def _side(level: Column, size: float) -> Column:
    return size * F.pow(F.lit(2.0), level)


def inside_boxes(points: DataFrame, boxes: DataFrame, key: str, bounds: tuple[str, str, str, str], size: float = 16.0) -> DataFrame:
    """Every pair of a point `(key, x, y)` and a box of equal key that touch, edges included.

    A box is listed under the four cells at most that it touches at the level where a cell is
    as large as the box; a point has one cell for each level in use."""
    low_x, high_x, low_y, high_y = (F.col(b) for b in bounds)
    sized = boxes.where((low_x <= high_x) & (low_y <= high_y)).withColumn("_level", _level(F.greatest(high_x - low_x, high_y - low_y), size))
    side = _side(F.col("_level"), size)
    listed = sized.withColumn("_row", F.explode(F.sequence(_cell(low_x, side), _cell(high_x, side)))) \
        .withColumn("_column", F.explode(F.sequence(_cell(low_y, side), _cell(high_y, side))))
    levels = F.array(*[F.lit(n) for n in _levels(sized)]).cast("array<int>")
    placed = points.withColumn("_level", F.explode(levels)).withColumns({
        "_row": _cell(F.col("x"), side), "_column": _cell(F.col("y"), side)})
    held = F.col("x").between(low_x, high_x) & F.col("y").between(low_y, high_y)
    return placed.join(listed, [key, "_level", "_row", "_column"]).where(held).drop("_level", "_row", "_column")


EDGES_IN_BAND = 8


def ring_bands(rings: DataFrame, key: str, size: float = 4.0) -> DataFrame:
    """Rings `(key, ..., ring)` in horizontal bands: `(key, ..., _level, _band, _min_x, _max_x, _spans)`, a
    row for each band, with the few edges a line in it can cross. A ring's bands are of a height
    that leaves about EDGES_IN_BAND edges to each."""
    rest = [c for c in rings.columns if c != "ring"]
    good = rings.where(F.size("ring") >= 3)
    ys, xs = F.transform("ring", lambda p: p[1]), F.transform("ring", lambda p: p[0])
    height = (F.array_max(ys) - F.array_min(ys)) * EDGES_IN_BAND / F.size("ring")
    spans = good.select(*rest, _level(height, size).alias("_level"), F.array_min(xs).alias("_min_x"), F.array_max(xs).alias("_max_x"),
                        F.explode(G.ring_spans(F.col("ring"))).alias("_span"))
    side = _side(F.col("_level"), size)
    banded = spans.withColumn("_band", F.explode(F.sequence(_cell(F.col("_span.low"), side), _cell(F.col("_span.high"), side))))
    return banded.groupBy(*rest, "_level", "_band").agg(
        F.first("_min_x").alias("_min_x"), F.first("_max_x").alias("_max_x"), F.collect_list("_span").alias("_spans"))


def inside_rings(points: DataFrame, rings: DataFrame, key: str, size: float = 4.0) -> DataFrame:
    """Every pair of a point `(key, x, y)` and a ring `(key, ..., ring)` of equal key that holds it."""
    bands = written(ring_bands(rings, key, size), "ring-bands")
    levels = F.array(*[F.lit(n) for n in _levels(bands)]).cast("array<int>")
    placed = points.withColumn("_level", F.explode(levels)).withColumn("_band", _cell(F.col("y"), _side(F.col("_level"), size)))
    x, y = F.col("x"), F.col("y")
    held = x.between(F.col("_min_x"), F.col("_max_x")) & G.inside_spans(F.col("_spans"), x, y)
    return placed.join(bands, [key, "_level", "_band"]).where(held).drop("_level", "_band", "_min_x", "_max_x", "_spans")
