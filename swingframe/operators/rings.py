"""Validity of polygon rings: which rings membership tests may trust.

A ring is valid if it has three different points in a row, does not fold back on itself and if
no two of its edges touch but neighbours at the point they share. Edges are compared within a
ring only where their spans overlap: every edge is listed under the cells of the ring's longer
side that it touches (as many cells as the ring has edges), and edges of one cell are
compared. A ring of n edges so costs some multiple of n rows, spread by ring and cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe.functions.arrays import bound
from swingframe.operators import holes as H


def open_ring(ring: Column) -> Column:
    """The ring without points that repeat the one before them; so a closed ring is opened."""
    return bound(ring, lambda r: F.filter(r, lambda p, i: p != F.get(r, (i + F.size(r) - 1) % F.size(r))))


def turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Positive if a, b, c turn left, 0 if they lie on a line."""
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def folds_back(ring: Column) -> Column:
    """Whether an edge of an opened ring runs back along the one before it."""
    def any_fold(r: Column) -> Column:
        n = F.size(r)

        def fold(b: Column, i: Column) -> Column:
            a, c = F.get(r, (i + n - 1) % n), F.get(r, (i + 1) % n)
            back = (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1]) < 0
            return (turn(a[0], a[1], b[0], b[1], c[0], c[1]) == 0) & back

        return F.exists(F.transform(r, fold), lambda f: f)

    return bound(ring, any_fold)


def ring_edges(rings: DataFrame, keys: list[str]) -> DataFrame:
    """Edges `(keys, e_at, e_n, e_x0, e_y0, e_x1, e_y1, e_cell)` of opened rings `(keys, ring)`, one row for each cell."""
    def measured(ring: Column) -> Column:
        n, xs, ys = F.size(ring), F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
        wide, high = F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)
        edge = F.transform(ring, lambda p, i: F.struct(
            i.alias("e_at"), p[0].alias("e_x0"), p[1].alias("e_y0"),
            F.get(ring, (i + 1) % n)[0].alias("e_x1"), F.get(ring, (i + 1) % n)[1].alias("e_y1")))
        return F.struct(n.alias("n"), (wide >= high).alias("along"), F.when(wide >= high, F.array_min(xs)).otherwise(F.array_min(ys)).alias("low"),
                        (F.greatest(wide, high) / n).alias("width"), edge.alias("edges"))

    # what holds for a whole ring is worked out before its edges become rows
    ring = rings.select(*keys, bound(F.col("ring"), measured).alias("_m"))
    whole = ring.select(*keys, *[F.col(f"_m.{c}").alias(f"e_{c}") for c in ("n", "along", "low", "width", "edges")])
    rows = whole.select(*keys, "e_n", "e_along", "e_low", "e_width", F.inline("e_edges"))

    def cell(pick: Column) -> Column:
        return F.floor((pick - F.col("e_low")) / F.col("e_width"))

    a = F.when(F.col("e_along"), F.col("e_x0")).otherwise(F.col("e_y0"))
    b = F.when(F.col("e_along"), F.col("e_x1")).otherwise(F.col("e_y1"))
    touched = F.sequence(cell(F.least(a, b)), cell(F.greatest(a, b)))
    return rows.withColumn("e_cell", F.explode(touched)).drop("e_along", "e_low", "e_width")


def crossing_rings(rings: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the opened rings with two edges that touch without being neighbours."""
    edges = ring_edges(rings.where(F.size("ring") > 3), keys)
    own = [c for c in edges.columns if c not in keys]
    second = edges.select(*[F.col(k).alias(f"f_key_{k}") for k in keys], *[F.col(c).alias(f"f{c[1:]}") for c in own if c != "e_n"])
    same = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"f_key_{k}")) for k in keys], F.col("e_cell") == F.col("f_cell"))
    at, n, other = F.col("e_at"), F.col("e_n"), F.col("f_at")
    apart = (other - at >= 2) & ~((at == 0) & (other == n - 1))

    def span(edge: str, side: str) -> tuple[Column, Column]:
        ends = [F.col(f"{edge}_{side}{k}") for k in (0, 1)]
        return F.least(*ends), F.greatest(*ends)

    boxes = reduce(lambda p, q: p & q, [
        (span("e", s)[1] >= span("f", s)[0]) & (span("f", s)[1] >= span("e", s)[0]) for s in "xy"])

    def sides(p: str, q: str) -> Column:
        """The ends of edge q do not lie on one side of edge p."""
        line = [F.col(f"{p}_{c}") for c in ("x0", "y0", "x1", "y1")]
        ends = [turn(*line, F.col(f"{q}_x{k}"), F.col(f"{q}_y{k}")) for k in (0, 1)]
        return F.signum(ends[0]) * F.signum(ends[1]) <= 0

    met = edges.join(second, same).where(apart & boxes & sides("e", "f") & sides("f", "e"))
    return met.select(*keys).distinct()


def rejected_rings(rings: DataFrame, keys: list[str]) -> DataFrame:
    """`(keys, reason)` of the rings `(keys, ring)` that are no simple polygon: 'short' with fewer than
    three points, 'spike' where an edge runs back along the one before, 'crossing' where edges meet.
    A null ring is short; a ring with a null or non-finite coordinate has a 'point'."""
    def broken(p: Column) -> Column:
        return ~F.coalesce((F.size(p) == 2) & F.forall(p, lambda v: F.abs(v) < float("inf")), F.lit(False))

    whole = F.coalesce("ring", F.array().cast("array<array<double>>"))
    marked = rings.select(*keys, F.exists(whole, broken).alias("_broken"), whole.alias("ring"))
    opened = marked.withColumn("ring", F.when(~F.col("_broken"), open_ring(F.col("ring"))))
    by_row = opened.withColumn("_reason", F.when(F.col("_broken"), "point").when(F.size("ring") < 3, "short").when(folds_back(F.col("ring")), "spike"))
    crossing = crossing_rings(by_row.where("_reason IS NULL"), keys).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.lit("crossing").alias("_crossing"))
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return by_row.join(crossing, match, "left").select(
        *keys, F.coalesce("_reason", "_crossing").alias("reason")).where("reason IS NOT NULL")


# ---- the rings of a course ------------------------------------------------
def course_rings(holes: DataFrame) -> DataFrame:
    """`(hole_id, layer, at, ring)`, one row for each ring of course holes."""
    layers = F.array(*[
        F.struct(F.lit(name).alias("layer"), (F.array(name) if name == "green" else F.col(name)).alias("rings")) for name in H.LAYERS])
    return holes.select("hole_id", F.inline(layers)).select("hole_id", "layer", F.posexplode("rings").alias("at", "ring"))


def checked_course(holes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Course holes ready for membership tests without their invalid rings, and the rejected
    rings `(hole_id, layer, at, reason)`. A hole whose green is rejected has none."""
    every = course_rings(holes)
    bad = rejected_rings(every, ["hole_id", "layer", "at"])
    wrong = bad.groupBy("hole_id").agg(F.collect_set(F.struct("layer", "at")).alias("_bad"))
    joined = holes.join(wrong, "hole_id", "left")
    none = F.array().cast("array<struct<layer:string,at:int>>")

    def kept(name: str) -> Column:
        def fine(at: Column) -> Column:
            return ~F.array_contains(F.coalesce("_bad", none), F.struct(F.lit(name).alias("layer"), at.alias("at")))

        if name == "green":
            return F.when(fine(F.lit(0)), F.col(name))
        return F.filter(name, lambda _, i: fine(i))

    clean = joined.withColumns({name: kept(name) for name in H.LAYERS}).drop("_bad")
    return H.prepare_course(clean), bad
