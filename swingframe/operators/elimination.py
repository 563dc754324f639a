"""Exact elimination of aims before they are priced over whole clouds.

A cloud's landings are counted in square boxes as wide as the step between aims, so moving the aim
moves a box onto another box. For every box that some aim puts balls into, a least and a greatest price
of any ball inside follow from the distances that its corners allow and the lies that it can hold. Summed over the
boxes of a cloud they bound what an aim costs; an aim whose lower bound is above another's upper
bound cannot be the best and is not priced. What is left is priced on every landing, so the answer,
its ties included, is that of pricing all.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import geometry as G
from swingframe.functions import strokes as S
from swingframe.operators import holes as H
from swingframe.operators.joins import lookup

MARGIN = 1e-6  # of a price, and of a box's side: bounds are sums in another order than prices


@dataclass
class Case:
    """A lie that a box may hold: whether it can, whether all of the box does, and its price there."""

    may: Column
    must: Column
    least: Column
    greatest: Column


def bounds_of(cases: list[Case]) -> tuple[Column, Column]:
    """Least and greatest price over cases in order of precedence; a case that must hold ends the list."""
    open_, lows, highs = F.lit(True), [], []
    for case in cases:
        lows.append(F.when(open_ & case.may, case.least))
        highs.append(F.when(open_ & case.may, case.greatest))
        open_ = open_ & ~case.must
    return F.least(*lows), F.greatest(*highs)


def box_counts(cells: DataFrame, group: list[str], step: float) -> DataFrame:
    """`(group, _a, _b, n)`: balls by box, from landings `(group, dx, dy, n)`."""
    return cells.groupBy(*group, F.floor(F.col("dx") / step).alias("_a"), F.floor(F.col("dy") / step).alias("_b")).agg(F.sum("n").alias("n"))


def boxes_hit(counts: DataFrame, group: list[str], down: int, across: int) -> DataFrame:
    """`(group, _u, _v)`: every box that some aim of a grid of `down` x `across` can put balls into."""
    span = counts.groupBy(*group).agg(*[f(c).alias(f"{n}{c}") for c in ("_a", "_b") for n, f in (("low", F.min), ("high", F.max))])
    rows = span.withColumn("_u", F.explode(F.sequence(F.col("low_a"), F.col("high_a") + down - 1)))
    return rows.withColumn("_v", F.explode(F.sequence(F.col("low_b"), F.col("high_b") + across - 1))).select(*group, "_u", "_v")


def surviving(counts: DataFrame, aims: DataFrame, bounds: DataFrame, group: list[str]) -> DataFrame:
    """`aims` `(group, aim, _i, _j, ...)` without those that cannot be their group's best.

    `bounds` has `(group, _u, _v, low, high)`; every box of an aim must be among them."""
    placed = counts.join(aims.select(*group, "aim", "_i", "_j"), group).select(
        *group, "aim", "n", (F.col("_a") + F.col("_i")).alias("_u"), (F.col("_b") + F.col("_j")).alias("_v"))
    priced = placed.join(bounds, [*group, "_u", "_v"]).groupBy(*group, "aim").agg(
        (F.sum(F.col("n") * F.col("low")) / F.sum("n")).alias("_low"), (F.sum(F.col("n") * F.col("high")) / F.sum("n")).alias("_high"))
    best = priced.groupBy(*group).agg(F.min("_high").alias("_best"))
    kept = lookup(priced, best, group, "inner").where(F.col("_low") <= F.col("_best") + MARGIN).select(*group, "aim")
    return aims.join(kept, [*group, "aim"], "left_semi")


# ---- distances ------------------------------------------------------------
def _farthest(centre: Column, half: float) -> Column:
    return F.abs(centre) + half


def _closest(centre: Column, half: float) -> Column:
    return F.greatest(F.abs(centre) - half, F.lit(0.0))


def distances(x: Column, y: Column, half: float) -> tuple[Column, Column]:
    """Least and greatest distance from the origin to a point of the box around (x, y)."""
    return F.hypot(_closest(x, half), _closest(y, half)), F.hypot(_farthest(x, half), _farthest(y, half))


# ---- parametric holes -------------------------------------------------------
def parametric_bounds(boxes: DataFrame, step: float) -> DataFrame:
    """Price bounds of boxes with centres `(x, y)` on rows that carry their parametric hole.

    Curves do not fall with distance, so a lie's price lies between those of the nearest
    and the farthest point of the box."""
    half = step / 2 + MARGIN
    x, y = F.col("x"), F.col("y")
    near, far = distances(F.col("pin_distance") - x, y, half)

    def rect(name: str) -> tuple[Column, Column]:
        a, b, c, d = (F.col(f"{name}.{side}") for side in ("near", "far", "left", "right"))
        touches = (x + half >= a) & (x - half <= b) & (y + half >= c) & (y - half <= d)
        holds = (x - half >= a) & (x + half <= b) & (y - half >= c) & (y + half <= d)
        return F.coalesce(touches, F.lit(False)), F.coalesce(holds, F.lit(False))

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda p, q: p | q, tests, F.lit(False))

    def lie(name: str, may: Column, must: Column) -> Case:
        kind = F.lit(name)
        return Case(may, must, S.curve_strokes(near, kind), S.curve_strokes(far, kind))

    cases = []
    wet, sand = ([(c, *rect(c)) for c in H.slots(boxes, sort)] for sort in ("wet", "sand"))
    if wet:
        costs = [F.when(touch, F.col(f"{c}.cost")) for c, touch, _ in wet]
        none = [F.lit(None).cast("double")] * 2  # least and greatest take two columns
        cases.append(Case(any_of([t for _, t, _ in wet]), any_of([h for _, _, h in wet]), F.least(*costs, *none), F.greatest(*costs, *none)))
    if sand:
        cases.append(lie("sand", any_of([t for _, t, _ in sand]), any_of([h for _, _, h in sand])))
    cases.append(lie("green", near <= F.col("green_radius"), far <= F.col("green_radius")))
    cases.append(lie("fairway", _closest(y, half) <= F.col("half_width"), _farthest(y, half) <= F.col("half_width")))
    cases.append(lie("rough", F.lit(True), F.lit(True)))
    low, high = bounds_of(cases)
    return boxes.withColumns({"low": low, "high": high})


# ---- polygon holes ----------------------------------------------------------
def layer_state(name: str, x: Column, y: Column, half: float) -> tuple[Column, Column]:
    """Whether some, and whether all, of a box lies in a layer; where a ring's edge may pass
    through the box, some but perhaps not all does."""
    rings = F.array(name) if name == "green" else F.col(name)
    good = G.usable_rings(F.filter(F.coalesce(rings, F.array().cast("array<array<array<double>>>")), lambda r: r.isNotNull()))
    cut = F.exists(good, lambda r: G.edge_distance(r, x, y) <= half * 1.4143)
    inside = G.inside_layer(F.col(f"{name}_layer"), x, y)
    return cut | inside, ~cut & inside


def approach_bounds(boxes: DataFrame, step: float) -> DataFrame:
    """Price bounds of boxes with centres `(x, y)` on rows that carry their polygon hole, a pin and a
    `short_game`: as `strategy.price_approaches`, over every lie the box can hold."""
    half = step / 2 + MARGIN
    x, y = F.col("x"), F.col("y")
    pin_x, pin_y, skill, hard = (F.col(c) for c in ("pin_x", "pin_y", "short_game", "green_difficulty"))
    near, far = distances(pin_x - x, pin_y - y, half)
    sides = {name: layer_state(name, x, y, half) for name in H.LAYERS}
    states = boxes.withColumns({
        f"_{name}_{kind}": side for name, pair in sides.items() for kind, side in zip(("may", "must"), pair)}).withColumns({
            "_near": near, "_far": far})
    near, far = F.col("_near"), F.col("_far")

    def state(name: str, kind: str) -> Column:
        return F.col(f"_{name}_{kind}")

    def taxed(distance: Column, name: str, at: Column) -> Column:
        """The price with the tax of the ground at distance `at`."""
        return S.skill_tax(S.curve_strokes(distance, F.lit(name)), at, F.lit(name), skill, hard)

    def lie(name: str, may: Column, must: Column) -> Case:
        # the tax is one thing near the green and another beyond, so both ends of the box are tried
        least, greatest = (pick(taxed(d, name, near), taxed(d, name, far)) for pick, d in ((F.least, near), (F.greatest, far)))
        if name == "green":
            slope = F.col("green_slope")
            above = H.green_height(x, y) - H.green_height(pin_x, pin_y)
            swing = (F.abs(slope[0]) + F.abs(slope[1])) * half
            least, greatest = least + K.SLOPE_PUTT * (above - swing), greatest + K.SLOPE_PUTT * (above + swing)
        return Case(may, must, least, greatest)

    corridor = F.col("playable_layer").isNotNull()
    water = F.lit(K.WATER_STROKES)
    low, high = bounds_of([
        Case(state("water", "may"), state("water", "must"), water, water),
        *[lie(kind, state(layer, "may"), state(layer, "must")) for layer, kind in (("green", "green"), ("bunkers", "sand"), ("fairway", "fairway"))],
        lie("recovery", corridor & ~state("playable", "must"), corridor & ~state("playable", "may")),
        lie("rough", F.lit(True), F.lit(True))])
    return states.withColumns({"low": low, "high": high})


def lie_raster(holes: DataFrame, step: float = 1.0) -> DataFrame:
    """`(hole_id, _x, _y, sure_lie, sure_wet)`: squares of each hole, beside its green, fairways, bunkers and
    water, that hold one lie only. A ball in one of them needs no membership test."""
    half = step / 2 + MARGIN

    def edge(pick: str, side: str) -> Column:
        return getattr(F, pick)(*[F.col(f"{n}_layer.{side}") for n in ("green", "fairway", "bunkers", "water")])

    def line(low: Column, high: Column) -> Column:
        return F.sequence(F.floor(low / step) - 10, F.ceil(high / step) + 10)

    squares = holes.where(edge("least", "min_x").isNotNull()) \
        .withColumn("_x", F.explode(line(edge("least", "min_x"), edge("greatest", "max_x")))) \
        .withColumn("_y", F.explode(line(edge("least", "min_y"), edge("greatest", "max_y"))))
    x, y = (F.col("_x") + 0.5) * step, (F.col("_y") + 0.5) * step
    sides = [layer_state(name, x, y, half) for name in H.LAYERS]
    pure = reduce(lambda a, b: a & b, [may == must for may, must in sides])
    return squares.where(pure).select(
        "hole_id", "_x", "_y", H.polygon_lie(x, y).alias("sure_lie"), H.polygon_penalty(x, y).alias("sure_wet"))
