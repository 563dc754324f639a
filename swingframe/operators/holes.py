"""Holes: where a ball lies, what a penalty costs, and how the ground rises."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import cleaning as C
from swingframe.functions import geometry as G
from swingframe.functions import strokes as S
from swingframe.operators.cells import inside_boxes

LAYERS = ["green", "fairway", "bunkers", "water", "playable"]


# ---- parametric holes ---------------------------------------------------
def is_penalty(kind: Column) -> Column:
    return kind.isin("water", "ob")


def lay_regions(holes: DataFrame, regions: DataFrame) -> DataFrame:
    """Holes with their rectangles laid out as struct columns `sand_0, sand_1, ...` and
    `wet_0, ...` (in the order given, each wet one with its replay cost).

    A hole has a handful of rectangles, and columns instead of an array keep the test of
    a landing inside generated code. One small aggregate finds how many columns it takes.
    """
    drop = F.coalesce("drop_distance", F.col("pin_distance") - K.DROP_BACK_YARDS)
    priced = regions.join(holes.select("hole_id", "pin_distance"), "hole_id").select(
        "hole_id", "ord", F.when(is_penalty(F.col("kind")), "wet").when(F.col("kind") == "sand", "sand").alias("sort"),
        F.struct(
            "near", "far", "left", "right", F.col("penalty_strokes").alias("strokes"), drop.alias("drop"),
            (F.col("penalty_strokes") + S.approach_strokes(F.abs(F.col("pin_distance") - drop))).alias("cost"),
        ).alias("box"),
    ).where("sort IS NOT NULL")
    order = Window.partitionBy("hole_id", "sort").orderBy("ord")
    placed = priced.withColumn("at", F.row_number().over(order) - 1)
    widths = {r.sort: r.n for r in placed.groupBy("sort").agg((F.max("at") + 1).alias("n")).collect()}
    slots = [(sort, i) for sort, n in sorted(widths.items()) for i in range(n)]
    if not slots:
        return holes
    laid = placed.groupBy("hole_id").agg(*[
        F.max(F.when((F.col("sort") == sort) & (F.col("at") == i), F.col("box"))).alias(f"{sort}_{i}")
        for sort, i in slots
    ])
    return holes.join(laid, "hole_id", "left")


def slots(df: DataFrame, sort: str) -> list[str]:
    return sorted((c for c in df.columns if c.startswith(f"{sort}_")), key=lambda c: int(c.split("_")[1]))


def in_box(box: str, x: Column, y: Column) -> Column:
    inside = x.between(F.col(f"{box}.near"), F.col(f"{box}.far")) & y.between(
        F.col(f"{box}.left"), F.col(f"{box}.right"))
    return F.coalesce(inside, F.lit(False))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def points_in_regions(points: DataFrame, regions: DataFrame) -> DataFrame:
    """Every (point, rectangle) pair of a hole that touch, edges included."""
    boxes = regions.select("hole_id", "region_id", "kind", *[F.col(c).alias(f"_{c}") for c in ("near", "far", "left", "right")])
    return inside_boxes(points, boxes, "hole_id", ("_near", "_far", "_left", "_right")).select(*points.columns, "region_id", "kind")


def parametric_remaining(x: Column, y: Column) -> Column:
    return F.hypot(F.col("pin_distance") - x, y)


def parametric_lie(df: DataFrame, x: Column, y: Column) -> Column:
    """Rough, then fairway by half width, green by radius, sand last."""
    return (
        F.when(_any([in_box(c, x, y) for c in slots(df, "sand")]), "sand")
        .when(parametric_remaining(x, y) <= F.col("green_radius"), "green")
        .when(F.abs(y) <= F.col("half_width"), "fairway").otherwise("rough")
    )


def parametric_penalty(df: DataFrame, x: Column, y: Column) -> Column:
    return _any([in_box(c, x, y) for c in slots(df, "wet")])


def penalty_replay(df: DataFrame, x: Column, y: Column) -> Column:
    """Cost of the last penalty rectangle the point is in: its strokes plus an approach
    from its drop (or from short of the pin where it names none); null when dry."""
    cost = C.null_of("double")
    for c in slots(df, "wet"):
        cost = F.when(in_box(c, x, y), F.col(f"{c}.cost")).otherwise(cost)
    return cost


def parametric_bounds(holes: DataFrame) -> DataFrame:
    """Grid extent, replay point and penalty strokes of each parametric hole."""
    reach = F.greatest(F.col("half_width") + 25.0, F.lit(40.0))
    wet = slots(holes, "wet")
    default_drop = F.col("pin_distance") - K.DROP_BACK_YARDS
    return holes.withColumns({
        "min_x": F.lit(0.0), "max_x": F.col("pin_distance") + 40.0, "min_y": -reach, "max_y": reach,
        "drop_x": F.coalesce(F.col(f"{wet[0]}.drop"), default_drop) if wet else default_drop,
        "penalty_cost": F.coalesce(F.col(f"{wet[0]}.strokes"), F.lit(1.0)) if wet else F.lit(1.0),
    })


def classify_parametric(points: DataFrame, holes: DataFrame) -> DataFrame:
    """Lie, remaining distance and penalty flag of points `(hole_id, x, y)`."""
    x, y = F.col("x"), F.col("y")
    placed = points.join(holes, "hole_id")
    return placed.select(
        *points.columns, parametric_remaining(x, y).alias("remaining"),
        parametric_lie(placed, x, y).alias("lie"), parametric_penalty(placed, x, y).alias("in_penalty"))


# ---- polygon holes ------------------------------------------------------
def prepare_course(holes: DataFrame) -> DataFrame:
    """Course holes with one membership struct per layer, beside its rings, and the green's centroid.
    `green` is a ring; every other layer is a list of rings."""
    ready = holes
    for name in LAYERS:
        rings = F.array(name) if name == "green" else F.col(name)
        ready = ready.withColumn(f"{name}_layer", G.layer(rings))
    return ready.withColumn("green_centre", G.area_centroid(F.col("green")))


def polygon_lie(x: Column, y: Column) -> Column:
    """Rough, recovery outside the playable corridor, fairway, sand, green: later wins."""
    def within(name: str) -> Column:
        return G.inside_layer(F.col(f"{name}_layer"), x, y)

    return (
        F.when(within("green"), "green").when(within("bunkers"), "sand")
        .when(within("fairway"), "fairway")
        .when(F.col("playable_layer").isNotNull() & ~within("playable"), "recovery")
        .otherwise("rough")
    )


def polygon_penalty(x: Column, y: Column) -> Column:
    return G.inside_layer(F.col("water_layer"), x, y)


def course_bounds(holes: DataFrame) -> DataFrame:
    """Grid extent with margins, lay-up point short of the water, penalty strokes."""
    def edge(pick: str, side: str, names: list[str]) -> Column:
        return getattr(F, pick)(*[F.col(f"{n}_layer.{side}") for n in names])

    names = ["green", "fairway", "bunkers", "water"]
    drop = F.greatest(F.lit(0.0), F.col("water_layer.min_x") - 5.0)
    return holes.withColumns({
        "min_x": F.least(F.lit(0.0), edge("least", "min_x", names) - 10.0),
        "max_x": F.greatest(edge("greatest", "max_x", names), F.col("pin_distance")) + 20.0,
        "min_y": F.least(F.lit(-40.0), edge("least", "min_y", names) - 15.0),
        "max_y": F.greatest(F.lit(40.0), edge("greatest", "max_y", names) + 15.0),
        "drop_x": F.coalesce(drop, F.col("pin_distance") - K.DROP_BACK_YARDS),
        "penalty_cost": F.lit(1.0),
    })


def classify_polygon(points: DataFrame, holes: DataFrame) -> DataFrame:
    """Lie, remaining distance and water flag of points `(hole_id, x, y)`."""
    x, y = F.col("x"), F.col("y")
    return points.join(holes, "hole_id").select(
        *points.columns, F.hypot(F.col("pin_distance") - x, y).alias("remaining"),
        polygon_lie(x, y).alias("lie"), polygon_penalty(x, y).alias("in_penalty"))


# ---- greens and ground --------------------------------------------------
def green_height(x: Column, y: Column) -> Column:
    """Height of the putting surface relative to the green's centre, from its tilt plane."""
    slope = F.col("green_slope")
    return slope[0] * (x - F.col("green_centre.x")) + slope[1] * (y - F.col("green_centre.y"))


def green_grade(x: Column, y: Column) -> Column:
    """Local slope in percent: the quadratic surface's gradient, else the plane's."""
    q, slope = F.col("green_quad"), F.col("green_slope")
    curved = F.hypot(F.get(q, F.lit(1)) + 2 * F.get(q, F.lit(3)) * x + F.get(q, F.lit(4)) * y,
                     F.get(q, F.lit(2)) + F.get(q, F.lit(4)) * x + 2 * F.get(q, F.lit(5)) * y)
    return 100.0 * F.when(F.size(F.coalesce(q, F.array().cast("array<double>"))) >= 6, curved).otherwise(
        F.hypot(slope[0], slope[1]))


def ground_height(knots: Column, x: Column) -> Column:
    """Ground height at a downrange from a hole's profile `array<array<double>>`
    (sorted by downrange, flat past the ends; 0 without a profile)."""
    n = F.size(knots)
    after = F.size(F.filter(knots, lambda p: p[0] <= x))
    left = F.get(knots, F.greatest(after - 1, F.lit(0)))
    right = F.get(knots, F.least(after, n - 1))
    run = F.nullif(right[0] - left[0], F.lit(0.0))
    share = F.coalesce((x - left[0]) / run, F.lit(0.0))
    share = F.when(after == 0, 0.0).otherwise(share)
    return F.when(F.coalesce(n, F.lit(0)) <= 0, 0.0).otherwise(left[1] + share * (right[1] - left[1]))


def pick_tees(tees: DataFrame, holes: DataFrame) -> DataFrame:
    """One tee per hole and level: tees ranked longest first, Back the first, Middle the
    middle, Forward the last; a hole without tees plays from its pin distance."""
    order = Window.partitionBy("hole_id").orderBy(F.desc("yards"), "downrange", "lateral")
    count = F.count(F.lit(1)).over(Window.partitionBy("hole_id"))
    ranked = tees.withColumn("at", F.row_number().over(order) - 1).withColumn("n", count)
    levels = F.array(
        F.struct(F.lit("Back").alias("level"), F.lit(0).alias("want")),
        F.struct(F.lit("Middle").alias("level"), F.floor((F.col("n") - 1) / 2).cast("int").alias("want")),
        F.struct(F.lit("Forward").alias("level"), (F.col("n") - 1).cast("int").alias("want")))
    picked = ranked.withColumn("l", F.explode(levels)).where("l.want = at").select(
        "hole_id", "l.level", "downrange", "lateral", "yards")
    bare = holes.join(tees.select("hole_id").distinct(), "hole_id", "left_anti").select(
        "hole_id", F.explode(F.array(*map(F.lit, ["Back", "Middle", "Forward"]))).alias("level"),
        F.lit(0.0).alias("downrange"), F.lit(0.0).alias("lateral"), F.col("pin_distance").alias("yards"))
    return picked.unionByName(bare)


def plays_like(tees: DataFrame, holes: DataFrame) -> DataFrame:
    """Net rise from tee to pin and the yardage the hole plays like."""
    rise = ground_height(F.col("elevation"), F.col("pin_distance")) - ground_height(
        F.col("elevation"), F.col("downrange"))
    return tees.join(holes.select("hole_id", "pin_distance", "elevation"), "hole_id").select(
        *tees.columns, rise.alias("net_rise"),
        (F.col("yards") + K.ELEVATION_CARRY * rise).alias("plays_like"))
