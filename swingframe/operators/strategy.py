"""Where to aim: candidate aims priced over landing clouds.

Clouds are first reduced to distinct landings with a weight, so the work of an aim
grid follows the distinct cells of a cloud, not its rows. Each cell emits its aims in
the map stage and the price is averaged there before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import geometry as G
from swingframe.functions import strokes as S
from swingframe.functions import units as U
from swingframe.operators import elimination as E
from swingframe.operators import holes as H
from swingframe.operators.joins import lookup, spread_out
from swingframe.session import written

CLUB = ["bag_id", "club"]


def cloud_cells(clouds: DataFrame, centres: DataFrame | None = None) -> DataFrame:
    """Distinct landings `(bag_id, club, dx, dy, stock, n)` about each cloud's mean (or
    about given centres), with their weight."""
    cells = clouds.groupBy(*CLUB, "carry", "lateral").agg(F.count(F.lit(1)).alias("n"))
    means = centres if centres is not None else cloud_centres(clouds)
    placed = lookup(cells, means, CLUB, "inner")
    return placed.select(
        *CLUB, (F.col("carry") - F.col("stock")).alias("dx"),
        (F.col("lateral") - F.col("drift")).alias("dy"), "stock", "n")


def cloud_centres(clouds: DataFrame) -> DataFrame:
    return clouds.groupBy(*CLUB).agg(F.avg("carry").alias("stock"), F.avg("lateral").alias("drift"))


def _mean(value: Column) -> Column:
    return F.sum(value * F.col("n")) / F.sum("n")


def _share(flag: Column) -> Column:
    return F.sum(F.when(flag, F.col("n")).otherwise(0)) / F.sum("n")


def evaluate_aims(aimed: DataFrame) -> DataFrame:
    """Price every aim over its cloud on parametric holes.

    `aimed` has cells with their aims and their hole's columns: `(hole_id, bag_id, club,
    aim, aim_distance, aim_lateral, dx, dy, n, ...)`. Penalty balls cost their strokes plus
    an approach from the drop; proximity is over balls that stayed in play.
    """
    x, y = F.col("x"), F.col("y")
    placed = aimed.withColumns({
        "x": F.col("dx") + F.col("aim_distance"), "y": F.col("dy") + F.col("aim_lateral")})
    judged = placed.withColumns({
        "left_yards": H.parametric_remaining(x, y), "lie": H.parametric_lie(placed, x, y),
        "replay": H.penalty_replay(placed, x, y)})
    dry = F.col("replay").isNull()
    cost = F.coalesce("replay", S.curve_strokes(F.col("left_yards"), F.col("lie")))
    return judged.groupBy("hole_id", *CLUB, "aim", "aim_distance", "aim_lateral").agg(
        (1.0 + _mean(cost)).alias("expected_strokes"),
        _share(~dry).alias("penalty_pct"),
        _share(dry & (F.col("lie") == "green")).alias("frac_on_green"),
        (F.sum(F.when(dry, F.col("left_yards") * F.col("n")))
         / F.nullif(F.sum(F.when(dry, F.col("n"))), F.lit(0))).alias("mean_proximity_yards"))


def on_holes(cells: DataFrame, requests: DataFrame, holes: DataFrame) -> DataFrame:
    """Cells on the holes their bag is asked about, `requests` `(bag_id, hole_id)`."""
    asked = requests.select("bag_id", "hole_id").join(holes, "hole_id")
    placed = lookup(cells, asked, ["bag_id"], "inner")
    return spread_out(placed, "hole_id", *CLUB, "dx", "dy")


def candidate_aims(
    stocks: DataFrame, short: float = K.AIM_SHORT, long: float = K.AIM_LONG, span: float = 24.0, step: float = 3.0,
) -> DataFrame:
    """Every candidate aim `(aim, _i, _j, aim_distance, aim_lateral)` around a club's stock distance,
    downrange outer and lateral inner. Aims short of one yard are left out; a club too short
    for any of them is aimed at its stock distance."""
    deep, wide = int((short + long) / step + 1e-9) + 1, int(2 * span / step + 1e-9) + 1
    stock, i = F.col("stock"), F.floor(F.col("aim") / wide)
    reachable = stock - short + step * (deep - 1) >= 1.0
    distance = F.when(reachable, stock - short + i * step).when(i == 0, stock)
    aimed = stocks.withColumn("aim", F.explode(F.sequence(F.lit(0), F.lit(deep * wide - 1))))
    return aimed.withColumn("aim_distance", distance).where(
        F.col("aim_distance").isNotNull() & (~reachable | (F.col("aim_distance") >= 1.0))
    ).withColumns({"aim_lateral": (F.col("aim") - i * wide) * step - span, "_i": i, "_j": F.col("aim") - i * wide})


def worthy_aims(placed: DataFrame, requests: DataFrame, holes: DataFrame, short: float = K.AIM_SHORT, long: float = K.AIM_LONG,
                span: float = 24.0, step: float = 3.0) -> DataFrame:
    """`(hole_id, bag_id, club, aim, aim_distance, aim_lateral)` of the aims that may be the best of
    their club, by the bounds of `elimination`."""
    group = ["hole_id", *CLUB]
    deep, wide = int((short + long) / step + 1e-9) + 1, int(2 * span / step + 1e-9) + 1
    stocks = placed.select(*group, "stock").distinct()
    aims = candidate_aims(stocks, short, long, span, step)
    reachable = F.col("stock") - short + step * (deep - 1) >= 1.0
    counts = E.box_counts(placed, group, step)
    boxes = lookup(E.boxes_hit(counts, group, deep, wide), stocks, group, "inner").withColumns({
        "x": F.col("stock") - short + (F.col("_u") + 0.5) * step, "y": (F.col("_v") + 0.5) * step - span})
    bounds = E.parametric_bounds(lookup(boxes, holes, ["hole_id"], "inner"), step).select(*group, "_u", "_v", "low", "high")
    kept = E.surviving(counts, aims.where(reachable), bounds, group)
    return kept.unionByName(aims.where(~reachable)).select(*group, "aim", "aim_distance", "aim_lateral")


def at_aims(placed: DataFrame, aims: DataFrame, keys: list[str]) -> DataFrame:
    """Every landing at every aim of its group, which has some hundreds at most."""
    rest = [c for c in aims.columns if c not in keys]
    grouped = aims.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_aims"))
    return lookup(placed, grouped, keys, "inner").select(*placed.columns, F.inline("_aims"))


def best_aims(prices: DataFrame, keys: list[str], price: str = "expected_strokes") -> DataFrame:
    """The cheapest aim per group, the first candidate on a tie (prices compared to 1e-9,
    so that summation order does not break a tie)."""
    rest = [c for c in prices.columns if c not in keys]
    best = prices.groupBy(*keys).agg(
        F.min(F.struct(F.round(price, 9).alias("_price"), "aim", *[c for c in rest if c != "aim"])).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}") for c in rest])


def optimize_shots(clouds: DataFrame, requests: DataFrame, holes: DataFrame) -> DataFrame:
    """Per requested hole and bag, every club's best aim, ranked. Aims that cannot be the best
    are eliminated before they are priced."""
    cells = written(cloud_cells(clouds), "cloud-cells")
    asked = lookup(cells, requests.select("bag_id", "hole_id"), ["bag_id"], "inner")
    aims = written(worthy_aims(asked, requests, holes), "worthy-aims")
    placed = on_holes(cells, requests, holes)
    prices = evaluate_aims(at_aims(placed.drop("stock"), aims, ["hole_id", *CLUB]))
    best = best_aims(prices, ["hole_id", *CLUB])
    order = Window.partitionBy("hole_id", "bag_id").orderBy(F.round("expected_strokes", 9), "club")
    return best.withColumn("place", F.row_number().over(order).cast("bigint")).drop("aim")


def nearest_club(requests: DataFrame, centres: DataFrame, distance: str) -> DataFrame:
    """For every request of a bag the club whose stock is closest; a tie goes to the
    longer club. A bag has at most a set of clubs, so the pairs stay few per request."""
    keys = requests.columns
    pairs = requests.join(centres.select("bag_id", "club", "stock"), "bag_id")
    gap = F.round(F.abs(F.col("stock") - F.col(distance)), 9)
    chosen = pairs.groupBy(*keys).agg(
        F.min(F.struct(gap.alias("gap"), (-F.col("stock")).alias("_long"), "club", "stock")).alias("b"))
    return chosen.select(*keys, "b.club", "b.stock")


def naive_against_best(clouds: DataFrame, requests: DataFrame, holes: DataFrame) -> DataFrame:
    """The nearest club fired at the flag against the best aim, per requested hole and bag."""
    centres = cloud_centres(clouds)
    asked = requests.select("bag_id", "hole_id").join(holes.select("hole_id", "pin_distance"), "hole_id")
    naive_club = nearest_club(asked, centres, "pin_distance").drop("stock")
    cells = cloud_cells(clouds, centres).drop("stock")
    at_flag = lookup(cells, naive_club, CLUB, "inner").withColumns({
        "aim": F.lit(0), "aim_distance": F.col("pin_distance"), "aim_lateral": F.lit(0.0)})
    naive = evaluate_aims(at_flag.drop("pin_distance").join(holes, "hole_id")).select(
        "hole_id", "bag_id", F.col("club").alias("naive_club"),
        F.col("expected_strokes").alias("naive_strokes"), F.col("penalty_pct").alias("naive_penalty"))
    best = optimize_shots(clouds, requests, holes).where("place = 1").select(
        "hole_id", "bag_id", F.col("club").alias("best_club"), "aim_distance", "aim_lateral",
        F.col("expected_strokes").alias("best_strokes"))
    return naive.join(best, ["hole_id", "bag_id"]).withColumn(
        "saved", F.col("naive_strokes") - F.col("best_strokes"))


# ---- approaches to a pin on a polygon green -----------------------------
def price_approaches(balls: DataFrame, holes: DataFrame, raster: DataFrame | None = None) -> DataFrame:
    """Price balls `(hole_id, pin_x, pin_y, short_game, x, y, ...)` on polygon holes, adding
    `left_yards`, `lie` and `cost`: player strokes, more when above the hole, a fixed price
    in water. The layers are dropped in the projection that reads them, so rows carry
    them one step only; with a `raster` of squares that hold one lie, balls in these are not tested."""
    x, y = F.col("x"), F.col("y")
    shapes = holes.select("hole_id", "green_slope", "green_centre", "green_difficulty",
                          *[f"{n}_layer" for n in H.LAYERS])
    above = H.green_height(x, y) - H.green_height(F.col("pin_x"), F.col("pin_y"))
    lie, wet = H.polygon_lie(x, y), H.polygon_penalty(x, y)
    placed = balls
    if raster is not None:
        squares = balls.withColumns({"_x": F.floor(x), "_y": F.floor(y)})
        placed = lookup(squares, raster, ["hole_id", "_x", "_y"])
        sure = F.col("sure_lie").isNotNull()
        lie, wet = F.when(sure, F.col("sure_lie")).otherwise(lie), F.when(sure, F.col("sure_wet")).otherwise(wet)
    landed = placed.join(shapes, "hole_id").select(
        *balls.columns, F.hypot(F.col("pin_x") - x, F.col("pin_y") - y).alias("left_yards"),
        lie.alias("lie"), wet.alias("_wet"), above.alias("_above"), F.col("green_difficulty").alias("_difficulty"))
    base = S.player_strokes(F.col("left_yards"), F.col("lie"), F.col("short_game"), F.col("_difficulty"))
    sloped = F.when(F.col("lie") == "green", base + K.SLOPE_PUTT * F.col("_above")).otherwise(base)
    cost = F.when(F.col("_wet"), F.lit(K.WATER_STROKES)).otherwise(sloped)
    return landed.withColumn("cost", cost).drop("_wet", "_above", "_difficulty")


def _requested_cells(clouds: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests joined with the distinct landings of their nearest club, about the cloud's mean."""
    centres = cloud_centres(clouds)
    chosen = nearest_club(requests, centres, "from_distance").drop("stock")
    wanted = chosen.select(*CLUB).distinct()
    cells = cloud_cells(clouds.join(wanted, CLUB, "left_semi"), centres).drop("stock")
    asked = lookup(cells, chosen, CLUB, "inner")
    return spread_out(asked, *asked.columns)


APPROACH_STEP, APPROACH_LONG, APPROACH_RIGHT = 2.0, 24.0, 20.0  # yards: step, and how far aims go from the flag
APPROACH_DOWN, APPROACH_ACROSS = 17, 21  # aims


def aim_for_pin(clouds: DataFrame, pins: DataFrame, holes: DataFrame) -> DataFrame:
    """Best aim for each approach `(pin_id, bag_id, hole_id, pin_x, pin_y, from_distance,
    short_game)`: yards long and right of the flag, strokes, green share, proximity. Aims that cannot be
    the best are eliminated before they are priced."""
    group = ["pin_id", *CLUB]
    cells = written(_requested_cells(clouds, pins), "approach-cells")
    request = ["hole_id", "pin_x", "pin_y", "short_game"]
    asked = cells.select(*group, *request).distinct()
    grid = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(APPROACH_DOWN - 1)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(APPROACH_ACROSS - 1)), lambda j: F.struct(
            (i * APPROACH_ACROSS + j).alias("aim"), i.alias("_i"), j.alias("_j"),
            (i * APPROACH_STEP - APPROACH_LONG).alias("long_yds"), (j * APPROACH_STEP - APPROACH_RIGHT).alias("right_yds")))))
    counts = E.box_counts(cells, group, APPROACH_STEP)
    boxes = lookup(E.boxes_hit(counts, group, APPROACH_DOWN, APPROACH_ACROSS), asked, group, "inner").withColumns({
        "x": F.col("pin_x") - APPROACH_LONG + (F.col("_u") + 0.5) * APPROACH_STEP,
        "y": F.col("pin_y") - APPROACH_RIGHT + (F.col("_v") + 0.5) * APPROACH_STEP})
    shapes = holes.select("hole_id", "green_slope", "green_centre", "green_difficulty", *H.LAYERS, *[f"{n}_layer" for n in H.LAYERS])
    bounds = E.approach_bounds(lookup(spread_out(boxes, *group, "_u", "_v"), shapes, ["hole_id"], "inner"), APPROACH_STEP)
    kept = E.surviving(counts, asked.select(*group, F.inline(grid)), bounds.select(*group, "_u", "_v", "low", "high"), group)
    kept = written(kept.select(*group, "aim", "long_yds", "right_yds"), "approach-aims")
    balls = at_aims(cells, kept, group).withColumns({
        "x": F.col("pin_x") + F.col("long_yds") + F.col("dx"), "y": F.col("pin_y") + F.col("right_yds") + F.col("dy")})
    on_green = F.col("lie") == "green"
    raster = written(E.lie_raster(holes), "lie-raster")
    prices = price_approaches(balls, holes, raster).groupBy(*group, "aim", "long_yds", "right_yds").agg(
        _mean(F.col("cost")).alias("expected_strokes"), (100.0 * _share(on_green)).alias("on_green_pct"),
        (K.FEET_PER_YARD * F.sum(F.when(on_green, F.col("left_yards") * F.col("n")))
         / F.nullif(F.sum(F.when(on_green, F.col("n"))), F.lit(0))).alias("proximity_ft"))
    return best_aims(prices, ["pin_id", "bag_id"]).drop("aim")


def green_lattice(holes: DataFrame, step: float) -> DataFrame:
    """Lattice points of each green's bounding box that lie on the green, with their
    distance to its edge."""
    box = F.col("green_layer")

    def line(low: Column, high: Column) -> Column:
        count = F.greatest(F.ceil((high - low) / step).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: low + i * step)

    points = (
        holes.withColumn("px", F.explode(line(box["min_x"], box["max_x"])))
        .withColumn("py", F.explode(line(box["min_y"], box["max_y"])))
    )
    on_green = points.where(G.inside_layer(F.col("green_layer"), F.col("px"), F.col("py")))
    return on_green.withColumn("edge", G.edge_distance(F.col("green"), F.col("px"), F.col("py")))


def clamp_pins(pins: DataFrame, holes: DataFrame, margin: float = 3.0, step: float = 1.0) -> DataFrame:
    """Keep a pin that is `margin` inside the green; move any other to the nearest
    lattice point that is (to the nearest on the green when it is too small for that)."""
    lattice = green_lattice(holes, step).select("hole_id", "px", "py", "edge")
    deep = lattice.groupBy("hole_id").agg((F.max("edge") >= margin).alias("_deep"))
    legal = lattice.join(deep, "hole_id").where(~F.col("_deep") | (F.col("edge") >= margin)).drop("edge")
    shapes = holes.select("hole_id", "green", "green_layer")
    x, y = F.col("pin_x"), F.col("pin_y")
    placed = pins.join(shapes, "hole_id").withColumn(
        "_ok", G.inside_layer(F.col("green_layer"), x, y)
        & (G.edge_distance(F.col("green"), x, y) >= margin)).drop("green", "green_layer")
    kept = placed.where("_ok").select(*pins.columns, x.alias("clamped_x"), y.alias("clamped_y"))
    near = F.round(F.hypot(F.col("px") - x, F.col("py") - y), 9)
    moved = placed.where("NOT _ok").drop("_ok").join(legal.drop("_deep"), "hole_id").groupBy(
        *pins.columns).agg(F.min(F.struct(near.alias("d"), "px", "py")).alias("b")).select(
        *pins.columns, F.col("b.px").alias("clamped_x"), F.col("b.py").alias("clamped_y"))
    return kept.unionByName(moved)


def legal_pins(holes: DataFrame, step: float) -> DataFrame:
    """Candidate flags: the deepest inset that leaves any, on the gentler part of the green."""
    lattice = green_lattice(holes, step)
    deepest = F.max("edge").over(Window.partitionBy("hole_id"))
    inset = F.lit(None).cast("double")
    for want in reversed(K.PIN_INSETS):
        inset = F.when(F.col("_deepest") >= want, want).otherwise(inset)
    flags = lattice.withColumn("_deepest", deepest).where(F.col("edge") >= inset).withColumn(
        "_grade", H.green_grade(F.col("px"), F.col("py")))
    # A green's lattice is bounded by its area, so an exact percentile holds few values.
    cut = F.percentile("_grade", F.lit(K.PIN_GRADE_QUANTILE)).over(Window.partitionBy("hole_id"))
    curved = F.size(F.coalesce("green_quad", F.array().cast("array<double>"))) >= 6
    return flags.withColumn("_cut", cut).where(~curved | (F.col("_grade") <= F.col("_cut"))).select(
        "hole_id", F.col("px").alias("pin_x"), F.col("py").alias("pin_y"))


def pin_difficulty(
    clouds: DataFrame, requests: DataFrame, holes: DataFrame, step: float = 3.0
) -> DataFrame:
    """How hard each legal flag plays for a bag: the best of aiming at it or part of the
    way to the green's centre, and how much dearer that is than the kindest flag.
    `requests` has `(bag_id, hole_id, from_distance, short_game)`."""
    cells = _requested_cells(clouds, requests)
    flags = legal_pins(holes, step)
    centres = holes.select("hole_id", F.col("green_centre.x").alias("_cx"), F.col("green_centre.y").alias("_cy"))
    balls = cells.join(flags.join(centres, "hole_id"), "hole_id").select(
        "*", F.explode(F.array(F.lit(0.0), F.lit(0.3), F.lit(0.55))).alias("bail")).withColumns({
            "x": F.col("pin_x") + F.col("bail") * (F.col("_cx") - F.col("pin_x")) + F.col("dx"),
            "y": F.col("pin_y") + F.col("bail") * (F.col("_cy") - F.col("pin_y")) + F.col("dy")}).drop("_cx", "_cy")
    flag = ["hole_id", "bag_id", "pin_x", "pin_y"]
    raster = written(E.lie_raster(holes), "lie-raster")
    prices = price_approaches(balls, holes, raster).groupBy(
        *flag, "bail").agg(_mean(F.col("cost")).alias("price"))
    best = prices.groupBy(*flag).agg(F.round(F.round(F.min("price"), 9), 3).alias("expected"))
    return over_easiest(best, ["hole_id", "bag_id"], "expected").select(
        "hole_id", "bag_id", F.round("pin_x", 1).alias("pin_x"), F.round("pin_y", 1).alias("pin_y"),
        "expected", "over_easiest")


def over_easiest(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Difference from the group's minimum."""
    lowest = df.groupBy(*keys).agg(F.min(value).alias("_lowest"))
    return lookup(df, lowest, keys, "inner").withColumn(
        "over_easiest", F.round(F.col(value) - F.col("_lowest"), 3)).drop("_lowest")


# ---- conditions ---------------------------------------------------------
def conditions_on_holes(conditions: DataFrame, holes: DataFrame) -> DataFrame:
    """Air density and the wind in each hole's frame, for every scenario of a course:
    `conditions` `(scenario, course_id, wind_mph, wind_from_deg, temp_c, altitude_m)`."""
    angle = U.wind_angle(F.col("wind_from_deg"), F.col("bearing_deg"))
    return holes.join(conditions, "course_id").select(
        "scenario", "hole_id", U.air_density(F.col("temp_c"), F.col("altitude_m")).alias("air_density"),
        U.wind_downrange(F.col("wind_mph"), angle).alias("wind_x"),
        U.wind_lateral(F.col("wind_mph"), angle).alias("wind_y"),
        U.wind_class(F.col("wind_mph"), angle).alias("wind_class"))


def shift_clouds(clouds: DataFrame, deltas: DataFrame) -> DataFrame:
    """Move whole clouds by per-club deltas; a club without one stays where it is."""
    moved = lookup(clouds, deltas.select("club", "d_carry", "d_lateral"), ["club"])
    return moved.withColumns({
        "carry": F.col("carry") + F.coalesce("d_carry", F.lit(0.0)),
        "lateral": F.col("lateral") + F.coalesce("d_lateral", F.lit(0.0)),
    }).drop("d_carry", "d_lateral")


def shift_summaries(summaries: DataFrame, deltas: DataFrame) -> DataFrame:
    """The same shift on cloud summaries: places move, spreads stay; re-ranked by carry."""
    d = F.coalesce("d_carry", F.lit(0.0))
    joined = summaries.join(deltas.select("club", "d_carry", "d_lateral"), "club", "left")
    moved = joined.withColumns({
        **{c: F.col(c) + d for c in ("carry_mean_yards", "carry_p10_yards", "carry_p90_yards")},
        "lateral_mean_yards": F.col("lateral_mean_yards") + F.coalesce("d_lateral", F.lit(0.0)),
    }).drop("d_carry", "d_lateral")
    order = Window.partitionBy("bag_id").orderBy(F.desc("carry_mean_yards"), "club")
    return moved.withColumn("place", F.row_number().over(order).cast("bigint"))
