"""Whole-hole planning as tables: grid, stencils, value sweeps and the plan they give.

A scenario is one player's bag on one hole. One sweep is factorised: the expected cost
of a club landing around a cell is computed once per (club, lie class) as stencil times
value table, and every aim then only looks it up at a shifted cell. Every table is keyed
by scenario first, so many holes, bags and conditions are swept together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import strokes as S
from swingframe.operators import holes as H
from swingframe.operators.joins import lookup
from swingframe.session import bucketed, written

CELL = ["scenario", "i", "j"]


# ---- grid ---------------------------------------------------------------
def _centres(low: Column, count: Column, size: float) -> Column:
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: low + k * size)


def _nearest_zero(centres: Column) -> Column:
    return F.array_min(F.transform(centres, lambda v, k: F.struct(F.abs(v).alias("d"), k.alias("k"))))["k"]


def _cell_at(value: Column, first: Column, count: Column, size: float) -> Column:
    """Index of the first centre at or past a value, kept on the grid."""
    return F.least(F.greatest(F.ceil((value - first) / size).cast("int"), F.lit(0)), count - 1)


def grid_frames(holes: DataFrame, size: float) -> DataFrame:
    """Per hole with bounds: first centres, cell counts, tee cell and drop cell."""
    framed = holes.withColumns({
        "x0": F.col("min_x") + size / 2, "y0": F.col("min_y") + size / 2}).withColumns({
            "nx": F.ceil((F.col("max_x") - F.col("x0")) / size).cast("int"),
            "ny": F.ceil((F.col("max_y") - F.col("y0")) / size).cast("int")})
    return framed.withColumns({
        "tee_i": _nearest_zero(_centres(F.col("x0"), F.col("nx"), size)),
        "tee_j": _nearest_zero(_centres(F.col("y0"), F.col("ny"), size)),
        "drop_i": _cell_at(F.col("drop_x"), F.col("x0"), F.col("nx"), size)})


def hole_grid(frames: DataFrame, size: float, polygon: bool) -> DataFrame:
    """Cell centres with remaining distance, lie, lie class and penalty flag."""
    cells = (
        frames.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
        .withColumns({"x": F.col("x0") + F.col("i") * size, "y": F.col("y0") + F.col("j") * size})
    )
    x, y = F.col("x"), F.col("y")
    lie = H.polygon_lie(x, y) if polygon else H.parametric_lie(cells, x, y)
    wet = H.polygon_penalty(x, y) if polygon else H.parametric_penalty(cells, x, y)
    return cells.select(
        "hole_id", "i", "j", "x", "y", F.hypot(F.col("pin_distance") - x, y).alias("remaining"),
        lie.alias("lie"), wet.alias("in_penalty")).withColumn("lie_class", lie_class(F.col("lie")))


def lie_class(lie: Column) -> Column:
    return F.when(lie.isin("rough", "sand", "recovery"), lie).otherwise("clean")


# ---- stencils -----------------------------------------------------------
def stencils(clouds: DataFrame, skews: DataFrame, size: float) -> DataFrame:
    """Share of landings `p` per offset `(di, dj)` for every club and lie class. A skew
    stretches one side of the lateral scatter and is recentred, so the aim stays the mean."""
    keys = ["bag_id", "club"]
    cells = clouds.groupBy(*keys, "carry", "lateral").agg(F.count(F.lit(1)).alias("n"))
    means = cells.groupBy(*keys).agg(
        (F.sum(F.col("carry") * F.col("n")) / F.sum("n")).alias("_c"),
        (F.sum(F.col("lateral") * F.col("n")) / F.sum("n")).alias("_l"), F.sum("n").alias("_size"))
    means = means.join(skews.select("bag_id", "skew"), "bag_id", "left").withColumn(
        "skew", F.coalesce("skew", F.lit(0.0)))
    side = F.col("lateral") - F.col("_l")
    bent = lookup(cells, means, keys, "inner").select(
        *keys, "n", "_size", (F.col("carry") - F.col("_c")).alias("down"),
        (side * (1.0 + F.col("skew") * F.signum(side))).alias("across"))
    drift = bent.groupBy(*keys).agg((F.sum(F.col("across") * F.col("n")) / F.sum("n")).alias("_drift"))
    classes = F.explode(F.array(*[
        F.struct(F.lit(name).alias("lie_class"), F.lit(spread).alias("spread"))
        for name, (_, spread) in K.LIE_PLAY.items()]))

    def offset(residual: Column) -> Column:
        # A first rounding takes out the noise of the mean, which would decide a half.
        return F.rint(F.round(residual * F.col("s.spread") / size, 9)).cast("int")

    spread = lookup(bent, drift, keys, "inner").withColumn("s", classes)
    return spread.groupBy(
        *keys, F.col("s.lie_class").alias("lie_class"), offset(F.col("down")).alias("di"),
        offset(F.col("across") - F.col("_drift")).alias("dj"),
    ).agg((F.sum("n") / F.max("_size")).alias("p"))


def bag_clubs(clouds: DataFrame) -> DataFrame:
    """A bag's clubs with their mean carry, longest first."""
    order = Window.partitionBy("bag_id").orderBy(F.desc("carry"), "club")
    means = clouds.groupBy("bag_id", "club").agg(F.round(F.avg("carry"), 9).alias("carry"))
    return means.withColumn("place", F.row_number().over(order) - 1)


# ---- scenario tables ----------------------------------------------------
def scenario_cells(scenarios: DataFrame, frames: DataFrame, grid: DataFrame, clubs: DataFrame, size: float) -> DataFrame:
    """Every scenario's cells with the short-game floor: inside the shortest club's range
    the player can always hole out in the benchmark strokes, beyond it there is no such option.
    `scenarios` has `(scenario, hole_id, bag_id, start_x, start_y, short_game)`; a null start
    is the tee."""
    short = clubs.groupBy("bag_id").agg(F.min("carry").alias("short_range"))
    heads = frames.select("hole_id", "nx", "ny", "x0", "y0", "tee_i", "tee_j", "drop_i",
                          "penalty_cost", "green_difficulty", *(["elevation"] if "elevation" in frames.columns else []))
    asked = scenarios.join(short, "bag_id").join(heads, "hole_id").withColumns({
        "start_i": F.when(F.col("start_x").isNull(), F.col("tee_i")).otherwise(
            _cell_at(F.col("start_x"), F.col("x0"), F.col("nx"), size)),
        "start_j": F.when(F.col("start_y").isNull(), F.col("tee_j")).otherwise(
            _cell_at(F.col("start_y"), F.col("y0"), F.col("ny"), size))})
    floor = F.when(
        F.col("remaining") <= F.col("short_range"),
        S.player_strokes(F.col("remaining"), F.col("lie"), F.col("short_game"), F.col("green_difficulty")),
    ).otherwise(K.UNREACHABLE_STROKES)
    cells = grid.join(asked, "hole_id").withColumn("floor", floor)
    if "elevation" not in cells.columns:
        cells = cells.withColumn("elevation", F.lit(None).cast("array<array<double>>"))
    return cells


AIM_DOWN = sorted({  # whole cells short or long of stock, from an even spread of yards
    d for d in [-K.AIM_SHORT + k * (K.AIM_SHORT + K.AIM_LONG) / (K.AIM_STEPS - 1) for k in range(K.AIM_STEPS)]})


def aim_offsets(size: float) -> list[tuple[int, int]]:
    """Distinct (downrange, lateral) cell offsets, in search order."""
    down = sorted({round(d / size) for d in AIM_DOWN})  # round() is half-even, as needed
    across = sorted({round(d / size) for d in K.AIM_LATERALS})
    return [(a, b) for a in down for b in across]


def candidates(cells: DataFrame, clubs: DataFrame, size: float) -> DataFrame:
    """Every (club, aim) open to a cell, with the cell it is aimed at. The club plays from
    the cell's own lie class, lands shorter uphill, and the driver is for the tee row only."""
    carry = F.lit(None).cast("double")
    for name, (multiple, _) in K.LIE_PLAY.items():
        carry = F.when(F.col("lie_class") == name, multiple).otherwise(carry)
    stock = F.rint(F.round(F.col("carry") * carry / size, 9)).cast("int")
    land = F.greatest(F.lit(0), F.least(F.col("nx") - 1, F.col("i") + F.col("stock")))
    rise = H.ground_height(F.col("elevation"), F.col("x0") + land * size) - H.ground_height(
        F.col("elevation"), F.col("x0") + F.col("i") * size)
    uphill = F.rint(F.round(K.ELEVATION_CARRY * rise / size, 9)).cast("int")
    aims = aim_offsets(size)
    options = F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(a).alias("down"), F.lit(b).alias("across"))
        for n, (a, b) in enumerate(aims)]))
    return (
        cells.join(clubs, "bag_id").where((F.col("club") != "Driver") | (F.col("i") == F.col("start_i")))
        .withColumn("stock", stock).withColumn("reach", F.col("stock") - uphill)
        .select(*CELL, "bag_id", "lie_class", "club", "place", "reach", "nx", "ny", options.alias("o"))
        .select(
            *CELL, "lie_class", "club", (F.col("place") * len(aims) + F.col("o.n")).alias("choice"),
            (F.col("reach") + F.col("o.down")).alias("off_i"), F.col("o.across").alias("off_j"),
            (F.col("i") + F.col("reach") + F.col("o.down")).alias("to_i"),
            (F.col("j") + F.col("o.across")).alias("to_j"), "nx", "ny")
        .withColumn("on_grid", F.col("to_i").between(0, F.col("nx") - 1) & F.col("to_j").between(0, F.col("ny") - 1))
        .drop("nx", "ny")
    )


# ---- sweeps -------------------------------------------------------------
TARGET = ["scenario", "club", "lie_class", "to_i", "to_j"]


@dataclass(frozen=True)
class Board:
    """What every sweep of some scenarios reads, written once: cells with `is_drop`, shots `(scenario,
    club, lie_class, di, dj, p)`, and options in buckets of the landing cell they are priced at, so that a
    sweep moves values and prices only."""

    cells: DataFrame
    shots: DataFrame
    options: DataFrame

    def of(self, scenarios: DataFrame) -> Board:
        """The board of some of its scenarios."""
        return Board(*(t.join(scenarios, "scenario", "left_semi") for t in (self.cells, self.shots, self.options)))


def board(cells: DataFrame, shapes: DataFrame, options: DataFrame) -> Board:
    drop = (F.col("i") == F.col("drop_i")) & (F.col("j") == F.col("tee_j"))
    cells = written(cells.withColumn("is_drop", drop), "plan-cells")
    played = cells.select("scenario", "bag_id", "lie_class").distinct()
    shots = shapes.join(played, ["bag_id", "lie_class"]).select("scenario", "club", "lie_class", "di", "dj", "p")
    return Board(cells, written(shots, "plan-shots"), bucketed(options, TARGET, "plan_options"))


def landing_costs(on: Board, values: DataFrame) -> DataFrame:
    """Expected cost `(scenario, club, lie_class, to_i, to_j, q)` of a shot that lands around a cell:
    one plus stencil times value, water priced as penalty plus the drop's value and ground
    off the grid as lost. Cells meet stencils by scenario and club, so a scenario's product is spread."""
    valued = on.cells.select(*CELL, "in_penalty", "is_drop", "penalty_cost", "nx", "ny").join(values.select(*CELL, "v"), CELL)
    replay = valued.where("is_drop").select("scenario", (F.col("penalty_cost") + F.col("v")).alias("replay"))
    cost = F.when(F.col("in_penalty"), F.col("replay")).otherwise(F.col("v"))
    priced = lookup(valued, replay, ["scenario"], "inner").select(*CELL, "nx", "ny", cost.alias("cost"))
    clubs = on.shots.select("scenario", "club").distinct()
    reached = priced.join(clubs, "scenario").join(on.shots, ["scenario", "club"]).select(
        "scenario", "club", "lie_class", (F.col("i") - F.col("di")).alias("to_i"),
        (F.col("j") - F.col("dj")).alias("to_j"), "p", "cost", "nx", "ny",
    ).where(F.col("to_i").between(0, F.col("nx") - 1) & F.col("to_j").between(0, F.col("ny") - 1))
    return reached.groupBy(*TARGET).agg(
        (1.0 + F.sum(F.col("p") * F.col("cost")) + K.LOST_STROKES * (1.0 - F.sum("p"))).alias("q"))


def best_choices(on: Board, values: DataFrame) -> DataFrame:
    """One backup: per cell the cheapest (club, aim), the first in search order on a tie."""
    priced = on.options.join(landing_costs(on, values), TARGET, "left")
    cost = F.when(F.col("on_grid"), F.coalesce("q", F.lit(1.0 + K.LOST_STROKES))).otherwise(K.LOST_STROKES)
    best = priced.groupBy(*CELL).agg(F.min(F.struct(
        F.round(cost, 9).alias("_cost"), "choice", cost.alias("best"), "club", "off_i", "off_j")).alias("b"))
    return best.select(*CELL, "b.best", "b.choice", "b.club", "b.off_i", "b.off_j")


def sweep(on: Board, values: DataFrame) -> DataFrame:
    """New values: the short-game floor caps what the best full shot costs."""
    best = best_choices(on, values).select(*CELL, "best")
    return on.cells.select(*CELL, "floor").join(best, CELL, "left").join(
        values.select(*CELL, F.col("v").alias("before")), CELL).select(
        *CELL, F.least("floor", F.coalesce("best", F.col("floor"))).alias("v"), "before")


def first_values(cells: DataFrame) -> DataFrame:
    return cells.select(*CELL, F.col("floor").alias("v"))


def iterate(on: Board, tol: float = 1e-3, most: int | None = None) -> DataFrame:
    """Sweep until no value moves by `tol`. A scenario that has come to rest is set aside
    with the values of its last sweep, and only the others are swept again. Values only ever
    fall and are bounded below, so every scenario comes to rest; with `most` set, sweeps
    beyond it raise. Each sweep's table goes to the shared folder, so a lost executor
    repeats one sweep at most; the driver sees two counts."""
    values, rested, sweeps, live = written(first_values(on.cells), "plan-values"), [], 0, on
    while True:
        values = written(sweep(live, values), "plan-values")
        moved = values.groupBy("scenario").agg((F.max(F.abs(F.col("v") - F.col("before"))) >= tol).alias("moved"))
        moved, sweeps = written(moved, "plan-moved"), sweeps + 1
        left, done = moved.agg(F.count_if("moved"), F.count_if(~F.col("moved"))).first()
        if done:
            rested.append(values.join(moved.where("NOT moved"), "scenario", "left_semi").select(*CELL, "v"))
        if not left:
            break
        if most is not None and sweeps >= most:
            raise RuntimeError(f"{left} scenarios still move after {most} sweeps")
        if done:  # always from the whole tables, so that plans do not grow from sweep to sweep
            live = on.of(moved.where("moved").select("scenario"))
            values = values.join(moved.where("moved"), "scenario", "left_semi")
    if not rested:
        return values.select(*CELL, "v")
    out = rested[0]
    for part in rested[1:]:
        out = out.unionByName(part)
    return out


# ---- the plan -----------------------------------------------------------
def policy(on: Board, values: DataFrame) -> DataFrame:
    """The best choice of every cell under the final values, and whether play has reached
    the short game there."""
    best = best_choices(on, values)
    done = (F.col("lie") == "green") | (F.col("best") >= F.col("floor") - 1e-9)
    return on.cells.join(best, CELL).select(
        *CELL, "club", "off_i", "off_j", "nx", "ny", "x", "y", done.alias("done"))


def rollout(cells: DataFrame, choices: DataFrame) -> DataFrame:
    """Shots `(scenario, shot, club, from_x, from_y, aim_x, aim_y, to_i, to_j, ends)` from the
    start, each played to its expected landing, until the short game takes over. A shot that
    comes to a cell already played from would go round for ever; it is the last one, and
    `ends` is 'stuck' for it, 'short game' for a last shot that reaches it, else null."""
    at = cells.select("scenario", F.col("start_i").alias("i"), F.col("start_j").alias("j")).distinct()
    choices = written(choices)  # read by every shot
    spots = choices.select("scenario", F.col("i").alias("to_i"), F.col("j").alias("to_j"),
                           F.col("x").alias("aim_x"), F.col("y").alias("aim_y"), F.col("done").alias("_done"))
    played: DataFrame | None = None
    shot = 0
    while True:
        shot += 1
        step = at.join(choices, CELL).where(~F.col("done")).select(
            "scenario", F.lit(shot).alias("shot"), "club", F.col("x").alias("from_x"), F.col("y").alias("from_y"),
            "i", "j", F.greatest(F.lit(0), F.least(F.col("nx") - 1, F.col("i") + F.col("off_i"))).alias("to_i"),
            F.greatest(F.lit(0), F.least(F.col("ny") - 1, F.col("j") + F.col("off_j"))).alias("to_j"))
        step = written(step)
        played = step if played is None else played.unionByName(step)
        at = step.select("scenario", F.col("to_i").alias("i"), F.col("to_j").alias("j")).join(
            played.select(*CELL), CELL, "left_anti")
        if at.isEmpty():
            break
    seen = played.select("scenario", F.col("i").alias("to_i"), F.col("j").alias("to_j"), F.col("shot").alias("_from"))
    ends = F.when(F.col("_done"), "short game").when(F.col("_from") <= F.col("shot"), "stuck")
    return played.join(spots, ["scenario", "to_i", "to_j"]).join(
        seen, ["scenario", "to_i", "to_j"], "left").select(
        "scenario", "shot", "club", "from_x", "from_y", "aim_x", "aim_y", "to_i", "to_j", ends.alias("ends"))


def round_rows(
    scenarios: DataFrame, cells: DataFrame, values: DataFrame, shots: DataFrame, shape: str = "straight"
) -> DataFrame:
    """One summary row per scenario: the scenario's own columns (its hole's ref, par and the chosen
    tee's yards among them), expected score from the start, against par, finish, shots and plan."""
    start = cells.select("scenario", F.col("start_i").alias("i"), F.col("start_j").alias("j")).distinct().join(
        values, CELL).select("scenario", F.col("v").alias("_value"))
    last = shots.groupBy("scenario").agg(F.max_by(F.struct("to_i", "to_j"), "shot").alias("l")).select(
        "scenario", F.col("l.to_i").alias("i"), F.col("l.to_j").alias("j"))
    finish = last.join(values, CELL).select("scenario", F.col("v").alias("finish"))
    words = shots.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("shots"), plan_text(F.col("shot"), F.col("club"), shape).alias("plan"))
    against = [F.round(F.col("_value") - F.col("par"), 2).alias("vs_par")] if "par" in scenarios.columns else []
    known = [c for c in scenarios.columns if c not in ("start_x", "start_y", "short_game")]
    return scenarios.join(start, "scenario").join(words, "scenario", "left").join(finish, "scenario", "left").select(
        *known, F.round("_value", 2).alias("expected"), *against, F.coalesce("shots", F.lit(0)).alias("shots"),
        F.coalesce("plan", F.lit("")).alias("plan"), "finish")


def plan_text(shot: Column, club: Column, shape: str) -> Column:
    """Aggregate: a hole's shots in order as one line. A shot starts from a cell not
    played from before, so there are no more shots than cells."""
    ordered = F.array_sort(F.collect_list(F.struct(shot.alias("s"), club.alias("c"))))
    return F.array_join(F.transform(ordered, lambda v: F.concat(v["c"], F.lit(f" ({shape})"))), " → ")


def round_total(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Hole rows `(ref, par, yards, expected)` to a round: total, nines, against par, yards."""
    def nine(value: str, front: bool) -> Column:
        holes = F.col("ref") <= 9 if front else F.col("ref") > 9
        return F.sum(F.when(holes, F.col(value)).otherwise(0))

    return rows.groupBy(*keys).agg(
        F.sum("par").alias("par"), F.sum("yards").alias("yards"), F.sum("expected").alias("expected"),
        (F.sum("expected") - F.sum("par")).alias("vs_par"),
        nine("expected", True).alias("front"), (nine("expected", True) - nine("par", True)).alias("front_vs_par"),
        nine("expected", False).alias("back"), (nine("expected", False) - nine("par", False)).alias("back_vs_par"))
