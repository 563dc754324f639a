"""Queries over whole-hole planning tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.operators import holes as H
from swingframe.operators import planning as P
from swingframe.operators import strategy
from swingframe.operators.joins import lookup
from swingframe.plans import courses_data as D
from swingframe.plans import strategy as S
from swingframe.plans import tables
from swingframe.plans.bags import r6, rounded
from swingframe.plans.registry import dround, query, relation
from swingframe.session import written
from swingframe.sources.seeds import values_sql

SIZE = 20.0
SKEWS = [("bag0", -0.35), ("bag1", 0.0), ("bag2", 0.35)]


def skews(spark):
    return spark.sql(values_sql(["bag_id", "skew"], SKEWS))


relation("skews", values_sql(["bag_id", "skew"], SKEWS))
# One bag plays in the wind: its clouds are shifted before they are planned with.
WINDY = "bag2"


def plan_clouds(spark, folder):
    clouds = tables.landings(spark, folder)
    shifted = strategy.shift_clouds(clouds.where(F.col("bag_id") == WINDY), spark.sql(values_sql(["club", "d_carry", "d_lateral"], S.DELTAS)))
    return clouds.where(F.col("bag_id") != WINDY).unionByName(shifted)


relation("plan_landings", f"""SELECT l.bag_id, l.club, l.carry + CASE WHEN l.bag_id = '{WINDY}' THEN coalesce(d.d_carry, 0) ELSE 0 END AS carry,
  l."lateral" + CASE WHEN l.bag_id = '{WINDY}' THEN coalesce(d.d_lateral, 0) ELSE 0 END AS "lateral" FROM landings l LEFT JOIN deltas d ON l.club = d.club""")
relation("plan_stocks", """SELECT bag_id, club, avg(carry) AS stock, avg("lateral") AS drift FROM plan_landings GROUP BY bag_id, club""")
relation("bent", """SELECT l.bag_id, l.club, l.carry - s.stock AS down,
  (l."lateral" - s.drift) * (1 + k.skew * sign(l."lateral" - s.drift)) AS across
FROM plan_landings l JOIN plan_stocks s ON l.bag_id = s.bag_id AND l.club = s.club JOIN skews k ON k.bag_id = l.bag_id""")
PLAY = [(name, *v) for name, v in K.LIE_PLAY.items()]
relation("lie_play", values_sql(["lie_class", "reach", "spread"], PLAY))


def _offset(residual: str) -> str:
    return f"CAST(round_even(round({residual} * c.spread / {SIZE}e0, 9), 0) AS INT)"


relation("shapes", f"""SELECT bag_id, club, lie_class, di, dj, count(*) / max(size) AS p FROM (
  SELECT b.bag_id, b.club, c.lie_class, {_offset('b.down')} AS di, {_offset('(b.across - b.drift)')} AS dj, b.size
  FROM (SELECT *, avg(across) OVER (PARTITION BY bag_id, club) AS drift, count(*) OVER (PARTITION BY bag_id, club) AS size FROM bent) b, lie_play c)
GROUP BY bag_id, club, lie_class, di, dj""")


@query("landing_stencil", f"SELECT bag_id, club, lie_class, di, dj, {r6('p', 'p')} FROM shapes")
def landing_stencil(spark, folder):
    return rounded(P.stencils(plan_clouds(spark, folder), skews(spark), SIZE), ["p"])


# ---- grid: one parametric and one polygon hole --------------------------
relation("frames", f"""SELECT *, x0 + (nx - 1) * {SIZE}e0 AS last_x FROM (
  SELECT hole_id, pin, x0, y0, difficulty, penalty_cost, CAST(ceil((max_x - x0) / {SIZE}e0) AS INT) AS nx,
    CAST(ceil((max_y - y0) / {SIZE}e0) AS INT) AS ny, drop_x FROM (
  SELECT 'pond' AS hole_id, 150e0 AS pin, 0e0 + {SIZE / 2}e0 AS x0, -41e0 + {SIZE / 2}e0 AS y0, 0e0 AS difficulty, 1e0 AS penalty_cost,
    190e0 AS max_x, 41e0 AS max_y, 120e0 AS drop_x
  UNION ALL SELECT 'P1', 160e0, b.min_x + {SIZE / 2}e0, b.min_y + {SIZE / 2}e0, 0.4e0, 1e0, b.max_x, b.max_y, b.drop_x FROM p1_bounds b))""")
relation("p1_bounds", """SELECT least(0, min(x0) - 10) AS min_x, greatest(max(x0), 160) + 20 AS max_x, least(-40, min(y0) - 15) AS min_y,
  greatest(40, max(y0) + 15) AS max_y, greatest(0, min(x0) FILTER (WHERE layer = 'water') - 5) AS drop_x
FROM course_edges WHERE hole_id = 'P1' AND layer <> 'playable'""")
_POND_SAND = [r for r in D.REGIONS if r[0] == "pond" and r[3] == "sand"][0]


def _box(r, x, y):
    return f"{x} BETWEEN {r[4]}e0 AND {r[5]}e0 AND {y} BETWEEN {r[6]}e0 AND {r[7]}e0"


POND_WET = " OR ".join(_box(r, "x", "y") for r in D.REGIONS if r[0] == "pond" and r[3] in ("water", "ob"))
relation("grid", f"""SELECT *, CASE WHEN lie IN ('rough', 'sand', 'recovery') THEN lie ELSE 'clean' END AS lie_class FROM (
  SELECT hole_id, i, j, x, y, sqrt(pow(pin - x, 2) + pow(y, 2)) AS remaining,
    CASE WHEN hole_id = 'pond' THEN CASE WHEN {_box(_POND_SAND, 'x', 'y')} THEN 'sand'
      WHEN sqrt(pow(pin - x, 2) + pow(y, 2)) <= 6 THEN 'green' WHEN abs(y) <= 16 THEN 'fairway' ELSE 'rough' END
    ELSE {D.sql_lie('x', 'y')} END AS lie,
    CASE WHEN hole_id = 'pond' THEN {POND_WET} ELSE {D.sql_in_layer('water', 'x', 'y')} END AS in_penalty
  FROM (SELECT hole_id, pin, i, j, x0 + i * {SIZE}e0 AS x, y0 + j * {SIZE}e0 AS y FROM (
    SELECT hole_id, pin, x0, y0, CAST(i AS INT) AS i, CAST(unnest(range(ny)) AS INT) AS j FROM (
      SELECT *, unnest(range(nx)) AS i FROM frames))))""")


def frames(spark):
    shared = ["hole_id", "pin_distance", "green_difficulty", "min_x", "max_x", "min_y", "max_y", "drop_x", "penalty_cost"]
    pond = H.parametric_bounds(D.parametric_holes(spark)).where("hole_id = 'pond'")
    p1 = H.course_bounds(D.polygon_holes(spark)).where("hole_id = 'P1'")
    grids = [P.hole_grid(P.grid_frames(pond, SIZE), SIZE, polygon=False),
             P.hole_grid(P.grid_frames(p1, SIZE), SIZE, polygon=True)]
    heads = pond.select(*shared, F.lit(None).cast("array<array<double>>").alias("elevation")).unionByName(
        p1.select(*shared, "elevation"))
    return P.grid_frames(heads, SIZE), grids[0].unionByName(grids[1])


# Each bag plays from its own tee; a hole without tees is played from its start.
TEE_OF = {"bag0": "Back", "bag1": "Middle", "bag2": "Forward"}
HEADS = [("pond", 2, 3, 150.0), ("P1", 1, 3, 160.0)]
HEAD_COLUMNS = ["hole_id", "ref", "par", "pin_distance"]
relation("plan_heads", values_sql(HEAD_COLUMNS, HEADS))
relation("tee_of", values_sql(["bag_id", "level"], list(TEE_OF.items())))
relation("scenarios", """SELECT concat(h.hole_id, '/', b.bag_id) AS scenario, h.hole_id, b.bag_id, h.ref, h.par, o.level AS tee,
  CAST(round_even(coalesce(t.yards, h.pin_distance), 0) AS BIGINT) AS yards, t.downrange AS start_x, t."lateral" AS start_y
FROM (SELECT DISTINCT bag_id FROM plan_landings) b JOIN tee_of o ON o.bag_id = b.bag_id, plan_heads h
LEFT JOIN picked_tees t ON t.hole_id = h.hole_id AND t.level = o.level""")


def plan_scenarios(spark, clouds):
    """Every bag on both holes from its tee, with the hole's ref, par and the tee's yards."""
    levels = spark.sql(values_sql(["bag_id", "tee"], list(TEE_OF.items())))
    asked = lookup(S.bag_holes(clouds, [h[0] for h in HEADS]), levels, ["bag_id"])
    asked = lookup(asked, spark.sql(values_sql(HEAD_COLUMNS, HEADS)), ["hole_id"])
    tees = H.pick_tees(D.tees(spark), D.polygon_holes(spark)).withColumnsRenamed({"level": "tee", "downrange": "start_x", "lateral": "start_y"})
    placed = lookup(asked, tees, ["hole_id", "tee"])
    return placed.select(
        F.concat_ws("/", "hole_id", "bag_id").alias("scenario"), "hole_id", "bag_id", "ref", "par", "tee",
        F.rint(F.coalesce("yards", "pin_distance")).cast("bigint").alias("yards"), "start_x", "start_y", F.lit(0.25).alias("short_game"))


def scenario_tables(spark, folder):
    """Cells, stencils and candidates of every bag on both holes."""
    clouds = plan_clouds(spark, folder)
    heads, grid = frames(spark)
    clubs = P.bag_clubs(clouds)
    scenarios = plan_scenarios(spark, clouds)
    cells = P.scenario_cells(scenarios, heads, grid, clubs, SIZE)
    return scenarios, cells, P.stencils(clouds, skews(spark), SIZE), P.candidates(cells, clubs, SIZE)


def boards(spark, folder):
    """The scenarios and what their sweeps read, written once."""
    scenarios, cells, shapes, _ = scenario_tables(spark, folder)
    cells, scenarios = written(cells, "scenario-cells"), written(scenarios, "scenarios")
    options = P.candidates(cells, P.bag_clubs(plan_clouds(spark, folder)), SIZE)
    return scenarios, P.board(cells, shapes, options)


relation("bag_club_order", """SELECT bag_id, club, carry, row_number() OVER (PARTITION BY bag_id ORDER BY carry DESC, club) - 1 AS place
FROM (SELECT bag_id, club, round(avg(carry), 9) AS carry FROM plan_landings GROUP BY bag_id, club)""")
relation("scn_cells", f"""SELECT concat(g.hole_id, '/', b.bag_id) AS scenario, g.*, b.bag_id, f.nx, f.ny, f.x0, f.y0, f.penalty_cost,
  CAST(least(greatest(ceil((f.drop_x - f.x0) / {SIZE}e0), 0), f.nx - 1) AS INT) AS drop_i, t.tee_i, t.tee_j,
  CASE WHEN s.start_x IS NULL THEN t.tee_i ELSE CAST(least(greatest(ceil((s.start_x - f.x0) / {SIZE}e0), 0), f.nx - 1) AS INT) END AS start_i,
  CASE WHEN s.start_y IS NULL THEN t.tee_j ELSE CAST(least(greatest(ceil((s.start_y - f.y0) / {SIZE}e0), 0), f.ny - 1) AS INT) END AS start_j,
  b.short_range, f.difficulty FROM grid g JOIN frames f ON f.hole_id = g.hole_id
JOIN (SELECT hole_id, arg_min(i, (abs(x), i)) AS tee_i, arg_min(j, (abs(y), j)) AS tee_j FROM grid GROUP BY hole_id) t ON t.hole_id = g.hole_id,
  (SELECT bag_id, min(carry) AS short_range FROM bag_club_order GROUP BY bag_id) b JOIN scenarios s ON s.bag_id = b.bag_id AND s.hole_id = g.hole_id""")
relation("scn_floor", f"""SELECT * EXCLUDE (e), CASE WHEN remaining <= short_range THEN {S.taxed('e', 'remaining', 'lie', '0.25e0', 'difficulty')} ELSE 50e0 END AS floor
FROM ({S.priced('SELECT * FROM scn_cells', 'remaining', 'lie', 'e')})""")


@query("short_game_floor", f"SELECT scenario, i, j, {r6('floor', 'floor')} FROM scn_floor")
def short_game_floor(spark, folder):
    return rounded(scenario_tables(spark, folder)[1].select("scenario", "i", "j", "floor"), ["floor"])


AIMS = P.aim_offsets(SIZE)
relation("aim_list", values_sql(["n", "down", "across"], [(n, a, b) for n, (a, b) in enumerate(AIMS)]))


def _height(x: str) -> str:
    return f"coalesce((SELECT g.y0 + g.slope * ({x} - g.x0) FROM ground g WHERE g.hole_id = c.hole_id AND {x} >= g.from_x AND {x} < g.to_x), 0)"


relation("scn_reach", f"""SELECT c.*, c.stock - CAST(round_even(round(0.93e0 * ({_height(f'(c.x0 + greatest(0, least(c.nx - 1, c.i + c.stock)) * {SIZE}e0)')}
    - {_height(f'(c.x0 + c.i * {SIZE}e0)')}) / {SIZE}e0, 9), 0) AS INT) AS reach FROM (
  SELECT s.scenario, s.hole_id, s.i, s.j, s.lie_class, s.nx, s.ny, s.x0, b.club, b.place,
    CAST(round_even(round(b.carry * p.reach / {SIZE}e0, 9), 0) AS INT) AS stock
  FROM scn_cells s JOIN bag_club_order b ON b.bag_id = s.bag_id JOIN lie_play p ON p.lie_class = s.lie_class
  WHERE b.club <> 'Driver' OR s.i = s.start_i) c""")
relation("scn_options", f"""SELECT r.scenario, r.i, r.j, r.lie_class, r.club, CAST(r.place * {len(AIMS)} + a.n AS INT) AS choice, r.reach + a.down AS off_i, a.across AS off_j,
  r.i + r.reach + a.down AS to_i, r.j + a.across AS to_j,
  r.i + r.reach + a.down BETWEEN 0 AND r.nx - 1 AND r.j + a.across BETWEEN 0 AND r.ny - 1 AS on_grid FROM scn_reach r, aim_list a""")


@query("shot_choices", "SELECT * FROM scn_options")
def shot_choices(spark, folder):
    return scenario_tables(spark, folder)[3]


relation("scn_cost", """SELECT c.scenario, c.bag_id, c.i, c.j, c.nx, c.ny, CASE WHEN c.in_penalty THEN c.penalty_cost + d.floor ELSE c.floor END AS cost
FROM scn_floor c JOIN scn_floor d ON d.scenario = c.scenario AND d.i = d.drop_i AND d.j = d.tee_j""")
relation("scn_q", """SELECT v.scenario, s.club, s.lie_class, v.i - s.di AS i, v.j - s.dj AS j, 1 + sum(s.p * v.cost) + 8 * (1 - sum(s.p)) AS q
FROM scn_cost v JOIN shapes s ON s.bag_id = v.bag_id
JOIN (SELECT DISTINCT scenario, lie_class FROM scn_cells) k ON k.scenario = v.scenario AND k.lie_class = s.lie_class
WHERE v.i - s.di BETWEEN 0 AND v.nx - 1 AND v.j - s.dj BETWEEN 0 AND v.ny - 1 GROUP BY 1, 2, 3, 4, 5""")
relation("scn_best", """SELECT scenario, i, j, min(round(CASE WHEN on_grid THEN coalesce(q, 9) ELSE 8 END, 9)) AS best,
  arg_min(choice, (round(CASE WHEN on_grid THEN coalesce(q, 9) ELSE 8 END, 9), choice)) AS choice
FROM (SELECT o.*, q.q FROM scn_options o LEFT JOIN scn_q q ON q.scenario = o.scenario AND q.club = o.club AND q.lie_class = o.lie_class
  AND q.i = o.to_i AND q.j = o.to_j) GROUP BY scenario, i, j""")


@query("bellman_sweep", f"""SELECT c.scenario, c.i, c.j, {r6('least(c.floor, b.best)', 'v')}, {r6('c.floor', 'before')}
FROM scn_floor c JOIN scn_best b ON b.scenario = c.scenario AND b.i = c.i AND b.j = c.j""")
def bellman_sweep(spark, folder):
    """One backup of every cell of every scenario, from the short-game floor."""
    _, on = boards(spark, folder)
    return rounded(P.sweep(on, P.first_values(on.cells)), ["v", "before"])


@query("best_choice", "SELECT scenario, i, j, choice, round(best, 6) AS best FROM scn_best")
def best_choice(spark, folder):
    _, on = boards(spark, folder)
    best = P.best_choices(on, P.first_values(on.cells))
    return best.select("scenario", "i", "j", "choice", F.round(F.round("best", 9), 6).alias("best"))


def best_under(values: str) -> str:
    """Best choice of every cell, priced with the values of a relation."""
    cost = f"""SELECT c.scenario, c.bag_id, c.i, c.j, c.nx, c.ny, CASE WHEN c.in_penalty THEN c.penalty_cost + d.v ELSE r.v END AS cost
FROM scn_floor c JOIN {values} r ON r.scenario = c.scenario AND r.i = c.i AND r.j = c.j
JOIN {values} d ON d.scenario = c.scenario AND d.i = c.drop_i AND d.j = c.tee_j"""
    q = f"""SELECT v.scenario, s.club, s.lie_class, v.i - s.di AS i, v.j - s.dj AS j, 1 + sum(s.p * v.cost) + 8 * (1 - sum(s.p)) AS q
FROM ({cost}) v JOIN shapes s ON s.bag_id = v.bag_id
JOIN (SELECT DISTINCT scenario, lie_class FROM scn_cells) k ON k.scenario = v.scenario AND k.lie_class = s.lie_class
WHERE v.i - s.di BETWEEN 0 AND v.nx - 1 AND v.j - s.dj BETWEEN 0 AND v.ny - 1 GROUP BY 1, 2, 3, 4, 5"""
    first = "(round(cost, 9), choice)"
    return f"""SELECT scenario, i, j, arg_min(cost, {first}) AS best, arg_min(club, {first}) AS club, arg_min(off_i, {first}) AS off_i, arg_min(off_j, {first}) AS off_j
FROM (SELECT o.*, CASE WHEN on_grid THEN coalesce(q.q, 9) ELSE 8 END AS cost FROM scn_options o LEFT JOIN ({q}) q
  ON q.scenario = o.scenario AND q.club = o.club AND q.lie_class = o.lie_class AND q.i = o.to_i AND q.j = o.to_j) GROUP BY scenario, i, j"""


_MOVING = "(SELECT * FROM plan_sweeps WHERE moved >= 1e-3)"
relation("plan_sweeps", f"""SELECT scenario, i, j, floor AS v, 1e9 AS moved, 0 AS k FROM scn_floor
UNION ALL SELECT scenario, i, j, v, max(abs(v - before)) OVER (PARTITION BY scenario), k + 1 FROM (
  SELECT c.scenario, c.i, c.j, least(c.floor, coalesce(b.best, c.floor)) AS v, r.v AS before, r.k
  FROM scn_floor c JOIN {_MOVING} r ON r.scenario = c.scenario AND r.i = c.i AND r.j = c.j
  LEFT JOIN ({best_under(_MOVING)}) b ON b.scenario = c.scenario AND b.i = c.i AND b.j = c.j)""")
relation("plan_values", "SELECT scenario, i, j, v FROM (SELECT *, max(k) OVER (PARTITION BY scenario) AS last FROM plan_sweeps) WHERE k = last")
relation("plan_policy", f"""SELECT c.scenario, c.i, c.j, c.x, c.y, c.start_i, c.start_j, b.club, c.lie = 'green' OR b.best >= c.floor - 1e-9 AS done,
  CAST(greatest(0, least(c.nx - 1, c.i + b.off_i)) AS INT) AS to_i, CAST(greatest(0, least(c.ny - 1, c.j + b.off_j)) AS INT) AS to_j
FROM scn_floor c JOIN ({best_under('plan_values')}) b ON b.scenario = c.scenario AND b.i = c.i AND b.j = c.j""")
relation("plan_shots", """SELECT scenario, 1 AS shot, club, i, j, x, y, to_i, to_j, [(i, j)] AS seen FROM plan_policy WHERE i = start_i AND j = start_j AND NOT done
UNION ALL SELECT p.scenario, r.shot + 1, p.club, p.i, p.j, p.x, p.y, p.to_i, p.to_j, list_append(r.seen, (p.i, p.j))
FROM plan_shots r JOIN plan_policy p ON p.scenario = r.scenario AND p.i = r.to_i AND p.j = r.to_j
WHERE NOT p.done AND NOT list_contains(r.seen, (p.i, p.j))""")
_SPOTS = ["from_x", "from_y", "aim_x", "aim_y"]


def solved(spark, folder):
    scenarios, on = boards(spark, folder)
    return scenarios, on, P.iterate(on)


@query("value_iteration", f"SELECT scenario, i, j, {r6('v', 'v')} FROM plan_values")
def value_iteration(spark, folder):
    """Converged values of every scenario."""
    return rounded(solved(spark, folder)[2], ["v"])


@query("policy_rollout", f"""SELECT s.scenario, s.shot, s.club, {r6('s.x', 'from_x')}, {r6('s.y', 'from_y')}, {r6('a.x', 'aim_x')}, {r6('a.y', 'aim_y')}, s.to_i, s.to_j,
  CASE WHEN a.done THEN 'short game' WHEN list_contains(s.seen, (s.to_i, s.to_j)) THEN 'stuck' END AS ends
FROM plan_shots s JOIN plan_policy a ON a.scenario = s.scenario AND a.i = s.to_i AND a.j = s.to_j""")
def policy_rollout(spark, folder):
    _, on, values = solved(spark, folder)
    return rounded(P.rollout(on.cells, P.policy(on, values)), _SPOTS)


relation("round_table", f"""SELECT c.scenario, c.hole_id, c.bag_id, c.ref, c.par, c.tee, c.yards, {dround('t.v', 2)} AS expected, {dround('t.v - c.par', 2)} AS vs_par,
  coalesce(s.shots, 0) AS shots, coalesce(s.plan, '') AS plan, f.v AS finish
FROM (SELECT DISTINCT c.scenario, c.hole_id, c.bag_id, c.start_i, c.start_j, s.ref, s.par, s.tee, s.yards FROM scn_cells c JOIN scenarios s ON s.scenario = c.scenario) c
JOIN plan_values t ON t.scenario = c.scenario AND t.i = c.start_i AND t.j = c.start_j
LEFT JOIN (SELECT scenario, count(*) AS shots, string_agg(club || ' (straight)', ' → ' ORDER BY shot) AS plan,
    arg_max(to_i, shot) AS to_i, arg_max(to_j, shot) AS to_j FROM plan_shots GROUP BY scenario) s ON s.scenario = c.scenario
LEFT JOIN plan_values f ON f.scenario = c.scenario AND f.i = s.to_i AND f.j = s.to_j""")


def round_table(spark, folder):
    scenarios, on, values = solved(spark, folder)
    shots = P.rollout(on.cells, P.policy(on, values))
    return P.round_rows(scenarios, on.cells, values, shots)


@query("round_rows", f"SELECT * EXCLUDE (finish), {r6('finish', 'finish')} FROM round_table")
def round_rows(spark, folder):
    """Every scenario's hole as the round table shows it."""
    return rounded(round_table(spark, folder), ["finish"])


_TOTALS = ["expected", "vs_par", "front", "front_vs_par", "back", "back_vs_par"]


@query("round_total", f"""SELECT bag_id, CAST(sum(par) AS BIGINT) AS par, CAST(sum(yards) AS BIGINT) AS yards, {r6('sum(expected)', 'expected')},
  {r6('sum(expected) - sum(par)', 'vs_par')}, {r6('coalesce(sum(expected) FILTER (WHERE ref <= 9), 0)', 'front')},
  {r6('coalesce(sum(expected - par) FILTER (WHERE ref <= 9), 0)', 'front_vs_par')}, {r6('coalesce(sum(expected) FILTER (WHERE ref > 9), 0)', 'back')},
  {r6('coalesce(sum(expected - par) FILTER (WHERE ref > 9), 0)', 'back_vs_par')} FROM round_table GROUP BY bag_id""")
def round_total(spark, folder):
    """Each bag's round over the holes it planned."""
    return rounded(P.round_total(round_table(spark, folder), ["bag_id"]), _TOTALS)


@query("plan_text", """SELECT player_id, count(*) AS shots, string_agg(club || ' (straight)', ' → ' ORDER BY shot, club) AS plan
FROM (SELECT user_id * 1000 + event_id % 1000 AS player_id, CAST(event_id AS BIGINT) AS shot, event_type AS club FROM events) GROUP BY player_id""")
def plan_text(spark, folder):
    shots = tables.read_events(spark, folder).selectExpr(
        "user_id * 1000 + event_id % 1000 AS player_id", "event_id AS shot", "event_type AS club")
    return shots.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("shots"), P.plan_text(F.col("shot"), F.col("club"), "straight").alias("plan"))


