"""Queries that score shots and search aims."""

from __future__ import annotations

from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import units as U
from swingframe.operators import holes as H
from swingframe.operators import scoring, strategy
from swingframe.operators.cells import inside_rings
from swingframe.operators.lookup import interpolate
from swingframe.operators.rings import course_rings, rejected_rings
from swingframe.plans import courses_data as D
from swingframe.plans import tables
from swingframe.plans.bags import r6, rounded
from swingframe.plans.registry import dround, query, relation
from swingframe.sources.seeds import values_sql

# ---- the curves as intervals, for the SQL side ---------------------------
BIG = 1e9


def _intervals(lie: str, xs: list[float], ys: list[float]) -> list[tuple]:
    rows = [(lie, -BIG, float(xs[0]), float(xs[0]), float(ys[0]), 0.0)]
    rows += [(lie, float(xs[i]), float(xs[i + 1]), float(xs[i]), float(ys[i]), (ys[i + 1] - ys[i]) / (xs[i + 1] - xs[i]))
             for i in range(len(xs) - 1)]
    return [*rows, (lie, float(xs[-1]), BIG, float(xs[-1]), float(ys[-1]), 0.0)]


CURVES = [row for lie, ys in K.CURVE_STROKES.items() for row in _intervals(lie, K.CURVE_YARDS, ys)]
CURVES += _intervals("green", K.PUTT_FEET, K.PUTT_STROKES)
relation("curves", values_sql(["curve", "from_x", "to_x", "x0", "y0", "slope"], CURVES))


def priced(source: str, distance: str, lie: str, out: str) -> str:
    """`source` with `out`, the curve value at (distance, lie)."""
    at = f"(CASE WHEN {lie} = 'green' THEN 3e0 * {distance} ELSE {distance} END)"
    return (f"SELECT p.*, c.y0 + c.slope * ({at} - c.x0) AS {out} FROM ({source}) p "
            f"LEFT JOIN curves c ON c.curve = {lie} AND {at} >= c.from_x AND {at} < c.to_x")


def expected(source: str, distance: str, lie: str, out: str) -> str:
    return (f"SELECT * EXCLUDE (_curve), CASE WHEN {distance} <= 0 THEN 0e0 WHEN {lie} = 'tee' "
            f"THEN 2.38e0 + 0.0041e0 * {distance} ELSE _curve END AS {out} FROM ({priced(source, distance, lie, '_curve')})")


# ---- shots from lineitem -------------------------------------------------
LIES = ["tee", "fairway", "rough", "sand", "recovery", "green"]
PAIR_COLUMNS = [
    "l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber",
    "CASE WHEN l_linenumber % 6 = 5 THEN CAST(l_partkey % 300 AS DOUBLE) / 1e1 ELSE CAST(l_partkey % 480 AS DOUBLE) + l_quantity / 1e2 END AS start_distance",
    tables.pick("CAST(l_linenumber % 6 AS INT)", LIES) + " AS start_lie",
    "CASE WHEN l_orderkey % 9 = 0 THEN 0e0 ELSE CAST((l_suppkey * 7 + l_orderkey) % 2600 AS DOUBLE) / 1e1 END AS end_distance",
    tables.pick("CAST(l_orderkey % 5 AS INT)", ["fairway", "rough", "sand", "recovery", "green"]) + " AS end_lie",
    "CASE WHEN l_orderkey % 50 = 0 THEN 1e0 ELSE 0e0 END AS penalty",
]
relation("shot_pairs", f"SELECT {', '.join(PAIR_COLUMNS)} FROM lineitem")


def shot_pairs(spark, folder):
    return tables.read(spark, folder, "lineitem").selectExpr(*PAIR_COLUMNS)


POSITION = "l_orderkey, l_linenumber, start_distance, start_lie"


@query("expected_strokes", f"SELECT {POSITION}, {r6('e', 'expected_strokes')} FROM ({expected('SELECT * FROM shot_pairs', 'start_distance', 'start_lie', 'e')})")
def expected_strokes(spark, folder):
    scored = scoring.score_positions(shot_pairs(spark, folder), "start_distance", "start_lie")
    return rounded(scored.select("l_orderkey", "l_linenumber", "start_distance", "start_lie", "expected_strokes"),
                   ["expected_strokes"])


TWICE = expected(expected("SELECT * FROM shot_pairs", "start_distance", "start_lie", "e0"), "end_distance", "end_lie", "e1")


@query("strokes_gained", f"SELECT l_orderkey, l_linenumber, {r6('e0 - e1 - 1 - penalty', 'strokes_gained')} FROM ({TWICE})")
def strokes_gained(spark, folder):
    scored = scoring.score_shots(shot_pairs(spark, folder))
    return rounded(scored.select("l_orderkey", "l_linenumber", "strokes_gained"), ["strokes_gained"])


@query("strokes_gained_by_lie", f"""SELECT start_lie, count(*) AS shots, {r6('avg(e0 - e1 - 1 - penalty)', 'mean_gained')} FROM ({TWICE}) GROUP BY start_lie""")
def strokes_gained_by_lie(spark, folder):
    scored = scoring.score_shots(shot_pairs(spark, folder))
    return rounded(scored.groupBy("start_lie").agg(
        F.count(F.lit(1)).alias("shots"), F.avg("strokes_gained").alias("mean_gained")), ["mean_gained"])


def taxed(cost: str, distance: str, lie: str, sg: str, gd: str) -> str:
    tax = (f"({sg} * CASE WHEN {lie} = 'green' THEN 0.6e0 ELSE 1e0 END + CASE WHEN {lie} = 'green' OR {distance} <= 30 "
           f"THEN {gd} * (0.18e0 + 0.55e0 * {sg}) ELSE 0e0 END)")
    return f"({cost} + {tax} * ({cost} - 1e0))"


@query("player_strokes", f"""SELECT l_orderkey, l_linenumber, {r6(taxed('e', 'end_distance', 'end_lie', '0.25e0', '0.5e0'), 'expected_strokes')}
FROM ({priced('SELECT * FROM shot_pairs', 'end_distance', 'end_lie', 'e')})""")
def player_strokes(spark, folder):
    from swingframe.functions import strokes as S

    cost = S.player_strokes(F.col("end_distance"), F.col("end_lie"), 0.25, 0.5)
    return rounded(shot_pairs(spark, folder).select("l_orderkey", "l_linenumber", cost.alias("expected_strokes")),
                   ["expected_strokes"])


KNOTS = [("fairway", 5.0, 2.05), ("fairway", 60.0, 2.67), ("fairway", 240.0, 3.4), ("sand", 20.0, 2.53), ("sand", 100.0, 3.1)]
relation("knot_lines", values_sql(["lie", "from_x", "to_x", "x0", "y0", "slope"], [
    r for lie in ("fairway", "sand") for r in _intervals(
        lie, [k[1] for k in KNOTS if k[0] == lie], [k[2] for k in KNOTS if k[0] == lie])]))


@query("linear_lookup", f"""SELECT p.l_orderkey, p.end_distance, p.end_lie, {r6('k.y0 + k.slope * (p.end_distance - k.x0)', 'value')}
FROM shot_pairs p LEFT JOIN knot_lines k ON k.lie = p.end_lie AND p.end_distance >= k.from_x AND p.end_distance < k.to_x""")
def linear_lookup(spark, folder):
    knots = spark.sql(values_sql(["end_lie", "x", "y"], KNOTS))
    pairs = shot_pairs(spark, folder).select("l_orderkey", "end_distance", "end_lie")
    return rounded(interpolate(pairs, knots, ["end_lie"], "end_distance", "value"), ["value"])


# ---- clouds -------------------------------------------------------------
relation("stocks", 'SELECT bag_id, club, avg(carry) AS stock, avg("lateral") AS drift FROM landings GROUP BY bag_id, club')


def hole_out_sql(source: str, keys: str) -> str:
    """`source` has keys, left_yards; a putt within 5 yards, else a clean approach."""
    at = "(CASE WHEN left_yards <= 5 THEN 3e0 * left_yards ELSE left_yards END)"
    curve = "(CASE WHEN left_yards <= 5 THEN 'green' ELSE 'fairway' END)"
    return f"""SELECT {keys}, 1 + avg(c.y0 + c.slope * ({at} - c.x0)) AS expected_strokes, avg(left_yards) AS mean_proximity_yards,
  avg(CASE WHEN left_yards <= 5 THEN 1e0 ELSE 0e0 END) AS frac_on_green
FROM ({source}) p JOIN curves c ON c.curve = {curve} AND {at} >= c.from_x AND {at} < c.to_x GROUP BY {keys}"""


_SCORE = ["expected_strokes", "mean_proximity_yards", "frac_on_green"]


@query("hole_out", f"""SELECT bag_id, club, {', '.join(r6(c, c) for c in _SCORE)} FROM ({hole_out_sql(
    'SELECT bag_id, club, sqrt(pow(150e0 - carry, 2) + pow("lateral", 2)) AS left_yards FROM landings', 'bag_id, club')})""")
def hole_out(spark, folder):
    clouds = tables.landings(spark, folder).withColumn("pin", F.lit(150.0))
    return rounded(scoring.hole_out(clouds, ["bag_id", "club"], "pin"), _SCORE)


relation("placed_clouds", """SELECT l.bag_id, l.club, round(s.stock, 0) + 2 AS stock_yards, s.sd,
  l.carry - s.stock + round(s.stock, 0) + 2 AS carry FROM landings l
JOIN (SELECT bag_id, club, avg(carry) AS stock, stddev_pop(carry) AS sd FROM landings GROUP BY bag_id, club) s
  ON l.bag_id = s.bag_id AND l.club = s.club""")
relation("consistency", f"""SELECT a.bag_id, a.club, a.stock_yards, a.expected_strokes AS own_strokes, b.expected_strokes AS tight_strokes,
  a.expected_strokes - b.expected_strokes AS gap
FROM ({hole_out_sql('SELECT bag_id, club, stock_yards, abs(stock_yards - carry) AS left_yards FROM placed_clouds', 'bag_id, club, stock_yards')}) a
JOIN ({hole_out_sql('SELECT bag_id, club, stock_yards, abs((carry - stock_yards) * 5e0 / sd) AS left_yards FROM placed_clouds', 'bag_id, club, stock_yards')}) b
  ON a.bag_id = b.bag_id AND a.club = b.club""")
_COST = ["own_strokes", "tight_strokes", "gap"]


def consistency(spark, folder):
    clouds = tables.landings(spark, folder)
    stock = clouds.groupBy("bag_id", "club").agg((F.round(F.avg("carry"), 0) + 2).alias("stock_yards"))
    return scoring.consistency_cost(clouds, stock)


@query("consistency_cost", f"SELECT bag_id, club, stock_yards, {', '.join(r6(c, c) for c in _COST)} FROM consistency")
def consistency_cost(spark, folder):
    return rounded(consistency(spark, folder), _COST)


@query("mean_consistency_gap", f"SELECT bag_id, {r6('avg(gap)', 'mean_gap')}, count(*) AS clubs FROM consistency GROUP BY bag_id")
def mean_consistency_gap(spark, folder):
    return rounded(scoring.mean_gap(consistency(spark, folder)), ["mean_gap"])


# ---- parametric holes ---------------------------------------------------
relation("points", """SELECT CASE WHEN ord % 2 = 0 THEN 'pond' ELSE 'front' END AS hole_id, ord, carry AS x, "lateral" AS y FROM landings""")


def points(spark, folder, names=("pond", "front")):
    return tables.landings(spark, folder).selectExpr(
        f"CASE WHEN ord % 2 = 0 THEN '{names[0]}' ELSE '{names[1]}' END AS hole_id", "ord", "carry AS x", "lateral AS y")


IN_BOX = '{x} BETWEEN r.near AND r.far AND {y} BETWEEN r."left" AND r."right"'


def sql_parametric_lie(x: str, y: str) -> str:
    box = IN_BOX.replace("{x}", x).replace("{y}", y)
    left = f"sqrt(pow(h.pin_distance - {x}, 2) + pow({y}, 2))"
    return (f"CASE WHEN EXISTS (SELECT 1 FROM hole_regions r WHERE r.hole_id = h.hole_id AND r.kind = 'sand' AND {box}) THEN 'sand' "
            f"WHEN {left} <= h.green_radius THEN 'green' WHEN abs({y}) <= h.half_width THEN 'fairway' ELSE 'rough' END")


@query("region_join", f"""SELECT p.hole_id, p.ord, p.x, p.y, r.region_id, r.kind FROM points p JOIN hole_regions r
ON p.hole_id = r.hole_id AND {IN_BOX.replace('{x}', 'p.x').replace('{y}', 'p.y')}""")
def region_join(spark, folder):
    return H.points_in_regions(points(spark, folder), D.regions(spark))


@query("parametric_lies", f"""SELECT p.hole_id, p.ord, p.x, p.y, {r6('sqrt(pow(h.pin_distance - p.x, 2) + pow(p.y, 2))', 'remaining')},
  {sql_parametric_lie('p.x', 'p.y')} AS lie,
  EXISTS (SELECT 1 FROM hole_regions r WHERE r.hole_id = h.hole_id AND r.kind IN ('water', 'ob') AND {IN_BOX.replace('{x}', 'p.x').replace('{y}', 'p.y')}) AS in_penalty
FROM points p JOIN holes h ON p.hole_id = h.hole_id""")
def parametric_lies(spark, folder):
    return rounded(H.classify_parametric(points(spark, folder), D.parametric_holes(spark)), ["remaining"])


@query("penalty_relief", f"""SELECT p.hole_id, p.ord, {r6('r.penalty_strokes + c.y0 + c.slope * (abs(r.pin - r.drop_x) - c.x0)', 'replay_cost')}
FROM (SELECT p.hole_id, p.ord, h.pin_distance AS pin, arg_max(r.penalty_strokes, r.ord) AS penalty_strokes,
        arg_max(coalesce(r.drop_distance, h.pin_distance - 30), r.ord) AS drop_x
      FROM points p JOIN holes h ON p.hole_id = h.hole_id JOIN hole_regions r ON r.hole_id = h.hole_id
        AND r.kind IN ('water', 'ob') AND {IN_BOX.replace('{x}', 'p.x').replace('{y}', 'p.y')} GROUP BY ALL) r
JOIN points p ON p.ord = r.ord
JOIN curves c ON c.curve = 'fairway' AND abs(r.pin - r.drop_x) >= c.from_x AND abs(r.pin - r.drop_x) < c.to_x""")
def penalty_relief(spark, folder):
    x, y = F.col("x"), F.col("y")
    placed = points(spark, folder).join(D.parametric_holes(spark), "hole_id")
    judged = placed.select("hole_id", "ord", H.penalty_replay(placed, x, y).alias("replay_cost"))
    return rounded(judged.where("replay_cost IS NOT NULL"), ["replay_cost"])


# Aims over clouds: one text prices a table of aimed balls.
def aim_prices(aimed: str) -> str:
    """`aimed`: hole_id, bag_id, club, aim, aim_distance, aim_lateral, x, y per ball."""
    wet = f"""SELECT a.*, sqrt(pow(h.pin_distance - a.x, 2) + pow(a.y, 2)) AS left_yards,
  CASE {' '.join(f"WHEN a.hole_id = '{r[0]}' AND a.x BETWEEN {r[4]}e0 AND {r[5]}e0 AND a.y BETWEEN {r[6]}e0 AND {r[7]}e0 THEN 'sand'" for r in D.REGIONS if r[3] == 'sand')}
    WHEN sqrt(pow(h.pin_distance - a.x, 2) + pow(a.y, 2)) <= h.green_radius THEN 'green'
    WHEN abs(a.y) <= h.half_width THEN 'fairway' ELSE 'rough' END AS lie,
  CASE {' '.join(f"WHEN a.hole_id = '{r[0]}' AND a.x BETWEEN {r[4]}e0 AND {r[5]}e0 AND a.y BETWEEN {r[6]}e0 AND {r[7]}e0 THEN (SELECT cost FROM region_costs WHERE region_id = '{r[1]}')" for r in sorted(D.REGIONS, key=lambda r: -r[2]) if r[3] in ('water', 'ob'))} END AS replay
FROM ({aimed}) a JOIN holes h ON a.hole_id = h.hole_id"""
    return f"""SELECT hole_id, bag_id, club, aim, aim_distance, aim_lateral, 1 + avg(coalesce(replay, e)) AS expected_strokes,
  avg(CASE WHEN replay IS NOT NULL THEN 1e0 ELSE 0e0 END) AS penalty_pct,
  avg(CASE WHEN replay IS NULL AND lie = 'green' THEN 1e0 ELSE 0e0 END) AS frac_on_green,
  avg(CASE WHEN replay IS NULL THEN left_yards END) AS mean_proximity_yards
FROM ({priced(wet, 'left_yards', 'lie', 'e')}) GROUP BY hole_id, bag_id, club, aim, aim_distance, aim_lateral"""


relation("region_costs", """SELECT r.region_id, r.penalty_strokes + c.y0 + c.slope * (abs(h.pin_distance - coalesce(r.drop_distance, h.pin_distance - 30)) - c.x0) AS cost
FROM hole_regions r JOIN holes h ON r.hole_id = h.hole_id JOIN curves c ON c.curve = 'fairway'
  AND abs(h.pin_distance - coalesce(r.drop_distance, h.pin_distance - 30)) >= c.from_x
  AND abs(h.pin_distance - coalesce(r.drop_distance, h.pin_distance - 30)) < c.to_x""")
relation("bag_holes", "SELECT DISTINCT l.bag_id, h.hole_id FROM landings l, holes h")
relation("aimed_balls", """SELECT b.hole_id, l.bag_id, l.club, CAST(i * 17 + j AS INT) AS aim, s.stock - 30 + 3 * i AS aim_distance,
  CAST(3 * j - 24 AS DOUBLE) AS aim_lateral, l.carry - s.stock + s.stock - 30 + 3 * i AS x, l."lateral" - s.drift + 3 * j - 24 AS y
FROM landings l JOIN stocks s ON l.bag_id = s.bag_id AND l.club = s.club JOIN bag_holes b ON b.bag_id = l.bag_id,
  range(15) a(i), range(17) c(j) WHERE s.stock - 30 + 3 * i >= 1""")
relation("aim_price_table", aim_prices("SELECT * FROM aimed_balls"))
relation("best_aim_table", """SELECT * EXCLUDE (nth), row_number() OVER (PARTITION BY hole_id, bag_id ORDER BY round(expected_strokes, 9), club) AS place
FROM (SELECT *, row_number() OVER (PARTITION BY hole_id, bag_id, club ORDER BY round(expected_strokes, 9), aim) AS nth FROM aim_price_table) WHERE nth = 1""")
_EVAL = ["expected_strokes", "penalty_pct", "frac_on_green", "mean_proximity_yards"]


def bag_holes(clouds, names):
    """Every bag asked about every named hole."""
    return clouds.select("bag_id").distinct().select(
        "bag_id", F.explode(F.array(*map(F.lit, names))).alias("hole_id"))


@query("aim_evaluation", f"""SELECT hole_id, bag_id, club, aim, {', '.join(r6(c, c) for c in ['aim_distance', *_EVAL])}
FROM ({aim_prices('SELECT * FROM flag_balls')})""")
def aim_evaluation(spark, folder):
    """Every club of every bag fired straight at its stock distance."""
    clouds = tables.landings(spark, folder)
    placed = strategy.on_holes(
        strategy.cloud_cells(clouds), bag_holes(clouds, ["pond", "front"]), D.parametric_holes(spark))
    aimed = placed.withColumns({"aim": F.lit(0), "aim_distance": F.col("stock"), "aim_lateral": F.lit(0.0)})
    prices = strategy.evaluate_aims(aimed).drop("aim_lateral")
    return rounded(prices, ["aim_distance", *_EVAL])


relation("flag_balls", """SELECT b.hole_id, l.bag_id, l.club, 0 AS aim, s.stock AS aim_distance, 0e0 AS aim_lateral,
  l.carry - s.stock + s.stock AS x, l."lateral" - s.drift AS y
FROM landings l JOIN stocks s ON l.bag_id = s.bag_id AND l.club = s.club JOIN bag_holes b ON b.bag_id = l.bag_id""")


@query("shot_optimizer", f"""SELECT hole_id, bag_id, club, {', '.join(r6(c, c) for c in ['aim_distance', 'aim_lateral', *_EVAL])}, place FROM best_aim_table""")
def shot_optimizer(spark, folder):
    clouds = tables.landings(spark, folder)
    best = strategy.optimize_shots(clouds, bag_holes(clouds, ["pond", "front"]), D.parametric_holes(spark))
    return rounded(best, ["aim_distance", "aim_lateral", *_EVAL])


relation("naive_balls", """SELECT n.hole_id, l.bag_id, l.club, 0 AS aim, n.pin_distance AS aim_distance, 0e0 AS aim_lateral,
  l.carry - s.stock + n.pin_distance AS x, l."lateral" - s.drift AS y
FROM (SELECT h.hole_id, h.pin_distance, s.bag_id, arg_min(s.club, (round(abs(s.stock - h.pin_distance), 9), -s.stock, s.club)) AS club
      FROM holes h, stocks s GROUP BY ALL) n
JOIN landings l ON l.bag_id = n.bag_id AND l.club = n.club JOIN stocks s ON s.bag_id = l.bag_id AND s.club = l.club""")


@query("naive_against_best", f"""SELECT n.hole_id, n.bag_id, n.club AS naive_club, {r6('n.expected_strokes', 'naive_strokes')},
  {r6('n.penalty_pct', 'naive_penalty')}, b.club AS best_club, {r6('b.aim_distance', 'aim_distance')}, b.aim_lateral,
  {r6('b.expected_strokes', 'best_strokes')}, {r6('n.expected_strokes - b.expected_strokes', 'saved')}
FROM ({aim_prices('SELECT * FROM naive_balls')}) n JOIN best_aim_table b ON b.hole_id = n.hole_id AND b.bag_id = n.bag_id AND b.place = 1""")
def naive_against_best(spark, folder):
    clouds = tables.landings(spark, folder)
    table = strategy.naive_against_best(clouds, bag_holes(clouds, ["pond", "front"]), D.parametric_holes(spark))
    return rounded(table, ["naive_strokes", "naive_penalty", "aim_distance", "best_strokes", "saved"])


@query("nearest_club", """SELECT o.order_id, o.hole_distance, o.bag_id, arg_min(s.club, (round(abs(s.stock - o.hole_distance), 9), -s.stock, s.club)) AS club
FROM (SELECT o_orderkey AS order_id, CAST(o_orderkey % 300 AS DOUBLE) AS hole_distance, 'bag' || CAST(o_custkey % 3 AS VARCHAR) AS bag_id FROM orders) o
JOIN stocks s ON s.bag_id = o.bag_id GROUP BY ALL""")
def nearest_club(spark, folder):
    asked = tables.read(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id", "CAST(o_orderkey % 300 AS DOUBLE) AS hole_distance",
        "concat('bag', CAST(o_custkey % 3 AS STRING)) AS bag_id")
    return strategy.nearest_club(asked, strategy.cloud_centres(tables.landings(spark, folder)), "hole_distance").drop("stock")


# ---- polygon holes ------------------------------------------------------
relation("polygon_points", """SELECT CASE WHEN ord % 2 = 0 THEN 'P1' ELSE 'P2' END AS hole_id, ord, carry AS x, "lateral" AS y FROM landings""")


@query("polygon_lies", f"""SELECT p.hole_id, p.ord, p.x, p.y, {r6('sqrt(pow(h.pin_distance - p.x, 2) + pow(p.y, 2))', 'remaining')},
  {D.sql_lie('p.x', 'p.y', 'p.hole_id')} AS lie, {D.sql_in_layer('water', 'p.x', 'p.y', 'p.hole_id')} AS in_penalty
FROM polygon_points p JOIN course h ON p.hole_id = h.hole_id""")
def polygon_lies(spark, folder):
    return rounded(H.classify_polygon(points(spark, folder, ("P1", "P2")), D.polygon_holes(spark)), ["remaining"])


@query("polygon_membership", """SELECT p.hole_id, p.ord, e.layer FROM polygon_points p JOIN course_edges e ON p.hole_id = e.hole_id
AND ((e.y0 > p.y) <> (e.y1 > p.y)) AND p.x < (e.x1 - e.x0) * (p.y - e.y0) / (e.y1 - e.y0) + e.x0
GROUP BY p.hole_id, p.ord, e.layer, e.ring HAVING count(*) % 2 = 1""")
def polygon_membership(spark, folder):
    """(point, layer) pairs; the layers here have rings that do not overlap."""
    rings = course_rings(D.mapped_holes(spark))
    return inside_rings(points(spark, folder, ("P1", "P2")), rings, "hole_id").select("hole_id", "ord", "layer")


# Rings from the lines of an order: some are polygons, some cross themselves, some are too short.
RING_POINT = ["l_orderkey AS ring_id", "l_linenumber AS a", "l_partkey AS b", "l_suppkey AS c", "l_extendedprice AS d",
              "CAST(l_quantity AS DOUBLE) AS x", "CAST(l_partkey % 40 AS DOUBLE) AS y"]
relation("ring_lines", f"SELECT {', '.join(RING_POINT)} FROM lineitem")
relation("drawn_rings", """SELECT * EXCLUDE (px, py) FROM (SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER v) AS px, coalesce(lag(y) OVER w, last_value(y) OVER v) AS py
  FROM ring_lines WINDOW w AS (PARTITION BY ring_id ORDER BY a, b, c, d), v AS (PARTITION BY ring_id ORDER BY a, b, c, d ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
WHERE x <> px OR y <> py""")
relation("drawn_edges", """SELECT ring_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY ring_id) AS n, x AS x0, y AS y0,
  coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1
FROM drawn_rings WINDOW w AS (PARTITION BY ring_id ORDER BY a, b, c, d)""")
_SIDE = "(sign(({p}.x1 - {p}.x0) * ({q}.y0 - {p}.y0) - ({p}.y1 - {p}.y0) * ({q}.x0 - {p}.x0)) * sign(({p}.x1 - {p}.x0) * ({q}.y1 - {p}.y0) - ({p}.y1 - {p}.y0) * ({q}.x1 - {p}.x0)) <= 0)"
_OVERLAP = " AND ".join(f"greatest({p}.{s}0, {p}.{s}1) >= least({q}.{s}0, {q}.{s}1)" for s in "xy" for p, q in ("ef", "fe"))


@query("rejected_rings", f"""SELECT r.ring_id, CASE WHEN coalesce(n.n, 0) < 3 THEN 'short' WHEN s.ring_id IS NOT NULL THEN 'spike' ELSE 'crossing' END AS reason
FROM (SELECT DISTINCT ring_id FROM ring_lines) r LEFT JOIN (SELECT DISTINCT ring_id, n FROM drawn_edges) n ON n.ring_id = r.ring_id
LEFT JOIN (SELECT DISTINCT e.ring_id FROM drawn_edges e JOIN drawn_edges f ON f.ring_id = e.ring_id AND f.i = (e.i + 1) % e.n
  WHERE (e.x1 - e.x0) * (f.y1 - f.y0) - (e.y1 - e.y0) * (f.x1 - f.x0) = 0 AND (e.x1 - e.x0) * (f.x1 - f.x0) + (e.y1 - e.y0) * (f.y1 - f.y0) < 0) s ON s.ring_id = r.ring_id
LEFT JOIN (SELECT DISTINCT e.ring_id FROM drawn_edges e JOIN drawn_edges f ON f.ring_id = e.ring_id AND f.i - e.i >= 2 AND NOT (e.i = 0 AND f.i = e.n - 1)
  WHERE {_OVERLAP} AND {_SIDE.replace('{p}', 'e').replace('{q}', 'f')} AND {_SIDE.replace('{p}', 'f').replace('{q}', 'e')}) c ON c.ring_id = r.ring_id
WHERE coalesce(n.n, 0) < 3 OR s.ring_id IS NOT NULL OR c.ring_id IS NOT NULL""")
def rejected(spark, folder):
    """Rings drawn by the lines of an order that membership tests cannot use, and why."""
    lines = tables.read(spark, folder, "lineitem").selectExpr(*RING_POINT)
    ordered = F.array_sort(F.collect_list(F.struct("a", "b", "c", "d", "x", "y")))
    drawn = lines.groupBy("ring_id").agg(F.transform(ordered, lambda p: F.array(p["x"], p["y"])).alias("ring"))
    return rejected_rings(drawn, ["ring_id"])


SQL_HEIGHT = "(h.slope_x * ({x} - h.cx) + h.slope_y * ({y} - h.cy))"
P1_QUAD = D.COURSE["P1"]["green_quad"]
SQL_GRADE = f"""100 * CASE WHEN h.hole_id = 'P1' THEN sqrt(pow({P1_QUAD[1]}e0 + 2 * {P1_QUAD[3]}e0 * {{x}} + {P1_QUAD[4]}e0 * {{y}}, 2)
  + pow({P1_QUAD[2]}e0 + {P1_QUAD[4]}e0 * {{x}} + 2 * {P1_QUAD[5]}e0 * {{y}}, 2)) ELSE sqrt(pow(h.slope_x, 2) + pow(h.slope_y, 2)) END"""


def at(text: str, x: str, y: str) -> str:
    return text.replace("{x}", x).replace("{y}", y)


@query("green_surface", f"""SELECT p.hole_id, p.ord, {r6(at(SQL_HEIGHT, 'p.x', 'p.y'), 'height')}, {r6(at(SQL_GRADE, 'p.x', 'p.y'), 'grade')}
FROM polygon_points p JOIN course h ON p.hole_id = h.hole_id""")
def green_surface(spark, folder):
    x, y = F.col("x"), F.col("y")
    joined = points(spark, folder, ("P1", "P2")).join(D.polygon_holes(spark), "hole_id")
    return rounded(joined.select("hole_id", "ord", H.green_height(x, y).alias("height"),
                                 H.green_grade(x, y).alias("grade")), ["height", "grade"])


ELEVATION = _intervals("P1", [k[0] for k in D.COURSE["P1"]["elevation"]], [k[1] for k in D.COURSE["P1"]["elevation"]])
relation("ground", values_sql(["hole_id", "from_x", "to_x", "x0", "y0", "slope"], ELEVATION))


@query("ground_height", f"""SELECT p.hole_id, p.ord, {r6('coalesce(g.y0 + g.slope * (p.x - g.x0), 0)', 'height')} FROM polygon_points p
LEFT JOIN ground g ON g.hole_id = p.hole_id AND p.x >= g.from_x AND p.x < g.to_x""")
def ground_height(spark, folder):
    joined = points(spark, folder, ("P1", "P2")).join(D.polygon_holes(spark).select("hole_id", "elevation"), "hole_id")
    return rounded(joined.select("hole_id", "ord", H.ground_height(F.col("elevation"), F.col("x")).alias("height")), ["height"])


relation("picked_tees", """SELECT t.hole_id, l.level, t.downrange, t."lateral", t.yards FROM (
  SELECT *, row_number() OVER (PARTITION BY hole_id ORDER BY yards DESC, downrange, "lateral") - 1 AS at, count(*) OVER (PARTITION BY hole_id) AS n FROM tees) t
JOIN (VALUES ('Back'), ('Middle'), ('Forward')) l(level) ON t.at = CASE l.level WHEN 'Back' THEN 0 WHEN 'Middle' THEN (t.n - 1) // 2 ELSE t.n - 1 END
UNION ALL SELECT h.hole_id, l.level, 0e0, 0e0, h.pin_distance FROM course h, (VALUES ('Back'), ('Middle'), ('Forward')) l(level)
WHERE h.hole_id NOT IN (SELECT hole_id FROM tees)""")


# ---- approaches ---------------------------------------------------------
PIN_COLUMNS = ["pin_id", "hole_id", "pin_x", "pin_y", "from_distance", "short_game"]
PINS = [("centre", "P1", 160.0, 0.0, 152.0, 0.0), ("left", "P1", 158.0, -8.0, 152.0, 0.25),
        ("back", "P2", 214.0, 4.0, 178.0, 0.4)]
relation("pins", "SELECT p.*, b.bag_id FROM (" + values_sql(PIN_COLUMNS, PINS) + ") p, (SELECT DISTINCT bag_id FROM landings) b")


def pins(spark, clouds):
    flags = spark.sql(values_sql(PIN_COLUMNS, PINS))
    asked = clouds.select("bag_id").distinct().select(
        "bag_id", F.explode(F.array(*[F.lit(p[0]) for p in PINS])).alias("pin_id"))
    return flags.join(asked, "pin_id")


def requested_cells(requests: str, key: str) -> str:
    """Landings of the nearest club, about the cloud's mean."""
    return f"""SELECT q.*, l.carry - s.stock AS dx, l."lateral" - s.drift AS dy FROM (
  SELECT {key}, r.bag_id, arg_min(s.club, (round(abs(s.stock - r.from_distance), 9), -s.stock, s.club)) AS club
  FROM ({requests}) r JOIN stocks s ON s.bag_id = r.bag_id GROUP BY {key}, r.bag_id) q
JOIN stocks s ON s.bag_id = q.bag_id AND s.club = q.club
JOIN landings l ON l.bag_id = q.bag_id AND l.club = q.club"""


def approach_sql(source: str) -> str:
    """`source`: hole_id, pin_x, pin_y, short_game, x, y per ball; adds lie, left_yards, cost."""
    landed = f"""SELECT b.*, sqrt(pow(pin_x - x, 2) + pow(pin_y - y, 2)) AS left_yards, {D.sql_lie('x', 'y')} AS lie,
  {D.sql_in_layer('water', 'x', 'y')} AS wet FROM ({source}) b"""
    height = f"({at(SQL_HEIGHT, 'p.x', 'p.y')} - {at(SQL_HEIGHT, 'p.pin_x', 'p.pin_y')})"
    tax = taxed("p.e", "p.left_yards", "p.lie", "p.short_game", "h.difficulty")
    return f"""SELECT p.*, CASE WHEN wet THEN 3.7e0 ELSE {tax} + CASE WHEN p.lie = 'green' THEN 0.35e0 * {height} ELSE 0 END END AS cost
FROM ({priced(landed, 'left_yards', 'lie', 'e')}) p JOIN course h ON p.hole_id = h.hole_id"""


relation("pin_cells", requested_cells("SELECT * FROM pins", "r.pin_id"))
relation("pin_balls", """SELECT c.pin_id, c.bag_id, c.club, p.hole_id, p.pin_x, p.pin_y, p.short_game, i * 21 + j AS aim, 2e0 * i - 24 AS long_yds,
  2e0 * j - 20 AS right_yds, p.pin_x + 2e0 * i - 24 + c.dx AS x, p.pin_y + 2e0 * j - 20 + c.dy AS y
FROM pin_cells c JOIN pins p ON p.pin_id = c.pin_id AND p.bag_id = c.bag_id, range(17) a(i), range(21) b(j)""")
_PIN = ["expected_strokes", "on_green_pct", "proximity_ft"]


@query("approach_aim", f"""SELECT pin_id, bag_id, club, long_yds, right_yds, {', '.join(r6(c, c) for c in _PIN)} FROM (
  SELECT *, row_number() OVER (PARTITION BY pin_id, bag_id ORDER BY round(expected_strokes, 9), aim) AS nth FROM (
    SELECT pin_id, bag_id, club, aim, long_yds, right_yds, avg(cost) AS expected_strokes,
      100 * avg(CASE WHEN lie = 'green' THEN 1e0 ELSE 0e0 END) AS on_green_pct, 3 * avg(CASE WHEN lie = 'green' THEN left_yards END) AS proximity_ft
    FROM ({approach_sql('SELECT * FROM pin_balls')}) GROUP BY ALL)) WHERE nth = 1""")
def approach_aim(spark, folder):
    clouds = tables.landings(spark, folder)
    return rounded(strategy.aim_for_pin(clouds, pins(spark, clouds), D.polygon_holes(spark)), _PIN)


def lattice_sql(step: float) -> str:
    line = "range(CAST(greatest(ceil(({high} - {low}) / {step}), 1) AS BIGINT))".replace("{step}", f"{step}e0")
    edge = """(SELECT min(sqrt(pow(g.px - e.x0 - g.t * 0, 2) * 0 + pow(g.px - (e.x0 + greatest(0, least(1, ((g.px - e.x0) * (e.x1 - e.x0) + (g.py - e.y0) * (e.y1 - e.y0))
  / (pow(e.x1 - e.x0, 2) + pow(e.y1 - e.y0, 2)))) * (e.x1 - e.x0)), 2)
  + pow(g.py - (e.y0 + greatest(0, least(1, ((g.px - e.x0) * (e.x1 - e.x0) + (g.py - e.y0) * (e.y1 - e.y0))
  / (pow(e.x1 - e.x0, 2) + pow(e.y1 - e.y0, 2)))) * (e.y1 - e.y0)), 2))) FROM course_edges e WHERE e.hole_id = g.hole_id AND e.layer = 'green')"""
    edge = edge.replace("pow(g.px - e.x0 - g.t * 0, 2) * 0 + ", "")
    return f"""SELECT g.hole_id, g.px, g.py, {edge} AS edge FROM (
  SELECT hole_id, ax + i * {step}e0 AS px, ay + j * {step}e0 AS py FROM (
    SELECT hole_id, ax, ay, i, unnest({line.replace('{high}', 'by_').replace('{low}', 'ay')}) AS j FROM (
      SELECT hole_id, ax, ay, by_, unnest({line.replace('{high}', 'bx').replace('{low}', 'ax')}) AS i FROM (
        SELECT hole_id, min(x0) AS ax, max(x0) AS bx, min(y0) AS ay, max(y0) AS by_ FROM course_edges WHERE layer = 'green' GROUP BY hole_id)))) g
WHERE {D.sql_in_layer('green', 'g.px', 'g.py', 'g.hole_id')}"""


relation("lattice1", lattice_sql(1.0))
relation("lattice3", lattice_sql(3.0))
EDGE_SQL = """(SELECT min(sqrt(pow({x} - (e.x0 + greatest(0, least(1, (({x} - e.x0) * (e.x1 - e.x0) + ({y} - e.y0) * (e.y1 - e.y0))
  / (pow(e.x1 - e.x0, 2) + pow(e.y1 - e.y0, 2)))) * (e.x1 - e.x0)), 2)
  + pow({y} - (e.y0 + greatest(0, least(1, (({x} - e.x0) * (e.x1 - e.x0) + ({y} - e.y0) * (e.y1 - e.y0))
  / (pow(e.x1 - e.x0, 2) + pow(e.y1 - e.y0, 2)))) * (e.y1 - e.y0)), 2))) FROM course_edges e WHERE e.hole_id = {h} AND e.layer = 'green')"""
REQUESTED_PIN = ["ord AS pin_id", "CASE WHEN ord % 2 = 0 THEN 'P1' ELSE 'P2' END AS hole_id",
                 "CASE WHEN ord % 2 = 0 THEN 160e0 ELSE 208e0 END + lateral AS pin_x", "lateral * 1.5e0 AS pin_y"]
relation("asked_pins", "SELECT ord AS pin_id, CASE WHEN ord % 2 = 0 THEN 'P1' ELSE 'P2' END AS hole_id, "
         "CASE WHEN ord % 2 = 0 THEN 160e0 ELSE 208e0 END + \"lateral\" AS pin_x, \"lateral\" * 1.5e0 AS pin_y FROM landings")


@query("pin_clamp", f"""SELECT p.pin_id, p.hole_id, p.pin_x, p.pin_y, round(CASE WHEN p.ok THEN p.pin_x ELSE n.x END, 6) AS clamped_x,
  round(CASE WHEN p.ok THEN p.pin_y ELSE n.y END, 6) AS clamped_y
FROM (SELECT q.*, {D.sql_in_layer('green', 'q.pin_x', 'q.pin_y', 'q.hole_id')}
        AND {EDGE_SQL.replace('{x}', 'q.pin_x').replace('{y}', 'q.pin_y').replace('{h}', 'q.hole_id')} >= 3 AS ok FROM asked_pins q) p
LEFT JOIN (SELECT d.hole_id, d.pin_x, d.pin_y, arg_min(l.px, (round(sqrt(pow(l.px - d.pin_x, 2) + pow(l.py - d.pin_y, 2)), 9), l.px, l.py)) AS x,
    arg_min(l.py, (round(sqrt(pow(l.px - d.pin_x, 2) + pow(l.py - d.pin_y, 2)), 9), l.px, l.py)) AS y
  FROM (SELECT DISTINCT hole_id, pin_x, pin_y FROM asked_pins) d JOIN lattice1 l ON l.hole_id = d.hole_id AND l.edge >= 3 GROUP BY 1, 2, 3) n
  ON n.hole_id = p.hole_id AND n.pin_x = p.pin_x AND n.pin_y = p.pin_y""")
def pin_clamp(spark, folder):
    """Flags asked for at scattered spots, moved onto the green."""
    asked = tables.landings(spark, folder).selectExpr(*REQUESTED_PIN)
    spots = strategy.clamp_pins(asked.select("hole_id", "pin_x", "pin_y").distinct(), D.polygon_holes(spark))
    return rounded(asked.join(spots, ["hole_id", "pin_x", "pin_y"]), ["clamped_x", "clamped_y"])


SURFACE_COLUMNS = ["hole_id", "from_distance", "short_game"]
SURFACE = [("P1", 150.0, 0.3), ("P2", 180.0, 0.0)]
relation("surface_requests", "SELECT p.*, b.bag_id FROM (" + values_sql(SURFACE_COLUMNS, SURFACE) + ") p, (SELECT DISTINCT bag_id FROM landings) b")
relation("flags", f"""SELECT hole_id, px AS pin_x, py AS pin_y FROM (SELECT *, quantile_cont(grade, 0.7) OVER (PARTITION BY hole_id) AS cut FROM (
  SELECT l.*, {at(SQL_GRADE, 'l.px', 'l.py')} AS grade, max(l.edge) OVER (PARTITION BY l.hole_id) AS deepest FROM lattice3 l JOIN course h ON h.hole_id = l.hole_id)
  WHERE edge >= CASE WHEN deepest >= 4 THEN 4 WHEN deepest >= 2 THEN 2 ELSE 0 END) WHERE hole_id <> 'P1' OR grade <= cut""")
relation("surface_cells", requested_cells("SELECT * FROM surface_requests", "r.hole_id"))
relation("surface_balls", """SELECT c.hole_id, c.bag_id, f.pin_x, f.pin_y, q.short_game, b.bail, f.pin_x + b.bail * (h.cx - f.pin_x) + c.dx AS x,
  f.pin_y + b.bail * (h.cy - f.pin_y) + c.dy AS y
FROM surface_cells c JOIN surface_requests q ON q.hole_id = c.hole_id AND q.bag_id = c.bag_id JOIN flags f ON f.hole_id = c.hole_id
JOIN course h ON h.hole_id = c.hole_id, (VALUES (0e0), (0.3e0), (0.55e0)) b(bail)""")


@query("pin_difficulty", f"""SELECT hole_id, bag_id, {dround('pin_x', 1)} AS pin_x, {dround('pin_y', 1)} AS pin_y, expected,
  {dround('expected - min(expected) OVER (PARTITION BY hole_id, bag_id)', 3)} AS over_easiest FROM (
  SELECT hole_id, bag_id, pin_x, pin_y, {dround('min(price)', 3)} AS expected FROM (
    SELECT hole_id, bag_id, pin_x, pin_y, bail, avg(cost) AS price FROM ({approach_sql('SELECT * FROM surface_balls')}) GROUP BY ALL) GROUP BY ALL)""")
def pin_difficulty(spark, folder):
    clouds = tables.landings(spark, folder)
    asked = clouds.select("bag_id").distinct().select(
        "bag_id", F.explode(F.array(*[F.lit(r[0]) for r in SURFACE])).alias("hole_id"))
    requests = spark.sql(values_sql(SURFACE_COLUMNS, SURFACE)).join(asked, "hole_id")
    return strategy.pin_difficulty(clouds, requests, D.polygon_holes(spark))


@query("over_easiest", """SELECT club, bag_id, stock, round(stock - min(stock) OVER (PARTITION BY bag_id), 3) AS over_easiest
FROM (SELECT bag_id, club, round(stock, 3) AS stock FROM stocks)""")
def over_easiest(spark, folder):
    stocks = strategy.cloud_centres(tables.landings(spark, folder)).select("bag_id", "club", F.round("stock", 3).alias("stock"))
    return strategy.over_easiest(stocks, ["bag_id"], "stock")


# ---- conditions ---------------------------------------------------------
CONDITION_COLUMNS = ["scenario", "wind_mph", "wind_from_deg", "temp_c", "altitude_m"]
CONDITION_CELLS = ["event_id AS scenario", "'home' AS course_id", "CAST(event_id % 31 AS DOUBLE) AS wind_mph",
                   "CAST((event_id * 7) % 360 AS DOUBLE) AS wind_from_deg", "CAST(event_id % 45 AS DOUBLE) - 5e0 AS temp_c",
                   "CAST((event_id * 13) % 2500 AS DOUBLE) AS altitude_m"]
relation("conditions", f"SELECT {', '.join(CONDITION_CELLS)} FROM events")
_ANGLE = "(((c.wind_from_deg - h.bearing_deg) % 360 + 360) % 360)"


@query("conditions", f"""SELECT scenario, hole_id, {r6('101325e0 * pow(1 - 0.0065e0 * altitude_m / 288.15e0, 9.80665e0 / (287.05e0 * 0.0065e0)) / (287.05e0 * (temp_c + 273.15e0))', 'air_density')},
  {r6('wind_mph * 0.44704e0 * cos(radians(angle + 180))', 'wind_x')}, {r6('wind_mph * 0.44704e0 * sin(radians(angle + 180))', 'wind_y')},
  CASE WHEN wind_mph = 0 THEN 'calm' ELSE coalesce(nullif(concat_ws(' ',
    CASE WHEN cos(radians(angle)) > 0.35 THEN 'into' WHEN cos(radians(angle)) < -0.35 THEN 'downwind' END,
    CASE WHEN sin(radians(angle)) > 0.35 THEN 'off the right' WHEN sin(radians(angle)) < -0.35 THEN 'off the left' END), ''), 'crosswind') END AS wind_class
FROM (SELECT c.*, h.hole_id, {_ANGLE} AS angle FROM conditions c, course h)""")
def conditions(spark, folder):
    scenarios = tables.read_events(spark, folder).selectExpr(*CONDITION_CELLS)
    holes = D.polygon_holes(spark).select("course_id", "hole_id", "bearing_deg")
    return rounded(strategy.conditions_on_holes(scenarios, holes), ["air_density", "wind_x", "wind_y"])


@query("shape_skew", """SELECT event_id, hand, shape, CASE WHEN shape = 'Straight' THEN 0e0 WHEN shape = 'Draw' THEN -0.35e0 ELSE 0.35e0 END
  * CASE WHEN hand = 'Right' OR shape = 'Straight' THEN 1 ELSE -1 END AS skew
FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Left' ELSE 'Right' END AS hand,
  CASE event_id % 3 WHEN 0 THEN 'Draw' WHEN 1 THEN 'Fade' ELSE 'Straight' END AS shape FROM events)""")
def shape_skew(spark, folder):
    golfers = tables.read_events(spark, folder).selectExpr(
        "event_id", "CASE WHEN event_id % 4 = 0 THEN 'Left' ELSE 'Right' END AS hand",
        "CASE event_id % 3 WHEN 0 THEN 'Draw' WHEN 1 THEN 'Fade' ELSE 'Straight' END AS shape")
    return golfers.select("*", U.shape_skew(F.col("hand"), F.col("shape")).alias("skew"))


DELTAS = [("Driver", -12.5, 3.25), ("5-iron", -6.0, -1.5), ("PW", 4.5, 0.5)]
relation("deltas", values_sql(["club", "d_carry", "d_lateral"], DELTAS))


@query("shifted_clouds", """SELECT l.ord, l.bag_id, l.club, round(l.carry + coalesce(d.d_carry, 0), 6) AS carry,
  round(l."lateral" + coalesce(d.d_lateral, 0), 6) AS "lateral" FROM landings l LEFT JOIN deltas d ON l.club = d.club""")
def shifted_clouds(spark, folder):
    deltas = spark.sql(values_sql(["club", "d_carry", "d_lateral"], DELTAS))
    return rounded(strategy.shift_clouds(tables.landings(spark, folder), deltas), ["carry", "lateral"])


@query("shifted_bag", f"""SELECT *, row_number() OVER (PARTITION BY bag_id ORDER BY carry_mean_yards DESC, club) AS place FROM (
  SELECT s.bag_id, s.club, {r6('s.m + coalesce(d.d_carry, 0)', 'carry_mean_yards')}, {r6('s.sd', 'carry_std_yards')},
    {r6('s.lat + coalesce(d.d_lateral, 0)', 'lateral_mean_yards')}, {r6('s.p10 + coalesce(d.d_carry, 0)', 'carry_p10_yards')},
    {r6('s.p90 + coalesce(d.d_carry, 0)', 'carry_p90_yards')}
  FROM (SELECT bag_id, club, avg(carry) AS m, stddev_pop(carry) AS sd, avg("lateral") AS lat, quantile_cont(carry, 0.1) AS p10,
    quantile_cont(carry, 0.9) AS p90 FROM landings GROUP BY bag_id, club) s LEFT JOIN deltas d ON s.club = d.club)""")
def shifted_bag(spark, folder):
    from swingframe.operators.bags import cloud_summary

    deltas = spark.sql(values_sql(["club", "d_carry", "d_lateral"], DELTAS))
    cols = ["carry_mean_yards", "carry_std_yards", "lateral_mean_yards", "carry_p10_yards", "carry_p90_yards"]
    summary = cloud_summary(tables.landings(spark, folder), ["bag_id", "club"]).select("bag_id", "club", *cols)
    return rounded(strategy.shift_summaries(summary, deltas), cols)
