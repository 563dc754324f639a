"""Holes, tees, ground, profiles and sessions made from the given tables, and the queries over them.

A supplier is a hole; its customers are the rectangles, tees and ground marks of that hole; sessions
are days of events. So their number grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from swingframe.operators import bags, dims, silver
from swingframe.operators import holes as H
from swingframe.operators import planning as P
from swingframe.operators.joins import lookup
from swingframe.plans import tables
from swingframe.plans.bags import r6, rounded
from swingframe.plans.registry import query, relation
from swingframe.sources import seeds

SIZE = 20.0
OF_CUSTOMER = "CAST((c_custkey - c_custkey % 15) / 15 AS BIGINT)"
HOLE = ["concat('s', CAST(s_suppkey AS STRING)) AS hole_id", "CAST(120 + (s_suppkey * 7) % 100 AS DOUBLE) AS pin_distance",
        "CAST(5 + s_suppkey % 4 AS DOUBLE) AS green_radius", "CAST(12 + s_suppkey % 8 AS DOUBLE) AS half_width",
        "CAST(s_suppkey % 5 AS DOUBLE) / 1e1 AS green_difficulty"]
REGION = [f"concat('s', CAST({OF_CUSTOMER} AS STRING)) AS hole_id", "concat('r', CAST(c_custkey AS STRING)) AS region_id", "CAST(c_custkey % 15 AS INT) AS ord",
          tables.pick("CAST(c_custkey % 3 AS INT)", ["sand", "water", "ob"]) + " AS kind",
          "CAST(60 + (c_custkey * 13) % 120 AS DOUBLE) AS near", "CAST(70 + (c_custkey * 13) % 120 + (c_custkey % 7) * 3 AS DOUBLE) AS far",
          "CAST((c_custkey * 11) % 70 - 40 AS DOUBLE) AS left", "CAST((c_custkey * 11) % 70 - 32 + (c_custkey % 5) * 2 AS DOUBLE) AS right",
          "CAST(1 + c_custkey % 2 AS DOUBLE) AS penalty_strokes", "CASE WHEN c_custkey % 2 = 0 THEN CAST(40 + (c_custkey * 13) % 120 AS DOUBLE) END AS drop_distance"]
HAS_REGION = f"c_custkey % 15 <= {OF_CUSTOMER} % 4 AND {OF_CUSTOMER} % 9 <> 0"


def _duck(columns: list[str]) -> str:
    return ", ".join(columns).replace("AS STRING", "AS VARCHAR").replace("AS left", 'AS "left"').replace("AS right", 'AS "right"')


relation("made_holes", f"SELECT {_duck(HOLE)} FROM supplier")
relation("made_regions", f"SELECT {_duck(REGION)} FROM customer WHERE {HAS_REGION}")


def holes(spark, folder):
    """Parametric holes with their rectangles."""
    regions = tables.read(spark, folder, "customer").where(HAS_REGION).selectExpr(
        *[c.replace("AS left", "AS `left`").replace("AS right", "AS `right`") for c in REGION])
    return H.lay_regions(tables.read(spark, folder, "supplier").selectExpr(*HOLE), regions)


relation("made_bounds", """SELECT h.hole_id, 0e0 AS min_x, h.pin_distance + 40 AS max_x, -greatest(h.half_width + 25, 40) AS min_y,
  greatest(h.half_width + 25, 40) AS max_y, CASE WHEN f.hole_id IS NULL OR f.drop_distance IS NULL THEN h.pin_distance - 30 ELSE f.drop_distance END AS drop_x,
  coalesce(f.penalty_strokes, 1) AS penalty_cost, h.pin_distance, h.green_radius, h.half_width FROM made_holes h
LEFT JOIN (SELECT * FROM made_regions WHERE kind IN ('water', 'ob') QUALIFY row_number() OVER (PARTITION BY hole_id ORDER BY ord) = 1) f ON f.hole_id = h.hole_id""")
BOUNDS = ["min_x", "max_x", "min_y", "max_y", "drop_x", "penalty_cost"]


@query("parametric_bounds", f"SELECT hole_id, {', '.join(BOUNDS)} FROM made_bounds")
def parametric_bounds(spark, folder):
    """Grid extent and replay point of every hole."""
    return H.parametric_bounds(holes(spark, folder)).select("hole_id", *BOUNDS)


_IN = 'EXISTS (SELECT 1 FROM made_regions r WHERE r.hole_id = c.hole_id AND r.kind IN ({kinds}) AND c.x BETWEEN r.near AND r.far AND c.y BETWEEN r."left" AND r."right")'


@query("hole_grid", f"""SELECT hole_id, i, j, {r6('x', 'x')}, {r6('y', 'y')}, {r6('remaining', 'remaining')}, lie, in_penalty,
  CASE WHEN lie IN ('rough', 'sand') THEN lie ELSE 'clean' END AS lie_class FROM (
  SELECT *, CASE WHEN {_IN.format(kinds="'sand'")} THEN 'sand' WHEN remaining <= green_radius THEN 'green' WHEN abs(y) <= half_width THEN 'fairway' ELSE 'rough' END AS lie,
    {_IN.format(kinds="'water', 'ob'")} AS in_penalty FROM (
    SELECT *, sqrt(pow(pin_distance - x, 2) + pow(y, 2)) AS remaining FROM (
      SELECT *, {SIZE / 2}e0 + i * {SIZE}e0 AS x, min_y + {SIZE / 2}e0 + j * {SIZE}e0 AS y FROM (
        SELECT *, CAST(unnest(range(CAST(ceil((max_y - min_y - {SIZE / 2}e0) / {SIZE}e0) AS BIGINT))) AS INT) AS j FROM (
          SELECT *, CAST(unnest(range(CAST(ceil((max_x - {SIZE / 2}e0) / {SIZE}e0) AS BIGINT))) AS INT) AS i FROM made_bounds)))) c)""")
def hole_grid(spark, folder):
    """The planning cells of every hole."""
    frames = P.grid_frames(H.parametric_bounds(holes(spark, folder)), SIZE)
    return rounded(P.hole_grid(frames, SIZE, polygon=False), ["x", "y", "remaining"])


# ---- polygon holes --------------------------------------------------------
PIN = "CAST(150 + (s_suppkey * 13) % 80 AS DOUBLE)"
SHAPES = [  # layer, ring, whether a hole has it, points (x, y) as expressions
    ("green", 0, "true", [(f"{PIN} - 10 - s_suppkey % 3", "-9e0"), (f"{PIN} + 9", "-10e0 - s_suppkey % 4"), (f"{PIN} + 11", "8e0"), (f"{PIN} - 9", "10e0 + s_suppkey % 2")]),
    ("fairway", 0, "true", [("60e0", "-14e0"), (f"{PIN} - 25", "-15e0"), (f"{PIN} - 22", "13e0"), ("58e0", "12e0")]),
    ("fairway", 1, "s_suppkey % 2 = 0", [("10e0", "-50e0 - s_suppkey % 7"), ("40e0", "-48e0"), ("38e0", "-20e0")]),
    ("bunkers", 0, "s_suppkey % 4 <> 1", [(f"{PIN} - 4", "14e0"), (f"{PIN} + 6 + s_suppkey % 30", "15e0"), (f"{PIN} + 2", "22e0 + s_suppkey % 30")]),
    ("water", 0, "s_suppkey % 3 = 0", [("90e0 + s_suppkey % 11", "-30e0"), ("120e0", "-31e0"), ("118e0", "20e0")]),
]
relation("made_course", " UNION ALL ".join(
    f"SELECT concat('c', CAST(s_suppkey AS VARCHAR)) AS hole_id, '{layer}' AS layer, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM supplier WHERE {has}"
    for layer, _, has, points in SHAPES for x, y in points))
relation("made_pins", f"SELECT concat('c', CAST(s_suppkey AS VARCHAR)) AS hole_id, {PIN} AS pin_distance, s_suppkey % 4 AS kind FROM supplier")
MARK = [f"concat('c', CAST({OF_CUSTOMER} AS STRING)) AS hole_id", "CAST((c_custkey % 15) * 20 AS DOUBLE) AS x", "CAST(CAST(floor(c_acctbal) AS BIGINT) % 300 AS DOUBLE) / 1e1 AS height"]
HAS_MARK = f"c_custkey % 15 < 10 AND {OF_CUSTOMER} % 4 <> 0"
TEE = [f"concat('c', CAST({OF_CUSTOMER} AS STRING)) AS hole_id", "CAST((c_custkey % 15) * 6 AS DOUBLE) AS downrange", "CAST(c_custkey % 5 - 2 AS DOUBLE) AS lateral",
       f"CAST(150 + ({OF_CUSTOMER} * 13) % 80 - (c_custkey % 15) * 6 AS DOUBLE) AS yards"]
HAS_TEE = f"c_custkey % 15 < {OF_CUSTOMER} % 6"
relation("made_marks", f"SELECT {_duck(MARK)} FROM customer WHERE {HAS_MARK}")
relation("made_tees", f"SELECT {_duck(TEE).replace('AS lateral', 'AS "lateral"')} FROM customer WHERE {HAS_TEE}")


def course(spark, folder):
    """Polygon holes, prepared for membership tests."""
    def ring(points):
        return "array(" + ", ".join(f"array(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for x, y in points) + ")"

    def layer(name):
        rings = [f"CASE WHEN {has} THEN {ring(points)} END" for kind, _, has, points in SHAPES if kind == name]
        return f"filter(array({', '.join(rings)}), r -> r IS NOT NULL)"

    marks = tables.read(spark, folder, "customer").where(HAS_MARK).selectExpr(*MARK)
    ground = marks.groupBy("hole_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("x", "height"))), lambda m: F.array(m["x"], m["height"])).alias("elevation"))
    shapes = tables.read(spark, folder, "supplier").selectExpr(
        "concat('c', CAST(s_suppkey AS STRING)) AS hole_id", f"{PIN} AS pin_distance", f"{layer('green')}[0] AS green",
        *[f"{layer(n)} AS {n}" for n in ("fairway", "bunkers", "water")], "CAST(array() AS array<array<array<double>>>) AS playable")
    return H.prepare_course(shapes.join(ground, "hole_id", "left"))


@query("course_bounds", f"""SELECT h.hole_id, least(0, e.a - 10) AS min_x, greatest(e.b, h.pin_distance) + 20 AS max_x,
  least(-40, e.c - 15) AS min_y, greatest(40, e.d + 15) AS max_y, coalesce(greatest(0, w.x - 5), h.pin_distance - 30) AS drop_x, 1e0 AS penalty_cost FROM made_pins h
JOIN (SELECT hole_id, min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM made_course GROUP BY hole_id) e ON e.hole_id = h.hole_id
LEFT JOIN (SELECT hole_id, min(x) AS x FROM made_course WHERE layer = 'water' GROUP BY hole_id) w ON w.hole_id = h.hole_id""")
def course_bounds(spark, folder):
    """Grid extent, lay-up point and penalty of every polygon hole."""
    return H.course_bounds(course(spark, folder)).select("hole_id", *BOUNDS)


relation("made_levels", """SELECT t.hole_id, l.level, t.downrange, t."lateral", t.yards FROM (
  SELECT *, row_number() OVER (PARTITION BY hole_id ORDER BY yards DESC, downrange, "lateral") - 1 AS at, count(*) OVER (PARTITION BY hole_id) AS n FROM made_tees) t
JOIN (VALUES ('Back'), ('Middle'), ('Forward')) l(level) ON t.at = CASE l.level WHEN 'Back' THEN 0 WHEN 'Middle' THEN (t.n - 1) // 2 ELSE t.n - 1 END
UNION ALL SELECT h.hole_id, l.level, 0e0, 0e0, h.pin_distance FROM made_pins h, (VALUES ('Back'), ('Middle'), ('Forward')) l(level)
WHERE h.hole_id NOT IN (SELECT hole_id FROM made_tees)""")


def tees(spark, folder):
    return tables.read(spark, folder, "customer").where(HAS_TEE).selectExpr(*TEE)


@query("tee_levels", 'SELECT hole_id, level, downrange, "lateral" AS "lateral", yards FROM made_levels')
def tee_levels(spark, folder):
    """The back, middle and forward tee of every hole."""
    return H.pick_tees(tees(spark, folder), course(spark, folder).select("hole_id", "pin_distance"))


relation("made_slopes", """SELECT hole_id, x AS from_x, coalesce(nx, 1e9) AS to_x, x AS x0, height AS y0, CASE WHEN nx IS NULL THEN 0 ELSE (nh - height) / (nx - x) END AS slope
FROM (SELECT *, lead(x) OVER w AS nx, lead(height) OVER w AS nh FROM made_marks WINDOW w AS (PARTITION BY hole_id ORDER BY x))""")


def _ground(x: str) -> str:
    return f"coalesce((SELECT g.y0 + g.slope * ({x} - g.x0) FROM made_slopes g WHERE g.hole_id = t.hole_id AND {x} >= g.from_x AND {x} < g.to_x), 0)"


@query("plays_like", f"""SELECT t.hole_id, t.level, t.downrange, t."lateral" AS "lateral", t.yards, {r6(_ground('h.pin_distance') + ' - ' + _ground('t.downrange'), 'net_rise')},
  {r6('t.yards + 0.93e0 * (' + _ground('h.pin_distance') + ' - ' + _ground('t.downrange') + ')', 'plays_like')}
FROM made_levels t JOIN made_pins h ON t.hole_id = h.hole_id""")
def plays_like(spark, folder):
    """Net rise and the yardage that each tee plays like."""
    played = course(spark, folder)
    return rounded(H.plays_like(H.pick_tees(tees(spark, folder), played.select("hole_id", "pin_distance")), played), ["net_rise", "plays_like"])


# ---- profiles, averages, sessions ------------------------------------------
PROFILE = ["c_name AS profile", "CASE WHEN c_custkey % 3 = 0 THEN 'lpga' ELSE 'pga' END AS tour", "6e-1 + CAST(c_custkey % 40 AS DOUBLE) / 1e2 AS dist_scale"]


@query("profile_stock", f"""SELECT p.profile, t.club, {r6('t.ball_speed_mph * p.dist_scale', 'ball_speed_mph')}, {r6('t.carry_yards * p.dist_scale', 'carry_yards')}
FROM (SELECT {', '.join(PROFILE)} FROM customer) p JOIN (SELECT 'pga' AS tour, * FROM tour_pga UNION ALL SELECT 'lpga', * FROM tour_lpga) t ON p.tour = t.tour""")
def profile_stock(spark, folder):
    """The stock table of every customer's profile."""
    profiles = tables.read(spark, folder, "customer").selectExpr(*PROFILE)
    return rounded(bags.profile_stock(seeds.all_tours(spark), profiles), ["ball_speed_mph", "carry_yards"])


@query("tour_averages", f"""SELECT l.bag_id, t.club, {r6('t.ball_speed_mph', 'ball_speed_mph')}, {r6('avg(l.carry) - t.carry_yards', 'over_tour')}, count(*) AS shots
FROM landings l JOIN tour_pga t ON t.club = l.club GROUP BY l.bag_id, t.club, t.ball_speed_mph, t.carry_yards""")
def tour_averages(spark, folder):
    """Every bag's carry against the typed reference averages."""
    reference = seeds.tour_averages(spark, "pga").select("club", "ball_speed_mph", "carry_yards")
    own = tables.landings(spark, folder).groupBy("bag_id", "club").agg(F.avg("carry").alias("_own"), F.count(F.lit(1)).alias("shots"))
    return rounded(own.join(reference, "club").select("bag_id", "club", "ball_speed_mph", (F.col("_own") - F.col("carry_yards")).alias("over_tour"), "shots"),
                   ["ball_speed_mph", "over_tour"])


SOURCE_OF = "CASE event_type " + " ".join(f"WHEN '{kind}' THEN '{source}'" for source, (kind, _) in tables.RAW_COLUMNS.items()) + " END"
MANIFEST_SQL = f"""
SELECT source, concat(source, '-', day) AS session_id, day AS session_date, CASE WHEN first % 2 = 0 THEN 'indoor' ELSE 'outdoor' END AS indoor_outdoor,
       concat('unit ', CAST(first % 9 AS STRING)) AS device, CASE WHEN first % 3 = 0 THEN 'estimated' ELSE 'measured' END AS carry_method,
       CASE WHEN first % 5 = 0 THEN 'range' ELSE 'premium' END AS ball_type
FROM (SELECT {SOURCE_OF} AS source, CAST(CAST(ts AS DATE) AS STRING) AS day, min(event_id) AS first FROM events GROUP BY 1, 2) AS s
"""
relation("made_manifest", MANIFEST_SQL.replace("AS STRING", "AS VARCHAR"))


@query("dim_session", """SELECT d.*, coalesce(n.shots, 0) AS shots FROM (
  SELECT md5(session_id) AS session_key, session_id, source, CAST(session_date AS DATE) AS session_date, indoor_outdoor, device, carry_method, ball_type FROM made_manifest) d
LEFT JOIN (SELECT source, count(*) AS shots FROM silver_shots GROUP BY source) n ON d.source = n.source""")
def dim_session(spark, folder):
    """The sessions of every source and day, with the number of the source's shots."""
    manifest = spark.sql(MANIFEST_SQL.replace("FROM events", "FROM {given}"), given=tables.read(spark, folder, "events"))
    counts = silver.silver_shots(tables.raw_sources(spark, folder)).groupBy("source").agg(F.count(F.lit(1)).alias("shots"))
    return lookup(dims.dim_session(manifest), counts, ["source"]).withColumn("shots", F.coalesce("shots", F.lit(0).cast("bigint")))
