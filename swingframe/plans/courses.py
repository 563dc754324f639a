"""Queries over course maps, course records and mapping proposals."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import geometry as G
from swingframe.operators import courses as B
from swingframe.operators import proposals as R
from swingframe.plans import tables
from swingframe.plans.bags import rounded
from swingframe.plans.registry import dround, query, relation
from swingframe.sources import courses as files
from swingframe.sources.seeds import values_sql

# ---- maps: holes and greens from supplier, other features from customer --
# A course is 12 suppliers and 180 customers, so courses grow with the tables.
ORIGIN = ("(30e0 + CAST(course_id % 50 AS DOUBLE) * 3e-1)", "(-100e0 + CAST(course_id % 97 AS DOUBLE) * 5e-1)")
SPOT_COLUMNS = ["course_id", "id",
                f"{ORIGIN[0]} + CAST((id * 7919) % 2000 AS DOUBLE) / 1e5 AS lat",
                f"{ORIGIN[1]} + CAST((id * 104729) % 2000 AS DOUBLE) / 1e5 AS lon"]
SUPPLIERS = ["(s_suppkey - s_suppkey % 12) / 12", "s_suppkey"]
LINE = [(0.0, 0.0), (0.0012, 0.0009), (0.0031, 0.0011)]
RING = [(-0.00012, -0.0001), (-0.00011, 0.00012), (0.00013, 0.00014), (0.00012, -0.00009), (0.0, -0.00015)]
BIG_RING = [(a * 1.5, b * 1.5) for a, b in RING]
GREEN_AT = (0.00305, 0.00118)
KINDS = ["bunker", "bunker", "bunker", "tee", "tee", "water", "water_hazard", "fairway", "path"]
relation("supplier_spots", "SELECT " + ", ".join(SPOT_COLUMNS) + " FROM (SELECT CAST((s_suppkey - s_suppkey % 12) / 12 AS BIGINT) AS course_id, s_suppkey AS id FROM supplier)")
relation("customer_spots", "SELECT " + ", ".join(SPOT_COLUMNS) + " FROM (SELECT CAST((c_custkey - c_custkey % 180) / 180 AS BIGINT) AS course_id, c_custkey AS id FROM customer)")


def _points(offsets, lat="lat", lon="lon"):
    cells = ", ".join(f"named_struct('lat', {lat} + {a!r}D, 'lon', {lon} + {b!r}D)" for a, b in offsets)
    return f"array({cells})"


def spots(spark, folder, table, key, size):
    return tables.read(spark, folder, table).selectExpr(
        f"CAST(({key} - {key} % {size}) / {size} AS BIGINT) AS course_id", f"{key} AS id").selectExpr(*SPOT_COLUMNS)


def elements(spark, folder):
    """Map elements in the shape an extract is read into."""
    none = "CAST(NULL AS array<struct<role:string,geometry:array<struct<lat:double,lon:double>>>>)"
    supplied = spots(spark, folder, "supplier", "s_suppkey", 12)
    holes = supplied.where("id % 2 = 0").selectExpr(
        "course_id", "id AS element_id", "'way' AS type",
        "map('golf', 'hole', 'ref', CAST(id % 12 + 1 AS STRING), 'par', CAST(3 + id % 3 AS STRING)) AS tags",
        f"{_points(LINE)} AS geometry", f"{none} AS members")
    greens = supplied.selectExpr(
        "course_id", "id + 1000000 AS element_id", "'way' AS type", "map('golf', 'green') AS tags",
        _points([(a + GREEN_AT[0], b + GREEN_AT[1]) for a, b in RING]) + " AS geometry", f"{none} AS members")
    kind = tables.pick("CAST(id % 9 AS INT)", KINDS)
    # Every fifth feature is a relation: an inner member, a small outer ring and a large one.
    members = (f"array(named_struct('role', 'inner', 'geometry', {_points(BIG_RING)}), "
               f"named_struct('role', 'outer', 'geometry', {_points(RING)}), "
               f"named_struct('role', 'outer', 'geometry', {_points(BIG_RING)}))")
    others = spots(spark, folder, "customer", "c_custkey", 180).selectExpr(
        "course_id", "id + 2000000 AS element_id", "CASE WHEN id % 5 = 0 THEN 'relation' ELSE 'way' END AS type",
        f"map('golf', {kind}) AS tags", f"CASE WHEN id % 5 <> 0 THEN {_points(RING)} END AS geometry",
        f"CASE WHEN id % 5 = 0 THEN {members} END AS members")
    return holes.unionByName(greens).unionByName(others)


def _rows(offsets):
    return values_sql(["ord", "dlat", "dlon"], [(i, float(a), float(b)) for i, (a, b) in enumerate(offsets)])


relation("hole_vertices", f"""SELECT s.course_id, CAST(s.id % 12 + 1 AS INT) AS ref, CAST(3 + s.id % 3 AS INT) AS par, o.ord, s.lat + o.dlat AS lat, s.lon + o.dlon AS lon
FROM supplier_spots s, ({_rows(LINE)}) o WHERE s.id % 2 = 0""")
relation("ring_points", f"""SELECT s.course_id, s.id + 1000000 AS element_id, 'green' AS golf, 0 AS ring, o.ord, s.lat + o.dlat AS lat, s.lon + o.dlon AS lon
FROM supplier_spots s, ({_rows([(a + GREEN_AT[0], b + GREEN_AT[1]) for a, b in RING])}) o
UNION ALL SELECT s.course_id, s.id + 2000000, {tables.pick('CAST(s.id % 9 AS INT)', KINDS)}, 0, o.ord, s.lat + o.dlat, s.lon + o.dlon FROM customer_spots s, ({_rows(RING)}) o
UNION ALL SELECT s.course_id, s.id + 2000000, {tables.pick('CAST(s.id % 9 AS INT)', KINDS)}, 1, o.ord, s.lat + o.dlat, s.lon + o.dlon FROM customer_spots s, ({_rows(BIG_RING)}) o WHERE s.id % 5 = 0""")
relation("main_rings", """SELECT * FROM ring_points WHERE golf <> 'path' AND (course_id, element_id, ring) IN (
  SELECT (course_id, element_id, arg_min(ring, (-area, ring))) FROM (SELECT course_id, element_id, ring,
    (max(lat) - min(lat)) * (max(lon) - min(lon)) AS area FROM ring_points GROUP BY ALL) GROUP BY course_id, element_id)""")
relation("centres", "SELECT course_id, element_id, golf, avg(lat) AS lat, avg(lon) AS lon FROM main_rings GROUP BY ALL")


def sql_metres(a: str, b: str) -> str:
    return (f"sqrt(pow(({a}.lat - {b}.lat) * 111320e0, 2) + "
            f"pow(({a}.lon - {b}.lon) * 111320e0 * cos(radians({a}.lat + {b}.lat) / 2), 2))")


@query("outer_rings", f"""SELECT course_id, element_id, golf, ring, count(*) AS points, {dround('(max(lat) - min(lat)) * 1e6', 4)} AS height
FROM ring_points WHERE golf <> 'path' GROUP BY ALL""")
def outer_rings(spark, folder):
    rings = B.ring_features(elements(spark, folder)).select(
        "course_id", "element_id", "golf", F.posexplode("rings").alias("ring", "r"))
    lats = F.transform("r", lambda p: p["lat"])
    height = (F.array_max(lats) - F.array_min(lats)) * 1e6
    return rings.select("course_id", "element_id", "golf", "ring", F.size("r").cast("bigint").alias("points"),
                        F.round(F.round(height, 10), 4).alias("height"))


@query("ring_centres", f"SELECT course_id, element_id, golf, {dround('lat', 8)} AS lat, {dround('lon', 8)} AS lon FROM centres")
def ring_centres(spark, folder):
    features = B.ring_features(elements(spark, folder))
    return rounded(features.select("course_id", "element_id", "golf", "centre.lat", "centre.lon"), ["lat", "lon"], 8)


@query("earth_distance", f"""SELECT a.element_id, b.course_id, {dround(sql_metres('a', 'b'), 3)} AS metres FROM centres a
JOIN (SELECT course_id, avg(lat) AS lat, avg(lon) AS lon FROM supplier_spots GROUP BY course_id) b ON a.course_id = b.course_id""")
def earth_distance(spark, folder):
    """Metres from each feature to the middle of its course."""
    features = B.ring_features(elements(spark, folder)).select("course_id", "element_id", "centre")
    middle = spots(spark, folder, "supplier", "s_suppkey", 12).groupBy("course_id").agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    metres = G.metres(F.col("centre.lat"), F.col("centre.lon"), F.col("lat"), F.col("lon"))
    return rounded(features.join(middle, "course_id").select("element_id", "course_id", metres.alias("metres")), ["metres"], 3)


relation("nearest_ref", f"""SELECT c.course_id, c.element_id, c.golf, arg_min(v.ref, (round({sql_metres('c', 'v')}, 6), v.ref)) AS ref
FROM centres c JOIN hole_vertices v ON c.course_id = v.course_id GROUP BY c.course_id, c.element_id, c.golf""")


@query("nearest_hole", "SELECT * FROM nearest_ref WHERE golf NOT IN ('green', 'fairway')")
def nearest_hole(spark, folder):
    mapped = elements(spark, folder)
    features = B.ring_features(mapped).where("golf NOT IN ('green', 'fairway')")
    return B.assign_to_holes(features, B.hole_lines(mapped)).select("course_id", "element_id", "golf", "ref")


@query("nearest_fairway", f"""SELECT v.course_id, v.ref, arg_min(c.element_id, (round({sql_metres('c', 'v')}, 6), c.element_id)) AS fairway_id
FROM hole_vertices v LEFT JOIN (SELECT * FROM centres WHERE golf = 'fairway') c ON c.course_id = v.course_id GROUP BY v.course_id, v.ref""")
def nearest_fairway(spark, folder):
    mapped = elements(spark, folder)
    return B.nearest_fairway(B.hole_lines(mapped), B.ring_features(mapped)).select("course_id", "ref", "fairway_id")


def framed(spark, folder):
    mapped = elements(spark, folder)
    lines, features = B.hole_lines(mapped), B.ring_features(mapped)
    return lines, features, B.hole_frames(lines, features, B.pair_greens(lines, features))


relation("hole_turns", "SELECT course_id, ref, row_number() OVER (PARTITION BY course_id ORDER BY ref) AS turn FROM (SELECT DISTINCT course_id, ref FROM hole_vertices)")
relation("hole_ends", f"""SELECT course_id, ref, CASE ord WHEN 0 THEN 0 ELSE 1 END AS "end", lat, lon FROM hole_vertices WHERE ord IN (0, {len(LINE) - 1})""")
_NEAR = f"""(round({sql_metres('c', 'e')}, 6), c.element_id, e."end")"""
relation("green_turns", f"""SELECT course_id, 0 AS turn, 0 AS ref, CAST(0 AS BIGINT) AS green_id, 0 AS "end", CAST([] AS BIGINT[]) AS taken FROM (SELECT DISTINCT course_id FROM hole_turns)
UNION ALL SELECT course_id, turn, ref, green_id, "end", list_append(taken, green_id) FROM (
  SELECT r.course_id, CAST(r.turn + 1 AS INT) AS turn, h.ref, arg_min(c.element_id, {_NEAR}) AS green_id, arg_min(e."end", {_NEAR}) AS "end", r.taken
  FROM green_turns r JOIN hole_turns h ON h.course_id = r.course_id AND h.turn = r.turn + 1 JOIN hole_ends e ON e.course_id = h.course_id AND e.ref = h.ref
  JOIN (SELECT * FROM centres WHERE golf = 'green') c ON c.course_id = h.course_id AND NOT list_contains(r.taken, c.element_id)
  GROUP BY r.course_id, r.turn, h.ref, r.taken)""")


@query("green_pairing", """SELECT t.course_id, t.ref, g.green_id, g."end" FROM hole_turns t LEFT JOIN green_turns g
  ON g.course_id = t.course_id AND g.ref = t.ref AND g.turn > 0""")
def green_pairing(spark, folder):
    """Greedy pairing in ref order; a hole that finds no free green has a null one."""
    mapped = elements(spark, folder)
    return B.pair_greens(B.hole_lines(mapped), B.ring_features(mapped))


# The SQL side of everything after the pairing starts from a fixed pairing: the hole's own green.
relation("own_greens", """SELECT h.course_id, CAST(h.id % 12 + 1 AS INT) AS ref, h.id + 1000000 AS green_id, 1 AS "end" FROM supplier_spots h WHERE h.id % 2 = 0""")
relation("paired_greens", """SELECT course_id, ref, green_id, "end" FROM green_turns WHERE turn > 0""")


def axes_sql(pairs: str) -> str:
    """The tee-to-pin frame of holes by a pairing: the tee is the end of the line that is not the green's."""
    return f"""SELECT course_id, ref, par, green_id, tlat, tlon, mlon, plat, plon, pe / sqrt(pe * pe + pn * pn) AS de, pn / sqrt(pe * pe + pn * pn) AS dn,
  sqrt(pe * pe + pn * pn) / 0.9144e0 AS pin_yards, (degrees(atan2(pe, pn)) % 360 + 360) % 360 AS bearing FROM (
  SELECT g.course_id, g.ref, t.par, g.green_id, t.lat AS tlat, t.lon AS tlon, c.lat AS plat, c.lon AS plon, 111320e0 * cos(radians(t.lat)) AS mlon,
    (c.lon - t.lon) * 111320e0 * cos(radians(t.lat)) AS pe, (c.lat - t.lat) * 111320e0 AS pn
  FROM {pairs} g JOIN centres c ON c.course_id = g.course_id AND c.element_id = g.green_id
  JOIN hole_vertices t ON t.course_id = g.course_id AND t.ref = g.ref AND t.ord = CASE g."end" WHEN 0 THEN {len(LINE) - 1} ELSE 0 END)"""


relation("axes", axes_sql("own_greens"))
relation("paired_axes", axes_sql("paired_greens"))


def sql_project(a: str, lat: str, lon: str) -> tuple[str, str]:
    e, n = f"(({lon} - {a}.tlon) * {a}.mlon)", f"(({lat} - {a}.tlat) * 111320e0)"
    return (dround(f"({e} * {a}.de + {n} * {a}.dn) / 0.9144e0", 1), dround(f"({e} * {a}.dn - {n} * {a}.de) / 0.9144e0", 1))


def own_frames(spark, folder):
    mapped = elements(spark, folder)
    lines, features = B.hole_lines(mapped), B.ring_features(mapped)
    pairs = spots(spark, folder, "supplier", "s_suppkey", 12).where("id % 2 = 0").selectExpr(
        "course_id", "CAST(id % 12 + 1 AS INT) AS ref", "id + 1000000 AS green_id", "1 AS end")
    return lines, features, B.hole_frames(lines, features, pairs)


@query("hole_frames", f"""SELECT course_id, ref, par, green_id, {dround('pin_yards', 1)} AS pin_distance_yards, {dround('bearing', 1)} AS bearing_deg FROM axes""")
def hole_frames(spark, folder):
    frames = own_frames(spark, folder)[2]
    return frames.select("course_id", "ref", "par", "green_id", F.round("frame.pin_yards", 1).alias("pin_distance_yards"),
                         F.round("frame.bearing", 1).alias("bearing_deg"))


_X, _Y = sql_project("a", "p.lat", "p.lon")


@query("projected_rings", f"""SELECT n.course_id, n.ref, n.element_id, p.ord, {_X} AS downrange, {_Y} AS "lateral"
FROM nearest_ref n JOIN axes a ON a.course_id = n.course_id AND a.ref = n.ref
JOIN main_rings p ON p.course_id = n.course_id AND p.element_id = n.element_id WHERE n.golf IN ('bunker', 'water', 'water_hazard')""")
def projected_rings(spark, folder):
    lines, features, frames = own_frames(spark, folder)
    own = B.assign_to_holes(features.where("golf IN ('bunker', 'water', 'water_hazard')"), lines)
    rings = own.join(frames.select("course_id", "ref", "frame"), ["course_id", "ref"]).select(
        "course_id", "ref", "element_id", F.posexplode(B.project_ring(F.col("frame"), F.col("ring"))).alias("ord", "p"))
    return rings.select("course_id", "ref", "element_id", "ord", F.col("p")[0].alias("downrange"), F.col("p")[1].alias("lateral"))


_TX, _TY = sql_project("a", "c.lat", "c.lon")


@query("tee_boxes", f"""SELECT course_id, ref, element_id, x AS downrange, y AS "lateral", {dround('yards', 1)} AS yards,
  CAST(row_number() OVER (PARTITION BY course_id, ref ORDER BY yards DESC, element_id) AS INT) AS place FROM (
  SELECT *, sqrt(pow(pin_yards - x, 2) + pow(y, 2)) AS yards FROM (
    SELECT n.course_id, n.ref, n.element_id, a.pin_yards, {_TX} AS x, {_TY} AS y FROM nearest_ref n JOIN axes a ON a.course_id = n.course_id AND a.ref = n.ref
    JOIN centres c ON c.course_id = n.course_id AND c.element_id = n.element_id WHERE n.golf = 'tee'))
WHERE x BETWEEN -25 AND 0.45e0 * pin_yards AND abs(y) <= 45 AND yards >= 70""")
def tee_boxes(spark, folder):
    lines, features, frames = own_frames(spark, folder)
    return B.tee_boxes(frames, B.assign_to_holes(features.where("golf = 'tee'"), lines))


# ---- ground -------------------------------------------------------------
relation("steps", f"""SELECT a.course_id, a.ref, a.ord, a.lat, a.lon, b.lat AS lat2, b.lon AS lon2, {sql_metres('a', 'b')} AS len FROM hole_vertices a
JOIN hole_vertices b ON b.course_id = a.course_id AND b.ref = a.ref AND b.ord = a.ord + 1""")
relation("walked", """SELECT *, sum(len) OVER w - len AS before, sum(len) OVER w AS upto, sum(len) OVER (PARTITION BY course_id, ref) AS total FROM steps
WINDOW w AS (PARTITION BY course_id, ref ORDER BY ord ROWS UNBOUNDED PRECEDING)""")
relation("resampled", """SELECT course_id, ref, CAST(k AS INT) AS k, arg_min(lat + (total * k / 5e0 - before) / len * (lat2 - lat), ord) AS lat,
  arg_min(lon + (total * k / 5e0 - before) / len * (lon2 - lon), ord) AS lon
FROM walked, range(6) t(k) WHERE upto >= total * k / 5e0 - 1e-9 GROUP BY course_id, ref, k""")


@query("resampled_lines", f"SELECT course_id, ref, k, {dround('lat', 8)} AS lat, {dround('lon', 8)} AS lon FROM resampled")
def resampled_lines(spark, folder):
    lines = B.hole_lines(elements(spark, folder))
    return rounded(lines.select("course_id", "ref", F.inline(B.resample_line(F.col("line"), 6))), ["lat", "lon"], 8)


relation("ground_samples", f"""SELECT s.course_id, s.ref, s.ord, s.lat, s.lon, s.ord * 1.7e0 + s.ref AS metres FROM (
  SELECT course_id, ref, 0 AS ord, lat, lon FROM hole_vertices WHERE ord = 0
  UNION ALL SELECT course_id, ref, k + 1, lat, lon FROM resampled) s""")
_SX, _SY = sql_project("a", "s.lat", "s.lon")


@query("elevation_profile", f"""SELECT course_id, ref, downrange, arg_max(height, ord) AS height FROM (
  SELECT s.course_id, s.ref, s.ord, CAST(round_even({_SX}, 0) AS INT) AS downrange, {dround('(s.metres - t.metres) / 0.9144e0', 1)} AS height
  FROM ground_samples s JOIN ground_samples t ON t.course_id = s.course_id AND t.ref = s.ref AND t.ord = 0
  JOIN axes a ON a.course_id = s.course_id AND a.ref = s.ref) GROUP BY course_id, ref, downrange""")
def elevation_profile(spark, folder):
    lines, _, frames = own_frames(spark, folder)
    places = F.concat(
        F.array(F.struct(F.lit(0).alias("ord"), F.col("line")[0]["lat"].alias("lat"), F.col("line")[0]["lon"].alias("lon"))),
        F.transform(B.resample_line(F.col("line"), 6), lambda p: F.struct(
            (p["k"] + 1).alias("ord"), p["lat"].alias("lat"), p["lon"].alias("lon"))))
    samples = lines.select("course_id", "ref", F.inline(places)).withColumn("metres", F.col("ord") * 1.7 + F.col("ref"))
    return B.elevation_profile(frames, samples)


@query("green_planes", f"""SELECT course_id, ref, n, CASE WHEN n >= 4 THEN {dround('(xz * yy - yz * xy) / (xx * yy - xy * xy)', 4)} ELSE 0 END AS slope_x,
  CASE WHEN n >= 4 THEN {dround('(yz * xx - xz * xy) / (xx * yy - xy * xy)', 4)} ELSE 0 END AS slope_y FROM (
  SELECT course_id, ref, count(z) AS n, var_samp(x) AS xx, var_samp(y) AS yy, covar_samp(x, y) AS xy, covar_samp(x, z) AS xz, covar_samp(y, z) AS yz
  FROM (SELECT s.course_id, s.ref, {_SX} AS x, {_SY} AS y, (s.a * 0.31e0 + s.b * 0.17e0 + s.a * s.b * 0.05e0 + s.ref) / 0.9144e0 AS z
        FROM green_lattice s JOIN axes a ON a.course_id = s.course_id AND a.ref = s.ref) GROUP BY course_id, ref)""")
def green_planes(spark, folder):
    samples = B.green_samples(own_frames(spark, folder)[2])
    metres = F.col("a") * 0.31 + F.col("b") * 0.17 + F.col("a") * F.col("b") * 0.05 + F.col("ref")
    return B.green_planes(samples.withColumn("metres", metres))


def green_edges_sql(pairs: str) -> str:
    return f"""SELECT g.course_id, g.ref, p.lon AS x0, p.lat AS y0, q.lon AS x1, q.lat AS y1 FROM {pairs} g
JOIN main_rings p ON p.course_id = g.course_id AND p.element_id = g.green_id
JOIN main_rings q ON q.course_id = g.course_id AND q.element_id = g.green_id AND q.ord = (p.ord + 1) % 5"""


def lattice_sql(edges: str) -> str:
    return f"""SELECT s.course_id, s.ref, s.a, s.b, s.lat, s.lon FROM (
  SELECT course_id, ref, CAST(a AS INT) AS a, CAST(b AS INT) AS b, x0 + (a + 0.5e0) / 4e0 * (x1 - x0) AS lon, y0 + (b + 0.5e0) / 4e0 * (y1 - y0) AS lat FROM (
    SELECT course_id, ref, min(x0) AS x0, max(x0) AS x1, min(y0) AS y0, max(y0) AS y1 FROM {edges} GROUP BY course_id, ref), range(4) i(a), range(4) j(b)) s
JOIN {edges} e ON e.course_id = s.course_id AND e.ref = s.ref AND ((e.y0 > s.lat) <> (e.y1 > s.lat))
  AND s.lon < (e.x1 - e.x0) * (s.lat - e.y0) / (e.y1 - e.y0) + e.x0 GROUP BY ALL HAVING count(*) % 2 = 1"""


relation("green_edges", green_edges_sql("own_greens"))
relation("green_lattice", lattice_sql("green_edges"))
relation("paired_edges", green_edges_sql("paired_greens"))
relation("paired_lattice", lattice_sql("paired_edges"))


# ---- records ------------------------------------------------------------
def terrain(spark, folder):
    """The ground of every course, from its suppliers: a middle and its height in metres, and the rise
    in metres a degree to the north and east."""
    ground = tables.read(spark, folder, "supplier").selectExpr(
        "CAST((s_suppkey - s_suppkey % 12) / 12 AS BIGINT) AS course_id", "s_suppkey AS id", "CAST(s_acctbal AS DOUBLE) AS balance")
    return ground.groupBy("course_id").agg(
        (F.max("balance") / 50).alias("middle"), F.round(F.avg("balance")).alias("north"),
        (F.min(F.col("id") % 7 * 500) - 1000.0).alias("east")).selectExpr(
        "course_id", f"{ORIGIN[0]} AS lat0", f"{ORIGIN[1]} AS lon0", "middle", "north", "east")


def records(spark, folder):
    ground = terrain(spark, folder)

    def heights(places):
        metres = F.col("middle") + (F.col("lat") - F.col("lat0")) * F.col("north") + (F.col("lon") - F.col("lon0")) * F.col("east")
        return places.join(ground, "course_id", "left").select(*places.columns, metres.alias("metres"))

    return B.build_course(elements(spark, folder), heights)


relation("terrain", f"""SELECT course_id, {ORIGIN[0]} AS lat0, {ORIGIN[1]} AS lon0, middle, north, east FROM (
  SELECT CAST((s_suppkey - s_suppkey % 12) / 12 AS BIGINT) AS course_id, max(CAST(s_acctbal AS DOUBLE)) / 50 AS middle,
    round(avg(CAST(s_acctbal AS DOUBLE))) AS north, min(s_suppkey % 7 * 500) - 1000e0 AS east FROM supplier GROUP BY 1)""")
_METRES = "(t.middle + (s.lat - t.lat0) * t.north + (s.lon - t.lon0) * t.east)"
relation("record_ground", f"""SELECT s.course_id, s.ref, s.ord, s.lat, s.lon, {_METRES} AS metres FROM (
  SELECT course_id, ref, 0 AS ord, tlat AS lat, tlon AS lon FROM paired_axes UNION ALL SELECT course_id, ref, k + 1, lat, lon FROM resampled
  UNION ALL SELECT course_id, ref, 7, plat, plon FROM paired_axes) s JOIN terrain t ON t.course_id = s.course_id""")
relation("record_profile", f"""SELECT course_id, ref, downrange, arg_max(height, ord) AS height FROM (
  SELECT s.course_id, s.ref, s.ord, CAST(round_even({_SX}, 0) AS INT) AS downrange, {dround('(s.metres - b.metres) / 0.9144e0', 1)} AS height
  FROM record_ground s JOIN record_ground b ON b.course_id = s.course_id AND b.ref = s.ref AND b.ord = 0
  JOIN paired_axes a ON a.course_id = s.course_id AND a.ref = s.ref) GROUP BY course_id, ref, downrange""")
relation("record_slopes", f"""SELECT course_id, ref, CASE WHEN n >= 4 AND abs(xx * yy - xy * xy) > 1e-12 THEN {dround('(xz * yy - yz * xy) / (xx * yy - xy * xy)', 4)} ELSE 0 END AS x,
  CASE WHEN n >= 4 AND abs(xx * yy - xy * xy) > 1e-12 THEN {dround('(yz * xx - xz * xy) / (xx * yy - xy * xy)', 4)} ELSE 0 END AS y FROM (
  SELECT course_id, ref, count(z) AS n, var_samp(x) AS xx, var_samp(y) AS yy, covar_samp(x, y) AS xy, covar_samp(x, z) AS xz, covar_samp(y, z) AS yz
  FROM (SELECT s.course_id, s.ref, {_SX} AS x, {_SY} AS y, {_METRES} / 0.9144e0 AS z
        FROM paired_lattice s JOIN paired_axes a ON a.course_id = s.course_id AND a.ref = s.ref JOIN terrain t ON t.course_id = s.course_id) GROUP BY course_id, ref)""")
relation("record_tees", f"""SELECT course_id, ref, x, y, {dround('yards', 1)} AS yards, row_number() OVER (PARTITION BY course_id, ref ORDER BY yards DESC, element_id) - 1 AS ord FROM (
  SELECT *, sqrt(pow(pin_yards - x, 2) + pow(y, 2)) AS yards FROM (
    SELECT n.course_id, n.ref, n.element_id, a.pin_yards, {_TX} AS x, {_TY} AS y FROM nearest_ref n JOIN paired_axes a ON a.course_id = n.course_id AND a.ref = n.ref
    JOIN centres c ON c.course_id = n.course_id AND c.element_id = n.element_id WHERE n.golf = 'tee'))
WHERE x BETWEEN -25 AND 0.45e0 * pin_yards AND abs(y) <= 45 AND yards >= 70""")
relation("record_fairways", f"""SELECT v.course_id, v.ref, arg_min(c.element_id, (round({sql_metres('c', 'v')}, 6), c.element_id)) AS element_id
FROM hole_vertices v JOIN centres c ON c.course_id = v.course_id AND c.golf = 'fairway' GROUP BY v.course_id, v.ref""")
_PART = "SELECT n.course_id, n.ref, {part} AS part, {ring} AS ring, p.ord, " + f"{_X} AS x, {_Y} AS y" + """
FROM {rings} n JOIN paired_axes a ON a.course_id = n.course_id AND a.ref = n.ref JOIN main_rings p ON p.course_id = n.course_id AND p.element_id = n.element_id"""
_HAZARDS = """(SELECT course_id, ref, element_id, CASE golf WHEN 'bunker' THEN 'bunker' ELSE 'water' END AS part,
  row_number() OVER (PARTITION BY course_id, ref, golf = 'bunker' ORDER BY element_id) - 1 AS nth FROM nearest_ref WHERE golf IN ('bunker', 'water', 'water_hazard'))"""
_ONE = "CAST(NULL AS DOUBLE)"
relation("record_parts", " UNION ALL ".join([
    f"SELECT course_id, ref, 'par' AS part, 0 AS ring, 0 AS ord, CAST(par AS DOUBLE) AS x, {_ONE} AS y FROM (SELECT DISTINCT course_id, ref, par FROM hole_vertices)",
    f"SELECT course_id, ref, 'frame', 0, 0, {dround('pin_yards', 1)}, {dround('bearing', 1)} FROM paired_axes",
    "SELECT h.course_id, h.ref, 'slope', 0, 0, coalesce(s.x, 0), coalesce(s.y, 0) FROM paired_axes h LEFT JOIN record_slopes s ON s.course_id = h.course_id AND s.ref = h.ref",
    "SELECT course_id, ref, 'elevation', 0, row_number() OVER (PARTITION BY course_id, ref ORDER BY downrange) - 1, CAST(downrange AS DOUBLE), height FROM record_profile",
    "SELECT course_id, ref, 'tee', 0, ord, x, y FROM record_tees", f"SELECT course_id, ref, 'tee yards', 0, ord, yards, {_ONE} FROM record_tees",
    _PART.format(part="'green'", ring=0, rings="(SELECT course_id, ref, green_id AS element_id FROM paired_greens)"),
    _PART.format(part="'fairway'", ring=0, rings="record_fairways"), _PART.format(part="n.part", ring="n.nth", rings=_HAZARDS)]))
_FLAT = "part, CAST(ring AS INT) AS ring, CAST(ord AS INT) AS ord, x, y FROM record_parts"


@query("hole_records", f"SELECT course_id, ref, {_FLAT}")
def hole_records(spark, folder):
    """Nested hole records of every course, from map elements and the ground, as flat rows."""
    return B.record_rows(records(spark, folder), ["course_id", "ref"])


@query("course_files", f"SELECT CAST(course_id AS VARCHAR) AS name, CAST(course_id AS VARCHAR) AS slug, ref, {_FLAT}")
def course_files(spark, folder):
    """Hole records gathered per course, as the course files hold them, as flat rows."""
    gathered = files.course_records(records(spark, folder))
    return B.record_rows(gathered.select("name", "slug", F.inline("holes")), ["name", "slug", "ref"])


# ---- mapping proposals --------------------------------------------------
HEADERS = {"Club": "club", "Ball Speed": "ball_speed_mph", "Carry": "carry_yards", "Spin": None, "Note": None}
relation("header_columns", "SELECT s.source AS source_name, h.source_column FROM (SELECT DISTINCT source FROM documents) s, (VALUES "
         + ", ".join(f"('{h}')" for h in HEADERS) + ") h(source_column)")


def _mapping(field: str, column: str, confidence: str) -> str:
    return json.dumps({"common_field": field, "source_column": column, "unit_conversion": "none",
                       "confidence": 0.5, "notes": ""}).replace("0.5", confidence)


PROPOSAL = ("concat('{\"source_name\": \"', source, '\", \"mappings\": [" + _mapping("club", "Club", "0.95") + "', "
            "CASE WHEN doc_id % 3 = 0 THEN ', " + _mapping("ball_speed_mph", "Ball Speed", "0.9") + "' ELSE '' END, "
            "CASE WHEN doc_id % 4 = 0 THEN ', " + _mapping("carry_yards", "Carry", "0.8") + "' ELSE ', "
            + _mapping("carry_yards", "", "0.1") + "' END, "
            "CASE WHEN doc_id % 10 = 9 THEN '] oops' ELSE '], \"unmapped_source_columns\": [], \"missing_common_fields\": [], \"overall_notes\": \"\"}' END)")
relation("proposal_rows", """SELECT doc_id AS proposal_id, source AS source_name, m.field AS common_field, nullif(m.col, '') AS source_column, m.confidence
FROM (SELECT * FROM documents WHERE doc_id % 10 <> 9) d, LATERAL (
  SELECT 'club' AS field, 'Club' AS col, 0.95e0 AS confidence
  UNION ALL SELECT 'ball_speed_mph', 'Ball Speed', 0.9e0 WHERE d.doc_id % 3 = 0
  UNION ALL SELECT 'carry_yards', CASE WHEN d.doc_id % 4 = 0 THEN 'Carry' ELSE '' END, CASE WHEN d.doc_id % 4 = 0 THEN 0.8e0 ELSE 0.1e0 END) m""")
FIELD_LIST = ", ".join(f"('{f}')" for f in K.MAPPABLE_FIELDS)


@query("mapping_review", f"""SELECT proposal_id, source_name, 'mapping' AS item, common_field, source_column, confidence FROM proposal_rows
UNION ALL SELECT d.doc_id, d.source, 'missing field', f.field, NULL, NULL FROM documents d, (VALUES {FIELD_LIST}) f(field)
WHERE d.doc_id % 10 <> 9 AND NOT EXISTS (SELECT 1 FROM proposal_rows p WHERE p.proposal_id = d.doc_id AND p.common_field = f.field AND p.source_column IS NOT NULL)
UNION ALL SELECT d.doc_id, d.source, 'unused column', NULL, h.source_column, NULL FROM documents d JOIN header_columns h ON h.source_name = d.source
WHERE d.doc_id % 10 <> 9 AND NOT EXISTS (SELECT 1 FROM proposal_rows p WHERE p.proposal_id = d.doc_id AND p.source_column = h.source_column)
UNION ALL SELECT d.doc_id, NULL, 'unparsed', NULL, NULL, NULL FROM documents d WHERE d.doc_id % 10 = 9""")
def mapping_review(spark, folder):
    documents = tables.read(spark, folder, "documents")
    texts = documents.selectExpr("doc_id AS proposal_id", f"{PROPOSAL} AS text")
    headers = documents.select(F.col("source").alias("source_name")).distinct().select(
        "source_name", F.explode(F.array(*map(F.lit, HEADERS))).alias("source_column"))
    return R.ordered_review(R.review(R.parse_proposals(texts, "text"), headers))
