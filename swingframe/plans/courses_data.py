"""Invented holes that the strategy queries play, in both engines' terms."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swingframe.operators import holes as H
from swingframe.plans.registry import relation
from swingframe.sources.seeds import values_sql

# ---- parametric holes ---------------------------------------------------
HOLE_COLUMNS = ["hole_id", "pin_distance", "green_radius", "half_width", "green_difficulty"]
HOLES = [("pond", 150.0, 6.0, 16.0, 0.0), ("front", 184.0, 7.0, 14.0, 0.3)]
REGION_COLUMNS = ["hole_id", "region_id", "ord", "kind", "near", "far", "left", "right",
                  "penalty_strokes", "drop_distance"]
REGIONS = [
    ("pond", "pond-w", 0, "water", 135.0, 165.0, 6.0, 45.0, 1.0, None),
    ("pond", "pond-s", 1, "sand", 138.0, 156.0, -32.0, -11.0, 1.0, None),
    ("pond", "pond-o", 2, "ob", 150.0, 190.0, 20.0, 60.0, 2.0, 120.0),
    ("front", "front-w", 0, "water", 150.0, 172.0, -40.0, 40.0, 1.0, 140.0),
    ("front", "front-s", 1, "sand", 186.0, 196.0, -12.0, 2.0, 1.0, None),
]
relation("holes", values_sql(HOLE_COLUMNS, HOLES))
relation("hole_regions", 'SELECT hole_id, region_id, kind, near, far, "left", "right", penalty_strokes, CAST(drop_distance AS DOUBLE) AS drop_distance, ord FROM ('
         + values_sql([f'"{c}"' for c in REGION_COLUMNS], REGIONS) + ")")


def regions(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql([f"`{c}`" for c in REGION_COLUMNS], REGIONS)).withColumn(
        "drop_distance", F.col("drop_distance").cast("double"))


def parametric_holes(spark: SparkSession) -> DataFrame:
    return H.lay_regions(spark.sql(values_sql(HOLE_COLUMNS, HOLES)), regions(spark))


# ---- polygon holes ------------------------------------------------------
COURSE = {
    "P1": {
        "ref": 1, "par": 3, "pin_distance_yards": 160.0, "bearing_deg": 40.0,
        "green": [[148.03, -11.02], [170.04, -12.07], [173.01, 9.03], [151.06, 12.52]],
        "fairway": [[[60.01, -15.03], [140.02, -16.04], [142.07, 14.01], [58.03, 13.06]]],
        "bunkers": [[[150.02, 14.03], [162.07, 14.08], [160.06, 22.02], [149.04, 21.01]],
                    [[140.01, -24.02], [147.03, -23.04], [146.08, -13.06]]],
        "water": [[[152.04, -30.02], [172.06, -28.01], [170.03, -14.07], [150.08, -15.04]]],
        "playable": [[[-20.01, -45.02], [200.03, -45.07], [200.08, 45.01], [-20.06, 45.04]]],
        "green_slope": [0.02, -0.012], "green_difficulty": 0.4,
        "green_quad": [0.1, 0.02, -0.012, 0.0004, 0.0002, -0.0003],
        "elevation": [[0.0, 0.0], [80.0, 4.0], [160.0, 10.5]],
        "tees": [[0.0, 0.0, 160.0], [12.5, -3.0, 147.5], [30.0, 2.0, 130.0], [41.0, 0.0, 119.0]],
    },
    "P2": {
        "ref": 2, "par": 4, "pin_distance_yards": 208.0, "bearing_deg": 275.0,
        "green": [[196.02, -10.04], [221.07, -8.03], [219.01, 13.06], [205.08, 15.02], [195.03, 6.07]],
        "fairway": [[[80.04, -18.01], [190.06, -17.02], [188.02, 18.05], [82.07, 17.03]],
                    [[20.01, -12.02], [70.03, -11.04], [72.06, 12.08], [19.05, 11.01]]],
        "bunkers": [], "water": [], "playable": [],
        "green_slope": [-0.015, 0.008], "green_difficulty": 0.0, "green_quad": [],
        "elevation": [], "tees": [],
    },
}


def _rows() -> list[dict]:
    rows = []
    for hole, h in COURSE.items():
        rows.append({
            "course_id": "home", "hole_id": hole, "ref": h["ref"], "par": h["par"],
            "pin_distance": h["pin_distance_yards"], "bearing_deg": h["bearing_deg"],
            "green": h["green"], "fairway": h["fairway"], "bunkers": h["bunkers"], "water": h["water"],
            "playable": h["playable"], "green_slope": h["green_slope"], "green_quad": h["green_quad"],
            "green_difficulty": h["green_difficulty"], "elevation": h["elevation"],
        })
    return rows


ROW_DDL = (
    "course_id string, hole_id string, ref int, par int, pin_distance double, bearing_deg double, "
    "green array<array<double>>, fairway array<array<array<double>>>, bunkers array<array<array<double>>>, "
    "water array<array<array<double>>>, playable array<array<array<double>>>, green_slope array<double>, "
    "green_quad array<double>, green_difficulty double, elevation array<array<double>>"
)


def mapped_holes(spark: SparkSession) -> DataFrame:
    text = json.dumps(_rows()).replace("'", "")
    return spark.sql(f"SELECT inline(from_json('{text}', 'array<struct<{_struct(ROW_DDL)}>>'))")


def polygon_holes(spark: SparkSession) -> DataFrame:
    return H.prepare_course(mapped_holes(spark))


def _struct(ddl: str) -> str:
    return ", ".join(f"{part.split(' ', 1)[0]}:{part.split(' ', 1)[1]}" for part in ddl.split(", "))


TEE_ROWS = [(hole, *map(float, t)) for hole, h in COURSE.items() for t in h["tees"]]
TEE_COLUMNS = ["hole_id", "downrange", "lateral", "yards"]
relation("tees", values_sql([f'"{c}"' for c in TEE_COLUMNS], TEE_ROWS))
relation("course_heads", values_sql(
    ["hole_id", "ref", "par", "pin_distance", "bearing_deg", "slope_x", "slope_y", "difficulty"],
    [(hole, h["ref"], h["par"], h["pin_distance_yards"], h["bearing_deg"], *h["green_slope"],
      h["green_difficulty"]) for hole, h in COURSE.items()]))
relation("course_edges", values_sql(
    ["hole_id", "layer", "ring", "x0", "y0", "x1", "y1"],
    [(hole, name, i, *ring[j], *ring[(j + 1) % len(ring)])
     for hole, h in COURSE.items() for name in H.LAYERS
     for i, ring in enumerate([h[name]] if name == "green" else h[name]) for j in range(len(ring))]))
relation("green_centres", """SELECT hole_id, sum((x0 + x1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)) AS cx,
  sum((y0 + y1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)) AS cy
FROM course_edges WHERE layer = 'green' GROUP BY hole_id""")
relation("course", "SELECT h.*, c.cx, c.cy FROM course_heads h JOIN green_centres c ON h.hole_id = c.hole_id")


# The same membership spelled out per hole for the SQL side.
def _in_ring(ring: list[list[float]], x: str, y: str) -> str:
    tests = []
    for j, (x0, y0) in enumerate(ring):
        x1, y1 = ring[(j + 1) % len(ring)]
        tests.append(f"CAST((({y0}e0 > {y}) <> ({y1}e0 > {y})) AND {x} < ({x1}e0 - {x0}e0) * ({y} - {y0}e0)"
                     f" / ({y1}e0 - {y0}e0) + {x0}e0 AS INT)".replace("--", "+"))
    return "((" + " + ".join(tests) + ") % 2 = 1)"


def sql_in_layer(name: str, x: str, y: str, hole: str = "hole_id") -> str:
    parts = []
    for h, shape in COURSE.items():
        rings = [shape[name]] if name == "green" else shape[name]
        inside = " OR ".join(_in_ring(r, x, y) for r in rings) or "false"
        parts.append(f"WHEN {hole} = '{h}' THEN ({inside})")
    return "(CASE " + " ".join(parts) + " END)"


def sql_lie(x: str, y: str, hole: str = "hole_id") -> str:
    corridor = ", ".join(f"'{h}'" for h, shape in COURSE.items() if shape["playable"])
    return (f"CASE WHEN {sql_in_layer('green', x, y, hole)} THEN 'green' "
            f"WHEN {sql_in_layer('bunkers', x, y, hole)} THEN 'sand' "
            f"WHEN {sql_in_layer('fairway', x, y, hole)} THEN 'fairway' "
            f"WHEN {hole} IN ({corridor}) AND NOT {sql_in_layer('playable', x, y, hole)} THEN 'recovery' "
            f"ELSE 'rough' END")


def tees(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(TEE_COLUMNS, TEE_ROWS))
