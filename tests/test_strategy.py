import numpy as np
import pytest
from pyspark.sql import functions as F

from swingframe.operators import holes as H
from swingframe.operators import strategy as ST

REGIONS = "hole_id string, region_id string, ord int, kind string, near double, far double, left double, right double, penalty_strokes double, drop_distance double"


def _hole(spark, regions=(), pin=150.0, radius=6.0, half=16.0):
    holes = spark.createDataFrame([("h", pin, radius, half, 0.0)], "hole_id string, pin_distance double, green_radius double, half_width double, green_difficulty double")
    rows = [("h", f"r{i}", i, *r) for i, r in enumerate(regions)]
    return H.lay_regions(holes, spark.createDataFrame(rows, REGIONS))


def _cloud(spark, clubs, n=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for club, mean, sc, sl in clubs:
        rows += [("b", club, float(c), float(x), i) for i, (c, x) in enumerate(zip(rng.normal(mean, sc, n), rng.normal(0, sl, n)))]
    return spark.createDataFrame(rows, "bag_id string, club string, carry double, lateral double, ord bigint")


def _ask(spark):
    return spark.createDataFrame([("b", "h")], "bag_id string, hole_id string")


def test_safe_hole_is_aimed_at_the_pin_and_clubs_are_ranked(spark):
    clouds = _cloud(spark, [("7i", 150, 5, 5), ("5i", 172, 9, 9)])
    rows = ST.optimize_shots(clouds, _ask(spark), _hole(spark)).orderBy("place").collect()
    best = rows[0]
    assert best.club == "7i" and abs(best.aim_distance - 150) <= 3.5 and abs(best.aim_lateral) <= 3.5
    assert [r.expected_strokes for r in rows] == sorted(r.expected_strokes for r in rows)


def test_pond_on_the_right_pushes_the_aim_left(spark):
    clouds = _cloud(spark, [("7i", 150, 6, 11)])
    hole = _hole(spark, [("water", 135.0, 165.0, 6.0, 45.0, 1.0, None)])
    row = ST.naive_against_best(clouds, _ask(spark), hole).first()
    assert row.aim_lateral < 0 and row.saved >= 0 and row.naive_penalty > 0


def test_evaluation_equals_a_plain_loop(spark):
    clouds = _cloud(spark, [("7i", 150, 10, 9)], n=200)
    boxes = [("water", 120.0, 144.0, -40.0, 5.0, 1.0, None), ("ob", 140.0, 150.0, -5.0, 5.0, 2.0, 100.0), ("sand", 150.0, 160.0, -9.0, 9.0, 1.0, None)]
    hole = _hole(spark, boxes)
    cells = ST.on_holes(ST.cloud_cells(clouds), _ask(spark), hole).withColumns({"aim": F.lit(0), "aim_distance": F.lit(147.0), "aim_lateral": F.lit(2.0)})
    got = ST.evaluate_aims(cells).first()
    from swingframe import constants as K
    pts = [(r.carry, r.lateral) for r in clouds.collect()]
    mc, ml = np.mean([p[0] for p in pts]), np.mean([p[1] for p in pts])
    fair = lambda d: np.interp(d, K.CURVE_YARDS, K.CURVE_STROKES["fairway"])
    costs, wet, green, prox = [], 0, 0, []
    for c, l in pts:
        x, y = c - mc + 147, l - ml + 2
        d = np.hypot(150 - x, y)
        inside = lambda b: b[1] <= x <= b[2] and b[3] <= y <= b[4]
        if inside(boxes[1]) or inside(boxes[0]):
            wet += 1
            costs.append(2 + fair(50) if inside(boxes[1]) else 1 + fair(30))
            continue
        prox.append(d)
        lie = "sand" if inside(boxes[2]) else "green" if d <= 6 else "fairway" if abs(y) <= 16 else "rough"
        green += lie == "green"
        costs.append(np.interp(d * 3, K.PUTT_FEET, K.PUTT_STROKES) if lie == "green" else np.interp(d, K.CURVE_YARDS, K.CURVE_STROKES[lie]))
    assert np.allclose([got.expected_strokes, got.penalty_pct, got.frac_on_green, got.mean_proximity_yards],
                       [1 + np.mean(costs), wet / 200, green / 200, np.mean(prox)])


COURSE = ("hole_id string, pin_distance double, green array<array<double>>, fairway array<array<array<double>>>, bunkers array<array<array<double>>>, "
          "water array<array<array<double>>>, playable array<array<array<double>>>, green_slope array<double>, green_quad array<double>, green_difficulty double, elevation array<array<double>>")
GREEN = [[380.0, -12.0], [410.0, -12.0], [410.0, 12.0], [380.0, 12.0]]


def _green(spark, water=(), playable=(), slope=(0.0, 0.0)):
    row = ("g", 395.0, GREEN, [], [], list(water), list(playable), list(slope), [], 0.0, [])
    return H.prepare_course(spark.createDataFrame([row], COURSE))


def test_polygon_lies(spark):
    hole = _green(spark, water=[[[384.0, -30.0], [406.0, -30.0], [406.0, -12.0], [384.0, -12.0]]], playable=[[[0.0, -40.0], [430.0, -40.0], [430.0, 40.0], [0.0, 40.0]]])
    pts = spark.createDataFrame([("g", 395.0, 0.0), ("g", 395.0, -20.0), ("g", 200.0, 60.0), ("g", 200.0, 5.0)], "hole_id string, x double, y double")
    got = {(r.x, r.y): (r.lie, r.in_penalty) for r in H.classify_polygon(pts, hole).collect()}
    assert got == {(395.0, 0.0): ("green", False), (395.0, -20.0): ("rough", True),
                   (200.0, 60.0): ("recovery", False), (200.0, 5.0): ("rough", False)}


def test_pins_are_clamped_onto_the_green(spark):
    pins = spark.createDataFrame([("g", 395.0, 0.0), ("g", 380.0, -12.0), ("g", 500.0, 0.0)], "hole_id string, pin_x double, pin_y double")
    got = {(r.pin_x, r.pin_y): (r.clamped_x, r.clamped_y) for r in ST.clamp_pins(pins, _green(spark)).collect()}
    assert got == {(395.0, 0.0): (395.0, 0.0), (380.0, -12.0): (383.0, -9.0), (500.0, 0.0): (407.0, 0.0)}


def test_short_sided_flags_play_harder(spark):
    hole = _green(spark, water=[[[384.0, -30.0], [406.0, -30.0], [406.0, -12.0], [384.0, -12.0]]])
    ask = spark.createDataFrame([("b", "g", 160.0, 0.3)], "bag_id string, hole_id string, from_distance double, short_game double")
    rows = ST.pin_difficulty(_cloud(spark, [("7i", 160, 10, 10)]), ask, hole, step=4.0).collect()
    assert min(r.over_easiest for r in rows) == 0.0
    left, right = min(rows, key=lambda r: r.pin_y), max(rows, key=lambda r: r.pin_y)
    assert left.expected > right.expected


@pytest.mark.parametrize("slope,short", [((0.08, 0.0), True), ((0.0, 0.0), False)])
def test_slope_pulls_the_aim_below_the_hole(spark, slope, short):
    pins = spark.createDataFrame([("p", "b", "g", 395.0, 0.0, 160.0, 0.0)], "pin_id string, bag_id string, hole_id string, pin_x double, pin_y double, from_distance double, short_game double")
    row = ST.aim_for_pin(_cloud(spark, [("7i", 160, 6, 6), ("Driver", 250, 6, 6)]), pins, _green(spark, slope=slope)).first()
    assert row.club == "7i" and (row.long_yds < -2 if short else abs(row.long_yds) <= 4)


def test_tees_and_ground(spark):
    tees = spark.createDataFrame([("g", 0.0, 0.0, 395.0), ("g", 30.0, 0.0, 365.0)], "hole_id string, downrange double, lateral double, yards double")
    hole = _green(spark)
    got = {r.level: r.yards for r in H.pick_tees(tees, hole).collect()}
    assert got == {"Back": 395.0, "Middle": 395.0, "Forward": 365.0}
    assert {r.yards for r in H.pick_tees(tees.limit(0), hole).collect()} == {395.0}
    rows = spark.createDataFrame([([[0.0, 0.0], [100.0, 10.0]], x) for x in (-5.0, 50.0, 200.0)] + [([], 1.0)], "e array<array<double>>, x double")
    assert [r[0] for r in rows.select(H.ground_height(F.col("e"), F.col("x"))).collect()] == [0.0, 5.0, 10.0, 0.0]
