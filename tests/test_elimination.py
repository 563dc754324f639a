import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.operators import elimination as E
from swingframe.operators import holes as H
from swingframe.operators import strategy as ST

REGIONS = "hole_id string, region_id string, ord int, kind string, near double, far double, left double, right double, penalty_strokes double, drop_distance double"
COURSE = ("hole_id string, pin_distance double, green array<array<double>>, fairway array<array<array<double>>>, bunkers array<array<array<double>>>, "
          "water array<array<array<double>>>, playable array<array<array<double>>>, green_slope array<double>, green_quad array<double>, green_difficulty double, elevation array<array<double>>")


def _clouds(spark, clubs, n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = [("b", club, round(float(c), 1), round(float(x), 1), i) for club, mean, sc, sl in clubs
            for i, (c, x) in enumerate(zip(rng.normal(mean, sc, n), rng.normal(0, sl, n)))]
    return spark.createDataFrame(rows, "bag_id string, club string, carry double, lateral double, ord bigint")


def _parametric(spark):
    heads = spark.createDataFrame([("h", 152.0, 7.0, 15.0, 0.0), ("g", 30.0, 5.0, 12.0, 0.0)],
                                  "hole_id string, pin_distance double, green_radius double, half_width double, green_difficulty double")
    boxes = [("h", "w", 0, "water", 135.0, 165.0, 6.0, 45.0, 1.0, None), ("h", "s", 1, "sand", 138.0, 156.0, -32.0, -11.0, 1.0, None),
             ("h", "o", 2, "ob", 150.0, 190.0, 20.0, 60.0, 2.0, 120.0), ("h", "u", 3, "sand", 158.0, 170.0, -9.0, 3.0, 1.0, None)]
    return H.lay_regions(heads, spark.createDataFrame(boxes, REGIONS))


def _polygons(spark):
    box = lambda a, b, c, d: [[a, c], [b, c], [b, d], [a, d]]
    rows = [("g", 395.0, box(380.0, 410.0, -12.0, 12.0), [box(250.0, 372.0, -18.0, 17.0)], [[[384.0, 13.0], [402.0, 15.0], [396.0, 24.0]]],
             [box(384.0, 406.0, -30.0, -12.0)], [box(0.0, 430.0, -40.0, 40.0)], [0.03, -0.02], [], 0.4, []),
            ("k", 395.0, [[380.0, -9.0], [401.0, -12.0], [411.0, 2.0], [395.0, 14.0]], [], [], [], [], [0.0, 0.0], [], 0.0, [])]
    return H.prepare_course(spark.createDataFrame(rows, COURSE))


def test_curves_do_not_fall_with_distance():
    for values in (*K.CURVE_STROKES.values(), K.PUTT_STROKES):
        assert all(a <= b for a, b in zip(values, values[1:]))


def test_the_best_aim_of_all_is_found_with_few_priced(spark):
    clouds, holes = _clouds(spark, [("7i", 150, 8, 9), ("9i", 131, 7, 7), ("lob", 22, 3, 3)]), _parametric(spark)
    asked = spark.createDataFrame([("b", "h"), ("b", "g")], "bag_id string, hole_id string")
    placed = ST.on_holes(ST.cloud_cells(clouds), asked, holes)
    every = ST.candidate_aims(placed.select("hole_id", *ST.CLUB, "stock").distinct()).drop("_i", "_j", "stock")
    priced = ST.evaluate_aims(ST.at_aims(placed.drop("stock"), every, ["hole_id", *ST.CLUB]))
    want = {tuple(r) for r in ST.best_aims(priced, ["hole_id", *ST.CLUB]).select("hole_id", "club", "aim_distance", "aim_lateral", F.round("expected_strokes", 9)).collect()}
    got = ST.optimize_shots(clouds, asked, holes)
    assert {tuple(r) for r in got.select("hole_id", "club", "aim_distance", "aim_lateral", F.round("expected_strokes", 9)).collect()} == want and len(want) == 6
    kept = ST.worthy_aims(placed.select("hole_id", *ST.CLUB, "dx", "dy", "stock", "n"), asked, holes)
    assert 6 <= kept.count() < every.count() / 2


def _pins(spark):
    rows = [("p", "b", "g", 395.0, 0.0, 160.0, 0.25), ("q", "b", "g", 385.0, -9.0, 152.0, 0.0), ("r", "b", "k", 400.0, 3.0, 148.0, 0.4)]
    return spark.createDataFrame(rows, "pin_id string, bag_id string, hole_id string, pin_x double, pin_y double, from_distance double, short_game double")


def test_the_best_approach_of_all_is_found(spark, monkeypatch):
    clouds, holes, pins = _clouds(spark, [("7i", 155, 7, 8), ("Driver", 250, 12, 14)], n=250), _polygons(spark), _pins(spark)
    fields = ["pin_id", "club", "long_yds", "right_yds", F.round("expected_strokes", 9), F.round("on_green_pct", 6), F.round("proximity_ft", 6)]
    got = {tuple(r) for r in ST.aim_for_pin(clouds, pins, holes).select(*fields).collect()}
    counted = []
    surviving = E.surviving
    monkeypatch.setattr(E, "surviving", lambda counts, aims, bounds, group: counted.append((aims.count(), surviving(counts, aims, bounds, group).count())) or aims)
    want = {tuple(r) for r in ST.aim_for_pin(clouds, pins, holes).select(*fields).collect()}
    assert got == want and len(want) == 3
    (every, kept), = counted
    assert every == 3 * 357 and 3 <= kept < every / 2


def test_bounds_hold_every_price(spark):
    draw = random.Random(4)
    spots = [("g" if k % 2 else "k", k, draw.uniform(240, 440), draw.uniform(-60, 60), 395.0, 0.0, 0.3) for k in range(400)]
    boxes = spark.createDataFrame(spots, "hole_id string, box int, x double, y double, pin_x double, pin_y double, short_game double")
    holes = _polygons(spark)
    bounds = E.approach_bounds(boxes.join(holes, "hole_id"), 3.0).select("box", "low", "high")
    inside = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1.5, -0.4, 0.9, 1.5) for b in (-1.5, 0.0, 1.1, 1.5)]))
    balls = boxes.withColumn("o", inside).withColumns({"x": F.col("x") + F.col("o.a"), "y": F.col("y") + F.col("o.b")}).drop("o")
    priced = ST.price_approaches(balls, holes).join(bounds, "box")
    assert priced.count() == 6400
    assert priced.where("cost < low - 1e-6 OR cost > high + 1e-6 OR low IS NULL").count() == 0
    tight = bounds.agg(F.avg(F.col("high") - F.col("low"))).first()[0]
    assert tight < 1.0


@pytest.mark.parametrize("seed", [1, 2])
def test_sure_squares_agree_with_the_layers(spark, seed):
    draw = random.Random(seed)
    holes = _polygons(spark)
    raster = E.lie_raster(holes)
    rows = [("g" if k % 2 else "k", k, draw.uniform(230, 440), draw.uniform(-60, 60), 395.0, 0.0, 0.1) for k in range(3000)]
    balls = spark.createDataFrame(rows, "hole_id string, ball int, x double, y double, pin_x double, pin_y double, short_game double")
    fields = ["ball", "lie", "cost"]
    plain = {tuple(r) for r in ST.price_approaches(balls, holes).select(*fields).collect()}
    assert {tuple(r) for r in ST.price_approaches(balls, holes, raster).select(*fields).collect()} == plain
    known = raster.join(balls.withColumns({"_x": F.floor("x"), "_y": F.floor("y")}), ["hole_id", "_x", "_y"]).count()
    assert known > 600
