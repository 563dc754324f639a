import math

from pyspark.sql import functions as F

from swingframe.operators import courses as B
from swingframe.plans import courses as PC
from swingframe.sources import courses as files

YARDS = 1 / 0.9144


def test_records_hold_the_profile_and_tilt_of_a_sloping_ground(spark, folder):
    mapped = PC.elements(spark, folder).where("course_id < 3")
    rise = lambda lat, lon: 12.0 + (lat - 30) * 2500 + (lon + 100) * 800
    built = B.build_course(mapped, lambda places: places.withColumn("metres", rise(F.col("lat"), F.col("lon"))))
    lines, features = B.hole_lines(mapped), B.ring_features(mapped)
    frames = {(r.course_id, r.ref): r for r in B.hole_frames(lines, features, B.pair_greens(lines, features)).collect()}
    rows = built.collect()
    assert rows and len(rows) == len(frames)
    for r in rows:
        f = frames[r.course_id, r.ref].frame
        north, east = 2500 / 111320, 800 / f.metres_lon  # metres a metre
        want = (f.east * east + f.north * north, f.north * east - f.east * north)
        assert all(math.isclose(a, b, abs_tol=2e-3) for a, b in zip(r.green_slope, want)) and r.green_slope != [0.0, 0.0]
        height = dict((d, h) for d, h in r.elevation)
        pin = frames[r.course_id, r.ref].pin
        assert len(height) >= 6 and height[0.0] == 0.0 and list(height) == sorted(height)
        assert math.isclose(height[round(f.pin_yards, 0)], (rise(pin.lat, pin.lon) - rise(f.lat, f.lon)) * YARDS, abs_tol=0.06)


def test_places_without_a_height_are_left_out(spark, folder):
    mapped = PC.elements(spark, folder).where("course_id = 1")
    blind = B.build_course(mapped, lambda places: places.withColumn("metres", F.when(F.col("ord") > 0, F.lit(5.0))))
    assert all(r.elevation == [] and r.green_slope == [0.0, 0.0] for r in blind.collect())  # no height of the tee, none on the green


def test_registered_records_have_ground(spark, folder):
    rows = PC.records(spark, folder).collect()
    assert rows and all(len(r.elevation) > 2 and any(r.green_slope) for r in rows)
    assert len({h for r in rows for _, h in r.elevation}) > 3
    gathered = files.course_records(PC.records(spark, folder)).collect()
    assert all(h.elevation and any(h.green_slope) for c in gathered for h in c.holes)
