import json
import math

import numpy as np
from pyspark.sql import functions as F

from swingframe.operators import courses as B
from swingframe.operators import holes as H
from swingframe.operators import proposals as R
from swingframe.plans import courses as PC
from swingframe.sources import courses as files


def _metres(a, b):
    m = math.radians(a[0] + b[0]) / 2
    return math.hypot((a[0] - b[0]) * 111320, (a[1] - b[1]) * 111320 * math.cos(m))


def test_pairing_equals_the_greedy_loop(spark, folder):
    mapped = PC.elements(spark, folder)
    lines, features = B.hole_lines(mapped), B.ring_features(mapped)
    got = {(r.course_id, r.ref): (r.green_id, r.end) for r in B.pair_greens(lines, features).collect()}
    greens, want = {}, {}
    for r in features.where("golf = 'green'").collect():
        greens.setdefault(r.course_id, {})[r.element_id] = (r.centre.lat, r.centre.lon)
    for r in sorted(lines.collect(), key=lambda r: (r.course_id, r.ref)):
        ends = [(p.lat, p.lon) for p in (r.line[0], r.line[-1])]
        free = greens[r.course_id]
        _, gid, end = min((round(_metres(free[g], e), 6), g, i) for g in free for i, e in enumerate(ends))
        del free[gid]
        want[(r.course_id, r.ref)] = (gid, end)
    assert got == want and want


def _square(lat, lon, s):
    return [{"lat": lat + a, "lon": lon + b} for a, b in ((-s, -s), (-s, s), (s, s), (s, -s))]


def _extract(path):
    def way(golf, ring, **tags):
        return {"type": "way", "id": 1, "tags": {"golf": golf, **tags}, "geometry": ring}

    north = [{"lat": 32.0, "lon": -117.0}, {"lat": 32.002, "lon": -117.0}, {"lat": 32.003, "lon": -117.0}]
    elements = [
        way("hole", north, ref="1", par="4"), way("hole", [dict(p, lon=-117.01) for p in north], ref="2", par="3"),
        way("hole", north, ref="9"),  # without a par it is not played
        way("green", _square(32.003, -117.0, 0.0001)), way("green", _square(32.003, -117.01, 0.0001)),
        way("fairway", _square(32.0015, -117.0, 0.0005)), way("tee", _square(32.0002, -117.0, 0.00002)),
        way("tee", _square(32.0025, -117.0, 0.00002)), way("bunker", _square(32.0028, -117.0003, 0.00004)),
        way("water", _square(32.002, -117.0104, 0.0001)[:2]),  # two points are no ring
        {"type": "relation", "id": 2, "tags": {"golf": "water_hazard"}, "members": [
            {"role": "inner", "geometry": _square(32.002, -117.0102, 0.0009)},
            {"role": "outer", "geometry": _square(32.002, -117.0102, 0.0001)},
            {"role": "outer", "geometry": _square(32.001, -117.0102, 0.0003)}]}]
    path.write_text(json.dumps({"elements": elements}, indent=1))


def test_extract_to_course_and_back(spark, tmp_path):
    _extract(tmp_path / "links.json")
    mapped = files.read_map_extract(spark, str(tmp_path / "links.json"))
    assert {r.course_id for r in mapped.collect()} == {"links"}
    built = B.build_course(mapped)
    rows = {r.ref: r for r in built.collect()}
    assert sorted(rows) == [1, 2]
    one = rows[1]
    assert abs(one.pin_distance_yards - 0.003 * 111320 / 0.9144) < 0.1 and one.bearing_deg == 0.0 and one.par == 4
    assert abs(sum(p[0] for p in one.green) / 4 - one.pin_distance_yards) < 0.2 and len(one.fairway) == 4
    assert len(one.tees) == 1 and one.tees[0].downrange > 20  # the second tee is past 45 % of the hole
    assert len(one.bunkers) == 1 and one.bunkers[0][0][1] < 0 and one.water == []
    assert len(rows[2].water) == 1 and max(p[0] for p in rows[2].water[0]) - min(p[0] for p in rows[2].water[0]) > 60  # largest outer
    files.write_courses(built, str(tmp_path / "out"))
    back = files.read_course(spark, str(tmp_path / "out"))
    again = {r.ref: r for r in back.collect()}
    assert again[1].fairway == [one.fairway] and again[2].pin_distance == rows[2].pin_distance_yards
    lies = H.classify_polygon(spark.createDataFrame([("links-1", one.pin_distance_yards, 0.5)], "hole_id string, x double, y double"), H.prepare_course(back))
    assert lies.first().lie == "green"


def test_course_reader_takes_one_ring_or_many(spark, tmp_path):
    ring = [[0, 0], [10, 0], [10, 10]]
    hole = {"ref": 1, "par": 3, "pin_distance_yards": 150.5, "green": ring, "fairway": ring, "bunkers": [], "water": []}
    holes = [hole, {**hole, "ref": 2, "fairway": [ring, ring]}, {**hole, "ref": 3, "fairway": []}]
    (tmp_path / "c.json").write_text(json.dumps({"name": "C", "slug": "c", "holes": holes}, indent=1))
    rows = {r.ref: r for r in files.read_course(spark, str(tmp_path / "c.json")).collect()}
    assert [len(rows[k].fairway) for k in (1, 2, 3)] == [1, 2, 0]
    assert rows[1].green_slope == [0.0, 0.0] and rows[1].elevation == [] and rows[1].bearing_deg == 0.0 and rows[1].playable == []


def test_resampling_walks_the_line(spark):
    pts = [(32.0, -117.0), (32.001, -117.0), (32.001, -117.0), (32.004, -117.002)]
    df = spark.createDataFrame([([{"lat": a, "lon": b} for a, b in pts],)], "line array<struct<lat:double,lon:double>>")
    got = df.select(F.inline(B.resample_line(F.col("line"), 6))).collect()
    seg = [_metres(pts[i], pts[i + 1]) for i in range(3)]
    cum = np.concatenate([[0], np.cumsum(seg)])
    for r in got:
        d = cum[-1] * r.k / 5
        i = next((j for j in range(3) if cum[j + 1] >= d), 0)
        f = (d - cum[i]) / (seg[i] or 1.0)
        assert math.isclose(r.lat, pts[i][0] + f * (pts[i + 1][0] - pts[i][0]), abs_tol=1e-9)


def test_plane_fit_equals_least_squares(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(0, 5, (12, 2))
    z = 0.03 * pts[:, 0] - 0.02 * pts[:, 1] + 4 + rng.normal(0, 0.05, 12)
    df = spark.createDataFrame([("a", float(x), float(y), float(h)) for (x, y), h in zip(pts, z)] + [("few", 0.0, 0.0, 1.0)] * 3, "k string, x double, y double, z double")
    got = {r.k: (r.slope_x, r.slope_y) for r in B.fit_planes(df, ["k"], "x", "y", "z").collect()}
    want = np.linalg.lstsq(np.column_stack([pts, np.ones(12)]), z, rcond=None)[0]
    assert np.allclose(got["a"], np.round(want[:2], 4)) and got["few"] == (0.0, 0.0)


def test_mapping_review(spark):
    proposal = {"source_name": "acme", "mappings": [
        {"common_field": "club", "source_column": "Club", "unit_conversion": "none", "confidence": 0.99, "notes": ""},
        {"common_field": "ball_speed_mph", "source_column": "Ball (m/s)", "unit_conversion": "m/s -> mph", "confidence": 0.9, "notes": ""},
        {"common_field": "player", "source_column": "", "unit_conversion": "none", "confidence": 0.0, "notes": ""}],
        "unmapped_source_columns": ["Temp"], "missing_common_fields": ["player"], "overall_notes": ""}
    texts = spark.createDataFrame([(1, json.dumps(proposal)), (2, "not json")], "proposal_id int, text string")
    headers = spark.createDataFrame([("acme", "Club"), ("acme", "Ball (m/s)"), ("acme", "Temp")], "source_name string, source_column string")
    rows = R.ordered_review(R.review(R.parse_proposals(texts, "text"), headers)).collect()
    assert [r.common_field for r in rows if r.item == "mapping"] == ["ball_speed_mph", "club", "player"]
    assert len([r for r in rows if r.item == "missing field"]) == 9
    assert [r.source_column for r in rows if r.item == "unused column"] == ["Temp"]
