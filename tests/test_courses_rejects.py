from pyspark.sql import functions as F

from swingframe.operators import courses as B
from swingframe.operators import holes as H
from swingframe.sources import courses as files


def _elements(spark):
    schema = ("course_id long, element_id long, type string, tags map<string,string>, "
              "geometry array<struct<lat:double,lon:double>>, members array<struct<role:string,geometry:array<struct<lat:double,lon:double>>>>")
    line = [(32.0, -117.0), (32.003, -117.0)]
    ring = [(32.003, -117.0), (32.0031, -117.0), (32.0031, -116.9999), (32.003, -116.9999)]
    hole = lambda ref, par, geometry=line: {"golf": "hole", "ref": ref, "par": par}
    return spark.createDataFrame([
        (1, 1, "way", hole("1", "4"), line, None), (1, 2, "way", hole("10A", "4"), line, None),
        (1, 3, "way", hole("3", "four"), line, None), (1, 4, "way", hole("4", "3"), line[:1], None),
        (1, 5, "way", hole("5", "5"), line, None), (1, 6, "way", {"golf": "green"}, ring, None),
        (1, 7, "way", {"golf": "bunker"}, ring[:2], None), (1, 8, "way", {"golf": "path"}, None, None)], schema)


def test_what_cannot_be_read_is_rejected_and_the_rest_goes_on(spark):
    elements = _elements(spark)
    assert {(r.element_id, r.reason) for r in B.rejected_features(elements).collect()} == {
        (2, "ref"), (3, "par"), (4, "line"), (7, "ring")}
    assert {r.ref for r in B.hole_lines(elements).collect()} == {1, 5}


def test_a_hole_without_a_free_green_is_kept(spark):
    elements = _elements(spark)
    pairs = B.pair_greens(B.hole_lines(elements), B.ring_features(elements))
    assert {(r.ref, r.green_id) for r in pairs.collect()} == {(1, 6), (5, None)}
    none = B.pair_greens(B.hole_lines(elements.where(F.lit(False))), B.ring_features(elements))
    assert none.count() == 0


def test_a_hole_without_a_free_green_reaches_its_record(spark, tmp_path):
    ring = "array(named_struct('lat', 32.0015D, 'lon', -117D), named_struct('lat', 32.0016D, 'lon', -117D), named_struct('lat', 32.0016D, 'lon', -116.9999D))"
    none = "CAST(NULL AS array<struct<role:string,geometry:array<struct<lat:double,lon:double>>>>)"
    more = spark.sql(f"SELECT 1L AS course_id, id AS element_id, 'way' AS type, map('golf', kind) AS tags, {ring} AS geometry, {none} AS members "
                     "FROM VALUES (20L, 'fairway'), (21L, 'bunker'), (22L, 'tee') AS t(id, kind)")
    elements = _elements(spark).unionByName(more)
    holes = B.build_course(elements)
    rows = {r.ref: r for r in holes.collect()}
    assert sorted(rows) == [1, 5] and rows[1].green and rows[1].fairway and rows[1].bunkers
    lone = rows[5]
    assert (lone.par, lone.pin_distance_yards, lone.bearing_deg, lone.green) == (5, None, None, None)
    assert lone.fairway == lone.bunkers == lone.water == lone.tees == lone.elevation == [] and lone.green_slope == [0.0, 0.0]
    # Only the hole that came away empty has features of its own.
    far = B.build_course(elements.where("element_id NOT IN (1)").unionByName(elements.where("element_id = 6").selectExpr(
        "course_id", "1 AS element_id", "type", "map('golf', 'hole', 'ref', '1', 'par', '4') AS tags", "transform(geometry, p -> named_struct('lat', p.lat + 1, 'lon', p.lon)) AS geometry", "members")))
    assert {r.ref: (r.green is None, r.bunkers) for r in far.collect()}[5] == (True, [])
    files.write_courses(holes, str(tmp_path / "out"))
    back = files.read_course(spark, str(tmp_path / "out"))
    assert {r.ref: r.green is None for r in back.collect()} == {1: False, 5: True}
    spots = spark.createDataFrame([("1-1", rows[1].pin_distance_yards, 0.0), ("1-5", 10.0, 0.0)], "hole_id string, x double, y double")
    lies = {r.hole_id: r.lie for r in H.classify_polygon(spots, H.prepare_course(back)).collect()}
    assert lies == {"1-1": "green", "1-5": "rough"}
