import __spark_entry__ as entry_module
from swingframe.operators.rings import checked_course
from swingframe.sources import courses as files


def test_sessions_carry_the_shots_of_their_source(spark, folder):
    queries = entry_module.queries()
    sessions = queries["dim_session"](spark, folder).collect()
    counts = {r["source"]: r["count"] for r in queries["silver_shots"](spark, folder).groupBy("source").count().collect()}
    assert counts and {r.source for r in sessions} >= set(counts)
    assert all(r.shots == counts.get(r.source, 0) for r in sessions)


def test_every_course_is_written_to_a_file_of_its_own(spark, tmp_path):
    ring = "array(array(0D, 0D), array(10D, 0D), array(10D, 10D))"
    holes = spark.range(60).selectExpr(
        "CAST(id % 20 AS bigint) AS course_id", "CAST(id AS int) AS ref", "4 AS par", "1.5D AS pin_distance_yards", f"{ring} AS green", f"{ring} AS fairway")
    files.write_courses(holes, str(tmp_path / "courses"))
    assert len(list((tmp_path / "courses").glob("part-*.json"))) == 20
    back = files.read_course(spark, str(tmp_path / "courses")).select("course_id", "ref").collect()
    assert sorted((int(r.course_id), r.ref) for r in back) == sorted((k % 20, k) for k in range(60))


def test_centres_come_from_every_course_file(spark, tmp_path):
    square = "array(array(id, 0D), array(id + 10D, 0D), array(id + 10D, 10D), array(id, 10D))"
    holes = spark.range(12).selectExpr(
        "CAST(id % 6 AS bigint) AS course_id", "CAST(id AS int) AS ref", "4 AS par", "1.5D AS pin_distance_yards", f"{square} AS green", f"{square} AS fairway")
    files.write_courses(holes, str(tmp_path / "courses"))
    ready, _ = checked_course(files.read_course(spark, str(tmp_path / "courses")))
    got = {r.hole_id: (round(r.x, 6), round(r.y, 6)) for r in ready.select("hole_id", "green_centre.*").collect()}
    assert got == {f"{k % 6}-{k}": (k + 5.0, 5.0) for k in range(12)}
