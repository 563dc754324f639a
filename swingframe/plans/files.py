"""Queries that go through files: exports in, tables out, courses in and out."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe import schemas
from swingframe.functions import cleaning as C
from swingframe.operators import conform, silver
from swingframe.operators import courses as B
from swingframe.operators.rings import checked_course
from swingframe.plans import courses, shots, tables
from swingframe.plans.registry import dround, query
from swingframe.session import fresh_path
from swingframe.sources import bronze, incremental, seeds
from swingframe.sources import courses as course_files
from swingframe.sources.registry import SOURCES, Source

# Vendor headers for the doppler export, with the shot number as an extra column.
DOPPLER_HEADERS = {"Shot No.": "CAST(_row_index AS STRING)", "Club": "club", "Ball Speed (mph)": "ball_speed_mph",
                   "Smash": "smash", "Launch Angle V": "launch_angle_v", "Spin RPM": "spin_rpm",
                   "Carry Distance (yds)": "carry_distance_yds"}
EXPORTS = Source("flightscope", r"^range/.*\.csv$", "flightscope_raw", multi_line=False)


def landed(spark, folder):
    root = fresh_path(spark, "landing")
    raw = tables.raw_source(spark, folder, "flightscope")
    raw.selectExpr(*[f"{v} AS `{k}`" for k, v in DOPPLER_HEADERS.items()]).write.csv(
        f"{root}/range", header=True, quote='"', escape='"', emptyValue="")
    return bronze.read_bronze(spark, root, EXPORTS)


@query("bronze_files", """SELECT 'flightscope' AS _source, CAST(_row_index AS VARCHAR) AS shot_no, club, ball_speed_mph, smash, launch_angle_v,
  spin_rpm, carry_distance_yds FROM flightscope_raw""")
def bronze_files(spark, folder):
    """CSV exports landed and read back: sanitised headers, strings kept, blanks kept."""
    return landed(spark, folder).select("_source", "shot_no", "club", "ball_speed_mph", "smash", "launch_angle_v",
                                        "spin_rpm", "carry_distance_yds")


@query("bronze_lineage", """SELECT 'flightscope' AS _source, count(*) AS n_rows, CAST(0 AS BIGINT) AS first_index, count(*) - 1 AS last_index,
  count(*) AS indexes FROM flightscope_raw""")
def bronze_lineage(spark, folder):
    return landed(spark, folder).groupBy("_source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("_row_index").alias("first_index"),
        F.max("_row_index").alias("last_index"), F.countDistinct("_row_index").alias("indexes"))


def land_lines(lines, path, encoding="UTF-8"):
    """Text lines `(file_no, ord, line)` as one CSV file for each number, in order."""
    lines.repartition("file_no").sortWithinPartitions("file_no", "ord").select("file_no", "line").write.partitionBy("file_no").options(
        sep="\u0001", quote="", encoding=encoding, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def export_lines(rows, cells, units=None, mark=""):
    """Rows `(file_no, ord, ...)` as lines under a header of vendor names, with a units row where units are given."""
    files = rows.select("file_no").distinct()
    parts = [files.select("file_no", F.lit(-2).cast("bigint").alias("ord"), F.lit(mark + ",".join(cells)).alias("line"))]
    if units is not None:
        parts.append(files.select("file_no", F.lit(-1).cast("bigint").alias("ord"), F.lit(",".join(units)).alias("line")))
    body = rows.selectExpr("file_no", "ord", "concat_ws(',', " + ", ".join(cells.values()) + ") AS line")
    return reduce(DataFrame.unionByName, parts, body)


# A camera's files in two layouts, each with a row of units; every third file lacks the carry.
CAMERA = {"Player": "player", "Club Type": "club_type", "Remark": "concat('\"say \"\"', club_type, '\"\", ok\"')", "Ball Speed": "ball_speed"}
CAMERA_FILES = Source("foresight", r"^foresight/.*\.csv$", "foresight_raw", has_units_row=True, multi_line=False)
FILE_NO = "CAST((_row_index - _row_index % 2500) / 2500 AS BIGINT)"
_CAMERA_SQL = f"""SELECT concat('file_no=', CAST(file_no AS VARCHAR)) AS file, CAST(row_number() OVER (ORDER BY concat(CAST(file_no AS VARCHAR), '/'), _row_index) - 1 AS BIGINT) AS row_index,
  player, club_type, ball_speed, CASE WHEN file_no % 3 <> 2 THEN carry_distance END AS carry_distance, {{remark}} AS remark
FROM (SELECT *, {FILE_NO} AS file_no FROM foresight_raw)"""


def camera_rows(spark, folder):
    return tables.raw_source(spark, folder, "foresight").selectExpr("*", f"{FILE_NO} AS file_no", "_row_index AS ord")


def camera_answer(df):
    return df.select(F.regexp_extract("_source_file", "file_no=[0-9]+", 0).alias("file"), F.col("_row_index").alias("row_index"),
                     "player", "club_type", "ball_speed", "carry_distance", "remark")


@query("bronze_layouts", _CAMERA_SQL.replace("{remark}", """concat('say "', club_type, '", ok')"""))
def bronze_layouts(spark, folder):
    """Files of two layouts with units rows and byte-order marks, beside files whose path the source's pattern rejects."""
    root, rows = fresh_path(spark, "layouts"), camera_rows(spark, folder)
    full, units = {**CAMERA, "Carry Distance": "carry_distance"}, ["", "", "", "[mph]", "[yds]"]
    short = {k: CAMERA[k] for k in ("Ball Speed", "Player", "Remark", "Club Type")}
    lines = export_lines(rows.where("file_no % 3 <> 2"), full, units, mark="\ufeff").unionByName(
        export_lines(rows.where("file_no % 3 = 2"), short, ["[mph]", "", "", ""]))
    land_lines(lines, f"{root}/foresight")
    land_lines(lines.where("file_no = 0"), f"{root}/elsewhere")
    return camera_answer(bronze.read_bronze(spark, root, CAMERA_FILES))


@query("bronze_two_byte_encoding", _CAMERA_SQL.replace("{remark}", "concat('größer ', club_type)"))
def bronze_two_byte_encoding(spark, folder):
    """The same in an encoding of two bytes a character, with quoted line breaks allowed."""
    root, rows = fresh_path(spark, "encoded"), camera_rows(spark, folder)
    cells = {"Player": "player", "Club Type": "club_type", "Remark": "concat('größer ', club_type)", "Ball Speed": "ball_speed"}
    lines = export_lines(rows.where("file_no % 3 <> 2"), {**cells, "Carry Distance": "carry_distance"}, ["", "", "", "[mph]", "[yds]"], mark="\ufeff").unionByName(
        export_lines(rows.where("file_no % 3 = 2"), cells, ["", "", "", "[mph]"]))
    land_lines(lines, f"{root}/foresight", encoding="UTF-16LE")
    source = replace(CAMERA_FILES, encoding="UTF-16LE", multi_line=True)
    return camera_answer(bronze.read_bronze(spark, root, source))


REGISTRY_CELLS = {"trackman": ["club", "ball_speed", "carry_flat_length"], "foresight": ["player", "club_type", "ball_speed"],
                  "caddieset": ["golferid", "clubtype", "ballspeed"], "flightscope": ["club", "ball_speed_mph", "spin_rpm"]}


@query("ingest_registry", " UNION ALL ".join(
    f"SELECT '{s}' AS _source, {c[0]} AS a, {c[1]} AS b, {c[2]} AS c, count(*) AS n_rows FROM {s}_raw GROUP BY ALL" for s, c in REGISTRY_CELLS.items()))
def ingest_registry(spark, folder):
    """Every registered source landed, ingested and written; the written tables by their cells."""
    root, target = fresh_path(spark, "registry"), fresh_path(spark, "bronze")
    for name, cells in REGISTRY_CELLS.items():
        rows = tables.raw_source(spark, folder, name).selectExpr("*", f"{FILE_NO} AS file_no", "_row_index AS ord")
        units = ["[u]"] * len(cells) if SOURCES[name].has_units_row else None
        below = "range" if name == "flightscope" else name
        land_lines(export_lines(rows, {c: c for c in cells}, units), f"{root}/{below}")
    bronze.ingest_and_write(spark, root, target)
    parts = [bronze.read_table(spark, f"{target}/{SOURCES[name].bronze_table}").groupBy(
        "_source", *[F.col(c).alias(x) for c, x in zip(cells, "abc")]).agg(F.count(F.lit(1)).alias("n_rows")) for name, cells in REGISTRY_CELLS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("optional_source_present", "SELECT * FROM stg_manual")
def optional_source_present(spark, folder):
    """A personal-session table that was landed is read like any other."""
    path = f"{fresh_path(spark, 'sessions')}/manual_raw"
    bronze.write_table(tables.raw_source(spark, folder, "manual"), path)
    return conform.conform_manual(bronze.read_optional(spark, path, schemas.MANUAL_RAW))


@query("session_landing", """SELECT 'manual' AS _source, 'Tester' AS player, club, ball_speed_mph, launch_angle_deg, spin_rate_rpm, carry_yards, side_dispersion,
  launch_direction_deg, '' AS total_yards, count(*) AS copies
FROM (SELECT trim("Club Name") AS club, "Ball Speed [mph]" AS ball_speed_mph, "Launch V" AS launch_angle_deg, "Spin Rate" AS spin_rate_rpm,
  coalesce(nullif("Carry", ''), nullif("Carry Dist.", ''), '') AS carry_yards, "Offline" AS side_dispersion, "HLA" AS launch_direction_deg FROM export_raw) GROUP BY ALL""")
def session_landing(spark, folder):
    """A personal export written as vendors do and landed as a bronze table."""
    path = fresh_path(spark, "session")
    shots.export(spark, folder).write.csv(path, header=True, quote='"', escape='"', emptyValue="")
    landed = bronze.land_session(spark, path, "Tester")
    return landed.groupBy("_source", "player", F.trim("club").alias("club"), "ball_speed_mph", "launch_angle_deg", "spin_rate_rpm", "carry_yards", "side_dispersion",
                          "launch_direction_deg", "total_yards").agg(F.count(F.lit(1)).alias("copies"))


_AVERAGED = ["club_speed_mph", "ball_speed_mph", "smash_factor", "launch_angle_deg", "spin_rate_rpm", "carry_yards"]


@query("averages_file", "SELECT club, " + ", ".join(f"{dround(f'avg({c})', 3)} AS {c}" for c in _AVERAGED) + " FROM typed_shots GROUP BY club")
def averages_file(spark, folder):
    """Reference averages read from a CSV file under their pinned types; the file holds the averages of the shots."""
    path = fresh_path(spark, "averages")
    mean = tables.typed_shots(spark, folder).groupBy("club").agg(*[F.round(F.round(F.avg(c), 9), 3).alias(c) for c in _AVERAGED])
    empty = [F.lit(None).cast("string").alias(c) for c in ("attack_angle_deg", "max_height_yards", "land_angle_deg")]
    mean.select("*", *empty).select(schemas.TOUR_AVERAGES.names).write.csv(path, header=True)
    return seeds.read_seed(spark, "tour_averages", path).select("club", *_AVERAGED)


@query("table_round_trip", "SELECT shot_id, source, club, ball_speed_mph, session_date FROM silver_shots")
def table_round_trip(spark, folder):
    """Silver written in place twice and read back."""
    path = fresh_path(spark, "silver")
    rows = silver.silver_shots(tables.raw_sources(spark, folder))
    bronze.write_table(rows.limit(0), path)
    bronze.write_table(rows, path)
    return bronze.read_table(spark, path).select("shot_id", "source", "club", "ball_speed_mph", "session_date")


@query("seed_files", "SELECT * FROM club_specs")
def seed_files(spark, folder):
    path = fresh_path(spark, "club_specs")
    tables.club_specs(spark, folder).write.csv(path, header=True)
    return seeds.read_seed(spark, "club_specs", path)


CAMERA_HEADER = ("golferid", "clubtype", "ballspeed", "carry", "distance", "lrdistanceout", "spinback", "spinside")
CAMERA_VIEWS = Source("caddieset", r"^caddieset/.*\.csv$", "caddieset_raw", multi_line=False, header=CAMERA_HEADER)
_TYPED = {n: c for n, c in shots.CAMERA_CELLS.items() if c in CAMERA_HEADER}


@query("incremental_views", f"SELECT DISTINCT golferid, clubtype, {', '.join(_TYPED)} FROM camera_clean")
def incremental_views(spark, folder):
    """The camera's two views of a shot landing in different files and runs; each shot once."""
    root, target, state = (fresh_path(spark, n) for n in ("arrivals", "views", "stream"))
    raw = tables.raw_source(spark, folder, "caddieset")
    for turn in (0, 1):
        some = raw.where((F.col("_row_index") + F.floor(F.col("_row_index") / 2)) % 2 == turn).select(*CAMERA_HEADER)
        some.write.csv(f"{root}/caddieset/{turn}", header=True, emptyValue="")
        incremental.land_new(spark, root, CAMERA_VIEWS, target, state, fingerprint=["golferid", "clubtype", *_TYPED],
                             conform=lambda rows: rows.select("_landed_at", "golferid", "clubtype", *[C.clean_double(F.col(c)).alias(n) for n, c in _TYPED.items()]))
    return spark.read.parquet(target).select("golferid", "clubtype", *_TYPED)


_VERTEX = "round(s.lat + o.dlat, 8) AS lat, round(s.lon + o.dlon, 8) AS lon"
_GREEN_RING = [(a + courses.GREEN_AT[0], b + courses.GREEN_AT[1]) for a, b in courses.RING]
_KIND = tables.pick("CAST(s.id % 9 AS INT)", courses.KINDS)


def _member(ring, role, offsets):
    return (f"SELECT CAST(s.course_id AS VARCHAR), 'relation', {_KIND}, NULL, NULL, '{role}', {ring}, o.ord, {_VERTEX} "
            f"FROM customer_spots s, ({courses._rows(offsets)}) o WHERE s.id % 5 = 0")


@query("map_extracts", " UNION ALL ".join([
    f"SELECT CAST(s.course_id AS VARCHAR) AS course_id, 'way' AS type, 'hole' AS golf, CAST(s.id % 12 + 1 AS VARCHAR) AS ref, CAST(3 + s.id % 3 AS VARCHAR) AS par, "
    f"NULL AS role, 0 AS ring, o.ord, {_VERTEX} FROM supplier_spots s, ({courses._rows(courses.LINE)}) o WHERE s.id % 2 = 0",
    f"SELECT CAST(s.course_id AS VARCHAR), 'way', 'green', NULL, NULL, NULL, 0, o.ord, {_VERTEX} FROM supplier_spots s, ({courses._rows(_GREEN_RING)}) o",
    f"SELECT CAST(s.course_id AS VARCHAR), 'way', {_KIND}, NULL, NULL, NULL, 0, o.ord, {_VERTEX} FROM customer_spots s, ({courses._rows(courses.RING)}) o WHERE s.id % 5 <> 0",
    _member(0, "inner", courses.BIG_RING), _member(1, "outer", courses.RING), _member(2, "outer", courses.BIG_RING)]))
def map_extracts(spark, folder):
    """Map extracts written one course per line and read back as feature rows, shown vertex by vertex."""
    path = fresh_path(spark, "maps")
    mapped = courses.elements(spark, folder)
    mapped.groupBy("course_id").agg(F.collect_list(F.struct(
        "type", F.col("element_id").alias("id"), "tags", "geometry", "members")).alias("elements")).select(
        "elements", "course_id").write.partitionBy("course_id").json(path)
    folder_name = F.regexp_extract("_metadata.file_path", "course_id=([^/]+)/", 1)
    read = course_files.read_map_extract(spark, f"{path}/*/*.json", folder_name)
    head = ["course_id", "type", F.col("tags")["golf"].alias("golf"), F.col("tags")["ref"].alias("ref"), F.col("tags")["par"].alias("par")]
    ways = read.where("type = 'way'").select(*head, F.lit(None).cast("string").alias("role"), F.lit(0).alias("ring"), F.posexplode("geometry").alias("ord", "p"))
    members = read.where("type = 'relation'").select(*head, F.posexplode("members").alias("ring", "m")).select(
        "course_id", "type", "golf", "ref", "par", "m.role", "ring", F.posexplode("m.geometry").alias("ord", "p"))
    return ways.unionByName(members).select("course_id", "type", "golf", "ref", "par", "role", "ring", "ord",
                                            F.round("p.lat", 8).alias("lat"), F.round("p.lon", 8).alias("lon"))


@query("course_reader", f"SELECT concat(CAST(course_id AS VARCHAR), '-', CAST(ref AS VARCHAR)) AS hole_id, ref, {courses._FLAT}")
def course_reader(spark, folder):
    """Course files written and read back into holes, as flat rows."""
    path = fresh_path(spark, "courses")
    course_files.write_courses(courses.records(spark, folder), path)
    holes = course_files.read_course(spark, path)
    one = F.coalesce(F.get("fairway", F.lit(0)), F.array().cast("array<array<double>>"))
    return B.record_rows(holes.withColumnRenamed("pin_distance", "pin_distance_yards").withColumn("fairway", one), ["hole_id", "ref"])


@query("course_centres", f"""SELECT hole_id, {dround('sum((x0 + x1) * c) / (3 * sum(c))', 6)} AS x, {dround('sum((y0 + y1) * c) / (3 * sum(c))', 6)} AS y FROM (
  SELECT concat(CAST(p.course_id AS VARCHAR), '-', CAST(p.ref AS VARCHAR)) AS hole_id, p.x AS x0, p.y AS y0, q.x AS x1, q.y AS y1, p.x * q.y - q.x * p.y AS c
  FROM record_parts p JOIN record_parts q ON q.course_id = p.course_id AND q.ref = p.ref AND q.part = 'green' AND q.ord = (p.ord + 1) % 5 WHERE p.part = 'green') GROUP BY hole_id""")
def course_centres(spark, folder):
    """Green centres of the holes of course files, checked and prepared for membership tests."""
    path = fresh_path(spark, "courses")
    course_files.write_courses(courses.records(spark, folder), path)
    ready, _ = checked_course(course_files.read_course(spark, path))
    return ready.select("hole_id", *[F.round(F.round(f"green_centre.{c}", 10), 6).alias(c) for c in "xy"])
