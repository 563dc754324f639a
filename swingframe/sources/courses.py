"""Course files: map extracts in, hole records in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swingframe import schemas

RINGS = "array<array<array<double>>>"


def read_map_extract(spark: SparkSession, path: str, course: Column | None = None) -> DataFrame:
    """Elements of map extracts, one file per course, as feature rows. The course is the file's
    name, or an expression over `_metadata`."""
    files = spark.read.schema(schemas.MAP_EXTRACT).option("multiLine", True).json(path)
    if course is None:
        course = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.json)?$", 1)
    return files.select(course.alias("course_id"), F.posexplode("elements").alias("element_id", "e")).select(
        "course_id", F.col("element_id").cast("bigint").alias("element_id"), "e.type", "e.tags", "e.geometry", "e.members")


def read_course(spark: SparkSession, path: str) -> DataFrame:
    """Course files, one course in each, to hole rows. The fairway may be one ring or a list of rings; optional
    fields get their defaults."""
    files = spark.read.schema(schemas.COURSE).option("multiLine", True).json(path)
    holes = files.select(F.coalesce("slug", "name").alias("course_id"), F.col("name").alias("course"), F.explode("holes").alias("h"))
    many = F.from_json("h.fairway", RINGS)
    one = F.from_json("h.fairway", "array<array<double>>")
    one_ring = F.when(F.size(one) > 0, F.array(one)).otherwise(F.array().cast(RINGS))
    # A single ring read as a list of rings has numbers where points belong.
    is_many = F.regexp_like("h.fairway", F.lit(r"^\s*\[\s*\[\s*\["))
    empty = F.array().cast(RINGS)
    flat = F.array(F.lit(0.0), F.lit(0.0))
    return holes.select(
        "course_id", "course", F.concat("course_id", F.lit("-"), F.col("h.ref").cast("string")).alias("hole_id"),
        "h.ref", "h.par", F.col("h.pin_distance_yards").alias("pin_distance"),
        F.coalesce("h.bearing_deg", F.lit(0.0)).alias("bearing_deg"), "h.green",
        F.when(is_many, many).otherwise(one_ring).alias("fairway"),
        F.coalesce("h.bunkers", empty).alias("bunkers"), F.coalesce("h.water", empty).alias("water"),
        F.coalesce("h.playable", empty).alias("playable"),
        F.coalesce("h.green_slope", flat).alias("green_slope"),
        F.coalesce("h.green_quad", F.array().cast("array<double>")).alias("green_quad"),
        F.coalesce("h.green_difficulty", F.lit(0.0)).alias("green_difficulty"),
        F.coalesce("h.elevation", F.array().cast("array<array<double>>")).alias("elevation"),
        F.coalesce("h.tees", F.array().cast("array<struct<downrange:double,lateral:double,yards:double>>")).alias("tees"))


def course_records(holes: DataFrame) -> DataFrame:
    """Hole records gathered into one record per course, holes in ref order."""
    fields = [c for c in holes.columns if c != "course_id"]
    gathered = holes.groupBy("course_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("holes"))
    return gathered.select(F.col("course_id").cast("string").alias("name"), F.col("course_id").cast("string").alias("slug"), "holes")


def write_courses(holes: DataFrame, path: str) -> None:
    """One file per course, as `read_course` takes one record from a file."""
    course_records(holes).write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
