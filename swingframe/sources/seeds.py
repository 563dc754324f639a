"""Reference tables: seed files with pinned types, and the built-in constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from swingframe import constants as K
from swingframe import schemas

SEED_SCHEMAS = {
    "session_manifest": schemas.SESSION_MANIFEST,
    "player_profiles": schemas.PLAYER_PROFILES,
    "player_clubs": schemas.PLAYER_CLUBS,
    "club_specs": schemas.CLUB_SPECS,
    "tour_averages": schemas.TOUR_AVERAGES,
}


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A seed CSV under its declared schema, never inferred."""
    return spark.read.schema(SEED_SCHEMAS[name]).csv(path, header=True, quote='"', escape='"')


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}e0" if "e" not in repr(value) else repr(value)
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values_sql(columns: list[str], rows: list[tuple]) -> str:
    """`SELECT * FROM VALUES ...` text for a constant table."""
    body = ",".join("(" + ",".join(sql_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({','.join(columns)})"


def constant_table(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A constant table planned as a local relation, so its size is known to the optimizer."""
    df = spark.sql(values_sql(schema.names, rows))
    return df.select([df[f.name].cast(f.dataType) for f in schema])


def session_manifest(spark: SparkSession) -> DataFrame:
    rows = [(source, *rest) for source, rest in K.SESSION_MANIFEST.items()]
    return constant_table(spark, schemas.SESSION_MANIFEST, rows)


def tour_averages(spark: SparkSession, tour: str) -> DataFrame:
    rows = [(club, *map(float, v)) for club, v in K.TOUR_AVERAGES[tour].items()]
    return constant_table(spark, schemas.TOUR_AVERAGES, rows)


def all_tours(spark: SparkSession) -> DataFrame:
    """Both tours' averages in one table with a `tour` column."""
    rows = [(t, c, *map(float, v)) for t, clubs in K.TOUR_AVERAGES.items() for c, v in clubs.items()]
    return spark.sql(values_sql(["tour", "club", *K.TOUR_COLUMNS], rows))
