"""Declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from swingframe.constants import MEASURES, SESSION_COLUMNS, TOUR_COLUMNS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STR, DBL, LONG, DATE, BOOL = (
    T.StringType(), T.DoubleType(), T.LongType(), T.DateType(), T.BooleanType(),
)

COMMON = _struct(
    shot_id=STR, source=STR, player=STR, club=STR, session_date=DATE,
    **{m: DBL for m in MEASURES},
)
MANUAL_RAW = _struct(
    _source=STR, _source_file=STR, _row_index=LONG, **{c: STR for c in SESSION_COLUMNS},
    _ingested_at_utc=T.TimestampType(),
)

# Seed files, with sparse columns pinned rather than inferred.
SESSION_MANIFEST = _struct(
    source=STR, session_id=STR, session_date=STR, indoor_outdoor=STR, device=STR,
    carry_method=STR, ball_type=STR,
)
PLAYER_PROFILES = _struct(
    player=STR, handicap_band=STR, age_band=STR, gender=STR, effective_from=STR,
)
PLAYER_CLUBS = _struct(
    player=STR, club_type=STR, make=STR, model=STR, year=STR, is_custom=STR,
    reported_loft_deg=DBL, reported_length_in=DBL, reported_shaft=STR, effective_from=STR,
)
CLUB_SPECS = _struct(
    make=STR, model=STR, year=STR, club_type=STR, stock_loft_deg=DBL,
    standard_length_in=DBL, stock_shaft=STR,
)
TOUR_AVERAGES = _struct(club=STR, **{c: DBL for c in TOUR_COLUMNS})

# Course files.
RING = T.ArrayType(T.ArrayType(DBL))
TEE = _struct(downrange=DBL, lateral=DBL, yards=DBL)
COURSE = T.StructType([
    T.StructField("name", STR),
    T.StructField("slug", STR),
    T.StructField("holes", T.ArrayType(_struct(
        ref=T.IntegerType(), par=T.IntegerType(), pin_distance_yards=DBL, bearing_deg=DBL,
        green_slope=T.ArrayType(DBL), green_difficulty=DBL, green_quad=T.ArrayType(DBL),
        elevation=RING, tees=T.ArrayType(TEE), green=RING, fairway=STR,
        bunkers=T.ArrayType(RING), water=T.ArrayType(RING), playable=T.ArrayType(RING),
    ))),
])
POINT = _struct(lat=DBL, lon=DBL)
MAP_EXTRACT = T.StructType([
    T.StructField("elements", T.ArrayType(_struct(
        type=STR, id=LONG, tags=T.MapType(STR, STR), geometry=T.ArrayType(POINT),
        members=T.ArrayType(_struct(role=STR, geometry=T.ArrayType(POINT))),
    ))),
])
MAPPING_PROPOSAL = T.StructType([
    T.StructField("source_name", STR),
    T.StructField("mappings", T.ArrayType(_struct(
        common_field=STR, source_column=STR, unit_conversion=STR, confidence=DBL, notes=STR,
    ))),
    T.StructField("unmapped_source_columns", T.ArrayType(STR)),
    T.StructField("missing_common_fields", T.ArrayType(STR)),
    T.StructField("overall_notes", STR),
])


def as_common(df: DataFrame) -> DataFrame:
    """Project onto the common shot schema by name and type; a missing column is an error."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in COMMON])
