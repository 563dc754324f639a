"""Per-source conformers: raw string table to the common shot schema.

Every conformer is one projection (the camera source adds one grouping for its
duplicated views), so it stays inside the scan's stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe.constants import HEADER_ALIASES, MEASURES, SESSION_COLUMNS
from swingframe.functions import cleaning as C
from swingframe.functions import units as U
from swingframe.schemas import as_common


def _project(
    raw: DataFrame, columns: dict[str, str], player: Column, club: Column, date: Column
) -> DataFrame:
    """Common-schema projection from a {common name: raw column} map; a measure
    that is not in the map is a typed null. Cells are parsed in a projection of their
    own, so that later rules read a parsed value instead of parsing again."""
    typed = raw.select(
        C.shot_key(F.col("_source"), F.col("_row_index")).alias("shot_id"),
        F.col("_source").alias("source"),
        player.alias("player"), club.alias("club"), date.alias("session_date"),
        *[
            (C.clean_double(F.col(columns[m])) if m in columns else C.null_of("double")).alias(m)
            for m in MEASURES
        ],
    )
    return as_common(typed.withColumn("spin_rate_rpm", C.known_spin(F.col("spin_rate_rpm"))))


def conform_radar(raw: DataFrame) -> DataFrame:
    """Imperial radar export without player or date."""
    columns = {
        "ball_speed_mph": "ball_speed", "club_speed_mph": "club_speed",
        "smash_factor": "smash_factor", "launch_angle_deg": "launch_angle",
        "spin_rate_rpm": "spin_rate", "carry_yards": "carry_flat_length",
        "total_yards": "total", "side_dispersion": "side_total",
        "spin_axis_deg": "spin_axis", "launch_direction_deg": "launch_direction",
    }
    return _project(raw, columns, F.lit("unknown"), F.col("club"), C.null_of("date"))


def conform_stamped(raw: DataFrame) -> DataFrame:
    """Imperial export with player, club type and a stamp in one of two styles."""
    columns = {
        "ball_speed_mph": "ball_speed", "club_speed_mph": "club_speed",
        "smash_factor": "smash_factor", "launch_angle_deg": "launch_angle",
        "spin_rate_rpm": "spin_rate", "carry_yards": "carry_distance",
        "total_yards": "total_distance", "side_dispersion": "total_deviation_distance",
        "spin_axis_deg": "spin_axis", "launch_direction_deg": "launch_direction",
    }
    return _project(
        raw, columns, C.blank_to_null(F.col("player")), F.col("club_type"),
        C.date_of_stamp(F.col("date")),
    )


def conform_doppler(raw: DataFrame) -> DataFrame:
    """Imperial export with coded clubs and the session date in the file path."""
    columns = {
        "ball_speed_mph": "ball_speed_mph", "club_speed_mph": "club_speed_mph",
        "smash_factor": "smash", "launch_angle_deg": "launch_angle_v",
        "spin_rate_rpm": "spin_rpm", "carry_yards": "carry_distance_yds",
    }
    return _project(
        raw, columns, F.lit("unknown"), C.doppler_club(F.col("club")),
        C.date_in_path(F.col("_source_file")),
    )


def conform_manual(raw: DataFrame) -> DataFrame:
    """Personal sessions, landed with the common names already."""
    return _project(
        raw, {m: m for m in MEASURES}, C.blank_to_null(F.col("player")), F.col("club"),
        C.iso_date(F.col("session_date")),
    )


CAMERA_FINGERPRINT = [
    "golferid", "clubtype", "carry_m", "distance_m", "ballspeed_ms",
    "spinback_rpm", "spinside_rpm", "lr_m",
]


def first_view(df: DataFrame, fingerprint: list[str], order: str) -> DataFrame:
    """Keep the first row by `order` of every fingerprint.

    A minimum over a struct led by the order column merges on the map side, so a
    fingerprint shared by very many rows costs one row per task in the shuffle.
    """
    rest = [c for c in df.columns if c not in fingerprint and c != order]
    first = df.groupBy(*fingerprint).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return first.select(*fingerprint, "_first.*").select(df.columns)


def conform_camera(raw: DataFrame) -> DataFrame:
    """Metric camera export: one row per camera view, spin in two components."""
    metres = {
        "ballspeed_ms": "ballspeed", "carry_m": "carry", "distance_m": "distance",
        "lr_m": "lrdistanceout", "spinback_rpm": "spinback", "spinside_rpm": "spinside",
        "spin_axis_deg": "spinaxis", "launch_direction_deg": "directionangle",
    }
    typed = raw.select(
        "_row_index", "_source",
        F.coalesce("golferid", F.lit("")).alias("golferid"),
        F.coalesce("clubtype", F.lit("")).alias("clubtype"),
        F.struct(F.col("golferid").alias("golfer"), F.col("clubtype").alias("code")).alias("_as_read"),
        *[C.clean_double(F.col(old)).alias(new) for new, old in metres.items()],
    )
    shots = first_view(typed, CAMERA_FINGERPRINT, "_row_index")
    return as_common(shots.select(
        C.shot_key(F.col("_source"), F.col("_row_index")).alias("shot_id"),
        F.col("_source").alias("source"),
        F.concat(F.lit("Golfer "), F.col("_as_read.golfer")).alias("player"),
        C.camera_club(F.col("_as_read.code")).alias("club"),
        C.null_of("date").alias("session_date"),
        U.mph_from_ms(F.col("ballspeed_ms")).alias("ball_speed_mph"),
        C.null_of("double").alias("club_speed_mph"),
        C.null_of("double").alias("smash_factor"),
        C.null_of("double").alias("launch_angle_deg"),
        U.total_spin(F.col("spinback_rpm"), F.col("spinside_rpm")).alias("spin_rate_rpm"),
        U.yards_from_metres(F.col("carry_m")).alias("carry_yards"),
        U.yards_from_metres(F.col("distance_m")).alias("total_yards"),
        U.yards_from_metres(F.col("lr_m")).alias("side_dispersion"),
        "spin_axis_deg", "launch_direction_deg",
    ))


CONFORMERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "trackman": conform_radar,
    "foresight": conform_stamped,
    "caddieset": conform_camera,
    "flightscope": conform_doppler,
    "manual": conform_manual,
}


def conform_headers(df: DataFrame) -> DataFrame:
    """Rename a personal export's recognised headers to the common names and drop
    the rest; where several headers mean one field the first non-empty cell wins."""
    fields = {alias: field for field, aliases in HEADER_ALIASES.items() for alias in aliases}
    found: dict[str, list[Column]] = {}
    for name in df.columns:
        field = fields.get(C.alias_form(name))
        if field:
            found.setdefault(field, []).append(df[f"`{name}`"])
    return df.select([
        F.coalesce(*[C.blank_to_null(c) for c in cells], cells[-1]).alias(field)
        for field, cells in found.items()
    ])


def session_rows(df: DataFrame, player: str) -> DataFrame:
    """A conformed personal session stamped with its owner: the 13 session columns,
    absent ones blank."""
    conformed = conform_headers(df)
    have = set(conformed.columns)
    return conformed.select([
        F.lit(player).alias(c) if c == "player"
        else (F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("")).alias(c)
        for c in SESSION_COLUMNS
    ])


def usable_rows() -> Column:
    """Aggregate: rows that carry a ball speed."""
    return F.count_if(F.trim(F.col("ball_speed_mph")) != "")
