"""Dimensions: players and clubs as validity-dated versions, and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe.constants import OPEN_END
from swingframe.functions import cleaning as C
from swingframe.operators.joins import neighbour, lookup


def with_validity(df: DataFrame, keys: list[str]) -> DataFrame:
    """A version holds until the day before the next one; the last one is open."""
    open_end = F.lit(OPEN_END).cast("date")
    ends = F.coalesce(F.date_sub("_next", 1), open_end)
    return neighbour(df, keys, "valid_from", "valid_from", "_next").withColumns({
        "valid_to": ends, "is_current": ends == open_end}).drop("_next")


def dim_player(profiles: DataFrame) -> DataFrame:
    versions = with_validity(
        profiles.select(
            "player", "handicap_band", "age_band", "gender",
            F.col("effective_from").cast("date").alias("valid_from"),
        ),
        ["player"],
    )
    key = C.surrogate_key(F.col("player"), F.col("valid_from").cast("string"))
    return versions.select(key.alias("player_key"), "*")


def enrich_clubs(clubs: DataFrame, specs: DataFrame) -> DataFrame:
    """Reported clubs with stock specs; a custom club keeps what the player reported."""
    reported = clubs.select(
        "player", "club_type", "make", "model",
        C.safe_int(F.col("year")).alias("model_year"),
        C.parse_flag(F.col("is_custom")).alias("is_custom"),
        "reported_loft_deg", "reported_length_in",
        C.blank_to_null(F.col("reported_shaft")).alias("reported_shaft"),
        F.col("effective_from").cast("date").alias("valid_from"),
    )
    stock = specs.select(
        "make", "model", C.safe_int(F.col("year")).alias("model_year"), "club_type",
        "stock_loft_deg", "standard_length_in", "stock_shaft",
    )

    def pick(own: str, reference: str, name: str) -> Column:
        return F.when(F.col("is_custom"), F.col(own)).otherwise(F.col(reference)).alias(name)

    joined = lookup(reported, stock, ["make", "model", "model_year", "club_type"])
    return joined.select(
        "player", "club_type", "make", "model", "model_year", "is_custom",
        pick("reported_loft_deg", "stock_loft_deg", "loft_deg"),
        pick("reported_length_in", "standard_length_in", "length_in"),
        pick("reported_shaft", "stock_shaft", "shaft"),
        "valid_from",
    )


def dim_club(clubs: DataFrame, specs: DataFrame) -> DataFrame:
    versions = with_validity(enrich_clubs(clubs, specs), ["player", "club_type"])
    key = C.surrogate_key(F.col("player"), F.col("club_type"), F.col("valid_from").cast("string"))
    return versions.select(key.alias("club_key"), "*")


def dim_session(manifest: DataFrame) -> DataFrame:
    return manifest.select(
        F.md5("session_id").alias("session_key"), "session_id", "source",
        F.col("session_date").cast("date").alias("session_date"),
        "indoor_outdoor", "device", "carry_method", "ball_type",
    )
