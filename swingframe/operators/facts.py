"""The shot fact with point-in-time player and club keys."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.constants import MEASURES, UNKNOWN_CLUB, UNKNOWN_PLAYER
from swingframe.operators.joins import as_of_lookup, resolve_at_moments, lookup


def fct_shots(
    shots: DataFrame, sessions: DataFrame, players: DataFrame, clubs: DataFrame
) -> DataFrame:
    """One row per shot of a listed session.

    The moment is the session's date, one per source, so the interval condition is settled on
    the distinct (source, player) of the shots, joined to their versions by name: one row
    with the player's key and the keys of the clubs in their bag, a few dozen at most. Shots
    then need one equality lookup, and are read twice: for their keys and for themselves.
    """
    dates = sessions.select("source", "session_key", "session_date", "carry_method")
    seen = lookup(shots.select("source", "player").distinct(), dates.select("source", "session_date"), ["source"], "inner")
    club = F.struct(F.col("club_type").alias("club"), "club_key", "model_year")
    versions = players.select("player", "valid_from", "valid_to", "player_key", F.lit(None).alias("_club")).unionByName(
        clubs.select("player", "valid_from", "valid_to", F.lit(None).alias("player_key"), club.alias("_club")))
    keys_at = resolve_at_moments(seen, versions, ["player"], "session_date").groupBy("source", "player").agg(
        F.min("player_key").alias("_player_key"), F.collect_set("_club").alias("_bag"))
    listed = lookup(shots.drop("session_date"), dates, ["source"], "inner")
    keyed = lookup(listed, keys_at, ["source", "player"])
    own = F.get(F.filter("_bag", lambda c: c["club"] == F.col("club")), F.lit(0))
    keyed = keyed.withColumns({"_club_key": own["club_key"], "club_model_year": own["model_year"]})
    age = F.when(
        F.col("club_model_year").isNotNull(), F.year("session_date") - F.col("club_model_year"))
    return keyed.select(
        "shot_id", "source", "player", "club", "session_key", "session_date", "carry_method",
        F.coalesce("_player_key", F.lit(_hex(UNKNOWN_PLAYER))).alias("player_key"),
        F.coalesce("_club_key", F.lit(_hex(UNKNOWN_CLUB))).alias("club_key"),
        "club_model_year", *MEASURES, age.cast("bigint").alias("club_age_years"),
    )


def fct_shots_own_date(
    shots: DataFrame, sessions: DataFrame, players: DataFrame, clubs: DataFrame
) -> DataFrame:
    """The same keys resolved at each shot's own date where it has one."""
    dated = shots.join(
        sessions.select("source", "carry_method", F.col("session_date").alias("_listed")), "source",
    ).withColumn("session_date", F.coalesce("session_date", "_listed")).select(
        "shot_id", "source", "player", "club", "session_date", "carry_method")
    keyed = as_of_lookup(dated, players, ["player"], "session_date", ["player_key"])
    setups = clubs.withColumnRenamed("club_type", "club")
    keyed = as_of_lookup(keyed, setups, ["player", "club"], "session_date", ["club_key", "model_year"])
    return keyed.select(
        *dated.columns, F.coalesce("player_key", F.lit(_hex(UNKNOWN_PLAYER))).alias("player_key"),
        F.coalesce("club_key", F.lit(_hex(UNKNOWN_CLUB))).alias("club_key"),
        F.col("model_year").alias("club_model_year"))


def _hex(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()
