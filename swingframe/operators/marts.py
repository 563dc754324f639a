"""The club gapping mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.functions.cleaning import surrogate_key
from swingframe.operators.joins import lookup

QUANTILE_ACCURACY = 10_000


def named_shots(facts: DataFrame, clubs: DataFrame, players: DataFrame) -> DataFrame:
    """Fact rows with a carry, under the names their keys stand for; a key without a
    dimension row drops the shot."""
    measured = facts.where(F.col("carry_yards").isNotNull()).select(
        "source", "carry_method", "player_key", "club_key", "shot_id",
        "carry_yards", "total_yards", "side_dispersion")
    club_names = clubs.select("club_key", F.col("club_type").alias("club"))
    named = lookup(measured, club_names, ["club_key"], "inner")
    return lookup(
        named, players.select("player_key", "player"), ["player_key"], "inner",
    ).select("source", "carry_method", "player", "club", "carry_yards", "total_yards", "side_dispersion")


def one_decimal(c: Column) -> Column:
    """Round an average to 0.1. The order in which partial sums meet moves an average in
    its last bits, which would decide an exact half; a first rounding takes that out."""
    return F.round(F.round(c, 9), 1)


def gapping_aggregate(shots: DataFrame) -> DataFrame:
    """Counts, means, spread and approximate quantiles; every part merges on the map side."""
    q = F.percentile_approx("carry_yards", [0.1, 0.5, 0.9], QUANTILE_ACCURACY)
    grouped = shots.groupBy("source", "carry_method", "player", "club").agg(
        F.count(F.lit(1)).alias("shot_count"),
        one_decimal(F.avg("carry_yards")).alias("avg_carry_yards"),
        q.alias("_q"),
        one_decimal(F.stddev_samp("carry_yards")).alias("carry_consistency_sd"),
        one_decimal(F.avg("total_yards")).alias("avg_total_yards"),
        one_decimal(F.avg(F.abs("side_dispersion"))).alias("avg_offline_yards"),
        one_decimal(F.avg("side_dispersion")).alias("avg_side_bias_yards"),
    )
    return grouped.select(
        "source", "carry_method", "player", "club", "shot_count", "avg_carry_yards",
        F.round(F.col("_q")[1], 1).alias("median_carry_yards"),
        F.round(F.col("_q")[0], 1).alias("carry_p10_yards"),
        F.round(F.col("_q")[2], 1).alias("carry_p90_yards"),
        "carry_consistency_sd", "avg_total_yards", "avg_offline_yards", "avg_side_bias_yards",
    )


def with_gaps(clubs: DataFrame) -> DataFrame:
    """Step in median carry down to the player's next-shorter club."""
    order = Window.partitionBy("source", "player").orderBy(F.desc("median_carry_yards"), "club")
    gap = F.col("median_carry_yards") - F.lead("median_carry_yards").over(order)
    return clubs.withColumn("gap_to_shorter_club_yards", F.round(gap, 1))


def agg_club_gapping(facts: DataFrame, clubs: DataFrame, players: DataFrame) -> DataFrame:
    mart = with_gaps(gapping_aggregate(named_shots(facts, clubs, players)))
    key = surrogate_key(F.col("source"), F.col("player"), F.col("club"))
    return mart.select(key.alias("gapping_key"), "*")
