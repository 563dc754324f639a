"""Scores of shots and of landing clouds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import strokes as S
from swingframe.operators.bags import recentre


def score_positions(df: DataFrame, distance: str = "distance", lie: str = "lie") -> DataFrame:
    return df.withColumn("expected_strokes", S.expected_strokes(F.col(distance), F.col(lie)))


def score_shots(df: DataFrame) -> DataFrame:
    """Strokes gained per row of (start_distance, start_lie, end_distance, end_lie, penalty)."""
    return df.withColumn("strokes_gained", S.strokes_gained(
        F.col("start_distance"), F.col("start_lie"), F.col("end_distance"), F.col("end_lie"),
        F.col("penalty")))


def hole_out(
    clouds: DataFrame, keys: list[str], pin: str, *, use_lateral: bool = True,
    radius: float = K.PUTT_RADIUS_YARDS,
) -> DataFrame:
    """Expected strokes to hole out over each cloud, this shot included: a putt within
    the radius, an approach from a clean lie outside it."""
    miss = F.col(pin) - F.col("carry")
    left = F.hypot(miss, F.col("lateral")) if use_lateral else F.abs(miss)
    on_green = F.col("_left") <= radius
    rest = F.when(on_green, S.putt_strokes(F.col("_left"))).otherwise(S.approach_strokes(F.col("_left")))
    return clouds.withColumn("_left", left).groupBy(*keys).agg(
        (1.0 + F.avg(rest)).alias("expected_strokes"),
        F.avg("_left").alias("mean_proximity_yards"),
        F.avg(on_green.cast("double")).alias("frac_on_green"))


def consistency_cost(clouds: DataFrame, stock: DataFrame, sigma: float = K.BENCHMARK_SIGMA) -> DataFrame:
    """Per club, strokes lost to distance spread: the cloud at its stock distance against
    the same cloud tightened to `sigma`. Lateral is left out on purpose."""
    keys = ["bag_id", "club"]
    placed = recentre(clouds, keys, stock, target="stock_yards")
    spread = clouds.groupBy(*keys).agg(F.stddev_pop("carry").alias("_spread"))
    facts = stock.join(spread, keys).select(*keys, "stock_yards", "_spread")
    rows = placed.select(*keys, "carry").join(facts, keys)
    tight = F.col("stock_yards") + (F.col("carry") - F.col("stock_yards")) * F.coalesce(
        F.lit(sigma) / F.nullif(F.col("_spread"), F.lit(0.0)), F.lit(1.0))
    both = rows.select(*keys, "stock_yards", F.explode(F.array(
        F.struct(F.lit("own").alias("which"), F.col("carry").alias("carry")),
        F.struct(F.lit("tight").alias("which"), tight.alias("carry")))).alias("v")).select(
        *keys, "stock_yards", "v.which", "v.carry")
    scored = hole_out(both, [*keys, "stock_yards", "which"], "stock_yards", use_lateral=False)
    return scored.groupBy(*keys, "stock_yards").agg(
        F.max(F.when(F.col("which") == "own", F.col("expected_strokes"))).alias("own_strokes"),
        F.max(F.when(F.col("which") == "tight", F.col("expected_strokes"))).alias("tight_strokes"),
    ).withColumn("gap", F.col("own_strokes") - F.col("tight_strokes"))


def mean_gap(costs: DataFrame) -> DataFrame:
    return costs.groupBy("bag_id").agg(F.avg("gap").alias("mean_gap"), F.count(F.lit(1)).alias("clubs"))
