"""Silver: one trusted shot table over all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.operators.conform import CONFORMERS


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def core_metric(df: DataFrame) -> DataFrame:
    return df.where(F.col("ball_speed_mph").isNotNull())


def silver_shots(raw: dict[str, DataFrame]) -> DataFrame:
    """Conform every source that is present and keep rows whose ball speed parsed."""
    return core_metric(union_sources([CONFORMERS[name](df) for name, df in raw.items()]))


def source_counts(shots: DataFrame) -> DataFrame:
    """Rows per source and the total (source `all`), in one pass."""
    per_source = shots.groupBy("source").agg(F.count(F.lit(1)).alias("shots"))
    total = per_source.agg(F.lit("all").alias("source"), F.sum("shots").alias("shots"))
    return per_source.unionByName(total)
