"""Piecewise-linear lookup against a table of knots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def knot_intervals(knots: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Knots `(keys, x, y)` to intervals `(keys, from_x, to_x, x0, y0, slope)` that
    cover the whole line, flat past both ends. A key's knots are few (a curve, a profile)."""
    order = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy(x)
    nxt, nxt_y = F.lead(x).over(order), F.lead(y).over(order)
    lines = knots.select(
        *keys, F.col(x).cast("double").alias("x0"), F.col(y).cast("double").alias("y0"),
        nxt.cast("double").alias("x1"), nxt_y.cast("double").alias("y1"),
        F.row_number().over(order).alias("at"))
    inner = lines.select(
        *keys, F.col("x0").alias("from_x"), F.coalesce("x1", F.lit(float("inf"))).alias("to_x"),
        "x0", "y0", F.coalesce((F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0")), F.lit(0.0)).alias("slope"))
    before = lines.where("at = 1").select(
        *keys, F.lit(float("-inf")).alias("from_x"), F.col("x0").alias("to_x"), "x0", "y0",
        F.lit(0.0).alias("slope"))
    return inner.unionByName(before)


def interpolate(
    df: DataFrame, knots: DataFrame, keys: list[str], at: str, out: str,
    knot_x: str = "x", knot_y: str = "y", default: float | None = None,
) -> DataFrame:
    """Add `out`, the knot table's value at column `at`; rows whose key has no knots get
    `default`. Equality on the key with the interval as a residual gives one match per row."""
    pieces = knot_intervals(knots, keys, knot_x, knot_y).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "from_x", "to_x", "x0", "y0", "slope")
    match = (F.col(at) >= F.col("from_x")) & (F.col(at) < F.col("to_x"))
    for k in keys:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    value = F.col("y0") + F.when(F.col("slope") == 0.0, 0.0).otherwise(
        F.col("slope") * (F.col(at) - F.col("x0")))
    joined = df.join(pieces, match, "left")
    filled = F.coalesce(value, F.lit(default)) if default is not None else value
    return joined.select(*df.columns, filled.alias(out))
