"""Exact interpolated percentiles and row positions, with no more than a stated number of rows
ordered in one task.

Spark's exact `percentile` keeps a count of every distinct value of a group in one
aggregation buffer, which a hot group of measured doubles outgrows. Here values are counted
and the counts written once. Groups of BOUND different values at most are ordered as they
are. A larger group is cut at approximate quantiles of its own values; only the parts that hold a
wanted rank are kept, and cut again while one has more than BOUND different values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.session import written

BOUND = 1_000_000  # different values ordered in one task
CUTS = 64  # parts that one pass cuts a part into
ACCURACY = 10_000


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """How often each non-null value occurs in its group, `(keys, _v, _n)`."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))


def wanted_ranks(probs: list[float], total: Column) -> Column:
    """Positions from 0 between which the percentiles lie."""
    edges = [edge(p * (total - 1)).cast("bigint") for p in probs for edge in (F.floor, F.ceil)]
    return F.array_distinct(F.array(*edges))


def _match(keys: list[str], left: str, right: str) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return match


def narrowed(counts: DataFrame, keys: list[str], probs: list[float], bound: int) -> DataFrame:
    """The counted values of the parts that hold a wanted rank, `(keys, _part, _before, _total, _ranks, _v, _n)`, each
    part with `bound` different values at most. `_before` values of the group lie below its part."""
    group = [F.col(k) for k in keys] or [F.lit(0)]
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    if keys:
        parts = counts.alias("c").join(totals.alias("t"), _match(keys, "c", "t")).select("c.*", "t._total")
    else:
        parts = counts.withColumn("_total", totals.scalar())
    parts = parts.withColumns({"_part": F.lit(0).cast("bigint"), "_before": F.lit(0).cast("bigint"), "_ranks": wanted_ranks(probs, F.col("_total"))})
    while True:
        parts = written(parts, "percentile-parts")
        sizes = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_values"))
        large = sizes.where(F.col("_values") > bound)
        if large.isEmpty():
            return parts
        cuts = parts.alias("c").join(large.alias("t"), _match([*keys, "_part"], "c", "t")).select("c.*").groupBy(*keys, "_part").agg(
            F.array_distinct(F.percentile_approx("_v", [k / CUTS for k in range(1, CUTS)], ACCURACY)).alias("_cuts"))
        at = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_v"))), F.lit(0))
        cut = parts.alias("c").join(cuts.alias("t"), _match([*keys, "_part"], "c", "t"), "left").select("c.*", "t._cuts")
        cut = cut.withColumn("_piece", F.when(F.col("_cuts").isNotNull(), at).otherwise(0)).drop("_cuts")
        running = Window.partitionBy(*group, "_part").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        pieces = cut.groupBy(*keys, "_part", "_piece").agg(
            F.sum("_n").alias("_size"), F.first("_before").alias("_start"), F.first("_ranks").alias("_all"))
        pieces = pieces.withColumn("_from", F.col("_start") + F.coalesce(F.sum("_size").over(running), F.lit(0)))
        inside = F.filter("_all", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_size")))
        pieces = pieces.withColumn("_held", inside).where(F.size("_held") > 0)
        kept = cut.alias("c").join(pieces.alias("t"), _match([*keys, "_part", "_piece"], "c", "t"))
        parts = kept.select(*[f"c.{k}" for k in keys], "c._v", "c._n", "c._total",
                            (F.col("c._part") * CUTS + F.col("c._piece")).alias("_part"),
                            F.col("t._from").alias("_before"), F.col("t._held").alias("_ranks"))


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], *,
    count: str | None = None, bound: int = BOUND,
) -> DataFrame:
    """One row per group with a column per entry of `probs` (linear interpolation), and the
    number of values as `count` if named.

    Null values are ignored and a group without values has no row. `bound` is the number of
    different values that one task may order; any bound gives the same result.
    """
    counts = written(value_counts(df, keys, value), "value-counts")
    group = [F.col(k) for k in keys] or [F.lit(0)]
    largest = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values")).agg(F.max("_values")).first()[0] or 0
    if largest <= bound:
        whole = Window.partitionBy(*group)
        parts = counts.withColumn("_total", F.sum("_n").over(whole)).withColumns({
            "_before": F.lit(0), "_ranks": wanted_ranks(list(probs.values()), F.col("_total"))})
        inside = whole.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        parts = narrowed(counts, keys, list(probs.values()), bound)
        inside = Window.partitionBy(*group, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = parts.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside)).withColumn("_r", F.explode(F.filter(
        "_ranks", lambda r: (r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto")))))

    def at(p: float) -> Column:
        position = p * (F.col("_total") - 1)
        low = F.max(F.when(F.col("_r") == F.floor(position), F.col("_v")))
        high = F.max(F.when(F.col("_r") == F.ceil(position), F.col("_v")))
        share = F.max(position - F.floor(position))
        return low + (high - low) * share

    sizes = [F.max("_total").alias(count)] if count else []
    return found.groupBy(*keys).agg(*[at(p).alias(name) for name, p in probs.items()], *sizes)


def exact_median(
    df: DataFrame, keys: list[str], value: str, name: str = "median", *, bound: int = BOUND
) -> DataFrame:
    return exact_percentiles(df, keys, value, {name: 0.5}, bound=bound)


def ordinal_rank(df: DataFrame, keys: list[str], order: str, *, block: int = 100_000) -> DataFrame:
    """0-based position `rank` of each row in its group by a unique integer column,
    and the group size `size`.

    The order column is cut into blocks; a running sum over the block counts gives
    each block's first position and only one block is numbered per task, so at most
    `block` rows are ordered together however large the group is.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    group = [F.col(k) for k in keys] or [F.lit(0)]
    running = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_first", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
        .withColumn("size", F.sum("_rows").over(Window.partitionBy(*group)))
        .drop("_rows")
    )
    match = F.col("r._block") == F.col("s._block")
    for k in keys:
        match = match & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    within = Window.partitionBy(*group, "_block").orderBy(order)
    return (
        blocked.alias("r").join(starts.alias("s"), match).select("r.*", "s._first", "s.size")
        .withColumn("rank", F.col("_first") + F.row_number().over(within) - 1)
        .drop("_block", "_first")
    )
