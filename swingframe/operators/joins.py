"""Join helpers that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.constants import OPEN_END


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    residual: Column | None = None,
) -> DataFrame:
    """Attach `table` (few rows per key) to `rows` on `keys`.

    An equi-join and no more: a table that turns out small is broadcast, and where a key owns
    many rows the adaptive planner splits its partition and reads the table's part once per
    piece. Nothing is copied for keys that are not hot.
    """
    value_columns = [c for c in table.columns if c not in keys]
    keyed = table.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *value_columns)
    match = residual if residual is not None else F.lit(True)
    for k in keys:
        left, right = F.col(k), F.col(f"_key_{k}")
        match = match & (left.eqNullSafe(right) if null_safe else left == right)
    return rows.join(keyed, match, how).select(*rows.columns, *value_columns)


def spread_out(df: DataFrame, *columns: str) -> DataFrame:
    """Hash the rows over all shuffle partitions ahead of a step that multiplies them.
    Without it the adaptive planner sizes partitions by the small input and hands the
    multiplied work to a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def neighbour(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, ahead: bool = True
) -> DataFrame:
    """Add `name`, the `value` of the next (or previous) row of the key by date `order`: one
    window over the versions of a key."""
    step = F.lead if ahead else F.lag
    return df.withColumn(name, step(value).over(Window.partitionBy(*keys).orderBy(order)))


def resolve_at_moments(seen: DataFrame, versions: DataFrame, on: list[str], moment: str) -> DataFrame:
    """Versions in force (inclusive window) at the moment of each row of `seen`, which holds
    the keys that occur, once each."""
    inside = F.col(moment).between(F.col("valid_from"), F.col("valid_to"))
    return lookup(seen, versions, on, "inner", residual=inside)


def as_of_lookup(
    rows: DataFrame, versions: DataFrame, on: list[str], moment: str, values: list[str],
    *, days: int = 30,
) -> DataFrame:
    """As-of left join: attach the `values` of the version whose validity window (inclusive)
    holds at each row's date, within equal keys `on`.

    Closed versions are listed under every `days`-wide bucket they touch, so a row meets
    the few versions of its key and bucket, not the key's whole history; open versions are
    one per key. Windows of a key must not overlap.
    """
    def bucket(c: Column) -> Column:
        return F.floor(F.datediff(c, F.lit("1970-01-01")) / days)

    open_end = F.lit(OPEN_END).cast("date")
    closed = versions.where((F.col("valid_to") < open_end) & (F.col("valid_to") >= F.col("valid_from"))).select(
        *on, *[F.col(v).alias(f"_closed_{v}") for v in values], F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        F.explode(F.sequence(bucket(F.col("valid_from")), bucket(F.col("valid_to")))).alias("_bucket"))
    still = versions.where(F.col("valid_to") >= open_end).select(
        *on, *[F.col(v).alias(f"_open_{v}") for v in values], F.col("valid_from").alias("_since"))
    at = F.col(moment)
    bucketed = rows.withColumn("_bucket", bucket(at))
    first = lookup(bucketed, closed, [*on, "_bucket"], residual=at.between(F.col("_from"), F.col("_to")))
    both = lookup(first, still, on, residual=at >= F.col("_since"))
    return both.select(*rows.columns, *[
        F.coalesce(F.col(f"_closed_{v}"), F.col(f"_open_{v}")).alias(v) for v in values])
