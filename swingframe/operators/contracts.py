"""Data contracts: each returns what breaks it, and one gate runs them all."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.operators.joins import neighbour
from swingframe.session import written


@dataclass(frozen=True)
class Contract:
    """One rule on a column. `args` holds the accepted values, the (low, high)
    bounds, or the (parent table, parent column) of a relationship."""

    table: str
    column: str
    kind: str  # not_null | unique | accepted_values | between | relationships
    args: tuple = ()


class ContractViolation(Exception):
    pass


def breaks(contract: Contract) -> Column:
    """Row predicate of a contract that looks at one row at a time; nulls pass all but not_null."""
    c = F.col(contract.column)
    if contract.kind == "not_null":
        return c.isNull()
    if contract.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*contract.args)
    if contract.kind == "between":
        low, high = contract.args
        return c.isNotNull() & ((c < low) | (c > high))
    raise ValueError(f"{contract.kind} is not a row contract")


def violating_rows(df: DataFrame, contract: Contract) -> DataFrame:
    return df.where(breaks(contract))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent row, with the number of child rows. Keys are counted before the
    join, so a hot key crosses it once; an outer join, as an anti join would be pushed below
    the count."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(field).alias("_field")).where("_field IS NOT NULL").distinct().withColumn("_known", F.lit(True))
    return keys.join(known, F.col(column) == F.col("_field"), "left").where("_known IS NULL").drop("_field", "_known")


def not_one_current(versions: DataFrame, entity: Column) -> DataFrame:
    """Entities whose number of current versions is not one."""
    return (
        versions.groupBy(entity.alias("entity"))
        .agg(F.count_if("is_current").alias("n_current")).where("n_current <> 1")
    )


def overlapping_windows(versions: DataFrame, entity: Column) -> DataFrame:
    """Versions that start before the previous version of the entity ends."""
    windows = versions.select(entity.alias("entity"), "valid_from", "valid_to")
    return (
        neighbour(windows, ["entity"], "valid_from", "valid_to", "prev_valid_to", ahead=False)
        .where("prev_valid_to >= valid_from").select("entity", "valid_from", "prev_valid_to")
    )


def club_entity() -> Column:
    return F.concat("player", F.lit(" / "), "club_type")


COUNTED = "contract string, `table` string, `column` string, violations bigint"


def row_contracts(table: str, contracts: list[Contract]) -> list[Contract]:
    return [c for c in contracts if c.table == table and c.kind not in ("unique", "relationships")]


def write_counted(df: DataFrame, table: str, contracts: list[Contract], write: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, list[tuple]]:
    """The table as `write` leaves it, and `(contract, table, column, violations)` of each of its row
    contracts, observed on the rows while they are written."""
    own = row_contracts(table, contracts)
    if not own:
        return write(df, table), []
    seen = Observation(f"{table}-{uuid.uuid4().hex}")
    kept = write(df.observe(seen, *[F.count_if(breaks(c)).alias(f"c{i}") for i, c in enumerate(own)]), table)
    return kept, [(c.kind, table, c.column, seen.get[f"c{i}"]) for i, c in enumerate(own)]


def gate(tables: dict[str, DataFrame], contracts: list[Contract], write: Callable[[DataFrame, str], DataFrame] = written) -> DataFrame:
    """(contract, table, column, violations) for every contract, plus the two version
    invariants over `dim_player` and `dim_club` where both are present.

    Every table is written first, and its row contracts are counted in that one pass. What takes
    several rows to judge is read from the tables at rest."""
    counted: list[tuple] = []
    kept: dict[str, DataFrame] = {}
    for table in dict.fromkeys([*(c.table for c in contracts), *(c.args[0] for c in contracts if c.kind == "relationships"),
                                *(t for t in ("dim_player", "dim_club") if t in tables)]):
        kept[table], counts = write_counted(tables[table], table, contracts, write)
        counted += counts
    return judged(kept, contracts, counted)


def judged(tables: dict[str, DataFrame], contracts: list[Contract], counted: list[tuple]) -> DataFrame:
    """The gate's table from written tables and the counts of their row contracts."""
    spark = next(iter(tables.values())).sparkSession
    parts: list[DataFrame] = [spark.createDataFrame(counted, COUNTED)] if counted else []

    def add(kind: str, table: str, column: str, count: DataFrame) -> None:
        parts.append(count.select(
            F.lit(kind).alias("contract"), F.lit(table).alias("table"),
            F.lit(column).alias("column"), F.col("violations")))

    for c in contracts:
        if c.kind == "unique":
            found = duplicates(tables[c.table], c.column)
            add(c.kind, c.table, c.column, found.agg(F.count(F.lit(1)).alias("violations")))
        elif c.kind == "relationships":
            found = orphans(tables[c.table], c.column, tables[c.args[0]], c.args[1])
            add(c.kind, c.table, c.column, found.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")))
    for table, entity in (("dim_player", F.col("player")), ("dim_club", club_entity())):
        if table in tables:
            for kind, check in (("one_current", not_one_current), ("no_overlap", overlapping_windows)):
                count = check(tables[table], entity).agg(F.count(F.lit(1)).alias("violations"))
                add(kind, table, "valid_from", count)
    return reduce(DataFrame.unionByName, parts)


def enforce(result: DataFrame) -> None:
    """Fail the run when any contract is broken; the table has one row per contract."""
    broken = result.where("violations > 0").collect()
    if broken:
        lines = [f"{r.contract}({r.table}.{r.column}): {r.violations}" for r in broken]
        raise ContractViolation("; ".join(sorted(lines)))


def _shot_contracts(table: str, not_null: list[str], ranges: list[str]) -> list[Contract]:
    bounds = {  # fixed ranges of plausible measurements
        "ball_speed_mph": (0, 250), "club_speed_mph": (0, 200), "smash_factor": (0, 2),
        "launch_angle_deg": (-20, 70), "spin_rate_rpm": (0, 16000), "carry_yards": (0, 450),
    }
    source = table.removeprefix("stg_")
    return [
        Contract(table, "shot_id", "not_null"), Contract(table, "shot_id", "unique"),
        Contract(table, "source", "accepted_values", (source,)),
        *[Contract(table, c, "not_null") for c in not_null],
        *[Contract(table, c, "between", bounds[c]) for c in ranges],
    ]


_CORE = ["ball_speed_mph", "spin_rate_rpm", "carry_yards"]
STAGING_CONTRACTS = [
    *_shot_contracts("stg_trackman", [], ["ball_speed_mph", "club_speed_mph", "smash_factor",
                                          "launch_angle_deg", "spin_rate_rpm", "carry_yards"]),
    *_shot_contracts("stg_caddieset", ["player"], _CORE),
    *_shot_contracts("stg_foresight", ["player", "session_date"],
                     ["ball_speed_mph", "smash_factor", "launch_angle_deg", "spin_rate_rpm", "carry_yards"]),
    *_shot_contracts("stg_flightscope", ["session_date"], _CORE),
    *_shot_contracts("stg_manual", ["player"], _CORE),
]
_METHODS = ("measured", "estimated")
SEED_CONTRACTS = [
    Contract("club_specs", "club_type", "not_null"),
    Contract("player_clubs", "player", "not_null"),
    Contract("player_clubs", "is_custom", "accepted_values", ("true", "false")),
    Contract("player_profiles", "player", "not_null"),
    Contract("session_manifest", "source", "not_null"),
    Contract("session_manifest", "source", "unique"),
    Contract("session_manifest", "carry_method", "accepted_values", _METHODS),
]
SILVER_CONTRACTS = [
    Contract("silver_shots", "shot_id", "not_null"), Contract("silver_shots", "shot_id", "unique"),
    Contract("silver_shots", "source", "not_null"),
    Contract("silver_shots", "source", "accepted_values", tuple(K.SOURCES)),
    Contract("silver_shots", "ball_speed_mph", "not_null"),
    Contract("silver_shots", "ball_speed_mph", "between", (0, 250)),
]
GOLD_CONTRACTS = [
    Contract("dim_player", "player_key", "not_null"), Contract("dim_player", "player_key", "unique"),
    Contract("dim_player", "player", "not_null"), Contract("dim_player", "valid_from", "not_null"),
    Contract("dim_player", "is_current", "not_null"),
    Contract("dim_club", "club_key", "not_null"), Contract("dim_club", "club_key", "unique"),
    Contract("dim_club", "player", "not_null"), Contract("dim_club", "club_type", "not_null"),
    Contract("dim_club", "is_custom", "not_null"),
    Contract("dim_session", "session_key", "not_null"), Contract("dim_session", "session_key", "unique"),
    Contract("dim_session", "carry_method", "not_null"),
    Contract("dim_session", "carry_method", "accepted_values", _METHODS),
    Contract("dim_session", "indoor_outdoor", "accepted_values", ("indoor", "outdoor")),
    Contract("fct_shots", "shot_id", "not_null"), Contract("fct_shots", "shot_id", "unique"),
    Contract("fct_shots", "player_key", "not_null"),
    Contract("fct_shots", "player_key", "relationships", ("dim_player", "player_key")),
    Contract("fct_shots", "club_key", "not_null"),
    Contract("fct_shots", "club_key", "relationships", ("dim_club", "club_key")),
    Contract("fct_shots", "session_key", "not_null"),
    Contract("fct_shots", "session_key", "relationships", ("dim_session", "session_key")),
    Contract("fct_shots", "carry_method", "accepted_values", _METHODS),
    Contract("agg_club_gapping", "gapping_key", "not_null"),
    Contract("agg_club_gapping", "gapping_key", "unique"),
    Contract("agg_club_gapping", "shot_count", "not_null"),
    Contract("agg_club_gapping", "shot_count", "between", (1, 100000)),
    Contract("agg_club_gapping", "median_carry_yards", "not_null"),
    Contract("agg_club_gapping", "median_carry_yards", "between", (0, 450)),
    Contract("agg_club_gapping", "carry_method", "accepted_values", _METHODS),
]
ALL_CONTRACTS = [*SEED_CONTRACTS, *STAGING_CONTRACTS, *SILVER_CONTRACTS, *GOLD_CONTRACTS]
