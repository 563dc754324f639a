"""Bronze to gold as lazy frames over the given tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from swingframe.operators import conform, contracts, dims, facts, marts, silver
from swingframe.plans import tables
from swingframe.session import written
from swingframe.sources import seeds


@dataclass(frozen=True)
class Star:
    shots: DataFrame
    players: DataFrame
    clubs: DataFrame
    sessions: DataFrame
    facts: DataFrame

    @property
    def gapping(self) -> DataFrame:
        return marts.agg_club_gapping(self.facts, self.clubs, self.players)


def staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        f"stg_{name}": conform.CONFORMERS[name](raw)
        for name, raw in tables.raw_sources(spark, folder).items()
    }


def star(spark: SparkSession, folder: str) -> Star:
    """The gold tables over a silver table and dimensions at rest: each given table is scanned
    once for them, whatever reads them afterwards."""
    shots = written(silver.silver_shots(tables.raw_sources(spark, folder)), "silver")
    players = written(dims.dim_player(tables.player_profiles(spark, folder)), "dim-player")
    clubs = written(dims.dim_club(tables.player_clubs(spark, folder), tables.club_specs(spark, folder)), "dim-club")
    sessions = dims.dim_session(seeds.session_manifest(spark))
    return Star(shots, players, clubs, sessions, facts.fct_shots(shots, sessions, players, clubs))


def checked_tables(spark: SparkSession, folder: str, rules: list[contracts.Contract]) -> DataFrame:
    """Every table from seeds to mart built from the tables before it, with all contracts counted
    on the way: those of a row while its table is written."""
    kept: dict[str, DataFrame] = {}
    counted: list[tuple] = []

    def add(name: str, df: DataFrame) -> DataFrame:
        kept[name], counts = contracts.write_counted(df, name, rules, written)
        counted.extend(counts)
        return kept[name]

    add("session_manifest", seeds.session_manifest(spark))
    profiles = add("player_profiles", tables.player_profiles(spark, folder))
    owned = add("player_clubs", tables.player_clubs(spark, folder))
    specs = add("club_specs", tables.club_specs(spark, folder))
    staged = [add(name, df) for name, df in staging(spark, folder).items()]
    shots = add("silver_shots", silver.core_metric(silver.union_sources(staged)))
    players, clubs = add("dim_player", dims.dim_player(profiles)), add("dim_club", dims.dim_club(owned, specs))
    sessions = add("dim_session", dims.dim_session(kept["session_manifest"]))
    mart = add("fct_shots", facts.fct_shots(shots, sessions, players, clubs))
    add("agg_club_gapping", marts.agg_club_gapping(mart, clubs, players))
    return contracts.judged(kept, rules, counted)
