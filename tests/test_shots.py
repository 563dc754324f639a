import datetime as dt

import pytest
from pyspark.sql import functions as F

from swingframe.functions import cleaning as C
from swingframe.functions import units as U
from swingframe.operators import conform, contracts, dims, facts, marts
from swingframe.schemas import COMMON
from swingframe.sources import seeds


def _values(spark, fn, cells):
    return [r[0] for r in spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").orderBy("i").select(fn(F.col("c"))).collect()]


def test_cells(spark):
    cells = ["12.5", " 7 ", "", "abc", "NaN", None, "1.5f", "2d", "1e3", "-9999"]
    assert _values(spark, C.clean_double, cells) == [12.5, 7.0, None, None, None, None, None, None, 1000.0, -9999.0]
    assert _values(spark, C.clean_spin, ["-9999", "0", "2500"]) == [None, 0.0, 2500.0]
    assert _values(spark, C.safe_int, ["2022", "", "x"]) == [2022, None, None]
    assert _values(spark, C.date_of_stamp, ["5/4/26 10:51:29", "05/23/26 08:28:38 AM", "05/23/26 08:28:38 PM", "no"]) == [
        dt.date(2026, 5, 4), dt.date(2026, 5, 23), dt.date(2026, 5, 23), None]
    assert _values(spark, C.date_in_path, ["range/2019-01-31/x.csv", "range/2019-13-31/x.csv", "range/x.csv"]) == [dt.date(2019, 1, 31), None, None]
    assert _values(spark, C.doppler_club, ["6I", "3W", "PW", "Driver", "Putter"]) == ["6 Iron", "3 Wood", "Pitching Wedge", "Driver", "Putter"]
    assert _values(spark, C.camera_club, ["W1", "I7", "P"]) == ["Driver", "7 Iron", "P"]
    assert _values(spark, C.bag_label, ["7i", "7 Iron", "#7iron", "pw", "Pitching Wedge", "3w", " Driver ", "60 deg"]) == [
        "7-iron", "7-iron", "7-iron", "PW", "PW", "3-wood", "Driver", "60 deg"]


def _raw(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {'bigint' if c == '_row_index' else 'string'}" for c in columns))


def test_camera_views_collapse_to_the_first(spark):
    columns = ["_source", "_source_file", "_row_index", "golferid", "clubtype", "ballspeed", "carry", "distance",
               "lrdistanceout", "spinback", "spinside", "spinaxis", "directionangle"]
    shot = ["3", "I7", "50", "100", "110", "-2", "3000", "400", "1", "2"]
    # One fingerprint holds most rows, as a hot key would.
    rows = [("caddieset", "f", i, *shot) for i in range(500)] + [("caddieset", "f", 900, "3", "I7", "51", *shot[3:])]
    out = conform.conform_camera(_raw(spark, rows, columns).repartition(4))
    assert out.schema.names == COMMON.names
    got = {r.ball_speed_mph: r for r in out.collect()}
    assert len(got) == 2
    first = got[111.85]
    assert first.player == "Golfer 3" and first.club == "7 Iron" and first.carry_yards == 109.4 and first.spin_rate_rpm == 3027.0
    assert first.shot_id == _raw(spark, rows, columns).where("_row_index = 0").select(
        C.shot_key(F.col("_source"), F.col("_row_index"))).first()[0]


def test_headers_conform_and_unknown_ones_drop(spark):
    df = _raw(spark, [("7 Iron", "115", "", "158", "x")], ["Club", "Ball Speed [mph]", "Carry", "Carry Distance", "Note"])
    row = conform.conform_headers(df).first()
    assert row.asDict() == {"club": "7 Iron", "ball_speed_mph": "115", "carry_yards": "158"}
    same = _raw(spark, [("Driver", "150")], ["club", "ball_speed_mph"])
    assert conform.conform_headers(same).collect() == same.collect()


def _shots(spark, rows):
    base = {f.name: None for f in COMMON}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], COMMON)


def _star(spark):
    profiles = spark.createDataFrame([
        ("unknown", "unknown", "unknown", "unknown", "1900-01-01"), ("Ann", "mid", "30-39", "F", "2015-01-01"),
        ("Ann", "low", "30-39", "F", "2025-01-01")], "player string, handicap_band string, age_band string, gender string, effective_from string")
    clubs = spark.createDataFrame([
        ("unknown", "unknown", "unknown", "unknown", "", "false", None, None, "", "1900-01-01"),
        ("Ann", "Driver", "Apex", "One", "2020", "false", None, None, "", "2015-01-01"),
        ("Ann", "Driver", "Apex", "Two", "2024", "TRUE", 9.0, 45.0, "X", "2025-06-01")],
        "player string, club_type string, make string, model string, year string, is_custom string, reported_loft_deg double, reported_length_in double, reported_shaft string, effective_from string")
    specs = spark.createDataFrame([("Apex", "One", "2020", "Driver", 10.5, 45.5, "Stock")],
                                  "make string, model string, year string, club_type string, stock_loft_deg double, standard_length_in double, stock_shaft string")
    return dims.dim_player(profiles), dims.dim_club(clubs, specs), dims.dim_session(seeds.session_manifest(spark))


def test_versions_and_enrichment(spark):
    players, clubs, _ = _star(spark)
    ann = sorted((r.valid_from, r.valid_to, r.is_current) for r in players.where("player = 'Ann'").collect())
    assert ann == [(dt.date(2015, 1, 1), dt.date(2024, 12, 31), False), (dt.date(2025, 1, 1), dt.date(9999, 12, 31), True)]
    drivers = {r.model: r for r in clubs.where("club_type = 'Driver'").collect()}
    assert (drivers["One"].loft_deg, drivers["One"].shaft) == (10.5, "Stock")
    assert (drivers["Two"].is_custom, drivers["Two"].loft_deg, drivers["Two"].shaft) == (True, 9.0, "X")


def test_fact_resolves_keys_at_the_session_date(spark):
    players, clubs, sessions = _star(spark)
    shots = _shots(spark, [
        {"shot_id": "a", "source": "trackman", "player": "Ann", "club": "Driver", "ball_speed_mph": 150.0, "carry_yards": 250.0},
        {"shot_id": "b", "source": "foresight", "player": "Ann", "club": "Driver", "ball_speed_mph": 150.0, "carry_yards": 240.0},
        {"shot_id": "c", "source": "manual", "player": "Stranger", "club": "7 Iron", "ball_speed_mph": 100.0},
        {"shot_id": "d", "source": "unlisted", "player": "Ann", "club": "Driver", "ball_speed_mph": 100.0}])
    facts_df = facts.fct_shots(shots, sessions, players, clubs)
    rows = {r.shot_id: r for r in facts_df.collect()}
    assert sorted(rows) == ["a", "b", "c"]  # a source without a session drops out
    key = {(r.player, str(r.valid_from)): r.player_key for r in players.collect()}
    assert rows["a"].player_key == key[("Ann", "2015-01-01")] and rows["b"].player_key == key[("Ann", "2025-01-01")]
    assert (rows["a"].club_model_year, rows["a"].club_age_years, rows["b"].club_model_year, rows["b"].club_age_years) == (2020, 4, 2024, 2)
    assert rows["c"].player_key == "8068118c" + rows["c"].player_key[8:] and rows["c"].player_key.endswith("43ec")
    assert rows["c"].club_age_years is None
    mart = marts.agg_club_gapping(facts_df, clubs, players).collect()
    assert {(r.source, r.player, r.club, r.shot_count) for r in mart} == {("trackman", "Ann", "Driver", 1), ("foresight", "Ann", "Driver", 1)}


def test_gap_is_down_to_the_next_shorter_club(spark):
    rows = [("s", "measured", "p", club, float(c), None, None) for club, c in (("Driver", 250), ("7 Iron", 150), ("PW", 110), ("7 Iron", 152), ("7 Iron", 148))]
    df = spark.createDataFrame(rows, "source string, carry_method string, player string, club string, carry_yards double, total_yards double, side_dispersion double")
    gaps = {r.club: r.gap_to_shorter_club_yards for r in marts.with_gaps(marts.gapping_aggregate(df)).collect()}
    assert gaps == {"Driver": 100.0, "7 Iron": 40.0, "PW": None}


def test_gate_counts_and_fails(spark):
    players, clubs, sessions = _star(spark)
    rules = [contracts.Contract("dim_player", "player", "not_null"), contracts.Contract("dim_player", "player", "unique"),
             contracts.Contract("dim_session", "carry_method", "accepted_values", ("measured",)),
             contracts.Contract("dim_club", "loft_deg", "between", (10, 12)),
             contracts.Contract("dim_club", "player", "relationships", ("dim_player", "player"))]
    result = contracts.gate({"dim_player": players, "dim_club": clubs, "dim_session": sessions}, rules)
    found = {(r.contract, r.table): r.violations for r in result.collect()}
    assert found[("not_null", "dim_player")] == 0 and found[("unique", "dim_player")] == 1
    assert found[("accepted_values", "dim_session")] == 3 and found[("between", "dim_club")] == 1
    assert found[("relationships", "dim_club")] == 0 and found[("one_current", "dim_player")] == 0
    with pytest.raises(contracts.ContractViolation, match="unique"):
        contracts.enforce(result)
    contracts.enforce(result.where("violations = 0"))
    assert len(contracts.ALL_CONTRACTS) == 84


def test_conditions(spark):
    row = spark.range(1).select(
        U.air_density(F.lit(15.0), F.lit(0.0)).alias("sea"), U.air_density(F.lit(15.0), F.lit(2000.0)).alias("high"),
        U.wind_downrange(F.lit(20.0), F.lit(0.0)).alias("head"), U.wind_lateral(F.lit(20.0), F.lit(90.0)).alias("right"),
        U.wind_class(F.lit(0.0), F.lit(0.0)).alias("calm"), U.wind_class(F.lit(9.0), F.lit(45.0)).alias("mixed"),
        U.wind_class(F.lit(9.0), F.lit(90.0)).alias("side"), U.wind_angle(F.lit(10.0), F.lit(350.0)).alias("angle")).first()
    assert abs(row.sea - 1.225) < 1e-3 and row.high < row.sea and row.head < 0 and row.right < 0
    assert (row.calm, row.mixed, row.side, row.angle) == ("calm", "into off the right", "off the right", 20.0)
