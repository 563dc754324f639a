"""Views of the given tables in the shapes the operators read.

Each view is a list of column texts that Spark and DuckDB read alike, so both
engines start from the same cells. Raw metrics are built from integers and cast to
fixed-decimal text; a share of cells is spoiled (`NaN`, blank, `abc`, sentinels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swingframe import constants as K
from swingframe.plans.registry import relation
from swingframe.sources import seeds

K_OF = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
CLUB_NAMES = ["Driver", "3 Wood", "4 Iron", "5 Iron", "6 Iron", "7 Iron", "8 Iron", "9 Iron",
              "Pitching Wedge", "Sand Wedge"]


def pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {seeds.sql_literal(v)}" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


def mix(a: int, b: int, mod: int, base: int = 0) -> str:
    """A spread-out integer in [base, base + mod)."""
    return f"({base} + (event_id * {a} + k * {b}) % {mod})"


def tenths(t: str) -> str:
    return f"concat(CAST(CAST(({t} - {t} % 10) / 10 AS BIGINT) AS STRING), '.', CAST({t} % 10 AS STRING))"


def signed(t: str, flip: int) -> str:
    return f"concat(CASE WHEN event_id % {flip} = 0 THEN '-' ELSE '' END, {tenths(t)})"


def spoiled(cell: str, shift: int) -> str:
    e = f"(event_id + {shift})"
    return (f"CASE WHEN {e} % 17 = 0 THEN 'NaN' WHEN {e} % 19 = 0 THEN '' "
            f"WHEN {e} % 23 = 0 THEN 'abc' ELSE {cell} END")


def spin(cell: str, shift: int) -> str:
    return f"CASE WHEN event_id % 29 = 0 THEN '-9999' ELSE {spoiled(cell, shift)} END"


def _lineage(source: str) -> list[str]:
    return [f"'{source}' AS _source", f"'{source}.csv' AS _source_file", "event_id AS _row_index"]


CLUB_CELL = pick("CAST(event_id % 10 AS INT)", CLUB_NAMES)
# Integer metrics, each computed once per row ahead of the cell texts.
METRICS = {
    "m_ball": mix(37, 11, 1300, 600), "m_speed": mix(41, 7, 600, 600), "m_smash": mix(43, 5, 90, 10),
    "m_launch": mix(47, 3, 350), "m_spin": mix(53, 17, 10000, 1000), "m_carry": mix(59, 19, 4200, 500),
    "m_total": mix(59, 19, 4200, 600), "m_side": mix(61, 23, 400), "m_axis": mix(67, 29, 300),
    "m_direction": mix(71, 31, 80), "c_ball": mix(37, 11, 500, 300), "c_carry": mix(59, 19, 2000, 300),
    "c_distance": mix(59, 19, 2000, 350), "c_side": mix(61, 23, 300), "c_spinside": mix(61, 23, 9000),
}
BALL, SPEED, CARRY, TOTAL = tenths("m_ball"), tenths("m_speed"), tenths("m_carry"), tenths("m_total")
SMASH, SPIN = "concat('1.', CAST(m_smash AS STRING))", "CAST(m_spin AS STRING)"
LAUNCH, SIDE = signed("m_launch", 9), signed("m_side", 2)
AXIS, DIRECTION = signed("m_axis", 3), signed("m_direction", 5)
PLAYER = "concat('Player ', CAST(user_id % 30 AS STRING))"

# {stamp24}, {stamp12} and {folder} are the only dialect-specific texts.
RAW_COLUMNS = {
    "trackman": ("error", _lineage("trackman") + [
        f"{CLUB_CELL} AS club", f"{spoiled(BALL, 0)} AS ball_speed", f"{spoiled(SPEED, 1)} AS club_speed",
        f"{spoiled(SMASH, 2)} AS smash_factor", f"{spoiled(LAUNCH, 3)} AS launch_angle",
        f"{spin(SPIN, 4)} AS spin_rate", f"{spoiled(CARRY, 5)} AS carry_flat_length",
        f"{spoiled(TOTAL, 6)} AS total", f"{spoiled(SIDE, 7)} AS side_total",
        f"{spoiled(AXIS, 8)} AS spin_axis", f"{spoiled(DIRECTION, 9)} AS launch_direction",
    ]),
    "foresight": ("click", _lineage("foresight") + [
        f"CASE WHEN event_id % 31 = 0 THEN '' ELSE {PLAYER} END AS player",
        f"{CLUB_CELL} AS club_type",
        "CASE WHEN event_id % 37 = 0 THEN 'no date' WHEN event_id % 2 = 0 THEN {stamp24} ELSE {stamp12} END AS date",
        f"{spoiled(BALL, 0)} AS ball_speed", f"{spoiled(SPEED, 1)} AS club_speed",
        f"{spoiled(SMASH, 2)} AS smash_factor", f"{spoiled(LAUNCH, 3)} AS launch_angle",
        f"{spin(SPIN, 4)} AS spin_rate", f"{spoiled(CARRY, 5)} AS carry_distance",
        f"{spoiled(TOTAL, 6)} AS total_distance", f"{spoiled(SIDE, 7)} AS total_deviation_distance",
        f"{spoiled(AXIS, 8)} AS spin_axis", f"{spoiled(DIRECTION, 9)} AS launch_direction",
    ]),
    "flightscope": ("view", [
        "'flightscope' AS _source",
        "CASE WHEN event_id % 41 = 0 THEN 'range/undated.csv' ELSE concat('range/', {folder}, '/shots.csv') END AS _source_file",
        "event_id AS _row_index",
        pick("CAST(event_id % 9 AS INT)",
             ["Driver", "3W", "5W", "6I", "7I", "PW", "GW", "SW", "Putter"]) + " AS club",
        f"{spoiled(BALL, 0)} AS ball_speed_mph", f"{spoiled(SPEED, 1)} AS club_speed_mph",
        f"{spoiled(SMASH, 2)} AS smash", f"{spoiled(LAUNCH, 3)} AS launch_angle_v",
        f"{spin(SPIN, 4)} AS spin_rpm", f"{spoiled(CARRY, 5)} AS carry_distance_yds",
    ]),
    "manual": ("signup", _lineage("manual") + [
        f"CASE WHEN event_id % 31 = 0 THEN '' ELSE {PLAYER} END AS player", f"{CLUB_CELL} AS club",
        "CASE WHEN event_id % 5 = 0 THEN '' ELSE {folder} END AS session_date",
        f"{spoiled(BALL, 0)} AS ball_speed_mph", f"{spoiled(SPEED, 1)} AS club_speed_mph",
        f"{spoiled(SMASH, 2)} AS smash_factor", f"{spoiled(LAUNCH, 3)} AS launch_angle_deg",
        f"{spin(SPIN, 4)} AS spin_rate_rpm", f"{spoiled(CARRY, 5)} AS carry_yards",
        f"{spoiled(TOTAL, 6)} AS total_yards", f"{spoiled(SIDE, 7)} AS side_dispersion",
        f"{spoiled(AXIS, 8)} AS spin_axis_deg", f"{spoiled(DIRECTION, 9)} AS launch_direction_deg",
    ]),
    # Every camera shot appears in two views with the same physics.
    "caddieset": ("purchase", [
        "'caddieset' AS _source", "'caddieset.csv' AS _source_file",
        "2 * event_id + view_no AS _row_index",
        "CAST(user_id % 30 AS STRING) AS golferid",
        pick("CAST(event_id % 9 AS INT)",
             ["W1", "W3", "I4", "I5", "I6", "I7", "I8", "I9", "PT"]) + " AS clubtype",
        f"{spoiled(tenths("c_ball"), 0)} AS ballspeed",
        f"{spoiled(tenths("c_carry"), 1)} AS carry",
        f"{spoiled(tenths("c_distance"), 2)} AS distance",
        f"{spoiled(signed("c_side", 2), 3)} AS lrdistanceout",
        f"{spoiled(SPIN, 4)} AS spinback", f"{spoiled(signed("c_spinside", 2), 5)} AS spinside",
        f"{spoiled(AXIS, 6)} AS spinaxis", f"{spoiled(DIRECTION, 7)} AS directionangle",
    ]),
}
SPARK_DIALECT = {
    "stamp24": "date_format(ts, 'M/d/yy H:mm:ss')",
    "stamp12": "date_format(ts, 'MM/dd/yy hh:mm:ss a')",
    "folder": "date_format(ts, 'yyyy-MM-dd')",
}
DUCK_DIALECT = {
    "stamp24": "strftime(ts, '%-m/%-d/%y %-H:%M:%S')",
    "stamp12": "strftime(ts, '%m/%d/%y %I:%M:%S %p')",
    "folder": "strftime(ts, '%Y-%m-%d')",
}


def _texts(source: str, dialect: dict[str, str]) -> list[str]:
    texts = RAW_COLUMNS[source][1]
    for token, text in dialect.items():
        texts = [t.replace("{" + token + "}", text) for t in texts]
    return texts


relation("events_k", f"SELECT *, {K_OF} AS k FROM events")
relation("event_metrics", "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in METRICS.items()) + " FROM events_k")
for _source, (_type, _) in RAW_COLUMNS.items():
    _views = ", (VALUES (0), (1)) AS v(view_no)" if _source == "caddieset" else ""
    relation(f"{_source}_raw",
             f"SELECT {', '.join(_texts(_source, DUCK_DIALECT))} FROM event_metrics{_views} "
             f"WHERE event_type = '{_type}'")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number out of `props`."""
    return read(spark, folder, "events").selectExpr("*", f"{K_OF} AS k")


def event_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return read_events(spark, folder).selectExpr("*", *[f"{e} AS {n}" for n, e in METRICS.items()])


def raw_source(
    spark: SparkSession, folder: str, source: str, metrics: DataFrame | None = None
) -> DataFrame:
    kind, _ = RAW_COLUMNS[source]
    events = (metrics or event_metrics(spark, folder)).where(f"event_type = '{kind}'")
    if source == "caddieset":
        events = events.selectExpr("*", "explode(array(0, 1)) AS view_no")
    return events.selectExpr(*_texts(source, SPARK_DIALECT))


def raw_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    metrics = event_metrics(spark, folder)
    return {source: raw_source(spark, folder, source, metrics) for source in K.SOURCES}


# ---- dimension inputs from orders and part ------------------------------
OWNER = ("concat(CASE WHEN o_custkey % 4 = 3 THEN 'Golfer ' ELSE 'Player ' END, "
         "CAST(o_custkey % 30 AS STRING))")
EFFECTIVE = "CAST(CAST(o_orderdate AS DATE) + 9000 AS STRING)"
UNKNOWN_PROFILE = ("unknown", "unknown", "unknown", "unknown", "1900-01-01")
PROFILE_SQL = f"""
SELECT player, {pick("CAST(id % 4 AS INT)", ["low (5-9)", "mid (10-18)", "high (19+)", "scratch"])} AS handicap_band,
       {pick("CAST(id % 5 AS INT)", ["20-29", "30-39", "40-49", "50-59", "60+"])} AS age_band,
       CASE WHEN id % 3 = 0 THEN 'F' ELSE 'M' END AS gender, effective_from
FROM (SELECT {OWNER} AS player, {EFFECTIVE} AS effective_from, min(o_orderkey) AS id
      FROM orders GROUP BY 1, 2) AS p
UNION ALL SELECT 'unknown', 'unknown', 'unknown', 'unknown', '1900-01-01'
"""
CLUBS_SQL = f"""
SELECT player, club_type, concat('Brand#', CAST(id % 25 AS STRING)) AS make,
       concat('M', CAST(id % 4 AS STRING)) AS model,
       CASE WHEN id % 13 = 0 THEN '' ELSE CAST(2015 + id % 10 AS STRING) END AS year,
       CASE WHEN id % 11 = 0 THEN 'true' WHEN id % 11 = 1 THEN 'TRUE' ELSE 'false' END AS is_custom,
       CAST(id % 300 AS DOUBLE) / 1e1 AS reported_loft_deg,
       CAST(35 + id % 10 AS DOUBLE) AS reported_length_in,
       CASE WHEN id % 2 = 0 THEN '' ELSE 'Custom S' END AS reported_shaft, effective_from
FROM (SELECT {OWNER} AS player, {pick("CAST(o_orderkey % 10 AS INT)", CLUB_NAMES)} AS club_type,
             {EFFECTIVE} AS effective_from, min(o_orderkey) AS id
      FROM orders GROUP BY 1, 2, 3) AS c
UNION ALL
SELECT 'unknown', name, 'unknown', 'unknown', '', 'false', NULL, NULL, '', '1900-01-01'
FROM (VALUES ('unknown'), {",".join(f"('{n}')" for n in CLUB_NAMES)}) AS u(name)
"""
SPECS_SQL = f"""
SELECT make, model, year, club_type, CAST(id % 300 AS DOUBLE) / 1e1 + 5e0 AS stock_loft_deg,
       CAST(34 + id % 12 AS DOUBLE) AS standard_length_in,
       concat('Stock ', CAST(id % 3 AS STRING)) AS stock_shaft
FROM (SELECT p_brand AS make, concat('M', CAST(p_size % 4 AS STRING)) AS model,
             CAST(2015 + p_partkey % 10 AS STRING) AS year,
             {pick("CAST(p_partkey % 10 AS INT)", CLUB_NAMES)} AS club_type, min(p_partkey) AS id
      FROM part GROUP BY 1, 2, 3, 4) AS s
"""
MANIFEST_COLUMNS = ["source", "session_id", "session_date", "indoor_outdoor", "device",
                    "carry_method", "ball_type"]
relation("player_profiles", PROFILE_SQL)
relation("player_clubs", CLUBS_SQL)
relation("club_specs", SPECS_SQL)
relation("session_manifest",
         seeds.values_sql(MANIFEST_COLUMNS, [(s, *r) for s, r in K.SESSION_MANIFEST.items()]))


def _over(spark: SparkSession, folder: str, table: str, sql: str) -> DataFrame:
    """Run a shared text with one given table in place of its name."""
    return spark.sql(sql.replace(f"FROM {table}", "FROM {given}"), given=read(spark, folder, table))


def player_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return _over(spark, folder, "orders", PROFILE_SQL)


def player_clubs(spark: SparkSession, folder: str) -> DataFrame:
    return _over(spark, folder, "orders", CLUBS_SQL)


def club_specs(spark: SparkSession, folder: str) -> DataFrame:
    return _over(spark, folder, "part", SPECS_SQL)


# ---- landing clouds from events -----------------------------------------
LANDING_CLUBS = {"purchase": ("Driver", 2450), "click": ("3-wood", 2200), "view": ("5-iron", 1800),
                 "signup": ("7-iron", 1500), "error": ("PW", 1200)}
_CASE = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {{{i}}}" for i, t in enumerate(LANDING_CLUBS)) + " END"
LANDING_COLUMNS = [
    "concat('bag', CAST(user_id % 3 AS STRING)) AS bag_id",
    _CASE.format(*[f"'{c}'" for c, _ in LANDING_CLUBS.values()]) + " AS club",
    "CAST(" + _CASE.format(*[str(b) for _, b in LANDING_CLUBS.values()])
    + " + (event_id * 37 + k * 13) % 400 - 200 AS DOUBLE) / 1e1 AS carry",
    "CAST((event_id * 53 + k * 29) % 300 - 150 AS DOUBLE) / 1e1 AS lateral",
    "event_id AS ord",
]
relation("landings", f"SELECT {', '.join(LANDING_COLUMNS)} FROM events_k")


def landings(spark: SparkSession, folder: str) -> DataFrame:
    """`(bag_id, club, carry, lateral, ord)`, one row per event."""
    return read_events(spark, folder).selectExpr(*LANDING_COLUMNS)


# ---- typed shots from events --------------------------------------------
# Club labels as players write them; a third of the shots belong to one player.
SHOT_CLUBS = {"purchase": ("Driver", 1500, 2300), "click": ("3w", 1400, 2080), "view": ("5 Iron", 1200, 1700),
              "signup": ("7i", 1100, 1480), "error": ("pw", 900, 1180)}
_SHOT_CASE = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {{{i}}}" for i, t in enumerate(SHOT_CLUBS)) + " END"


def _unless(mod: int, expr: str) -> str:
    return f"CASE WHEN event_id % {mod} = 0 THEN CAST(NULL AS DOUBLE) ELSE {expr} END"


_B = _SHOT_CASE.format(*[str(v[1]) for v in SHOT_CLUBS.values()])
_C = _SHOT_CASE.format(*[str(v[2]) for v in SHOT_CLUBS.values()])
SHOT_COLUMNS = [
    "event_id AS ord", "md5(CAST(event_id AS STRING)) AS shot_id",
    "CASE WHEN event_id % 4 = 0 THEN 'foresight' ELSE 'trackman' END AS source",
    "CASE WHEN event_id % 4 = 0 THEN 'estimated' ELSE 'measured' END AS carry_method",
    "CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE concat('Player ', CAST(user_id % 7 AS STRING)) END AS player",
    _SHOT_CASE.format(*[f"'{v[0]}'" for v in SHOT_CLUBS.values()]) + " AS club",
    f"CASE WHEN event_id % 41 = 0 THEN 35e0 ELSE {_unless(17, f'CAST({_B} + (event_id * 37 + k * 11) % 260 - 130 AS DOUBLE) / 1e1')} END AS ball_speed_mph",
    "CAST(800 + (event_id * 41 + k * 7) % 300 AS DOUBLE) / 1e1 AS club_speed_mph",
    "CAST(120 + (event_id * 43 + k * 5) % 40 AS DOUBLE) / 1e2 AS smash_factor",
    _unless(19, "CAST(60 + (event_id * 47 + k * 3) % 140 AS DOUBLE) / 1e1") + " AS launch_angle_deg",
    _unless(23, "CAST(1400 + (event_id * 53 + k * 17) % 4000 AS DOUBLE)") + " AS spin_rate_rpm",
    _unless(29, f"CAST({_C} + (event_id * 59 + k * 19) % 320 - 160 AS DOUBLE) / 1e1") + " AS carry_yards",
    _unless(31, f"CAST({_C} + (event_id * 59 + k * 19) % 320 AS DOUBLE) / 1e1") + " AS total_yards",
    _unless(37, "CAST((event_id * 61 + k * 23) % 400 - 200 AS DOUBLE) / 1e1") + " AS side_dispersion",
    _unless(5, "CAST((event_id * 67 + k * 29) % 300 - 150 AS DOUBLE) / 1e1") + " AS spin_axis_deg",
    _unless(7, "CAST((event_id * 71 + k * 31) % 80 - 40 AS DOUBLE) / 1e1") + " AS launch_direction_deg",
]
relation("typed_shots", f"SELECT {', '.join(SHOT_COLUMNS)} FROM events_k")


def typed_shots(spark: SparkSession, folder: str) -> DataFrame:
    return read_events(spark, folder).selectExpr(*SHOT_COLUMNS)
