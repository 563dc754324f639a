"""Queries from raw exports to the gapping mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import cleaning as C
from swingframe.functions import units as U
from swingframe.operators import conform, contracts, dims, facts, marts, silver
from swingframe.operators.joins import as_of_lookup
from swingframe.plans import tables, warehouse
from swingframe.plans.registry import dround, query, relation
from swingframe.sources import seeds


def num(c: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"


def spin_num(c: str) -> str:
    return (f"CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) OR TRY_CAST({c} AS DOUBLE) < 0 THEN NULL "
            f"ELSE TRY_CAST({c} AS DOUBLE) END")


def staged(source: str, player: str, club: str, date: str, columns: dict[str, str]) -> str:
    measures = ", ".join(
        f"{(spin_num if m == 'spin_rate_rpm' else num)(columns[m])} AS {m}" if m in columns
        else f"CAST(NULL AS DOUBLE) AS {m}" for m in K.MEASURES)
    return (f"SELECT md5(concat(_source, '-', CAST(_row_index AS VARCHAR))) AS shot_id, _source AS source, "
            f"{player} AS player, {club} AS club, {date} AS session_date, {measures} FROM {source}_raw")


DOPPLER_CLUB = """CASE WHEN club = 'PW' THEN 'Pitching Wedge' WHEN club = 'GW' THEN 'Gap Wedge'
  WHEN club = 'SW' THEN 'Sand Wedge' WHEN club = 'LW' THEN 'Lob Wedge'
  WHEN regexp_matches(club, '^[0-9]+I$') THEN concat(regexp_extract(club, '^([0-9]+)I$', 1), ' Iron')
  WHEN regexp_matches(club, '^[0-9]+W$') THEN concat(regexp_extract(club, '^([0-9]+)W$', 1), ' Wood')
  ELSE club END"""
CAMERA_CLUB = ("CASE clubtype " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in K.CAMERA_CLUBS.items())
               + " ELSE clubtype END")
PATH_DATE = "TRY_CAST(nullif(regexp_extract(_source_file, '(\\d{4}-\\d{2}-\\d{2})', 1), '') AS DATE)"
STAMP_DATE = ("CAST(coalesce(try_strptime(date, '%m/%d/%y %H:%M:%S'), "
              "try_strptime(date, '%m/%d/%y %I:%M:%S %p')) AS DATE)")

relation("stg_trackman", staged("trackman", "'unknown'", "club", "CAST(NULL AS DATE)", {
    "ball_speed_mph": "ball_speed", "club_speed_mph": "club_speed", "smash_factor": "smash_factor",
    "launch_angle_deg": "launch_angle", "spin_rate_rpm": "spin_rate", "carry_yards": "carry_flat_length",
    "total_yards": "total", "side_dispersion": "side_total", "spin_axis_deg": "spin_axis",
    "launch_direction_deg": "launch_direction"}))
relation("stg_foresight", staged("foresight", "nullif(player, '')", "club_type", STAMP_DATE, {
    "ball_speed_mph": "ball_speed", "club_speed_mph": "club_speed", "smash_factor": "smash_factor",
    "launch_angle_deg": "launch_angle", "spin_rate_rpm": "spin_rate", "carry_yards": "carry_distance",
    "total_yards": "total_distance", "side_dispersion": "total_deviation_distance",
    "spin_axis_deg": "spin_axis", "launch_direction_deg": "launch_direction"}))
relation("stg_flightscope", staged("flightscope", "'unknown'", DOPPLER_CLUB, PATH_DATE, {
    "ball_speed_mph": "ball_speed_mph", "club_speed_mph": "club_speed_mph", "smash_factor": "smash",
    "launch_angle_deg": "launch_angle_v", "spin_rate_rpm": "spin_rpm", "carry_yards": "carry_distance_yds"}))
relation("stg_manual", staged("manual", "nullif(player, '')", "club",
                              "TRY_CAST(nullif(session_date, '') AS DATE)", {m: m for m in K.MEASURES}))
CAMERA_CELLS = {"ballspeed_ms": "ballspeed", "carry_m": "carry", "distance_m": "distance",
                "lr_m": "lrdistanceout", "spinback_rpm": "spinback", "spinside_rpm": "spinside",
                "spin_axis_deg": "spinaxis", "launch_direction_deg": "directionangle"}
relation("camera_clean", "SELECT _row_index, _source, golferid, clubtype, "
         + ", ".join(f"{num(o)} AS {n}" for n, o in CAMERA_CELLS.items()) + " FROM caddieset_raw")
relation("camera_first", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY golferid, clubtype, carry_m, distance_m,
  ballspeed_ms, spinback_rpm, spinside_rpm, lr_m ORDER BY _row_index) AS view_rank FROM camera_clean)
WHERE view_rank = 1""")
CAMERA_MEASURES = f"""{dround('ballspeed_ms * 2.2369362920544e0', 2)} AS ball_speed_mph,
  CAST(NULL AS DOUBLE) AS club_speed_mph, CAST(NULL AS DOUBLE) AS smash_factor,
  CAST(NULL AS DOUBLE) AS launch_angle_deg,
  {dround('sqrt(pow(spinback_rpm, 2) + pow(spinside_rpm, 2))', 0)} AS spin_rate_rpm,
  {dround('carry_m * 1.0936132983377e0', 1)} AS carry_yards,
  {dround('distance_m * 1.0936132983377e0', 1)} AS total_yards,
  {dround('lr_m * 1.0936132983377e0', 1)} AS side_dispersion"""
relation("stg_caddieset", f"""
SELECT md5(concat(_source, '-', CAST(_row_index AS VARCHAR))) AS shot_id, _source AS source,
  concat('Golfer ', golferid) AS player, {CAMERA_CLUB} AS club, CAST(NULL AS DATE) AS session_date,
  {CAMERA_MEASURES}, spin_axis_deg, launch_direction_deg FROM camera_first""")
relation("conformed", " UNION ALL ".join(f"SELECT * FROM stg_{s}" for s in K.SOURCES))
relation("silver_shots", "SELECT * FROM conformed WHERE ball_speed_mph IS NOT NULL")


def validity(keys: str) -> str:
    lead = f"lead(valid_from) OVER (PARTITION BY {keys} ORDER BY valid_from)"
    return f"coalesce(CAST({lead} - INTERVAL 1 DAY AS DATE), DATE '9999-12-31')"


relation("dim_player", f"""
SELECT md5(concat(player, '|', CAST(valid_from AS VARCHAR))) AS player_key, *,
  valid_to = DATE '9999-12-31' AS is_current
FROM (SELECT *, {validity('player')} AS valid_to FROM (
  SELECT player, handicap_band, age_band, gender, CAST(effective_from AS DATE) AS valid_from
  FROM player_profiles))""")
relation("clubs_enriched", """
SELECT c.player, c.club_type, c.make, c.model, c.model_year, c.is_custom,
  CASE WHEN c.is_custom THEN c.reported_loft_deg ELSE s.stock_loft_deg END AS loft_deg,
  CASE WHEN c.is_custom THEN c.reported_length_in ELSE s.standard_length_in END AS length_in,
  CASE WHEN c.is_custom THEN c.reported_shaft ELSE s.stock_shaft END AS shaft, c.valid_from
FROM (SELECT player, club_type, make, model, TRY_CAST(year AS BIGINT) AS model_year,
        lower(is_custom) = 'true' AS is_custom, reported_loft_deg, reported_length_in,
        nullif(reported_shaft, '') AS reported_shaft, CAST(effective_from AS DATE) AS valid_from
      FROM player_clubs) c
LEFT JOIN (SELECT make, model, TRY_CAST(year AS BIGINT) AS model_year, club_type, stock_loft_deg,
             standard_length_in, stock_shaft FROM club_specs) s
  ON c.make = s.make AND c.model = s.model AND c.model_year = s.model_year AND c.club_type = s.club_type""")
relation("dim_club", f"""
SELECT md5(concat(player, '|', club_type, '|', CAST(valid_from AS VARCHAR))) AS club_key, *,
  valid_to = DATE '9999-12-31' AS is_current
FROM (SELECT *, {validity('player, club_type')} AS valid_to FROM clubs_enriched)""")
relation("dim_session", """
SELECT md5(session_id) AS session_key, session_id, source, CAST(session_date AS DATE) AS session_date,
  indoor_outdoor, device, carry_method, ball_type FROM session_manifest""")
relation("fct_shots", f"""
SELECT s.shot_id, s.source, s.player, s.club, x.session_key, x.session_date, x.carry_method,
  coalesce(p.player_key, md5('unknown|1900-01-01')) AS player_key,
  coalesce(c.club_key, md5('unknown|unknown|1900-01-01')) AS club_key, c.model_year AS club_model_year,
  {', '.join('s.' + m for m in K.MEASURES)},
  CAST(CASE WHEN c.model_year IS NOT NULL THEN year(x.session_date) - c.model_year END AS BIGINT) AS club_age_years
FROM silver_shots s JOIN dim_session x ON s.source = x.source
LEFT JOIN dim_player p ON s.player = p.player AND x.session_date BETWEEN p.valid_from AND p.valid_to
LEFT JOIN dim_club c ON s.player = c.player AND s.club = c.club_type
  AND x.session_date BETWEEN c.valid_from AND c.valid_to""")
relation("mart_shots", """
SELECT f.source, f.carry_method, p.player, c.club_type AS club, f.carry_yards, f.total_yards, f.side_dispersion
FROM fct_shots f JOIN dim_club c ON f.club_key = c.club_key JOIN dim_player p ON f.player_key = p.player_key
WHERE f.carry_yards IS NOT NULL""")
relation("gap_groups", f"""
SELECT source, carry_method, player, club, count(*) AS shot_count,
  {dround('avg(carry_yards)', 1)} AS avg_carry_yards,
  {dround('quantile_disc(carry_yards, 0.5)', 1)} AS median_carry_yards,
  {dround('quantile_disc(carry_yards, 0.1)', 1)} AS carry_p10_yards,
  {dround('quantile_disc(carry_yards, 0.9)', 1)} AS carry_p90_yards,
  {dround('stddev_samp(carry_yards)', 1)} AS carry_consistency_sd,
  {dround('avg(total_yards)', 1)} AS avg_total_yards,
  {dround('avg(abs(side_dispersion))', 1)} AS avg_offline_yards,
  {dround('avg(side_dispersion)', 1)} AS avg_side_bias_yards
FROM mart_shots GROUP BY source, carry_method, player, club""")
relation("agg_club_gapping", f"""
SELECT md5(concat(source, '|', player, '|', club)) AS gapping_key, *,
  {dround('median_carry_yards - lead(median_carry_yards) OVER (PARTITION BY source, player ORDER BY median_carry_yards DESC, club)', 1)}
    AS gap_to_shorter_club_yards FROM gap_groups""")


# ---- cleaning -----------------------------------------------------------
# The cells of all sources under common names; a source without a player column has none.
RAW_CELLS = {
    "trackman": ("ball_speed", "carry_flat_length", "total", "spin_rate", None),
    "foresight": ("ball_speed", "carry_distance", "total_distance", "spin_rate", "player"),
    "flightscope": ("ball_speed_mph", "carry_distance_yds", None, "spin_rpm", None),
    "manual": ("ball_speed_mph", "carry_yards", "total_yards", "spin_rate_rpm", "player"),
    "caddieset": ("ballspeed", "carry", "distance", "spinback", "golferid"),
}
CELL_NAMES = ("ball_cell", "carry_cell", "total_cell", "spin_cell", "player_cell")
relation("raw_cells", " UNION ALL ".join(
    "SELECT _source, _row_index, " + ", ".join(f"{c or 'CAST(NULL AS VARCHAR)'} AS {n}" for c, n in zip(cells, CELL_NAMES))
    + f" FROM {source}_raw" for source, cells in RAW_CELLS.items()))


def raw_cells(spark, folder):
    raw = tables.raw_sources(spark, folder)
    return silver.union_sources([
        raw[source].select("_source", "_row_index", *[
            (F.col(c) if c else C.null_of("string")).alias(n) for c, n in zip(cells, CELL_NAMES)])
        for source, cells in RAW_CELLS.items()])


@query("safe_cast", """SELECT _source, _row_index, coalesce(isnan(TRY_CAST(ball_cell AS DOUBLE)), false) AS not_a_number,
  CASE WHEN NOT isnan(TRY_CAST(ball_cell AS DOUBLE)) THEN TRY_CAST(ball_cell AS DOUBLE) END AS ball_speed FROM raw_cells""")
def safe_cast(spark, folder):
    """Every cell of every source; NaN, which equals nothing, is told apart by a flag."""
    value = C.safe_double(F.col("ball_cell"))
    return raw_cells(spark, folder).select(
        "_source", "_row_index", F.coalesce(F.isnan(value), F.lit(False)).alias("not_a_number"), F.when(~F.isnan(value), value).alias("ball_speed"))


@query("nan_scrub", f"SELECT _source, _row_index, {num('carry_cell')} AS carry, {num('total_cell')} AS total FROM raw_cells")
def nan_scrub(spark, folder):
    return raw_cells(spark, folder).select(
        "_source", "_row_index", C.clean_double(F.col("carry_cell")).alias("carry"), C.clean_double(F.col("total_cell")).alias("total"))


@query("spin_sentinel", f"SELECT _source, _row_index, {spin_num('spin_cell')} AS spin_rate_rpm FROM raw_cells")
def spin_sentinel(spark, folder):
    return raw_cells(spark, folder).select("_source", "_row_index", C.clean_spin(F.col("spin_cell")).alias("spin_rate_rpm"))


@query("blank_to_null", "SELECT _source, _row_index, nullif(player_cell, '') AS player FROM raw_cells")
def blank_to_null(spark, folder):
    return raw_cells(spark, folder).select("_source", "_row_index", C.blank_to_null(F.col("player_cell")).alias("player"))


@query("metric_units", f"SELECT _row_index, {CAMERA_MEASURES} FROM camera_clean")
def metric_units(spark, folder):
    raw = tables.raw_source(spark, folder, "caddieset")
    cell = {n: C.clean_double(F.col(o)) for n, o in CAMERA_CELLS.items()}
    empty = [C.null_of("double").alias(m) for m in ("club_speed_mph", "smash_factor", "launch_angle_deg")]
    return raw.select(
        "_row_index", U.mph_from_ms(cell["ballspeed_ms"]).alias("ball_speed_mph"), *empty,
        U.total_spin(cell["spinback_rpm"], cell["spinside_rpm"]).alias("spin_rate_rpm"),
        U.yards_from_metres(cell["carry_m"]).alias("carry_yards"),
        U.yards_from_metres(cell["distance_m"]).alias("total_yards"),
        U.yards_from_metres(cell["lr_m"]).alias("side_dispersion"))


@query("derived_total_spin", f"""SELECT _row_index, spinback_rpm, spinside_rpm,
  {dround('sqrt(spinback_rpm * spinback_rpm + spinside_rpm * spinside_rpm)', 0)} AS spin_rate_rpm FROM camera_clean""")
def derived_total_spin(spark, folder):
    raw = tables.raw_source(spark, folder, "caddieset")
    back, side = C.clean_double(F.col("spinback")), C.clean_double(F.col("spinside"))
    return raw.select("_row_index", back.alias("spinback_rpm"), side.alias("spinside_rpm"),
                      U.total_spin(back, side).alias("spin_rate_rpm"))


@query("typed_null_columns", """SELECT shot_id, 'unknown' AS player, CAST(NULL AS DATE) AS session_date,
  CAST(NULL AS DOUBLE) AS total_yards FROM stg_flightscope""")
def typed_null_columns(spark, folder):
    staged = conform.conform_doppler(tables.raw_source(spark, folder, "flightscope"))
    return staged.select("shot_id", F.lit("unknown").alias("player"),
                         C.null_of("date").alias("session_date"), "total_yards")


@query("surrogate_keys", """SELECT _source, _row_index, md5(concat(_source, '-', CAST(_row_index AS VARCHAR))) AS shot_id,
  md5(concat(_source, '|', player, '|', CAST(_row_index AS VARCHAR))) AS grain_key
FROM (SELECT *, coalesce(player_cell, 'unknown') AS player FROM raw_cells)""")
def surrogate_keys(spark, folder):
    player = F.coalesce("player_cell", F.lit("unknown"))
    return raw_cells(spark, folder).select(
        "_source", "_row_index", C.shot_key(F.col("_source"), F.col("_row_index")).alias("shot_id"),
        C.surrogate_key(F.col("_source"), player, F.col("_row_index").cast("string")).alias("grain_key"))


@query("camera_club_codes", f"SELECT _row_index, clubtype, {CAMERA_CLUB} AS club FROM caddieset_raw")
def camera_club_codes(spark, folder):
    raw = tables.raw_source(spark, folder, "caddieset")
    return raw.select("_row_index", "clubtype", C.camera_club(F.col("clubtype")).alias("club"))


@query("doppler_club_codes", f"SELECT _row_index, club AS code, {DOPPLER_CLUB} AS club FROM flightscope_raw")
def doppler_club_codes(spark, folder):
    raw = tables.raw_source(spark, folder, "flightscope")
    return raw.select("_row_index", F.col("club").alias("code"), C.doppler_club(F.col("club")).alias("club"))


@query("path_dates", f"SELECT _row_index, {PATH_DATE} AS session_date FROM flightscope_raw")
def path_dates(spark, folder):
    raw = tables.raw_source(spark, folder, "flightscope")
    return raw.select("_row_index", C.date_in_path(F.col("_source_file")).alias("session_date"))


@query("stamp_dates", f"SELECT _row_index, {STAMP_DATE} AS session_date FROM foresight_raw")
def stamp_dates(spark, folder):
    raw = tables.raw_source(spark, folder, "foresight")
    return raw.select("_row_index", C.date_of_stamp(F.col("date")).alias("session_date"))


LABEL_SQL = """SELECT _row_index, label, CASE
  WHEN lower(trim(label)) IN ('dr', 'd') THEN 'Driver' WHEN lower(trim(label)) = '3w' THEN '3-wood'
  WHEN lower(trim(label)) = '5w' THEN '5-wood' WHEN lower(trim(label)) = '7w' THEN '7-wood'
  WHEN lower(trim(label)) IN ('hy', 'hybrid') THEN 'Hybrid'
  WHEN lower(trim(label)) IN ('pw', 'pitching wedge') THEN 'PW'
  WHEN regexp_matches(squeezed, '^[0-9]+i(ron)?$') THEN concat(regexp_extract(squeezed, '^([0-9]+)', 1), '-iron')
  WHEN regexp_matches(squeezed, '^[0-9]+wood$') THEN concat(regexp_extract(squeezed, '^([0-9]+)', 1), '-wood')
  ELSE trim(label) END AS club
FROM (SELECT *, lower(replace(replace(trim(label), ' ', ''), '#', '')) AS squeezed FROM labelled)"""
LABELS = ["7i", "7 Iron", "#7iron", "pw", "Pitching Wedge", "3w", "3 Wood", " Driver ", "dr", "Hy",
          "5-iron", "Sand Wedge", "9 IRON", "3wood", "60"]
LABEL_CELL = tables.pick("CAST(event_id % 15 AS INT)", LABELS)
relation("labelled", f"SELECT event_id AS _row_index, {LABEL_CELL} AS label FROM events")


@query("club_labels", LABEL_SQL)
def club_labels(spark, folder):
    labelled = tables.read(spark, folder, "events").selectExpr("event_id AS _row_index", f"{LABEL_CELL} AS label")
    return labelled.select("*", C.bag_label(F.col("label")).alias("club"))


HEADERS = ["Club Speed", "Dyn. Loft", "Max Height - Dist.", "Launch Angle V (deg sign)", "  Spin Rate  ", "***",
           "Ball__Speed", "_Carry_"]
HEADER_CELL = tables.pick("CAST(event_id % 8 AS INT)", HEADERS)


@query("header_names", f"""SELECT event_id, coalesce(nullif(trim(regexp_replace(lower(trim(header)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unnamed') AS name
FROM (SELECT event_id, {HEADER_CELL} AS header FROM events)""")
def header_names(spark, folder):
    cells = tables.read(spark, folder, "events").selectExpr("event_id", f"{HEADER_CELL} AS header")
    return cells.select("event_id", C.header_name(F.col("header")).alias("name"))


# An export with vendor headers, two of which mean one field.
EXPORT = {
    "Club Name": LABEL_CELL, "Ball Speed [mph]": tables.spoiled(tables.BALL, 0),
    "Launch V": tables.spoiled(tables.LAUNCH, 1), "Spin Rate": tables.spoiled(tables.SPIN, 2),
    "Carry": tables.spoiled(tables.CARRY, 3), "Carry Dist.": tables.spoiled(tables.CARRY, 4),
    "Offline": tables.spoiled(tables.SIDE, 5), "HLA": tables.spoiled(tables.DIRECTION, 6), "Note": "'x'",
}
relation("export_raw", "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in EXPORT.items()) + ", event_id AS n FROM event_metrics")


def export(spark, folder):
    return tables.event_metrics(spark, folder).selectExpr(*[f"{v} AS `{k}`" for k, v in EXPORT.items()])


# No row key survives the alias projection, so the two sides are compared as counted bags.
@query("header_conform", """SELECT club, ball_speed_mph, launch_angle_deg, spin_rate_rpm, carry_yards, side_dispersion,
  launch_direction_deg, count(*) AS copies
FROM (SELECT "Club Name" AS club, coalesce(nullif("Ball Speed [mph]", ''), "Ball Speed [mph]") AS ball_speed_mph,
  "Launch V" AS launch_angle_deg, "Spin Rate" AS spin_rate_rpm,
  coalesce(nullif("Carry", ''), nullif("Carry Dist.", ''), '') AS carry_yards,
  "Offline" AS side_dispersion, "HLA" AS launch_direction_deg FROM export_raw) GROUP BY ALL""")
def header_conform(spark, folder):
    conformed = conform.conform_headers(export(spark, folder))
    return conformed.groupBy(*conformed.columns).agg(F.count(F.lit(1)).alias("copies"))


@query("session_usable_rows", """SELECT 'Tester' AS player, count(*) AS n_rows,
  count(*) FILTER (WHERE trim("Ball Speed [mph]") <> '') AS usable FROM export_raw""")
def session_usable_rows(spark, folder):
    rows = conform.session_rows(export(spark, folder), "Tester")
    return rows.groupBy("player").agg(F.count(F.lit(1)).alias("n_rows"), conform.usable_rows().alias("usable"))


# ---- staging and silver -------------------------------------------------
def _register_staging(source: str) -> None:
    @query(f"stg_{source}", f"SELECT * FROM stg_{source}")
    def staged_source(spark, folder):
        return conform.CONFORMERS[source](tables.raw_source(spark, folder, source))


for _source in K.SOURCES:
    _register_staging(_source)


@query("first_camera_view", "SELECT _row_index, golferid, clubtype, carry_m FROM camera_first")
def first_camera_view(spark, folder):
    raw = tables.raw_source(spark, folder, "caddieset")
    typed = raw.select("_row_index", "_source", "golferid", "clubtype",
                       *[C.clean_double(F.col(o)).alias(n) for n, o in CAMERA_CELLS.items()])
    return conform.first_view(typed, conform.CAMERA_FINGERPRINT, "_row_index").select(
        "_row_index", "golferid", "clubtype", "carry_m")


@query("source_union", "SELECT * FROM conformed")
def source_union(spark, folder):
    return silver.union_sources(list(warehouse.staging(spark, folder).values()))


@query("core_metric_filter", "SELECT * FROM conformed WHERE ball_speed_mph IS NOT NULL")
def core_metric_filter(spark, folder):
    return silver.core_metric(silver.union_sources(list(warehouse.staging(spark, folder).values())))


@query("silver_shots", "SELECT * FROM silver_shots")
def silver_shots(spark, folder):
    return silver.silver_shots(tables.raw_sources(spark, folder))


@query("source_counts", """SELECT source, count(*) AS shots FROM silver_shots GROUP BY source
UNION ALL SELECT 'all', count(*) FROM silver_shots""")
def source_counts(spark, folder):
    return silver.source_counts(silver.silver_shots(tables.raw_sources(spark, folder)))


LAYOUTS = {  # what each source has of (club, smash_factor, player, launch_direction)
    "trackman": ("club", "smash_factor", None, "launch_direction"),
    "foresight": (None, "smash_factor", "player", "launch_direction"),
    "flightscope": ("club", None, None, None),
    "manual": ("club", "smash_factor", "player", None),
    "caddieset": (None, None, None, None),
}


@query("schema_on_read_union", " UNION ALL ".join(
    "SELECT _row_index, _source, " + ", ".join(
        f"{c or 'CAST(NULL AS VARCHAR)'} AS {n}" for c, n in zip(cells, ("club", "smash_factor", "player", "launch_direction")))
    + f" FROM {source}_raw" for source, cells in LAYOUTS.items()))
def schema_on_read_union(spark, folder):
    """Five layouts, each with some of the columns."""
    from functools import reduce

    raw = tables.raw_sources(spark, folder)
    parts = [raw[s].select("_row_index", "_source", *[c for c in cells if c]) for s, cells in LAYOUTS.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@query("optional_source", "SELECT * FROM stg_trackman")
def optional_source(spark, folder):
    """A personal-session table that was never landed adds nothing to the union."""
    from swingframe.sources.bronze import read_optional
    from swingframe.schemas import MANUAL_RAW

    absent = read_optional(spark, f"{folder}/manual_raw.parquet", MANUAL_RAW)
    present = conform.conform_radar(tables.raw_source(spark, folder, "trackman"))
    return present.unionByName(conform.conform_manual(absent))


@query("launch_ready", """SELECT shot_id, source, ball_speed_mph, launch_angle_deg, spin_rate_rpm FROM silver_shots
WHERE ball_speed_mph IS NOT NULL AND launch_angle_deg IS NOT NULL AND spin_rate_rpm IS NOT NULL""")
def launch_ready(spark, folder):
    from swingframe.operators.bags import launch_ready as ready

    shots = silver.silver_shots(tables.raw_sources(spark, folder))
    return ready(shots).select("shot_id", "source", "ball_speed_mph", "launch_angle_deg", "spin_rate_rpm")


# ---- gold ---------------------------------------------------------------
@query("dim_player", "SELECT * FROM dim_player")
def dim_player(spark, folder):
    return dims.dim_player(tables.player_profiles(spark, folder))


@query("club_enrichment", "SELECT * FROM clubs_enriched")
def club_enrichment(spark, folder):
    return dims.enrich_clubs(tables.player_clubs(spark, folder), tables.club_specs(spark, folder))


@query("flags_and_years", """SELECT player, club_type, effective_from, lower(is_custom) = 'true' AS is_custom,
  TRY_CAST(year AS BIGINT) AS model_year FROM player_clubs""")
def flags_and_years(spark, folder):
    clubs = tables.player_clubs(spark, folder)
    return clubs.select("player", "club_type", "effective_from", C.parse_flag(F.col("is_custom")).alias("is_custom"),
                        C.safe_int(F.col("year")).alias("model_year"))


@query("dim_club", "SELECT * FROM dim_club")
def dim_club(spark, folder):
    return dims.dim_club(tables.player_clubs(spark, folder), tables.club_specs(spark, folder))


@query("session_join", """SELECT s.shot_id, s.source, d.session_key, d.carry_method FROM silver_shots s
JOIN (SELECT * FROM dim_session WHERE source <> 'manual') d ON s.source = d.source""")
def session_join(spark, folder):
    listed = dims.dim_session(seeds.session_manifest(spark)).where("source <> 'manual'")
    shots = silver.silver_shots(tables.raw_sources(spark, folder)).select("shot_id", "source")
    return shots.join(listed.select("source", "session_key", "carry_method"), "source")


@query("as_of_versions", """SELECT o.o_orderkey, o.player, o.moment, p.player_key FROM
(SELECT o_orderkey, {owner} AS player, CAST(o_orderdate AS DATE) + 9400 AS moment FROM orders) o
LEFT JOIN dim_player p ON o.player = p.player AND o.moment BETWEEN p.valid_from AND p.valid_to""".replace("{owner}", tables.OWNER))
def as_of_versions(spark, folder):
    """Each order date matched to the player version in force that day."""
    moments = tables.read(spark, folder, "orders").selectExpr(
        "o_orderkey", f"{tables.OWNER} AS player", "CAST(o_orderdate AS DATE) + 9400 AS moment")
    versions = dims.dim_player(tables.player_profiles(spark, folder))
    return as_of_lookup(moments, versions, ["player"], "moment", ["player_key"])


@query("fct_shots", "SELECT * FROM fct_shots")
def fct_shots(spark, folder):
    return warehouse.star(spark, folder).facts


relation("dated_shots", """SELECT s.shot_id, s.source, s.player, s.club, coalesce(s.session_date, d.session_date) AS session_date,
  d.carry_method FROM silver_shots s JOIN dim_session d ON s.source = d.source""")


@query("fct_shots_own_date", """
SELECT s.*, coalesce(p.player_key, md5('unknown|1900-01-01')) AS player_key,
  coalesce(c.club_key, md5('unknown|unknown|1900-01-01')) AS club_key, c.model_year AS club_model_year
FROM dated_shots s
LEFT JOIN dim_player p ON s.player = p.player AND s.session_date BETWEEN p.valid_from AND p.valid_to
LEFT JOIN dim_club c ON s.player = c.player AND s.club = c.club_type AND s.session_date BETWEEN c.valid_from AND c.valid_to""")
def fct_shots_own_date(spark, folder):
    gold = warehouse.star(spark, folder)
    return facts.fct_shots_own_date(gold.shots, gold.sessions, gold.players, gold.clubs)


@query("unknown_member", """SELECT source, count(*) FILTER (WHERE player_key = md5('unknown|1900-01-01')) AS unknown_players,
  count(*) FILTER (WHERE club_key = md5('unknown|unknown|1900-01-01')) AS unknown_clubs FROM fct_shots GROUP BY source""")
def unknown_member(spark, folder):
    shots = warehouse.star(spark, folder).facts
    return shots.groupBy("source").agg(
        F.count_if(F.col("player_key") == F.md5(F.lit(K.UNKNOWN_PLAYER))).alias("unknown_players"),
        F.count_if(F.col("club_key") == F.md5(F.lit(K.UNKNOWN_CLUB))).alias("unknown_clubs"))


@query("mart_star_join", """SELECT source, carry_method, player, club, count(*) AS shots,
  round(sum(carry_yards), 4) AS carry_sum FROM mart_shots GROUP BY ALL""")
def mart_star_join(spark, folder):
    gold = warehouse.star(spark, folder)
    named = marts.named_shots(gold.facts, gold.clubs, gold.players)
    return named.groupBy("source", "carry_method", "player", "club").agg(
        F.count(F.lit(1)).alias("shots"), F.round(F.sum("carry_yards"), 4).alias("carry_sum"))


@query("gapping_aggregate", "SELECT * FROM gap_groups")
def gapping_aggregate(spark, folder):
    gold = warehouse.star(spark, folder)
    return marts.gapping_aggregate(marts.named_shots(gold.facts, gold.clubs, gold.players))


@query("club_gapping", "SELECT * FROM agg_club_gapping")
def club_gapping(spark, folder):
    return warehouse.star(spark, folder).gapping


# ---- contracts ----------------------------------------------------------
@query("contract_not_null", "SELECT shot_id, source, session_date FROM conformed WHERE session_date IS NULL")
def contract_not_null(spark, folder):
    rule = contracts.Contract("conformed", "session_date", "not_null")
    staged = silver.union_sources(list(warehouse.staging(spark, folder).values()))
    return contracts.violating_rows(staged, rule).select("shot_id", "source", "session_date")


@query("contract_unique", """SELECT player, count(*) AS copies FROM player_profiles
WHERE player IS NOT NULL GROUP BY player HAVING count(*) > 1""")
def contract_unique(spark, folder):
    return contracts.duplicates(tables.player_profiles(spark, folder), "player")


@query("contract_accepted_values", """SELECT player, club_type, is_custom FROM player_clubs
WHERE is_custom NOT IN ('true', 'false')""")
def contract_accepted_values(spark, folder):
    rule = contracts.Contract("player_clubs", "is_custom", "accepted_values", ("true", "false"))
    return contracts.violating_rows(tables.player_clubs(spark, folder), rule).select("player", "club_type", "is_custom")


@query("contract_between", "SELECT shot_id, carry_yards FROM silver_shots WHERE carry_yards < 0 OR carry_yards > 450")
def contract_between(spark, folder):
    rule = contracts.Contract("silver_shots", "carry_yards", "between", (0, 450))
    shots = silver.silver_shots(tables.raw_sources(spark, folder))
    return contracts.violating_rows(shots, rule).select("shot_id", "carry_yards")


@query("contract_relationships", """SELECT player, count(*) AS rows FROM silver_shots s
WHERE player IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_player d WHERE d.player = s.player) GROUP BY player""")
def contract_relationships(spark, folder):
    """Shot players that no dimension row names."""
    shots = silver.silver_shots(tables.raw_sources(spark, folder))
    players = dims.dim_player(tables.player_profiles(spark, folder))
    return contracts.orphans(shots, "player", players, "player")


@query("scd2_one_current", """SELECT player AS entity, count(*) FILTER (WHERE is_current AND year(valid_from) % 2 = 1) AS n_current
FROM dim_player GROUP BY player HAVING count(*) FILTER (WHERE is_current AND year(valid_from) % 2 = 1) <> 1""")
def scd2_one_current(spark, folder):
    """Run on a history whose even years lost their current mark, so that there is something to find."""
    damaged = dims.dim_player(tables.player_profiles(spark, folder)).withColumn(
        "is_current", F.col("is_current") & (F.year("valid_from") % 2 == 1))
    return contracts.not_one_current(damaged, F.col("player"))


OVERLAP = """SELECT entity, valid_from, prev_valid_to FROM (SELECT *, lag(valid_to) OVER
  (PARTITION BY entity ORDER BY valid_from) AS prev_valid_to FROM ({source})) WHERE prev_valid_to >= valid_from"""
_STRETCHED = "valid_from, CASE WHEN valid_to < DATE '9999-12-31' THEN valid_to + 3 ELSE valid_to END AS valid_to"


@query("scd2_overlaps", " UNION ALL ".join([
    OVERLAP.replace("{source}", f"SELECT player AS entity, {_STRETCHED} FROM dim_player"),
    OVERLAP.replace("{source}", f"SELECT concat(player, ' / ', club_type) AS entity, {_STRETCHED} FROM dim_club")]))
def scd2_overlaps(spark, folder):
    """Run on windows stretched by three days, open ones as they are; both dimensions' findings."""
    gold = warehouse.star(spark, folder)

    def stretched(df):
        closed = F.col("valid_to") < F.lit(K.OPEN_END).cast("date")
        return df.withColumn("valid_to", F.when(closed, F.date_add("valid_to", 3)).otherwise(F.col("valid_to")))

    return contracts.overlapping_windows(stretched(gold.players), F.col("player")).unionByName(
        contracts.overlapping_windows(stretched(gold.clubs), contracts.club_entity()))


def gate_sql(rules: list[contracts.Contract]) -> str:
    parts = []
    for c in rules:
        if c.kind == "unique":
            count = f"SELECT count(*) FROM (SELECT {c.column} FROM {c.table} WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        elif c.kind == "relationships":
            count = f"SELECT count(*) FROM {c.table} WHERE {c.column} IS NOT NULL AND {c.column} NOT IN (SELECT {c.args[1]} FROM {c.args[0]})"
        else:
            test = {"not_null": f"{c.column} IS NULL",
                    "accepted_values": f"{c.column} NOT IN ({', '.join(map(seeds.sql_literal, c.args))})",
                    "between": f"{c.column} < {c.args[0]} OR {c.column} > {c.args[-1]}" if c.kind == "between" else ""}[c.kind]
            count = f"SELECT count(*) FROM {c.table} WHERE {test}"
        parts.append(f"SELECT '{c.kind}' AS contract, '{c.table}' AS \"table\", '{c.column}' AS \"column\", ({count}) AS violations")
    for table, entity in (("dim_player", "player"), ("dim_club", "concat(player, ' / ', club_type)")):
        parts.append(f"SELECT 'one_current', '{table}', 'valid_from', (SELECT count(*) FROM (SELECT {entity} FROM {table} GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1))")
        parts.append(f"SELECT 'no_overlap', '{table}', 'valid_from', (SELECT count(*) FROM ({OVERLAP.replace('{source}', f'SELECT {entity} AS entity, valid_from, valid_to FROM {table}')}))")
    return " UNION ALL ".join(parts)


@query("quality_gate", gate_sql(contracts.ALL_CONTRACTS))
def quality_gate(spark, folder):
    return warehouse.checked_tables(spark, folder, contracts.ALL_CONTRACTS)
