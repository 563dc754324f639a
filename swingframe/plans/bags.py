"""Queries over player shots: selections, trims, statistics and bags."""

from __future__ import annotations

from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import cleaning as C
from swingframe.operators import bags
from swingframe.operators.quantiles import exact_percentiles, ordinal_rank
from swingframe.plans import tables
from swingframe.plans.registry import dround, query, relation
from swingframe.plans.shots import LABEL_SQL
from swingframe.sources import seeds

TOUR_COLUMNS = ["club", *K.TOUR_COLUMNS]
for _tour, _rows in K.TOUR_AVERAGES.items():
    relation(f"tour_{_tour}", seeds.values_sql(TOUR_COLUMNS, [(c, *map(float, v)) for c, v in _rows.items()]))
READY = "ball_speed_mph IS NOT NULL AND launch_angle_deg IS NOT NULL AND spin_rate_rpm IS NOT NULL"
relation("ready_shots", f"SELECT * FROM typed_shots WHERE {READY}")


def rounded(df, columns: dict[str, int] | list[str], places: int = 6):
    """Round the named floating columns, leaving the rest."""
    names = columns if isinstance(columns, list) else list(columns)
    return df.select([F.round(F.round(c, 10), places).alias(c) if c in names else F.col(c) for c in df.columns])


def r6(expr: str, name: str) -> str:
    return f"{dround(expr, 6)} AS {name}"


# ---- selections ---------------------------------------------------------
BUCKET = "CAST('0x' || substr(md5(shot_id), 1, 8) AS BIGINT) % 20 = 0"


@query("hash_sample", f"SELECT shot_id, ord FROM typed_shots WHERE {BUCKET}")
def hash_sample(spark, folder):
    return bags.hash_sample(tables.typed_shots(spark, folder), "shot_id").select("shot_id", "ord")


@query("driver_band", f"""SELECT shot_id, ball_speed_mph, spin_rate_rpm, launch_angle_deg, carry_yards FROM typed_shots
WHERE source = 'trackman' AND carry_method = 'measured' AND carry_yards IS NOT NULL AND ball_speed_mph BETWEEN 130 AND 175
  AND spin_rate_rpm BETWEEN 1500 AND 4000 AND launch_angle_deg BETWEEN 7 AND 18 AND {BUCKET}""")
def driver_band(spark, folder):
    return bags.driver_band(tables.typed_shots(spark, folder)).select(
        "shot_id", "ball_speed_mph", "spin_rate_rpm", "launch_angle_deg", "carry_yards")


@query("player_filter", """SELECT shot_id, club, carry_yards FROM ready_shots
WHERE source = 'trackman' AND player = 'Player 3'""")
def player_filter(spark, folder):
    return bags.player_shots(tables.typed_shots(spark, folder), "trackman", "Player 3").select(
        "shot_id", "club", "carry_yards")


relation("si_shots", """SELECT shot_id, source, player, club, ball_speed_mph * 0.44704e0 AS ball_speed_ms,
  radians(launch_angle_deg) AS launch_angle_rad, radians(coalesce(launch_direction_deg, 0)) AS launch_direction_rad,
  spin_rate_rpm * 2e0 * pi() / 60e0 AS spin_rate_rad_s, radians(coalesce(spin_axis_deg, 0)) AS spin_axis_rad,
  carry_yards AS measured_carry_yards, total_yards AS measured_total_yards FROM ready_shots""")
SI = ", ".join(r6(c, c) for c in bags.LAUNCH_SI)


@query("si_projection", f"SELECT shot_id, source, player, club, {SI}, measured_carry_yards, measured_total_yards FROM si_shots")
def si_projection(spark, folder):
    return rounded(bags.to_si(tables.typed_shots(spark, folder)), bags.LAUNCH_SI)


@query("roll_out", f"""SELECT shot_id, {r6('0.9e0 * 0.091e0 * measured_carry_yards * exp(-0.00155e0 * spin_rate_rad_s)', 'roll_yards')},
  {r6('measured_carry_yards + 0.9e0 * 0.091e0 * measured_carry_yards * exp(-0.00155e0 * spin_rate_rad_s)', 'total_yards')} FROM si_shots""")
def roll_out(spark, folder):
    rolled = bags.with_roll(bags.to_si(tables.typed_shots(spark, folder)), firmness=0.9)
    return rounded(rolled.select("shot_id", "roll_yards", "total_yards"), ["roll_yards", "total_yards"])


# ---- who has a bag ------------------------------------------------------
relation("shot_counts", "SELECT source, player, club, count(*) AS club_shots FROM ready_shots GROUP BY ALL")
relation("bag_counts", """SELECT source, player, count(*) FILTER (WHERE club_shots >= 8) AS clubs,
  CAST(sum(club_shots) AS BIGINT) AS shots FROM shot_counts GROUP BY source, player""")


@query("player_bags", "SELECT * FROM bag_counts WHERE clubs >= 1")
def player_bags(spark, folder):
    return bags.ranked_bags(tables.typed_shots(spark, folder))


@query("richest_player", "SELECT * FROM bag_counts ORDER BY clubs DESC, shots DESC, source, player LIMIT 1")
def richest_player(spark, folder):
    return bags.richest_player(tables.typed_shots(spark, folder))


@query("top_clubs", """SELECT source, player, club, club_shots, place FROM (SELECT *, row_number() OVER
  (PARTITION BY source, player ORDER BY club_shots DESC, club) AS place FROM shot_counts WHERE club_shots >= 8) WHERE place <= 3""")
def top_clubs(spark, folder):
    ranked = bags.top_clubs(bags.club_counts(tables.typed_shots(spark, folder)), k=3)
    return ranked.withColumn("place", F.col("place").cast("bigint"))


# ---- trims --------------------------------------------------------------
TRIM_A = """SELECT source, player, club, {cols} FROM (
  SELECT *, count(*) FILTER (WHERE inside) OVER (PARTITION BY source, player, club) AS kept FROM (
    SELECT r.*, coalesce(r.ball_speed_mph BETWEEN g.lo AND g.hi, false) AS inside, g.n FROM typed_shots r
    JOIN (SELECT source, player, club, quantile_cont(ball_speed_mph, 0.05) AS lo, quantile_cont(ball_speed_mph, 0.95) AS hi,
            count(ball_speed_mph) AS n FROM typed_shots GROUP BY ALL) g USING (source, player, club)))
WHERE n < 8 OR kept < 8 OR inside"""


@query("trim_percentiles", TRIM_A.replace("{cols}", "shot_id, ball_speed_mph"))
def trim_percentiles(spark, folder):
    return bags.trim_percentiles(tables.typed_shots(spark, folder)).select(
        "source", "player", "club", "shot_id", "ball_speed_mph")


relation("median_trimmed", """SELECT r.* FROM ready_shots r JOIN (SELECT source, player, club,
  median(ball_speed_mph) AS m, count(*) AS n FROM ready_shots GROUP BY ALL) g USING (source, player, club)
WHERE g.n < 8 OR r.ball_speed_mph BETWEEN g.m * 0.7e0 AND g.m * 1.3e0""")


@query("trim_median", "SELECT shot_id, club, ball_speed_mph FROM median_trimmed")
def trim_median(spark, folder):
    ready = bags.launch_ready(tables.typed_shots(spark, folder))
    return bags.trim_median(ready, bags.CLUB_KEYS, "ball_speed_mph").select("shot_id", "club", "ball_speed_mph")


# ---- statistics ---------------------------------------------------------
_DIST = [f"mean_{c}" for c in bags.LAUNCH_SI] + [f"cov_{i}{j}" for i in range(5) for j in range(i, 5)]
_DIST_SQL = [r6(f"avg({c})", f"mean_{c}") for c in bags.LAUNCH_SI] + [
    r6(f"covar_samp({bags.LAUNCH_SI[i]}, {bags.LAUNCH_SI[j]})", f"cov_{i}{j}") for i in range(5) for j in range(i, 5)]


@query("launch_distribution", f"SELECT source, player, club, count(*) AS n_observed, {', '.join(_DIST_SQL)} FROM si_shots GROUP BY ALL HAVING count(*) >= 8")
def launch_distribution(spark, folder):
    return rounded(bags.launch_distribution(bags.to_si(tables.typed_shots(spark, folder))), _DIST)


REPORTED = """count(*) AS shots,
  CASE WHEN count(carry_yards) >= 2 THEN round(avg(carry_yards), 6) END AS measured_carry_mean,
  CASE WHEN count(carry_yards) >= 2 THEN round(stddev_pop(carry_yards), 6) END AS measured_carry_std,
  CASE WHEN count(side_dispersion) >= 2 THEN round(stddev_pop(side_dispersion), 6) END AS measured_side_std"""
_REPORTED = ["measured_carry_mean", "measured_carry_std", "measured_side_std"]


@query("reported_stats", f"SELECT source, player, club, {REPORTED} FROM typed_shots GROUP BY source, player, club")
def reported_stats(spark, folder):
    return rounded(bags.reported_stats(tables.typed_shots(spark, folder)), _REPORTED)


_SUMMARY = ["carry_mean_yards", "carry_std_yards", "lateral_mean_yards", "lateral_std_yards", "carry_p10_yards",
            "carry_p90_yards", "ellipse_semi_major_yards", "ellipse_semi_minor_yards", "ellipse_angle_deg"]


@query("cloud_summary", f"""SELECT bag_id, club, n_samples, {', '.join(r6(c, c) for c in _SUMMARY[:6])},
  {r6('sqrt(greatest((a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b), 0))', 'ellipse_semi_major_yards')},
  {r6('sqrt(greatest((a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b), 0))', 'ellipse_semi_minor_yards')},
  {r6('degrees(atan2(2 * b, a - c) / 2)', 'ellipse_angle_deg')}
FROM (SELECT bag_id, club, count(*) AS n_samples, avg(carry) AS carry_mean_yards, stddev_pop(carry) AS carry_std_yards,
  avg("lateral") AS lateral_mean_yards, stddev_pop("lateral") AS lateral_std_yards,
  quantile_cont(carry, 0.1) AS carry_p10_yards, quantile_cont(carry, 0.9) AS carry_p90_yards,
  var_samp(carry) AS a, covar_samp(carry, "lateral") AS b, var_samp("lateral") AS c FROM landings GROUP BY bag_id, club)""")
def cloud_summary(spark, folder):
    return rounded(bags.cloud_summary(tables.landings(spark, folder), ["bag_id", "club"]), _SUMMARY)


@query("exact_percentiles", """SELECT bag_id, round(quantile_cont(carry, 0.05), 6) AS p05,
  round(quantile_cont(carry, 0.5), 6) AS p50, round(quantile_cont(carry, 0.95), 6) AS p95 FROM landings GROUP BY bag_id""")
def percentiles(spark, folder):
    found = exact_percentiles(tables.landings(spark, folder), ["bag_id"], "carry",
                              {"p05": 0.05, "p50": 0.5, "p95": 0.95})
    return rounded(found, ["p05", "p50", "p95"])


@query("carry_error_report", """WITH e AS (SELECT club, abs(total_yards - 12e0 - carry_yards) AS error FROM typed_shots)
SELECT club AS "group", count(error) AS n, round(avg(error), 6) AS mean_abs_error, round(median(error), 6) AS median_abs_error
FROM e GROUP BY club UNION ALL SELECT 'all', count(error), round(avg(error), 6), round(median(error), 6) FROM e""".replace(
    "WITH e AS (SELECT club, abs(total_yards - 12e0 - carry_yards) AS error FROM typed_shots)\n", "").replace("FROM e", "FROM carry_errors"))
def carry_error_report(spark, folder):
    rows = tables.typed_shots(spark, folder).withColumn("predicted", F.col("total_yards") - 12.0)
    return rounded(bags.error_report(rows, "club", "predicted", "carry_yards"), ["mean_abs_error", "median_abs_error"])


relation("carry_errors", "SELECT club, abs(total_yards - 12e0 - carry_yards) AS error FROM typed_shots")
relation("shot_labels", LABEL_SQL.replace("SELECT _row_index, label, CASE", "SELECT *, CASE").replace(
    " AS club\n", " AS bag_club\n").replace("FROM labelled", "FROM (SELECT *, club AS label FROM ready_shots)"))


@query("spread_report", """SELECT c.club, c.n, round(c.sc, 6) AS cloud_carry_sigma, round(c.ss, 6) AS cloud_side_sigma,
  round(m.mc, 6) AS measured_carry_sigma, round(m.ms, 6) AS measured_side_sigma
FROM (SELECT club, count(*) AS n, stddev_pop(carry) AS sc, stddev_pop("lateral") AS ss FROM landings GROUP BY club) c
JOIN (SELECT bag_club AS club, stddev_pop(carry_yards) AS mc, stddev_pop(side_dispersion) AS ms FROM shot_labels GROUP BY 1) m
  ON c.club = m.club""")
def spread_report(spark, folder):
    shots = bags.launch_ready(tables.typed_shots(spark, folder)).withColumn("club", C.bag_label(F.col("club")))
    report = bags.spread_report(tables.landings(spark, folder), shots)
    return rounded(report, ["cloud_carry_sigma", "cloud_side_sigma", "measured_carry_sigma", "measured_side_sigma"])


# ---- clouds -------------------------------------------------------------
@query("recentred_clouds", """SELECT ord, round(carry - avg(carry) OVER (PARTITION BY bag_id, club), 6) AS carry FROM landings""")
def recentred_clouds(spark, folder):
    centred = bags.recentre(tables.landings(spark, folder), ["bag_id", "club"])
    return rounded(centred.select("ord", "carry"), ["carry"])


@query("even_subsample", """SELECT bag_id, club, ord, carry FROM (
  SELECT *, row_number() OVER (PARTITION BY bag_id, club ORDER BY ord) - 1 AS r,
    count(*) OVER (PARTITION BY bag_id, club) AS n FROM landings) l
WHERE n <= 100 OR r IN (SELECT (k * (l.n - 1)) // 99 FROM range(100) t(k))""")
def even_subsample(spark, folder):
    return bags.even_subsample(tables.landings(spark, folder), ["bag_id", "club"], "ord", 100).select(
        "bag_id", "club", "ord", "carry")


@query("row_numbering", """SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS rank,
  count(*) OVER (PARTITION BY event_type) AS size FROM events""")
def row_numbering(spark, folder):
    events = tables.read_events(spark, folder).select("event_type", "event_id")
    return ordinal_rank(events, ["event_type"], "event_id", block=1000)


@query("anchored_clouds", """SELECT l.ord, round(l.carry - avg(l.carry) OVER (PARTITION BY l.bag_id, l.club)
  + coalesce(m.target, avg(l.carry) OVER (PARTITION BY l.bag_id, l.club)), 6) AS carry FROM landings l
LEFT JOIN (SELECT bag_id, club, median(carry_yards) AS target FROM measured_landings GROUP BY bag_id, club) m
  ON l.bag_id = m.bag_id AND l.club = m.club""")
def anchored_clouds(spark, folder):
    clouds = tables.landings(spark, folder)
    measured = clouds.where("club <> 'PW'").select("bag_id", "club", (F.col("carry") + 3.5).alias("carry_yards"))
    anchored = bags.anchor_to_measured(clouds, measured, ["bag_id", "club"])
    return rounded(anchored.select("ord", "carry"), ["carry"])


relation("measured_landings", "SELECT bag_id, club, carry + 3.5e0 AS carry_yards FROM landings WHERE club <> 'PW'")


# ---- reference scaling --------------------------------------------------
relation("bag_carries", "SELECT bag_id, club, round(avg(carry), 6) AS measured_carry FROM landings GROUP BY bag_id, club")
def bag_carries(spark, folder):
    return tables.landings(spark, folder).groupBy("bag_id", "club").agg(
        F.round(F.avg("carry"), 6).alias("measured_carry"))


@query("bag_stock", """SELECT b.bag_id, b.club, round(t.ball_speed_mph * b.measured_carry / t.carry_yards, 6) AS ball_speed_mph,
  b.measured_carry AS carry_yards FROM bag_carries b JOIN tour_pga t ON b.club = t.club""")
def bag_stock(spark, folder):
    return rounded(bags.bag_stock(bag_carries(spark, folder), seeds.tour_averages(spark, "pga")), ["ball_speed_mph"])


@query("scale_ratio", """SELECT b.bag_id, round(coalesce(median(b.measured_carry / t.carry_yards), 1), 6) AS scale
FROM bag_carries b LEFT JOIN tour_pga t ON b.club = t.club GROUP BY b.bag_id""")
def scale_ratio(spark, folder):
    return rounded(bags.scale_ratio(bag_carries(spark, folder), seeds.tour_averages(spark, "pga")), ["scale"])


@query("gap_fill", """SELECT s.bag_id, s.club, coalesce(b.measured_carry, s.carry) AS carry, b.club IS NOT NULL AS is_real
FROM (SELECT DISTINCT l.bag_id, t.club, t.carry_yards AS carry FROM landings l, tour_pga t) s
LEFT JOIN bag_carries b ON s.bag_id = b.bag_id AND s.club = b.club""")
def gap_fill(spark, folder):
    own = bag_carries(spark, folder)
    tours = seeds.all_tours(spark).select("tour", "club", F.col("carry_yards").alias("carry"))
    base = own.select("bag_id").distinct().withColumn("tour", F.lit("pga")).join(tours, "tour").drop("tour")
    return bags.gap_fill(base, own.withColumnRenamed("measured_carry", "carry"), ["bag_id", "club"], "carry")


# ---- whole bags ---------------------------------------------------------
relation("bag_clean", """SELECT r.* FROM shot_labels r JOIN (SELECT player, bag_club, median(ball_speed_mph) AS m, count(*) AS n
  FROM shot_labels GROUP BY ALL) g ON r.player = g.player AND r.bag_club = g.bag_club
WHERE g.n < 8 OR r.ball_speed_mph BETWEEN g.m * 0.7e0 AND g.m * 1.3e0""")
relation("bag_real", """SELECT player, bag_club AS club, count(*) AS n_observed, coalesce(median(carry_yards), avg(carry_yards)) AS measured_carry,
  stddev_pop(carry_yards) AS carry_std_yards, stddev_pop(side_dispersion) AS lateral_std_yards
FROM bag_clean GROUP BY ALL HAVING count(*) >= 8""")


@query("bag_from_shots", """SELECT s.player, t.club, round(coalesce(r.measured_carry, t.carry_yards * s.scale), 6) AS carry_yards,
  round(r.carry_std_yards, 6) AS carry_std_yards, round(r.lateral_std_yards, 6) AS lateral_std_yards,
  r.n_observed, r.club IS NOT NULL AS is_real
FROM (SELECT b.player, coalesce(median(b.measured_carry / t.carry_yards), 1) AS scale FROM bag_real b
      LEFT JOIN tour_pga t ON b.club = t.club GROUP BY b.player) s CROSS JOIN tour_pga t
LEFT JOIN bag_real r ON r.player = s.player AND r.club = t.club""")
def bag_from_shots(spark, folder):
    built = bags.bag_from_shots(tables.typed_shots(spark, folder), seeds.all_tours(spark), bag="player")
    return rounded(built, ["carry_yards", "carry_std_yards", "lateral_std_yards"])


@query("richest_bag", f"""SELECT source, player, club, {REPORTED} FROM (
  SELECT *, count(*) FILTER (WHERE inside) OVER (PARTITION BY club) AS kept FROM (
    SELECT r.*, coalesce(r.ball_speed_mph BETWEEN g.lo AND g.hi, false) AS inside, g.n FROM richest_shots r
    JOIN (SELECT club, quantile_cont(ball_speed_mph, 0.05) AS lo, quantile_cont(ball_speed_mph, 0.95) AS hi,
            count(ball_speed_mph) AS n FROM richest_shots GROUP BY ALL) g USING (club)))
WHERE n < 8 OR kept < 8 OR inside GROUP BY source, player, club""")
def richest_bag(spark, folder):
    return rounded(bags.richest_bag(tables.typed_shots(spark, folder)), _REPORTED)


relation("richest_shots", """SELECT r.* FROM ready_shots r
JOIN (SELECT * FROM bag_counts ORDER BY clubs DESC, shots DESC, source, player LIMIT 1) p USING (source, player)
JOIN (SELECT source, player, club FROM (SELECT *, row_number() OVER (PARTITION BY source, player ORDER BY club_shots DESC, club) AS place
  FROM shot_counts WHERE club_shots >= 8) WHERE place <= 6) c USING (source, player, club)""")
