import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from swingframe.operators import bags
from swingframe.operators.joins import lookup
from swingframe.operators.quantiles import exact_percentiles, ordinal_rank
from swingframe.sources import seeds

COLUMNS = ("bag_id string, source string, player string, club string, ball_speed_mph double, launch_angle_deg double, "
           "spin_rate_rpm double, carry_yards double, side_dispersion double")


def _cloud(spark, seed=0, hot=3000):
    rng = np.random.default_rng(seed)
    rows = []
    for club, n, mean in (("Driver", hot, 250.0), ("7-iron", 37, 150.0), ("PW", 1, 110.0)):
        carry, lat = rng.normal(mean, 9, n), rng.normal(1, 5, n)
        rows += [("b", club, float(c), float(x), i) for i, (c, x) in enumerate(zip(carry, lat))]
    return spark.createDataFrame(rows, "bag_id string, club string, carry double, lateral double, ord bigint").repartition(4)


def _by_club(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.club, []).append(r)
    return out


@pytest.mark.parametrize("bound", [10, 60, 1_000_000])
def test_percentiles_equal_numpy_for_any_bound(spark, bound):
    df = _cloud(spark)
    rows = _by_club(df)
    got = {r.club: r for r in exact_percentiles(df, ["club"], "carry", {"a": 0.05, "m": 0.5, "z": 0.9}, bound=bound).collect()}
    for club, members in rows.items():
        values = [r.carry for r in members]
        assert np.allclose([got[club].a, got[club].m, got[club].z], np.percentile(values, [5, 50, 90]))


def test_a_hot_group_within_one_unit_is_cut_until_parts_are_small(spark):
    from swingframe.operators import quantiles

    df = spark.range(40000).selectExpr("IF(id % 3 = 0, concat('k', id % 50), 'hot') AS k", "(id * 7919 % 30011) / 30011.0D AS v").union(
        spark.range(9000).selectExpr("'hot'", "0.25D")).repartition(6)
    probs = {"a": 0.1, "m": 0.5, "z": 0.93}
    parts = quantiles.narrowed(quantiles.value_counts(df, ["k"], "v"), ["k"], list(probs.values()), 40)
    assert parts.groupBy("k", "_part").count().agg(F.max("count")).first()[0] <= 40
    got = {r.k: (r.a, r.m, r.z, r.n) for r in exact_percentiles(df, ["k"], "v", probs, count="n", bound=40).collect()}
    for k, rows in {k: [r.v for r in df.where(df.k == k).collect()] for k in ("hot", "k3", "k9")}.items():
        assert np.allclose(got[k][:3], np.percentile(rows, [10, 50, 93])) and got[k][3] == len(rows)
    whole = exact_percentiles(df, [], "v", probs, bound=40).first()
    assert np.allclose(list(whole), np.percentile([r.v for r in df.collect()], [10, 50, 93]))


def test_percentiles_with_ties_nulls_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("a", 2.0), ("a", None), (None, 5.0), (None, 7.0), ("e", None)], "k string, v double")
    got = {r.k: r.m for r in exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {"a": 1.0, None: 6.0}


def test_rank_in_blocks_is_the_row_order(spark):
    df = spark.range(1000).select((F.col("id") * 3).alias("ord"), F.when(F.col("id") % 3 == 0, "x").otherwise("hot").alias("k")).repartition(4)
    got = {(r.k, r.ord): (r.rank, r.size) for r in ordinal_rank(df, ["k"], "ord", block=50).collect()}
    for k in ("x", "hot"):
        order = sorted(o for (kk, o) in got if kk == k)
        assert [got[(k, o)] for o in order] == [(i, len(order)) for i in range(len(order))]


@pytest.mark.parametrize("n", [1, 2, 7, 36, 100])
def test_even_subsample_matches_linspace(spark, n):
    taken = _by_club(bags.even_subsample(_cloud(spark, hot=101), ["club"], "ord", n))
    for club, size in (("Driver", 101), ("7-iron", 37), ("PW", 1)):
        want = [k * (size - 1) // max(min(n, size) - 1, 1) for k in range(min(n, size))]
        assert sorted(r.ord for r in taken[club]) == want


def test_lookup_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise("hot").alias("k"))
    table = spark.createDataFrame([("hot", 1), (None, 2), ("x", 3)], "k string, v int")
    assert lookup(rows, table, ["k"]).where("v IS NULL").count() == 1667
    safe = lookup(rows, table, ["k"], null_safe=True)
    assert safe.count() == 5000 and safe.where("v = 2").count() == 1667
    assert lookup(rows, table, ["k"], "inner").count() == 3333


def test_summary_and_ellipse(spark):
    df = _cloud(spark)
    got = {r.club: r for r in bags.cloud_summary(df, ["bag_id", "club"]).collect()}
    members = _by_club(df)["Driver"]
    carry, lat = np.array([r.carry for r in members]), np.array([r.lateral for r in members])
    values, vectors = np.linalg.eigh(np.cov(np.vstack([carry, lat])))
    d = got["Driver"]
    assert math.isclose(d.carry_std_yards, carry.std()) and math.isclose(d.carry_p90_yards, np.percentile(carry, 90))
    assert np.allclose([d.ellipse_semi_minor_yards, d.ellipse_semi_major_yards], np.sqrt(values))
    tilt = math.degrees(math.atan2(vectors[1, 1], vectors[0, 1]))
    assert abs((d.ellipse_angle_deg - tilt + 90) % 180 - 90) < 1e-6


def test_recentre_and_anchor(spark):
    df = _cloud(spark, hot=50)
    centred = bags.recentre(df, ["bag_id", "club"])
    assert all(abs(r.m) < 1e-9 for r in centred.groupBy("club").agg(F.avg("carry").alias("m")).collect())
    measured = spark.createDataFrame([("b", "Driver", 261.0), ("b", "Driver", 263.0)], "bag_id string, club string, carry_yards double")
    means = {r.club: r.m for r in bags.anchor_to_measured(df, measured, ["bag_id", "club"]).groupBy("club").agg(F.avg("carry").alias("m")).collect()}
    before = {r.club: r.m for r in df.groupBy("club").agg(F.avg("carry").alias("m")).collect()}
    assert math.isclose(means["Driver"], 262.0) and math.isclose(means["7-iron"], before["7-iron"])


def _strikes(club, ball, carry, n=12):
    return [("b", "s", "p", club, ball + math.sin(i) * 0.5, 17.0, 6200.0 + i, carry + math.sin(i), float(i % 3)) for i in range(n)]


def test_bag_measures_gap_fills_and_drops_mishits(spark):
    whiffs = [("b", "s", "p", "7 iron", 35.0, 40.0, 1000.0, None, None)] * 4
    rows = _strikes("7 iron", 115.0, 150.0) + whiffs + _strikes("pw", 82.0, 110.0) + _strikes("Driver", 150.0, 240.0, n=5)
    bag = {r.club: r for r in bags.bag_from_shots(spark.createDataFrame(rows, COLUMNS), seeds.all_tours(spark)).collect()}
    assert len(bag) == 12
    assert {c for c, r in bag.items() if r.is_real} == {"7-iron", "PW"}  # five drives are too few
    assert bag["7-iron"].n_observed == 12 and abs(bag["7-iron"].carry_yards - 150) < 1.5
    scale = np.median([bag["7-iron"].carry_yards / 176, bag["PW"].carry_yards / 142])
    assert math.isclose(bag["Driver"].carry_yards, 282 * scale)


def test_trims(spark):
    rows = _strikes("Driver", 150.0, 240.0, n=100) + _strikes("PW", 80.0, 100.0, n=5)
    df = spark.createDataFrame(rows, COLUMNS)
    kept = _by_club(bags.trim_percentiles(df))
    low, high = np.percentile([r[4] for r in rows[:100]], [5, 95])
    assert len(kept["Driver"]) == sum(low <= r[4] <= high for r in rows[:100]) and len(kept["PW"]) == 5


def test_richest_player_and_top_clubs(spark):
    rows = []
    for player, clubs in (("a", {"x": 9, "y": 8}), ("b", {"x": 50, "y": 3}), ("c", {"x": 9, "y": 8})):
        for club, n in clubs.items():
            rows += [("b", "s", player, club, 100.0, 10.0, 2000.0, 100.0, 0.0)] * n
    df = spark.createDataFrame(rows, COLUMNS)
    pick = bags.richest_player(df).first()
    assert (pick.player, pick.clubs, pick.shots) == ("a", 2, 17)
    assert [(r.player, r.clubs) for r in bags.ranked_bags(df).collect()] == [("a", 2), ("c", 2), ("b", 1)]
    assert [r.club for r in bags.richest_bag(df).orderBy("club").collect()] == ["x", "y"]
    few = df.limit(3)
    assert bags.richest_player(few).first().clubs == 0  # nobody qualifies: totals decide
    assert bags.top_clubs(bags.club_counts(df), k=1).count() == 3
