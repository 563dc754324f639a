import numpy as np
import pytest
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import strokes as S
from swingframe.operators import scoring
from swingframe.operators.lookup import interpolate


def _expected(spark, pairs):
    df = spark.createDataFrame([(i, float(d), lie) for i, (d, lie) in enumerate(pairs)], "i int, d double, lie string")
    return [r[0] for r in df.orderBy("i").select(S.expected_strokes(F.col("d"), F.col("lie"))).collect()]


def test_anchors(spark):
    got = _expected(spark, [(100, "fairway"), (120, "fairway"), (120, "rough"), (1, "green"), (450, "tee"), (0, "fairway"), (0, "green")])
    assert np.allclose(got, [2.80, 2.85, 3.08, 1.04, 2.38 + 0.0041 * 450, 0, 0])


def test_lookup_equals_interpolation_everywhere(spark):
    d = np.concatenate([np.linspace(0.01, 300, 1201), K.CURVE_YARDS])
    for lie, curve in K.CURVE_STROKES.items():
        assert np.allclose(_expected(spark, [(x, lie) for x in d]), np.interp(d, K.CURVE_YARDS, curve))
    assert np.allclose(_expected(spark, [(x, "green") for x in d]), np.interp(d * 3, K.PUTT_FEET, K.PUTT_STROKES))


def test_orderings_and_unknown_lie(spark):
    lies = _expected(spark, [(130, x) for x in ("fairway", "rough", "sand", "recovery")])
    assert lies == sorted(lies)
    with pytest.raises(Exception, match="unknown lie: water"):
        _expected(spark, [(100, "water")])


def test_taxes(spark):
    df = spark.createDataFrame([(0.67, "green"), (6.7, "green"), (5.0, "sand"), (8.0, "green")], "d double, lie string")

    def cost(sg, gd):
        return np.array([r[0] for r in df.select(S.player_strokes(F.col("d"), F.col("lie"), sg, gd)).collect()])

    tour, loose = cost(0.0, 0.0), cost(0.4, 0.0)
    assert (loose >= tour).all() and loose[0] - tour[0] < 0.02 and loose[1] - tour[1] > 0.10 and loose[2] - tour[2] > 0.30
    assert (loose[2] - tour[2]) / (tour[2] - 1) > (loose[1] - tour[1]) / (tour[1] - 1)
    weak, strong = cost(0.4, 1.0)[3] - cost(0.4, 0.0)[3], cost(0.0, 1.0)[3] - cost(0.0, 0.0)[3]
    assert weak > strong > 0


def test_hole_out_prefers_a_tight_cloud(spark):
    rng = np.random.default_rng(0)
    rows = [("tight", float(c), 0.0, 100.0) for c in rng.normal(100, 3, 500)]
    rows += [("wide", float(c), 0.0, 100.0) for c in rng.normal(100, 25, 500)] + [("perfect", 100.0, 0.0, 100.0)] * 5
    df = spark.createDataFrame(rows, "club string, carry double, lateral double, pin double")
    got = {r.club: r for r in scoring.hole_out(df, ["club"], "pin").collect()}
    assert got["tight"].expected_strokes < got["wide"].expected_strokes
    assert got["perfect"].frac_on_green == 1.0 and abs(got["perfect"].expected_strokes - 2.0) < 0.1


def test_generic_lookup_with_flat_ends(spark):
    knots = spark.createDataFrame([("a", 0.0, 1.0), ("a", 10.0, 2.0), ("b", 5.0, 7.0)], "k string, x double, y double")
    df = spark.createDataFrame([("a", -5.0), ("a", 5.0), ("a", 10.0), ("a", 50.0), ("b", 1.0), ("b", 9.0), ("c", 1.0)], "k string, v double")
    got = {(r.k, r.v): r.out for r in interpolate(df, knots, ["k"], "v", "out", default=0.0).collect()}
    assert got == {("a", -5.0): 1.0, ("a", 5.0): 1.5, ("a", 10.0): 2.0, ("a", 50.0): 2.0, ("b", 1.0): 7.0, ("b", 9.0): 7.0, ("c", 1.0): 0.0}
