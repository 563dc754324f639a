import pytest

from swingframe.operators import planning as P


def _strip(spark, cells, floor):
    """One row of cells; a shot moves on by `step` cells, aimed exactly."""
    rows = [("s", i, 0, "b", floor(i), False, cells, 1, 0, 0, 0, 0, 1.0, "clean", "fairway", float(20 * i), 0.0) for i in range(cells)]
    return spark.createDataFrame(rows, "scenario string, i int, j int, bag_id string, floor double, in_penalty boolean, nx int, ny int, "
                                       "drop_i int, tee_j int, start_i int, start_j int, penalty_cost double, lie_class string, lie string, x double, y double")


def _options(spark, cells, moves):
    rows = [("s", i, 0, "clean", "club", k, m, 0, i + m, 0, 0 <= i + m < cells) for i in range(cells) for k, m in enumerate(moves)]
    return spark.createDataFrame(rows, "scenario string, i int, j int, lie_class string, club string, choice int, off_i int, off_j int, "
                                       "to_i int, to_j int, on_grid boolean")


def _shape(spark):
    return spark.createDataFrame([("b", "club", "clean", 0, 0, 1.0)], "bag_id string, club string, lie_class string, di int, dj int, p double")


def test_values_of_a_strip(spark):
    cells = _strip(spark, 4, lambda i: 1.0 if i == 3 else 50.0)
    values = P.iterate(P.board(cells, _shape(spark), _options(spark, 4, [1])))
    assert {r.i: round(r.v, 6) for r in values.collect()} == {0: 4.0, 1: 3.0, 2: 2.0, 3: 1.0}


def test_a_hole_of_twelve_shots_is_played_out(spark):
    cells = _strip(spark, 13, lambda i: 50.0)
    choices = spark.createDataFrame(
        [("s", i, 0, "club", 1, 0, 13, 1, 20.0 * i, 0.0, i == 12) for i in range(13)],
        "scenario string, i int, j int, club string, off_i int, off_j int, nx int, ny int, x double, y double, done boolean")
    shots = P.rollout(cells, choices).orderBy("shot").collect()
    assert [r.shot for r in shots] == list(range(1, 13)) and [r.ends for r in shots] == [None] * 11 + ["short game"]


def test_an_unfinished_iteration_raises(spark):
    cells = _strip(spark, 4, lambda i: 1.0 if i == 3 else 50.0)
    with pytest.raises(RuntimeError, match="still move"):
        P.iterate(P.board(cells, _shape(spark), _options(spark, 4, [1])), most=1)


def test_play_that_goes_round_is_marked(spark):
    cells = _strip(spark, 3, lambda i: 40.0)
    choices = spark.createDataFrame(
        [("s", 0, 0, "club", 1, 0, 3, 1, 0.0, 0.0, False), ("s", 1, 0, "club", -1, 0, 3, 1, 20.0, 0.0, False)],
        "scenario string, i int, j int, club string, off_i int, off_j int, nx int, ny int, x double, y double, done boolean")
    shots = P.rollout(cells, choices).orderBy("shot").collect()
    assert [(r.shot, r.to_i, r.ends) for r in shots] == [(1, 1, None), (2, 0, "stuck")]
