import numpy as np
import pytest
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.operators import holes as H
from swingframe.operators import planning as P

SIZE = 20.0
REGIONS = "hole_id string, region_id string, ord int, kind string, near double, far double, left double, right double, penalty_strokes double, drop_distance double"


def _cloud(spark, n=150):
    rng = np.random.default_rng(1)
    rows = []
    for club, mean, sc, sl in (("Driver", 230, 14, 14), ("7i", 140, 8, 9), ("PW", 100, 6, 6)):
        rows += [("b", club, float(c), float(x), i) for i, (c, x) in enumerate(zip(rng.normal(mean, sc, n), rng.normal(0, sl, n)))]
    return spark.createDataFrame(rows, "bag_id string, club string, carry double, lateral double, ord bigint")


def _solve(spark, regions=(), short_game=0.0, skew=0.35):
    clouds = _cloud(spark)
    heads = spark.createDataFrame([("h", 300.0, 8.0, 16.0, 0.0)], "hole_id string, pin_distance double, green_radius double, half_width double, green_difficulty double")
    holes = H.parametric_bounds(H.lay_regions(heads, spark.createDataFrame([("h", f"r{i}", i, *r) for i, r in enumerate(regions)], REGIONS)))
    frames = P.grid_frames(holes, SIZE)
    grid = P.hole_grid(frames, SIZE, polygon=False)
    clubs = P.bag_clubs(clouds)
    scenarios = spark.createDataFrame([("s", "h", "b", None, None, short_game)], "scenario string, hole_id string, bag_id string, start_x double, start_y double, short_game double")
    cells = P.written(P.scenario_cells(scenarios, frames, grid, clubs, SIZE))
    shapes = P.written(P.stencils(clouds, spark.createDataFrame([("b", skew)], "bag_id string, skew double"), SIZE))
    on = P.board(cells, shapes, P.candidates(cells, clubs, SIZE))
    return scenarios, cells, shapes, on, P.written(P.iterate(on))


POND = ("water", 270.0, 292.0, 4.0, 50.0, 1.0, 250.0)


@pytest.fixture(scope="module")
def solved(spark):
    return _solve(spark, [POND])


def _brute(spark, cells, skew):
    """The same value iteration over arrays."""
    rows = cells.collect()
    nx, ny = rows[0].nx, rows[0].ny
    get = lambda name: np.array([[next(r[name] for r in rows if (r.i, r.j) == (i, j)) for j in range(ny)] for i in range(nx)])
    floor, lie, wet = get("floor"), get("lie_class"), get("in_penalty")
    head = rows[0]
    clouds = {}
    for r in _cloud(spark).collect():
        clouds.setdefault(r.club, []).append((r.carry, r.lateral))
    order = sorted(clouds, key=lambda c: -np.mean([p[0] for p in clouds[c]]))
    plays = []
    for club in order:
        pts = np.array(clouds[club])
        down, across = pts[:, 0] - pts[:, 0].mean(), pts[:, 1] - pts[:, 1].mean()
        across = across * (1 + skew * np.sign(across))
        across -= across.mean()
        for name, (multiple, spread) in K.LIE_PLAY.items():
            di, dj = np.rint(down * spread / SIZE).astype(int), np.rint(across * spread / SIZE).astype(int)
            plays.append((club, name, int(np.rint(pts[:, 0].mean() * multiple / SIZE)), di, dj))
    v = floor.copy()
    for _ in range(300):
        cost = v.copy()
        cost[wet] = head.penalty_cost + v[head.drop_i, head.tee_j]
        best = np.full((nx, ny), np.inf)
        for club, name, stock, di, dj in plays:
            q = np.array([[1 + np.mean([cost[i + a, j + b] if 0 <= i + a < nx and 0 <= j + b < ny else 8.0 for a, b in zip(di, dj)])
                           for j in range(ny)] for i in range(nx)])
            for a, b in P.aim_offsets(SIZE):
                for i in range(nx):
                    if club == "Driver" and i != head.start_i:
                        continue
                    for j in range(ny):
                        if lie[i, j] == name:
                            ti, tj = i + stock + a, j + b
                            best[i, j] = min(best[i, j], q[ti, tj] if 0 <= ti < nx and 0 <= tj < ny else 8.0)
        new = np.minimum(floor, best)
        done = np.abs(new - v).max() < 1e-3
        v = new
        if done:
            return v


def test_sweeps_converge_to_the_array_solution(spark, solved):
    _, cells, _, _, values = solved
    want = _brute(spark, cells, 0.35)
    got = {(r.i, r.j): r.v for r in values.collect()}
    assert len(got) == want.size
    assert max(abs(got[i, j] - want[i, j]) for i, j in got) < 1e-9


def _tee(cells, values):
    head = cells.select("scenario", F.col("start_i").alias("i"), F.col("start_j").alias("j")).distinct()
    return head.join(values, ["scenario", "i", "j"]).first().v


def test_water_and_a_weak_short_game_cost_strokes(spark, solved):
    wet = _tee(solved[1], solved[4])
    _, dry_cells, _, _, dry = _solve(spark)
    assert wet >= _tee(dry_cells, dry) - 1e-6 and 2.5 < wet < 6
    _, cells, _, _, loose = _solve(spark, [POND], short_game=0.4)
    assert _tee(cells, loose) > wet


def test_rollout_and_round_row(spark, solved):
    scenarios, cells, _, on, values = solved
    shots = P.rollout(cells, P.policy(on, values)).orderBy("shot").collect()
    assert shots and shots[0].club == "Driver" and shots[0].from_x == 10.0 and shots[0].aim_x > 150
    assert all(a.aim_x == b.from_x for a, b in zip(shots, shots[1:]))
    row = P.round_rows(scenarios, cells, values, spark.createDataFrame(shots)).first()
    assert row.shots == len(shots) and row.plan.startswith("Driver (straight)") and row.expected == round(_tee(cells, values), 2)


def test_a_sweep_moves_no_option(spark, solved):
    """The options of a sweep's plan come from their buckets: no exchange stands above their scan and below their join."""
    import re

    on, values = solved[3], solved[4]
    plan = P.best_choices(on, values)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("== Initial Plan ==")[-1].split("\n")
    at = next(k for k, line in enumerate(lines) if "plan_options" in line)
    depth = lambda line: len(re.match(r"[ :|+\-*()0-9]*", line)[0])
    above, reach = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < reach:
            reach = depth(line)
            above.append(line)
    below_join = above[: next(k for k, line in enumerate(above) if "Join" in line)]
    assert not any("Exchange" in line for line in below_join), plan


def test_round_total(spark):
    rows = spark.createDataFrame([("a", r, 4, 400, 4.5) for r in range(1, 19)], "player string, ref int, par int, yards int, expected double")
    t = P.round_total(rows, ["player"]).first()
    assert (t.par, t.yards, t.expected, t.vs_par, t.front, t.front_vs_par, t.back) == (72, 7200, 81.0, 9.0, 40.5, 4.5, 40.5)


def test_aim_offsets_are_distinct_and_ordered():
    offsets = P.aim_offsets(4.0)
    assert len(offsets) == 8 * 11 and offsets == sorted(offsets) and offsets[0] == (-8, -32)
