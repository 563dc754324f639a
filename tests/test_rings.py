import random

import pytest

from swingframe.operators import cells, rings
from swingframe.operators import holes as H


def _turn(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _sign(v):
    return (v > 0) - (v < 0)


def _reason(ring):
    """The same rule by comparing all pairs of edges."""
    p = [q for i, q in enumerate(ring) if q != ring[i - 1]]
    n = len(p)
    if n < 3:
        return "short"
    edges = [(p[i], p[(i + 1) % n]) for i in range(n)]
    for (a, b), (_, c) in zip(edges, edges[1:] + edges[:1]):
        if (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0]) == 0 and (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1]) < 0:
            return "spike"
    for i in range(n):
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            (a, b), (c, d) = edges[i], edges[j]
            boxes = all(max(a[k], b[k]) >= min(c[k], d[k]) and max(c[k], d[k]) >= min(a[k], b[k]) for k in (0, 1))
            if boxes and _sign(_turn(a, b, c)) * _sign(_turn(a, b, d)) <= 0 and _sign(_turn(c, d, a)) * _sign(_turn(c, d, b)) <= 0:
                return "crossing"
    return None


def _star(n, wobble, seed):
    import math

    draw = random.Random(seed)
    return [[round((10 + wobble * draw.random()) * math.cos(2 * math.pi * k / n), 3), round((10 + wobble * draw.random()) * math.sin(2 * math.pi * k / n), 3)] for k in range(n)]


def test_reasons_are_those_of_all_pairs(spark):
    draw = random.Random(2)
    given = [
        [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]], [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]],
        [[0.0, 0.0], [4.0, 4.0], [4.0, 0.0], [0.0, 4.0]], [[0.0, 0.0], [1.0, 1.0]], [], [[1.0, 1.0]] * 5,
        [[0.0, 0.0], [4.0, 0.0], [2.0, 0.0], [2.0, 4.0]], [[0.0, 0.0], [2.0, 0.0], [4.0, 0.0], [2.0, 3.0], [2.0, 0.0], [0.0, 3.0]],
        [[5.0, 0.0], [5.0, 1.0], [5.0, 3.0]], _star(400, 0.05, 1), _star(400, 3.0, 2)]
    crossed = _star(600, 0.01, 3)
    crossed[100], crossed[400] = crossed[400], crossed[100]
    given.append(crossed)
    given += [[[float(draw.randrange(9)), float(draw.randrange(9))] for _ in range(draw.randrange(3, 8))] for _ in range(150)]
    frame = spark.createDataFrame([(k, r) for k, r in enumerate(given)], "k int, ring array<array<double>>")
    got = {r.k: r.reason for r in rings.rejected_rings(frame, ["k"]).collect()}
    assert got == {k: _reason(r) for k, r in enumerate(given) if _reason(r)}
    assert {None, "short", "spike", "crossing"} == {_reason(r) for r in given}


def test_null_rings_and_broken_points(spark):
    frame = spark.createDataFrame([(1, None), (2, [[0.0, 0.0], [1.0, None], [1.0, 1.0]]), (3, [[0.0, 0.0], [1.0], [1.0, 1.0]]),
                                   (None, [[0.0, 0.0], [2.0, 2.0], [2.0, 0.0], [0.0, 2.0]])], "k int, ring array<array<double>>")
    assert {(r.k, r.reason) for r in rings.rejected_rings(frame, ["k"]).collect()} == {(1, "short"), (2, "point"), (3, "point"), (None, "crossing")}


def test_a_long_ring_compares_edges_of_a_cell_only(spark):
    frame = spark.createDataFrame([(1, _star(2000, 0.0, 4))], "k int, ring array<array<double>>")
    assert rings.ring_edges(frame, ["k"]).count() < 10 * 2000 and rings.rejected_rings(frame, ["k"]).count() == 0


def test_a_course_without_its_bad_rings(spark):
    square = [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0]]
    bow = [[0.0, 0.0], [9.0, 9.0], [9.0, 0.0], [0.0, 9.0]]
    holes = spark.createDataFrame(
        [("a", square, [bow, square], [], None, [square]), ("b", bow, [square], [bow], [[[1.0, 1.0]]], [])],
        "hole_id string, green array<array<double>>, fairway array<array<array<double>>>, bunkers array<array<array<double>>>, "
        "water array<array<array<double>>>, playable array<array<array<double>>>")
    ready, bad = rings.checked_course(holes)
    assert {tuple(r) for r in bad.collect()} == {("a", "fairway", 0, "crossing"), ("b", "green", 0, "crossing"), ("b", "bunkers", 0, "crossing"), ("b", "water", 0, "short")}
    rows = {r.hole_id: r for r in ready.collect()}
    assert rows["a"].green is not None and len(rows["a"].fairway_layer.spans) == 1 and rows["a"].water_layer is None
    assert rows["b"].green is None and rows["b"].green_layer is None and rows["b"].bunkers_layer is None and rows["b"].fairway_layer is not None
    assert set(H.LAYERS) <= {c.removesuffix("_layer") for c in ready.columns}


# ---- cells ----------------------------------------------------------------
@pytest.mark.parametrize("size", [0.002, 0.5])
def test_nearest_is_that_of_all_pairs(spark, size):
    import math

    def metres(a, b):
        return round(math.hypot((a[0] - b[0]) * 111320, (a[1] - b[1]) * 111320 * math.cos(math.radians(a[0] + b[0]) / 2)), 6)

    draw = random.Random(6)
    spot = lambda wide: (45 + draw.random() * wide, -117 + draw.random() * wide)
    places = [(k % 4, k, *spot(0.03)) for k in range(80)] + [(1, 900, 45.9, -116.2), (7, 901, 45.0, -117.0)]
    targets = [(k % 3, k, *spot(0.03)) for k in range(40)] + [(1, 50, *places[1][2:]), (1, 49, *places[1][2:])]
    got = cells.nearest(spark.createDataFrame(places, "c int, id int, lat double, lon double"),
                        spark.createDataFrame(targets, "c int, t int, lat double, lon double"), ["c"], ["c", "id"], ["t"], size)
    want = {}
    for c, k, *p in places:
        near = [(metres(p, q), t) for d, t, *q in targets if d == c]
        if near:
            want[(c, k)] = min(near)[1]
    assert {(r.c, r.id): r.t for r in got.collect()} == want and got.count() == len(want)


def test_boxes_of_all_sizes(spark):
    draw = random.Random(8)
    points = [(f"h{k % 2}", k, draw.uniform(-300, 300), draw.uniform(-300, 300)) for k in range(300)]
    boxes = []
    for k in range(60):
        x, y, w = draw.uniform(-300, 300), draw.uniform(-300, 300), draw.choice([0.0, 1.0, 16.0, 90.0, 5000.0])
        boxes.append((f"h{k % 2}", k, x, x + w, y, y + w / 2))
    boxes += [("h0", 90, points[0][2], points[0][2], points[0][3], points[0][3]), ("h0", 91, 5.0, 1.0, 0.0, 9.0), ("h1", 92, None, 9.0, 0.0, 9.0)]
    got = cells.inside_boxes(spark.createDataFrame(points, "h string, id int, x double, y double"),
                             spark.createDataFrame(boxes, "h string, box int, a double, b double, c double, d double"), "h", ("a", "b", "c", "d"))
    want = {(i, n) for h, i, x, y in points for g, n, a, b, c, d in boxes if g == h and a is not None and a <= x <= b and c <= y <= d}
    assert sorted((r.id, r.box) for r in got.collect()) == sorted(want) and len(want) > 100


def test_rings_of_all_sizes(spark):
    def inside(ring, x, y):
        odd = False
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                odd = not odd
        return odd

    draw = random.Random(9)
    shapes = [("h0", k, [[a * s, b * s] for a, b in _star(n, 2.0, k)]) for k, (n, s) in enumerate([(3, 1), (5, 9), (200, 3), (800, 30), (4, 0.1)])]
    shapes.append(("h1", 9, [[0.0, 0.0], [1.0, 1.0]]))
    points = [("h0", k, draw.uniform(-90, 90), draw.uniform(-90, 90)) for k in range(300)] + [("h1", 999, 0.5, 0.5)]
    got = cells.inside_rings(spark.createDataFrame(points, "h string, id int, x double, y double"),
                             spark.createDataFrame(shapes, "h string, r int, ring array<array<double>>"), "h")
    want = {(i, r) for h, i, x, y in points for g, r, ring in shapes if g == h and len(ring) > 2 and inside(ring, x, y)}
    assert sorted((q.id, q.r) for q in got.collect()) == sorted(want) and len(want) > 200
