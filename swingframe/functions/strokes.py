"""Expected strokes to hole out, as column expressions.

Every published curve is piecewise linear with knots on a 5-yard (1-foot for
putts) lattice, so a curve is kept as two constant arrays of line intercepts and
slopes, one entry per lattice bucket. A lookup is then two array reads on a
computed index: no join, no shuffle, and few enough instructions that a stage which
prices several positions still compiles to machine code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swingframe import constants as K

LIE_ORDER = [*K.CURVE_STROKES, "green"]
YARD_STEP = 5.0
BUCKETS = K.PUTT_FEET[-1] + 1  # enough for both lattices; past a curve's end it is flat


def _lines(xs: list[float], ys: list[float], step: float) -> list[tuple[float, float]]:
    """(intercept, slope) of the curve on each lattice bucket, flat past both ends."""
    lines = []
    for b in range(BUCKETS):
        x = b * step
        if x < xs[0]:
            lines.append((ys[0], 0.0))
        elif x >= xs[-1]:
            lines.append((ys[-1], 0.0))
        else:
            i = max(j for j in range(len(xs) - 1) if xs[j] <= x)
            slope = (ys[i + 1] - ys[i]) / (xs[i + 1] - xs[i])
            lines.append((ys[i] - slope * xs[i], slope))
    return lines


_LINES = [line for ys in K.CURVE_STROKES.values() for line in _lines(K.CURVE_YARDS, ys, YARD_STEP)]
# Putts are published per foot and read per yard.
_LINES += [(a, b * K.FEET_PER_YARD) for a, b in _lines(K.PUTT_FEET, K.PUTT_STROKES, 1.0)]


def _constant_array(values: list[float]) -> Column:
    return F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")")


def _read(distance: Column, row: Column, per_yard: Column) -> Column:
    bucket = F.least(F.floor(F.greatest(distance, F.lit(0.0)) * per_yard), F.lit(BUCKETS - 1))
    index = (row * BUCKETS + bucket).cast("int")
    return F.get(_constant_array([a for a, _ in _LINES]), index) + F.get(
        _constant_array([b for _, b in _LINES]), index) * distance


def _row(lie: Column) -> Column:
    first, *others = LIE_ORDER
    row = F.when(lie == first, 0)
    for i, name in enumerate(others, start=1):
        row = row.when(lie == name, i)
    return row


def approach_strokes(distance: Column) -> Column:
    """Strokes to hole out from a clean lie."""
    return _read(distance, F.lit(LIE_ORDER.index("fairway")), F.lit(1.0 / YARD_STEP))


def putt_strokes(distance: Column) -> Column:
    """Putts to hole out from a distance in yards."""
    return _read(distance, F.lit(LIE_ORDER.index("green")), F.lit(K.FEET_PER_YARD))


def curve_strokes(distance: Column, lie: Column) -> Column:
    """Curve value for an approach lie or the green; null for any other lie."""
    per_yard = F.when(lie == "green", K.FEET_PER_YARD).otherwise(1.0 / YARD_STEP)
    return _read(distance, _row(lie), per_yard)


def expected_strokes(distance: Column, lie: Column) -> Column:
    """Benchmark strokes from a distance and lie: 0 once holed, a linear tee curve,
    an error for a lie that does not exist."""
    known = lie.isin(*LIE_ORDER)
    message = F.concat(F.lit("unknown lie: "), F.coalesce(lie, F.lit("null")))
    return (
        F.when(distance <= 0, F.lit(0.0))
        .when(lie == "tee", K.TEE_INTERCEPT + K.TEE_SLOPE * distance)
        .when(known, curve_strokes(distance, lie))
        .otherwise(F.raise_error(message).cast("double"))
    )


def strokes_gained(
    start: Column, start_lie: Column, end: Column, end_lie: Column, penalty: Column | float = 0.0
) -> Column:
    return expected_strokes(start, start_lie) - expected_strokes(end, end_lie) - 1.0 - penalty


def skill_tax(
    strokes: Column, distance: Column, lie: Column,
    short_game: Column | float, green_difficulty: Column | float,
) -> Column:
    """Scale the strokes above holing the next one by the player's short game and
    the difficulty of the green and the ground around it."""
    sg = short_game if isinstance(short_game, Column) else F.lit(float(short_game))
    gd = green_difficulty if isinstance(green_difficulty, Column) else F.lit(float(green_difficulty))
    on_green = lie == "green"
    tax = sg * F.when(on_green, K.PUTT_SKILL_WEIGHT).otherwise(1.0)
    near = on_green | (distance <= K.GREEN_ZONE_YARDS)
    tax = tax + F.when(near, gd * (K.GREEN_TAX_BASE + K.GREEN_TAX_SKILL * sg)).otherwise(0.0)
    return 1.0 + (1.0 + tax) * (strokes - 1.0)


def player_strokes(
    distance: Column, lie: Column,
    short_game: Column | float = 0.0, green_difficulty: Column | float = 0.0,
) -> Column:
    return skill_tax(curve_strokes(distance, lie), distance, lie, short_game, green_difficulty)
