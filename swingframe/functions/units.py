"""Unit conversions and small physical formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from swingframe import constants as K


def mph_from_ms(c: Column) -> Column:
    return F.round(c * K.MS_TO_MPH, 2)


def yards_from_metres(c: Column) -> Column:
    return F.round(c * K.M_TO_YARDS, 1)


def total_spin(back: Column, side: Column) -> Column:
    return F.round(F.sqrt(back * back + side * side), 0)


def rad_s_from_rpm(c: Column) -> Column:
    return c * (2.0 * math.pi / 60.0)


def ms_from_mph(c: Column) -> Column:
    return c * K.MPH_TO_MS


def roll_yards(carry: Column, spin_rad_s: Column, firmness: float | Column = 1.0) -> Column:
    """Roll grows with carry and falls off with backspin."""
    weight = firmness if isinstance(firmness, Column) else F.lit(firmness)
    return weight * K.ROLL_COEFF * carry * F.exp(spin_rad_s * -K.ROLL_SPIN_DECAY)


def air_density(temp_c: Column, altitude_m: Column) -> Column:
    """Standard-atmosphere density in kg/m3."""
    power = K.GRAVITY / (K.GAS_CONSTANT * K.LAPSE_RATE)
    pressure = K.SEA_LEVEL_PA * F.pow(1.0 - K.LAPSE_RATE * altitude_m / K.SEA_LEVEL_K, F.lit(power))
    return pressure / (K.GAS_CONSTANT * (temp_c + 273.15))


def wind_angle(from_compass: Column, bearing: Column) -> Column:
    """Direction the wind blows from, relative to the line of play, in [0, 360)."""
    return F.pmod(from_compass - bearing, F.lit(360.0))


def wind_downrange(speed_mph: Column, angle_deg: Column) -> Column:
    return ms_from_mph(speed_mph) * F.cos(F.radians(angle_deg + 180.0))


def wind_lateral(speed_mph: Column, angle_deg: Column) -> Column:
    return ms_from_mph(speed_mph) * F.sin(F.radians(angle_deg + 180.0))


def wind_class(speed_mph: Column, angle_deg: Column) -> Column:
    """`calm`, `crosswind`, or into / downwind joined with off the right / left."""
    ahead, right = F.cos(F.radians(angle_deg)), F.sin(F.radians(angle_deg))
    head = F.when(ahead > 0.35, "into").when(ahead < -0.35, "downwind")
    side = F.when(right > 0.35, "off the right").when(right < -0.35, "off the left")
    words = F.concat_ws(" ", head, side)
    return F.when(speed_mph == 0, "calm").when(words == "", "crosswind").otherwise(words)


def shape_skew(hand: Column, shape: Column) -> Column:
    """Lateral skew of a stock shot shape, mirrored for a left-hander."""
    base = (
        F.when(F.lower(shape) == "draw", K.SHAPE_SKEW["draw"])
        .when(F.lower(shape) == "fade", K.SHAPE_SKEW["fade"])
        .otherwise(0.0)
    )
    return F.when((hand == "Right") | (base == 0.0), base).otherwise(-base)
