"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MI = 3961
UNIT_FACTORS = {"mi": 1, "km": 1.60934}


def degrees_to_radians(degrees: Column) -> Column:
    return F.acos(F.lit(-1)) * degrees / 180


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    if unit not in UNIT_FACTORS:
        raise ValueError(f"unit must be one of {sorted(UNIT_FACTORS)}, got {unit!r}")

    def half_sine_squared(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))

    chord = half_sine_squared(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_sine_squared(lon1, lon2)
    return F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(chord)) * F.lit(UNIT_FACTORS[unit])
