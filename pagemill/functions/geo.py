"""Geographic points packed into longs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Degrees of one step: the circle in 2 ** 31 parts.
STEP = 360.0 / 2**31
KM_PER_DEGREE = 111.32


def pack(lat: Column, lon: Column) -> Column:
    """Latitude in the upper, longitude in the lower 32 bits, both as steps from -90 and -180 degrees."""
    a, b = F.floor((lat + 90.0) / STEP).cast("long"), F.floor((lon + 180.0) / STEP).cast("long")
    return F.shiftleft(a, 32).bitwiseOR(b)


def latitude(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 32) * STEP - 90.0


def longitude(packed: Column) -> Column:
    return packed.bitwiseAND(0xFFFFFFFF) * STEP - 180.0


def checked(lat: Column, lon: Column) -> Column:
    """(lat, lon), null if out of range or both zero, which stands for no place."""
    fine = F.abs(lat).between(0, 90) & F.abs(lon).between(0, 180) & ~((lat == 0) & (lon == 0))
    return F.when(fine, F.struct(lat.alias("lat"), lon.alias("lon")))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat distance, a degree taken as 111.32 km."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2)) * KM_PER_DEGREE


def place_key(population: Column, key: Column, folded: bool = False) -> list[Column]:
    """Sort columns: larger places first. ``folded`` takes 10000 off populations above that, as an old order did."""
    n = F.when(population > 10000, population - 10000).otherwise(population) if folded else population
    return [n.desc(), key.asc()]
