"""Transverse Mercator between WGS84 degrees and the project's metres, as column expressions.

Krueger's series to the fourth order of the third flattening, on GRS80 with the
parameters of the public registry entry 3116: latitude of origin
4.596200416666666, central meridian -74.07750791666666, scale 1, false origin
1,000,000 m. Accurate to well under a millimetre within the zone; the two
datums are taken as equal, as the registry does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col

A, INVERSE_F = 6378137.0, 298.257222101
LAT0, LON0, SCALE, FALSE_E, FALSE_N = 4.596200416666666, -74.07750791666666, 1.0, 1_000_000.0, 1_000_000.0

_f = 1 / INVERSE_F
N = _f / (2 - _f)
ECC = math.sqrt(_f * (2 - _f))
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
FORWARD = (
    N / 2 - 2 / 3 * N**2 + 5 / 16 * N**3 + 41 / 180 * N**4,
    13 / 48 * N**2 - 3 / 5 * N**3 + 557 / 1440 * N**4,
    61 / 240 * N**3 - 103 / 140 * N**4,
    49561 / 161280 * N**4,
)
BACK = (
    N / 2 - 2 / 3 * N**2 + 37 / 96 * N**3 - 1 / 360 * N**4,
    1 / 48 * N**2 + 1 / 15 * N**3 - 437 / 1440 * N**4,
    17 / 480 * N**3 - 37 / 840 * N**4,
    4397 / 161280 * N**4,
)


def _meridian(lat: float) -> float:
    s = math.sin(lat)
    t = math.sinh(math.atanh(s) - ECC * math.atanh(ECC * s))
    xi = math.atan2(t, 1)
    return SCALE * RADIUS * (xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(FORWARD)))


NORTH0 = _meridian(math.radians(LAT0))


def to_metres(lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
    """(x, y) of degrees."""
    s = F.sin(F.radians(col(lat)))
    t = F.sinh(F.atanh(s) - ECC * F.atanh(ECC * s))
    d = F.radians(col(lon) - LON0)
    xi, eta = F.atan2(t, F.cos(d)), F.asinh(F.sin(d) / F.sqrt(t * t + F.cos(d) * F.cos(d)))
    x, y = eta, xi
    for j, a in enumerate(FORWARD, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_E + SCALE * RADIUS * x, FALSE_N + SCALE * RADIUS * y - NORTH0


def to_degrees(x: Column | str, y: Column | str, rounds: int = 5) -> tuple[Column, Column]:
    """(lon, lat) of metres."""
    xi0, eta0 = (col(y) - FALSE_N + NORTH0) / (SCALE * RADIUS), (col(x) - FALSE_E) / (SCALE * RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(BACK, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lon = LON0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))
    # geodetic latitude from the conformal one by fixed-point steps
    q = F.atanh(F.sin(chi))
    s = F.sin(chi)
    for _ in range(rounds):
        s = F.tanh(q + ECC * F.atanh(ECC * s))
    return lon, F.degrees(F.asin(s))


def metres_per_degree(lat: Column | str) -> tuple[Column, Column]:
    """Approximate lengths of a degree of longitude and of latitude."""
    return 111320.0 * F.cos(F.radians(col(lat))), F.lit(110540.0)
