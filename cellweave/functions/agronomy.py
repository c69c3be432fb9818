"""Derived layers as column expressions: classes of relief, climate, soil and spectral indices."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import clip, col, floored


def bands(c: Column | str, edges: tuple[float, ...]) -> Column:
    """0 below the first edge, then one more from each edge on; missing stays missing."""
    c = col(c)
    out = F.when(c.isNull(), F.lit(None))
    for i, edge in enumerate(edges):
        out = out.when(c < edge, i)
    return out.otherwise(len(edges)).cast("int")


def altitude_class(c: Column | str) -> Column:
    return bands(c, (1000.0, 2000.0, 3000.0))


def slope_class(c: Column | str) -> Column:
    return bands(c, (5.0, 15.0, 30.0))


def stratum(altitude: Column, slope: Column, monitored: Column) -> Column:
    return (F.coalesce(altitude, F.lit(-1)) * 100 + F.coalesce(slope, F.lit(-1)) * 10 + monitored.cast("int")).cast("int")


def aspect_parts(degrees: Column | str) -> tuple[Column, Column]:
    """Sine and cosine of a direction; flat (negative) or missing has none."""
    d = col(degrees)
    flat = d.isNull() | (d < 0)
    return F.when(flat, 0.0).otherwise(F.sin(F.radians(d))), F.when(flat, 0.0).otherwise(F.cos(F.radians(d)))


def slope_percent(degrees: Column | str) -> Column:
    return F.tan(F.radians(col(degrees))) * 100.0


def slope_unified(value: Column, largest: Column) -> Column:
    """Degrees become percent where the layer's largest value lies in (90, 100]; otherwise it is percent already."""
    return F.when((largest > 90) & (largest <= 100), slope_percent(value)).otherwise(value)


def amplitude(t_max: Column | str, t_min: Column | str) -> Column:
    return col(t_max) - col(t_min)


def evapotranspiration(t_mean: Column | str, t_max: Column | str, t_min: Column | str, radiation: float = 15.0, days: float = 182.0) -> Column:
    """Hargreaves estimate for a half-year, at least 1."""
    spread = floored(amplitude(t_max, t_min), 0.0)
    return floored(0.0023 * (col(t_mean) + 17.8) * F.sqrt(spread) * radiation * days, 1.0)


def aridity(rain: Column | str, t_mean: Column | str, t_max: Column | str, t_min: Column | str) -> Column:
    return col(rain) / evapotranspiration(t_mean, t_max, t_min)


def ph_optimum(ph: Column | str) -> Column:
    return 1.0 - clip(F.abs(col(ph) - 6.5) / 3.5, 0.0, 1.0)


def min_max(c: Column | str, low: Column, high: Column) -> Column:
    """(c - low) / (high - low) within 0 to 1; 0 where the range is empty."""
    c = col(c)
    return F.when(high <= low, F.when(c.isNotNull(), 0.0)).otherwise(clip(F.try_divide(c - low, high - low), 0.0, 1.0))


def texture(clay: Column | str, sand: Column | str, silt: Column | str) -> tuple[Column, Column, Column]:
    """Shares of the three fractions in percent; missing where their sum isn't positive."""
    parts = [col(x).cast("double") for x in (clay, sand, silt)]
    whole = parts[0] + parts[1] + parts[2]
    return tuple(F.when(whole > 0, p / whole * 100.0) for p in parts)


def lapse(value: Column | str, altitude: Column | str, reference: float = 0.0, rate: float = 0.006) -> Column:
    """A temperature reduced from its altitude to a reference altitude."""
    return col(value) + rate * (col(altitude) - reference)


def spectral_indices(b02: Column, b03: Column, b04: Column, b08: Column, b11: Column) -> dict[str, Column]:
    e = 1e-10
    return {
        "ndvi": (b08 - b04) / (b08 + b04 + e),
        "gndvi": (b08 - b03) / (b08 + b03 + e),
        "evi": 2.5 * (b08 - b04) / (b08 + 6 * b04 - 7.5 * b02 + 1 + e),
        "ndwi": (b03 - b08) / (b03 + b08 + e),
        "msavi": (2 * b08 + 1 - F.sqrt((2 * b08 + 1) * (2 * b08 + 1) - 8 * (b08 - b04))) / 2,
        "bsi": ((b11 + b04) - (b08 + b02)) / ((b11 + b04) + (b08 + b02) + e),
        "savi": (b08 - b04) / (b08 + b04 + 0.5 + e) * 1.5,
    }


def decibel(c: Column | str) -> Column:
    """10 log10; missing for values that aren't positive."""
    c = col(c)
    return F.when(c > 0, 10.0 * F.log10(F.when(c > 0, c)))


def cloud_free(scl: Column | str) -> Column:
    return ~col(scl).isin(3, 8, 9, 10)


def agricultural(mean: Column | str, sigma: Column | str) -> Column:
    """Neither bare, nor dense forest, nor stable pasture; missing spread counts as 1, a missing mean keeps the cell."""
    m, s = col(mean), F.coalesce(col(sigma), F.lit(1.0))
    out = (m < 0.15) | ((m > 0.80) & (s < 0.06)) | ((m > 0.55) & (s < 0.04))
    return F.coalesce(~out, F.lit(True))


def cyclic(label: Column | str) -> tuple[Column, Column]:
    """cos(pi * half) and the half itself, 0 for A and 1 for B."""
    half = F.when(F.endswith(col(label), F.lit("B")), 1).otherwise(0)
    return half.cast("int"), F.cos(F.lit(math.pi) * half)


def heat_hue(share: Column | str) -> Column:
    """Hue of a heat colour: 240 (cold) to 0 (hot)."""
    return (1.0 - clip(share, 0.0, 1.0)) * 240.0
