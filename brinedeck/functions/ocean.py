"""Ocean formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from brinedeck.fixed_values import (
    CARBON_ALLOMETRY,
    CARBON_CYANOBACTERIA,
    CARBON_OTHER,
    DEPTH_BINS,
    HARMONIC_YEAR,
    REF_DEPTH_M,
    SHALLOW_REF_DEPTH_M,
    SHALLOW_STATIONS,
)
from brinedeck.functions.missing import ratio
from brinedeck.functions.text import station_of_trip


def cell_carbon(group: Column, biovolume: Column, cells: Column) -> Column:
    """Carbon of one cell from its volume, by taxon group."""
    volume = ratio(biovolume, cells)
    out = F.when(group == "Cyanobacteria", F.lit(CARBON_CYANOBACTERIA))
    for name, (factor, exponent) in CARBON_ALLOMETRY.items():
        out = out.when(group == name, F.lit(factor) * F.pow(volume, F.lit(exponent)))
    factor, exponent = CARBON_OTHER
    return F.when(group.isNotNull(), out.otherwise(F.lit(factor) * F.pow(volume, F.lit(exponent))))


def kelvin_to_celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(273.15)


def harmonic(doy: Column, mean: Column, an_cos: Column, an_sin: Column, sa_cos: Column, sa_sin: Column) -> Column:
    """Climatology value at a day of year: mean, annual and semi-annual terms."""
    t = doy * F.lit(2.0 * math.pi) / F.lit(HARMONIC_YEAR)
    return mean + an_cos * F.cos(t) + an_sin * F.sin(t) + sa_cos * F.cos(t * 2) + sa_sin * F.sin(t * 2)


def depth_bin(depth: Column) -> Column:
    """Label of the (low, high] bin; NULL outside all bins."""
    out = None
    for low, high, label in DEPTH_BINS:
        inside = (depth > low) & (depth <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def reference_depth(trip: Column) -> Column:
    """Depth the mixed-layer thresholds start from; shallower at two stations."""
    return F.when(station_of_trip(trip).isin(*SHALLOW_STATIONS), F.lit(SHALLOW_REF_DEPTH_M)).otherwise(
        F.lit(REF_DEPTH_M)
    )


def log10_squished(value: Column, low: float = -1.5, high: float = 1.0) -> Column:
    """log10 clamped to [low, high]; NULL where the value is missing or has no logarithm."""
    log = F.when(value > 0, F.log10(value))
    return F.when(log.isNotNull(), F.greatest(F.least(log, F.lit(high)), F.lit(low)))


def bilinear_blend(
    x: Column, y: Column, x1: Column, x2: Column, y1: Column, y2: Column,
    v11: Column, v21: Column, v12: Column, v22: Column,
) -> Column:
    """Blend of four corners; on a node line only the other axis is interpolated."""
    wx = F.when(x1 == x2, F.lit(0.0)).otherwise(ratio(x - x1, x2 - x1))
    wy = F.when(y1 == y2, F.lit(0.0)).otherwise(ratio(y - y1, y2 - y1))
    low = v11 * (1 - wx) + v21 * wx
    high = v12 * (1 - wx) + v22 * wx
    return low * (1 - wy) + high * wy
