"""Closed-form models applied to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldspark.fixed_values import BIOMASS_COEFFICIENTS, BIOMASS_FLOOR_G, LOG_AXIS_OFFSET
from fieldspark.functions.nulls import as_column


def growth(x: Column | str, coefficients: tuple[float, float, float]) -> Column:
    """a + b * exp(c * x)."""
    a, b, c = coefficients
    return F.lit(float(a)) + F.lit(float(b)) * F.exp(F.lit(float(c)) * as_column(x))


def biomass_g(
    diameter_mm: Column | str,
    coefficients: tuple[float, float, float] = BIOMASS_COEFFICIENTS,
    floor: float = BIOMASS_FLOOR_G,
) -> Column:
    """Mass from test diameter, floored; a missing diameter stays missing."""
    mass = growth(diameter_mm, coefficients)
    return F.when(mass.isNotNull(), F.greatest(mass, F.lit(floor)))


def offset_log10(x: Column | str, offset: float = LOG_AXIS_OFFSET) -> Column:
    return F.log10(as_column(x) + F.lit(offset))


def rescale(x: Column, lo: Column, hi: Column, to: tuple[float, float]) -> Column:
    """Linear rescale of [lo, hi] onto ``to``; a zero range maps to the midpoint."""
    a, b = to
    return F.when(hi == lo, F.lit((a + b) / 2)).otherwise(
        F.lit(a) + F.try_divide(x - lo, hi - lo) * F.lit(b - a)
    )
