"""Derived measures: prices, guarded rates, points."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .parsing import _column


def half_up(c: Column, digits: int = 2, exact: bool = False) -> Column:
    """Round half up. ``exact`` first settles the value at 8 decimals, so that
    a quotient a hair under a tie rounds alike on every engine."""
    if exact:
        return F.round(c.try_cast("decimal(28,8)"), digits).cast("double")
    return F.round(c, digits)


def unit_price(
    value: Column | str, surface: Column | str, digits: int = 2, exact: bool = False
) -> Column:
    """Value per unit of surface; NULL on a zero surface."""
    return half_up(F.try_divide(_column(value), _column(surface)), digits, exact)


def guarded_rate(
    part: Column | str, whole: Column | str, scale: int = 100, digits: int = 2,
    exact: bool = False,
) -> Column:
    """``part * scale / whole``, NULL unless ``whole`` is above zero."""
    part, whole = _column(part), _column(whole)
    return F.when(whole > 0, half_up(F.try_divide(part * scale, whole), digits, exact))


def or_zero(c: Column, digits: int = 2, exact: bool = False) -> Column:
    """NULL shown as 0, then rounded; the shape report rows carry."""
    return half_up(F.coalesce(c, F.lit(0.0)), digits, exact)


def geo_struct(
    lat: Column | str, lon: Column | str, zero_is_missing: bool = True
) -> Column:
    """``{lat, lon}``, or NULL when a coordinate is missing."""
    lat, lon = _column(lat), _column(lon)
    present = lat.isNotNull() & lon.isNotNull()
    if zero_is_missing:
        present = present & (lat != 0.0) & (lon != 0.0)
    return F.when(present, F.struct(lat.alias("lat"), lon.alias("lon")))
