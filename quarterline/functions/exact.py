"""Sums of doubles without any rounding but the last one, whatever the order of the rows.

A finite double is an integer times a power of two. Values whose exponents lie close together share one scale, on which
they are integers of at most 62 bits; those add up exactly, map-side, as decimals. A group has at most as many scales as
doubles have exponents over eight, usually a handful, and the scales are brought together in big integers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDTH, _BITS = 8, 53
#: Scale of the smallest double.
_LOWEST = -135


def scale_of(value: Column) -> Column:
    """Which integers a finite value is counted in; 0 for zero."""
    exponent = F.floor(F.log2(F.abs(value)))
    return F.when(value == 0, F.lit(0)).otherwise(F.floor(exponent / _WIDTH)).cast("int")


def units_of(value: Column, scale: Column) -> Column:
    """The value as an integer on its scale. Two exact steps, as one power of two could be out of range."""
    shift = F.lit(_BITS) - scale * _WIDTH
    half = F.floor(shift / 2)
    return (value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), shift - half)).cast("long").cast("decimal(28,0)")


def in_common(units: int, scale: int) -> int:
    """Units of a scale in those of the lowest one."""
    return units << _WIDTH * (scale - _LOWEST)


def as_double(common: int) -> float:
    """The nearest double to a sum in the lowest scale's units; infinite beyond the largest."""
    try:
        return common / (1 << _BITS - _WIDTH * _LOWEST)
    except OverflowError:
        return float("inf") if common > 0 else float("-inf")
