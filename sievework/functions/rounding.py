"""Rounding that agrees with Python and JavaScript on the binary value, without leaving the JVM.

``bround`` works on the shortest decimal text of a double, so 2.675 goes up although the stored value is
below the midpoint. Here the distance to the midpoint is computed exactly: the scale is split into powers
of two, whose products with a double are exact, and the differences taken near the midpoint are exact too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2 * 10**digits as a sum of powers of two, largest first.
_DOUBLED_SCALE = {1: (16.0, 4.0), 2: (128.0, 64.0, 8.0)}


def _distance(value: Column, digits: int, midpoint: Column) -> Column:
    """``2 * 10**digits * value - midpoint``, exact whenever the value is near the midpoint."""
    first, *rest = _DOUBLED_SCALE[digits]
    return reduce(lambda acc, p: acc + value * p, rest, value * first - midpoint)


def _rounded(value: Column, digits: int, ties_up: bool) -> Column:
    value = value.cast("double")
    scale = float(10**digits)
    near = F.rint(value * scale)
    over = _distance(value, digits, near * 2 + 1)
    under = _distance(value, digits, near * 2 - 1)
    bump = over >= 0 if ties_up else over > 0
    return F.when(bump, near + 1).when(under < 0, near - 1).otherwise(near) / scale


def round_half_even(value: Column, digits: int) -> Column:
    """Python's ``round(value, digits)`` for 1 or 2 digits."""
    return _rounded(value, digits, ties_up=False)


def to_fixed(value: Column, digits: int) -> Column:
    """JavaScript's ``value.toFixed(digits)`` for non-negative values and 1 or 2 digits, as text."""
    return F.format_string(f"%.{digits}f", _rounded(value, digits, ties_up=True))


def round_array_style(value: Column, digits: int) -> Column:
    """Rounding as numeric array libraries do it: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale
