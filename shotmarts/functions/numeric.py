"""Rounding, guarded division and order-independent sums."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Adding a full half would round the double just under one half up.
JUST_UNDER_HALF = math.nextafter(0.5, 0.0)
XG_DIGITS = 8  # fixed-point digits kept when expected goals are added up


def round_half_up(c: Column, digits: int, signed: bool = True) -> Column:
    """Round a double, ties away from zero.

    Scaling, rounding to a whole number and scaling back is what SQL engines do for doubles.
    ``F.round`` goes through a decimal string instead: other answers on near-ties, and an
    allocation per row. ``signed=False``, for values that cannot be negative, evaluates ``c`` only
    once, which keeps generated code short. Adding 0.0 turns -0.0 into 0.0.
    """
    factor = F.lit(10.0**digits)
    scaled = c.cast("double") * factor
    if signed:
        whole = F.signum(scaled) * F.floor(F.abs(scaled) + F.lit(JUST_UNDER_HALF))
    else:
        whole = F.floor(scaled + F.lit(JUST_UNDER_HALF))
    return whole / factor + F.lit(0.0)


def round_half_even(c: Column, digits: int) -> Column:
    """Round a double, ties to the even neighbour (the rounding of numeric Python)."""
    factor = F.lit(10.0**digits)
    return F.rint(c.cast("double") * factor) / factor + F.lit(0.0)


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL for a zero denominator (ANSI mode would raise)."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def to_fixed_point(c: Column, digits: int) -> Column:
    return F.rint(c.cast("double") * F.lit(10.0**digits)).cast("bigint")


def exact_sum(c: Column, digits: int = XG_DIGITS) -> Column:
    """Sum of doubles as fixed-point integers: the same result however partial sums combine.

    Integers keep partial aggregation in primitive code (a wide decimal would not). An overflow
    raises in ANSI mode rather than wrapping.
    """
    return F.sum(to_fixed_point(c, digits)).cast("double") / F.lit(10.0**digits)


def exact_avg(c: Column, digits: int = XG_DIGITS) -> Column:
    """Mean of the non-NULL values, built on :func:`exact_sum`."""
    return safe_div(exact_sum(c, digits), F.count(c))


def clip(c: Column, low: float, high: float) -> Column:
    """NULL becomes zero, then the value is held within [low, high]."""
    filled = F.coalesce(c, F.lit(0.0))
    return F.greatest(F.least(filled, F.lit(high)), F.lit(low))
