"""Rounding and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float(2**27 + 1)


def round_exact(value: Column, digits: int) -> Column:
    """Round the exact binary value of a double; true ties go to the even digit.

    Spark's own ``round`` works on the shortest decimal form, where 0.35 looks
    like a tie although the double is below it. The value is split in two halves
    whose scaled products are exact, so the distance to the tie has a true sign.
    """
    scale = 10**digits
    spread = value * _SPLIT
    high = spread - (spread - value)
    low = value - high
    below = F.floor(value * scale)
    past_tie = (high * scale - below - 0.5) + low * scale
    up = (past_tie > 0) | ((past_tie == 0) & (below % 2 != 0))
    return (below + F.when(up, 1).otherwise(0)) / scale


def percent_of(count: Column, total: Column) -> Column:
    """Share in percent, 0 when there is nothing to share."""
    return F.coalesce(F.try_divide(count, total) * 100, F.lit(0.0))
