"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_even(c: Column, digits: int) -> Column:
    """Round half to even on the scaled value (``round`` is half-up)."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def to_number(c: Column) -> Column:
    """Text to DOUBLE; junk and NaN become NULL.

    A trailing ``d`` or ``f`` is a Java literal suffix that the cast would
    accept, so it is ruled out first.
    """
    text = c.cast("string")
    plain = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text)
    return drop_nan(plain.try_cast("double"))


def drop_nan(c: Column) -> Column:
    """NaN to NULL: one NaN would poison every average, maximum and quantile."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_whole(c: Column) -> Column:
    """DOUBLE to nullable INT, NaN to NULL."""
    return F.rint(drop_nan(c)).try_cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def clip_zero(c: Column) -> Column:
    """Negative values to 0; NULL stays NULL."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def min_max(c: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column scales to 0, NULL stays NULL."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(ratio(c - low, high - low), F.lit(0.0))
    )
