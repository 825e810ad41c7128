"""Rounding that does not depend on how a double happens to be stored."""

from pyspark.sql import functions as F


def round_half_up(value, digits):
    """Round half away from zero.

    A double is first brought to ten decimals, which removes the noise that the order of
    a distributed sum leaves in its last bits; 2.345 then rounds up wherever it was added.
    Doubles without such a decimal (NaN, infinities, 1e28 and more) are rounded as they are.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def percent_change(now, before, digits=2):
    """NULL when there is no earlier value or it is zero."""
    return round_half_up((now - before) / F.nullif(before, F.lit(0.0)) * 100, digits)
