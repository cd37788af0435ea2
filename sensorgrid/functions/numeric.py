"""Rounding that does not depend on the decimal text of a double."""

from pyspark.sql import Column, functions as F

# Veltkamp constant 2^27 + 1: splits a double into two halves whose products are exact.
_SPLIT = float(2**27 + 1)


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Nearest multiple of ``10**-digits`` to the exact binary value, ties to even.

    ``bround`` rounds the shortest decimal text, so it moves 2.675 (stored slightly below)
    up; IEEE rounding of the stored value gives 2.67.  The error term of ``value * scale`` is
    computed exactly and decides the cases that look like ties after the multiplication.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be between 0 and 7")
    scale = F.lit(float(10**digits))
    product = value * scale
    low = F.floor(product).cast("double")
    part = product - low
    big = value * F.lit(_SPLIT)
    high = big - (big - value)
    error = (high * scale - product) + (value - high) * scale
    up = (
        F.when(part > 0.5, True)
        .when(part < 0.5, False)
        .when(error > 0, True)
        .when(error < 0, False)
        .otherwise(F.pmod(low, F.lit(2.0)) == 1.0)
    )
    return F.when(up, low + 1.0).otherwise(low) / scale
