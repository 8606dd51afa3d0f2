"""Money arithmetic on integer cents.

Amounts are ``bigint`` cents so sums are exact and independent of partition
order (a ``double`` partial sum is not). Ratios that the reports round to cents
or to one decimal are computed as exact integer quotients rounded half away
from zero (SQL ``ROUND`` semantics), never through a binary double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money(cents: Column) -> Column:
    """Cents to currency units as ``double`` (output edge only)."""
    return cents.cast("double") / F.lit(100.0)


def line_amount(quantity: Column, price_cents: Column) -> Column:
    """``coalesce(quantity, 0) * coalesce(price, 0)`` in cents."""
    return (F.coalesce(quantity, F.lit(0)).cast("bigint")
            * F.coalesce(price_cents, F.lit(0)).cast("bigint"))


def div_half_away(num: Column, den: Column) -> Column:
    """``round(num / den)`` to an integer, half away from zero, exactly.

    Both inputs are integral. Returns ``bigint``; NULL when ``den`` is 0 or
    NULL (the ``NULLIF(den, 0)`` guard of the reports).
    """
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    magnitude = F.call_function(
        "div", F.abs(n) * F.lit(2) + F.abs(d), F.abs(d) * F.lit(2))
    negative = (n < 0) != (d < 0)
    return (F.when(d.isNull() | (d == 0), F.lit(None).cast("bigint"))
            .when(negative, -magnitude)
            .otherwise(magnitude))
