"""Exact arithmetic, safe ratios and repairs of badly typed numbers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole for non-negative amounts, ties away from zero; NULL when the whole is zero.

    The rounding happens in whole hundredths: a quotient cut to some number of digits first, or held
    in binary, would push values next to a tie such as 99.455 to the wrong side.
    """
    part, whole = ((c.cast("decimal(26,2)") * 100).cast("decimal(28,0)") for c in (part, whole))
    whole = F.nullif(whole, F.lit(Decimal(0)))
    steps = 10**digits
    numerator = part * F.lit(Decimal(200 * steps)) + whole
    denominator = whole * 2
    rounded = (numerator - numerator % denominator) / denominator
    return (rounded / steps).cast(f"decimal(18,{digits})")


def repaired_int(value: Column) -> Column:
    """An integer that arrived as text or float: ``44.0`` gives 44, anything unreadable NULL."""
    return value.cast("string").try_cast("double").try_cast("int")


def count_where(condition: Column) -> Column:
    """How many rows satisfy the condition (0 rather than NULL on an empty input)."""
    return F.count_if(condition)
