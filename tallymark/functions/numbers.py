"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_price(price: str, area: str) -> Column:
    """Price per unit with two decimals; -1 without an area (missing counts as 0)."""
    size = F.coalesce(F.col(area).cast("double"), F.lit(0.0))
    return F.when(size == 0, F.lit(-1.0)).otherwise(F.round(F.try_divide(F.col(price), size), 2))


def division_report(a: str, b: str) -> Column:
    """The quotient of two texts as shown to a user, or what is wrong with them.

    Whole results have no decimals, others three.
    """
    x, y = F.col(a).try_cast("double"), F.col(b).try_cast("double")
    quotient = F.try_divide(x, y)
    whole = quotient % 1 == 0
    return (
        F.when(x.isNull() | y.isNull(), "Entered value is wrong")
        .when(y == 0, "Can't divide by zero")
        # The formats of the two results.
        .when(whole, F.format_string("%.0f", quotient))
        .otherwise(F.format_string("%.3f", quotient))
    )
