"""Exact money.

Amounts arrive as doubles with two decimals. They are added as whole cents in a
BIGINT, which stays exact, is cheaper than a wide decimal sum, and raises instead
of wrapping if it ever overflows; the result is shown as DECIMAL(28,2).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: str | Column) -> Column:
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.round(column * 100).cast("bigint")


def money(total_cents: str | Column) -> Column:
    column = F.col(total_cents) if isinstance(total_cents, str) else total_cents
    return (column * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def sum_money(amount: str | Column) -> Column:
    return money(F.sum(cents(amount)))


def share(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL when the whole is zero."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round(ratio * 100, digits)


def percent_text(percent: Column, digits: int) -> Column:
    """``12.3`` -> ``12.3000%`` (the decimal cast keeps trailing zeros)."""
    return F.concat(percent.cast(f"decimal(18,{digits})").cast("string"), F.lit("%"))
