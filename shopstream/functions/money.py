"""Exact money sums.

Amounts arrive as text or doubles of up to six decimals. Summing them as whole
millionths gives the same total in any order of rows, so a retried task or
another number of partitions cannot change a result. A group's partial sum is
a long, which stays in the generated hash aggregate and fails rather than
overflow; totals are wide decimals and are rounded once, to a double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMALS = 6


def minor(amount: Column) -> Column:
    """Amount as a whole number of millionths."""
    return F.round(amount.try_cast("double") * float(10 ** DECIMALS)).cast("long")


def major(units: Column) -> Column:
    """Millionths as a double amount."""
    return (units.cast("decimal(32,0)") * F.lit(Decimal(1).scaleb(-DECIMALS))).cast("double")


def total(units: Column) -> Column:
    """Sum of millionths as a double amount."""
    return major(F.sum(units.cast("decimal(20,0)")))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, or null when the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
