"""Sums of money that do not depend on the order of addition and drop no amount."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,8)"
# Amounts from here on, and those that are not finite, are added as doubles; a decimal sum
# of smaller ones cannot overflow.
EXACT_BELOW = 1e12


def exact_part(amount: Column) -> Column:
    return F.when(F.abs(amount) < EXACT_BELOW, amount.cast(EXACT))


def other_part(amount: Column) -> Column:
    """Null for the usual amount; NaN and infinities stay visible in a total."""
    return F.when(~(F.abs(amount) < EXACT_BELOW), amount)


def total(exact: Column, other: Column) -> Column:
    """The sum of both parts' sums as a double; null when neither holds an amount."""
    exact = exact.cast("double")
    return F.coalesce(exact + F.coalesce(other, F.lit(0.0)), other)


def money_sum(amount: Column) -> Column:
    return total(F.sum(exact_part(amount)), F.sum(other_part(amount)))
