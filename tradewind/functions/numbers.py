"""Tolerant numbers and exact money."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_double(name: str) -> Column:
    """NULL where the value is no number."""
    return F.col(name).try_cast("double")


def safe_double(value: Column) -> Column:
    """0.0 where the value is no number."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def safe_long(value: Column) -> Column:
    """Whole part of the number in ``value``, 0 where there is none."""
    return F.coalesce(value.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def money(value: Column) -> Column:
    """Six decimals, exact under addition in any order; an amount of 22 digits before the point is an error."""
    return value.try_cast("double").cast("decimal(28,6)")


def money_sum(value: Column) -> Column:
    """Sum of amounts as a double that does not depend on the order of addition."""
    return F.sum(money(value)).cast("double")
