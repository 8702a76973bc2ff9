"""Rounded means and percentages that do not depend on the order of summation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT = "decimal(28,4)"


def exact_sum(c: Column) -> Column:
    """Sum in decimal, so the result is the same however the rows are split."""
    return F.sum(c.cast(EXACT))


def rounded_ratio(total: Column, n: Column, digits: int = 0) -> Column:
    """total / n rounded half away from zero; NULL for n = 0."""
    return F.round(F.try_divide(total.cast("double"), n.cast("double")), digits)


def rounded_mean(c: Column, digits: int = 0) -> Column:
    return rounded_ratio(exact_sum(c), F.count(c), digits)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole with one decimal, half away from zero, by whole-number arithmetic."""
    part, whole = part.cast("bigint"), whole.cast("bigint")
    numerator, denominator = part * 2000 + whole, whole * 2
    tenths = F.try_divide(numerator - F.try_mod(numerator, denominator), denominator)
    return tenths.cast("double") / 10.0


def count_null(c: Column) -> Column:
    return F.count_if(c.isNull())


def count_present(c: Column) -> Column:
    return F.count_if(c.isNotNull())
