"""Exact decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_BREAK_SPACE = "\u00a0"


def line_amount(price: str = "price", quantity: str = "quantity") -> Column:
    return F.col(price) * F.col(quantity)


def parse_localised(text: Column) -> Column:
    """Number written with no-break spaces between thousands and a decimal comma."""
    plain = F.replace(F.replace(text, F.lit(NO_BREAK_SPACE), F.lit("")), F.lit(","), F.lit("."))
    return plain.cast("decimal(18,2)")


def mean(total: Column, count: Column) -> Column:
    """Average rounded half up to cents; the narrow casts keep 13 digits in the quotient."""
    return F.round(F.try_divide(total.cast("decimal(20,2)"), count.cast("decimal(10,0)")), 2).cast("decimal(20,2)")


def percent(part: Column, whole: Column) -> Column:
    """Share in percent rounded to 2; null when the whole is zero or missing."""
    ratio = F.try_divide(part.cast("decimal(22,2)"), whole.cast("decimal(22,2)"))
    return F.round(ratio * F.lit(100), 2).cast("decimal(20,2)")


def none_if_zero(count: Column) -> Column:
    """A block without rows joins as null, not as zero."""
    return F.when(count != 0, count)
